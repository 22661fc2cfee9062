"""Near-duplicate classes and decontamination against brute force."""

import itertools
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from constella.llm import common, decontaminate, near
from tests.llm.cases import EDGE_TEXTS, documents


def prose(seed, n, vocabulary=900):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(words, seed, edits):
    rng, out = random.Random(seed), list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"edit{rng.randrange(10**6)}"
    return out


def brute_classes(texts, idf):
    weighed = [near.weigh(t, idf) for t in texts]
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if texts[a] == texts[b] or near.weighted_jaccard(weighed[a], weighed[b]) >= near.SIMILARITY - 1e-6:
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return [root(i) for i in range(len(texts))]


def corpus():
    texts = [" ".join(prose(i, 120)) for i in range(40)]
    for i in range(8):  # groups of near copies of several sizes, and exact copies
        base = prose(100 + i, 200)
        texts += [" ".join(edited(base, k, 1 + k % 3)) for k in range(2 + 3 * i)]
        texts += [" ".join(base)] * 2
    shared = prose(999, 90)  # a passage that different documents share
    texts += [" ".join(prose(500 + i, 60) + shared + prose(700 + i, 60)) for i in range(25)]
    return texts


def test_classes_equal_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    idf = near.idf_table(df.select("text"), 0.25)
    got = {r.doc_id: r.class_id for r in near.classify(df).select("row.doc_id", "class_id").collect()}
    want = brute_classes(texts, idf)
    assert [got[i] for i in range(len(texts))] == want
    assert len(set(want)) < len(texts) - 100


def test_classes_over_many_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 8)
    monkeypatch.setattr(near, "LEADERS", 2)
    monkeypatch.setattr(near, "COLUMNS", 64)
    base = prose(1, 120)
    texts = [" ".join(edited(base, k, 1 + k % 4)) for k in range(90)] + [" ".join(prose(k + 10, 80)) for k in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    idf = near.idf_table(df.select("text"), 0.25)
    got = {r.doc_id: r.class_id for r in near.classify(df).select("row.doc_id", "class_id").collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts, idf)


def test_block_similarities_equal_pairwise(monkeypatch):
    monkeypatch.setattr(near, "COLUMNS", 16)
    base = prose(3, 40, 12)  # few words: shingles repeat
    texts = [" ".join(base * 3), " ".join(base * 2 + prose(4, 9)), " ".join(edited(base * 3, 1, 4)), "one", "one two"]
    idf = np.linspace(1, 1.2, near.CELLS).astype(np.float32)
    weighed = [near.weigh(t, idf) for t in texts]
    want = [[near.weighted_jaccard(a, b) for b in weighed] for a in weighed]
    off = ~np.eye(len(texts), dtype=bool)  # a text's own features are left out of the products
    assert np.allclose(near.similarities(texts, idf)[off], np.array(want)[off], atol=1e-6)


def test_hot_group_is_one_class_by_leaders(spark):
    base = prose(1, 150)
    texts = [" ".join(edited(base, k, 1)) for k in range(300)] + [" ".join(prose(k + 10, 80)) for k in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = near.classify(df).select("row.doc_id", "class_id").collect()
    assert {r.class_id for r in rows if r.doc_id < 300} == {0}
    assert all(r.class_id == r.doc_id for r in rows if r.doc_id >= 300)


def test_document_frequencies_count_every_row(spark):
    texts = corpus()[:60]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "text string").repartition(5)
    counts, n = near.document_frequencies(df)
    want = np.zeros(near.CELLS, int)
    for t in texts:
        want[np.unique(near._cells(near.shingles(t)[0]))] += 1
    assert n == len(texts) and (counts == want).all()


def shares(texts):
    held = {}
    for t in texts:
        for f in near.shingles(t)[0].tolist():
            held[f] = held.get(f, 0) + 1
    return {f: n / len(texts) for f, n in held.items()}


def test_idf_follows_exact_shares(spark):
    """Weights from the hashed table against weights from exact counts."""
    shared = [" ".join(prose(900 + k, 40)) for k in range(4)]
    texts = [" ".join(prose(i, 150, 50_000)) + "".join(f" {s}" for k, s in enumerate(shared) if i % (2, 5, 20, 100)[k] == 0)
             for i in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    idf = near.idf_table(df, 1.0)
    off = []
    for f, share in shares(texts).items():
        exact = 1 + np.log(max(share, near.RARE)) / np.log(near.RARE)
        off.append(abs(idf[near._cells(np.array([f], np.uint64))][0] - exact))
    assert np.mean(off) < 0.01 and np.quantile(off, 0.999) < 0.12


def test_similarity_does_not_depend_on_the_corpus_size():
    """Ten times the documents, the same shares: the same similarity of a fixed pair."""
    a, b = prose(1, 300), prose(2, 60)
    pair = [" ".join(a + b), " ".join(edited(a, 3, 8) + b)]
    found = []
    for n in (3_000, 30_000, 3_000_000, 300_000_000):
        rng = np.random.default_rng(1)  # every document has 400 shingles of its own, one in six holds the passage b
        counts = rng.poisson(n * 400 / near.CELLS, near.CELLS)
        counts[near._cells(near.shingles(" ".join(b))[0])] += n // 6
        idf = near.idf_of(counts, n, 0.25)
        found.append(near.weighted_jaccard(near.weigh(pair[0], idf), near.weigh(pair[1], idf)))
    assert max(found) - min(found) < 0.002
    flat = near.weighted_jaccard(*(near.weigh(t, np.ones(near.CELLS, np.float32)) for t in pair))
    assert abs(found[0] - flat) > 0.002  # and the weights act


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    features = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    n = len(features)
    agreed, exact = 0.0, 0.0
    for k in range(40):
        a = (features, rng.random(n).astype(np.float32) + 0.5)
        b = (features, (a[1] * np.where(rng.random(n) < 0.3, 0.4, 1)).astype(np.float32))
        shift = np.uint64(k * 7919)
        x, y = near.samples(a[0] + shift, a[1]), near.samples(b[0] + shift, b[1])
        agreed += (x == y).mean() / 40
        exact += near.weighted_jaccard(a, b) / 40
    assert abs(agreed - exact) < 0.05


def test_looked_up_samples_equal_computed_ones():
    rng = np.random.default_rng(7)
    for n in (1, 50, 9000):
        features = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        usual = np.float32(2 ** 0.25)
        weights = np.where(rng.random(len(features)) < 0.8, usual, rng.random(len(features)) + 1).astype(np.float32)
        assert (near.samples(features, weights, usual) == near.samples(features, weights)).all()
        assert (near.samples(features, weights, np.float32(9)) == near.samples(features, weights)).all()


def test_lone_pairs_at_the_threshold_share_a_band():
    rng = np.random.default_rng(8)
    ones = np.ones(90, np.float32)
    missed = 0
    for _ in range(8000):
        x = rng.integers(0, 1 << 63, 100).astype(np.uint64)  # 80 of 100 in common: similarity 0.8
        a, b = (near.bands_of(near.samples(near._mix(f), ones)) for f in (x[:90], x[10:]))
        missed += not (a == b).any()
    assert missed == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)]
    label = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.label for r in common.min_classes(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: y for x, y in label.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert common.min_classes(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_edge_rows(spark):
    docs = documents(spark)
    rows = near.classify(docs).select("row.*", "class_id").collect()
    assert len(rows) == len(EDGE_TEXTS)
    same = [r for r in rows if r.text == EDGE_TEXTS[9]]
    assert {r.class_id for r in same} == {9}
    kept = near.stage_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == len(EDGE_TEXTS) - 1
    assert near.stage_near_duplicates(spark, docs.limit(0), "").count() == 0
    nulls = near.stage_near_duplicates(spark, documents(spark, [None, None, "", "", "?!", "?!"]), "")
    assert sorted((r.text is None, r.text) for r in nulls.collect() if r.text is not None) == [(False, ""), (False, "?!")]
    assert nulls.where("text is null").count() == 2


def brute_hits(text, items):
    words = decontaminate.words_of(text)
    hit, found = set(), set()
    for item, body in items:
        w = decontaminate.words_of(body)
        size = min(13, len(w))
        grams = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [2_000_000, 40])
def test_decontamination_equals_brute_force(spark, block_words):
    items = [(i, " ".join(prose(i, n, 60))) for i, n in enumerate([40, 13, 14, 5, 2, 1, 0, 30])]
    items += [(50, None), (None, "w1 w2 w3"), (51, "W1, w2! ÄB"), (7, items[0][1])]
    texts = [" ".join(prose(100 + i, 200, 60)) for i in range(20)]
    texts += ["pre " + items[0][1].upper() + " post", " ".join(items[0][1].split()[3:25]), items[1][1] + " x " * 300,
              "w1 w2 Äb", "w1 w2 äB", None, "", "... !!"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.match(df, bench, block_words)
    rows = found.select("row.doc_id", "found.*", decontaminate.contaminated().alias("bad")).collect()
    known = [(i, t) for i, t in items if i is not None]
    assert len(rows) == len(texts)
    for r in rows:
        n, hits, ids = brute_hits(texts[r.doc_id], known)
        assert (r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) == (n, hits, ids)
        assert r.bad == (hits > 0 and 20 * hits >= n)


@pytest.mark.parametrize("block_words", [2_000_000, 40])
def test_items_without_id_hit_as_in_sql(spark, block_words):
    body = prose(1, 30, 500)
    texts = ["x " + " ".join(body) + " y", " ".join(prose(2, 60, 500)), "a b c d", None]
    items = [(None, " ".join(body)), (3, " ".join(body[5:25])), (None, "b C"), (4, None)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.match(df, bench, block_words).select("row.doc_id", decontaminate.n_hit().alias("n_hit"),
                                                               F.size("found.items").alias("n_items"))
    got = sorted(tuple(r) for r in found.collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert got == sorted(con.execute(f"SELECT doc_id, n_hit, n_items FROM ({decontaminate.OP7_SQL})").fetchall())
    assert got == [(0, 30, 2), (1, 0, 0), (2, 2, 1), (3, 0, 0)]


def test_index_takes_the_rarest_shingle_of_all_documents(spark):
    texts = [" ".join(prose(i, 150, 12)) for i in range(30)] + [None, "", "w1 w2"]
    items = [(1, " ".join(prose(90, 30, 12))), (2, " ".join(prose(91, 13, 12))), (3, "w1 w2"), (None, "w3"), (4, "W3")]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    held = {}
    for t in texts:
        w = decontaminate.words_of(t)
        for size in (1, 2, 3):
            for shingle in {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}:
                held[shingle] = held.get(shingle, 0) + 1
    rows = decontaminate.index_rows(docs, bench).collect()
    expected = {(bytes(w), i) for w, ids in decontaminate.windows_of(items).items() for i in ids}
    assert {(bytes(r.window), r.item) for r in rows} == expected and len(rows) == len(expected)
    for r in rows:
        w = bytes(r.window).split(b" ")
        size = min(3, len(w))
        counts = [held.get(tuple(w[i:i + size]), 0) for i in range(len(w) - size + 1)]
        assert counts[r.offset] == min(counts)
        key = int(decontaminate._shingles(common.word_hashes(w), size).view("int64")[r.offset])
        assert r.key == key


@pytest.mark.parametrize("most", [1, 13, 14, 20, 40, 1000])
def test_pieces_hold_each_window_once(most):
    size = decontaminate.WINDOW
    for n in (0, 1, 12, 13, 14, 40, 41):
        words = [str(i).encode() for i in range(n)]
        pieces = list(decontaminate._pieces(words, most))
        held = [tuple(p[i:i + size]) for p in pieces for i in range(max(1, len(p) - size + 1))]
        assert held == [tuple(words[i:i + size]) for i in range(max(1, n - size + 1))]
        assert all(len(p) <= max(most, size) for p in pieces)


def test_decontamination_edge_rows(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.match(docs, none).count() == len(EDGE_TEXTS)
    some = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (2, "")], "item_id long, text string")
    rows = decontaminate.match(docs, some).select("row.text", "found.items").collect()
    assert [r["items"] for r in rows if r.text == "one two three"] == [[1]]
    assert decontaminate.match(docs.limit(0), some).count() == 0


def test_words_hashes_and_bands_of_a_batch_are_those_of_each_text():
    texts = [*(t for t in EDGE_TEXTS if t), "İstanbul ẞ\x00a\x1fb\x85c\u2028d E-F_g", " ".join(prose(5, 300))]
    for text in texts:
        words = re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode())
        assert text.lower().encode().translate(near._WORD_BYTES).split() == words
        assert common.word_hashes(words).tolist() == [xxhash.xxh3_64_intdigest(w) for w in words]
    rng = np.random.default_rng(4)
    signatures = rng.integers(0, 1 << 63, (5, near.SAMPLES)).astype(np.uint64)
    bands = near.bands_of(signatures)
    assert bands.shape == (5, near.SAMPLES // near.ROWS)
    assert (bands == np.array([near.bands_of(s) for s in signatures])).all()
