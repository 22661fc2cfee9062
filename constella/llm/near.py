"""Operator 6: near-duplicate classes by consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles (lower-cased words; a text of one to four
words is one shingle). A shingle weighs tf * idf ** idf_power, where idf = 1 + ln(1 / f) / ln(1 / RARE)
lies between 1 and 2 and f is the share of documents that hold the shingle, at least ``RARE``. So the
weights follow from shares and not from the corpus' size. The shares come from a hashed count table
over all documents, of fixed size (``CELLS``), less the mean load of a cell. That load is a share, too:
shingles of a document / CELLS, whatever the number of documents; where it nears ``RARE`` (texts of
hundreds of words on average), ``RARE`` is raised to four times the load. The power is below 1 so that a large group of copies, which makes its own
shingles common, keeps its similarity; common boilerplate still weighs less than rare text.

1. Count table: each task sums its documents' cells; the partial tables are added in a tree.
2. Signature: 96 improved consistent weighted samples (Ioffe 2010), 24 bands of 4. A lone pair at
   similarity 0.80 shares no band with probability (1 - 0.8^4)^24, under 4 in a million.
3. Equal texts become one node first, so copies cost one row each and no pair.
4. Links. The members of a bucket are dealt into blocks (by number and by bytes), and all pairs of a
   block are verified on the exact weighted Jaccard similarity of their texts (``similarity`` or
   more); a block returns fewer links than it has texts. A bucket of several blocks also has leaders,
   drawn by hash, which are in all its blocks: in a group of near copies they join most members into
   one class. The first bands go first; of the others, only buckets with several classes are left.
5. In a bucket of several blocks, the members outside its largest class then meet all others, block by
   block. Thus no pair of a bucket stays untested unless its two texts are in one class already.
6. Classes are the connected parts of the verified links, found by large-star/small-star rounds.

Row cases: a null text is a class of its own, always. Texts without words are equal only byte for
byte. Repeated rows and copies share a class; ``class_id`` is its least non-null doc_id (null if it
has none). Extra columns of any name pass through untouched, as the row travels in one struct.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.llm.common import checkpointed, lean_batches, min_classes, staged, table, text_batches, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
CELLS = 1 << 18
RARE = 1 / 256
SAMPLES, ROWS = 96, 4
#: Texts and bytes of a block in verification, leaders of a bucket, and columns of a dense product.
BLOCK, BLOCK_BYTES, LEADERS, COLUMNS = 192, 4 << 20, 48, 4096
#: Bands of the first round.
EARLY = 4
_PARAMETERS = 1 << 14
#: Every byte that is in no word (``[0-9a-z\x80-\xff]+``) becomes a space.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32 for b in range(256))
_SIGNED = "key binary, words boolean, bands array<long>"
_draws: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed odd multipliers)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a whole text, and how often each occurs."""
    words = text.lower().encode().translate(_WORD_BYTES).split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    ids = word_hashes(words)
    n = len(ids) - SHINGLE + 1
    if n < 1:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], np.uint64), np.ones(1, np.int64)
    joined = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        joined = (joined ^ ids[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        joined ^= joined >> np.uint64(29)
    return np.unique(_mix(joined), return_counts=True)


def _cells(features: np.ndarray) -> np.ndarray:
    return (features >> np.uint64(64 - 18)).astype(np.int64)


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """The hashed count table over all rows of ``text``, and the number of texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(CELLS, np.int64), 0
        for _, rows in text_batches(batches, 0):
            found = [_distinct(_cells(shingles(t)[0])) for t in rows if t]
            n += sum(len(x) > 0 for x in found)
            if found:
                counts += np.bincount(np.concatenate(found), minlength=CELLS)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary()),
                                          pa.array([n], pa.int64())], names=["counts", "n"])

    def add(x: tuple[bytes, int], y: tuple[bytes, int]) -> tuple[bytes, int]:
        both = np.frombuffer(zlib.decompress(x[0]), np.int64) + np.frombuffer(zlib.decompress(y[0]), np.int64)
        return zlib.compress(both.tobytes(), 1), x[1] + y[1]

    tables = texts.mapInArrow(run, "counts binary, n long").rdd.map(lambda r: (bytes(r["counts"]), r["n"]))
    packed, n = tables.treeReduce(add, depth=3) if tables.getNumPartitions() else (b"", 0)
    return (np.frombuffer(zlib.decompress(packed), np.int64) if packed else np.zeros(CELLS, np.int64)), n


def idf_of(counts: np.ndarray, n: int, idf_power: float) -> np.ndarray:
    """Weights by cell, from the cells' counts over ``n`` texts with words."""
    if n < 1:
        return np.ones(CELLS, np.float32)
    load = counts.mean() / n
    rare = min(max(RARE, 4 * load), 0.5)
    share = np.clip(counts / n - load, rare, 1.0)
    return ((1 + np.log(share) / np.log(rare)) ** idf_power).astype(np.float32)


def idf_table(texts: DataFrame, idf_power: float) -> np.ndarray:
    return idf_of(*document_frequencies(texts), idf_power)


def weigh(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    features, tf = shingles(text)
    return features, tf.astype(np.float32) * idf[_cells(features)]


def _parameters() -> list[np.ndarray]:
    """r, 1/r, ln c and beta of the samples, drawn once by a fixed seed for each hashed row."""
    if not _draws:
        rng = np.random.default_rng(20_100)
        r = rng.gamma(2.0, 1.0, (_PARAMETERS, SAMPLES))
        c = rng.gamma(2.0, 1.0, (_PARAMETERS, SAMPLES))
        beta = rng.random((_PARAMETERS, SAMPLES))
        _draws.extend(x.astype(np.float32) for x in (r, 1 / r, np.log(c), beta))
    return _draws


_values: dict[float, tuple[np.ndarray, np.ndarray]] = {}


def _levels(log_weights: np.ndarray, row: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Values and levels of the samples for weights (their logarithms) in parameter rows (None: in all)."""
    r, inverse, log_c, beta = (x if row is None else np.take(x, row, axis=0) for x in _parameters())
    level = np.floor(log_weights[:, None] * inverse + beta)
    return log_c - r * (level - beta) - r, level


def _values_of(weight: np.float32) -> tuple[np.ndarray, np.ndarray]:
    """Values and levels of one weight in all parameter rows; the last weights are remembered."""
    key = float(weight)
    if key not in _values:
        if len(_values) >= 2:
            _values.clear()
        _values[key] = _levels(np.log(np.full(_PARAMETERS, weight, np.float32)), None)
    return _values[key]


def samples(features: np.ndarray, weights: np.ndarray, usual: np.float32 | None = None) -> np.ndarray:
    """The 96 samples (shingle, level) of a weighted set, each as one 64-bit hash.

    Most shingles are rare and occur once, so they have one weight (``usual``), whose values are looked up.
    """
    best = np.full(SAMPLES, np.inf, np.float32)
    out, owner = np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, np.uint64)
    columns = np.arange(SAMPLES)
    common = weights == usual if usual is not None else np.zeros(len(weights), bool)
    for looked_up, chosen in ((True, common), (False, ~common)):
        some, some_weights = features[chosen], weights[chosen]
        for at in range(0, len(some), 4096):  # blocks: memory does not grow with the text
            part = some[at:at + 4096]
            row = (part & np.uint64(_PARAMETERS - 1)).astype(np.int64)
            if looked_up:
                values, levels = _values_of(usual)
                value = np.take(values, row, axis=0)
            else:
                value, level = _levels(np.log(some_weights[at:at + 4096]), row)
            place = np.argmin(value, axis=0)
            least = value[place, columns]
            new = (least < best) | ((least == best) & (part[place] < owner))  # the smaller shingle on a tie
            best[new], owner[new] = least[new], part[place][new]
            at_level = levels[row[place], columns] if looked_up else level[place, columns]
            picked = at_level.astype(np.int64).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            out[new] = _mix(part[place] ^ picked)[new]
    return out


def bands_of(sig: np.ndarray) -> np.ndarray:
    """Bucket numbers of the bands of one signature, or of each row of several."""
    groups = sig.reshape(*sig.shape[:-1], -1, ROWS)
    keys = np.arange(groups.shape[-2], dtype=np.uint64)
    for k in range(ROWS):
        keys = _mix((keys ^ groups[..., k]) * np.uint64(0x9E3779B97F4A7C15))
    return keys.view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    either = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64)) - both
    return both / either if either else 0.0


def _signer(idf: Broadcast):
    @F.arrow_udf(_SIGNED)
    def sign(texts: pa.Array) -> pa.Array:
        keys, words, signatures, usual = [], [], [], idf.value.max()
        for text in texts.to_pylist():
            features, weights = weigh(text, idf.value) if text else (np.empty(0, np.uint64), None)
            keys.append(None if text is None else xxhash.xxh3_128_digest(text.encode()))
            words.append(len(features) > 0)
            if len(features):
                signatures.append(samples(features, weights, usual))
        found = iter(bands_of(np.array(signatures)) if signatures else ())  # of all texts of the batch at once
        bands = [next(found) if held else None for held in words]
        return pa.StructArray.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(words, pa.bool_()), pa.array(bands, pa.list_(pa.int64()))],
            names=["key", "words", "bands"])

    return sign


def _occurrences(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle occurrences of a text and their weights: the k-th occurrence of a shingle is a feature
    of its own, so that the shared weight of two texts is the weight of their common features."""
    features, tf = shingles(text)
    weights = np.repeat(idf[_cells(features)].astype(np.float64), tf)
    ids = np.repeat(features, tf)
    nth = np.arange(len(ids)) - np.repeat(np.cumsum(tf) - tf, tf)
    again = nth > 0
    ids[again] = _mix(ids[again] ^ (nth[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return ids, weights


def similarities(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of a block of texts, by products of dense column blocks."""
    found = [_occurrences(t, idf) for t in texts]
    n = len(found)
    total = np.array([w.sum() for _, w in found])
    owner = np.repeat(np.arange(n), [len(x) for x, _ in found])
    _, column, held = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True, return_counts=True)
    weight = np.sqrt(np.concatenate([w for _, w in found]))
    kept = np.flatnonzero(held[column] > 1)  # a feature of one text adds to no pair
    kept = kept[np.argsort(column[kept], kind="stable")]
    place = (np.cumsum(held > 1) - 1)[column[kept]]
    both = np.zeros((n, n))
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        lo, hi = np.searchsorted(place, [at, at + COLUMNS])
        dense = np.zeros((n, int(place[hi - 1]) - at + 1))
        dense[owner[kept[lo:hi]], place[lo:hi] - at] = weight[kept[lo:hi]]
        both += dense @ dense.T
    return both / (total[:, None] + total[None, :] - both)


def _parts(linked: np.ndarray) -> np.ndarray:
    """Least index of each one's connected part, of a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(linked)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _verified(dealt: DataFrame, texts: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """Links (a, b) that connect, within each block (bucket, i, j) of ``dealt``, the texts joined by pairs
    that reach the similarity. All pairs of a block are verified; fewer links than texts are returned."""

    def compare(held: pd.DataFrame) -> pd.DataFrame:
        held = held.drop_duplicates("node").sort_values("node")
        nodes = held["node"].to_numpy()
        alike = similarities(held["text"].tolist(), idf.value) >= similarity - 1e-6
        np.fill_diagonal(alike, True)
        label = _parts(alike)
        joined = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": nodes[label[joined]], "b": nodes[joined]})

    return checkpointed(dealt.select("bucket", "i", "j", "node").join(texts, "node").groupBy("bucket", "i", "j")
                        .applyInPandas(compare, "a long, b long"))


def _blocks(count: Column, size: Column) -> Column:
    """Into how many blocks texts are dealt: by their number, and by their bytes."""
    return F.greatest(F.ceil(count / F.lit(BLOCK)), F.ceil(size / F.lit(BLOCK_BYTES)), F.lit(1)).cast("int")


def _dealt(parts: str) -> Column:
    return F.pmod(F.xxhash64("node", "bucket", F.lit(11)), F.col(parts)).cast("int")


def _links(members: DataFrame, texts: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """Verified links between nodes that share a bucket, enough to connect every class.

    ``members``: bucket, band (its number), node, size (bytes of its text). ``texts``: node, text.
    """
    # buckets of the same members (as of two copies that share many bands) count once
    shared = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes"), F.bit_xor(F.xxhash64("node")).alias("all"),
        F.min("node").alias("least"), F.min("band").alias("band")).where("n > 1").groupBy(
        "n", "bytes", "all", "least").agg(F.min(F.struct("band", "bucket")).alias("b"))
    live = checkpointed(members.join(shared.select(
        F.col("b.bucket").alias("bucket"), "n", _blocks(F.col("n"), F.col("bytes")).alias("parts")), "bucket"))
    # all texts move once; the rounds move only those that share a bucket
    texts = staged(texts.join(live.select("node").distinct(), "node", "left_semi"), "near-texts")
    links = members.sparkSession.createDataFrame([], "a long, b long")
    for early in (True, False):  # the first bands join most classes, whose later buckets then leave
        if early:
            now = live.where(F.col("band") < EARLY)
        else:
            now = live.where(F.col("band") >= EARLY)
            several = now.join(min_classes(links), "node", "left").withColumn(
                "label", F.coalesce("label", "node")).groupBy("bucket").agg(
                F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
            now = now.join(several.select("bucket"), "bucket", "left_semi")
        # every member is in one block of its bucket; some, drawn by hash, are leaders and in all blocks
        leader = (F.col("parts") > 1) & (F.pmod(F.xxhash64("node", F.lit(5)), F.col("n")) < LEADERS)
        blocks = F.when(leader, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(_dealt("parts")))
        dealt = now.select("bucket", "node", F.explode(blocks).alias("i"), F.lit(0).alias("j"))
        links = links.union(_verified(dealt, texts, idf, similarity))
    # a bucket of one block is settled; in the others, members outside the largest class meet all the rest
    open_ = live.where("parts > 1").join(min_classes(links), "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    buckets = open_.groupBy("bucket", "label").agg(F.count("*").alias("k"), F.sum("size").alias("bytes")).groupBy(
        "bucket").agg(F.sum("k").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("classes"),
                      F.max(F.struct("k", "bytes", "label")).alias("most")).where("classes > 1").select(
        "bucket", F.col("most.label").alias("largest"),
        _blocks(F.col("n") - F.col("most.k"), F.col("bytes") - F.col("most.bytes")).alias("outer"),
        _blocks(F.col("most.k"), F.col("most.bytes")).alias("inner"))
    held = checkpointed(open_.select("bucket", "node", "label", "size").join(buckets, "bucket"))
    if held.isEmpty():
        return links
    # blocks (i, j) with i < outer <= j: an outer and an inner one; i < j < outer: two outer ones
    mine = _dealt("outer")
    outside = held.where("label <> largest").select("bucket", "node", mine.alias("at"), F.explode(
        F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1)).alias("with")).where("at <> with").select(
        "bucket", "node", F.least("at", "with").alias("i"), F.greatest("at", "with").alias("j"))
    inside = held.where("label = largest").select(
        "bucket", "node", F.explode(F.sequence(F.lit(0), F.col("outer") - 1)).alias("i"),
        (_dealt("inner") + F.col("outer")).alias("j"))
    return links.union(_verified(outside.union(inside), texts, idf, similarity))


def classify(documents: DataFrame, similarity: float = SIMILARITY, idf_power: float = 0.25) -> DataFrame:
    """Per row of ``documents``: ``row`` (the whole input row), ``rid`` (its number), ``class_rid``
    (least row number of its class) and ``class_id`` (least doc_id of its class)."""
    spark = lean_batches(documents.sparkSession)
    texts = documents.select(F.col("text").cast("string").alias("text"))
    idf = spark.sparkContext.broadcast(idf_table(texts, idf_power))
    signed = staged(documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")).select(
        F.monotonically_increasing_id().alias("rid"), "row",
        _signer(idf)(F.col("row.text").cast("string")).alias("s")), "near-signed")
    rows = signed.select("rid", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("s.key").alias("key"))
    # a null text has no key: its row is a node by itself
    copies = rows.where("key is not null").groupBy("key").agg(
        F.min("rid").alias("node"), F.min("doc_id").alias("doc_id"))
    nodes = checkpointed(copies)
    members = signed.where("s.words").select(
        "rid", F.col("s.bands").alias("bands"), F.octet_length(F.col("row.text").cast("string")).cast("long").alias("size")).join(
        nodes.select(F.col("node").alias("rid")), "rid", "left_semi").select(
        F.col("rid").alias("node"), "size", F.posexplode("bands").alias("band", "bucket"))
    texts = signed.select(F.col("rid").alias("node"), F.col("row.text").cast("string").alias("text"))
    links = _links(members, texts, idf, similarity)
    labels = min_classes(links)
    of_node = nodes.join(labels, "node", "left").select(
        "key", F.coalesce("label", "node").alias("class_rid"), F.col("doc_id"))
    least = of_node.groupBy("class_rid").agg(F.min("doc_id").alias("class_id"))
    classes = of_node.select("key", "class_rid").join(least, "class_rid")
    named = rows.join(classes, "key", "left").select(
        "rid", F.coalesce("class_rid", "rid").alias("class_rid"),
        F.when(F.col("class_rid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    return signed.select("rid", "row").join(named, "rid")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, class_id (least doc_id of its class of near copies)."""
    return classify(table(spark, sf_dir, "documents")).select(F.col("row.doc_id").alias("doc_id"), "class_id")


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the first row of each class stays; all columns kept."""
    return classify(docs).where("rid = class_rid").select("row.*")
