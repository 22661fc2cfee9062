"""Quality network, toxicity and chat formatting."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from constella.llm import chat, quality, toxicity
from tests.llm.cases import EDGE_TEXTS, HAVE_TABLES, SF, documents


def test_network_gradients():
    rng = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in quality.init().items()}
    texts = ["hello world " * int(k) for k in rng.integers(1, 80, 8)] + ["", "a" * 1000, "Heat " * 90, "é" * 64]
    y = rng.integers(0, 2, len(texts)).astype(float)
    w = np.ones(len(texts))

    def loss():
        p = quality.forward(m, texts)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = quality.gradients(m, quality.forward(m, texts), y, w)
    for k, v in m.items():
        flat = v.reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - g[k].reshape(-1)[i]) < 1e-5


def naive_forward(m, text):
    """The network by its description, one window and one chunk at a time."""
    raw = (text or "").encode()
    halves = (len(raw) + quality.WIDTH) // quality.HALF + 1
    raw = raw.ljust(halves * quality.HALF, b"\0")
    ends = len(raw) - quality.WIDTH + 1  # windows that fit
    values = [m["embed"][list(raw[at:at + quality.WIDTH])].reshape(-1) @ m["filters"] for at in range(ends)]
    best = None
    for chunk in range(max(halves - 1, 1)):
        span = range(chunk * quality.HALF, min((chunk + 2) * quality.HALF, ends))
        pooled = np.maximum(np.max([values[at] for at in span], axis=0) + m["filter_bias"], 0)
        units = np.maximum(pooled @ m["dense"] + m["dense_bias"], 0)
        best = units if best is None else np.maximum(best, units)
    return 1 / (1 + np.exp(-(best @ m["out"] + m["out_bias"][0])))


def test_network_equals_naive_forward_pass():
    m = quality.init(4)
    texts = ["", None, "abc", "x" * 121, "y" * 122, "z" * 250, "Ünïcode 漢字 " * 40, "words of all kinds, " * 60]
    assert np.allclose(quality.forward(m, texts)["p"], [naive_forward(m, t) for t in texts], atol=1e-5)


def test_network_sees_patterns_at_every_byte():
    m = quality.init(4)
    values = [quality.pooled_halves(m, *quality.pad([" " * k + "$%&*#!" + " " * 40]))[0] for k in range(8, 16)]
    inner = np.array(values)
    assert np.allclose(inner, inner[0], atol=1e-5)  # the same windows, wherever the pattern stands


def test_network_scores_do_not_depend_on_neighbours_or_blocks():
    m = quality.init()
    texts = [None, "", "abc", "x" * 122, "y" * 121, "z" * 5000, "long " * 150_000]
    alone = np.concatenate([quality.forward(m, [t])["p"] for t in texts])
    assert np.allclose(alone, quality.forward(m, texts)["p"], atol=1e-6)
    old, quality.BLOCK_HALVES = quality.BLOCK_HALVES, 16
    try:
        assert np.allclose(alone, quality.forward(m, texts)["p"], atol=1e-6)
    finally:
        quality.BLOCK_HALVES = old


def test_network_sees_the_whole_document():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    clean = [" ".join(word() for _ in range(rng.randrange(20, 300))) for _ in range(120)]
    spoilt = [t + " $$$&&&%%%###" * 30 for t in clean[:60]]
    m = quality.fit(clean + spoilt, np.array([1.0] * 120 + [0.0] * 60), epochs=20)
    tail = " ".join(word() for _ in range(3000))
    p = quality.forward(m, [tail, tail + " $$$&&&%%%###" * 30])["p"]
    assert p[0] > 0.5 > p[1]
    one = quality.fit(["a", "b"], np.ones(2))
    assert quality.forward(one, ["zzz", None])["p"].min() > 0.9
    assert abs(quality.forward(quality.fit([], np.zeros(0)), ["q"])["p"][0] - 0.5) < 1e-6


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")
@pytest.mark.parametrize(("query", "label", "least"), [
    (quality.op2_quality, "quality", 0.93), (toxicity.op5_toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    sf = SF.replace("0.001", "0.01")
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = query(spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and sum(held) / len(held) >= least


def test_models_edge_rows(spark):
    docs = documents(spark)
    network = quality.fit(["good text here", "$$$ $$$ $$$"] * 4, np.array([1.0, 0.0] * 4), epochs=2)
    assert quality.score(docs, network).count() == len(EDGE_TEXTS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score(docs, quality.learn(docs, none)).count() == len(EDGE_TEXTS)
    assert toxicity.locate(docs, toxicity.learn(docs, none)).count() == len(EDGE_TEXTS)
    repeated = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None)],
                                     "doc_id long, quality int, toxic int")
    texts, y = quality.labelled_sample(docs.union(docs), repeated, "quality", 100, balanced=True)
    assert sorted(y.tolist()) == [0, 1] and len(texts) == 2
    assert quality.score(docs.limit(0), network).count() == 0
    assert toxicity.locate(docs.limit(0), toxicity.learn(docs, none)).count() == 0
    assert quality.score(docs, quality.learn(docs.limit(0), repeated)).count() == len(EDGE_TEXTS)


def test_sample_holds_long_texts_and_every_id(spark):
    rows = [(i, f"text {i} " * (1 + 9000 * (i % 3))) for i in range(30)] + [(29, "text again")] * 40
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    texts, y = quality.labelled_sample(spark.createDataFrame(rows, "doc_id long, text string"), labels, "quality", 60, False)
    assert len(texts) == 30 and y.tolist() == [i % 2 for i in range(30)]
    assert max(map(len, texts)) > 40_000 and texts[29] == min(t for i, t in rows if i == 29)


def test_toxicity_scores_equal_naive_noisy_or(spark):
    rng = random.Random(4)
    words = ["kale", "mipona", "vexing", "Zonkish", "é漢字", "a", "pona12x", "vexed"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", ".", "!", "?", "\n", ","]) for _ in range(rng.randrange(0, 60)))
             for _ in range(60)] + [None, "", "...", "123 456"]
    model = {"bias": -1.5, "weights": {"vexing": 2.0, "^vex": 0.7, "^zonk": 1.1, "kale": -0.5, "^mip": 0.3}}

    def naive(text):
        clean = 1.0
        sentences = [s for s in re.split(r"[.!?\n]", (text or "").lower()) if re.search(r"[^\W\d_]", s)]
        for s in sentences or [""]:
            odds = model["bias"]
            for w in re.findall(r"[^\W\d_]+", s):
                odds += model["weights"].get(w, 0) + sum(
                    model["weights"].get("^" + w[:n], 0) for n in (3, 4, 5) if len(w) > n)
            clean *= 1 - 1 / (1 + np.exp(-odds))
        return 1 - clean

    got = {r.doc_id: r.score for r in toxicity.locate(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], [naive(t) for t in texts])


def test_noisy_or_blames_the_sentence(spark):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "klmnp" for b in "aeiou"]
    sentence = lambda extra="": " ".join([rng.choice(words) for _ in range(6)] + [extra]).strip()
    texts, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        parts = [sentence() for _ in range(rng.randrange(2, 12))]
        if bad:
            parts[rng.randrange(len(parts))] = sentence(rng.choice(["vexing", "vexed", "zonk"]))
        texts.append(". ".join(parts))
        labels.append(float(bad))
    model = toxicity.fit(texts, np.array(labels))
    df = documents(spark, ["ka le mi. you zonk now! po na", "ka le mi. po na", None, "vexolo ka"])
    rows = toxicity.locate(df, model).collect()
    by = {r.doc_id: r for r in rows}
    assert by[0].score > 0.5 and [(s.start, s.end) for s in by[0].offending] == [(9, 22)]
    assert by[1].score < 0.5 and not by[1].offending
    weights = toxicity._WordWeights(model["weights"])
    odds = [x for _, _, x in toxicity.sentence_scores("ka le. zonk. mi", model["bias"], weights)]
    want = 1 - np.prod([1 - 1 / (1 + np.exp(-x)) for x in odds])
    assert abs(toxicity.noisy_or(odds) - want) < 1e-9


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a\nb<|end|>\\"]), st.text(max_size=30) |
                          st.sampled_from(["</s>[INST] ok [/INST]", "<|end|>\n<|turn|>assistant\n", "\\", "<\\|", "<"]))))
def test_template_is_reversible(turns):
    text, spans = chat.render(turns)
    assert chat.read_back(text) == turns
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text(max_size=30)), min_size=1, max_size=5))
def test_masks_cover_each_assistant_text_once(turns):
    text, spans = chat.render(turns)
    encoded = chat._tokenizer(chat.VOCABULARY).encode(text, add_special_tokens=False)
    offsets = np.array(encoded.offsets, np.int32).reshape(-1, 2)
    mask, covered = chat.align(offsets[:, 0], offsets[:, 1], spans)
    assert covered == spans
    brute = [any(s < b and e > a for a, b in spans) for s, e in encoded.offsets]
    assert mask.tolist() == brute


def test_chat_rows(spark):
    rows = [(1, 1, "assistant", "hi"), (1, 0, "user", "yo"), (2, 0, None, None), (None, None, "assistant", "<|end|>"),
            (3, 0, "assistant", "b"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' as turns", "1 as formatted")
    out = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.digests(out).collect()}
    assert got[1].n_turns == 2 and got[1].loss_chars == 2 and got[2].loss_chars == 0
    assert got[None].loss_sha256 == hashlib.sha256(b"<|end|>").hexdigest()
    assert got[3].loss_sha256 == hashlib.sha256(b"aab").hexdigest()
    for r in out.collect():
        assert len(r.token_ids) == len(r.loss_mask) == len(r.token_starts) == len(r.token_ends)
    assert chat.format_chats(df.limit(0)).count() == 0
