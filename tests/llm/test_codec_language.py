"""BPE codec against the tokenizers library; language identification on labelled rows and edge cases."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from constella.llm import bpe, language
from tests.llm.cases import EDGE_TEXTS, documents

LIBRARY = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [t for t in EDGE_TEXTS if t is not None] + [
    "Hello  WORLD it's I'LL 123", "<|endoftext|>a<|startoftext|>b <|endoftext", "é ü 漢字 İ ẞ Σίσυφος Ὀδυσσεύς",
    "é ́x 가 ﬁ \x1c\x85\xa0 tab\tx", "👩‍👩‍👧 ''s 't've", "a" * 4000, "ab" * 3000 + "é" * 999,
])
def test_codec_equals_library(text):
    codec = bpe.codec()
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)
    assert codec.decode(ids) == LIBRARY.decode(library_ids(text), skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_codec_equals_library_on_any_text(text):
    assert np.frombuffer(bpe.codec().encode(text), "<u4").tolist() == library_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.permutations([(a, b) for a in range(4) for b in range(4)]))
def test_segment_tree_equals_repeated_scan(symbols, order):
    ranks = {pair: (rank, 4 + rank) for rank, pair in enumerate(order[:9])}
    ranks |= {(4, 4): (20, 40), (5, 1): (21, 41)}
    slow = list(symbols)
    while True:
        found = [(ranks[p][0], i) for i, p in enumerate(zip(slow, slow[1:], strict=False)) if p in ranks]
        if not found:
            break
        _, i = min(found)
        slow[i:i + 2] = [ranks[slow[i], slow[i + 1]][1]]
    assert bpe.merge_symbols(symbols, ranks) == slow


def test_codec_rows(spark):
    rows = bpe.encode_decode(documents(spark)).collect()
    assert len(rows) == len(EDGE_TEXTS)
    empty = [r for r in rows if r.n_tokens == 0]
    assert empty and all(bytes(r.ids) == b"" and r.decoded == "" for r in empty)
    assert bpe.encode_decode(documents(spark).limit(0)).count() == 0
    total = hashlib.sha256(b"".join(sorted(bytes(r.ids) for r in rows))).hexdigest()
    again = bpe.encode_decode(documents(spark).repartition(3)).collect()
    assert hashlib.sha256(b"".join(sorted(bytes(r.ids) for r in again))).hexdigest() == total


TRAIN = [(i, t, x) for i, (t, x) in enumerate([
    ("the cat and the dog went to the house", "en"), ("the weather is good and the sky is blue", "en"),
    ("der hund und die katze sind in dem haus", "de"), ("das wetter ist gut und der himmel ist blau", "de"),
    ("le chat et le chien sont dans la maison", "fr"), ("le temps est beau et le ciel est bleu", "fr"),
] * 3)]


def test_language_words_then_grams(spark):
    model = language.learn(spark.createDataFrame(TRAIN, "doc_id long, text string, lang string"))
    scorer = language.Scorer(model)
    assert scorer.predict("the dog and the cat")[0] == "en"
    assert scorer.predict("KATZE und Hund")[0] == "de"
    assert scorer.predict("maisons ciels")[0] == "fr"  # unseen words, by their n-grams
    known, unseen = scorer.word("house"), scorer.word("houses")
    assert known == model["tables"][0]["house"] and unseen != known
    assert scorer.predict("漢字")[0] == model["common"]
    for text in ("12 + 3", None, "", "½ ² ①", "Ⅷ", "½_1 …"):
        assert scorer.predict(text) == (language.UNKNOWN, 0.0)
    assert scorer.predict("½ the ①")[0] == "en" and scorer.predict("Ⅷ 漢")[0] == model["common"]
    score = scorer.predict("the dog und le chat")[1]
    assert 0 <= score <= 1


def test_language_word_score_is_brute_force_backoff(spark):
    model = language.learn(spark.createDataFrame(TRAIN, "doc_id long, text string, lang string"))
    place = {x: i for i, x in enumerate(model["languages"])}
    counts = {}
    for _, text, lang in TRAIN:
        for w in text.split():
            counts.setdefault(w, [0] * 3)[place[lang]] += 1
    sums = [sum(c[i] for c in counts.values()) + 0.5 * len(counts) + 1 for i in range(3)]
    for w, c in counts.items():
        assert np.allclose(model["tables"][0][w], np.log((np.array(c) + 0.5) / sums))


def test_language_predictions_are_brute_force(spark):
    """Whole predictions from plain counts: words first, else the longest known n-grams' mean."""
    labelled = spark.createDataFrame(TRAIN, "doc_id long, text string, lang string")
    scorer, languages = language.Scorer(language.learn(labelled)), ["de", "en", "fr"]
    tables = {size: {} for size in range(5)}
    for _, text, lang in TRAIN:
        for w in text.split():
            for size in range(5):
                padded = f" {w} "
                terms = [w] if size == 0 else [padded[i:i + size] for i in range(len(padded) - size + 1)]
                for t in terms:
                    if t != " ":
                        tables[size].setdefault(t, [0] * 3)[languages.index(lang)] += 1

    def odds(size, counts):
        sums = [sum(c[i] for c in tables[size].values()) + 0.5 * len(tables[size]) + 1 for i in range(3)]
        return np.log((np.array(counts) + 0.5) / sums)

    def word(w):
        if w in tables[0]:
            return odds(0, tables[0][w])
        for size in (4, 3, 2, 1):
            padded = f" {w} " if size > 1 else w
            grams = [padded[i:i + size] for i in range(len(padded) - size + 1)]
            found = [odds(size, tables[size][g]) for g in grams if g in tables[size]]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(3)

    for text in ("the houses of Katzen", "le chien bleuatre", "himmelblau ist gut 12", "sky skies CIEL", "zzz wetterhaus",
                 "blau bleu blue " * 30):
        words = [w for w in text.lower().split() if w.isalpha()]
        total = sum(word(w) for w in words)
        best = int(np.argmax(total))
        score = 1 / np.exp((total - total[best]) * min(len(words), 20) / len(words)).sum()
        got = scorer.predict(text)
        assert got[0] == languages[best] and abs(got[1] - score) < 1e-6


def test_language_edge_rows(spark):
    docs = documents(spark)
    model = language.learn(docs)
    assert language.identify(docs, model).count() == len(EDGE_TEXTS)
    nothing = language.learn(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {language.UNKNOWN}
    kept = language.stage_language(spark, docs, "")
    assert kept.columns == docs.columns
    assert kept.where("text is null").count() == 0


def test_stage_keeps_every_row_with_a_language(spark):
    train = [(3 * i, t, lang) for i in range(30) for t, lang in [(f"the cat and the dog {i}", "en")]] + [
        (3 * i, t, lang) for i in range(30, 60) for t, lang in [(f"der hund und die katze {i}", "de")]] + [
        (3 * i, t, lang) for i in range(60, 90) for t, lang in [(f"le chien et le chat {i}", "fr")]]
    short = [(1001, "漢字", None), (1002, "the der le", None), (1003, "123 ...", None), (1004, None, None)]
    docs = spark.createDataFrame(train + short, "doc_id long, text string, lang string")
    scorer = language.Scorer(language.learn(language.training_rows(docs)))
    predicted = {i: scorer.predict(t) for i, t, _ in train + short}
    assert any(lang != language.UNKNOWN and score < 0.5 for lang, score in predicted.values())
    kept = {r.doc_id for r in language.stage_language(spark, docs, "").collect()}
    assert kept == {i for i, (lang, _) in predicted.items() if lang != language.UNKNOWN}
    assert {1001, 1002} <= kept and not {1003, 1004} & kept
