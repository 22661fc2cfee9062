"""Operator 3: language identification by word-first backoff.

A known word adds its log frequency in each language. An unseen word backs off to its character
n-grams (with word boundaries), from the longest to the shortest length, and takes the first length
at which any of its n-grams is known. The language with the highest sum wins.

Learning: word and n-gram counts are Spark aggregates over a bounded hashed sample of labelled rows
(``sample_rows`` per language), and only the ``model_words`` and ``model_grams`` most frequent
entries per language are kept, so the broadcast model is bounded; a word that is not kept is unseen
and backs off. Prediction covers every row and whole texts, in pieces of 50,000 words.

Row cases: null or empty text, or one without a letter (numerals such as ``½`` or ``Ⅷ`` are none): ``und``
with score 0. An empty table gives an empty result. Text whose letters are all
unknown to the model: the learned language with most rows, score 1/languages. Null language labels
teach nothing. Nothing learned (no labelled row): ``und``, score 0. Ties go to the first language
by name. Repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from constella.llm.common import checkpointed, fold, hashed_sample, lean_batches, table, text_batches

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
MEMO_WORDS = 150_000


def _grams(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def learn(labelled: DataFrame, sample_rows: int = 1500, model_words: int = 40_000, model_grams: int = 8_000,
          longest: int = 4) -> dict:
    """Model from rows ``(doc_id, text, lang)``: languages and log frequency tables per n (0: words)."""
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return {"languages": [], "tables": {}, "common": UNKNOWN}
    parts = [hashed_sample(rows.where(F.col("lang") == x), F.col("doc_id"), sample_rows, sizes[x]) for x in languages]
    sample = parts[0]
    for part in parts[1:]:
        sample = sample.union(part)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[str, str], int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in totals], pa.string()), pa.array([k[1] for k in totals], pa.string()),
                 pa.array(list(totals.values()), pa.int64())], names=["lang", "word", "n"])

        for part, texts in text_batches(batches, 0):
            for text, lang in zip(texts, part.column(1).to_pylist(), strict=True):
                for word in _LETTERS.findall(text.lower()):
                    totals[lang, word] = totals.get((lang, word), 0) + 1
            if len(totals) > 200_000:
                yield out()
                totals.clear()
        yield out()

    words = sample.select("text", "lang").mapInArrow(count, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n"))
    # the same length in both terms of the union: 0 for whole words, else n-grams of the padded word
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    grams = words.select("lang", "n", F.explode(F.array(*[F.lit(k) for k in range(1, longest + 1)])).alias("size"),
                         padded.alias("p")).where(F.length("p") >= F.col("size"))
    grams = grams.select("lang", "n", "size", F.explode(F.sequence(F.lit(1), F.length("p") - F.col("size") + 1))
                         .alias("at"), "p").select("lang", "size", F.substring("p", F.col("at"), F.col("size"))
                                                  .alias("term"), "n").where("term <> ' '")
    counts = words.select("lang", F.lit(0).alias("size"), F.col("word").alias("term"), "n").union(
        grams.groupBy("lang", "size", "term").agg(F.sum("n").alias("n")))
    counts = checkpointed(counts)
    totals = {(r["lang"], r["size"]): r["s"]
              for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("s")).collect()}
    order = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "term")
    kept = counts.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= F.when(F.col("size") == 0, model_words).otherwise(model_grams)).drop("place").collect()
    place = {x: i for i, x in enumerate(languages)}
    raw: dict[int, dict[str, list[int]]] = {}
    for r in kept:
        raw.setdefault(r["size"], {}).setdefault(r["term"], [0] * len(languages))[place[r["lang"]]] = r["n"]
    tables = {}
    for size, entries in raw.items():
        sums = [math.log(totals.get((x, size), 0) + 0.5 * len(entries) + 1.0) for x in languages]
        tables[size] = {t: tuple(math.log(n + 0.5) - z for n, z in zip(row, sums, strict=True))
                        for t, row in entries.items()}
    common = max(languages, key=lambda x: (sizes[x], [-ord(c) for c in x]))
    return {"languages": languages, "tables": tables, "common": common}


class Scorer:
    """Scores of texts under one model; remembers words (a memo only)."""

    def __init__(self, model: dict) -> None:
        self.model = model
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(model["languages"])))

    def word(self, word: str) -> tuple[float, ...]:
        """Log frequencies of a known word, else the mean over its longest known n-grams."""
        tables = self.model["tables"]
        row = tables.get(0, {}).get(word)
        if row is not None:
            return row
        for size in range(max(tables, default=0), 0, -1):
            get = tables.get(size, {}).get
            found = [row for g in _grams(word, size) if (row := get(g)) is not None]
            if found:
                return tuple(sum(column) / len(found) for column in zip(*found, strict=True))
        return (0.0,) * len(self.model["languages"])

    def _place(self, word: str) -> int:
        if len(self.known) >= MEMO_WORDS:
            self.known.clear()
        at = len(self.known)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = self.word(word)
        self.known[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _LETTERS.findall(text.lower()) if text else []
        languages = self.model["languages"]
        # a run of word characters may hold nothing but numerals that are no decimal digits
        if not languages or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        total = np.zeros(len(languages))
        known = self.known
        for at in range(0, len(words), 50_000):  # pieces: the memo may be emptied between two of them
            piece = words[at:at + 50_000]
            if len(known) + len(piece) >= MEMO_WORDS:
                known.clear()
            get = known.get
            places = [i if (i := get(w)) is not None else self._place(w) for w in piece]
            total += self.rows[places].sum(axis=0)
        if not total.any():
            return self.model["common"], 1.0 / len(languages)
        best = int(np.argmax(total))
        # a long text is not surer than some dozens of its words: the sum is scaled to at most 20 words
        margin = (total - total[best]) * (min(len(words), 20) / len(words))
        return languages[best], 1.0 / float(sum(math.exp(max(x, -700.0)) for x in margin))


_SCORERS: dict[int, Scorer] = {}


def worker_scorer(shared: Broadcast) -> Scorer:
    """The scorer of a broadcast model, kept between the tasks of a Python worker."""
    key = id(shared.value)
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(shared.value)
    return _SCORERS[key]


def identify(documents: DataFrame, model: dict) -> DataFrame:
    """Per row: doc_id, lang_pred, score."""
    shared = lean_batches(documents.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_scorer(shared)
        for part, texts in text_batches(batches, 1):
            found = [scorer.predict(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([x for x, _ in found], pa.string()),
                 pa.array([x for _, x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def training_rows(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text", "lang").where(fold(F.col("doc_id"), 3) != 1)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = identify(documents, learn(training_rows(documents)))
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose language is found stay, whatever its score; all columns kept.

    Rejected, as ``und`` in op3: no letter, or null text.
    """
    model = learn(training_rows(docs))
    shared = lean_batches(spark).sparkContext.broadcast(model)
    columns = docs.columns
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_scorer(shared)
        for part, texts in text_batches(batches, at):
            keep = [scorer.predict(t)[0] != UNKNOWN for t in texts]
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
