"""Operator 5: toxicity by multiple-instance learning over sentences.

A document is a bag of sentences (cut at ``.``, ``!``, ``?`` and line breaks). A sentence's log odds
are a bias plus the weights of its words; a word weighs as the sum of its features: the word itself
and its first three, four and five letters. Sentence probabilities are combined by noisy-or:
``1 - prod(1 - p)``. Only documents carry labels; the gradient of the noisy-or tells which sentences
to blame. Weights are kept sparse by an L1 penalty (proximal Adam steps).

Learning: a hashed sample of about ``sample_rows`` labelled documents that keeps the labels' shares,
with their whole texts (the least one of a repeated id), on the driver; features of fewer than
``least_documents`` sampled documents get no weight. Scoring covers every row and whole texts, a
sentence at a time. ``locate`` names the offending sentences.

Row cases: null or wordless texts are one empty sentence (the bias alone). An empty table gives an empty
result. Without labels of both
kinds all scores are the share of label 1 (0.5 if there is no label). Repeated label rows count once
(the least label of an id). Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.llm.common import fold, lean_batches, table, text_batches
from constella.llm.quality import labelled_sample

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORDS = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5)
MEMO_WORDS = 150_000


def features(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]


def bags(text: str) -> list[Counter]:
    """Feature counts of each sentence; one empty bag if there is none."""
    out = []
    for sentence in _SENTENCE.findall(text.lower()):
        words = _WORDS.findall(sentence)
        if words:
            out.append(Counter(f for w in words for f in features(w)))
    return out or [Counter()]


def fit(texts: list[str], labels: np.ndarray, epochs: int = 150, rate: float = 0.1, penalty: float = 4e-5,
        least_documents: int = 3) -> dict:
    """Weights by feature and the bias."""
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return {"bias": math.log(max(share, 1e-3) / max(1 - share, 1e-3)), "weights": {}}
    held: Counter = Counter()
    for t in texts:
        held.update({f for w in set(_WORDS.findall(t.lower())) for f in features(w)})
    place = {f: i for i, f in enumerate(sorted(f for f, n in held.items() if n >= least_documents))}
    index, amount, sizes, per_doc = [], [], [], []
    for t in texts:
        sentences = bags(t)
        per_doc.append(len(sentences))
        for bag in sentences:
            known = [(place[f], n) for f, n in bag.items() if f in place]
            sizes.append(len(known))
            index += [i for i, _ in known]
            amount += [n for _, n in known]
    index_, amount_ = np.array(index, np.int32), np.array(amount, np.float32)
    sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    starts = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
    doc = np.repeat(np.arange(len(texts)), per_doc)
    w, bias = np.zeros(len(place)), -5.0
    mean, square, mean_b, square_b = np.zeros(len(place)), np.zeros(len(place)), 0.0, 0.0
    for step in range(1, epochs + 1):
        logit = bias + np.bincount(sentence, w[index_] * amount_, len(sizes))
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        none = np.exp(-np.add.reduceat(np.logaddexp(0, np.clip(logit, -30, 30)), starts))  # no sentence is toxic
        blame = np.where(labels == 1, -none / np.maximum(1 - none, 1e-6), 1.0)
        d = p * blame[doc] / len(texts)
        g, g_b = np.bincount(index_, d[sentence] * amount_, len(place)), d.sum()
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        mean_b, square_b = 0.9 * mean_b + 0.1 * g_b, 0.99 * square_b + 0.01 * g_b * g_b
        now = rate * min(1.0, 2 * (1 - step / (epochs + 1)))
        scale = np.sqrt(square / (1 - 0.99 ** step)) + 1e-6
        w -= now * mean / (1 - 0.9 ** step) / scale
        w = np.sign(w) * np.maximum(np.abs(w) - now * penalty / scale, 0)
        bias -= now * mean_b / (1 - 0.9 ** step) / (math.sqrt(square_b / (1 - 0.99 ** step)) + 1e-6)
    return {"bias": float(bias), "weights": {f: float(w[i]) for f, i in place.items() if w[i]}}


class _WordWeights(dict):
    """Weight of a word, worked out on first use (a memo only)."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        get = self.weights.get
        value = sum(get(f, 0.0) for f in features(word))
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value
        return value


def sentence_scores(text: str | None, bias: float, weights: _WordWeights) -> list[tuple[int, int, float]]:
    """(start, end, log odds) of each sentence with a word."""
    out, words, get = [], _WORDS.findall, weights.__getitem__
    for m in _SENTENCE.finditer(text or ""):
        found = words(m.group().lower())
        if found:
            out.append((m.start(), m.end(), bias + sum(map(get, found))))
    return out


def noisy_or(log_odds: list[float]) -> float:
    return -math.expm1(-sum(max(x, 0.0) + math.log1p(math.exp(-abs(x))) for x in log_odds))


_worker: dict[int, tuple[dict, _WordWeights]] = {}  # with the model, so that its id stays its own


def _weights(shared: Broadcast) -> _WordWeights:
    key = id(shared.value)
    if key not in _worker:
        _worker.clear()
        _worker[key] = (shared.value, _WordWeights(shared.value["weights"]))
    return _worker[key][1]


def locate(documents: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """Per row: doc_id, score, and the spans (code points) of sentences whose own score is ``least``."""
    shared = lean_batches(documents.sparkSession).sparkContext.broadcast(model)
    limit = math.log(least / (1 - least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = _weights(shared), shared.value["bias"]
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        for part, texts in text_batches(batches, 1):
            scores, spans = [], []
            for text in texts:
                sentences = sentence_scores(text, bias, weights)
                scores.append(noisy_or([x for _, _, x in sentences] or [bias]))
                spans.append([{"start": a, "end": b} for a, b, x in sentences if x >= limit])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))],
                names=["doc_id", "score", "offending"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double, offending array<struct<start:int,end:int>>")


def learn(documents: DataFrame, labels: DataFrame, sample_rows: int = 5000) -> dict:
    return fit(*labelled_sample(documents, labels, "toxic", sample_rows, balanced=False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = lambda df: df.where(fold(F.col("doc_id"), 5) != 0)
    model = learn(learnt(documents), learnt(table(spark, sf_dir, "labels")))
    return locate(documents, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").alias("n_offending"),
        F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast(
            "string"))), ",").alias("offending"))
