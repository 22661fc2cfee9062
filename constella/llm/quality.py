"""Operator 2: quality classifier, a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded and run through filters of six bytes at every byte. The
whole document is covered by overlapping chunks of 256 bytes, one every 128 bytes. Each filter is
max-pooled over a chunk; a dense layer reads the pooled filters of a chunk; its units are max-pooled
over all chunks of the document, and a logistic unit combines them into one probability.

Learning: a hashed sample of about ``sample_rows`` labelled documents, half of each label where there
are enough, with their whole texts (the least one of a repeated id), is fitted by Adam on the driver. The gradient passes through both max-pools, so it touches only the winning windows.
Scoring runs over every row, in blocks of fixed size whatever a text's length.

Row cases: a null text counts as empty; an empty text is one chunk of padding and gets the network's
score for it. Without labels of both kinds all scores are the share of label 1 (0.5 if there is no
label). Repeated label rows count once (the least label of an id). An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.llm.common import fold, hashed_sample, lean_batches, table, text_batches

HALF = 128  # bytes; a chunk is two halves
WIDTH = 6
EMBED, FILTERS, HIDDEN = 6, 32, 16
BLOCK_HALVES = 2048


def pad(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each followed by zeros up to a multiple of HALF, and its number of halves."""
    raw = [(t or "").encode() for t in texts]
    halves = np.array([(len(b) + WIDTH) // HALF + 1 for b in raw])
    return np.frombuffer(b"".join(b.ljust(n * HALF, b"\0") for b, n in zip(raw, halves, strict=True)), np.uint8), halves


def init(seed: int = 2) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {"embed": normal(256, EMBED, scale=1.0), "filters": normal(WIDTH * EMBED, FILTERS, scale=0.15),
            "filter_bias": np.zeros(FILTERS, np.float32), "dense": normal(FILTERS, HIDDEN, scale=0.2),
            "dense_bias": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN, scale=0.2),
            "out_bias": np.zeros(1, np.float32)}


def _windows(m: dict, data: np.ndarray) -> np.ndarray:
    """Filter values of every window of ``data``, one product for each phase of window starts: windows
    that start WIDTH bytes apart lie side by side in the embedded bytes."""
    n = len(data) - WIDTH + 1
    flat = m["embed"][data].reshape(-1)
    out = np.empty((n, FILTERS), flat.dtype)
    for phase in range(min(WIDTH, n)):
        rows = -(-(n - phase) // WIDTH)
        out[phase::WIDTH] = flat[phase * EMBED:(phase + rows * WIDTH) * EMBED].reshape(rows, -1) @ m["filters"]
    return out


#: A text's last windows, which would reach into the next text; they start in its padding.
BEYOND = WIDTH - 1


def pooled_halves(m: dict, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Filters max-pooled over each half chunk; windows that reach into the next text do not count."""
    out, last = [], np.cumsum(counts) - 1
    for at in range(0, len(data), BLOCK_HALVES * HALF):
        block = data[at:at + BLOCK_HALVES * HALF]
        tail = data[at + len(block):at + len(block) + BEYOND]
        values = _windows(m, np.concatenate([block, tail, np.zeros(BEYOND - len(tail), np.uint8)]))
        values = values.reshape(-1, HALF, FILTERS)
        here = last[(last >= at // HALF) & (last < at // HALF + len(values))] - at // HALF
        values[here, -BEYOND:] = -np.inf
        out.append(values.max(axis=1))
    return np.concatenate(out)


def _chunks(halves: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk values, each chunk's first half, and the documents' first chunks. A document of n halves
    has n - 1 chunks (one, if it has a single half)."""
    ends = np.cumsum(counts)
    last = np.zeros(len(halves), bool)
    last[ends - 1] = True
    single = np.repeat(counts == 1, counts)
    first = np.flatnonzero(~last | single)
    second = np.where(single[first], first, np.minimum(first + 1, len(halves) - 1))
    per_doc = np.maximum(counts - 1, 1)
    return np.maximum(halves[first], halves[second]), first, np.concatenate([[0], np.cumsum(per_doc)[:-1]])


def forward(m: dict, texts: list[str | None]) -> dict:
    data, counts = pad(texts)
    halves = pooled_halves(m, data, counts)
    chunks, first, starts = _chunks(halves, counts)
    pooled = np.maximum(chunks + m["filter_bias"], 0)
    units = np.maximum(pooled @ m["dense"] + m["dense_bias"], 0)
    best = np.maximum.reduceat(units, starts, axis=0)
    logit = best @ m["out"] + m["out_bias"][0]
    return {"data": data, "counts": counts, "chunks": chunks, "first": first, "starts": starts, "pooled": pooled,
            "units": units, "best": best, "p": 1 / (1 + np.exp(-np.clip(logit, -30, 30)))}


def gradients(m: dict, f: dict, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted log loss, through the winners of both max-pools."""
    d = ((f["p"] - labels) * weights / weights.sum()).astype(np.float32)
    g = {"out": f["best"].T @ d, "out_bias": np.array([d.sum()], np.float32)}
    docs, units = np.nonzero(f["best"] > 0)
    ends = np.append(f["starts"][1:], len(f["units"]))
    winner = np.array([f["starts"][i] + np.argmax(f["units"][f["starts"][i]:ends[i], u])
                       for i, u in zip(docs, units, strict=True)], np.int64)
    back = d[docs] * m["out"][units]
    used, place = np.unique(winner, return_inverse=True)
    at_unit = np.zeros((len(used), HIDDEN), np.float32)
    np.add.at(at_unit, (place, units), back)
    g["dense"] = f["pooled"][used].T @ at_unit
    g["dense_bias"] = at_unit.sum(axis=0)
    at_filter = (at_unit @ m["dense"].T) * (f["pooled"][used] > 0)
    g["filter_bias"] = at_filter.sum(axis=0)
    # the winning window of each filter in the chunks used
    behind = np.concatenate([f["data"], np.zeros(2 * HALF + WIDTH, np.uint8)])
    starts = f["first"][used] * HALF
    chunk_of_doc = np.repeat(f["counts"], np.maximum(f["counts"] - 1, 1))[used]
    windows = behind[starts[:, None] + np.arange(2 * HALF + BEYOND)]
    values = np.stack([_windows(m, w) for w in windows]) if len(used) else np.zeros((0, HALF, FILTERS), np.float32)
    if len(used):
        values[chunk_of_doc == 1, HALF - BEYOND:] = -np.inf
        final = np.zeros(len(f["units"]), bool)
        final[ends - 1] = True
        values[final[used], -BEYOND:] = -np.inf
    best = values.argmax(axis=1) if len(used) else np.zeros((0, FILTERS), np.int64)
    rows, columns = np.nonzero(at_filter)
    position = starts[rows] + best[rows, columns]
    seen = behind[position[:, None] + np.arange(WIDTH)]
    amount = at_filter[rows, columns]
    g["filters"] = np.zeros_like(m["filters"])
    np.add.at(g["filters"].T, columns, m["embed"][seen].reshape(len(seen), -1) * amount[:, None])
    g["embed"] = np.zeros_like(m["embed"])
    np.add.at(g["embed"], seen.ravel(), (m["filters"].T[columns] * amount[:, None]).reshape(-1, EMBED))
    return g


def fit(texts: list[str], labels: np.ndarray, epochs: int = 14, batch: int = 32, rate: float = 0.01,
        seed: int = 2) -> dict[str, np.ndarray]:
    """Adam over shuffled batches; both labels weigh alike."""
    m = init(seed)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        m["out"][:] = 0
        m["out_bias"][0] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
        return m
    rng = np.random.default_rng(seed)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    mean = {k: np.zeros_like(v) for k, v in m.items()}
    square = {k: np.zeros_like(v) for k, v in m.items()}
    step, steps = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            f = forward(m, [texts[i] for i in pick])
            g = gradients(m, f, labels[pick], weight[pick])
            step += 1
            now = rate * (1 - step / (steps + 1))
            for k in m:
                mean[k] += 0.1 * (g[k] - mean[k])
                square[k] += 0.01 * (g[k] ** 2 - square[k])
                m[k] -= now * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-7)
    return m


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int,
                    balanced: bool) -> tuple[list[str], np.ndarray]:
    """Texts and labels of a hashed sample of about ``rows`` labelled ids: one whole text for each id."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    parts = [hashed_sample(known.where(F.col("y") == y), F.col("doc_id"), rows // 2 if balanced else
                           max(1, rows * n // sum(counts.values())), n) for y, n in sorted(counts.items())]
    if not parts:
        return [], np.zeros(0)
    chosen = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    found = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    found.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in found], np.array([r["y"] for r in found], float)


def learn(documents: DataFrame, labels: DataFrame, sample_rows: int = 1600) -> dict:
    texts, y = labelled_sample(documents, labels, "quality", sample_rows, balanced=True)
    return fit(texts, y)


def score(documents: DataFrame, model: dict) -> DataFrame:
    """Per row: doc_id, score."""
    shared = lean_batches(documents.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, 1, 64):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(forward(shared.value, texts)["p"], pa.float64())],
                names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = lambda df: df.where(fold(F.col("doc_id"), 3) != 1)
    model = learn(learnt(documents), learnt(table(spark, sf_dir, "labels")))
    return score(documents, model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
