"""Operator 7: benchmark decontamination by a prefix-filtered join.

Words are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters. A benchmark window is 13
consecutive words of an item; an item of fewer words, but not none, is one window.

Each window is a sequence of three-word shingles (of one or two words if it has no more). Containment
is exact, so one shingle is a necessary prefix: the rarest, by the number of documents that hold it,
counted over all documents. A document's shingles are looked up among these keys only. A match at
word ``p`` of a shingle that stands at offset ``o`` of a window of ``L`` words is tested only if the
window fits (``0 <= p - o`` and ``p - o + L <= n_words``), and then word by word.

Spark derives the index: distinct windows, their shingles, the documents' counts of these shingles (one
pass over the documents, which emits only shingles that pass a bit table of the benchmark's; the table has
at most ``MOST_BITS`` bits, and what passes wrongly falls out of the join) and each window's rarest one.
The finished index is broadcast in blocks of at most ``BLOCK_BYTES`` measured bytes (one window at least), so
the driver holds one block at a time. Documents are read once more per block and never shuffled. Between
blocks the partial results are written to the shared folder.

Row cases: null or wordless texts have no words and no hits. Null benchmark texts and items without
words have no windows. Items with a null id hit as any other and count as one item. Repeated rows of
documents give repeated rows; repeated items count once per id. Whole texts are searched, however long; a
long item gives its windows in pieces. An empty benchmark hits nothing; an empty table of documents gives
an empty result. Extra columns of any name pass through in one struct.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType
from pyspark.sql.types import _parse_datatype_string as _parse

from constella.llm.common import lean_batches, staged, table, text_batches, word_hashes

WINDOW = 13
SHINGLE = 3
BLOCK_BYTES = 32 << 20
PIECE_WORDS = 20_000
MOST_BITS = 1 << 25
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<long>"


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text in UTF-8; ``bytes.lower`` changes A-Z only."""
    return _WORDS.findall(text.encode().lower()) if text else []


def _shingles(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on."""
    n = len(ids) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ ids[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def _window_shingles(window: list[bytes]) -> np.ndarray:
    return _shingles(word_hashes(window), min(SHINGLE, len(window)))


def _at(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Positions of ``values`` that are among ``sorted_keys``."""
    if not len(sorted_keys) or not len(values):
        return np.empty(0, np.int64)
    # a bit table of the keys' low 16 bits turns nearly all values away before the binary search
    table_ = np.zeros(1 << 16, bool)
    table_[(sorted_keys & np.uint64(0xFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(table_[(values & np.uint64(0xFFFF)).astype(np.int64)])
    place = np.searchsorted(sorted_keys, values[maybe])
    place[place == len(sorted_keys)] = 0
    return maybe[sorted_keys[place] == values[maybe]]


def _in_order(ids: set[int | None]) -> list[int | None]:
    """Ids in order, a null last."""
    return sorted(ids - {None}) + [None] * (None in ids)


def windows_of(items: list[tuple[int | None, str | None]]) -> dict[bytes, set[int | None]]:
    """Distinct windows of the items (words joined by a space), with the ids of the items that hold them."""
    found: dict[bytes, set[int | None]] = defaultdict(set)
    for item, text in items:
        for window in _windows(words_of(text)):
            found[window].add(item)
    return found


def _windows(words: list[bytes]) -> list[bytes]:
    return [b" ".join(words[at:at + WINDOW]) for at in range(max(1, len(words) - WINDOW + 1))] if words else []


def _pieces(words: list[bytes], most: int) -> Iterator[list[bytes]]:
    """The words in pieces of at most ``most`` (one window at least) that hold each window once."""
    step = max(1, most - WINDOW + 1)
    for at in range(0, max(1, len(words) - WINDOW + 1), step):
        yield words[at:at + step + WINDOW - 1]


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (window, item) of the benchmark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, 1):
            for item, text in zip(part.column(0).to_pylist(), texts, strict=True):
                for words in _pieces(words_of(text), PIECE_WORDS):
                    rows = _windows(words)
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()),
                                                      pa.array([item] * len(rows), pa.int64())],
                                                     names=["window", "item"])

    return (benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "window binary, item long").distinct())


@F.arrow_udf(ArrayType(LongType()))
def _keys(windows: pa.Array) -> pa.Array:
    return pa.array([_window_shingles(w.split(b" ")).view(np.int64) for w in windows.to_pylist()],
                    pa.list_(pa.int64()))


def _bit_table(spots: DataFrame) -> np.ndarray:
    """Packed bits, one set for each key: 16 to 32 a key, ``MOST_BITS`` at most."""
    bits = min(MOST_BITS, 1 << max(16, (16 * spots.count()).bit_length()))
    words = (spots.groupBy(F.expr(f"shiftright(key & {bits - 1}L, 6)").alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 AS int))")).alias("set")).toArrow())
    out = np.zeros(bits >> 6, "<i8")
    out[words["at"].to_numpy()] = words["set"].to_numpy()
    return out.view(np.uint8)


def _document_counts(texts: DataFrame, table_: np.ndarray, sizes: list[int]) -> DataFrame:
    """In how many documents each shingle (``key``) occurs that passes the bit table."""
    shared = texts.sparkSession.sparkContext.broadcast(table_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value, bitorder="little").view(bool)
        low = np.uint64(len(known) - 1)
        for _, rows in text_batches(batches, 0):
            passed = []
            for text in rows:
                ids = word_hashes(words_of(text))
                for size in sizes:
                    s = _shingles(ids, size)
                    passed.append(np.unique(s[known[(s & low).astype(np.int64)]]))
            keys, n = np.unique(np.concatenate(passed), return_counts=True)
            if len(keys):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())],
                                                 names=["key", "n"])

    return texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def index_rows(texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The index as a table: ``window, item, key, offset``, the key being the window's rarest shingle."""
    windows = staged(benchmark_windows(benchmark), "benchmark-windows")
    spots = staged(windows.select("window").distinct().select("window", F.posexplode(_keys("window"))
                                                              .alias("offset", "key")), "benchmark-shingles")
    # a window of one or two words has one shingle, a longer one has shingles of three
    words = F.length("window") - F.length(F.translate(F.decode("window", "ISO-8859-1"), " ", "")) + 1
    sizes = sorted(r[0] for r in windows.select(F.least(words, F.lit(SHINGLE))).distinct().collect())
    if not sizes:
        return windows.withColumns({"key": F.lit(0).cast("long"), "offset": F.lit(0)})
    counts = _document_counts(texts, _bit_table(spots), sizes)
    rarest = (spots.join(counts, "key", "left").groupBy("window")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "offset")).alias("least")))
    return windows.join(rarest, "window").select("window", "item", "least.key", "least.offset")


#: Bytes of an entry beside its window: key, offset, words, place in the bytes, place in the items, item.
_ENTRY_BYTES = 48
_Block = dict[bytes, tuple[int, int, set[int | None]]]


def _blocks(rows: DataFrame, block_bytes: int) -> Iterator[_Block]:
    """The index in blocks: per window its key, offset and items. A window's items may lie in several."""
    block: _Block = {}
    size = 0
    for window, item, key, offset in rows.toLocalIterator():
        window = bytes(window)
        more = 8 if window in block else len(window) + _ENTRY_BYTES
        if block and size + more > block_bytes:
            yield block
            block, size, more = {}, 0, len(window) + _ENTRY_BYTES
        block.setdefault(window, (key & 0xFFFFFFFFFFFFFFFF, offset, set()))[2].add(item)
        size += more
    if block:
        yield block


def build_index(windows: dict[bytes, set[int | None]], counts: dict[int, int] | None = None) -> dict:
    """Index of windows held in memory, each under the shingle that is rarest by ``counts``."""
    block: _Block = {}
    for window, items in windows.items():
        hashes = _window_shingles(window.split(b" ")).tolist()
        offset = min(range(len(hashes)), key=lambda o: ((counts or {}).get(hashes[o], 0), hashes[o]))
        block[window] = (hashes[offset], offset, set(items))
    return _index(block)


def _index(block: _Block) -> dict:
    """Flat arrays, windows in the order of their keys; per shingle length the distinct keys and their runs."""
    rows = sorted((min(SHINGLE, n := w.count(b" ") + 1), key, w, offset, n, items)
                  for w, (key, offset, items) in block.items())
    index: dict = {"bytes": b"".join(r[2] for r in rows),
                   "at": np.cumsum([0] + [len(r[2]) for r in rows]),
                   "offset": np.array([r[3] for r in rows], np.int64),
                   "words": np.array([r[4] for r in rows], np.int64),
                   "items": np.array([i for r in rows for i in r[5] if i is not None], np.int64),
                   "item_at": np.cumsum([0] + [len(r[5] - {None}) for r in rows]),
                   "no_id": np.array([None in r[5] for r in rows], bool), "keys": {}}
    sizes = np.array([r[0] for r in rows], np.int64)
    keys = np.array([r[1] for r in rows], np.uint64)
    for size in np.unique(sizes).tolist():
        first, last = np.searchsorted(sizes, [size, size + 1])
        distinct, run = np.unique(keys[first:last], return_index=True)
        index["keys"][size] = (distinct, np.append(run, last - first) + first)
    return index


def find(text: str | None, index: dict) -> tuple[int, list[tuple[int, int]], set[int | None]]:
    """Number of words, merged spans of hit words, ids of the items whose windows occur."""
    words = words_of(text)
    ids = word_hashes(words)
    hits, windows = [], set()
    for size, (keys, runs) in index["keys"].items():
        hashes = _shingles(ids, size)
        spots = _at(keys, hashes)
        places = np.searchsorted(keys, hashes[spots])
        for p, first, last in zip(spots.tolist(), runs[places].tolist(), runs[places + 1].tolist(), strict=True):
            tests = zip(range(first, last), index["offset"][first:last].tolist(),
                        index["words"][first:last].tolist(), strict=True)
            for number, offset, n in tests:
                start = p - offset
                if start >= 0 and start + n <= len(words) and (
                        b" ".join(words[start:start + n])
                        == index["bytes"][index["at"][number]:index["at"][number + 1]]):
                    hits.append((start, start + n))
                    windows.add(number)
    items: set[int | None] = set()
    for number in windows:
        items.update(index["items"][index["item_at"][number]:index["item_at"][number + 1]].tolist())
        if index["no_id"][number]:
            items.add(None)
    return len(words), merge(hits), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _finder(shared: Broadcast):
    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array, before: pa.Array) -> pa.Array:
        rows = []
        for text, old in zip(texts.to_pylist(), before.to_pylist(), strict=True):
            n, spans, items = find(text, shared.value)
            if old and old["spans"]:
                spans = merge(spans + [(s["start"], s["end"]) for s in old["spans"]])
                items.update(old["items"])
            rows.append({"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans], "items": _in_order(items)})
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.array(rows, pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)),
                                         ("items", pa.list_(pa.int64()))]))

    return found


def match(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``documents``: ``row`` (the whole input row) and ``found`` (see ``find``)."""
    spark = lean_batches(documents.sparkSession)
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    text = F.col("row.text").cast("string")
    out = rows.withColumn("found", F.lit(None).cast(_parse(_FOUND)))
    texts = documents.select(F.col("text").cast("string"))
    blocks = 0
    for block in _blocks(index_rows(texts, benchmark), block_bytes):
        if blocks:
            out = staged(out, "decontaminate")
        shared = spark.sparkContext.broadcast(_index(block))
        out = out.select("row", _finder(shared)(text, F.col("found")).alias("found"))
        blocks += 1
    if not blocks:  # no window at all: only the words are counted
        shared = spark.sparkContext.broadcast(_index({}))
        out = out.select("row", _finder(shared)(text, F.col("found")).alias("found"))
    return out


def n_hit() -> Column:
    return F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated() -> Column:
    """A twentieth of the words, or more, are hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("found.n_words"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("found.items", lambda x: x.cast("string"))), ",")
    return found.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("found.n_words").alias("n_words"),
                        n_hit().alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows that are not contaminated by the benchmark stay; all columns kept."""
    return match(docs, table(spark, sf_dir, "benchmark")).where(~contaminated()).select("row.*")


OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS l, array_to_string(ws[i:i + 12], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM bw WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT l FROM win),
grams AS (
  SELECT doc_id, l, i, array_to_string(ws[i:i + l - 1], ' ') AS g
  FROM (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM w, lens WHERE len(ws) >= l)),
occ AS (SELECT doc_id, i, win.l AS l, item_id FROM grams JOIN win ON grams.g = win.g AND grams.l = win.l),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM occ) GROUP BY 1),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM occ) GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
