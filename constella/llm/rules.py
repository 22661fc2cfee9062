"""Operator 10 (native): quality rules judged at the level of hosts.

Each document is measured by base rules; a rule failure is a document that fails the base rules or
has too many symbols or repeated lines. Failures are summed by host (the document's source). A host's
failure rate is shrunk towards the corpus by a beta prior fitted to all hosts' rates (method of
moments), so that a host of a few documents is not judged on them alone. A host whose shrunk rate
exceeds ``worst_rate`` is rejected, and the verdict is joined back to its documents.

Only DataFrame functions are used. All counts of a document are made inside its row; documents are
not shuffled, and the measures are cut from the texts before hosts are summed (partial sums first,
so a host of a third of all rows is one row per task).

Row cases: null text has no words (base rules fail it). Whole texts are measured, however long. A null source is a host of its own. Repeated
rows are counted and returned each. Empty table: empty result. Fewer than two hosts, or hosts with
equal rates: the prior weighs as ``default_strength`` documents. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.llm.common import checkpointed, table

# fixed values of the base rules
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
#: More symbols per word, or repeated lines per line, are a rule failure.
MOST_SYMBOLS, MOST_DUP_LINES = 0.1, 0.3
WORST_RATE = 0.5
DEFAULT_STRENGTH = 50.0


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""
    n = F.size(words)
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.concat_ws(
        " ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<string>"))
    return windows


def measure(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"),
                            text.alias("t"))
    rows = rows.select("doc_id", "host", "t", F.filter(F.split("t", SPACE, -1), lambda w: w != "").alias("w"),
                       F.filter(F.split("t", "\n", -1), lambda x: F.trim(F.translate(x, SPACES, " ")) != "").alias(
                           "lines"))
    rows = rows.withColumn("windows", _repeat_words(F.col("w")))
    # most texts repeat no window: a set of the windows tells; only the others are sorted by window
    ordered = F.array_sort(F.transform("windows", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    rows = rows.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ordered))
    same = lambda a, b: F.get("ordered", a)["g"] == F.get("ordered", b)["g"]
    repeated = F.filter(F.transform("ordered", lambda x, i: F.when(
        F.coalesce(same(i, i + 1), F.lit(False)) | F.coalesce(F.when(i > 0, same(i, i - 1)), F.lit(False)), x["i"])),
        lambda i: i.isNotNull())
    covered = F.size(F.array_distinct(F.flatten(F.transform(repeated, lambda i: F.array(i, i + 1, i + 2)))))
    return rows.select(
        "doc_id", "host", F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("ordered").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_failed() -> Column:
    return base_failed() | (F.col("n_symbols") > MOST_SYMBOLS * F.col("n_words")) | (
        F.col("n_dup_lines") > MOST_DUP_LINES * F.col("n_lines"))


def hosts(measured: DataFrame, worst_rate: float = WORST_RATE, strength: float = DEFAULT_STRENGTH) -> DataFrame:
    """Per host: documents, failures, shrunk failure rate, rejected."""
    counts = measured.groupBy("host").agg(F.count("*").alias("docs"), F.sum(rule_failed().cast("long")).alias("fails"))
    rate = F.col("fails") / F.col("docs")
    prior = counts.agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v")).first()
    m, v = (prior["m"], prior["v"]) if prior["m"] is not None else (0.0, None)
    total = m * (1 - m) / v - 1 if v else strength
    total = min(max(total, 1.0), 1e6)
    return counts.withColumn("rate", (F.col("fails") + m * total) / (F.col("docs") + total)).withColumn(
        "rejected", F.col("rate") > worst_rate)


def judge(documents: DataFrame, worst_rate: float = WORST_RATE) -> DataFrame:
    """Per row the measures of ``measure``, base_failed, host_rate and kept."""
    measured = checkpointed(measure(documents))
    verdicts = hosts(measured, worst_rate).select(F.col("host").alias("h"), "rate", "rejected")
    return measured.join(verdicts, F.col("host").eqNullSafe(F.col("h"))).select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), F.col("rate").alias("host_rate"),
        (~base_failed() & ~F.col("rejected")).alias("kept"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP10_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines
  FROM d LEFT JOIN rep USING (r)),
f AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words OR n_symbols > {MOST_SYMBOLS} * n_words
      OR n_dup_lines > {MOST_DUP_LINES} * n_lines AS failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS k FROM f GROUP BY source),
p AS (SELECT avg(k / n) AS m, var_samp(k / n) AS v FROM h),
q AS (SELECT m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE {DEFAULT_STRENGTH} END, 1), 1e6) AS s
  FROM p),
x AS (SELECT source, (k + m * s) / (n + s) > {WORST_RATE} AS rejected FROM h, q)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM f JOIN x ON f.source IS NOT DISTINCT FROM x.source
"""
