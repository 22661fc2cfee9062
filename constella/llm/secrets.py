"""Operator 8 (native): secret scans with corpus-wide ownership frequency.

Candidates are found by three patterns (``assign``, ``access``, ``hex``). A candidate's value is
hashed, and the hash is counted over the whole corpus: in how many distinct repositories (documents)
and under how many distinct owners (sources) it occurs. A value is a widely copied example if
``COPIED_OWNERS`` owners or more hold it, or if several owners hold it in ``COPIED_REPOSITORIES``
repositories or more. Any other value is owner-specific: one owner may well repeat its own credential
in many places. If it also looks random (at least ``LEAST_DISTINCT`` different characters and no
placeholder word) it is live-looking, and a span ``live`` over the value is added to the spans of its
pattern.

Only DataFrame functions are used. Match offsets come from the pieces between matches: the split of
a text by a pattern has one piece before each match, so a running sum of piece and match lengths
(in code points) gives every start. Rows without a candidate never leave the scan; candidates are
numbered, joined and regrouped by row number. Counting first reduces to distinct (value, owner,
repository), so a value that a third of the rows hold is spread over its repositories.

Row cases: a null text counts as empty; whole texts are scanned, however long. An empty table gives an
empty result. A null source is an owner of its own, a null doc_id a
repository of its own. Repeated rows give repeated rows and count once as a repository. Extra columns
of any name pass through the stage in one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from constella.llm.common import staged, table

# fixed values: the patterns of the base spans, kinds in their fixed order
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
              r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    # runs as long as asked for: a shorter run holds no longer one, so nothing else can match in it
    "access": r"(AKIA[A-Z0-9]{14,})()",
    "hex": r"([0-9a-f]{16,})()",
}
LEAST_ASSIGN = 12
PLACEHOLDERS = r"(?i)example|sample|placeholder|changeme|your[-_.]?|x{6,}|0{8,}|12345678"
MASK = "[SECRET]"


def _matches(text: Column, kind: str) -> Column:
    """Array of (place, gap, whole, value) of a pattern's matches, in order."""
    pattern = F.lit(PATTERNS[kind])
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else whole
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda piece: F.length(piece))
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value"))
    # the piece after the last match has no match beside it
    return F.when(F.regexp_like(text, pattern), F.transform(
        F.filter(zipped, lambda z: z["whole"].isNotNull()),
        lambda z, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), z["gap"].alias("gap"),
                              F.length(z["whole"]).alias("size"), z["value"].alias("value")))).otherwise(
        F.array().cast("array<struct<kind:string,place:int,gap:int,size:int,value:string>>"))


def scan(documents: DataFrame, carry: bool = False) -> DataFrame:
    """Staged rows: rid, doc_id, source, matches of all patterns; with ``carry`` the whole row."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = documents.select(F.monotonically_increasing_id().alias("rid"), row)
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    kept = [F.col("row")] if carry else []
    return staged(rows.select(
        "rid", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.source").cast("string").alias("source"),
        F.concat(*[_matches(text, k) for k in KINDS]).alias("matches"), *kept), "secrets")


def candidates(scanned: DataFrame) -> DataFrame:
    """One row per candidate: rid, owner, repository, kind, span and hashed value."""
    found = scanned.where(F.size("matches") > 0).select("rid", "doc_id", "source", F.explode("matches").alias("m"))
    before = Window.partitionBy("rid", "m.kind").orderBy("m.place")
    ends = found.select("rid", "doc_id", "source", "m.*", F.sum(F.col("m.gap") + F.col("m.size")).over(before)
                        .cast("long").alias("end"))
    looks_random = (F.size(F.array_distinct(F.split("value", ""))) >= F.lit(LEAST_DISTINCT)) & ~F.col("value").rlike(
        PLACEHOLDERS)
    return ends.where((F.col("kind") != "assign") | (F.length("value") >= LEAST_ASSIGN)).select(
        "rid", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("repository"),
        F.coalesce(F.col("source"), F.lit("\0")).alias("owner"), "kind", (F.col("end") - F.col("size")).alias("start"),
        "end", (F.col("end") - F.length("value")).alias("value_start"), F.sha2("value", 256).alias("hash"),
        looks_random.alias("random"))


LEAST_DISTINCT = 6
COPIED_OWNERS = 3
COPIED_REPOSITORIES = 8


def ownership(found: DataFrame, copied_owners: int = COPIED_OWNERS,
              copied_repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """Per hashed value: distinct repositories and owners, and whether it is a widely copied example."""
    by_repository = found.select("hash", "owner", "repository").distinct()
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners")).withColumn(
        "copied", (F.col("owners") >= copied_owners)
        | ((F.col("owners") > 1) & (F.col("repositories") >= copied_repositories)))


def judged(scanned: DataFrame, copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """Candidates with their ownership counts and ``live``, the method's verdict."""
    found = candidates(scanned)
    return found.join(ownership(found, copied_owners), "hash").withColumn("live", ~F.col("copied") & F.col("random"))


def _joined(spans: Column) -> Column:
    ordered = F.array_sort(spans)  # by start, then the kind's place, then the end
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(documents: DataFrame, copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """Per row: doc_id, counts per kind, base spans and all spans in order, live and copied counts, and the
    widest spread of its values (owners, repositories)."""
    scanned = scan(documents)
    order = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).otherwise(2)
    span = F.struct("start", order.alias("place"), "end", "kind")
    live = F.struct(F.col("value_start").alias("start"), F.lit(3).alias("place"), "end", F.lit("live").alias("kind"))
    of_row = judged(scanned, copied_owners).groupBy("rid").agg(
        *[F.sum((F.col("kind") == k).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sum(F.col("live").cast("long")).alias("n_live"), F.sum(F.col("copied").cast("long")).alias("n_copied"),
        F.max("owners").alias("n_owners"), F.max("repositories").alias("n_repositories"),
        F.collect_list(span).alias("base"), F.collect_set(F.when(F.col("live"), live)).alias("added"))
    none = F.lit(0).cast("long")
    return scanned.select("rid", "doc_id").join(of_row, "rid", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", none).alias(f"n_{k}") for k in (
            *KINDS, "live", "copied", "owners", "repositories")],
        F.coalesce(_joined(F.col("base")), F.lit("")).alias("base_spans"),
        F.coalesce(_joined(F.concat("base", "added")), F.lit("")).alias("spans"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_live",
                        "n_copied", "n_owners", "n_repositories")


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the values of live-looking secrets are masked; all rows and columns kept.

    Widely copied examples and placeholders stay as they are. Overlapping spans are masked once.
    ``n_chars`` of a changed row is its new length. Rows without a candidate are read straight through; only
    rows with one meet the spans.
    """
    scanned = scan(docs, carry=True)
    spans = judged(scanned).where("live").groupBy("rid").agg(
        F.array_sort(F.collect_set(F.struct(F.col("value_start").alias("start"), "end"))).alias("live"))
    some = F.size("matches") > 0
    joined = scanned.where(some).select("rid", "row").join(spans, "rid", "left").select("row", "live").union(
        scanned.where(~some).select("row", F.lit(None).cast(spans.schema["live"].dataType)))
    text = F.col("row.text").cast("string")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    # a span that begins inside the one before only moves the end; else the gap and a mask are added
    masked = F.aggregate("live", start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when((s["start"] < acc["at"]) & (acc["at"] > 0), acc["parts"]).otherwise(F.concat(acc["parts"], F.array(
            F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit(MASK)
        ))).alias("parts")), lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(
            text, acc["at"].cast("int") + 1, F.length(text))))
    columns = []
    for f in docs.schema.fields:
        old = F.col("row").getField(f.name)
        if f.name == "text":
            old = F.when(F.col("live").isNull(), old).otherwise(masked)
        elif f.name == "n_chars":
            old = F.when(F.col("live").isNull(), old).otherwise(F.length(masked).cast(f.dataType))
        columns.append(old.alias(f.name))
    return joined.select(*columns)


def _positions(kind: str, pattern: str, least: str, group: int) -> str:
    return f"""
  SELECT doc_id, source, '{kind}' AS kind, v,
    list_sum(gaps[1:i])::BIGINT + coalesce(list_sum(sizes[1:i - 1]), 0)::BIGINT AS s,
    list_sum(gaps[1:i])::BIGINT + list_sum(sizes[1:i])::BIGINT AS e
  FROM (SELECT doc_id, source, gaps, list_transform(ms, lambda x: length(x)) AS sizes, unnest(vs) AS v,
      unnest(range(1, len(ms) + 1)) AS i
    FROM (SELECT doc_id, source, regexp_extract_all(text, {pattern}) AS ms,
        regexp_extract_all(text, {pattern}, {group}) AS vs,
        list_transform(string_split_regex(text, {pattern}), lambda x: length(x)) AS gaps
      FROM d WHERE regexp_matches(text, {pattern})))
  WHERE {least}"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''").replace("\\x20", " ") + "'"


OP8_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
c AS ({_positions('assign', _quoted(PATTERNS['assign']), f'length(v) >= {LEAST_ASSIGN}', 2)}
  UNION ALL {_positions('access', _quoted('AKIA[A-Z0-9]{14,}'), 'true', 0)}
  UNION ALL {_positions('hex', _quoted('[0-9a-f]{16,}'), 'true', 0)}),
o AS (
  SELECT v, count(DISTINCT coalesce(source, chr(1))) AS owners,
    count(DISTINCT (coalesce(source, chr(1)), coalesce(doc_id::VARCHAR, 'null'))) AS repositories FROM c GROUP BY v),
w AS (
  SELECT *, owners >= {COPIED_OWNERS} OR owners > 1 AND repositories >= {COPIED_REPOSITORIES} AS copied FROM o),
j AS (
  SELECT c.*, owners, repositories, copied, NOT copied
    AND len(list_distinct(string_split(c.v, ''))) >= {LEAST_DISTINCT}
    AND NOT regexp_matches(c.v, '{PLACEHOLDERS}') AS live,
    CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 ELSE 2 END AS k
  FROM c JOIN w USING (v)),
s AS (
  SELECT doc_id, s, k, e, kind || ':' || s || ':' || e AS t, true AS base FROM j
  UNION ALL SELECT DISTINCT doc_id, e - length(v), 3, e, 'live:' || (e - length(v)) || ':' || e, false FROM j
  WHERE live),
a AS (
  SELECT doc_id, string_agg(t, ',' ORDER BY s, k, e) FILTER (base) AS b, string_agg(t, ',' ORDER BY s, k, e) AS x
  FROM s GROUP BY doc_id),
n AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied,
    max(owners) AS n_owners, max(repositories) AS n_repositories
  FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(x, '') AS spans,
  coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied,
  coalesce(n_owners, 0)::BIGINT AS n_owners, coalesce(n_repositories, 0)::BIGINT AS n_repositories
FROM d LEFT JOIN a USING (doc_id) LEFT JOIN n USING (doc_id)
"""
