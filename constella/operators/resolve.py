"""Identifier resolution: ISIN repair, key lookups and entity enrichment.

All lookups are joins (never per-row dictionaries): the lookup side has one
row per instrument, so AQE broadcasts it while it is small and falls back to a
sort-merge join, with skew splitting, when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from constella.operators.intervals import first_per_key
from constella.schemas import ENTITY_RESPONSE_TYPE
from constella.session import staged

# Raw ISIN texts that mean "no ISIN" (compared case-insensitively
# after trimming), and the prefix of the synthetic fallback identifier.
MISSING_ISIN_TEXTS = ("", "null", "none")
FALLBACK_PREFIX = "KEY_"


def valid_isin(raw: Column) -> Column:
    """P2 predicate: a raw ISIN is usable unless blank / 'null' / 'none'."""
    t = F.trim(raw)
    return raw.isNotNull() & ~F.lower(t).isin(*MISSING_ISIN_TEXTS)


def isin_lookup(history: DataFrame, order_col: str = "ordinal") -> DataFrame:
    """internal_key -> ISIN from earlier assets; the last valid row per key wins.

    Rows need a non-empty key and a non-blank ISIN that is not a fallback
    identifier.  ``order_col`` is the explicit input order.
    """
    ok = history.where(
        F.col("internal_key").isNotNull()
        & (F.col("internal_key") != "")
        & F.col("isin").isNotNull()
        & (F.trim(F.col("isin")) != "")
        & ~F.col("isin").startswith(FALLBACK_PREFIX)
    ).select("index_name", F.trim("internal_key").alias("internal_key"), F.trim("isin").alias("isin"), order_col)
    last = ok.groupBy("index_name", "internal_key").agg(F.max_by("isin", F.col(order_col)).alias("isin"))
    return last


def resolve_isins(rows: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Keep a valid raw ISIN, else the lookup's ISIN for the key, else KEY_<key>.

    A row with neither has a null ISIN (Q13); membership never takes such rows.
    """
    key = F.trim(F.col("internal_key"))
    out = rows.withColumn("internal_key", key)
    if lookup is not None:
        out = out.join(lookup.withColumnRenamed("isin", "_looked_up"), ["index_name", "internal_key"], "left")
    else:
        out = out.withColumn("_looked_up", F.lit(None).cast("string"))
    resolved = F.when(valid_isin(F.col("raw_isin")), F.trim(F.col("raw_isin"))).otherwise(
        F.coalesce(F.col("_looked_up"), F.concat(F.lit(FALLBACK_PREFIX), F.nullif(F.col("internal_key"), F.lit(""))))
    )
    return out.withColumn("isin", resolved).drop("_looked_up")


def unnest_entities(responses: DataFrame) -> DataFrame:
    """``{id: {"alpha_id": ...} | null}`` responses -> (id, alpha_id) rows.

    Q19: an entity whose alpha_id is null counts as unresolved, like a null entity.
    """
    parsed = responses.select(
        "index_name", "endpoint", F.explode(F.from_json("response", ENTITY_RESPONSE_TYPE)).alias("id", "entity")
    )
    return parsed.where(F.col("entity.alpha_id").isNotNull()).select(
        "index_name", "endpoint", "id", F.col("entity.alpha_id").alias("alpha_id")
    )


def enrich_ids(
    assets: DataFrame,
    entities: DataFrame,
    id_col: str = "entity_id",
    seen: tuple[Observation, Observation] | None = None,
    one_per_isin: bool = False,
) -> DataFrame:
    """Entity id by ISIN; for ISINs still unresolved, by RIC; row count preserved.

    Q20: when several RICs of one ISIN resolve, the smallest RIC's id is used.  ``seen`` observes the rows
    on their way in (``rows``) and out (``rows``, ``by_isin``, ``by_ric``, ``unresolved``).  With
    ``one_per_isin`` (no ISIN of an index has two rows) a row's own RIC is the only one to ask for.
    """
    by_isin = (
        entities.where(F.col("endpoint") == "isin")
        .groupBy("index_name", F.col("id").alias("isin"))
        .agg(F.min("alpha_id").alias("_by_isin"))
    )
    by_ric = (
        entities.where(F.col("endpoint") == "ric")
        .groupBy("index_name", F.col("id").alias("ric"))
        .agg(F.min("alpha_id").alias("_by_ric"))
    )
    base = assets.drop(id_col)
    count = F.count(F.lit(1)).alias("rows")
    if seen:
        base = base.observe(seen[0], count)
    if one_per_isin:
        keys = ["index_name", "isin"]
        if "_spread" in base.columns:  # the rows lie by this number already (``merge_listed``)
            keys = ["_spread", *keys]
            by_isin = entities.where(F.col("endpoint") == "isin").groupBy(
                F.xxhash64("index_name", "id").alias("_spread"), "index_name", F.col("id").alias("isin")).agg(
                F.min("alpha_id").alias("_by_isin"))
        # a blank RIC is no RIC, and an ISIN that was answered is not asked for by RIC
        out = base.join(by_isin.withColumn("_answered", F.lit(True)), keys, "left").join(
            by_ric.where(F.col("ric") != ""), ["index_name", "ric"], "left").select(
            *[c for c in base.columns if c != "_spread"], "_by_isin",
            F.when(F.col("_answered").isNull(), F.col("_by_ric")).alias("_by_ric"))
    else:
        pairs = (
            assets.select("index_name", "isin", "ric")
            .where(F.col("ric").isNotNull() & (F.col("ric") != ""))
            .join(by_isin.select("index_name", "isin"), ["index_name", "isin"], "left_anti")
            .distinct()
        )
        ric_hits = pairs.join(by_ric, ["index_name", "ric"], "inner").groupBy("index_name", "isin").agg(
            F.min_by("_by_ric", F.col("ric")).alias("_by_ric")
        )
        out = base.join(by_isin, ["index_name", "isin"], "left").join(ric_hits, ["index_name", "isin"], "left")
    if seen:
        none = F.col("_by_isin").isNull()
        out = out.observe(
            seen[1], count, F.count("_by_isin").alias("by_isin"),
            F.count_if(none & F.col("_by_ric").isNotNull()).alias("by_ric"),
            F.count_if(none & F.col("_by_ric").isNull()).alias("unresolved"))
    return out.withColumn(id_col, F.coalesce("_by_isin", "_by_ric")).drop("_by_isin", "_by_ric")


class RowsChanged(RuntimeError):
    """Enrichment lost or multiplied rows."""


def enrich_counted(
    assets: DataFrame, entities: DataFrame, id_col: str = "entity_id", one_per_isin: bool = False
) -> tuple[DataFrame, dict[str, int]]:
    """V6: ``enrich_ids`` with its counts, taken on the one pass that writes the result.

    Returns the staged rows and {rows_before, rows_after, by_isin, by_ric, unresolved}; raises
    ``RowsChanged`` unless every row went through exactly once.
    """
    seen = (Observation("enrich_in"), Observation("enrich_out"))
    once = {"one_per_isin": True} if one_per_isin else {}
    out = staged(enrich_ids(assets, entities, id_col, seen, **once), "enriched")
    after = seen[1].get
    counts = {"rows_before": seen[0].get["rows"], "rows_after": after["rows"],
              **{k: after[k] for k in ("by_isin", "by_ric", "unresolved")}}
    if counts["rows_before"] != counts["rows_after"]:
        raise RowsChanged(f"{counts['rows_before']} rows went in, {counts['rows_after']} came out")
    return out, counts


def unresolved_isins(assets: DataFrame, entities: DataFrame) -> DataFrame:
    """J8 (anti): ISINs of the assets that the ISIN lookup did not resolve."""
    by_isin = entities.where(F.col("endpoint") == "isin").select("index_name", F.col("id").alias("isin"))
    return assets.select("index_name", "isin").distinct().join(by_isin, ["index_name", "isin"], "left_anti")


def unresolved_report(enriched: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """V7: one row per unresolved ISIN, existing report columns only, dates as text."""
    wanted = ("isin", "ric", "name", "country", "currency", "first_included", "last_included")
    cols = [c for c in wanted if c in enriched.columns]
    rows = enriched.where(F.col(id_col).isNull()).select("index_name", *cols)
    order = [c for c in ("first_included", "ric") if c in cols]
    one = first_per_key(rows, ["index_name", "isin"], order or ["isin"], [c for c in cols if c != "isin"])
    dates = {f.name for f in one.schema.fields if f.dataType.typeName() == "date"}
    return one.select(
        "index_name", *[F.col(c).cast("string").alias(c) if c in dates else F.col(c) for c in cols]
    ).orderBy("index_name", "isin")
