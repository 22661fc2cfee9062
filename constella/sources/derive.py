"""Selection lists derived from the input tables.

Two indexes stand in for the reviewed index (one review per calendar quarter):

* ``CUST`` — one instrument per customer; market cap = order value of the
  quarter; customers with a negative account balance are listed unranked.
* ``PART`` — one instrument per part; market cap = shipped value of the quarter.

Market caps are summed in integer cents so that ranks never depend on the
order of a floating-point sum.  Both indexes are produced by the same
aggregation-and-rank plan and processed together in every later step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.functions.ranking import ranked_within
from constella.schemas import DEFAULT_RULE, IndexRule
from constella.sources.tables import read_table

# Rules of the two derived indexes: PART uses the reviewed index's constants,
# CUST a smaller universe-sized rule so that every reason occurs.
RULES: dict[str, IndexRule] = {
    "CUST": IndexRule(auto=220, target=240, buffer_end=300, check_to=100),
    "PART": DEFAULT_RULE,
}


def _quarter(ts: str) -> Column:
    return F.trunc(F.to_date(F.col(ts)), "quarter")


def _cents(amount: str) -> Column:
    return F.sum(F.round(F.col(amount) * 100).cast("bigint"))


def _ident(prefix: str, key: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def _value_per_quarter(df: DataFrame, ts: str, key: str, amount: str) -> DataFrame:
    """Sum of integer cents per (quarter, key).

    A plain partial + final aggregate: most keys are near-unique per quarter,
    but a hot key (one customer or part with a third of all rows) is combined
    map-side before the shuffle instead of landing in one task.
    """
    keyed = df.select(_quarter(ts).alias("review_date"), F.col(key).alias("key"), F.col(amount))
    return keyed.groupBy("review_date", "key").agg(_cents(amount).alias("cents"))


def _cust_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    value = _value_per_quarter(orders, "o_orderdate", "o_custkey", "o_totalprice")
    return (
        value.join(customer, value.key == customer.c_custkey, "inner")
        .select(
            F.lit("CUST").alias("index_name"),
            "review_date",
            "key",
            "cents",
            F.lit("C").alias("isin_prefix"),
            F.coalesce(F.col("c_acctbal") >= 0, F.lit(False)).alias("eligible"),
        )
    )


def _part_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_extendedprice", "l_shipdate"])
    return _value_per_quarter(lineitem, "l_shipdate", "l_partkey", "l_extendedprice").select(
        F.lit("PART").alias("index_name"),
        "review_date",
        "key",
        "cents",
        F.lit("P").alias("isin_prefix"),
        F.lit(True).alias("eligible"),
    )


def isin_of(prefix: Column, key: Column) -> Column:
    return F.concat(F.lit("X"), prefix, F.lpad(key.cast("string"), 10, "0"))


def ric_of(prefix: Column, key: Column) -> Column:
    # Dotted like exchange RICs, so that wide exports need quoted names.
    return F.concat(prefix, key.cast("string"), F.lit("."), prefix, F.lit("X"))


def _keyed_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cust_listing(spark, sf_dir).unionByName(_part_listing(spark, sf_dir))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists' rows without their places: index, review, instrument, market cap, and whether it is ranked."""
    rows = _keyed_listing(spark, sf_dir)
    prefix, key = F.col("isin_prefix"), F.col("key")
    return rows.select("index_name", "review_date", isin_of(prefix, key).alias("isin"), ric_of(prefix, key).alias("ric"),
                       "cents", (F.col("cents") / F.lit(100.0)).alias("ff_mcap"), "eligible")


def rank_order() -> list[Column]:
    """The order of ranked rows: market cap, then ISIN."""
    return [F.col("cents").desc(), F.col("isin").asc()]


def listed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(index, review) of every list, from the dates alone."""
    return _listed(spark, sf_dir, "review_date")


def listed_isins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(index, ISIN) of every instrument that was ever listed."""
    return _listed(spark, sf_dir, "isin")


def _listed(spark: SparkSession, sf_dir: str, what: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer", ["c_custkey"])
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    known = orders.join(customer, orders.o_custkey == customer.c_custkey, "left_semi")
    lineitem = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_shipdate"])
    values = {"review_date": (_quarter("o_orderdate"), _quarter("l_shipdate")),
              "isin": (isin_of(F.lit("C"), F.col("o_custkey")), isin_of(F.lit("P"), F.col("l_partkey")))}[what]
    return known.select(F.lit("CUST").alias("index_name"), values[0].alias(what)).distinct().unionByName(
        lineitem.select(F.lit("PART").alias("index_name"), values[1].alias(what)).distinct())


def review_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selection-list entries of both indexes (ENTRY_SCHEMA), numbered and staged.

    ``ordinal`` is the row's place in its list (ranked rows first, by market
    cap, then ISIN); ``rank`` equals it for ranked rows and is null otherwise.
    """
    # keys and cents are dealt and staged; the texts that follow from them are made where they are read
    prefix = F.when(F.col("index_name") == "CUST", "C").otherwise("P")
    isin = isin_of(prefix, F.col("key"))
    ordered = ranked_within(_keyed_listing(spark, sf_dir).drop("isin_prefix"), ["index_name", "review_date"],
                            [F.when(F.col("eligible"), 0).otherwise(1), F.col("cents").desc()], "ordinal", isin)
    return ordered.select(
        "index_name",
        "review_date",
        isin.alias("isin"),
        ric_of(prefix, F.col("key")).alias("ric"),
        (F.col("cents") / F.lit(100.0)).alias("ff_mcap"),
        F.when(F.col("eligible"), F.col("ordinal")).cast("int").alias("rank"),
        F.when(~F.col("eligible"), F.lit("negative balance")).alias("comment"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )


def review_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument master data of both indexes (ASSET_SCHEMA), one row per ISIN."""
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    cust = customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey, "left").select(
        F.lit("CUST").alias("index_name"),
        isin_of(F.lit("C"), F.col("c_custkey")).alias("isin"),
        F.lpad(F.col("c_custkey").cast("string"), 7, "0").alias("internal_key"),
        ric_of(F.lit("C"), F.col("c_custkey")).alias("ric"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("currency"),
        _ident("S", F.col("c_custkey"), 6).alias("sedol"),
    )
    parts = part.select(
        F.lit("PART").alias("index_name"),
        isin_of(F.lit("P"), F.col("p_partkey")).alias("isin"),
        F.lpad(F.col("p_partkey").cast("string"), 7, "0").alias("internal_key"),
        ric_of(F.lit("P"), F.col("p_partkey")).alias("ric"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("country"),
        F.col("p_type").alias("currency"),
        F.lit(None).cast("string").alias("sedol"),
    )
    return cust.unionByName(parts)


# ----------------------------------------------------------- raw vendor inputs
# The derived lists above are clean.  The inputs below add the defects the
# reviewed pipeline repairs; each defect is a fixed function of the
# instrument key, so every row of the input tables is kept.


def _key() -> Column:
    return F.col("internal_key").cast("bigint")


def raw_isin_text(isin: Column, key: Column) -> Column:
    """Vendor ISIN text: blank, 'null' or 'None' for some keys."""
    return (
        F.when(key % 17 == 0, F.lit(""))
        .when(key % 19 == 0, F.lit("null"))
        .when(key % 23 == 0, F.lit(" None"))
        .when(key % 29 == 0, F.lit("NULL "))
        .otherwise(isin)
    )


def selection_rows(entries: DataFrame, assets: DataFrame) -> DataFrame:
    """Rows of the vendor's selection lists: entry + instrument data, raw ISIN text."""
    # the instruments of a task are hashed, so that the many rows of the lists are not sorted to meet them
    rows = entries.drop("ric").join(assets.hint("shuffle_hash"), ["index_name", "isin"], "inner")
    return rows.withColumn("raw_isin", raw_isin_text(F.col("isin"), _key()))


def patchy_isin_text(isin: Column, key: Column, day: Column) -> Column:
    """ISIN text that is blank in some of an instrument's lists only."""
    return F.when((key + F.year(day) * 4 + F.quarter(day)) % 7 == 0, F.lit("")).otherwise(isin)


def _variants(df: DataFrame, keep_cols: list[str], *variants: tuple[Column, dict[str, Column]]) -> DataFrame:
    """One scan, several output rows per input row: ``inline`` over an array of
    (keep, fields) structs, then drop the variants whose condition is false."""
    names = list(variants[0][1])
    structs = [F.struct(cond.alias("_keep"), *[fields[n].alias(n) for n in names]) for cond, fields in variants]
    return df.select(*keep_cols, F.inline(F.array(*structs))).where("_keep").drop("_keep")


def asset_history(spark: SparkSession, sf_dir: str, assets: DataFrame | None = None) -> DataFrame:
    """An earlier assets file: superseded ISINs, fallback ids, blanks, padded keys.

    ``ordinal`` is the row order of that file (later rows win in the lookup).
    """
    assets = assets if assets is not None else review_assets(spark, sf_dir)
    k = _key()
    key, isin = F.col("internal_key"), F.col("isin")
    return _variants(
        assets,
        ["index_name"],
        (k % 7 == 0, {"internal_key": key, "isin": F.concat(F.lit("XO"), F.substring("isin", 3, 10)),
                      "ordinal": k * 4}),
        (F.lit(True), {"internal_key": F.when(k % 13 == 0, F.concat(F.lit(" "), key, F.lit(" "))).otherwise(key),
                       "isin": F.when(k % 3 == 0, F.concat(F.lit("KEY_"), key)).otherwise(isin),
                       "ordinal": k * 4 + 1}),
        (k % 11 == 0, {"internal_key": key, "isin": F.lit("  "), "ordinal": k * 4 + 2}),
    )


def entity_responses(spark: SparkSession, sf_dir: str, assets: DataFrame | None = None) -> DataFrame:
    """Identity-service answers as JSON text, 100 identifiers per response.

    By ISIN: most keys resolve, every 8th is a null entity, other 4th keys are
    absent.  By RIC: every 3rd key resolves, some others answer null.
    """
    assets = assets if assets is not None else review_assets(spark, sf_dir)
    k = _key()
    entity = F.struct(F.concat(F.lit("E"), F.lpad(k.cast("string"), 9, "0")).alias("alpha_id"))
    null_entity = F.lit(None).cast("struct<alpha_id:string>")
    calls = _variants(
        assets,
        ["index_name", (k / 100).cast("bigint").alias("batch")],
        ((k % 4 != 0) | (k % 8 == 0), {"endpoint": F.lit("isin"), "id": F.col("isin"),
                                       "entity": F.when(k % 8 == 0, null_entity).otherwise(entity)}),
        ((k % 3 == 0) | (k % 5 == 1), {"endpoint": F.lit("ric"), "id": F.col("ric"),
                                       "entity": F.when(k % 3 == 0, entity).otherwise(null_entity)}),
    )
    return calls.groupBy("index_name", "endpoint", "batch").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("id", "entity")))).alias("response")
    )


def previous_snapshot(spark: SparkSession, sf_dir: str, assets: DataFrame | None = None) -> DataFrame:
    """An assets snapshot published earlier: other names, duplicates, stale derived columns."""
    assets = assets if assets is not None else review_assets(spark, sf_dir)
    k = _key()
    others = [c for c in assets.columns if c != "name"]
    snap = _variants(
        assets.where(k % 2 == 0),
        others,
        (F.lit(True), {"name": F.upper("name"), "_row": k * 2}),
        (k % 10 == 0, {"name": F.lit("DUPLICATE"), "_row": k * 2 + 1}),
    )
    stale = F.lit(None).cast("date")
    return snap.select(
        *assets.columns, "_row", stale.alias("first_included"), stale.alias("last_included"),
        F.lit("stale").alias("entity_id"),
    )
