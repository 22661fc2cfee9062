"""Fixed schemas and the per-index rule record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the data model (must equal the reviewed pipeline's):
# entry reasons, in the order the rule assigns them.
REASON_TOP = "top_550"
REASON_RETAINED = "buffer_retained"
REASON_FILL = "fill_to_600"
REASON_BOOTSTRAP = "bootstrap"
ENTRY_REASONS = (REASON_TOP, REASON_RETAINED, REASON_FILL, REASON_BOOTSTRAP)


@dataclass(frozen=True)
class IndexRule:
    """Buffer rule of one index.

    ``auto``: positions 1..auto are members outright; ``target``: index size;
    ``buffer_end``: last position at which a prior member is retained;
    ``check_to``: ranks 1..check_to must be present in the daily ranking.
    """

    auto: int = 550
    target: int = 600
    buffer_end: int = 750
    check_to: int = 100

    def __post_init__(self) -> None:
        if not (0 <= self.auto <= self.target <= self.buffer_end):
            raise ValueError(f"rule needs 0 <= auto <= target <= buffer_end, got {self}")


# The reviewed index's constants: 550 automatic, 600 members, buffer to 750,
# ranks 1-100 checked in the ranking table.
DEFAULT_RULE = IndexRule(550, 600, 750, 100)

ASSET_SCHEMA = T.StructType(
    [
        T.StructField("index_name", T.StringType()),
        T.StructField("isin", T.StringType()),
        T.StructField("internal_key", T.StringType()),
        T.StructField("ric", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("sedol", T.StringType()),
    ]
)

ENTRY_SCHEMA = T.StructType(
    [
        T.StructField("index_name", T.StringType()),
        T.StructField("review_date", T.DateType()),
        T.StructField("isin", T.StringType()),
        T.StructField("ric", T.StringType()),
        T.StructField("ff_mcap", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("comment", T.StringType()),
        T.StructField("ordinal", T.LongType()),
    ]
)

# Selection-list CSV: every column is read as text; casts happen afterwards
# with blank-tolerant try_cast (leading zeros of keys survive).
SELECTION_CSV_COLUMNS = (
    "Internal_Key",
    "ISIN",
    "RIC",
    "Instrument_Name",
    "Country",
    "Currency",
    "Sedol",
    "FF_Mcap_MEUR",
    "Rank_Final",
    "Comment",
    "Creation_Date",
)

# Older report dialect (rows already extracted from the report tables).
LEGACY_COLUMNS = (
    "ISIN",
    "Sedol",
    "RIC",
    "Int.Key",
    "Company Name",
    "Country",
    "Currency",
    "Component",
    "FF Mcap (BEUR)",
    "Rank\n(FINAL)",
    "Rank\n(PREVIOUS\n)",
)

ENTITY_RESPONSE_TYPE = T.MapType(T.StringType(), T.StructType([T.StructField("alpha_id", T.StringType())]))
