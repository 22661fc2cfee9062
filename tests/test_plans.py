"""Plan properties that matter at scale (checked on the small tables)."""

import os
import re

import pytest

from constella.operators import membership as M
from constella.plans.queries import QUERIES
from constella.sources.derive import RULES, review_entries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_candidates_limit_before_shuffle(spark):
    plan = M.candidates(review_entries(spark, SF), RULES)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", [
    "review_dates", "review_calendar", "publication_keys", "missing_periods", "match_publications", "dq_keys",
    "resolve_isin", "buffer_chain", "country_top10", "rank_events",
])
def test_no_numbering_where_no_rank_is_read(spark, name, monkeypatch):
    def numbered(*_):
        raise AssertionError(f"{name} numbers the lists")

    monkeypatch.setattr("constella.plans.book.review_entries", numbered)
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    if name in ("review_dates", "review_calendar", "publication_keys", "missing_periods", "match_publications"):
        assert "cents" not in plan and "row_number" not in plan


def test_rank_events_has_no_grid(spark):
    plan = executed(QUERIES["rank_events"](spark, SF))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_latest_entries_are_partition_pruned(spark):
    plan = executed(QUERIES["entries_at"](spark, SF))
    assert "PartitionFilters: [" in plan and "index_name" in plan.split("PartitionFilters: [")[1][:200]


@pytest.mark.parametrize("name", [
    "buffer_chain", "buffer_single", "islands", "rank_events", "ranking_daily", "rank_gaps", "enrich_ids",
    "resolve_isin", "match_publications", "mcap_histogram", "country_top10", "sel_normalise_legacy",
])
def test_no_cartesian_or_nested_loop(spark, name):
    plan = executed(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDFs
