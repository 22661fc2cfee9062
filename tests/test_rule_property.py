"""Properties of one review under the buffer rule, on any list and prior set."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from constella.operators import membership as M
from constella.schemas import IndexRule

DAY = dt.date(2031, 5, 9)


def check_review(ranked, prior, rule, got):
    """``got``: {isin: reason}.  What must hold of a review, zone by zone."""
    place = {isin: k for k, isin in enumerate(ranked, 1)}
    by = {reason: sorted((i for i in got if got[i] == reason), key=place.get)
          for reason in ("bootstrap", "top_550", "buffer_retained", "fill_to_600")}
    assert len(got) == min(rule.target, len(ranked))
    if prior is None:
        assert by["bootstrap"] == ranked[:rule.target]
        return
    assert not by["bootstrap"]
    head = min(rule.auto, len(ranked))
    assert by["top_550"] == ranked[:head]
    zone = [i for i in ranked if rule.auto < place[i] <= rule.buffer_end and i in prior]
    kept = min(len(zone), rule.target - head)
    assert by["buffer_retained"] == zone[:kept]
    rest = [i for i in ranked if i not in by["top_550"] and i not in by["buffer_retained"]]
    assert by["fill_to_600"] == rest[:max(rule.target - head - kept, 0)]


@st.composite
def cases(draw):
    sizes = sorted(draw(st.lists(st.integers(0, 11), min_size=3, max_size=3)))
    names = draw(st.permutations([f"N{x}" for x in range(17)]))[:draw(st.integers(0, 17))]
    prior = draw(st.none() | st.sets(st.sampled_from([f"N{x}" for x in range(22)])))
    return IndexRule(*sizes, 1), list(names), prior


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(cases())
def test_review_properties(spark, case):
    rule, names, prior = case
    listed = spark.createDataFrame([("Q", DAY, n, k, k) for k, n in enumerate(names, 1)],
                                   "index_name string, review_date date, isin string, rank int, ordinal bigint")
    cands = M.candidates(listed, {"Q": rule})
    if prior is None:
        out = M.apply_buffer_rule(cands, None, {"Q": rule})
    else:
        before = spark.createDataFrame([("Q", DAY, i) for i in sorted(prior)],
                                       "index_name string, review_date date, isin string")
        told = spark.createDataFrame([("Q", DAY)], "index_name string, review_date date")
        out = M.apply_buffer_rule(cands, before, {"Q": rule}, prior_reviews=told)
    check_review(names, prior, rule, {r.isin: r.entry_reason for r in out.collect()})
