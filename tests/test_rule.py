"""Buffer rule over chains of reviews, held to the properties of single reviews."""

import datetime as dt
import random

from constella.operators import membership as M
from constella.schemas import DEFAULT_RULE, IndexRule
from tests.test_rule_property import check_review

LISTED = "index_name string, review_date date, isin string, rank int, ordinal bigint"
SMALL = IndexRule(auto=8, target=10, buffer_end=14, check_to=5)


def day(q):
    return dt.date(2010 + q // 2, 2 + 6 * (q % 2), 11)


def listing(spark, reviews, name="Q"):
    return spark.createDataFrame([(name, day(q), n, k, k) for q, names in enumerate(reviews)
                                  for k, n in enumerate(names, 1)], LISTED)


def by_review(out):
    got = {}
    for r in out.collect():
        got.setdefault(r.review_date, {})[r.isin] = r.entry_reason
    return got


def check_chain(reviews, rule, got, prior=None):
    for q, names in enumerate(reviews):
        check_review(names, prior, rule, got.get(day(q), {}))
        prior = set(got.get(day(q), {}))


def test_published_sizes(spark):
    rng = random.Random(11)
    reviews = [[f"S{x}" for x in sorted(range(1100), key=lambda x: x + rng.gauss(0, 90))] for _ in range(4)]
    got = by_review(M.chain_membership(M.candidates(listing(spark, reviews), {"Q": DEFAULT_RULE}), {"Q": DEFAULT_RULE}))
    check_chain(reviews, DEFAULT_RULE, got)
    assert {len(m) for m in got.values()} == {600}
    assert any("buffer_retained" in m.values() for m in got.values())


def test_random_chains_and_empty_reviews(spark):
    rng = random.Random(5)
    reviews = [rng.sample([f"S{x}" for x in range(40)], rng.randint(5, 30)) for _ in range(10)]
    reviews[4] = []  # no ranked row: no members, and the next review has an empty prior
    all_days = spark.createDataFrame([("Q", day(q)) for q in range(10)], "index_name string, review_date date")
    out = M.chain_membership(M.candidates(listing(spark, reviews), {"Q": SMALL}), {"Q": SMALL}, reviews=all_days)
    got = by_review(out)
    check_chain(reviews, SMALL, got)
    assert day(4) not in got and "bootstrap" not in got[day(5)].values()


def test_indexes_are_independent(spark):
    a, b = [["x", "y", "z"]] * 2, [["z", "y"], ["y", "x"]]
    rules = {"A": IndexRule(1, 2, 3, 1), "B": IndexRule(0, 1, 2, 1)}
    out = M.chain_membership(M.candidates(listing(spark, a, "A").union(listing(spark, b, "B")), rules), rules)
    rows = {(r.index_name, r.review_date, r.isin, r.entry_reason) for r in out.collect()}
    assert ("B", day(1), "x", "fill_to_600") not in rows and ("B", day(1), "y", "fill_to_600") in rows
    assert ("A", day(1), "y", "buffer_retained") in rows


def test_rechain_equals_full_chain(spark):
    rng = random.Random(6)
    reviews = [rng.sample([f"S{x}" for x in range(30)], 25) for _ in range(6)]
    rules = {"Q": SMALL}
    old = M.chain_membership(M.candidates(listing(spark, reviews), rules), rules)
    reviews[3] = list(reversed(reviews[3]))  # a corrected list in the middle
    cands = M.candidates(listing(spark, reviews), rules)
    since = spark.createDataFrame([("Q", day(3))], "index_name string, review_date date")
    got = by_review(M.rechain_from(cands, old, since, rules))
    assert got == by_review(M.chain_membership(cands, rules)) != by_review(old)
    check_chain(reviews, SMALL, got)


def test_ties_repeats_and_rows_without_rank_or_isin(spark):
    rows = [("Q", day(0), "b", 1, 1), ("Q", day(0), "a", 1, 2), ("Q", day(0), "a", 0, 3), ("Q", day(0), "c", None, 4),
            ("Q", day(0), None, 2, 5)]
    got = {r.isin: (r.rank, r.position) for r in M.positions(spark.createDataFrame(rows, LISTED)).collect()}
    assert got == {"a": (1, 1), "b": (1, 2)}


def test_top_n_beyond_the_window_limit(spark):
    df = listing(spark, [[f"S{x:04d}" for x in range(2600)]])
    assert sorted(r.position for r in M.top_n(df, 1500, salts=7).collect()) == list(range(1, 1501))
