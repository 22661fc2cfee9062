"""SQL twins of the registered queries (DuckDB dialect, base tables as views).

Each entry is one self-contained statement built from the shared CTEs below,
so the derivation of the review dataset is written once.
"""

from __future__ import annotations

import re

from constella.plans.book import AS_OF

# name -> (deps, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLE: dict[str, str] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def branch(prefix: str, names: tuple[str, ...], *replaced: str) -> None:
    """The CTEs ``names`` again under ``prefix``, reading each other's and the ``replaced`` ones' copies."""
    own = {*names, *replaced}
    for name in names:
        deps, body = CTES[name]
        cte(prefix + name, tuple(prefix + d if d in own else d for d in deps),
            re.sub(rf"\b(FROM|JOIN) ({'|'.join(sorted(own))})\b", rf"\1 {prefix}\2", body))


def build(final: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    parts = [f"{n} AS (\n{CTES[n][1].strip()}\n)" for n in order]
    return "WITH RECURSIVE\n" + ",\n".join(parts) + "\n" + final.strip()


def oracle(name: str, *needed: str):
    def deco(final: str) -> str:
        ORACLE[name] = build(final, *needed)
        return final

    return deco


# ------------------------------------------------------------------ derivation

cte(
    "rules",
    (),
    """
SELECT * FROM (VALUES ('CUST', 220, 240, 300, 100), ('PART', 550, 600, 750, 100))
  AS r(index_name, auto, target, buffer_end, check_to)
""",
)

cte(
    "listing",
    (),
    """
SELECT 'CUST' AS index_name, v.review_date, v.key, v.cents, 'C' AS prefix,
       COALESCE(c.c_acctbal >= 0, FALSE) AS eligible, c.c_acctbal >= 0 AS elig_raw
FROM (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS review_date, o_custkey AS key,
             SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
      FROM orders GROUP BY 1, 2) v
JOIN customer c ON v.key = c.c_custkey
UNION ALL
SELECT 'PART', CAST(date_trunc('quarter', l_shipdate) AS DATE), l_partkey,
       SUM(CAST(round(l_extendedprice * 100) AS BIGINT)), 'P', TRUE, TRUE
FROM lineitem GROUP BY 2, 3
""",
)

cte(
    "entries",
    ("listing",),
    """
SELECT index_name, review_date, isin, ric, ff_mcap,
       CASE WHEN eligible THEN CAST(ordinal AS INTEGER) END AS rank,
       CASE WHEN NOT elig_raw THEN 'negative balance' END AS comment,
       CAST(ordinal AS BIGINT) AS ordinal
FROM (
  SELECT l.*, 'X' || prefix || lpad(CAST(key AS VARCHAR), 10, '0') AS isin,
         prefix || CAST(key AS VARCHAR) || '.' || prefix || 'X' AS ric,
         CAST(cents AS DOUBLE) / 100.0 AS ff_mcap,
         row_number() OVER (PARTITION BY index_name, review_date
                            ORDER BY CASE WHEN eligible THEN 0 ELSE 1 END, cents DESC,
                                     'X' || prefix || lpad(CAST(key AS VARCHAR), 10, '0')) AS ordinal
  FROM listing l) t
""",
)

cte(
    "assets",
    (),
    """
SELECT 'CUST' AS index_name, 'XC' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS isin,
       lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS internal_key,
       'C' || CAST(c_custkey AS VARCHAR) || '.CX' AS ric, c_name AS name, n_name AS country,
       r_name AS currency, 'S' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS sedol
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT 'PART', 'XP' || lpad(CAST(p_partkey AS VARCHAR), 10, '0'), lpad(CAST(p_partkey AS VARCHAR), 7, '0'),
       'P' || CAST(p_partkey AS VARCHAR) || '.PX', p_name, p_brand, p_type, CAST(NULL AS VARCHAR)
FROM part
""",
)

cte("reviews", ("entries",), "SELECT DISTINCT index_name, review_date FROM entries")

cte(
    "review_k",
    ("reviews",),
    "SELECT index_name, review_date, row_number() OVER (PARTITION BY index_name ORDER BY review_date) AS k FROM reviews",
)

cte(
    "firsts",
    ("entries",),
    """
SELECT index_name, review_date, isin, arg_min(rank, ordinal) AS rank, min(ordinal) AS ordinal
FROM entries WHERE rank IS NOT NULL GROUP BY index_name, review_date, isin
""",
)

cte(
    "positions",
    ("firsts",),
    """
SELECT index_name, review_date, isin, rank,
       CAST(row_number() OVER (PARTITION BY index_name, review_date ORDER BY rank, isin) AS INTEGER) AS position
FROM firsts
""",
)

cte(
    "cands",
    ("positions", "rules"),
    """
SELECT p.index_name, p.review_date, p.isin, p.position
FROM positions p JOIN rules r USING (index_name) WHERE p.position <= r.buffer_end
""",
)

cte(
    "lists",
    ("cands", "rules"),
    """
SELECT l.*, r.auto, r.target, r.buffer_end,
       row_number() OVER (PARTITION BY l.index_name ORDER BY l.review_date) AS k
FROM (SELECT index_name, review_date, list(isin ORDER BY position) AS c
      FROM cands GROUP BY index_name, review_date) l
JOIN rules r USING (index_name)
""",
)

# The chained rule as a recursive CTE over each index's reviews.
cte(
    "chain",
    ("lists",),
    """
SELECT index_name, k, review_date,
       list_transform(c[1:target], lambda x: {'isin': x, 'reason': 'bootstrap'}) AS members
FROM lists WHERE k = 1
UNION ALL
SELECT index_name, k, review_date,
  CASE WHEN prior IS NULL
       THEN list_transform(c[1:target], lambda x: {'isin': x, 'reason': 'bootstrap'})
       ELSE list_concat(
              list_transform(top, lambda x: {'isin': x, 'reason': 'top_550'}),
              list_transform(ret, lambda x: {'isin': x, 'reason': 'buffer_retained'}),
              list_transform(list_filter(c, lambda x: NOT list_contains(list_concat(top, ret), x))
                               [1:greatest(target - len(top) - len(ret), 0)],
                             lambda x: {'isin': x, 'reason': 'fill_to_600'}))
  END AS members
FROM (
  SELECT l.index_name, l.k, l.review_date, l.c, l.target, prior, top,
         list_filter(l.c[l.auto + 1:l.buffer_end], lambda x: list_contains(prior, x))
           [1:greatest(l.target - len(top), 0)] AS ret
  FROM (SELECT ch.index_name AS ci, ch.k AS ck,
               list_transform(ch.members, lambda m: m.isin) AS prior FROM chain ch) p
  JOIN (SELECT *, c[1:auto] AS top FROM lists) l ON l.index_name = p.ci AND l.k = p.ck + 1
) s
""",
)

cte(
    "membership",
    ("chain",),
    """
SELECT index_name, review_date, m.isin AS isin, TRUE AS is_member, m.reason AS entry_reason
FROM (SELECT index_name, review_date, unnest(members) AS m FROM chain) u
""",
)

cte(
    "data_reviews",
    ("membership",),
    "SELECT DISTINCT index_name, review_date FROM membership WHERE is_member",
)

cte(
    "member_ranks",
    ("entries", "membership"),
    """
SELECT index_name, review_date, ric, COALESCE(arg_min(rank, ordinal), 0) AS rank
FROM (SELECT e.* FROM entries e
      WHERE e.ric IS NOT NULL AND EXISTS (
        SELECT 1 FROM membership m WHERE m.is_member AND m.index_name = e.index_name
          AND m.review_date = e.review_date AND m.isin = e.isin)) x
GROUP BY index_name, review_date, ric
""",
)

cte(
    "spans",
    ("data_reviews",),
    f"""
SELECT * FROM (
  SELECT index_name, review_date,
         COALESCE(CAST(lead(review_date) OVER (PARTITION BY index_name ORDER BY review_date) - INTERVAL 1 DAY AS DATE),
                  DATE '{AS_OF}') AS valid_to
  FROM data_reviews) s
WHERE review_date <= valid_to
""",
)

cte(
    "daily",
    ("member_ranks", "spans"),
    """
SELECT r.index_name, CAST(d.date AS DATE) AS date, r.ric, CAST(r.rank AS INTEGER) AS rank
FROM member_ranks r JOIN spans s USING (index_name, review_date),
     LATERAL (SELECT unnest(generate_series(s.review_date, s.valid_to, INTERVAL 1 DAY)) AS date) d
WHERE r.rank > 0
""",
)

cte(
    "tops",
    ("positions", "rules"),
    "SELECT p.* FROM positions p JOIN rules r USING (index_name) WHERE p.position <= r.target",
)

cte(
    "member_caps",
    ("entries", "membership"),
    """
SELECT m.index_name, m.review_date, m.isin, e.ff_mcap, CAST(round(e.ff_mcap * 100) AS BIGINT) AS cents
FROM membership m
JOIN (SELECT index_name, review_date, isin, arg_min(ff_mcap, ordinal) AS ff_mcap
      FROM entries WHERE ff_mcap IS NOT NULL GROUP BY ALL) e
  USING (index_name, review_date, isin)
WHERE m.is_member
""",
)

cte(
    "latest",
    ("reviews",),
    "SELECT index_name, max(review_date) AS review_date FROM reviews GROUP BY index_name",
)

cte(
    "constituents",
    ("membership", "assets"),
    """
SELECT m.index_name, m.review_date, m.isin, m.entry_reason, a.ric, a.name, a.country, a.currency
FROM membership m JOIN assets a USING (index_name, isin) WHERE m.is_member
""",
)

# -------------------------------------------------------------------- queries

oracle("positions", "positions")("SELECT * FROM positions")

cte(
    "tied_entries",
    ("entries",),
    """
SELECT index_name, review_date, isin, CAST(ceil(rank / 3.0) AS INTEGER) AS rank, ordinal FROM entries
UNION ALL
SELECT index_name, review_date, isin, 1, ordinal + 1000000000 FROM entries
WHERE CAST(substr(isin, 3, 10) AS BIGINT) % 10 = 0
""",
)
branch("tied_", ("firsts", "positions"), "entries")
oracle("listed_positions", "tied_positions")("SELECT * FROM tied_positions")

oracle("top_n", "tops")("SELECT index_name, review_date, isin, rank, position FROM tops")

oracle("buffer_single", "tops", "cands", "review_k", "rules")(
    """
, prior AS (
  SELECT t.index_name, nk.review_date, t.isin
  FROM tops t JOIN review_k k USING (index_name, review_date)
  JOIN review_k nk ON nk.index_name = k.index_name AND nk.k = k.k + 1
), has_prior AS (SELECT DISTINCT index_name, review_date FROM prior
), flagged AS (
  SELECT c.*, r.auto, r.target, r.buffer_end,
         (p.isin IS NOT NULL) AS in_prior, (h.review_date IS NOT NULL) AS has_prior,
         least(r.auto, count(*) OVER (PARTITION BY c.index_name, c.review_date)) AS n_top
  FROM cands c JOIN rules r USING (index_name)
  LEFT JOIN prior p USING (index_name, review_date, isin)
  LEFT JOIN has_prior h USING (index_name, review_date)
), buf AS (
  SELECT *, position > auto AND position <= buffer_end AND in_prior AS is_buf FROM flagged
), ret AS (
  SELECT *, is_buf AND sum(CAST(is_buf AS INTEGER)) OVER w <= target - n_top AS retained
  FROM buf WINDOW w AS (PARTITION BY index_name, review_date ORDER BY position
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), nret AS (
  SELECT *, sum(CAST(retained AS INTEGER)) OVER (PARTITION BY index_name, review_date) AS n_ret,
         position <= auto OR retained AS chosen
  FROM ret
), fill AS (
  SELECT *, NOT chosen AND sum(CAST(NOT chosen AS INTEGER)) OVER w <= target - n_top - n_ret AS fill
  FROM nret WINDOW w AS (PARTITION BY index_name, review_date ORDER BY position
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT index_name, review_date, isin, TRUE AS is_member, entry_reason FROM (
  SELECT *, CASE WHEN NOT has_prior THEN CASE WHEN position <= target THEN 'bootstrap' END
                 WHEN position <= auto THEN 'top_550'
                 WHEN retained THEN 'buffer_retained'
                 WHEN fill THEN 'fill_to_600' END AS entry_reason
  FROM fill) x
WHERE entry_reason IS NOT NULL
"""
)

oracle("buffer_chain", "membership")("SELECT * FROM membership")

# The middle review ranks nobody.
cte(
    "gap_lists",
    ("cands", "review_k", "rules"),
    """
SELECT k.index_name, k.review_date, coalesce(l.c, CAST([] AS VARCHAR[])) AS c, r.auto, r.target, r.buffer_end, k.k
FROM review_k k JOIN rules r USING (index_name)
JOIN (SELECT index_name, count(*) AS n FROM review_k GROUP BY index_name) n USING (index_name)
LEFT JOIN (SELECT index_name, review_date, list(isin ORDER BY position) AS c FROM cands GROUP BY ALL) l
  ON l.index_name = k.index_name AND l.review_date = k.review_date AND k.k <> (n.n + 1) // 2
""",
)
branch("gap_", ("chain", "membership"), "lists")
oracle("chain_empty_review", "gap_membership")("SELECT * FROM gap_membership")

oracle("members_per_review", "membership", "rules")(
    """
SELECT index_name, review_date, count(*) AS members, count(*) = max(r.target) AS full
FROM membership JOIN rules r USING (index_name) WHERE is_member GROUP BY index_name, review_date
"""
)

oracle("reason_counts", "membership")(
    "SELECT index_name, review_date, entry_reason, count(*) AS members FROM membership GROUP BY ALL"
)

oracle("ever_members", "membership")("SELECT DISTINCT index_name, isin FROM membership WHERE is_member")

oracle("constituents", "constituents")("SELECT * FROM constituents")

oracle("latest_constituents", "constituents", "latest")(
    "SELECT c.* FROM constituents c JOIN latest l USING (index_name, review_date)"
)

oracle("country_top10", "constituents", "latest")(
    """
SELECT * FROM (
  SELECT index_name, country, members,
         CAST(row_number() OVER (PARTITION BY index_name ORDER BY members DESC, country ASC NULLS LAST) AS INTEGER)
           AS place,
         count(*) OVER (PARTITION BY index_name) AS countries,
         CAST(sum(members) OVER (PARTITION BY index_name) AS BIGINT) AS total_members
  FROM (SELECT index_name, country, count(*) AS members
        FROM constituents c JOIN latest l USING (index_name, review_date) GROUP BY ALL) g) t
WHERE place <= 10
"""
)

cte(
    "intervals",
    ("membership", "review_k"),
    """
SELECT index_name, isin, min(review_date) AS first_included, max(review_date) AS last_included
FROM (SELECT m.index_name, m.isin, m.review_date,
             k.k - row_number() OVER (PARTITION BY m.index_name, m.isin ORDER BY k.k) AS island
      FROM (SELECT DISTINCT index_name, review_date, isin FROM membership WHERE is_member) m
      JOIN review_k k USING (index_name, review_date)) r
GROUP BY index_name, isin, island
""",
)

oracle("islands", "intervals")("SELECT * FROM intervals")

oracle("review_dates", "reviews")("SELECT * FROM reviews")

oracle("review_sizes", "entries")(
    "SELECT index_name, review_date, count(*) AS entries, count(rank) AS ranked FROM entries GROUP BY ALL"
)

cte(
    "rank_events",
    ("data_reviews", "member_ranks"),
    """
SELECT index_name, review_date, ric, CAST(rank AS INTEGER) AS rank FROM member_ranks
UNION ALL
SELECT m.index_name, n.next_review, m.ric, 0
FROM member_ranks m
JOIN (SELECT index_name, review_date,
             lead(review_date) OVER (PARTITION BY index_name ORDER BY review_date) AS next_review
      FROM data_reviews) n USING (index_name, review_date)
WHERE m.rank > 0 AND n.next_review IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM member_ranks k WHERE k.index_name = m.index_name AND k.review_date = n.next_review AND k.ric = m.ric)
""",
)

oracle("rank_events", "rank_events")("SELECT * FROM rank_events")
oracle("rank_events_backfilled", "rank_events")("SELECT * FROM rank_events")

oracle("ranking_daily", "daily")("SELECT * FROM daily")

oracle("ranking_at", "daily", "reviews")(
    "SELECT d.* FROM daily d WHERE EXISTS (SELECT 1 FROM reviews r WHERE r.index_name = d.index_name AND r.review_date = d.date)"
)

oracle("ranking_wide", "daily")(
    """
SELECT index_name, date, string_agg(ric || '=' || CAST(rank AS VARCHAR), ',' ORDER BY ric) AS ranks
FROM daily GROUP BY index_name, date
"""
)

oracle("rank_gaps", "daily", "reviews", "rules")(
    """
, at_review AS (
  SELECT DISTINCT d.index_name, d.date AS review_date, d.rank FROM daily d
  JOIN reviews r ON r.index_name = d.index_name AND r.review_date = d.date
), expected AS (
  SELECT r.index_name, r.review_date, unnest(generate_series(1, ru.check_to)) AS rank
  FROM reviews r JOIN rules ru USING (index_name)
), missing AS (
  SELECT index_name, review_date, count(*) AS missing,
         array_to_string(list_slice(list(rank ORDER BY rank), 1, 10), ',') AS missing_first10
  FROM (SELECT * FROM expected e WHERE NOT EXISTS (
          SELECT 1 FROM at_review a WHERE a.index_name = e.index_name AND a.review_date = e.review_date
            AND a.rank = e.rank)) x
  GROUP BY ALL
), found AS (
  SELECT index_name, review_date, count(*) AS distinct_ranks FROM at_review GROUP BY ALL
)
SELECT r.index_name, r.review_date, CAST(COALESCE(m.missing, 0) AS BIGINT) AS missing,
       COALESCE(m.missing_first10, '') AS missing_first10,
       CAST(COALESCE(f.distinct_ranks, 0) AS BIGINT) AS distinct_ranks,
       CASE WHEN f.distinct_ranks IS NULL THEN 'absent' WHEN m.missing IS NULL THEN 'passed' ELSE 'failed' END
         AS status
FROM reviews r LEFT JOIN found f USING (index_name, review_date) LEFT JOIN missing m USING (index_name, review_date)
"""
)

oracle("members_per_day", "daily")("SELECT index_name, date, count(*) AS ranked FROM daily GROUP BY ALL")

oracle("mcap_stats", "member_caps")(
    """
SELECT index_name, review_date, median(cents) / 100 AS median_mcap,
       CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS mean_mcap, max(ff_mcap) AS max_mcap
FROM member_caps GROUP BY ALL
"""
)

oracle("mcap_histogram", "member_caps")(
    """
SELECT index_name, review_date, bin, count(*) AS members FROM (
  SELECT c.index_name, c.review_date,
         CASE WHEN b.hi = b.lo THEN 1
              ELSE least(CAST(floor(CAST(c.cents - b.lo AS DOUBLE) * 50 / (b.hi - b.lo)) AS INTEGER) + 1, 50) END
           AS bin
  FROM member_caps c
  JOIN (SELECT index_name, review_date, min(cents) AS lo, max(cents) AS hi FROM member_caps GROUP BY ALL) b
    USING (index_name, review_date)) x
GROUP BY ALL
"""
)

oracle("coverage_stats", "entries", "membership")(
    """
SELECT e.*, m.member_rows, m.ever_members FROM
 (SELECT index_name, min(review_date) AS first_review, count(*) AS entries, count(DISTINCT isin) AS unique_isins,
         count(*) FILTER (WHERE rank IS NULL) AS unranked FROM entries GROUP BY index_name) e
LEFT JOIN
 (SELECT index_name, count(*) AS member_rows, count(DISTINCT isin) AS ever_members
  FROM membership WHERE is_member GROUP BY index_name) m USING (index_name)
"""
)

oracle("entries_ranked", "entries")(
    "SELECT index_name, review_date, isin, ric, ff_mcap, rank FROM entries WHERE rank IS NOT NULL"
)

oracle("dedup_first", "entries")(
    """
SELECT index_name, isin, arg_min(review_date, (review_date, ordinal)) AS review_date,
       arg_min(rank, (review_date, ordinal)) AS rank, arg_min(ff_mcap, (review_date, ordinal)) AS ff_mcap
FROM entries GROUP BY index_name, isin
"""
)

oracle("dq_rank_600", "entries", "rules")(
    """
SELECT s.index_name, s.review_date, s.entries,
       CAST(r.target - COALESCE(p.present, 0) AS BIGINT) AS missing_ranks,
       s.entries >= r.target AND r.target - COALESCE(p.present, 0) = 0 AS ok
FROM (SELECT index_name, review_date, count(*) AS entries FROM entries GROUP BY ALL) s
JOIN rules r USING (index_name)
LEFT JOIN (SELECT e.index_name, e.review_date, count(DISTINCT e.rank) AS present
           FROM entries e JOIN rules r USING (index_name)
           WHERE e.rank BETWEEN 1 AND r.target GROUP BY ALL) p USING (index_name, review_date)
"""
)

oracle("dq_keys", "entries", "assets", "reviews")(
    """
, snapshots AS (
  SELECT index_name, isin, 'current' AS snapshot FROM assets
  UNION ALL
  SELECT index_name, isin, 'previous' FROM assets WHERE CAST(internal_key AS BIGINT) % 2 = 0
  UNION ALL
  SELECT index_name, isin, 'previous' FROM assets WHERE CAST(internal_key AS BIGINT) % 10 = 0),
names AS (SELECT * FROM (SELECT DISTINCT index_name FROM reviews) r, (VALUES ('current'), ('previous')) v(snapshot))
SELECT n.index_name, n.snapshot, COALESCE(d.duplicate_isins, 0) AS duplicate_isins,
       COALESCE(o.orphan_isins, 0) AS orphan_isins
FROM names n
LEFT JOIN (SELECT index_name, snapshot, count(*) AS duplicate_isins FROM
             (SELECT index_name, snapshot, isin FROM snapshots GROUP BY ALL HAVING count(*) > 1) x GROUP BY ALL) d
  USING (index_name, snapshot)
LEFT JOIN (SELECT e.index_name, e.snapshot, count(*) AS orphan_isins FROM
             (SELECT DISTINCT e.index_name, e.isin, n.snapshot FROM entries e JOIN names n USING (index_name)) e
             WHERE NOT EXISTS (SELECT 1 FROM snapshots a WHERE a.index_name = e.index_name
                                 AND a.snapshot = e.snapshot AND a.isin = e.isin)
           GROUP BY ALL) o USING (index_name, snapshot)
"""
)

cte(
    "entries_ric",
    ("entries", "assets"),
    """
SELECT e.index_name, e.review_date, e.isin, e.ff_mcap, e.rank, e.comment, e.ordinal, a.ric
FROM entries e LEFT JOIN (SELECT index_name, isin, min(ric) AS ric FROM assets GROUP BY ALL) a
  USING (index_name, isin)
""",
)

oracle("entries_with_ric", "entries_ric")("SELECT * FROM entries_ric")
oracle("write_roundtrip", "entries_ric")("SELECT * FROM entries_ric")
oracle("entries_at", "entries_ric", "latest")(
    "SELECT e.* FROM entries_ric e JOIN latest l USING (index_name, review_date)"
)
oracle("membership_at", "membership", "latest")(
    "SELECT m.* FROM membership m JOIN latest l USING (index_name, review_date)"
)
oracle("assets_snapshot", "assets")("SELECT * FROM assets")
oracle("index_catalog", "reviews")(
    """
SELECT index_name, count(*) AS reviews, min(review_date) AS first_review, max(review_date) AS latest_review
FROM reviews GROUP BY index_name
"""
)
oracle("published_constituents", "membership", "latest", "assets")(
    """
SELECT m.*, a.ric, a.name, a.country, a.currency
FROM membership m JOIN latest l USING (index_name, review_date)
JOIN (SELECT index_name, isin, arg_min(ric, (ric, name, country, currency)) AS ric,
             arg_min(name, (ric, name, country, currency)) AS name,
             arg_min(country, (ric, name, country, currency)) AS country,
             arg_min(currency, (ric, name, country, currency)) AS currency
      FROM assets GROUP BY ALL) a USING (index_name, isin)
WHERE m.is_member
"""
)

# ------------------------------------------------------------------ resolution

cte(
    "history",
    ("assets",),
    """
SELECT index_name, internal_key, 'XO' || substr(isin, 3, 10) AS isin,
       CAST(internal_key AS BIGINT) * 4 AS ordinal
FROM assets WHERE CAST(internal_key AS BIGINT) % 7 = 0
UNION ALL
SELECT index_name,
       CASE WHEN CAST(internal_key AS BIGINT) % 13 = 0 THEN ' ' || internal_key || ' ' ELSE internal_key END,
       CASE WHEN CAST(internal_key AS BIGINT) % 3 = 0 THEN 'KEY_' || internal_key ELSE isin END,
       CAST(internal_key AS BIGINT) * 4 + 1
FROM assets
UNION ALL
SELECT index_name, internal_key, '  ', CAST(internal_key AS BIGINT) * 4 + 2
FROM assets WHERE CAST(internal_key AS BIGINT) % 11 = 0
""",
)

cte(
    "lookup",
    ("history",),
    """
SELECT index_name, trim(internal_key) AS internal_key, arg_max(trim(isin), ordinal) AS isin
FROM history
WHERE internal_key IS NOT NULL AND internal_key <> '' AND isin IS NOT NULL AND trim(isin) <> ''
  AND NOT starts_with(isin, 'KEY_')
GROUP BY index_name, trim(internal_key)
""",
)

oracle("isin_lookup", "lookup")("SELECT * FROM lookup")

oracle("resolve_isin", "entries", "assets", "lookup")(
    """
SELECT r.index_name, r.review_date, r.internal_key, r.raw_isin,
       CASE WHEN r.raw_isin IS NOT NULL AND lower(trim(r.raw_isin)) NOT IN ('', 'null', 'none') THEN trim(r.raw_isin)
            ELSE COALESCE(l.isin, 'KEY_' || r.internal_key) END AS isin
FROM (SELECT e.index_name, e.review_date, trim(a.internal_key) AS internal_key,
             CASE WHEN CAST(a.internal_key AS BIGINT) % 17 = 0 THEN ''
                  WHEN CAST(a.internal_key AS BIGINT) % 19 = 0 THEN 'null'
                  WHEN CAST(a.internal_key AS BIGINT) % 23 = 0 THEN ' None'
                  WHEN CAST(a.internal_key AS BIGINT) % 29 = 0 THEN 'NULL '
                  ELSE e.isin END AS raw_isin
      FROM entries e JOIN assets a USING (index_name, isin)) r
LEFT JOIN lookup l USING (index_name, internal_key)
"""
)

cte(
    "entities",
    ("assets",),
    """
SELECT index_name, 'isin' AS endpoint, isin AS id,
       'E' || lpad(CAST(CAST(internal_key AS BIGINT) AS VARCHAR), 9, '0') AS alpha_id
FROM assets WHERE CAST(internal_key AS BIGINT) % 4 <> 0
UNION ALL
SELECT index_name, 'ric', ric, 'E' || lpad(CAST(CAST(internal_key AS BIGINT) AS VARCHAR), 9, '0')
FROM assets WHERE CAST(internal_key AS BIGINT) % 3 = 0
""",
)

oracle("unnest_entities", "entities")("SELECT * FROM entities")

cte(
    "metadata",
    ("assets",),
    """
SELECT index_name, isin,
       arg_min(internal_key, (src, rw)) AS internal_key, arg_min(ric, (src, rw)) AS ric,
       arg_min(name, (src, rw)) AS name, arg_min(country, (src, rw)) AS country,
       arg_min(currency, (src, rw)) AS currency, arg_min(sedol, (src, rw)) AS sedol
FROM (
  SELECT index_name, isin, internal_key, ric, upper(name) AS name, country, currency, sedol,
         0 AS src, CAST(internal_key AS BIGINT) * 2 AS rw
  FROM assets WHERE CAST(internal_key AS BIGINT) % 2 = 0
  UNION ALL
  SELECT index_name, isin, internal_key, ric, 'DUPLICATE', country, currency, sedol,
         0, CAST(internal_key AS BIGINT) * 2 + 1
  FROM assets WHERE CAST(internal_key AS BIGINT) % 10 = 0
  UNION ALL
  SELECT index_name, isin, internal_key, ric, name, country, currency, sedol, 1, 0 FROM assets
) u
GROUP BY index_name, isin
""",
)

cte(
    "merged",
    ("intervals", "metadata"),
    "SELECT i.*, m.internal_key, m.ric, m.name, m.country, m.currency, m.sedol FROM intervals i LEFT JOIN metadata m USING (index_name, isin)",
)

cte(
    "enriched",
    ("merged", "entities"),
    """
SELECT m.*, COALESCE(bi.alpha_id, br.alpha_id) AS entity_id
FROM merged m
LEFT JOIN (SELECT index_name, id AS isin, min(alpha_id) AS alpha_id FROM entities WHERE endpoint = 'isin' GROUP BY ALL) bi
  USING (index_name, isin)
LEFT JOIN (
  SELECT p.index_name, p.isin, arg_min(r.alpha_id, p.ric) AS alpha_id
  FROM (SELECT DISTINCT index_name, isin, ric FROM merged m2
        WHERE ric IS NOT NULL AND ric <> ''
          AND NOT EXISTS (SELECT 1 FROM entities e WHERE e.endpoint = 'isin' AND e.index_name = m2.index_name
                            AND e.id = m2.isin)) p
  JOIN (SELECT index_name, id AS ric, min(alpha_id) AS alpha_id FROM entities WHERE endpoint = 'ric' GROUP BY ALL) r
    USING (index_name, ric)
  GROUP BY p.index_name, p.isin) br USING (index_name, isin)
""",
)

oracle("merge_assets", "merged")("SELECT * FROM merged")
oracle("enrich_ids", "enriched")("SELECT * FROM enriched")
oracle("enrich_counts", "merged", "enriched", "entities")(
    """
, seen AS (
  SELECT entity_id, EXISTS (SELECT 1 FROM entities x WHERE x.endpoint = 'isin' AND x.index_name = e.index_name
                              AND x.id = e.isin) AS by_isin FROM enriched e)
SELECT (SELECT count(*) FROM merged) AS rows_before, count(*) AS rows_after, count(*) FILTER (by_isin) AS by_isin,
       count(*) FILTER (NOT by_isin AND entity_id IS NOT NULL) AS by_ric,
       count(*) FILTER (entity_id IS NULL) AS unresolved
FROM seen
"""
)
oracle("semi_unresolved", "merged", "entities")(
    """
SELECT index_name, isin, ric FROM merged m
WHERE NOT EXISTS (SELECT 1 FROM entities e WHERE e.endpoint = 'isin' AND e.index_name = m.index_name AND e.id = m.isin)
"""
)
oracle("unresolved_report", "enriched")(
    """
SELECT index_name, isin, arg_min(ric, (first_included, ric)) AS ric, arg_min(name, (first_included, ric)) AS name,
       arg_min(country, (first_included, ric)) AS country, arg_min(currency, (first_included, ric)) AS currency,
       CAST(min(first_included) AS VARCHAR) AS first_included,
       CAST(arg_min(last_included, (first_included, ric)) AS VARCHAR) AS last_included
FROM enriched WHERE entity_id IS NULL GROUP BY index_name, isin
"""
)
oracle("ric_backfill", "entries_ric")("SELECT index_name, review_date, isin, ric, rank FROM entries_ric")

# -------------------------------------------------------------------- calendar

cte(
    "periods",
    ("reviews",),
    f"""
SELECT s.index_name, CAST(t.y AS INTEGER) AS year, CAST(u.m AS INTEGER) AS month,
       make_date(CAST(t.y AS INTEGER), CAST(u.m AS INTEGER), 1) AS period_date
FROM (SELECT index_name, min(review_date) AS start, DATE '{AS_OF}' AS "end" FROM reviews GROUP BY index_name) s,
     LATERAL (SELECT unnest(generate_series(year(s.start), year(s."end"))) AS y) t,
     LATERAL (SELECT unnest(CASE WHEN t.y = 1995 THEN [4, 7, 10] ELSE [1, 4, 7, 10] END) AS m) u
WHERE make_date(CAST(t.y AS INTEGER), CAST(u.m AS INTEGER), 1) >= CAST(date_trunc('month', s.start) AS DATE)
  AND make_date(CAST(t.y AS INTEGER), CAST(u.m AS INTEGER), 1) <= s."end"
""",
)

oracle("review_calendar", "periods")("SELECT * FROM periods")

oracle("publication_keys", "periods")(
    """
SELECT *, CASE WHEN period_date >= DATE '1999-12-01' THEN 'csv' ELSE 'legacy' END AS dialect,
       CAST(year AS VARCHAR) || '/' || strftime(period_date, '%B') AS folder,
       CASE WHEN period_date >= DATE '1999-12-01'
            THEN 'slpublic_' || lower(index_name) || '_' || strftime(period_date, '%Y%m%d') || '.csv'
            ELSE 'sl_' || lower(index_name) || '_' || strftime(period_date, '%Y%m') || '.pdf' END AS file_key
FROM periods
"""
)

cte(
    "search_windows",
    ("periods",),
    """
SELECT *, CAST(period_date + to_months(CASE WHEN is_csv AND nq > month THEN nq - month ELSE 1 END) AS DATE) AS window_end
FROM (
  SELECT p.*, period_date >= DATE '1999-12-01' AS is_csv,
         CASE WHEN month < 3 THEN 3 WHEN month < 6 THEN 6 WHEN month < 9 THEN 9 WHEN month < 12 THEN 12 ELSE 3 END AS nq
  FROM periods p) w
""",
)
cte(
    "late_reviews",
    ("reviews",),
    """
SELECT index_name, CAST(review_date + to_months(CASE month(review_date) WHEN 4 THEN 1 WHEN 10 THEN 2 ELSE 0 END) AS DATE)
         AS review_date
FROM reviews
""",
)


def _open_periods(published: str) -> str:
    return f"""
SELECT p.* FROM periods p WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT r.index_name, max(w.period_date) AS closed FROM ({published}) r JOIN search_windows w
                   ON w.index_name = r.index_name AND r.review_date >= w.period_date AND r.review_date < w.window_end
                 GROUP BY r.index_name, r.review_date) c
  WHERE c.index_name = p.index_name AND c.closed = p.period_date)
"""


oracle("missing_periods", "periods", "reviews", "search_windows")(
    _open_periods("SELECT * FROM reviews WHERE review_date < DATE '2000-01-01'"))
oracle("missing_periods_late", "periods", "late_reviews", "search_windows")(_open_periods("SELECT * FROM late_reviews"))
oracle("period_of_review", "late_reviews", "search_windows")(
    """
SELECT r.index_name, r.review_date, max(w.period_date) AS period_date
FROM late_reviews r LEFT JOIN search_windows w
  ON w.index_name = r.index_name AND r.review_date >= w.period_date AND r.review_date < w.window_end
GROUP BY ALL
"""
)

oracle("match_publications", "search_windows")(
    """
, pubs AS (
  SELECT 'CUST' AS index_name, CAST(o_orderdate AS DATE) AS pub_date FROM orders
  UNION ALL SELECT 'PART', CAST(l_shipdate AS DATE) FROM lineitem
), hits AS (
  SELECT w.index_name, w.period_date, min(pb.pub_date) AS pub_date
  FROM search_windows w JOIN pubs pb ON pb.index_name = w.index_name AND pb.pub_date >= w.period_date
   AND pb.pub_date < w.window_end
  GROUP BY ALL
)
SELECT w.index_name, w.year, w.month, w.period_date, h.pub_date,
       CASE WHEN w.is_csv THEN 'csv' ELSE 'legacy' END AS dialect,
       CASE WHEN h.pub_date IS NOT NULL THEN
         CASE WHEN w.is_csv THEN CAST(year(h.pub_date) AS VARCHAR) || '/' || strftime(h.pub_date, '%B')
              ELSE CAST(w.year AS VARCHAR) || '/' || strftime(w.period_date, '%B') END END AS folder,
       CASE WHEN h.pub_date IS NOT NULL THEN
         CASE WHEN w.is_csv THEN 'slpublic_' || lower(w.index_name) || '_' || strftime(h.pub_date, '%Y%m%d') || '.csv'
              ELSE 'sl_' || lower(w.index_name) || '_' || strftime(w.period_date, '%Y%m') || '.pdf' END END AS file_key,
       CASE WHEN h.pub_date IS NOT NULL THEN 'downloaded' ELSE 'missed' END AS status
FROM search_windows w LEFT JOIN hits h USING (index_name, period_date)
"""
)

# ------------------------------------------------------------- list dialects

cte(
    "sel_rows",
    ("entries", "assets"),
    """
SELECT e.index_name, e.review_date, e.ordinal, a.internal_key, a.ric, a.name, a.country, a.currency, a.sedol,
       e.ff_mcap, e.rank, e.comment,
       CASE WHEN CAST(a.internal_key AS BIGINT) % 17 = 0 THEN ''
            WHEN CAST(a.internal_key AS BIGINT) % 19 = 0 THEN 'null'
            WHEN CAST(a.internal_key AS BIGINT) % 23 = 0 THEN ' None'
            WHEN CAST(a.internal_key AS BIGINT) % 29 = 0 THEN 'NULL '
            ELSE e.isin END AS raw_isin
FROM entries e JOIN assets a USING (index_name, isin)
""",
)

cte(
    "csv_rows",
    ("sel_rows", "lookup"),
    """
SELECT r.index_name, 'slpublic_' || lower(r.index_name) || '_' || strftime(r.review_date, '%Y%m%d') || '.csv' AS file,
       r.review_date, trim(r.internal_key) AS internal_key,
       CASE WHEN r.raw_isin IS NOT NULL AND lower(trim(r.raw_isin)) NOT IN ('', 'null', 'none') THEN trim(r.raw_isin)
            ELSE COALESCE(l.isin, 'KEY_' || trim(r.internal_key)) END AS isin,
       trim(r.ric) AS ric, trim(r.name) AS name, trim(r.country) AS country, trim(r.currency) AS currency,
       nullif(trim(r.sedol), '') AS sedol, r.ff_mcap, r.rank, nullif(trim(r.comment), '') AS comment
FROM sel_rows r LEFT JOIN lookup l ON l.index_name = r.index_name AND l.internal_key = trim(r.internal_key)
""",
)

cte(
    "legacy_rows",
    ("sel_rows",),
    """
SELECT index_name, 'sl_' || lower(index_name) || '_' || strftime(review_date, '%Y%m') || '.pdf' AS file,
       review_date, internal_key, trim(raw_isin) AS isin, trim(ric) AS ric, trim(name) AS name,
       trim(country) AS country, trim(currency) AS currency, nullif(trim(sedol), '') AS sedol,
       CAST(CAST(cents // 100000 AS VARCHAR) || '.' || lpad(CAST(cents % 100000 AS VARCHAR), 5, '0') AS DOUBLE) * 1000
         AS ff_mcap,
       rank, ordinal
FROM (SELECT *, CAST(round(ff_mcap * 100) AS BIGINT) AS cents FROM sel_rows) r
WHERE trim(COALESCE(raw_isin, '')) <> ''
""",
)

_LIST = "index_name, review_date, internal_key, isin, ric, name, country, currency, sedol, ff_mcap, rank"
oracle("sel_normalise", "csv_rows")(f"SELECT {_LIST}, comment FROM csv_rows")
oracle("sel_assets", "csv_rows")(
    """
SELECT index_name, file, internal_key, isin, ric,
       CASE WHEN CAST(internal_key AS BIGINT) % 10 = 0 THEN 'EARLIER' ELSE name END AS name, country, currency, sedol
FROM csv_rows
"""
)
oracle("dq_review_date", "csv_rows")(
    """
SELECT index_name, file, count(DISTINCT d) AS review_dates, count(DISTINCT d) = 1 AS ok
FROM (SELECT index_name, file,
             CASE WHEN CAST(internal_key AS BIGINT) % 499 = 0 THEN DATE '1900-01-01' ELSE review_date END AS d
      FROM csv_rows) x
GROUP BY ALL
"""
)
oracle("sel_normalise_legacy", "legacy_rows")(f"SELECT {_LIST} FROM legacy_rows")
oracle("header_dates", "sel_rows")(
    """
SELECT DISTINCT index_name, 'sl_' || lower(index_name) || '_' || strftime(review_date, '%Y%m') || '.pdf' AS file,
       review_date
FROM sel_rows
"""
)
oracle("norm_names", "sel_rows")(
    r"""
SELECT f.index_name, f.file, CAST(h.position AS INTEGER) AS position, h.raw,
       regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(h.raw),
         '^\s+|\s+$', '', 'g'), '[()\[\]]+', '', 'g'), '[\s\-\.]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g')
         AS name
FROM (SELECT DISTINCT index_name, 'sl_' || lower(index_name) || '_' || strftime(review_date, '%Y%m') || '.pdf' AS file
      FROM sel_rows) f,
     (SELECT * FROM (VALUES (0, 'ISIN'), (1, 'Sedol'), (2, 'RIC'), (3, 'Int.Key'), (4, 'Company Name'),
                            (5, 'Country'), (6, 'Currency'), (7, 'Component'), (8, 'FF Mcap (BEUR)'),
                            (9, 'Rank' || chr(10) || '(FINAL)'),
                            (10, 'Rank' || chr(10) || '(PREVIOUS' || chr(10) || ')')) t(position, raw)) h
"""
)
oracle("sel_union_dialects", "csv_rows", "legacy_rows")(
    """
SELECT index_name, review_date, isin, ff_mcap, rank, 'csv' AS dialect FROM csv_rows
WHERE review_date >= DATE '1999-12-01'
UNION ALL
SELECT index_name, review_date, isin, ff_mcap, rank, 'legacy' FROM legacy_rows WHERE review_date < DATE '1999-12-01'
"""
)
for _name in ("sel_normalise", "sel_assets", "dq_review_date", "sel_normalise_legacy", "header_dates", "norm_names"):
    ORACLE[f"{_name}_whole"] = ORACLE[_name]

oracle("sel_quoted", "csv_rows")(
    f"""
SELECT {_LIST}, nullif(trim(CASE WHEN quarter(review_date) % 2 = 1 THEN comment
  WHEN CAST(internal_key AS BIGINT) % 5 = 0
    THEN 'first; "quoted"' || chr(10) || 'second; line ' || internal_key
  WHEN CAST(internal_key AS BIGINT) % 5 = 1 THEN 'a;b ""c""' ELSE comment END), '') AS comment
FROM csv_rows
"""
)
oracle("sel_assets_legacy", "legacy_rows")(
    """
SELECT index_name, file, isin, arg_min(internal_key, ordinal) AS internal_key, arg_min(ric, ordinal) AS ric,
       arg_min(name, ordinal) AS name, arg_min(country, ordinal) AS country, arg_min(currency, ordinal) AS currency,
       first(sedol ORDER BY ordinal) AS sedol
FROM legacy_rows GROUP BY index_name, file, isin
"""
)
oracle("list_rejects", "sel_rows")(
    """
, r AS (
  SELECT *, CAST(internal_key AS BIGINT) AS key, CAST((ordinal - 1) // 40 + 1 AS BIGINT) AS page,
    'slpublic_' || lower(index_name) || '_' || strftime(review_date, '%Y%m%d') || '.csv' AS file,
    'sl_' || lower(index_name) || '_' || strftime(review_date, '%Y%m') || '.pdf' AS report
  FROM sel_rows)
SELECT index_name, file, CAST(ordinal AS BIGINT) AS ordinal, 'rank' AS reason, 'n/a' AS value FROM r WHERE key % 53 = 0
UNION ALL SELECT index_name, file, ordinal, 'mcap', '1,5' FROM r WHERE key % 59 = 0
UNION ALL SELECT index_name, file, ordinal, 'date', ' ' FROM r WHERE key % 61 = 0
UNION ALL SELECT index_name, file, ordinal, 'identifier', nullif(raw_isin, '') FROM r
  WHERE key % 34 = 0 AND lower(trim(coalesce(raw_isin, ''))) IN ('', 'null', 'none')
UNION ALL SELECT DISTINCT index_name, report, page * 1000000 + 999, 'width', '1' FROM r
UNION ALL SELECT index_name, report, page * 1000000 + (ordinal - 1) % 40 + 1, 'identifier', internal_key FROM r
  WHERE trim(coalesce(raw_isin, '')) = ''
"""
)
oracle("same_date_lists", "sel_rows")(
    """
SELECT index_name, review_date, 1 + max(CASE WHEN ordinal % 2 = 0 OR ordinal % 5 = 0 THEN 1 ELSE 0 END) AS files,
       count(*) + count(*) FILTER (again) AS rows,
       count(rank) + count(*) FILTER (again AND rank IS NULL) AS ranked,
       CAST(sum(rank) + count(*) FILTER (again AND rank IS NULL) AS BIGINT) AS rank_sum
FROM (SELECT *, ordinal % 2 = 1 AND ordinal % 5 = 0 AS again FROM sel_rows) r GROUP BY ALL
"""
)

# ----------------------------------------------------------------- incremental

# Each row with the ISIN that its run published: its own text, else what an earlier run knew of its key.
cte(
    "sync_entries",
    ("entries", "assets"),
    """
SELECT w.index_name, w.review_date, w.ric, w.rank, w.ordinal, w.internal_key, w.name, w.country, w.currency,
       nullif(trim(w.sedol), '') AS sedol,
       CASE WHEN NOT blank THEN w.isin
            WHEN EXISTS (SELECT 1 FROM (SELECT index_name, isin, min(wave) AS wave FROM
                (SELECT index_name, isin, review_date, CASE WHEN review_date < DATE '1997-01-01' THEN 1
                   WHEN review_date < DATE '1999-12-01' THEN 2 WHEN review_date = DATE '2000-04-01' THEN 4 ELSE 3 END
                   AS wave FROM entries) x
                WHERE (CAST(substr(isin, 3, 10) AS BIGINT) + year(review_date) * 4 + quarter(review_date)) % 7 <> 0
                GROUP BY ALL) known
              WHERE known.index_name = w.index_name AND known.isin = w.isin AND known.wave < w.wave) THEN w.isin
            ELSE 'KEY_' || w.internal_key END AS isin
FROM (
  SELECT e.index_name, e.review_date, e.rank, e.ordinal, e.isin, a.ric, a.internal_key, a.name, a.country, a.currency,
         a.sedol, (CAST(a.internal_key AS BIGINT) + year(e.review_date) * 4 + quarter(e.review_date)) % 7 = 0 AS blank,
         CASE WHEN e.review_date < DATE '1997-01-01' THEN 1 WHEN e.review_date < DATE '1999-12-01' THEN 2
              WHEN e.review_date = DATE '2000-04-01' THEN 4 ELSE 3 END AS wave
  FROM entries e JOIN assets a USING (index_name, isin)) w
WHERE NOT (blank AND review_date < DATE '1999-12-01')
""",
)
branch("sync_", ("firsts", "positions", "cands", "lists", "chain", "membership", "data_reviews", "member_ranks", "spans",
                 "daily", "intervals"), "entries")
oracle("incremental_sync", "sync_membership")("SELECT * FROM sync_membership")
oracle("incremental_intervals", "sync_intervals", "sync_entries", "entities")(
    """
SELECT i.*, a.internal_key, a.ric, a.name, a.country, a.currency, a.sedol,
       coalesce(bi.alpha_id, br.alpha_id) AS entity_id
FROM sync_intervals i
LEFT JOIN (SELECT DISTINCT index_name, isin, internal_key, ric, name, country, currency, sedol FROM sync_entries) a
  USING (index_name, isin)
LEFT JOIN entities bi ON bi.endpoint = 'isin' AND bi.index_name = i.index_name AND bi.id = i.isin
LEFT JOIN entities br ON br.endpoint = 'ric' AND br.index_name = i.index_name AND br.id = a.ric
"""
)
oracle("incremental_ranking", "sync_daily", "reviews")(
    """
SELECT d.* FROM sync_daily d
WHERE EXISTS (SELECT 1 FROM reviews r WHERE r.index_name = d.index_name AND r.review_date = d.date)
"""
)
# The whole chain of the corrected lists, from the first review on: the middle review's candidates are
# reversed, and the chain's statements are the same with other names.
cte(
    "corrected_cands",
    ("cands", "review_k"),
    """
SELECT c.index_name, c.review_date, c.isin,
       CASE WHEN k.k = (n.n + 1) // 2
            THEN max(c.position) OVER (PARTITION BY c.index_name, c.review_date) + 1 - c.position
            ELSE c.position END AS position
FROM cands c JOIN review_k k USING (index_name, review_date)
JOIN (SELECT index_name, count(*) AS n FROM review_k GROUP BY index_name) n USING (index_name)
""",
)
branch("corrected_", ("lists", "chain", "membership"), "cands")
oracle("backfill_chain", "corrected_membership")("SELECT * FROM corrected_membership")

oracle("member_dates", "membership")(
    """
SELECT index_name, isin, list(review_date ORDER BY review_date) AS member_dates
FROM (SELECT DISTINCT index_name, isin, review_date FROM membership WHERE is_member) m GROUP BY ALL
"""
)
oracle("prior_members", "membership", "review_k")(
    """
SELECT m.index_name, m.isin FROM membership m JOIN review_k k USING (index_name, review_date)
WHERE m.is_member AND k.k = (SELECT max(k2.k) - 1 FROM review_k k2 WHERE k2.index_name = k.index_name)
"""
)

oracle("published_islands", "intervals")("SELECT * FROM intervals")
oracle("published_ranking_at", "daily", "reviews")(
    "SELECT d.* FROM daily d WHERE EXISTS (SELECT 1 FROM reviews r WHERE r.index_name = d.index_name AND r.review_date = d.date)"
)
