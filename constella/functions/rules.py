"""Per-index rule parameters as column expressions.

Rules are driver-side configuration (one record per index), so they are
inlined as ``CASE index_name WHEN ...`` literals: no join, no broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from constella.schemas import IndexRule


def rule_col(rules: dict[str, IndexRule], field: str, index_col: str | Column = "index_name") -> Column:
    idx = F.col(index_col) if isinstance(index_col, str) else index_col
    expr = None
    for name, rule in sorted(rules.items()):
        value = F.lit(getattr(rule, field))
        expr = F.when(idx == F.lit(name), value) if expr is None else expr.when(idx == F.lit(name), value)
    if expr is None:
        raise ValueError("no rules given")
    return expr.otherwise(F.lit(None).cast("int"))


def max_rule(rules: dict[str, IndexRule], field: str) -> int:
    return max(getattr(r, field) for r in rules.values())
