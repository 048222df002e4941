"""Part of day from an HHMM integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive HHMM bands; everything else (also invalid
# times such as 1160-1199) is night.
DAY_PARTS = (
    ("morning", 500, 1159),
    ("afternoon", 1200, 1659),
    ("evening", 1700, 2059),
)
NIGHT = "night"


def part_of_day(c) -> Column:
    """Native CASE expression, stays inside whole-stage codegen. Null → null."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for name, lo, hi in DAY_PARTS:
        cond = col.between(lo, hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.when(col.isNotNull(), NIGHT)


def hhmm_of(ts) -> Column:
    """HHMM integer of a timestamp column (hour*100 + minute)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return (F.hour(col) * 100 + F.minute(col)).cast("int")
