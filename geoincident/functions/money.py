"""Money text → integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_PATTERN = r"^\$([0-9][0-9,]*)$"


def parse_money(c) -> Column:
    """``"$33,887"`` → 33887 (bigint). Text of any other shape (``---``,
    ``No 2021 estimate ...``) → null instead of failing the task."""
    col = F.col(c) if isinstance(c, str) else c
    digits = F.regexp_replace(F.regexp_extract(col, MONEY_PATTERN, 1), ",", "")
    return F.when(digits != "", digits.try_cast("bigint"))
