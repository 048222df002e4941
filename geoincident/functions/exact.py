"""Means whose bits do not depend on the order of the rows (A3, A5).

Floating-point sums change with the order in which partial sums meet, so with
the number of partitions. Here every value is cut, without error, into whole
numbers of 2^30, 1, 2^-30 and 2^-60; those are summed exactly as decimals and
put together once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: finite values have to lie within +-2^92; what is below 2^-60 is cut off
_STEP = 2.0 ** 30


def exact_sum(col: Column | str) -> Column:
    """Sum of a column as an aggregate expression; null without values, NaN or infinite as Spark's own sum."""
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rest = F.when(finite, x) / F.lit(_STEP)
    places = []
    for _ in range(4):
        whole = rest.cast("bigint")  # towards zero, so that all places have the value's sign
        places.append(F.sum(whole.cast("decimal(20,0)")))
        rest = (rest - whole.cast("double")) * F.lit(_STEP)
    step = F.lit(int(_STEP)).cast("decimal(10,0)")
    units, parts = (((high.cast("decimal(28,0)") * step).cast("decimal(38,0)") + low).cast("double")
                    for high, low in (places[:2], places[2:]))
    odd = F.sum(F.when(~finite, x))
    return F.when(odd.isNotNull(), odd).otherwise(units + parts / F.lit(_STEP * _STEP))


def exact_mean(col: Column | str) -> Column:
    """Mean of the values that are not null, from :func:`exact_sum`."""
    n = F.count(col)
    return F.when(n > 0, exact_sum(col) / n)
