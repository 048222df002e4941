"""Extreme-groups filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoincident.operators.ranking import top_k_per_group
from geoincident.session import ensure_checkpoint_dir


def extreme_values(df: DataFrame, value_col: str, k: int = 3) -> DataFrame:
    """The ``k`` highest and ``k`` lowest distinct non-null values, one column.

    The distinct values are computed once; each value is tagged for both
    ends and a ``row_number <= k`` per end keeps the extremes. Catalyst
    plans a partial WindowGroupLimit before the shuffle, so every task sends
    at most ``2k`` rows onward: nothing unbounded reaches one task or the
    driver. Result: at most ``2k`` rows.
    """
    values = df.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    ends = values.select(value_col, F.explode(F.array(F.lit(0), F.lit(1))).alias("__end"))
    order = F.when(F.col("__end") == 0, F.col(value_col)).desc_nulls_last()
    order2 = F.when(F.col("__end") == 1, F.col(value_col)).asc_nulls_last()
    kept = top_k_per_group(ends, ["__end"], [order, order2], k, "row_number", "__rank")
    return kept.select(value_col).distinct()


def filter_extreme_groups(df: DataFrame, value_col: str, k: int = 3) -> DataFrame:
    """Rows whose ``value_col`` is among the k highest or k lowest distinct
    values of ``df`` itself; every row holding such a value is kept (ties in
    one value all stay). With fewer than k distinct values all are kept.

    The value set is a sub-plan (no collect to the driver); it has at most 2k
    rows, so broadcasting it for the semi join is size-safe by construction.
    ``df`` is evaluated twice; to count the kept rows, ``count_extreme_groups``
    evaluates it once.
    """
    keep = F.broadcast(extreme_values(df, value_col, k))
    return df.join(keep, on=value_col, how="left_semi")


def count_extreme_groups(df: DataFrame, value_col: str, group_col: str, k: int = 3,
                         count_col: str = "n_rows") -> DataFrame:
    """Rows per ``group_col`` among those that ``filter_extreme_groups`` keeps.

    ``df`` (often a chain of joins) runs once: its rows are counted per value
    and group with a map-side aggregate, that table is checkpointed, and both
    the extreme values and the totals come from it. A null group stays a group.
    """
    ensure_checkpoint_dir(df.sparkSession)
    value, group = F.col(f"`{value_col}`"), F.col(f"`{group_col}`")
    counts = (df.select(value.alias("__value"), group.alias("__group")).where(F.col("__value").isNotNull())
              .groupBy("__value", "__group").agg(F.count(F.lit(1)).alias("__n")).checkpoint())
    kept = filter_extreme_groups(counts, "__value", k)
    return kept.groupBy(F.col("__group").alias(group_col)).agg(F.sum("__n").alias(count_col))
