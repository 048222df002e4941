"""Top-k per group."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_FUNCTIONS = {
    "row_number": F.row_number,
    "rank": F.rank,
    "dense_rank": F.dense_rank,
}


def top_k_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
                    k: int, method: str = "row_number", rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of every group under ``order_by``.

    ``order_by`` should be a total order (add a tie-break column) so that
    ``row_number`` is deterministic. The filter on the rank lets Catalyst put
    a ``WindowGroupLimit`` before the shuffle: every task ships at most ``k``
    rows per group, so a hot group does not flood one reducer.
    """
    if method not in RANK_FUNCTIONS:
        raise ValueError(f"method must be one of {sorted(RANK_FUNCTIONS)}")
    if k < 1:
        raise ValueError("k must be >= 1")
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return (df.withColumn(rank_col, RANK_FUNCTIONS[method]().over(w))
            .filter(F.col(rank_col) <= k))
