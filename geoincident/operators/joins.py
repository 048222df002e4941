"""Joins with a chosen physical strategy (J1-J9) and plan inspection."""

from __future__ import annotations

import contextlib
import io
import re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRATEGIES = (None, "broadcast", "merge", "shuffle_hash", "skew")

# Upper bounds for the size checks (rows). A broadcast side is counted first
# and only broadcast below the bound; above it the planner's shuffle join
# (plus AQE's runtime conversion) is used instead.
MAX_BROADCAST_ROWS = 2_000_000
# ... and only if rows x estimated row width stays below this many bytes.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# Conservative widths per column type (bytes); unknown / variable types 64.
_TYPE_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4,
               "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8}

# Pieces of a heavy key per even share of the rows
PIECES = 8

_JOIN_NODES = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
               "CartesianProduct", "BroadcastNestedLoopJoin")


def estimated_row_bytes(df: DataFrame) -> int:
    """Upper-end width of one row from the schema (plus row overhead)."""
    return 16 + sum(_TYPE_WIDTH.get(t, 64) for _, t in df.dtypes)


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      rows: int | None = None,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only if its row count (counted, or ``rows`` when the
    caller already knows it) is <= ``max_rows`` and rows x estimated row
    width <= ``max_bytes``. Otherwise the frame is returned unhinted and the
    join shuffles. Returns the frame and whether the hint was applied."""
    n = df.count() if rows is None else rows
    if n <= max_rows and n * estimated_row_bytes(df) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def join_with_strategy(left: DataFrame, right: DataFrame, on, how: str = "inner",
                       strategy: str | None = None,
                       max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                       strict: bool = False) -> DataFrame:
    """``left.join(right, on, how)`` with a strategy hint on the right side.

    * ``None``: planner's choice (with AQE this already broadcasts a side
      that turns out small at run time).
    * ``"broadcast"``: right side broadcast after a row-count check; above
      ``max_broadcast_rows`` the planner's choice is kept, or with
      ``strict`` an error says that the side is too large.
    * ``"merge"`` / ``"shuffle_hash"``: sort-merge / shuffled hash join.
    * ``"skew"``: :func:`skew_join`; ``on`` has to name the columns.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy == "skew":
        names = [on] if isinstance(on, str) else list(on) if isinstance(on, (list, tuple)) else None
        if names is None or not all(isinstance(n, str) for n in names):
            raise ValueError("strategy 'skew' needs the names of the columns to join on")
        own = right.withColumnsRenamed({n: f"__right_{n}" for n in names})
        return skew_join(left, own, names, [f"__right_{n}" for n in names], how).drop(*[f"__right_{n}" for n in names])
    if strategy == "broadcast":
        right, small = checked_broadcast(right, max_broadcast_rows)
        if strict and not small:
            raise ValueError("the right side is over the bound for a broadcast")
    elif strategy is not None:
        right = right.hint(strategy)
    return left.join(right, on=on, how=how)


def heavy_keys(df: DataFrame, on: list[str], parts: int) -> dict[int, int]:
    """Hashes of the keys that hold more rows than one of ``parts`` even shares, with the number of pieces to cut each
    into, ``PIECES`` a share so that pieces that meet in one task don't weigh much.

    One pass with a frequent-items sketch, merged map-side: at most ``parts`` keys can be that heavy, so that many are
    asked for and the sketch tracks four times as many. Keys of one hash count as one, which only splits them alike.
    """
    tracked = max(4096, 4 * parts)
    row = df.agg(F.count(F.lit(1)).alias("n"), _top(_key_hash(df, on), parts, tracked).alias("top")).first()
    share = max(1, row["n"] // parts)
    return {item["item"]: -(-PIECES * item["count"] // share) for item in row["top"] or [] if item["count"] > share}


def _top(key: Column, k: int, tracked: int) -> Column:
    return F.call_function("approx_top_k", key, F.lit(k), F.lit(tracked))


def _key_hash(df: DataFrame, on: list[str]) -> Column:
    """Equal for equal keys: 0.0 and -0.0 are equal, and so are all NaN."""
    floats = {"float", "double"}
    return F.xxhash64(*[F.col(f"`{c}`") + F.lit(0.0).cast(kind) if (kind := df.schema[c].dataType.simpleString()) in floats
                        else F.col(f"`{c}`") for c in on])


def skew_join(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str], how: str = "inner",
              parts: int | None = None) -> DataFrame:
    """Equi-join whose heavy keys on the left are split over many tasks.

    A sketch finds the keys with more rows than an even share of ``parts`` (default: the shuffle partitions). Their left
    rows are dealt by turns to pieces of the key, in proportion to their number, and the right rows of just these keys
    are copied into each piece; all other rows are joined as they are. ``how`` is inner, left, left_semi or left_anti (a
    copied right row without partner would appear more than once in the others). Null keys match nothing; 0.0 equals
    -0.0 and NaN equals NaN, as in Spark's own equi-join. The pass over the left keys runs when the join is built.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("how must be inner, left, left_semi or left_anti")
    kinds = [[df.schema[c].dataType for c in on] for df, on in ((left, left_on), (right, right_on))]
    if kinds[0] != kinds[1]:
        raise ValueError(f"key types differ: {kinds[0]} and {kinds[1]}")
    width = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(left.select(*[F.col(f"`{c}`") for c in left_on]), left_on, width)
    same = F.lit(True)
    for a, b in zip(left_on, right_on, strict=True):
        same = same & (F.col(f"`{a}`") == F.col(f"`{b}`"))
    if not heavy:
        return left.join(right, same, how)
    # at most ``parts`` rows
    split = F.broadcast(left.sparkSession.createDataFrame(list(heavy.items()), "__hash long, __shares long"))

    def tagged(df: DataFrame, on: list[str]) -> DataFrame:
        return df.withColumn("__hash", _key_hash(df, on)).join(split, "__hash", "left").drop("__hash")

    turn = F.when(F.col("__shares").isNull(), F.lit(0)).otherwise(F.pmod(F.col("__turn"), F.col("__shares")))
    dealt = tagged(left.withColumn("__turn", F.monotonically_increasing_id()), left_on)
    dealt = dealt.withColumn("__part", turn.cast("long")).drop("__turn", "__shares")
    every = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("__shares"), F.lit(1).cast("long")) - F.lit(1))
    copied = tagged(right, right_on).withColumn("__copy", F.explode(every)).drop("__shares")
    return dealt.join(copied, same & (F.col("__part") == F.col("__copy")), how).drop("__part", "__copy")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def join_strategy_used(df: DataFrame) -> list[str]:
    """Physical join operators in the plan, in plan order."""
    text = plan_text(df)
    return re.findall("|".join(_JOIN_NODES), text)


def executed_plan_text(df: DataFrame) -> str:
    """The plan that ran: adaptive execution's final tree, without its first draft.

    Runs the query if no action on this DataFrame has run it yet; rows stay with the executors.
    """
    run = df._jdf.queryExecution()
    text = run.executedPlan().toString()
    if "isFinalPlan=false" in text:
        run.toRdd().count()
        text = run.executedPlan().toString()
    head, final, rest = text.partition("== Final Plan ==")
    return rest.split("== Initial Plan ==")[0] if final else head


def executed_joins(df: DataFrame) -> list[str]:
    """Physical join operators of the plan that ran, in plan order."""
    return re.findall("|".join(_JOIN_NODES), executed_plan_text(df))


def bucketed_table(df: DataFrame, name: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """``df`` written once as a table of the catalog, bucketed and sorted by ``keys`` with one file per bucket.

    Tables of equal keys and buckets join on them without moving a row, however often. ``path`` is a new folder that all
    executors share; the table is external, so dropping it leaves the files.
    """
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
     .format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)
