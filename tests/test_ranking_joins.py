import datetime as dt
import math
import random
import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

from geoincident.operators.extremes import count_extreme_groups, extreme_values, filter_extreme_groups
from geoincident.functions.exact import exact_mean
from geoincident.operators.joins import (bucketed_table, executed_joins, executed_plan_text, heavy_keys,
                                          join_strategy_used, join_with_strategy, plan_text, skew_join)
from geoincident.operators.ranking import top_k_per_group
from geoincident.plans.reports import top_months, top_months_sql


def _dates(spark):
    rows = []
    # 2019: March 5, April 5 (tie), May 4, June 1; 2020: only two months; one null date
    for m, n in ((3, 5), (4, 5), (5, 4), (6, 1)):
        rows += [(dt.date(2019, m, 1 + i),) for i in range(n)]
    rows += [(dt.date(2020, 1, 1),), (dt.date(2020, 2, 1),), (dt.date(2020, 2, 2),), (None,)]
    return spark.createDataFrame(rows, "`DATE OCC` date")


def test_top_months_ties_short_year_and_null(spark):
    got = [tuple(r) for r in top_months(_dates(spark)).collect()]
    assert got == [(2019, 3, 5, 1), (2019, 4, 5, 2), (2019, 5, 4, 3), (2020, 2, 2, 1), (2020, 1, 1, 2)]


def test_top_months_text_dates_and_sql_form_agree(spark):
    txt = _dates(spark).select(F.date_format("DATE OCC", "MM/dd/yyyy hh:mm:ss a").alias("DATE OCC"))
    a = [tuple(r) for r in top_months(txt).collect()]
    b = [tuple(r) for r in top_months_sql(spark, txt).collect()]
    assert a == b == [tuple(r) for r in top_months(_dates(spark)).collect()]


def test_top_k_uses_group_limit_and_methods(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 2), ("a", 1), ("b", 1)], "g string, v int")
    plan = plan_text(top_k_per_group(df, ["g"], [F.col("v").desc()], 2), "extended")
    assert "WindowGroupLimit" in plan
    rank = top_k_per_group(df, ["g"], [F.col("v").desc()], 2, "rank").where("g = 'a'").count()
    dense = top_k_per_group(df, ["g"], [F.col("v").desc()], 2, "dense_rank").where("g = 'a'").count()
    assert (rank, dense) == (2, 3)
    with pytest.raises(ValueError):
        top_k_per_group(df, ["g"], [F.col("v")], 0)


def test_extreme_groups_cases(spark):
    def vals(xs):
        return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, v int")
    assert sorted(r.v for r in extreme_values(vals([1, 2]), "v").collect()) == [1, 2]
    assert sorted(r.v for r in extreme_values(vals([1, 2, 3, 4, 5]), "v").collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.v for r in extreme_values(vals([1, 2, 3, 4, 5, 6, 7, None]), "v").collect()) == [1, 2, 3, 5, 6, 7]
    kept = filter_extreme_groups(vals([10, 10, 20, 30, 40, 50, 60, 70, None]), "v")
    assert sorted(r.v for r in kept.collect()) == [10, 10, 20, 30, 50, 60, 70]


def test_count_extreme_groups_runs_its_input_once(spark):
    df = spark.createDataFrame([(10, "a"), (10, None), (20, "a"), (30, "b"), (40, "b"), (50, "b"), (60, None),
                                (70, "a"), (None, "a")], "v int, `the group` string")
    seen = spark.sparkContext.accumulator(0)

    def count_rows(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    out = count_extreme_groups(df.mapInArrow(count_rows, df.schema), "v", "the group", 3, "n")
    assert {tuple(r) for r in out.collect()} == {("a", 3), ("b", 2), (None, 2)}
    assert seen.value == df.count()
    empty = count_extreme_groups(df.limit(0), "v", "the group")
    assert empty.columns == ["the group", "n_rows"] and empty.count() == 0


def _join_inputs(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (4, "d")], "k int, lv string")
    right = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z"), (4, "w")], "k2 int, rv string")
    return left, right


@pytest.mark.parametrize("strategy,node", [("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"),
                                           ("shuffle_hash", "ShuffledHashJoin")])
def test_join_strategies_same_rows_and_plan(spark, strategy, node):
    left, right = _join_inputs(spark)
    base = sorted(tuple(r) for r in join_with_strategy(left, right, left.k == right.k2).collect())
    df = join_with_strategy(left, right, left.k == right.k2, strategy=strategy)
    assert sorted(tuple(r) for r in df.collect()) == base
    assert len(base) == 5   # unmatched keys drop, duplicate keys multiply
    assert node in join_strategy_used(df)


def test_join_size_guards(spark):
    left, right = _join_inputs(spark)
    from geoincident.operators.joins import checked_broadcast
    assert checked_broadcast(right, max_rows=1)[1] is False
    assert checked_broadcast(right, max_rows=4)[1] is True
    df = join_with_strategy(left, right, left.k == right.k2, strategy="broadcast", max_broadcast_rows=1)
    assert sorted(tuple(r) for r in df.collect()) == sorted(
        tuple(r) for r in join_with_strategy(left, right, left.k == right.k2).collect())
    with pytest.raises(ValueError):
        join_with_strategy(left, right, left.k == right.k2, strategy="broadcast", max_broadcast_rows=1, strict=True)
    with pytest.raises(ValueError):
        join_with_strategy(left, right, left.k == right.k2, strategy="nested")


# ---- heavy keys

def _places(spark, n=60_000):
    """Three tenths of the rows on one place, some on null, zero and NaN ones."""
    k = F.when(F.col("id") % 10 < 3, F.lit(7.0)).when(F.col("id") % 997 == 0, F.lit(None)).when(
        F.col("id") % 991 == 0, F.lit(-0.0)).when(F.col("id") % 983 == 0, F.lit(float("nan"))).otherwise(
        (F.col("id") * 7919 % 5000).cast("double"))
    left = spark.range(0, n, 1, 8).select("id", k.alias("lat"), (k * 2).alias("lon"))
    place = spark.range(5000).select(F.col("id").cast("double").alias("g_lat"), (F.col("id") * 2.0).alias("g_lon"),
                                     F.col("id").alias("zip"))
    odd = spark.createDataFrame([(0.0, -0.0, -1), (float("nan"), float("nan"), -2), (None, None, -3), (7.0, 14.0, -4)],
                                "g_lat double, g_lon double, zip long")
    return left, place.unionByName(odd)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_the_plain_join(spark, how):
    left, right = _places(spark, 6000)
    plain = left.join(right, (F.col("lat") == F.col("g_lat")) & (F.col("lon") == F.col("g_lon")), how)
    got = skew_join(left, right, ["lat", "lon"], ["g_lat", "g_lon"], how, parts=16)
    assert got.columns == plain.columns
    same = lambda df: Counter(map(repr, df.collect()))
    assert same(got) == same(plain)
    assert heavy_keys(left, ["lat", "lon"], 16).keys() == {
        left.where("lat = 7").select(F.xxhash64("lat", "lon").alias("h")).first()["h"]}


def test_no_task_has_four_times_the_median(spark):
    left, right = _places(spark)
    keys = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("false", "48", "-1")):
            spark.conf.set(k, v)
        def sizes(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        even = sizes(skew_join(left, right, ["lat", "lon"], ["g_lat", "g_lon"]))
        hot = sizes(left.join(right, (F.col("lat") == F.col("g_lat")) & (F.col("lon") == F.col("g_lon"))))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert hot[-1] > 10 * hot[len(hot) // 2]
    assert even[-1] <= 4 * even[len(even) // 2] and sum(even) == sum(hot)


def test_skew_strategy_by_name_and_its_errors(spark):
    left, right = _places(spark, 2000)
    named = right.withColumnsRenamed({"g_lat": "lat", "g_lon": "lon"})
    got = join_with_strategy(left, named, ["lat", "lon"], strategy="skew")
    assert sorted(got.columns) == ["id", "lat", "lon", "zip"]
    assert got.count() == left.join(named, ["lat", "lon"]).count()
    with pytest.raises(ValueError, match="names"):
        join_with_strategy(left, right, left["lat"] == right["g_lat"], strategy="skew")
    with pytest.raises(ValueError, match="how"):
        skew_join(left, right, ["lat"], ["g_lat"], "full")
    with pytest.raises(ValueError, match="types"):
        skew_join(left, right, ["id"], ["g_lat"])


# ---- plans that ran, co-bucketed tables, means

def test_the_report_names_the_join_that_ran(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
    try:
        a = spark.range(200_000).select("id", (F.col("id") % 100).alias("v")).groupBy("id").agg(F.sum("v").alias("v"))
        b = spark.range(200_000).where("id % 1000 = 0").groupBy(F.col("id").alias("b")).count()
        df = a.join(b, F.col("id") == F.col("b"))
        assert join_strategy_used(df) == ["SortMergeJoin"]  # the plan before it runs
        assert executed_joins(df) == ["BroadcastHashJoin"]  # adaptive execution saw how small b is
        assert "isFinalPlan" not in executed_plan_text(df) and df.count() == 200
        assert executed_joins(df.groupBy().count()) == ["BroadcastHashJoin"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_co_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = bucketed_table(spark.range(5000).select("id", (F.col("id") * 2).alias("x")), "bucketed_a", ["id"], 6, str(tmp_path / "a"))
        b = bucketed_table(spark.range(0, 5000, 3).select(F.col("id").alias("k")), "bucketed_b", ["k"], 6, str(tmp_path / "b"))
        df = join_with_strategy(a, b, a["id"] == b["k"], strategy="merge")
        text = executed_plan_text(df)
        assert "SortMergeJoin" in text and "Exchange" not in text and df.count() == 1667
    finally:
        for t in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_means_have_equal_bits_for_any_partitions(spark):
    rnd = random.Random(3)
    rows = [(i % 3, rnd.choice([-1, 1]) * 10 ** rnd.uniform(-9, 9)) for i in range(4000)] + [(0, None), (4, None), (5, float("nan")), (6, -0.0)]
    df = spark.createDataFrame(rows, "g int, x double")
    seen = set()
    for n in (1, 7, 211):
        got = {r["g"]: r["m"] for r in df.repartition(n).groupBy("g").agg(exact_mean("x").alias("m")).collect()}
        seen.add(tuple(struct.pack("<d", got[g]) for g in range(3)))
        assert got[4] is None and math.isnan(got[5]) and got[6] == 0.0
    assert len(seen) == 1
    for g in range(3):
        values = [x for k, x in rows if k == g and x is not None]
        assert got[g] == pytest.approx(math.fsum(values) / len(values), rel=1e-14)
