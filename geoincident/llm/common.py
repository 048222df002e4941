"""Helpers shared by the operators: staged tables, sorted-group streaming, components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoincident.session import ensure_checkpoint_dir, ship_package

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Executors can import the package and a shared folder for staged tables exists."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: staged folders of the scopes that are open, innermost last
_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A scope whose staged tables are deleted when it ends, done or failed.

    Gives a function that stages a result outside the scope, so it stays.
    """
    own: list[str] = []
    _SCOPES.append(own)

    def keep(df: DataFrame, name: str) -> DataFrame:
        out, path = _write(df, name)
        for outer in _SCOPES[-2:-1]:
            outer.append(path)
        return out

    try:
        yield keep
    finally:
        _SCOPES.remove(own)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in own:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(conf).delete(folder, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs at most the running stage, and the
    shuffle files behind the table are released when the write ends. The table
    goes with the scope it was staged in.
    """
    out, path = _write(df, name)
    for scope in _SCOPES[-1:]:
        scope.append(path)
    return out


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


#: what a Python worker keeps from task to task, by name
_KEPT: dict[str, dict] = {}


def kept(name: str) -> dict:
    """A dict that lives on in a Python worker until it gets a task whose work does not use it."""
    return _KEPT.setdefault(name, {})


def _drop_kept(but: str | None) -> None:
    others = [d for name, d in _KEPT.items() if name != but and d]
    for d in others:
        d.clear()
    if others:
        _give_back()


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], uses: str | None = None
         ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` that gives its freed memory back at the end of a task.

    Python workers live on after a task; without this each keeps the most it
    ever held, beside the next operator's memory. Of what other operators
    ``kept`` only the dict named ``uses`` stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _drop_kept(uses)
        yield from work(batches)
        _give_back()

    return run


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def per_group(df: DataFrame, keys: list[str], order: list[str],
              work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on the rows of each key, for very many small groups.

    Rows are dealt out by the keys, sorted inside the partition and cut into
    groups while they stream past, so that a group costs no Python call of its
    own beyond ``work``. One group is held at a time; callers bound its size.
    """
    width = shuffle_width(df.sparkSession)
    dealt = df.repartition(width, *keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        held_key = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            columns = [table.column(k).to_pylist() for k in keys]
            marks = list(zip(*columns, strict=True))
            start = 0
            for i in range(1, len(marks) + 1):
                if i < len(marks) and marks[i] == marks[start]:
                    continue
                if held and marks[start] != held_key:
                    yield from work(pa.concat_tables(held))
                    held = []
                held_key = marks[start]
                held.append(table.slice(start, i - start))
                start = i
        if held:
            yield from work(pa.concat_tables(held))

    return dealt.mapInArrow(lean(run), schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of every node in ``edges`` (columns a, b; any order, repeats allowed).

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the
    edge set is a set of stars. Each step is an aggregation and a join on the
    node, so a node with very many edges is combined map-side and its join is
    split by adaptive execution; nothing is collected. Returns node, root, with
    root the smallest node of the component.
    """
    with scratch(edges.sparkSession) as keep:
        return keep(_stars(edges), "components")


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of distinct edges and the xor of their hashes."""
    return tuple(edges.agg(F.count("*").alias("n"), F.coalesce(
        F.expr("bit_xor(xxhash64(u, v))"), F.lit(0)).alias("x")).first())


def _stars(edges: DataFrame) -> DataFrame:
    """node, root of the components."""
    current = staged(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(), "edges")
    mark = _fingerprint(current)
    while True:
        both = current.select("u", "v").unionByName(
            current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        current = staged(small, "small")
        now = _fingerprint(current)
        if mark == now:
            break
        mark = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
