"""Near-duplicate embeddings by Euclidean p-stable hashing (op 1).

Vectors are normalised in double precision; each of several tables maps them to
``floor((a . v + b) / width)`` for a number of Gaussian directions ``a`` and
offsets ``b`` (Datar et al., 2004). Vectors that meet in a bucket are compared
by exact cosine. Equal vectors are one class with a multiplicity, so copies
never meet each other; a bucket of many different vectors is cut into parts
whose products are taken part by part, and only counts per vector and a forest
of links leave the task.

The number of directions follows the number of classes n (so that unrelated
vectors share a bucket ``meet`` times on average) and the number of tables
follows the wanted recall at the threshold, both by the closed-form collision
probability of the family.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoincident.llm.common import connected_components, per_group, prepare, staged


def collision_probability(distance: float, width: float) -> float:
    """That two vectors at this distance fall into one cell of one direction."""
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(n: int, cosine: float, width: float, recall: float, meet: float) -> tuple[int, int]:
    """(directions per table, tables)."""
    far = collision_probability(math.sqrt(2.0), width)
    near = collision_probability(math.sqrt(2 - 2 * cosine), width)
    k = max(4, math.ceil(math.log(max(n, 2) / meet) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near ** k))


def _directions(dim: int, k: int, tables: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, k * tables)), rng.uniform(0, width, k * tables)


def _buckets(units: np.ndarray, k: int, tables: int, width: float, seed: int) -> np.ndarray:
    """Bucket of every vector in every table, as int64."""
    a, b = _directions(units.shape[1], k, tables, width, seed)
    cells = np.floor((units @ a + b) / width).astype(np.int64).reshape(len(units), tables, k)
    out = np.full((len(units), tables), units.shape[1], dtype=np.uint64)
    for i in range(k):
        out = (out ^ cells[:, :, i].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _units(vectors: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_dim(vectors: list[bytes]) -> Iterator[np.ndarray]:
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def near_duplicate_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                              cosine: float = 0.95, width: float = 2.0, recall: float = 0.995,
                              meet: float = 0.25, seed: int = 17, part_rows: int = 1000) -> DataFrame:
    """Links of cosine >= ``cosine`` between vectors, and their components.

    Returns one row per input row: the id, n_links (other rows linked
    directly), component_id (smallest id reachable), kept. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing;
    vectors of different lengths neither. Repeated rows and ids count as rows
    of their own; an id that is null never names a component that has another.
    Extra columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    prepare(spark)
    kind = vectors.schema[id_col].dataType.simpleString()

    def classes_of(batches):
        for batch in batches:
            keys, raws = [], []
            for v in batch.column(1).to_pylist():
                raw = key = None
                if v and None not in v:
                    x = np.asarray(v, dtype=np.float64) + 0.0
                    if np.isfinite(x).all() and x.any():
                        raw = x.tobytes()
                        key = int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(raw))))
                keys.append(key)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.int64()), pa.array(raws, pa.binary())],
                names=["id", "cls", "vector"])

    rows = staged(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
                  .mapInArrow(classes_of, f"id {kind}, cls long, vector binary"), "vectors")
    classes = staged(rows.where("cls is not null").groupBy("cls").agg(
        F.count("*").alias("copies"), F.first("vector").alias("vector")), "classes")
    k, tables = plan_tables(classes.count(), cosine, width, recall, meet)

    def hashed(batches):
        for batch in batches:
            raws = batch.column(1).to_pylist()
            for at in _by_dim(raws):
                for i in range(0, len(at), 2000):
                    part = at[i:i + 2000]
                    b = _buckets(_units([raws[x] for x in part]), k, tables, width, seed)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(batch.column(0).to_numpy()[part], tables)),
                         pa.array(np.tile(np.arange(tables, dtype=np.int32), len(part))),
                         pa.array(b.ravel())], names=["cls", "tab", "bucket"])

    met = classes.select("cls", "vector").mapInArrow(hashed, "cls long, tab int, bucket long")
    full = (met.groupBy("tab", "bucket").agg(F.count("*").alias("n")).where("n > 1")
            .select("tab", "bucket", F.ceil(F.col("n") / part_rows).cast("int").alias("parts")))
    met = met.join(full, ["tab", "bucket"]).withColumn(
        "part", F.expr("cast(pmod(xxhash64(cls, tab), parts) as int)"))
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"))
    met = met.select("cls", "tab", "bucket", "part", F.least("part", "with").alias("p"),
                     F.greatest("part", "with").alias("q"))
    met = met.join(classes, "cls")

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if table.num_rows < 2:
            return
        raws = table.column("vector").to_pylist()
        cls, copies = table.column("cls").to_numpy(), table.column("copies").to_numpy()
        part, tab = table.column("part").to_numpy(), table.column("tab")[0].as_py()
        across = table.column("p")[0] != table.column("q")[0]
        for at in _by_dim(raws):
            u = _units([raws[i] for i in at])
            near = (u @ u.T) >= cosine
            np.fill_diagonal(near, False)
            if across:
                near &= part[at][:, None] != part[at][None, :]
            if not near.any():
                continue
            label = np.arange(len(at))
            while True:
                low = np.minimum(label, np.where(near, label[None, :], len(at)).min(axis=1))
                low = low[low]
                if (low == label).all():
                    break
                label = low
            # a pair counts in the first table where it meets
            if tab:
                early = _buckets(u, k, tables, width, seed)[:, :tab]
                x, y = np.nonzero(near)
                for i in range(0, len(x), 20_000):
                    a, b = x[i:i + 20_000], y[i:i + 20_000]
                    seen = (early[a] == early[b]).any(axis=1)
                    near[a[seen], b[seen]] = False
            count = near.astype(np.float64) @ copies[at].astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[at]), pa.array(cls[at][label]), pa.array(count.astype(np.int64))],
                names=["cls", "to", "n"])

    found = staged(per_group(met, ["tab", "bucket", "p", "q"], [], compare, "cls long, to long, n long"), "found")
    links = found.groupBy("cls").agg(F.sum("n").alias("n"))
    roots = connected_components(found.select(F.col("cls").alias("a"), F.col("to").alias("b")))
    named = classes.select("cls", "copies").join(links, "cls", "left").join(
        roots.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.select("cls", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("root", "cls").alias("root"))
    out = rows.select("id", "cls").join(named, "cls", "left")
    least = out.where("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    out = out.join(least, "root", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine 0.95 over all embeddings."""
    return near_duplicate_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: every two vectors by exact cosine; the components by walking the links
SQL = {"op1_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
   AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, comp.component_id,
       e.vec_id = comp.component_id AS kept
FROM embeddings e JOIN comp ON comp.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""}
