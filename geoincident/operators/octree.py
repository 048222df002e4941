"""Nearest-neighbour candidates by a level-synchronous descent of an octree.

Unit vectors lie in the cube [-1, 1]^3, which is halved ``level`` times along
each axis; a cell's key packs its three indexes into one long, so a parent is a
shift away. Facilities are aggregated into nodes (count, bounding box and one
representative point), incidents into cells (bounding box). Pairs of a cell and
a node that may hold a nearest facility start at a level of few cells and nodes
and go down a few levels a step, both sides at once, by equi-joins on the parents'
keys:

* a cell's nearest facility is at most as far as the farthest point of its box
  from any representative; the least of these is the cell's bound;
* a node stays with the cell only while their boxes are not farther apart.

At the level at which nodes hold few facilities, cells with few candidates are
settled; only the others, beside clusters, go on to finer levels with the
incidents and facilities under them. The work grows with the occupied cells, not
with incidents times facilities, and a clustered table takes the same plan.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoincident.operators.joins import checked_broadcast

#: levels of the finest cells (edges of 6 m on the earth), and levels that a step goes down
FINEST, STEP = 21, 3
#: facilities of a node at the level where most cells settle, and candidates of a settled cell
NODE_FACILITIES, SETTLED_CANDIDATES = 2, 64
#: most nodes and cells of the first level, whose pairs are all looked at
FIRST_NODES, FIRST_CELLS = 64, 4096
_MASK = (1 << FINEST) - 1
#: rounding of unit vectors, as a length
_ROUNDING = 1e-14


def _packed(x: str, y: str, z: str) -> str:
    return f"(shiftleft({x}, {2 * FINEST}) | shiftleft({y}, {FINEST}) | {z})"


def cell_key(p: str, level: int) -> Column:
    """Key of the cell of the point in columns ``p`` + x, y, z."""
    return F.expr(_packed(*[
        f"shiftright(least(cast(floor(({p}{a} + 1D) * {1 << (FINEST - 1)}D) AS bigint), {_MASK}L), {FINEST - level})"
        for a in "xyz"]))


def parent_key(key: str, levels: int) -> Column:
    """Key of the cell that many levels up."""
    return F.expr(_packed(*[f"shiftright(shiftright({key}, {FINEST * i}) & {_MASK}L, {levels})" for i in (2, 1, 0)]))


def _box(p: str, out: str) -> list[Column]:
    return [F.expr(f"{f}({p}{a}) AS {out}{s}{a}") for s, f in (("lo", "min"), ("hi", "max")) for a in "xyz"]


def _cells(points: DataFrame, p: str, level: int) -> DataFrame:
    return points.groupBy(cell_key(p, level).alias("__q")).agg(*_box(p, "__q"))


def _nodes(points: DataFrame, p: str, level: int) -> DataFrame:
    return points.groupBy(cell_key(p, level).alias("__f")).agg(
        *_box(p, "__f"), F.expr("count(1) AS __n"), F.expr(f"min(struct({p}x AS x, {p}y AS y, {p}z AS z)) AS __rep"))


def _up(rows: DataFrame, side: str, levels: int) -> DataFrame:
    """Cells or nodes some levels up, from those below."""
    agg = [F.expr(f"{f}(__{side}{s}{a}) AS __{side}{s}{a}") for s, f in (("lo", "min"), ("hi", "max")) for a in "xyz"]
    if side == "f":
        agg += [F.expr("sum(__n) AS __n"), F.expr("min(__rep) AS __rep")]
    return rows.groupBy(parent_key(f"__{side}", levels).alias(f"__{side}")).agg(*agg)


def _length(side: str) -> str:
    return "sqrt(" + " + ".join(f"pow({side.format(a=a)}, 2)" for a in "xyz") + ")"


#: least distance of the cell's and the node's boxes
_APART = _length("greatest(0D, __flo{a} - __qhi{a}, __qlo{a} - __fhi{a})")
#: distance of the representative from the farthest corner of the cell's box
_FARTHEST = _length("greatest(abs(__rep.{a} - __qlo{a}), abs(__rep.{a} - __qhi{a}))")


def _near(ratio: float, slack: float) -> Column:
    """Whether a facility of the node may be called nearest by the metric, if one is within ``__u`` of all the cell."""
    u = "__u" if ratio == 1.0 else f"2D * sin(least({ratio * 2.0!r}D * asin(least(1D, __u / 2D)), pi()) / 2D)"
    return F.expr(f"{_APART} <= {u} * {1.0 + slack!r}D + {_ROUNDING!r}D")


_NODE = [f"__f{s}{a}" for s in ("lo", "hi") for a in "xyz"] + ["__n", "__rep"]
_CELL = [f"__q{s}{a}" for s in ("lo", "hi") for a in "xyz"]


def _kept(pairs: DataFrame, ratio: float, slack: float) -> DataFrame:
    """Pairs within the cells' bounds, with the bound (__u) and the number of facilities that are left (__left)."""
    own = Window.partitionBy("__q")
    pairs = pairs.withColumn("__u", F.min(F.expr(_FARTHEST)).over(own)).where(_near(ratio, slack))
    return pairs.withColumn("__left", F.sum("__n").over(own))


def _occupied(points: DataFrame, p: str) -> tuple[int, dict[int, int]]:
    """Points, and about how many cells they occupy at every STEP-th level."""
    levels = range(STEP, FINEST + 1, STEP)
    n, *kinds = points.agg(F.count(F.lit(1)), *[F.approx_count_distinct(cell_key(p, v)) for v in levels]).first()
    return n, {0: min(n, 1)} | dict(zip(levels, kinds, strict=True))


def nearest_candidates(inc: DataFrame, inc_p: str, fac: DataFrame, fac_p: str, ratio: float, slack: float,
                       max_broadcast_rows: int, checkpoint: bool = True, base: int | None = None
                       ) -> Iterator[tuple[int, DataFrame]]:
    """(level, candidates) parts: facility rows with the key (__q) of each settled cell of that level that they may be
    nearest to. Every incident lies in one settled cell, whose rows hold all its nearest facilities.

    ``inc`` and ``fac`` have unit vectors in the columns ``inc_p`` / ``fac_p`` + x, y, z. ``ratio``: largest ratio of the
    metric to the sphere's arc over the smallest.
    """
    def kept(df: DataFrame) -> DataFrame:
        return df.checkpoint() if checkpoint else df

    def small(df: DataFrame, rows: int) -> DataFrame:
        return checked_broadcast(df, max_broadcast_rows, rows=rows)[0]

    n, kinds = _occupied(fac, fac_p)
    if base is None:
        base = next((v for v, k in kinds.items() if v and k * NODE_FACILITIES >= n), FINEST)
    base = min(max(base, 1), FINEST)
    cells = {base: kept(_cells(inc, inc_p, base))}
    nodes = {base: kept(_nodes(fac, fac_p, base))}
    first = max(v for v, k in kinds.items() if v < base and k <= FIRST_NODES)
    while first and _up(cells[base], "q", base - first).count() > FIRST_CELLS:
        first = max(first - STEP, 0)
    steps = sorted({first, *range(base, first, -STEP)}) + [*range(base + STEP, FINEST, STEP)] + [FINEST] * (base < FINEST)
    for level in steps:
        if level < base:
            cells[level], nodes[level] = _up(cells[base], "q", base - level), _up(nodes[base], "f", base - level)

    pairs = None
    for at, level in enumerate(steps):
        if pairs is None:
            found = small(nodes[level].withColumn("__one", F.lit(1)), 2 * FIRST_NODES).join(
                cells[level].withColumn("__one", F.lit(1)), "__one").drop("__one")
        else:
            up = steps[at - 1]
            if level > base:  # what lies under the cells and nodes that are left
                live = small(pairs.select(F.col("__q").alias("__k")).distinct(), many)
                cells[level] = _cells(inc.join(live, cell_key(inc_p, up) == F.col("__k"), "left_semi"), inc_p, level)
                live = small(pairs.select(F.col("__f").alias("__k")).distinct(), many)
                nodes[level] = _nodes(fac.join(live, cell_key(fac_p, up) == F.col("__k"), "left_semi"), fac_p, level)
            under = nodes[level].withColumn("__up", parent_key("__f", level - up))
            own = pairs.select(F.col("__q").alias("__above"), F.col("__f").alias("__up"), "__u", *_CELL)
            near = small(own, many).join(under, "__up").where(_near(ratio, slack)).drop("__up", *_CELL)
            below = cells[level].withColumn("__above", parent_key("__q", level - up))
            found = below.join(near, "__above").where(_near(ratio, slack)).drop("__above", "__u")
        pairs = kept(_kept(found, ratio, slack))
        settled = F.lit(level == FINEST) | ((F.col("__left") <= F.lit(SETTLED_CANDIDATES)) & F.lit(level >= base))
        many, done = pairs.agg(F.count(F.lit(1)), F.count_if(settled)).first()
        if done:
            sites = fac.withColumn("__f", cell_key(fac_p, level)).withColumns(
                {f"__f{s}{a}": F.col(fac_p + a) for s in ("lo", "hi") for a in "xyz"})
            chosen = pairs.where(settled).select("__q", "__f", "__u", *_CELL)
            yield level, (small(chosen, done).join(sites, "__f").where(_near(ratio, slack))
                          .drop("__f", "__u", *_CELL, *_NODE[:6]))
        pairs, many = pairs.where(~settled), many - done
        if not many:
            return
