"""Mixing sources to target weights by hierarchical budgeting (op 4).

The leaves of a tree (domain, language, source) hold documents. A token budget
is passed from the root down: each node's budget goes to its children by
weight, and what a child cannot hold (its documents' tokens times the epochs
allowed) goes to its siblings by their weights before the next level up feels
it; a node never gets more than its subtree holds. All shares are whole tokens
that add up. A leaf takes whole epochs of its documents and then a prefix of
tokens of one more epoch, in an order seeded per epoch.

The prefix is found without putting a leaf into one task: documents are summed
by leaf and the first four hex digits of their order (at most 65,536 sums a
leaf), and only the documents of the digits where the budget ends are ordered:
first the sums of their ids, then those of 65,536 ranges of the hashes of the
texts with the last id, then those of the different texts in the last range.
The rows equal to the last one are numbered. So a leaf's budget is met to the
token with null and repeated ids and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoincident.llm.common import free_name, prepare, staged

LEVELS = ("domain", "lang", "source")
_BIG = "decimal(38,0)"
#: leaves (of some 200 bytes each) that are sent to all executors at most
BROADCAST_LEAVES = 200_000


def _fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``budget`` to the children (columns parent, name, w, cap, of): the parent's budget ``of`` by weight."""
    own = [F.lit(0)] if not parent else [F.col(c) for c in parent]
    cap = F.when(F.col("w") > 0, F.col("cap")).otherwise(0)
    nodes = nodes.withColumn("cap", cap).withColumn(
        "fill", F.when(F.col("w") > 0, F.col("cap").cast("double") / F.col("w")).otherwise(0.0))
    order = Window.partitionBy(*own).orderBy("fill", name)
    every = Window.partitionBy(*own)
    before = F.sum("cap").over(order) - F.col("cap")
    weight = F.sum("w").over(every) - F.sum("w").over(order) + F.col("w")
    nodes = nodes.withColumn("left_", (F.col("of") - before).cast(_BIG)).withColumn("weight_", weight)
    nodes = nodes.withColumn("full_", (F.col("cap") * F.col("weight_")).cast(_BIG)
                             <= (F.col("left_") * F.col("w")).cast(_BIG))
    open_w = F.when(~F.col("full_"), F.col("w")).otherwise(0)
    nodes = nodes.withColumn("open_", open_w).withColumn(
        "rest_", (F.col("of") - F.sum(F.when(F.col("full_"), F.col("cap")).otherwise(0)).over(every)).cast(_BIG))
    nodes = nodes.withColumn("all_", F.sum("open_").over(every)).withColumn(
        "to_", F.sum("open_").over(Window.partitionBy(*own).orderBy(name)))
    share = (F.expr(f"cast(rest_ * to_ as {_BIG}) div all_") - F.expr(f"cast(rest_ * (to_ - open_) as {_BIG}) div all_"))
    nodes = nodes.withColumn("budget", F.when(F.col("full_"), F.col("cap")).otherwise(share).cast("long"))
    return nodes.drop("fill", "left_", "weight_", "full_", "open_", "rest_", "all_", "to_")


def _weighted(nodes: DataFrame, path: list[str], weights: dict[tuple[str, ...], int]) -> DataFrame:
    own = {k: v for k, v in weights.items() if len(k) == len(path)}
    if not own:
        return nodes.withColumn("w", F.lit(1).cast("long"))
    rows = nodes.sparkSession.createDataFrame([(*k, v) for k, v in own.items()],
                                              ", ".join([*(f"`{c}` string" for c in path), "w long"]))
    return nodes.join(rows, path, "left").withColumn("w", F.coalesce("w", F.lit(1)))


def leaf_budgets(sizes: DataFrame, weights: dict[tuple[str, ...], int], budget: float, max_epochs: int) -> DataFrame:
    """domain, lang, source, tokens, budget of every leaf; ``sizes`` has the leaves and their tokens.

    ``weights``: whole number per path, 1 where absent, 0 shuts a node out.
    ``budget``: share of all tokens.
    """
    tree = sizes.withColumn("cap", F.col("tokens") * max_epochs)
    total = sizes.agg(F.coalesce(F.floor(F.sum("tokens") * F.lit(budget)), F.lit(0)).cast("long").alias("of"))
    # what a subtree can hold, without nodes of weight 0
    leaves = _weighted(tree, list(LEVELS), weights).withColumn("cap", F.when(F.col("w") > 0, F.col("cap")).otherwise(0))
    langs = _weighted(leaves.groupBy(*LEVELS[:2]).agg(F.sum("cap").alias("cap")), list(LEVELS[:2]), weights)
    langs = langs.withColumn("cap", F.when(F.col("w") > 0, F.col("cap")).otherwise(0))
    domains = _weighted(langs.groupBy(LEVELS[0]).agg(F.sum("cap").alias("cap")), [LEVELS[0]], weights)
    domains = domains.withColumn("cap", F.when(F.col("w") > 0, F.col("cap")).otherwise(0))
    domains = domains.withColumn("all", F.sum("cap").over(Window.partitionBy(F.lit(0)))).join(total, F.lit(True))
    domains = _fill(domains.withColumn("of", F.least("of", "all")), [], "domain")
    langs = _fill(langs.join(domains.select("domain", F.col("budget").alias("of")), "domain"), ["domain"], "lang")
    leaves = _fill(leaves.join(langs.select("domain", "lang", F.col("budget").alias("of")), ["domain", "lang"]),
                   ["domain", "lang"], "source")
    return leaves.select(*LEVELS, "tokens", "budget")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _order(seed: int, epoch: Column, ident: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), ident))


#: order of a leaf's rows inside an epoch; the cut is sought one step after the other
_STEPS = (["slot"], ["key", "ident"], ["part"], ["hash", "n_tokens"])


def _cuts(lengths: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """domain, lang, source, key, ident, hash, n_tokens of the rows that each leaf's budget ends in, and ``rest``,
    the tokens left for all of these rows together."""
    rows = lengths.join(leaves.where("rest > 0"), list(LEVELS)).where("n_tokens > 0")
    rows = rows.withColumn("key", _order(seed, F.col("epochs"), F.col("ident")))
    rows = rows.withColumn("slot", F.substring("key", 1, 4)).withColumn("part", F.shiftright("hash", 48))
    by: list[str] = []
    for step in _STEPS:
        by = [*by, *step]
        sums = rows.groupBy(*LEVELS, *by, "rest").agg(F.sum("n_tokens").alias("n"))
        upto = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
        ends = (sums.withColumn("before", upto - F.col("n"))
                .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") >= F.col("rest")))
                .select(*LEVELS, *by, (F.col("rest") - F.col("before")).alias("rest")))
        if step is _STEPS[-1]:
            return ends.select(*LEVELS, "key", "ident", "hash", "n_tokens", "rest")
        rows = staged(rows.drop("rest").join(ends, [*LEVELS, *by]), step[0])


def _numbered(rows: DataFrame, leaf: list[Column], name: str) -> DataFrame:
    """``rows`` and their number (column ``name``), from 0 within the leaf, counted by partition, so that no leaf is one task's."""
    own = [f"_leaf{i}" for i in range(len(leaf))]
    rows = staged(rows.select(F.struct("*").alias("row"), *(c.alias(n) for c, n in zip(leaf, own, strict=True)),
                              F.monotonically_increasing_id().alias("uid")), "tied")
    rows = rows.withColumn("dealt", F.shiftright("uid", 33))
    inside = F.row_number().over(Window.partitionBy(*own, "dealt").orderBy("uid"))
    sums = rows.groupBy(*own, "dealt").count()
    upto = F.sum("count").over(Window.partitionBy(*own).orderBy("dealt")) - F.col("count")
    rows = rows.withColumn("inside", inside).join(sums.select(*own, "dealt", upto.alias("upto")), [*own, "dealt"])
    return rows.select("row.*", (F.col("upto") + F.col("inside") - 1).alias(name))


def mix_sources(docs: DataFrame, domain: Column, weights: dict[tuple[str, ...], int], budget: float,
                max_epochs: int = 1, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Every input row with a struct ``mix``: domain, lang, source, n_tokens, epochs, part_tokens.

    epochs: whole copies taken; part_tokens: tokens of the last, cut epoch (the
    first ones of the document). Tokens are words. Null domain, language or
    source is the leaf name ``-``. Rows of equal id, null ids too, are ordered
    by a hash of their text; of rows equal in both, some are taken whole, one in
    part and the rest not, so every leaf takes its budget to the token. A row
    without words takes nothing. An input column ``mix`` is replaced, all
    others stay, whatever their names. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    name = F.coalesce
    docs = docs.withColumn("mix", F.struct(
        name(domain.cast("string"), F.lit("-")).alias("domain"), name(F.col(lang_col).cast("string"), F.lit("-")).alias("lang"),
        name(F.col(source_col).cast("string"), F.lit("-")).alias("source"), word_count(F.col(text_col)).alias("n_tokens"),
        name(F.col(id_col).cast("string"), F.lit("")).alias("ident"), F.xxhash64(text_col).alias("hash")))
    lengths = staged(docs.select("mix.*"), "lengths")
    sizes = lengths.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = staged(leaf_budgets(sizes, weights, budget, max_epochs).withColumn(
        "epochs", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0)).withColumn(
        "rest", F.col("budget") - F.col("epochs") * F.col("tokens")), "leaves").select(*LEVELS, "epochs", "rest")
    cuts = _cuts(lengths, leaves, seed).select(
        *LEVELS, F.struct("key", "ident", "hash", "n_tokens").alias("cut"), F.col("rest").alias("cut_tokens"))
    leaf = free_name(docs, "leaf")
    leaves = staged(leaves.drop("rest").join(cuts, list(LEVELS), "left"), "cuts").select(F.struct("*").alias(leaf))
    if leaves.count() <= BROADCAST_LEAVES:  # else a join that shuffles the documents
        leaves = F.broadcast(leaves)
    out = docs.join(leaves, [F.col(f"mix.{c}") == F.col(f"{leaf}.{c}") for c in LEVELS], "left")
    n, cut = F.col("mix.n_tokens"), F.col(f"{leaf}.cut")
    own = F.struct(_order(seed, F.col(f"{leaf}.epochs"), F.col("mix.ident")).alias("key"), F.col("mix.ident").alias("ident"),
                   F.col("mix.hash").alias("hash"), n.alias("n_tokens"))
    tied = cut.isNotNull() & (own == cut)

    def taken(rows: DataFrame, part: Column) -> DataFrame:
        return rows.withColumn("mix", F.struct(
            *(F.col(f"mix.{c}").alias(c) for c in LEVELS), n.alias("n_tokens"),
            F.when(n > 0, F.coalesce(f"{leaf}.epochs", F.lit(0))).otherwise(0).cast("long").alias("epochs"),
            part.cast("long").alias("part_tokens"))).select(*(f"`{c}`" for c in docs.columns))

    nth = free_name(out, "nth")
    ends = _numbered(out.where(tied).withColumn(leaf, F.struct(f"{leaf}.epochs", f"{leaf}.cut_tokens")),
                     [F.col(f"mix.{c}") for c in LEVELS], nth)
    rest = F.greatest(F.lit(0), F.least(n, F.col(f"{leaf}.cut_tokens") - F.col(nth) * n))
    whole = F.when(cut.isNull() | (own > cut), 0).otherwise(n)
    return taken(out.where(~tied), whole).unionByName(taken(ends, rest))


#: fixed values of the query: three domains by the source's number, target weights, budget
QUERY = {"weights": {("domain_0",): 2, ("domain_1",): 3, ("domain_2",): 1, ("domain_0", "en"): 2,
                     ("domain_1", "de"): 3}, "budget": 0.9, "max_epochs": 3, "seed": 7}


def source_domain(source: Column) -> Column:
    """Stand-in for a table of domains: the number that ends the source's name, modulo 3."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("domain_"), (number.cast("long") % 3).cast("string")))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Takes of every document under the fixed weights."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs, source_domain(F.col("source")), **QUERY).select("doc_id", "mix.*")


_FILL = """
{name}_a AS (SELECT *, CASE WHEN w > 0 THEN CAST(cap AS DOUBLE) / w ELSE 0 END AS f FROM {name}_in),
{name}_b AS (SELECT *, of - (sum(cap) OVER (PARTITION BY {parent} ORDER BY f, {key} ROWS UNBOUNDED PRECEDING) - cap) AS lft,
    sum(w) OVER (PARTITION BY {parent}) - sum(w) OVER (PARTITION BY {parent} ORDER BY f, {key} ROWS UNBOUNDED PRECEDING) + w AS wr
  FROM {name}_a),
{name}_c AS (SELECT *, CAST(cap AS HUGEINT) * wr <= CAST(lft AS HUGEINT) * w AS sat FROM {name}_b),
{name}_d AS (SELECT *, CASE WHEN sat THEN 0 ELSE w END AS ow,
    of - sum(CASE WHEN sat THEN cap ELSE 0 END) OVER (PARTITION BY {parent}) AS rst FROM {name}_c),
{name}_e AS (SELECT *, sum(ow) OVER (PARTITION BY {parent}) AS aw,
    sum(ow) OVER (PARTITION BY {parent} ORDER BY {key} ROWS UNBOUNDED PRECEDING) AS tw FROM {name}_d),
{name} AS (SELECT *, CAST(CASE WHEN sat THEN cap ELSE (CAST(rst AS HUGEINT) * tw) // aw
    - (CAST(rst AS HUGEINT) * (tw - ow)) // aw END AS BIGINT) AS budget FROM {name}_e)"""

#: the weights are written out again
SQL = {"op4_source_mixing": r"""
WITH d AS (
  SELECT doc_id, coalesce('domain_' || (CAST(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS BIGINT) % 3), '-') AS domain,
    coalesce(lang, '-') AS lang, coalesce(source, '-') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
s AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL),
l0 AS (SELECT domain, lang, sum(tokens * 3) AS cap FROM s GROUP BY ALL),
dom_in AS (SELECT domain, 0 AS one, sum(cap) AS cap,
    CASE domain WHEN 'domain_0' THEN 2 WHEN 'domain_1' THEN 3 ELSE 1 END AS w,
    least((SELECT CAST(floor(sum(tokens) * CAST(0.9 AS DOUBLE)) AS BIGINT) FROM s), (SELECT sum(cap) FROM l0)) AS of FROM l0 GROUP BY domain),
""" + _FILL.format(name="dom", parent="one", key="domain") + r""",
lng_in AS (SELECT l0.domain, l0.lang, l0.cap, dom.budget AS of,
    CASE WHEN l0.domain = 'domain_0' AND l0.lang = 'en' THEN 2 WHEN l0.domain = 'domain_1' AND l0.lang = 'de' THEN 3 ELSE 1 END AS w
  FROM l0 JOIN dom USING (domain)),
""" + _FILL.format(name="lng", parent="domain", key="lang") + r""",
src_in AS (SELECT s.domain, s.lang, s.source, s.tokens, s.tokens * 3 AS cap, lng.budget AS of, 1 AS w
  FROM s JOIN lng USING (domain, lang)),
""" + _FILL.format(name="src", parent="domain, lang", key="source") + r""",
r AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS ep, tokens, budget FROM src),
k AS (SELECT d.*, r.ep, r.budget - r.ep * r.tokens AS rest,
    sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source ORDER BY md5('7:' || r.ep || ':' || doc_id), doc_id, n_tokens
      ROWS UNBOUNDED PRECEDING) - n_tokens AS start
  FROM d JOIN r ON d.domain = r.domain AND d.lang = r.lang AND d.source = r.source)
SELECT doc_id, domain, lang, source, n_tokens, CAST(CASE WHEN n_tokens > 0 THEN ep ELSE 0 END AS BIGINT) AS epochs,
  CAST(greatest(0, least(n_tokens, rest - start)) AS BIGINT) AS part_tokens
FROM k
"""}
