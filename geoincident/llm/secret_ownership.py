"""Secret scan with corpus-wide ownership frequency (op 6), native.

Candidates are found by pattern in every whole text. Their hashes are then
aggregated over the corpus by distinct repositories and owners: a value that
many owners carry is a copied example, one that few carry and that looks random
is a live-looking credential of its owner and gives an added span ``live``.

Spans come from the texts between and of the matches: both sequences of lengths
add up to the places of all matches. Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoincident.llm.common import prepare, staged

#: fixed values: kind, pattern, group of the value, least length of it
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: a text without one of these has no candidate of the kind
_NEEDED = {"assign": KINDS[0][1], "access": r"AKIA[A-Z0-9]{14}", "hex": r"[0-9a-f]{16}"}
#: runs shorter than the least length can be passed over: no match of these two starts inside another
_FASTER = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}


def _matches(kind: str, pattern: str, group: int) -> Column:
    """Array of (nth, gap before the match, length, value) or null."""
    pattern = _FASTER.get(kind, pattern)
    text = F.col("text")
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    parts = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"),
                         F.transform(whole, lambda x: F.length(x)).alias("size"), value.alias("value"))
    return F.when(text.rlike(_NEEDED[kind]), parts)


def looks_random(value: Column) -> Column:
    """At least one letter, one digit and eight different characters."""
    return (value.rlike("[A-Za-z]") & value.rlike("[0-9]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= 8))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository: Column | None = None,
                 owner: Column | None = None, copied_owners: int = 3) -> DataFrame:
    """Candidates of every row: id, kind counts, base_sha256, spans, n_live, n_copied.

    ``repository`` defaults to the column source; ``owner`` to the part of it
    before the first slash. A value is copied if at least ``copied_owners``
    owners or repositories hold it. Null or empty text has no candidates; a null owner or
    repository counts as none. Every input row gives one result row, repeated
    rows and ids too. Extra columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    repository = F.col("source") if repository is None else repository
    owner = F.substring_index(repository.cast("string"), "/", 1) if owner is None else owner
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"),
                       repository.cast("string").alias("repository"), owner.cast("string").alias("owner"))
    found = staged(rows.select("id", "repository", "owner", F.monotonically_increasing_id().alias("row"),
                               *(_matches(k, p, g).alias(k) for k, p, g, _ in KINDS)), "matches")
    hits = None
    for rank, (kind, _, _, least) in enumerate(KINDS):
        one = found.where(F.col(kind).isNotNull()).select(
            "row", "repository", "owner", F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), F.posexplode(kind).alias("nth", "m"))
        inside = Window.partitionBy("row").orderBy("nth")
        one = one.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(inside)).withColumn(
            "start", F.col("end") - F.col("m.size"))
        one = one.withColumn("value", F.col("m.value")).where(F.length("value") >= least).select(
            "row", "repository", "owner", "kind", "rank", "start", "end", "value",
            F.sha2("value", 256).alias("hash"), looks_random(F.col("value")).alias("random"))
        hits = one if hits is None else hits.unionByName(one)
    hits = staged(hits, "hits")
    spread = (hits.select("hash", "owner", "repository").distinct().groupBy("hash")
              .agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories")))
    copied = (F.col("owners") >= copied_owners) | (F.col("repositories") >= copied_owners)
    judged = hits.join(spread, "hash").select(
        "row", "kind", "rank", "start", "end", copied.alias("copied"), (~copied & F.col("random")).alias("live"),
        (F.col("end") - F.length("value")).alias("value_start"))
    spans = judged.select("row", "start", "rank", F.concat_ws(":", "kind", "start", "end").alias("span"), "copied",
                          F.lit(False).alias("added")).unionByName(
        judged.where("live").select("row", F.col("value_start").alias("start"), F.lit(len(KINDS)).alias("rank"),
                                    F.concat_ws(":", F.lit("live"), "value_start", "end").alias("span"),
                                    F.lit(False).alias("copied"), F.lit(True).alias("added")).distinct())
    per_row = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "rank", "span"))).alias("all"),
        *(F.count(F.when(F.col("rank") == r, 1)).alias(f"n_{k}") for r, (k, _, _, _) in enumerate(KINDS)),
        F.count(F.when(F.col("added"), 1)).alias("n_live"), F.count(F.when(F.col("copied"), 1)).alias("n_copied"))
    out = found.select("row", "id").join(per_row, "row", "left")
    listed = F.coalesce("all", F.array().cast("array<struct<start:bigint,rank:int,span:string>>"))
    base = F.filter(listed, lambda s: s["rank"] < len(KINDS))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: s["span"]), ",")
    return out.select(
        F.col("id").alias(id_col), *(F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k, _, _, _ in KINDS),
        F.sha2(text(base), 256).alias("base_sha256"), text(listed).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))


def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; a source is a repository."""
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
