"""Benchmark decontamination by a distributed positional inverted index (op 10), native.

1. One pass stores the postings (row, position, term) of every word of the
   documents that some benchmark item uses, and one posting past the last word
   of each document, which holds its length.
2. Document frequencies come from the postings. Of each window of an item
   (``window`` consecutive words, or all of a shorter item) the ``anchors``
   rarest terms are its anchors.
3. The postings of anchors, moved back by the anchor's offset in the item, give
   the place where the item would start; places where at least as many
   different anchors meet as a window has survive.
4. There the windows are compared word by word with the whole text, which gives
   the exact phrases. Anchors that meet within ``slack`` words of each other
   but not in line give proximity matches.

The benchmark is the query set; it is worked through in blocks of at most about
``block_words`` words, which bounds what is broadcast. Only DataFrame functions run.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoincident.llm.common import prepare, scratch, staged

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: no word: stands past the last word of a text
_LAST = "\x00"


def words_of(text: Column) -> Column:
    """Words after lower-casing A-Z; none for null."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, _BETWEEN), lambda w: w != "")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = 10, anchors: int = 2,
                  slack: int = 3, block_words: int = 2_000_000) -> DataFrame:
    """Exact and near matches of every row: id, n_words, n_hit, n_items, items (array of item ids as
    strings, sorted), n_near (items with a proximity or exact match), contaminated,
    row_key (xxhash64 of id and text).

    A word is hit if it is inside an occurrence of a window. Null text and text
    without words: no words, nothing hit; such items are never found. Items
    that share an id count as one in n_items. Rows equal in id and text give
    equal rows. Extra columns are ignored; empty tables give no row or no hit.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("id", "text"))
    items = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                         words_of(F.col(item_text)).alias("words"))
    with scratch(spark) as keep:
        found = _search(rows, items, window, anchors, slack, block_words)
        return keep(found.withColumnRenamed("id", id_col), "found")


def _search(rows: DataFrame, items: DataFrame, window: int, anchors: int, slack: int, block_words: int) -> DataFrame:
    items = staged(items.where(F.size("words") > 0).withColumn("n", F.size("words"))
                   .withColumn("unit", F.monotonically_increasing_id()), "items")
    blocks = max(1, -(-(items.agg(F.sum("n")).first()[0] or 0) // block_words))
    lengths, found = None, None
    for block in range(blocks):
        part = items.where(F.expr(f"pmod(xxhash64(unit), {blocks}) = {block}"))
        postings, own = _block(rows, part, window, anchors, slack)
        found = own if found is None else found.unionByName(own)
        if lengths is None:
            lengths = postings.where("term = 0").select("row", "id", F.col("pos").cast("long").alias("n_words"))
    per_row = found.groupBy("row").agg(
        F.flatten(F.collect_list("hit")).alias("hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    out = lengths.join(per_row, "row", "left")
    none = F.array().cast("array<string>")
    hits = F.coalesce(F.size(F.array_distinct("hit")), F.lit(0)).cast("long")
    return out.select(
        "id", "n_words", hits.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
        F.coalesce(F.size("near"), F.lit(0)).cast("long").alias("n_near"), (hits > 0).alias("contaminated"),
        F.col("row").alias("row_key"))


def _block(rows: DataFrame, items: DataFrame, window: int, anchors: int, slack: int) -> tuple[DataFrame, DataFrame]:
    """The postings for these items, and per row the words hit, the items found and the items near."""
    terms = items.select(F.explode("words").alias("word")).distinct()
    terms = staged(terms.select("word", F.xxhash64("word").alias("term")).unionByName(
        rows.sparkSession.range(1).select(F.lit(_LAST).alias("word"), F.lit(0).cast("long").alias("term"))), "terms")
    words = rows.select("row", "id", F.posexplode(F.concat(words_of(F.col("text")), F.array(F.lit(_LAST)))).alias("pos", "word"))
    postings = staged(words.join(F.broadcast(terms), "word").select("row", "id", "pos", "term"), "postings")
    frequency = postings.groupBy("term").agg(F.count("*").alias("df"))

    spelled = items.select("unit", "n", F.posexplode("words").alias("at", "word")).join(terms, "word").join(
        frequency, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    spelled = spelled.withColumn("start", F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("at") - (window - 1)),
        F.greatest(F.lit(0), F.least(F.col("at"), F.col("n") - window)))))
    rare = Window.partitionBy("unit", "start").orderBy("df", "word", "at")
    chosen = spelled.withColumn("nth", F.row_number().over(rare)).where(F.col("nth") <= anchors)
    needed = F.least(F.lit(anchors), F.col("n")).alias("needed")
    anchor = staged(chosen.select("unit", needed, "term", "at").distinct(), "anchors")
    placed = postings.join(F.broadcast(anchor), "term").select(
        "row", "unit", "needed", "at", (F.col("pos") - F.col("at")).alias("place"))
    placed = staged(placed, "placed")
    exact = (placed.groupBy("row", "unit", "needed", "place").agg(F.count_distinct("at").alias("met"))
             .where("met >= needed").select("row", "unit", "place"))
    wide = 2 * slack
    cell = F.explode(F.array(F.struct(F.lit(0).alias("grid"), F.floor(F.col("place") / wide).alias("cell")),
                             F.struct(F.lit(1).alias("grid"), F.floor((F.col("place") + slack) / wide).alias("cell"))))
    near = (placed.select("row", "unit", "needed", "at", cell.alias("c")).groupBy("row", "unit", "needed", "c")
            .agg(F.count_distinct("at").alias("met")).where("met >= needed").select("row", "unit").distinct())
    near = near.join(items.select("unit", "item"), "unit").groupBy("row").agg(F.collect_set("item").alias("near"))
    places = exact.join(items.select("unit", "item", "words"), "unit").groupBy("row").agg(
        F.collect_list(F.struct("item", "place", F.col("words").alias("own"))).alias("places"))
    texts = rows.join(places.hint("merge"), "row").dropDuplicates(["row"]).select("row", "places", words_of(F.col("text")).alias("words"))

    def starts(p: Column) -> Column:
        k = F.least(F.lit(window), F.size(p["own"]))
        low = F.greatest(F.lit(0), -p["place"])
        high = F.least(F.size(p["own"]) - k, F.size("words") - k - p["place"])
        return F.when(low <= high, F.filter(
            F.sequence(low, F.greatest(low, high)),
            lambda s: F.slice("words", p["place"] + s + 1, k) == F.slice(p["own"], s + 1, k))).otherwise(
            F.array().cast("array<int>"))

    seen = F.filter(F.transform("places", lambda p: F.struct(p["item"].alias("item"), F.flatten(F.transform(
        starts(p), lambda s: F.sequence(p["place"] + s, p["place"] + s + F.least(F.lit(window), F.size(p["own"])) - 1))).alias("hit"))),
        lambda x: F.size(x["hit"]) > 0)
    texts = texts.select("row", seen.alias("seen")).select(
        "row", F.array_distinct(F.flatten("seen.hit")).alias("hit"), F.array_distinct("seen.item").alias("items"))
    return postings, near.join(texts, "row", "full").select(
        "row", F.coalesce("hit", F.array().cast("array<int>")).alias("hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("near", F.array().cast("array<string>")).alias("near"))


def op10_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, windows of 10 words."""
    out = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items", "row_key")
