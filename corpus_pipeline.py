"""Training-corpus pipeline: each stage is written as Parquet and reread by the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoincident.llm import benchmark_index, language_ppm, ngram_join, source_mixing, token_repair
from geoincident.llm.common import free_name, prepare, staged

#: a language is taken for known from this share of the best one on
LEAST_SHARE = 0.5
#: share of the tokens that the mixture takes, and the domains' weights
MIX = {"weights": {("domain_0",): 2, ("domain_1",): 2, ("domain_2",): 2}, "budget": 0.9, "max_epochs": 1, "seed": 7}


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language; noise, other languages and texts without letters go.

    The model learns from the folds other than 0. Labelled documents of fold 0
    tell what code length per byte their language usually needs; a document
    that needs far more in the best language is in none of them.
    """
    model = spark.sparkContext.broadcast(language_ppm.train(docs.where(language_ppm.fold() != 0)))
    usual = language_ppm.usual_rates(docs.where(language_ppm.fold() == 0), model)
    lang, share, bits = names = tuple(free_name(docs, c) for c in ("__lang", "__share", "__bits"))
    known = language_ppm.identify(docs, model, docs.columns, names=names)
    return known.where((F.col(share) >= LEAST_SHARE) & language_ppm.fits(
        F.col(lang), F.col(bits), F.col("text"), usual)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one of the smallest id, of each group of near copies (5 words, 0.8).

    Documents without words are no copies of each other. Of rows equal in id
    and text one stays; rows that share an id only are judged by their texts.
    """
    groups = ngram_join.ngram_jaccard_components(docs, n=5, num=80, den=100)
    lone = F.when(F.col("n_shingles") == 0, F.col("row_key"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", F.col("row_key").alias("row"))  # null ids last
    row = free_name(docs, "__row")
    stay = (groups.groupBy("root", lone).agg(F.min(first).alias("first"))
            .select(F.col("first.row").alias(row)))
    return (docs.withColumn(row, _row_key()).join(stay.hint("merge"), row, "left_semi")
            .dropDuplicates([row]).select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of ten words of a benchmark item."""
    found = benchmark_index.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    row = free_name(docs, "__row")
    hit = found.where("contaminated").select(F.col("row_key").alias(row)).distinct()
    return docs.withColumn(row, _row_key()).join(hit.hint("merge"), row, "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, whole, the documents that the mixture takes tokens of."""
    free = free_name(docs, "__own_mix")
    own = docs.withColumnRenamed("mix", free)  # a column of this name is the caller's
    mixed = source_mixing.mix_sources(own, source_mixing.source_domain(F.col("source")), **MIX)
    kept = mixed.where("mix.epochs + mix.part_tokens > 0").select(*own.columns)
    return kept.withColumnRenamed(free, "mix")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the documents' ids in the binary format and returns what is read back per document."""
    import public_tokenizers

    return token_repair.digest(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_copies", near_copies), ("decontaminate", decontaminate),
          ("mix", mix), ("tokens", tokens)]

#: language identification and Re-Pair have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of ``sf_dir``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
