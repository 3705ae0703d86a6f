"""A training-data pipeline over the table documents: STAGES in order, each stage's rows written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rigstream import ensure_checkpoint_dir
from rigstream.llm import bpe, jaccard, language, mixing, toxicity
from rigstream.llm.common import arrow_batches, measured, table
from rigstream.session import materialised


#: Columns of documents that the stages work with; all others pass through them under names of their own.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rows go to Python in batches of so many bytes, whatever their number.
BATCH_BYTES = "4m"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def shielded(stage: Stage) -> Stage:
    """A stage that leaves further columns alone, whatever their names: to the stage they are ``_further_<n>``."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in COLUMNS else f"_further_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), sf_dir).select(*names).toDF(*docs.columns)

    return run


@shielded
def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents whose score is at least 0.5; all labels of the table labels teach the scorer."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("predicted") == 0).select(*docs.columns)


@shielded
def unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents without letters, and those that no language's model describes."""
    model = language.fit(docs.select("lang", "text"))
    return language.identify(docs, model).where(language.recognised()).select(*docs.columns)


@shielded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of documents alike (five words, 0.8): the one of the smallest id.

    Null ids come last; of rows of one component and id that with the smallest text stays. Rows are told
    apart by id and text, so texts of one id that are not alike all stay, and documents without words.
    """
    key = F.xxhash64("doc_id", "text").alias("_key")
    found = jaccard.linked_components(docs.select(key.alias("doc_id"), "text")).where("n_shingles > 0")
    of = found.groupBy(F.col("doc_id").alias("_key")).agg(F.min("component_id").alias("_component"))
    rows = docs.groupBy(key).agg(F.min("doc_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    members = materialised(rows.join(of, "_key"))
    several = members.groupBy("_component").agg(F.min("_id").alias("_least"), F.sum("_n").alias("_rows")).where("_rows > 1")
    members = materialised(members.join(measured(several.select("_component", "_least")), "_component"))
    first = F.col("_id").eqNullSafe(F.col("_least"))
    gone = measured(members.where(~first).select("_key"))
    kept = docs.withColumn("_key", key).join(gone, "_key", "left_anti")
    # only rows that share component and id are put together, so that texts do not move for the others
    left = members.where(first).groupBy("_component").agg(F.sum("_n").alias("_left")).where("_left > 1")
    twice = measured(members.where(first).join(left, "_component").select("_key", "_component"))
    if twice.isEmpty():
        return kept.select(*docs.columns)
    columns = ["text", *[c for c in docs.columns if c != "text"]]
    least = kept.join(twice, "_key").groupBy("_component").agg(F.min(F.struct(*columns)).alias("_row"))
    once = least.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
    return kept.join(twice, "_key", "left_anti").select(*docs.columns).unionByName(once)


@shielded
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, and digests of the ids and of what they decode to, of every text."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN, ["doc_id"])


STAGES = [
    ("toxicity", toxic_documents),
    ("language", unknown_languages),
    ("near_duplicates", near_duplicates),
    ("mixing", mixed_sources),
    ("bpe", tokens),
]

#: No stage but the last could be said in SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's rows go through Parquet in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    with arrow_batches(spark, BATCH_BYTES):
        for name, stage in STAGES:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
