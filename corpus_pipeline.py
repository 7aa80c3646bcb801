"""A training corpus from raw documents: five stages, each one operator of the library.

1. quality: a factorisation machine, fitted on the labelled rows, drops what it rejects.
2. near duplicates: one row of each group of linked texts stays, that of least id.
3. personal data: spans are replaced by the name of their kind.
4. mixing: sources are brought to their target weights; a document may repeat.
5. encoding: the ids of every document, and the digest of what they decode to.

Every stage is written as Parquet and read again before the next, so a lost executor
never costs more than a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.llm.bpe import code_text
from metricspark.llm.common import table
from metricspark.llm.jaccard import jaccard_components
from metricspark.llm.mixing import mixed_documents
from metricspark.llm.pii import fit_pii, redact_documents
from metricspark.llm.quality import THRESHOLD, fit_quality, score_quality, training_labels
from metricspark.session import work_path

# The stages learn models and work iteratively, which SQL cannot express.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_quality(docs, training_labels(table(spark, sf_dir, "labels")))
    return score_quality(docs, model, out="_quality").where(F.col("_quality") >= THRESHOLD).drop("_quality")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without an id have no group and stay.

    Texts are linked, not ids: rows that share an id but hold unrelated texts all stay.
    """
    keyed = docs.where(F.col("doc_id").isNotNull()).withColumn("_key", F.xxhash64("doc_id", "text"))
    groups = jaccard_components(keyed.select(F.col("_key").alias("doc_id"), "text"))
    named = groups.select(F.col("doc_id").alias("_key"), "component_id").distinct().join(keyed.select("_key", "doc_id").distinct(), "_key")
    least = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "_key")).alias("_least"))
    # equal rows of one id and text fall together in the tasks that read them
    single = keyed.groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("_row"))
    known = single.join(least.select("_least._key"), "_key", "left_semi")
    return known.select("_row.*").unionByName(docs.where(F.col("doc_id").isNull()))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = redact_documents(docs, fit_pii(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = code_text(docs.select("doc_id", "source", "text"))
    return coded.select(
        "doc_id",
        "source",
        (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mix", mix_sources),
    ("encode", encode_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
