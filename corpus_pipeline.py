"""The corpus pipeline: five operators in order, each over all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and gives the columns of ``docs`` back
(the last adds its pieces); ``run`` writes each result to the shared folder and
rereads it, so a lost executor costs no more than the stage it worked on.

Edge cases follow the operators: documents without letters (null and empty
texts too) are rejected by the first stage; a null id is kept and links with
nothing; rows repeating an id are one document; other columns pass through; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.llm import decontaminate, language_id, near_dup, piece_sampling, private_spans
from tsengine.llm._common import bound_batches, save_table

BROADCAST_IDS = 500_000


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, in effect: a text in a language that no
    label names counts as the nearest known one and stays."""
    bound_batches(spark)
    model = language_id.fit_text(docs)
    judged = language_id.classify(docs, model, "text", declared=docs["lang"], host=docs["source"])
    return judged.where("accepted").select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group (five-word shingles, 0.8)."""
    bound_batches(spark)
    gone = save_table(near_dup.near_duplicates(docs, "doc_id", "text").where("not kept").select("doc_id").distinct(),
                      "dropped")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    bound_batches(spark)
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts and counts their characters anew."""
    bound_batches(spark)
    masked = private_spans.redact(docs, private_spans.fit(docs))
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds sampled pieces; ``text`` is what they decode to, and ``lossless``
    tells that this is the text they came from."""
    bound_batches(spark)
    coded = piece_sampling.encode(docs, "doc_id", "text", decoded="decoded")
    keep = [F.col("decoded").alias(c) if c == "text" else F.col(c) for c in docs.columns]
    return coded.select(*keep, "pieces", F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


STAGES = [
    ("language_id", language_stage),
    ("minhash_near_dedup", dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", private_stage),
    ("sentencepiece", pieces_stage),
]

# Trained models and sampling decide rows: no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save_table(stage(spark, docs, sf_dir), name)
    return docs
