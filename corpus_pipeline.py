"""From raw documents to a training mix: five stages, each one operator of ``upshot.llm``.

A stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each
result as Parquet to the shared folder and reads it back as the next stage's
documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upshot.llm import decontaminate, mixing, simhash, suffix_dedup, toxicity
from upshot.llm.common import cut
from upshot.llm.queries import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the model learns from labels outside the held-out fifth."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    return docs.withColumn("__score", toxicity.score(model, F.col("text"), docs)).where("__score < 0.5").drop("__score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated bytes; every document stays, n_chars follows its text."""
    left = suffix_dedup.remove_repeats(docs).withColumn(
        "text", F.when(F.col("__removed.n_removed") > 0, F.col("__removed.kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("__removed.n_removed") > 0, F.char_length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which less than a twentieth of the words lies in benchmark windows."""
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated(F.col("__match"))).drop("__match")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix of what is left: words taken and training position of each document."""
    return mixing.mix(docs).drop("positions")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]

#: SQL can express neither the trained scores nor the components; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
