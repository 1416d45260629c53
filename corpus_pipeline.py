"""The corpus pipeline: documents -> training mix, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; its
result is written as Parquet in the shared folder and read again as the next one's ``docs``.
Defined results of nulls, empty texts, ties and repeated rows are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maintspark.llm import decontam, line_dedup, near_dup, pareto_mix, toxic_grammar
from maintspark.llm.store import write_table

#: No SQL can learn the toxicity grammar; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3; learned from the labelled ones that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    train = docs.where(~F.coalesce(toxic_grammar.held_out(F.col("doc_id")), F.lit(False)))
    return toxic_grammar.reject_toxic(docs, toxic_grammar.learn(train, labels))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is verbatim benchmark."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return pareto_mix.mix(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_deduplication), ("near_dedup", near_deduplication),
          ("decontamination", decontamination), ("mixing", mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``STAGES`` one after another over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
