"""Stages that turn the documents into a weighted training mix."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkeep.llm.decontamination import drop_contaminated
from starkeep.llm.linededup import drop_repeated_lines
from starkeep.llm.mixing import mix
from starkeep.llm.neardup import keep_one
from starkeep.llm.toxicity import fit, score
from starkeep.sources.files import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It is fitted on all labels there are."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit(docs.select("doc_id", "text"), labels)
    return score(docs, model).filter("predicted = 0").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated in many documents stay in one; ``n_chars`` follows the text. No document goes."""
    kept = drop_repeated_lines(docs)
    size = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", size).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8) stays."""
    return keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes: ``doc_id, source, size, source_size, target, taken``."""
    return mix(docs.select("doc_id", "source", "text"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("source mixing", mixing_stage),
]

#: The stages use learned models and hashes that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
