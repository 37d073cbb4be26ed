"""The corpus pipeline: language, toxicity, near duplicates, benchmark
contamination, then the mixed order of the sources.

Each stage is (spark, docs, sf_dir) -> DataFrame over all rows its predecessor
kept; all but the last return the columns of ``docs``.  ``run`` writes the result
of each stage as Parquet in the shared checkpoint folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, langid, mixing, toxicity
from tessera.llm.jaccard import jaccard_components
from tessera.llm.queries import BLOCK, TEMPER
from tessera.llm.scratch import written
from tessera.sources.tables import table

#: Toxic from this score on.
TOXIC = 0.7


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without text or without a letter go."""
    found = langid.predict(docs, langid.fit(docs))
    return found.where(F.col("lang_pred") != "und").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score, learnt from all labels, is below ``TOXIC``."""
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).where(F.col("score") < TOXIC).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that links of near-equal shingle sets hold together:
    the one of smallest id (a null id is the largest; rows that share the id:
    any one).  A row without words has no links and stays.  Rows are told apart
    by a key of their own, so those that only share an id, or have none, stay."""
    keyed = written(docs.withColumn("_key", F.monotonically_increasing_id()), "pipeline-keyed")
    groups = jaccard_components(keyed, "_key").join(keyed.select("_key", "doc_id"), "_key")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key"))
    kept = groups.groupBy("component_id").agg(least.alias("least")).select(F.col("least._key").alias("_key"))
    return keyed.join(kept, "_key", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in benchmark windows."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix: sorted by slot and at."""
    mixed = mixing.mix(docs, "source", TEMPER, BLOCK, F.char_length("text"))
    return mixed.select("row.*", "phase", "block", "slot", "at")


STAGES = [("language ID", identify_language), ("toxicity", drop_toxic), ("n-gram Jaccard join", drop_near_copies),
          ("benchmark decontamination", drop_contaminated), ("mixing sources to target weights", mix_sources)]

#: No SQL says what the fitted classifiers decide; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-stage")
    return STAGES[-1][1](spark, docs, sf_dir)
