"""From raw documents to token records: the stages of a training corpus in order.

Each stage gets what the stage before it kept, as a table written in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import language_id, mixing, queries, record_files, simhash_ball, template_leaks
from staylens.llm.common import fresh_name, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; the model learns from these documents' own labels."""
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = fresh_name(docs, "_found")
    known = docs.withColumn(found, language_id.identify(model, F.col("text")))
    return known.filter(F.col(found)["accepted"]).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_ball.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return template_leaks.decontaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may come twice."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records in the shared folder; what is read back from them, one row a record."""
    return record_files.read_records(record_files.write_records(docs, queries.vocabulary(), queries.END_ID))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("source_mixing", mix),
    ("token_records", write_tokens),
]

#: Clustering, fingerprints and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
