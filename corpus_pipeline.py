"""From raw documents to token ids in five stages, each written as Parquet and read again by the next.

Language ID keeps documents in a language that the labels of the corpus teach; exact dedup keeps the row with the
largest doc_id of each set of equal texts; near dedup keeps the smallest doc_id of each SimHash group (three-word shingles,
two bits); decontamination drops documents in which a benchmark item is found; the last stage gives piece ids and the
text decoded from them.
What every stage does with nulls, empty and long texts, ties, repeated rows, empty tables and further columns is
stated in the docstring of its operator's module; all stages but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxlake.llm import decontamination, exact_dedup, language_id, sentencepiece_fst, simhash
from boxlake.llm.common import documents, freeze
from boxlake.session import ship_package


def language_id_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return language_id.keep_known_languages(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return exact_dedup.keep_one_of_each(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_first_of_groups(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(spark, docs, benchmark)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return sentencepiece_fst.encode_and_decode(docs)


STAGES = [
    ("language_id", language_id_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: The language model and the piece lattice can't be stated in SQL.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
