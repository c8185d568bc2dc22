"""The corpus pipeline: language ID, line dedup, near-duplicate removal, benchmark decontamination, packing.

Each stage takes the documents its predecessor kept and returns the columns of ``documents``; the last returns the packed pieces.
Stages are written as Parquet in the shared folder and read back, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.llm import copies, decontaminate, language, lines, packing, queries
from tarifa.session import save
from tarifa.sources.tables import read_table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without a letter or unlike every language go."""
    return language.identify(queries.document_evidence(docs)).filter("kept").select(docs.columns)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that occur in many of them, which only the first one keeps; ``n_chars`` is counted anew."""
    found = lines.drop_common_lines(docs, keep_first=True)
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: at least 0.8 of the five-word shingles of two linked ones are shared."""
    return copies.keep_one(docs, size=5, least=0.8)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.filter("n_hit = 0").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed token stream."""
    return packing.pack(docs, queries.tokenizer_path()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language", known_language),
    ("lines", without_common_lines),
    ("near_copies", one_of_each),
    ("benchmark", without_benchmark),
    ("packing", packed),
]
# Trained models, hashes and tokenizers are not in SQL's reach; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
