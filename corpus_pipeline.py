"""A corpus from raw documents to packed sequences, stage by stage.

Quality rules, language identification, near duplicates, repeated passages, packing. A stage gets
what its predecessor kept, written as Parquet and read again. Quality rules drop rejected
documents, language identification those in none of the labelled languages (without labelled
rows, those without a letter), the near-duplicate stage all but one of each group of documents
that share 80 % of their five-word shingles, passages of 20 words that occur earlier are cut from
the texts, and what is left is packed into sequences.

Defined cases, the same in all stages: null, empty and blank texts fail the quality rules, so later
stages don't meet them; each stage on its own takes them, and its function says what becomes of
them. Very long texts count whole. Repeated rows and ids are judged row by row. Rows without an id
are taken like others and come last where ids are compared. Columns go by place: further columns,
whatever their names and types, are carried along by all stages but the last. An empty table gives
an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareweather.llm.language import keep_identified
from fareweather.llm.ngram_join import keep_one
from fareweather.llm.packing import pack
from fareweather.llm.rules import keep_good
from fareweather.llm.substrings import drop_repeats
from fareweather.session import scratch_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without words and what the rules' posterior takes for junk; one half is kept."""
    return keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those too far from each learned language; ties go to the first one."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of similar texts the row of least id; texts without words are all kept."""
    return keep_one(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that occur earlier by id; drops no row, leaves texts without words as they are."""
    return drop_repeats(docs, window=20)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places each text, also an empty one (its end alone), in pieces if it is longer than a bin."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packed_sequences", packed_sequences),
]

#: Expectation maximisation and kernel regression are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = scratch_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
