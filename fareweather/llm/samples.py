"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareweather.llm.tasks import by_place, held_out, stored


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int, remainder: int = 0) -> DataFrame:
    """``doc_id``, ``label``, ``weight`` and ``text`` of up to ``per_class`` labelled documents of each class.

    Only labels of ids that ``documents`` has count, so that the bound is filled by rows that are
    there. Rows whose crc32 remainder is ``remainder``, and rows without an id or a label, are
    never taken. Which of the others are taken follows from a hash of the id, so the same tables
    give the same sample. ``weight`` is how many documents of the class a sampled one stands for.
    Repeated ids count once, with label 1 where their labels differ, and with one text, chosen by
    its hash, where their texts differ.
    """
    named = by_place(labels, "doc_id", label).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = named.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", remainder))
    texts = by_place(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = stored(usable.groupBy("doc_id").agg(F.max("label").alias("label")).join(texts.select("doc_id"), "doc_id", "left_semi"))
    sizes = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    taken = [
        known.filter(F.col("label") == value)
        .withColumn("weight", F.lit(max(1.0, sizes.get(value, 0) / per_class)))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(per_class)
        for value in (0, 1)
    ]
    sample = texts.join(F.broadcast(taken[0].unionByName(taken[1])), "doc_id")
    one_text = F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text"))).alias("text")
    return sample.groupBy("doc_id").agg(F.first("label").alias("label"), F.first("weight").alias("weight"), one_text)


def in_one_task(df: DataFrame, *order: Column) -> DataFrame:
    """A bounded sample as one ordered stream."""
    return df.repartition(1).sortWithinPartitions(*order)
