"""The registered queries, their SQL, and the pipeline."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from fareweather.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.llm.fixtures import odd_documents
from tests.oracle import assert_same, connect


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 1 + len(QUERIES)))
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries())
    assert set(ORACLE_SQL) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert_same(registry.queries()[name](spark, SMALL), connect(SMALL), ORACLE_SQL[name])


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLE_SQL])
def test_query_covers_its_table(spark, name):
    table = "embeddings" if "embedding" in name else "conversations" if "conversation" in name else "documents"
    rows = registry.queries()[name](spark, SMALL)
    key = rows.columns[0]
    expected = spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).distinct().count()
    assert rows.select(key).distinct().count() == expected
    assert rows.count() == expected or name.startswith("op5")


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = odd_documents(spark)
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] >= 50
    assert counts[4] == counts[3]  # cutting passages drops no document
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns == ["doc_id", "piece", "n_tokens", "bin_id", "bin_offset", "bin_capacity"]
    assert rows.count() > 100
