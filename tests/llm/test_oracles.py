"""Queries that SQL can express, against DuckDB."""

import pytest
from helpers import DOCS, EDGES, SF, as_rows, documents, oracle, saved

from busframes.llm.catalog import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    assert as_rows(df.columns, df.collect()) == oracle(ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["op9_ngram_join", "op10_adaptive_quality_rules"])
def test_awkward_documents(spark, tmp_dir, name):
    long = " ".join(f"w{i % 97}x{i % 13}" for i in range(5000))
    near = [" ".join(f"t{j}" for j in range(60) if j != skip) for skip in (100, 59, 0, 30)]
    docs = documents(spark, [*EDGES, *EDGES[3:], long, long + " tail", *near])
    saved(spark, tmp_dir, documents=docs)
    df = QUERIES[name](spark, tmp_dir)
    assert as_rows(df.columns, df.collect()) == oracle(ORACLE_SQL[name], documents=docs.toArrow())


def test_empty_tables(spark, tmp_dir):
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    saved(spark, tmp_dir, documents=spark.createDataFrame([], DOCS), conversations=chats, benchmark=bench, labels=labels)
    for name, query in QUERIES.items():
        assert query(spark, tmp_dir).count() == 0, name
