"""The registered queries over the smallest tables, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from fieldgauge.llm.oracle import ORACLE
from fieldgauge.llm.queries import QUERIES
from fieldgauge.llm.tables import written

DATA = "/root/testdata/sf0.001"


def test_registered():
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark"):
        duck.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    rows = QUERIES[name](spark, DATA).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(result.fetchall())


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, DATA), name)
        counts.append(docs.count())
        assert docs.columns[: len(columns)] == columns
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0]
    assert docs.where("taken < 0 or taken > 2 * size").count() == 0


def test_stages_on_odd_and_empty_rows(spark):
    schema = spark.read.parquet(f"{DATA}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (3, "w " * 50, None, "a", 100), (3, "w " * 50, None, "a", 100)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, DATA)
        docs.collect()
