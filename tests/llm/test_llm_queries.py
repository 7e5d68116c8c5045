"""Queries against their SQL on the smallest tables, and the pipeline stage by stage."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from ordermill.llm.oracles import ORACLES
from ordermill.llm.queries import QUERIES
from tests.conftest import rows
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_packing import check as check_packing
from tests.llm.test_shingle_join import brute as brute_components

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{path}'")
    return connection


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(driver.queries()) >= {*QUERIES, "pipeline"} and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, database, name):
    result = QUERIES[name](spark, TABLES)
    expected = database.sql(ORACLES[name])
    columns = sorted(result.columns)
    assert sorted(expected.columns) == columns
    assert rows(result, *columns) == sorted(expected.select(*columns).fetchall(), key=repr)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "decontamination", "packing"]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], TABLES).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    for before, after in zip(tables[:4], tables[1:5]):
        assert after.dtypes == docs.dtypes
        assert set(after.collect()) <= set(before.collect()) and 0 < after.count() <= before.count()
    toxic = {r.doc_id for r in spark.read.parquet(f"{TABLES}/labels.parquet").where("toxic = 1").collect()}
    left = {r[0] for r in rows(tables[1], "doc_id")}
    assert len(left & toxic) < len(toxic) / 2
    held = [tuple(r) for r in tables[2].select("doc_id", "text").collect()]
    assert rows(tables[3], "doc_id") == sorted(((d,) for d, n, c in brute_components(held) if not n or d == c), key=repr)
    items = [tuple(r) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    clean = [(d,) for d, t in map(tuple, tables[3].select("doc_id", "text").collect()) if not brute_hits(items, t)[4]]
    assert rows(tables[4], "doc_id") == sorted(clean, key=repr)
    packed = [tuple(r) for r in tables[4].select("doc_id", "text").collect()]
    check_packing(tables[5].collect(), packed, 1024)
