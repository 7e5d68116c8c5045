"""Every query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
import query_oracles
from ordermill.plans import gallery

TABLES = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{path}'")
    return connection


NAMES = sorted(gallery.QUERIES)


def test_every_query_has_sql():
    assert set(NAMES) == set(query_oracles.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, database, name):
    result = driver.queries()[name](spark, TABLES)
    expected = database.sql(driver.oracle_sql()[name])
    kinds = {c: str(t) for c, t in zip(expected.columns, expected.types)}
    assert {c: TYPES[t] for c, t in result.dtypes} == kinds
    columns = sorted(kinds)
    found = sorted((tuple(r) for r in result.select(*columns).collect()), key=repr)
    wanted = sorted(expected.select(*columns).fetchall(), key=repr)
    assert found == wanted
    assert found


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "order_id", "n_items", "total_amount", "total_volume", "total_weight",
    ]


@pytest.mark.parametrize("name", ["order_totals_flat", "order_totals_nested", "order_events"])
def test_building_a_plan_runs_no_jobs(spark, name):
    tracker = spark.sparkContext.statusTracker()
    group = f"building {name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        gallery.QUERIES[name](spark, TABLES)
        assert len(tracker.getJobIdsForGroup(group)) <= 3
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["append_roundtrip", "append_replayed"])
def test_appended_runs_are_composed_once(spark, monkeypatch, name):
    composed, calls = gallery._composed, []
    monkeypatch.setattr(gallery, "_composed", lambda *a, **k: calls.append(a) or composed(*a, **k))
    assert gallery.QUERIES[name](spark, TABLES).count()
    assert len(calls) == 1


@pytest.mark.parametrize("name", ["published_lines", "stream_published"])
def test_published_lines_are_compressed(spark, name):
    files = [f for f in gallery.QUERIES[name](spark, TABLES).inputFiles()]
    assert files and all(f.endswith(".gz") for f in files)


def test_a_kinesis_record_is_parsed_once(spark):
    plan = gallery.QUERIES["kinesis_records"](spark, TABLES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_streamed_orders_are_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "orders")
    gallery._orders_with_lines(spark, TABLES, 6).write.parquet(path)
    assert len(glob.glob(f"{path}/*.parquet")) == 6


def test_orders_of_a_stream_are_kept_only_for_two_tables(spark, monkeypatch):
    from ordermill.streaming import orders

    names, kept = [], orders.kept
    monkeypatch.setattr(orders, "kept", lambda df, name: names.append(name) or kept(df, name))
    assert gallery.QUERIES["stream_orders"](spark, TABLES).count()
    assert names and "batch" not in names


def test_parts_of_orders_share_the_shuffle_of_lines_with_items(spark):
    plan = gallery.QUERIES["order_totals_parts"](spark, TABLES)._jdf.queryExecution().executedPlan().initialPlan()
    wide, left = [], [plan]
    while left:
        node = left.pop()
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        if node.nodeName() == "Exchange" and {"order_id", "packages"} <= set(names):
            wide.append(node.canonicalized())
        left += [node.children().apply(i) for i in range(node.children().size())]
    # Orders in parts of one package and of four by one shuffle, whole ones by another.
    assert len(wide) == 3
    assert len({w.hashCode() for w in wide}) == 2


@pytest.mark.parametrize("name", ["stream_once", "stream_lines"])
def test_sources_of_streams_are_written_by_many_tasks(spark, monkeypatch, name):
    written, write = [], gallery.write_table

    def noted(df, path, *args, **options):
        before = len(glob.glob(f"{path}/*.parquet"))
        write(df, path, *args, **options)
        written.append(len(glob.glob(f"{path}/*.parquet")) - before)

    monkeypatch.setattr(gallery, "write_table", noted)
    # As many tasks as partitions and files, however small they are.
    settings = {"spark.sql.files.openCostInBytes": 1 << 30, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, str(v))
        assert gallery.QUERIES[name](spark, TABLES).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert written[0] > 1 and written[1] > 1
