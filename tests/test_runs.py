import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators import compose_orders, to_events
from ordermill.plans import prepare_catalog, write_orders
from ordermill.schemas import order_event_schema
from ordermill.sources import (
    append_events,
    append_run,
    committed_runs,
    read_events,
    read_runs,
    runs,
    sweep_runs,
)
from tests.conftest import plan_of, rows
from tests.test_events import EVENT

SCHEMA = T.StructType().add("a", T.IntegerType()).add("b", T.StringType())
AS_OF = "2024-01-01 00:00:00"


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def folders(tmp_path):
    return sorted(p.name for p in (tmp_path / "t").glob(f"{runs.FOLDER}=*"))


def test_runs_add_up_and_a_repeated_one_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t") + "/"
    assert read_runs(spark, path, SCHEMA).count() == 0
    assert append_run(table(spark, (1, "x"), (2, None)), path, "monday")
    assert append_run(table(spark, (3, "y")), path, "tuesday é/../")
    before = read_runs(spark, path, SCHEMA)
    assert not append_run(table(spark, (9, "other")), path, "monday")
    assert rows(read_runs(spark, path, SCHEMA)) == rows(before) == [(1, "x"), (2, None), (3, "y")]
    assert {r.run for r in committed_runs(spark, path).collect()} == {"monday", "tuesday é/../"}
    assert len(folders(tmp_path)) == 2
    with pytest.raises(ValueError):
        append_run(before, path, "")


def test_a_repeated_run_is_not_computed(spark, tmp_path):
    path = str(tmp_path / "t")
    append_run(table(spark, (1, "x")), path, "run")
    failing = table(spark, (1, "x")).select("a", F.raise_error(F.lit("computed")).cast("string").alias("b"))
    assert not append_run(failing, path, "run")


def test_a_job_killed_between_files_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    append_run(table(spark, (1, "x")), path, "old")
    whole = spark.range(100).repartition(4).select(F.col("id").cast("int").alias("a"), F.lit("z").alias("b"))
    torn = whole.withColumn("b", F.when(F.col("a") == 42, F.raise_error(F.lit("killed")).cast("string")).otherwise("z"))
    with pytest.raises(Exception, match="killed"):
        append_run(torn, path, "new")
    assert rows(read_runs(spark, path, SCHEMA)) == [(1, "x")]
    assert append_run(whole, path, "new") and not append_run(whole, path, "new")
    assert read_runs(spark, path, SCHEMA).count() == 101


def test_a_job_killed_before_its_record(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_run(table(spark, (1, "x")), path, "old")
    with monkeypatch.context() as patch:
        patch.setattr(runs, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            append_run(table(spark, (2, "y")), path, "new")
    assert len(folders(tmp_path)) == 2 and rows(read_runs(spark, path, SCHEMA)) == [(1, "x")]
    assert append_run(table(spark, (2, "y")), path, "new")
    assert rows(read_runs(spark, path, SCHEMA)) == [(1, "x"), (2, "y")]
    assert sweep_runs(spark, path) == 0 and sweep_runs(spark, path, older_than=0) == 1
    assert len(folders(tmp_path)) == 2 and read_runs(spark, path, SCHEMA).count() == 2
    assert sweep_runs(spark, str(tmp_path / "none")) == 0


def test_of_two_jobs_with_one_name_the_first_to_finish_counts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    commit = runs.commit

    def overtaken(*args):
        monkeypatch.setattr(runs, "commit", commit)
        assert append_run(table(spark, (1, "first")), path, "run")
        return commit(*args)

    monkeypatch.setattr(runs, "commit", overtaken)
    assert not append_run(table(spark, (2, "second")), path, "run")
    assert rows(read_runs(spark, path, SCHEMA)) == [(1, "first")] and len(folders(tmp_path)) == 1
    assert [p.name for p in (tmp_path / "t" / runs.RECORDS).glob(".*") if "crc" not in p.name] == []


def test_formats_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    append_run(table(spark, (1, "x"), (2, "y")), path, "one", partition_by=["b"])
    append_run(table(spark, (3, "y")), path, "two", "ORC", partition_by=["b"])
    found = read_runs(spark, path, SCHEMA)
    assert rows(found) == [(1, "x"), (2, "y"), (3, "y")] and found.columns == ["a", "b"]


def test_events_by_run(spark, tmp_path):
    path = str(tmp_path / "t")
    events = spark.createDataFrame([EVENT], order_event_schema)
    for run in ("one", "two", "one"):
        append_events(events, path, run=run, by_date=True)
    back = read_events(spark, path)
    assert back.schema == order_event_schema and back.count() == 2
    assert back.first().asDict(recursive=True) == EVENT


def test_written_once_and_completed_by_a_repeat(spark, shop, lines, tmp_path, monkeypatch):
    catalog = prepare_catalog(shop.clients, shop.products, shop.packages)
    orders = lines.select("order_id", F.lit("a1").alias("address_id")).distinct()
    paths = str(tmp_path / "t"), str(tmp_path / "rejected")
    with monkeypatch.context() as patch:
        patch.setattr("ordermill.plans.writing.append_run", lambda *_: (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            write_orders(orders, lines, catalog, *paths, run="r", as_of=AS_OF)
    assert write_orders(orders, lines, catalog, *paths, run="r", as_of=AS_OF) == (False, True)
    assert write_orders(orders, lines, catalog, *paths, run="r", as_of=AS_OF) == (False, False)
    plain = compose_orders(orders, lines, catalog.items, catalog.addresses, as_of=AS_OF)
    assert rows(read_events(spark, paths[0])) == rows(to_events(plain.accepted, run="r"))
    schema = T.StructType.fromDDL("order_id string, reason string, n_lines long")
    assert rows(read_runs(spark, paths[1], schema)) == rows(plain.rejected)


def test_a_repeat_with_nothing_missing_computes_nothing(spark, shop, lines, tmp_path, monkeypatch):
    catalog = prepare_catalog(shop.clients, shop.products, shop.packages)
    orders = lines.select("order_id", F.lit("a1").alias("address_id")).distinct()
    paths = str(tmp_path / "t"), str(tmp_path / "rejected")
    assert write_orders(orders, lines, catalog, *paths, run="r", as_of=AS_OF, by_date=True) == (True, True)
    monkeypatch.setattr("ordermill.plans.writing.check_orders", None)
    assert write_orders(orders, lines, catalog, *paths, run="r", as_of=AS_OF, by_date=True) == (False, False)


def test_events_of_few_dates_are_not_shuffled(spark, tmp_path, monkeypatch):
    events = spark.createDataFrame([EVENT] * 8, order_event_schema).repartition(4)
    plans = []
    monkeypatch.setattr(
        "ordermill.sources.tables.append_run", lambda df, *_, **__: plans.append(plan_of(df)) or True
    )
    for few in (True, False):
        append_events(events, str(tmp_path / "t"), run="r", by_date=True, few_dates=few)
    assert [p.count("Exchange") for p in plans] == [1, 2]
    monkeypatch.undo()
    append_events(events, str(tmp_path / "t"), run="r", by_date=True, few_dates=True)
    assert len(list((tmp_path / "t").glob("*/order_date=*"))) == 1
    assert read_events(spark, str(tmp_path / "t")).count() == 8
