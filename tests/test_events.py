import json

import pytest
from pyspark.sql import functions as F

from ordermill.operators import conform, split_valid, to_envelope
from ordermill.schemas import clients_address_schema, order_event_schema
from ordermill.sources import publish, read_table
from tests.conftest import rows

EVENT = {
    "event_id": "ev-1",
    "event_type": "ORDER_CREATED",
    "event_timestamp": "2024-01-01 00:00:00",
    "order_id": "ord-1",
    "order_details": {
        "customer_id": "ñandú \"x\"\n",
        "order_timestamp": None,
        "order_date": "2024-01-01",
        "items": [
            {
                "product_id": "p", "product_name": None, "price": 1.5, "quantity": 2,
                "packages": [
                    {"package_id": "b", "subpackage_id": None, "quantity": 1,
                     "weight": None, "volume": 30.0}
                ],
            }
        ],
        "total_amount": 3.0, "total_volume": 60.0, "total_weight": 2.0,
        "status": "RECEIVED",
        "destination_address": {
            **dict.fromkeys(order_event_schema["order_details"].dataType["destination_address"].dataType.names),
            "coordinates": [1.0, 2.0], "lat": 19.989999771118164,
        },
        "payment_details": {"payment_method": "", "payment_status": "", "transaction_id": ""},
    },
}


@pytest.fixture(scope="module")
def events(spark):
    untyped = {**EVENT, "event_id": "ev-2", "event_type": None}
    return spark.createDataFrame([EVENT, untyped], order_event_schema)


def test_json_holds_every_field_and_value(events):
    record = to_envelope(events.limit(1)).first()
    assert bytes(record.key) == b"ord-1"
    by_type = to_envelope(events.limit(1), key="event_type").first()
    assert bytes(by_type.key) == b"ORDER_CREATED"
    assert json.loads(bytes(record.value).decode("utf-8")) == EVENT


def test_shapes_and_keys(events):
    record = to_envelope(events.limit(1), key="order_id", shape="kinesis").first()
    assert record.PartitionKey == "ord-1"
    assert json.loads(bytes(record.Data)) == EVENT
    for wrong in ({"key": "event_id"}, {"shape": "other"}):
        with pytest.raises(ValueError):
            to_envelope(events, **wrong)


def test_typed_validation(spark, events):
    valid = split_valid(events)
    assert rows(valid.accepted, "event_id") == [("ev-1",)]
    assert rows(valid.rejected, "event_id") == [("ev-2",)]
    numbers = spark.createDataFrame([(1,)], "event_type int")
    assert split_valid(numbers).accepted.count() == 0
    absent = split_valid(numbers.withColumnRenamed("event_type", "other"))
    assert (absent.accepted.count(), absent.rejected.count()) == (0, 1)


def test_json_validation(spark):
    texts = {
        '{"event_type": "a"}': True,
        '{"event_type": ""}': True,
        '{"event_type": 5}': False,
        '{"event_type": null}': False,
        '{"event_type": ["a"]}': False,
        '{"other": "a"}': False,
        '{"event_type": "a"': False,
        "": False,
        "[]": False,
        None: False,
    }
    df = spark.createDataFrame([(t,) for t in texts], "body string")
    valid = split_valid(df, json="body")
    assert {r.body for r in valid.accepted.collect()} == {t for t, good in texts.items() if good}
    assert {r.body for r in valid.rejected.collect()} == {t for t, good in texts.items() if not good}


def test_publish_writes_valid_events_one_per_line(spark, events, tmp_path):
    path = str(tmp_path / "out")
    publish(events, "text", {"path": path})
    lines = [r.value for r in spark.read.text(path).collect()]
    assert [json.loads(line) for line in lines] == [EVENT]
    again = read_table(spark, path, "json", order_event_schema)
    assert again.first().asDict(recursive=True) == EVENT


def test_rejected_events_have_a_place(spark, events, tmp_path):
    publish(events, "text", {"path": str(tmp_path / "out")}, rejected_path=str(tmp_path / "bad"))
    assert [r.event_id for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["ev-2"]
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    publish(
        stream, "text", {"path": str(tmp_path / "out2")}, checkpoint=str(tmp_path / "c"),
        rejected_path=str(tmp_path / "bad2"),
    ).awaitTermination()
    assert spark.read.text(str(tmp_path / "out2")).count() == 1
    assert [r.event_id for r in spark.read.parquet(str(tmp_path / "bad2")).collect()] == ["ev-2"]


def test_publish_to_any_sink(spark, events, tmp_path):
    path = str(tmp_path / "out")
    publish(events, "parquet", {"path": path}, key="order_id")
    publish(events, "parquet", {"path": path}, key="order_id")
    assert [bytes(r.key) for r in spark.read.parquet(path).collect()] == [b"ord-1", b"ord-1"]


def test_conform(spark):
    df = spark.createDataFrame([("c", 19.99, "x")], "client_id string, lat float, extra string")
    row = conform(df, clients_address_schema).first().asDict()
    assert "extra" not in row and row["road"] is None and row["client_id"] == "c"
    wide = df.withColumn("lat", F.col("lat").cast("float"))
    from pyspark.sql import types as T

    target = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("n", T.DoubleType())])
    widened = conform(wide.withColumn("n", F.lit(30)), target).first()
    assert (widened.lat, widened.n) == (19.989999771118164, 30.0)


def test_conform_refuses_text_for_numbers(spark):
    df = spark.createDataFrame([("5",)], "lat string")
    with pytest.raises(Exception):
        conform(df, clients_address_schema).collect()
