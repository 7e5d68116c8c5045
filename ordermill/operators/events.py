"""Order events: envelope, schema, validation and the record to publish."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.documents import has_text_field, json_bytes, timestamp_text
from ordermill.functions.draws import keyed_id, random_id
from ordermill.schemas import EVENT_ID_PREFIX, EVENT_TYPE, order_event_schema

RECORD_KEYS = ("order_id", "event_type")
PARTS = ["part", "n_parts"]


class Valid(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def event_ids(ids: str, prefix: str, *parts: Column) -> Column:
    """Ids that a replay repeats (``"replay"``) or fresh ones (``"random"``)."""
    if ids == "replay":
        return keyed_id(prefix, *parts)
    if ids == "random":
        return random_id(prefix)
    raise ValueError(f"ids must be 'replay' or 'random', got {ids!r}")


def to_events(
    orders: DataFrame, *, ids: str = "replay", run: str = "", parts: bool = False
) -> DataFrame:
    """Wrap composed orders in the event envelope.

    ``run`` tells apart the event ids of separate runs over the same orders.
    ``parts`` keeps ``part`` and ``n_parts`` beside the event, for orders that
    come in parts; ``to_envelope`` makes record headers of them.
    """
    part = F.when(F.col("n_parts") > 1, F.col("part"))
    event_id = event_ids(
        ids, EVENT_ID_PREFIX, F.lit("event"), F.lit(run), F.col("order_id"), part
    )
    events = orders.select(
        event_id.alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        timestamp_text(F.col("as_of")).alias("event_timestamp"),
        "order_id",
        "order_details",
        *PARTS,
    )
    if parts:
        beside = [T.StructField(c, events.schema[c].dataType) for c in PARTS]
        schema = T.StructType([*order_event_schema.fields, *beside])
        return conform(events, schema)
    return conform(events.drop(*PARTS))


def conform(df: DataFrame, schema: T.StructType = order_event_schema) -> DataFrame:
    """Cast to a schema: extra fields go, absent ones become null."""
    if _nullable(df.schema) == schema:
        # ``to`` would rebuild every nested array, field by field.
        return df
    return df.to(schema)


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere."""
    if isinstance(kind, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields]
        )
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    return kind


def split_valid(
    records: DataFrame, *, field: str = "event_type", json: str | None = None
) -> Valid:
    """Part records whose ``field`` is a string from those where it is not.

    Typed records need a non-null string column; with ``json`` that column holds
    raw JSON text.
    """
    if json is not None:
        good = has_text_field(F.col(json), field)
    elif dict(records.dtypes).get(field) == "string":
        good = F.col(field).isNotNull()
    else:
        good = F.lit(False)
    return Valid(records.where(good), records.where(~good))


def to_envelope(
    events: DataFrame, *, key: str = "order_id", shape: str = "kafka"
) -> DataFrame:
    """The record to publish: a partition key and the event as JSON bytes.

    ``shape="kafka"`` gives binary ``key``, ``value``, and ``headers`` for events
    with parts; ``"kinesis"`` gives ``PartitionKey`` (string) and ``Data``. The
    order id spreads records over a target's partitions; ``key="event_type"`` is
    one value for all order events and puts them all in one.
    """
    if key not in RECORD_KEYS:
        raise ValueError(f"key must be one of {RECORD_KEYS}, got {key!r}")
    beside = [c for c in PARTS if c in events.columns]
    data = json_bytes(*[c for c in events.columns if c not in beside])
    if shape == "kafka":
        headers = [
            F.struct(
                F.lit(c).alias("key"), F.encode(F.col(c).cast("string"), "UTF-8").alias("value")
            )
            for c in beside
        ]
        return events.select(
            F.encode(F.col(key), "UTF-8").alias("key"),
            data.alias("value"),
            *([F.array(*headers).alias("headers")] if headers else []),
        )
    if shape == "kinesis":
        return events.select(F.col(key).alias("PartitionKey"), data.alias("Data"), *beside)
    raise ValueError(f"shape must be 'kafka' or 'kinesis', got {shape!r}")
