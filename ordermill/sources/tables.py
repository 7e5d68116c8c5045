"""Reading and writing tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.events import conform
from ordermill.schemas import clients_address_schema, order_event_schema
from ordermill.sources.runs import append_run, read_runs

# Formats that carry their own schema, so there is nothing to infer.
SELF_DESCRIBING = ("delta", "parquet", "orc")
MODES = ("overwrite", "append", "ignore", "error")


class Dimensions(NamedTuple):
    clients: DataFrame
    products: DataFrame
    packages: DataFrame


def read_table(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read a file table.

    A given schema is applied, except to Delta, whose tables have their own.
    Without one, formats that do not describe themselves are inferred, unless
    the options say otherwise.
    """
    if not isinstance(path, str) or not path:
        raise ValueError(f"path must be a non-empty string, got {path!r}")
    format = format.lower()
    options = dict(options or {})
    reader = spark.read.format(format)
    if schema is not None and format != "delta":
        reader = reader.schema(schema)
    elif format not in SELF_DESCRIBING and "inferschema" not in map(str.lower, options):
        options["inferSchema"] = "true"
    try:
        return reader.options(**options).load(path)
    except Exception as error:
        raise IOError(f"cannot read {path}: {error}") from error


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    options: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Write a file table; modes are overwrite, append, ignore and error."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    df.write.save(path, format.lower(), mode, partition_by, **(options or {}))


def append_events(
    events: DataFrame,
    path: str,
    format: str = "parquet",
    *,
    by_date: bool = False,
    few_dates: bool = False,
    run: str | None = None,
    options: dict[str, str] | None = None,
) -> bool:
    """Append order events to a table, all in one write.

    ``by_date`` partitions the files by order date. Events are shuffled for it, so that
    a date has few files; events of ``few_dates``, as of one run, are written where they
    are, one file for each task and date. With ``run`` the events come in
    whole or not at all, and once however often the call is repeated; False if the
    table has them already, and ``read_events`` reads the table. Without ``run``
    file formats do not undo an append that fails half-way, and a repeated call
    appends again.
    """
    events = conform(events)
    partition_by = None
    if by_date:
        events = events.withColumn("order_date", F.col("order_details.order_date"))
        if not few_dates:
            # Rebalancing keeps the files few, and splits a date that has most events.
            events = events.hint("rebalance", "order_date")
        partition_by = ["order_date"]
    try:
        if run is not None and format.lower() == "delta":
            # Delta takes each number of an application only once.
            options = {**(options or {}), "txnAppId": run, "txnVersion": "0"}
        elif run is not None:
            return append_run(
                events, path, run, format, partition_by=partition_by, options=options
            )
        write_table(events, path, format, "append", options, partition_by)
    except Exception as error:
        raise RuntimeError(f"cannot append events to {path}: {error}") from error
    return True


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The events of a table that was appended to by runs."""
    return read_runs(spark, path, order_event_schema)


def read_dimensions(
    spark: SparkSession,
    base_path: str,
    *,
    clients: str = "clients_address",
    products: str = "products",
    packages: str = "packages",
    clients_format: str = "parquet",
    format: str = "delta",
) -> Dimensions:
    """Read the three lookup tables under ``base_path``.

    Clients have a fixed schema; products and packages bring theirs.
    """
    base = base_path.rstrip("/")
    return Dimensions(
        read_table(spark, f"{base}/{clients}", clients_format, clients_address_schema),
        read_table(spark, f"{base}/{products}", format),
        read_table(spark, f"{base}/{packages}", format),
    )
