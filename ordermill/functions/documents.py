"""Building blocks of the event document."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.schemas import (
    ADDRESS_COLUMNS,
    DATE_FORMAT,
    TIMESTAMP_FORMAT,
    payment_details_schema,
)


def destination_address() -> Column:
    """The address part of a client row."""
    widened = {"lat", "lon"}
    return F.struct(
        *[
            F.col(name).cast("double").alias(name) if name in widened else F.col(name)
            for name in ADDRESS_COLUMNS
        ]
    )


def payment_details() -> Column:
    """Payment fields, blank until a payment arrives."""
    return F.struct(*[F.lit("").alias(name) for name in payment_details_schema.names])


def as_of_column(as_of: str | datetime | Column) -> Column:
    """The clock value of a run, or of each row."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def timestamp_text(moment: Column) -> Column:
    return F.date_format(moment, TIMESTAMP_FORMAT)


def date_text(moment: Column) -> Column:
    return F.date_format(moment, DATE_FORMAT)


def json_text(*columns: str) -> Column:
    """A row as JSON, null fields included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_bytes(*columns: str) -> Column:
    return F.encode(json_text(*columns), "UTF-8")


def has_text_field(json: Column, field: str) -> Column:
    """True where raw JSON holds ``field`` as a string.

    ``from_json`` would turn the number 5 into "5"; the variant type keeps the
    difference. Malformed JSON, JSON null and absent fields give false.
    """
    value = F.variant_get(F.try_parse_json(json), f"$.{field}", "variant")
    return F.schema_of_variant(value).eqNullSafe("STRING")
