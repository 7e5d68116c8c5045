"""Reading text files of which some rows are damaged."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.validate import document_faults

FORMATS = ("csv", "json")
_TEXT = "_damaged"


class Rows(NamedTuple):
    """``good`` has the columns of the schema; ``bad`` has ``file``, ``text`` (the
    row as it stands in the file) and ``reasons``."""

    good: DataFrame
    bad: DataFrame


def _csv_reasons(schema: T.StructType, options: dict[str, str]) -> Column:
    """The wrong number of columns, or those whose text is not of their type."""
    texts = T.StructType([T.StructField(n, T.StringType()) for n in schema.names])
    read = {**options, "header": "false", "columnNameOfCorruptRecord": _TEXT}
    kept = T.StructType([*texts.fields, T.StructField(_TEXT, T.StringType())])
    row = F.from_csv(F.col(_TEXT), kept.simpleString()[7:-1].replace(":", " "), read)
    wrong = [
        F.when(
            row[f.name].isNotNull() & row[f.name].try_cast(f.dataType).isNull(),
            F.lit(f"{f.name}: not {f.dataType.simpleString()}"),
        )
        for f in schema.fields
    ]
    by_type = F.array_compact(F.array(*wrong))
    other = F.when(F.size(by_type) > 0, by_type).otherwise(F.array(F.lit("malformed")))
    return F.when(row[_TEXT].isNotNull(), F.array(F.lit("columns"))).otherwise(other)


def _json_reasons(schema: T.StructType) -> Column:
    faults = document_faults(schema)(F.col(_TEXT))
    told = F.transform(faults, lambda f: F.concat_ws(": ", f["path"], f["reason"]))
    return F.when(F.size(told) > 0, told).otherwise(F.array(F.lit("malformed")))


def read_damaged(
    spark: SparkSession,
    path: str,
    format: str,
    schema: T.StructType,
    options: dict[str, str] | None = None,
) -> Rows:
    """Read csv or json lines and part good rows from damaged ones; no row is lost.

    A row is damaged if Spark's reader cannot make all its columns of the types of
    ``schema``. What is good does not depend on the columns that are used later: the
    whole row is read in either case. Blank lines are no rows, as Spark has it.
    """
    format, options = format.lower(), dict(options or {})
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {format!r}")
    if _TEXT in schema.names:
        raise ValueError(f"{_TEXT} is the name of the text of damaged rows")
    marked = T.StructType([*schema.fields, T.StructField(_TEXT, T.StringType())])
    reading = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _TEXT}
    file = F.col("_metadata.file_name").alias("file")
    if format == "csv":
        reader = spark.read.schema(marked).options(**reading, columnPruning="false")
        # A test that needs every column, so that a later select cuts none of them out
        # of what the reader looks at.
        needs_all = F.size(F.array(*[F.col(f"`{n}`").isNull() for n in schema.names])) > 0
        rows = reader.csv(path).where(needs_all)
        rows = rows.select(F.struct(*[f"`{n}`" for n in schema.names]).alias("row"), _TEXT, file)
        reasons = _csv_reasons(schema, options)
    else:
        lines = spark.read.text(path).where(F.trim("value") != "").select("value", file)
        # Options keep the optimizer from reading only the fields that are used.
        parsed = lines.select(F.from_json("value", marked, reading).alias("row"), "value", "file")
        fields = F.struct(*[F.col(f"row.{n}") for n in schema.names])
        rows = parsed.select(fields.alias("row"), F.col(f"row.{_TEXT}").alias(_TEXT), "file")
        reasons = _json_reasons(schema)
    bad = F.col(_TEXT).isNotNull()
    return Rows(
        rows.where(~bad).select("row.*"),
        rows.where(bad).select("file", F.col(_TEXT).alias("text"), reasons.alias("reasons")),
    )
