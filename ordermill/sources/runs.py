"""Tables of files that grow by whole runs.

A run writes its files to a folder of its own and becomes part of the table by one
record, made under another name and renamed in a single step. Readers follow the
records, so they see all rows of a run or none, and a job that dies half-way leaves
the table as it was. Each run has a name; a name that has a record adds nothing, so
a run may be repeated after any failure, and of two jobs with one name the first to
finish counts.

The store has to rename a file in one step and refuse a name that is taken, as
HDFS does. On a plain disk the test and the rename are two steps.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ordermill.scratch import in_store

FOLDER = "ordermill_run"
RECORDS = "_runs"
RECORD_SCHEMA = "run string, folder string, format string"


def run_key(run: str) -> str:
    """A file name for any name of a run."""
    return hashlib.sha256(run.encode()).hexdigest()[:40]


def commit(spark: SparkSession, records: str, key: str, record: dict) -> bool:
    """Make the record, all of it or nothing; False if the run has one already."""
    final, store = in_store(spark, f"{records}/{key}.json")
    made, _ = in_store(spark, f"{records}/.{key}-{uuid.uuid4().hex}")
    out = store.create(made, True)
    try:
        out.write(bytearray(json.dumps(record).encode()))
    finally:
        out.close()
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        final.toUri(), spark._jsc.hadoopConfiguration()
    )
    kind = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    try:
        files.rename(made, final, jvm.java.lang.reflect.Array.newInstance(kind, 0))
    except Exception:
        store.delete(made, False)
        if store.exists(final):
            return False
        raise
    return True


def has_run(spark: SparkSession, path: str, run: str) -> bool:
    """Whether the table has the run already."""
    record, store = in_store(spark, f"{path.rstrip('/')}/{RECORDS}/{run_key(run)}.json")
    return bool(store.exists(record))


def append_run(
    df: DataFrame,
    path: str,
    run: str,
    format: str = "parquet",
    *,
    partition_by: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> bool:
    """Add the rows of ``df`` as run ``run``, all or none.

    False if the table has this run already; ``df`` is not computed then.
    """
    if not run:
        raise ValueError("a run needs a name")
    spark, path, key = df.sparkSession, path.rstrip("/"), run_key(run)
    if has_run(spark, path, run):
        return False
    folder = f"{FOLDER}={key}-{uuid.uuid4().hex}"
    df.write.save(f"{path}/{folder}", format.lower(), "error", partition_by, **(options or {}))
    added = commit(
        spark, f"{path}/{RECORDS}", key, {"run": run, "folder": folder, "format": format.lower()}
    )
    if not added:
        place, store = in_store(spark, f"{path}/{folder}")
        store.delete(place, True)
    return added


def committed_runs(spark: SparkSession, path: str) -> DataFrame:
    """``run``, ``folder`` and ``format`` of the runs that a table has."""
    records = f"{path.rstrip('/')}/{RECORDS}"
    place, store = in_store(spark, records)
    if not store.exists(place):
        return spark.createDataFrame([], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).json(records)


def read_runs(
    spark: SparkSession, path: str, schema: T.StructType, *, options: dict[str, str] | None = None
) -> DataFrame:
    """The rows of all runs that the table has at this moment.

    Runs that are added later do not change the DataFrame.
    """
    path = path.rstrip("/")
    # One name for each run, as in any listing of a table's folders.
    runs = committed_runs(spark, path).collect()
    by_format: dict[str, list[str]] = {}
    for row in sorted(runs):
        by_format.setdefault(row["format"], []).append(f"{path}/{row['folder']}")
    parts = []
    for format, folders in by_format.items():
        reader = spark.read.format(format).schema(schema).options(**(options or {}))
        parts.append(reader.option("basePath", path).load(folders).select(*schema.names))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def sweep_runs(spark: SparkSession, path: str, *, older_than: float = 7 * 86_400) -> int:
    """Delete folders of runs that never got a record; the number of these.

    Folders younger than ``older_than`` seconds may belong to a run at work.
    """
    path = path.rstrip("/")
    known = {row["folder"] for row in committed_runs(spark, path).collect()}
    root, store = in_store(spark, path)
    if not store.exists(root):
        return 0
    swept = 0
    for entry in store.listStatus(root):
        name = entry.getPath().getName()
        age = time.time() - entry.getModificationTime() / 1000
        if name.startswith(f"{FOLDER}=") and name not in known and age >= older_than:
            store.delete(entry.getPath(), True)
            swept += 1
    return swept
