"""Lookup tables in versions, and runs that keep to one of them.

A version is a whole table in a folder of its own, and becomes the newest by one
record with the next number. Nothing is overwritten, so a version can be read as
long as it is kept. A pin is a record that names, for a run, the versions of several
tables; the first one made counts for all batches of the run and for every restart.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ordermill.scratch import in_store
from ordermill.sources.runs import commit, run_key
from ordermill.sources.tables import Dimensions

VERSIONS = "_versions"
PINS = "_pins"


def _record(spark: SparkSession, path: str) -> dict | None:
    place, store = in_store(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def newest_version(spark: SparkSession, path: str) -> int:
    """The number of a table's newest version; 0 if it has none."""
    place, store = in_store(spark, f"{path.rstrip('/')}/{VERSIONS}")
    if not store.exists(place):
        return 0
    names = [s.getPath().getName() for s in store.listStatus(place)]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def write_version(df: DataFrame, path: str) -> int:
    """Write a table's next version, all or nothing; its number."""
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    while True:
        # Another writer may have taken the number meanwhile.
        number = newest_version(spark, path) + 1
        if commit(spark, f"{path}/{VERSIONS}", f"{number:012d}", {"folder": folder}):
            return number


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """One version of a table, by default the newest at this moment."""
    path = path.rstrip("/")
    number = newest_version(spark, path) if number is None else number
    record = _record(spark, f"{path}/{VERSIONS}/{number:012d}.json")
    if record is None:
        raise IOError(f"{path} has no version {number}")
    return spark.read.parquet(f"{path}/{record['folder']}")


def pin_versions(spark: SparkSession, base: str, run: str, tables: list[str]) -> dict[str, int]:
    """The versions of ``tables`` under ``base`` that a run keeps to.

    The first call for a run records the newest ones; later calls, in this job or
    after a restart, get the same.
    """
    base = base.rstrip("/")
    newest = {t: newest_version(spark, f"{base}/{t}") for t in tables}
    key = run_key(run)
    record = _record(spark, f"{base}/{PINS}/{key}.json")
    if record is None:
        missing = sorted(t for t, n in newest.items() if not n)
        if missing:
            raise IOError(f"no version under {base} of {missing}")
        commit(spark, f"{base}/{PINS}", key, {"run": run, "versions": newest})
        # Whoever came first is the one that is read back.
        record = _record(spark, f"{base}/{PINS}/{key}.json")
    versions = record["versions"]
    if set(versions) != set(tables):
        raise ValueError(f"run {run!r} was pinned for {sorted(versions)}")
    return versions


def read_pinned_dimensions(
    spark: SparkSession,
    base: str,
    run: str,
    *,
    clients: str = "clients_address",
    products: str = "products",
    packages: str = "packages",
) -> Dimensions:
    """The three lookup tables as they were when the run first read them."""
    names = [clients, products, packages]
    versions = pin_versions(spark, base, run, names)
    base = base.rstrip("/")
    return Dimensions(*[read_version(spark, f"{base}/{n}", versions[n]) for n in names])
