import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ordermill.schemas import (  # noqa: E402
    clients_address_schema,
    packages_schema,
    products_schema,
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("ordermill-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


class Shop:
    """Small lookup tables with the edge cases in them."""

    def __init__(self, spark):
        self.packages = spark.createDataFrame(
            [
                ("box", 1, "small", 1, 2, 3, 2.5, 10, 5),
                ("box", 2, "large", 2, 4, 6, None, None, 5),
                (None, None, "nameless", 9, 9, 9, 9.0, 9, 0),
                ("bag", None, "bag", 1, 1, 1, 7.0, 7, 0),
            ],
            packages_schema,
        )
        self.products = spark.createDataFrame(
            [
                ("lamp", "Lamp", "home", None, 19.99, "EUR", [("box", 1, 3), ("box", 2, 2)]),
                ("cup", "Cup", "home", None, 2.5, "EUR", [("box", 1, 1)]),
                ("lost", "Lost", "home", None, 1.0, "EUR", [("gone", 1, 4), ("bag", None, 1)]),
                ("void", "Void", "home", None, 4.0, "EUR", []),
                ("free", "Free", "home", None, None, "EUR", [("box", 1, 1)]),
                ("odd", "Odd", "home", None, 1.0, "EUR", [("box", 1, None)]),
                ("twin", "Twin B", "home", None, 6.0, "EUR", [("box", 1, 5)]),
                ("twin", "Twin A", "home", None, 5.0, "EUR", [("box", 2, 6)]),
                (None, "Nobody", "home", None, 1.0, "EUR", [("box", 1, 1)]),
            ],
            products_schema,
        )

        def client(number, address, lat=19.99):
            row = dict.fromkeys(clients_address_schema.names)
            row.update(
                client_id=number,
                address_id=address,
                road="Calle Ñ",
                coordinates=[1.5, 2.5],
                lat=lat,
                lon=-3.0,
            )
            return tuple(row[name] for name in clients_address_schema.names)

        self.clients = spark.createDataFrame(
            [
                client("c1", "a1"),
                client("c3", "a2"),
                client("c2", "a2", 1.0),
                client("c4", None),
            ],
            clients_address_schema,
        )


@pytest.fixture(scope="session")
def shop(spark):
    return Shop(spark)


LINES = "order_id string, pos int, product_id string, quantity int"


@pytest.fixture(scope="session")
def lines(spark):
    return spark.createDataFrame(
        [
            ("plain", 1, "lamp", 2),
            ("plain", 2, "cup", 3),
            ("repeat", 1, "cup", 1),
            ("repeat", 2, "cup", 1),
            ("unpriced", 1, "free", 1),
            ("uncounted", 1, "odd", 1),
            ("unsized", 1, "cup", None),
            ("holey", 1, "cup", 1),
            ("holey", 2, "void", 2),
            ("stray", 1, "cup", 1),
            ("stray", 2, "unheard", 1),
            ("twins", 1, "twin", 2),
            ("loose", 1, "lost", 2),
            (None, 1, "cup", 1),
        ],
        LINES,
    )
