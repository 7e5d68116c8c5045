"""The TPC-H-style test tables in the shape of this package's tables.

A package is a brand in up to three sizes, a product is a part, a client is a
customer. The gaps (missing package rows, null measures, null keys, products
without components) are there to exercise the operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.events import conform
from ordermill.schemas import (
    clients_address_schema,
    packages_schema,
    products_schema,
)
from ordermill.sources.tables import Dimensions, read_table


SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, "
    "l_quantity double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, "
    "c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A test table, its columns named up front instead of inferred by a job."""
    return read_table(spark, f"{directory}/{name}.parquet", schema=T.StructType.fromDDL(SCHEMAS[name]))


def _label(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def packages(spark: SparkSession, directory: str) -> DataFrame:
    brand, size = F.col("brand"), F.col("size")
    sizes = (
        table(spark, directory, "part")
        .select(F.expr("cast(substr(p_brand, 7) as int)").alias("brand"))
        .distinct()
        .withColumn("size", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .where(~((brand % 5 == 0) & (size == 2)))
    )
    width, height = F.lit(10) + size, F.lit(5) + brand
    rows = sizes.select(
        _label("pkg-", brand).alias("package_id"),
        size.alias("subpackage_id"),
        _label("box ", brand).alias("name"),
        width.alias("width"),
        height.alias("height"),
        F.lit(20).alias("length"),
        F.when(size != 3, size * 1.25).cast("float").alias("weight"),
        F.when(~((brand % 7 == 0) & (size == 1)), width * height * 20).alias("volume"),
        F.coalesce(brand * 10, F.lit(0)).alias("stock_quantity"),
    )
    return conform(rows, packages_schema)


def products(spark: SparkSession, directory: str) -> DataFrame:
    number = F.col("p_partkey")
    package_id = F.concat(F.lit("pkg-"), F.expr("substr(p_brand, 7)"))

    def component(size):
        unnumbered = (number % 40 == 39) & (size == 1)
        return F.struct(
            package_id.alias("package_id"),
            F.when(~unnumbered, size).cast("int").alias("subpackage_id"),
            (1 + (number + size) % 4).cast("int").alias("package_quantity"),
        )

    sizes = F.sequence(F.lit(1).cast("bigint"), 1 + number % 3)
    components = F.transform(F.when(number % 50 != 49, sizes), component)
    rows = table(spark, directory, "part").select(
        _label("prd-", number).alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.lit(None).cast("string").alias("url"),
        F.col("p_retailprice").cast("float").alias("price"),
        F.lit("USD").alias("currency"),
        F.coalesce(components, F.array()).alias("product_components"),
    )
    return conform(rows, products_schema)


def clients(spark: SparkSession, directory: str) -> DataFrame:
    number = F.col("c_custkey")

    def degrees(span):
        return ((number % (200 * span)).cast("double") / 100.0 - span / 1.0).cast("float")

    rows = (
        table(spark, directory, "customer")
        .join(table(spark, directory, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, directory, "region"), F.expr("n_regionkey = r_regionkey"))
        .select(
            _label("cl-", number).alias("client_id"),
            _label("addr-", number).alias("address_id"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("state"),
            F.col("c_mktsegment").alias("occupation"),
            degrees(90).alias("lat"),
            degrees(180).alias("lon"),
        )
        .withColumn(
            "coordinates", F.array(F.col("lat").cast("double"), F.col("lon").cast("double"))
        )
    )
    return conform(rows, clients_address_schema)


def dimensions(spark: SparkSession, directory: str) -> Dimensions:
    return Dimensions(
        clients(spark, directory),
        products(spark, directory),
        packages(spark, directory),
    )


def orders(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "orders").select(
        _label("ord-", F.col("o_orderkey")).alias("order_id"),
        _label("addr-", F.col("o_custkey")).alias("address_id"),
        F.col("o_orderdate").alias("ordered_at"),
    )


def order_lines(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "lineitem").select(
        _label("ord-", F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("pos"),
        _label("prd-", F.col("l_partkey")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
