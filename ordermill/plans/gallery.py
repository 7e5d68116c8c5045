"""Ready-made queries over the test tables, one or more for each operator.

Nested results are flattened, so that any engine can check them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions import draw, exact_sum, reciprocal_choice
from ordermill.operators import (
    Orders,
    attach_client,
    attach_products,
    build_items,
    client_addresses,
    component_measures,
    compose_orders,
    dense_index,
    draw_rows,
    hot_join,
    lookup_by_key,
    one_per_key,
    order_documents,
    order_totals,
    product_measures,
    split_valid,
    to_envelope,
    to_events,
    validate_documents,
)
from ordermill.operators.events import PARTS
from ordermill.operators.items import explode_components
from ordermill.plans import warehouse
from ordermill.plans.catalog import prepare_catalog
from ordermill.schemas import COMPONENT_COLUMNS, order_event_schema
from ordermill.scratch import kept
from ordermill.plans.writing import write_orders
from ordermill.sources import (
    append_events,
    bucket_join,
    lookup,
    materialize,
    publish,
    read_damaged,
    read_dimensions,
    read_events,
    read_pinned_dimensions,
    read_runs,
    read_table,
    save_bucketed,
    scratch_path,
    sweep_runs,
    write_sorted,
    write_table,
    write_version,
)
from ordermill.streaming import gather_orders
from ordermill.streaming import stream_orders as start_order_stream

SEED = 7
AS_OF = "2024-05-06 07:08:09"
RUN = "gallery"
TOTALS = ["n_items", "total_amount", "total_volume", "total_weight"]
FORMATS = ("csv", "json", "orc", "parquet")
# Parts of an address that the test tables do not have.
UNFILLED = ("neighborhood", "road", "house_number", "suburb", "city_district", "postcode")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    """Register a query by its name, but for a trailing ``_query``."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


# --- lookup tables ----------------------------------------------------------


@query
def lookup_product(spark, directory):
    found = lookup_by_key(warehouse.products(spark, directory), "category", "ECONOMY")
    return found.select(
        "product_id",
        "name",
        "category",
        F.col("price").cast("double").alias("price"),
        F.size("product_components").cast("bigint").alias("n_components"),
    )


@query
def lookup_client(spark, directory):
    found = lookup_by_key(warehouse.clients(spark, directory), "state", "ASIA")
    return found.select("client_id", "address_id", "country", "occupation")


@query
def lookup_pruned(spark, directory):
    """Order lines by product, of which a few files are read, and by order."""
    path = scratch_path(spark, "lines")
    write_sorted(warehouse.order_lines(spark, directory), path, "product_id", bloom=["order_id"], files=32)
    by_product = lookup(spark, path, "product_id", ["prd-17", "prd-180", "prd-none"])
    by_order = lookup_by_key(read_table(spark, path), "order_id", "ord-17")
    return by_product.withColumn("by", F.lit("product")).unionByName(
        by_order.withColumn("by", F.lit("order"))
    )


@query
def dimension_snapshot(spark, directory):
    """Products that are written anew while a run goes on do not change the run."""
    base = scratch_path(spark, "lookup")
    tables = dict(zip(("clients_address", "products", "packages"), warehouse.dimensions(spark, directory)))
    for name, df in tables.items():
        write_version(df, f"{base}/{name}")
    batches = [("first", read_pinned_dimensions(spark, base, "monday"))]
    dearer = tables["products"].withColumn("price", (F.col("price") * 2).cast("float"))
    write_version(dearer.where("product_id <> 'prd-1'"), f"{base}/products")
    batches.append(("second", read_pinned_dimensions(spark, base, "monday")))
    batches.append(("next run", read_pinned_dimensions(spark, base, "tuesday")))
    return reduce(DataFrame.unionByName, [
        found.products.select(
            F.lit(batch).alias("batch"), "product_id", F.col("price").cast("double").alias("price")
        )
        for batch, found in batches
    ])


@query
def dimension_rows(spark, directory):
    """The lookup tables, written and read back together."""
    base = scratch_path(spark, "lookup")
    tables = warehouse.dimensions(spark, directory)
    for name, df in zip(("clients_address", "products", "packages"), tables):
        write_table(df, f"{base}/{name}")
    back = read_dimensions(spark, base, format="parquet")

    def keyed(name, df, key, label):
        return df.select(F.lit(name).alias("source"), key.alias("key"), label.alias("label"))

    package = F.concat_ws("/", "package_id", "subpackage_id")
    return (
        keyed("clients", back.clients, F.col("address_id"), F.col("client_id"))
        .unionByName(keyed("products", back.products, F.col("product_id"), F.col("name")))
        .unionByName(keyed("packages", back.packages, package, F.col("name")))
    )


@query
def first_client_by_country(spark, directory):
    clients = warehouse.clients(spark, directory)
    return one_per_key(clients.select("country", "occupation", "client_id"), "country")


@query
def client_index(spark, directory):
    return dense_index(warehouse.clients(spark, directory), "address_id").table


@query
def explode_components_query(spark, directory):
    rows = explode_components(warehouse.products(spark, directory))
    return rows.withColumn("price", F.col("price").cast("double"))


@query
def component_measures_query(spark, directory):
    products = warehouse.products(spark, directory)
    rows = component_measures(products, warehouse.packages(spark, directory))
    rows = rows.withColumn("drawn", draw(SEED, "qty", F.col("product_id")))
    made = {
        "product_quantity": reciprocal_choice(F.col("drawn"), 3),
        "price": F.col("price").cast("double"),
        "weight": F.col("weight").cast("double"),
    }
    return rows.withColumns(made).select(*COMPONENT_COLUMNS)


@query
def unmatched_components(spark, directory):
    products = warehouse.products(spark, directory)
    rows = component_measures(products, warehouse.packages(spark, directory))
    return rows.where(F.col("width").isNull()).select(
        "product_id", "package_id", "subpackage_id", "package_quantity"
    )


def _items(spark, directory):
    return build_items(
        warehouse.products(spark, directory), warehouse.packages(spark, directory)
    )


@query
def item_packages(spark, directory):
    return (
        _items(spark, directory)
        .select(
            "product_id",
            "product_name",
            "price",
            F.posexplode("packages").alias("package_pos", "package"),
        )
        .select("product_id", "product_name", "price", "package_pos", "package.*")
    )


@query
def unit_measures(spark, directory):
    measures = product_measures(
        warehouse.products(spark, directory), warehouse.packages(spark, directory)
    )
    return measures.select(
        "product_id", "product_name", "price", "is_empty", "unit_volume", "unit_weight"
    )


# --- orders from order lines ------------------------------------------------


@query
def line_products(spark, directory):
    lines = attach_products(
        warehouse.order_lines(spark, directory),
        product_measures(
            warehouse.products(spark, directory), warehouse.packages(spark, directory)
        ),
    )
    return lines.select(
        "order_id", "pos", "product_id", "product_name", "price", "quantity"
    )


@query
def line_products_bucketed(spark, directory):
    """The same from bucketed tables, which are joined without a shuffle."""
    saved = {
        "lines": warehouse.order_lines(spark, directory),
        "measures": product_measures(
            warehouse.products(spark, directory), warehouse.packages(spark, directory)
        ),
    }
    tables = []
    for name, df in saved.items():
        path = scratch_path(spark, name)
        table = "bucketed_" + path[-36:].replace("-", "_")
        tables.append(save_bucketed(df, table, "product_id", 8, path=path))
    lines = bucket_join(*tables, "product_id")
    return lines.select("order_id", "pos", "product_id", "product_name", "price", "quantity")


@query
def line_products_hot(spark, directory):
    """A third of the lines are of one product, and a tenth of none."""
    number = F.expr("cast(substr(order_id, 5) as bigint)")
    skewed = F.when(number % 3 == 0, "prd-7").when(number % 10 != 1, F.col("product_id"))
    lines = warehouse.order_lines(spark, directory).withColumn("product_id", skewed)
    products = product_measures(
        warehouse.products(spark, directory), warehouse.packages(spark, directory)
    )
    joined = hot_join(lines, products, "product_id")
    return joined.select("order_id", "pos", "product_id", "product_name", "price", "quantity")


def _documents(spark, directory, on_empty="drop_order") -> Orders:
    return order_documents(
        warehouse.order_lines(spark, directory),
        _items(spark, directory),
        on_empty=on_empty,
    )


@query
def order_totals_nested(spark, directory):
    return _documents(spark, directory).accepted.select("order_id", *TOTALS)


@query
def order_totals_drop_item(spark, directory):
    orders = _documents(spark, directory, "drop_item")
    return orders.accepted.select("order_id", *TOTALS)


@query
def order_totals_keep(spark, directory):
    return _documents(spark, directory, "keep").accepted.select("order_id", *TOTALS)


@query
def order_totals_parts(spark, directory):
    """Events of one package each, of few, and whole: sums over parts are equal.

    All three come from the same tables, so they share the shuffle of lines with items.
    """
    sources, found = _sources(spark, directory), []
    for limit in (1, 4, None):
        orders = compose_orders(*sources, as_of=AS_OF, max_packages=limit).accepted
        events = to_events(orders, run=RUN, parts=True)
        details = "order_details"
        measured = events.select(
            "order_id", *PARTS, F.size(f"{details}.items").alias("n_items"),
            *[f"{details}.{t}" for t in TOTALS[1:]],
        )
        totals = measured.groupBy("order_id").agg(
            *[F.sum(t).alias(t) for t in TOTALS],
            F.count_if((F.col("part") < 0) | (F.col("part") >= F.col("n_parts"))).alias("n_wrong"),
            (F.count(F.lit(1)) - F.max("n_parts")).alias("n_missing"),
        )
        found.append(totals.withColumn("most", F.lit(limit or 0)))
    return reduce(DataFrame.unionByName, found)


@query
def order_rejects(spark, directory):
    return _documents(spark, directory).rejected


def _outcomes(spark, directory, on_empty):
    """Every order of the orders table or the lines, accepted or with its reason."""
    orders = _composed(spark, directory, on_empty=on_empty)
    accepted = orders.accepted.select("order_id", F.lit("accepted").alias("outcome"))
    rejected = orders.rejected.select("order_id", F.col("reason").alias("outcome"))
    return accepted.unionByName(rejected)


@query
def order_outcomes(spark, directory):
    return _outcomes(spark, directory, "drop_order")


@query
def order_outcomes_drop_item(spark, directory):
    return _outcomes(spark, directory, "drop_item")


@query
def order_outcomes_keep(spark, directory):
    return _outcomes(spark, directory, "keep")


@query
def order_totals_flat(spark, directory):
    measures = product_measures(
        warehouse.products(spark, directory), warehouse.packages(spark, directory)
    )
    orders = order_totals(warehouse.order_lines(spark, directory), measures)
    return orders.accepted.select("order_id", *TOTALS)


@query
def order_totals_exact(spark, directory):
    """Totals whose last bits do not depend on the order of rows, by both routes."""
    products, packages = warehouse.products(spark, directory), warehouse.packages(spark, directory)
    lines = warehouse.order_lines(spark, directory)
    flat = order_totals(lines, product_measures(products, packages, exact=True), exact=True)
    nested = order_documents(lines, build_items(products, packages), exact=True)
    return (
        flat.accepted.select("order_id", *TOTALS, F.lit("flat").alias("route"))
        .unionByName(nested.accepted.select("order_id", *TOTALS, F.lit("nested").alias("route")))
    )


@query
def charges_exact(spark, directory):
    """What each order is charged, of factors that are no binary fractions."""
    schema = "l_orderkey bigint, l_extendedprice double, l_discount double, l_tax double"
    lines = read_table(spark, f"{directory}/lineitem.parquet", schema=T.StructType.fromDDL(schema))
    charge = F.expr("l_extendedprice * (1 - l_discount) * (1 + l_tax)")
    return lines.groupBy(F.col("l_orderkey").alias("order_key")).agg(exact_sum(charge).alias("charge"))


@query
def order_item_packages(spark, directory):
    """Order documents taken apart again, down to the packages."""
    return (
        _documents(spark, directory)
        .accepted.select("order_id", F.explode("items").alias("item"))
        .select("order_id", "item.*")
        .select(
            "order_id",
            "product_id",
            "quantity",
            F.explode("packages").alias("package"),
        )
        .select(
            "order_id",
            "product_id",
            "quantity",
            "package.package_id",
            "package.subpackage_id",
            F.col("package.quantity").alias("package_quantity"),
            "package.weight",
            "package.volume",
        )
    )


@query
def destination_address(spark, directory):
    addresses = client_addresses(warehouse.clients(spark, directory))
    orders = attach_client(warehouse.orders(spark, directory), addresses)
    address = "destination_address"
    return orders.select(
        "order_id",
        "customer_id",
        f"{address}.address_id",
        f"{address}.state",
        f"{address}.country",
        f"{address}.postcode",
        F.col(f"{address}.coordinates")[0].alias("first_coordinate"),
        F.col(f"{address}.coordinates")[1].alias("second_coordinate"),
        f"{address}.lat",
        f"{address}.lon",
    )


# --- events -----------------------------------------------------------------


def _sources(spark, directory):
    """What ``compose_orders`` takes: orders, lines, items and addresses."""
    return (
        warehouse.orders(spark, directory),
        warehouse.order_lines(spark, directory),
        _items(spark, directory),
        client_addresses(warehouse.clients(spark, directory)),
    )


def _composed(spark, directory, **options) -> Orders:
    return compose_orders(*_sources(spark, directory), as_of=AS_OF, **options)


def _events(spark, directory, run=RUN):
    return to_events(_composed(spark, directory).accepted, run=run)


def _leaves(schema: T.StructType, path: str = "") -> list:
    """The plain fields of a nested row; of an array of rows its size."""
    found = []
    for field in schema.fields:
        name = f"{path}{field.name}"
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, f"{name}.")
        elif not isinstance(field.dataType, T.ArrayType):
            found.append(F.col(name).alias(field.name))
        elif isinstance(field.dataType.elementType, T.StructType):
            found.append(F.size(name).cast("bigint").alias(f"n_{field.name}"))
    return found


def _flat_events(events: DataFrame, *more: str) -> DataFrame:
    flat = events.select(*more, *_leaves(order_event_schema))
    return flat.select(*[c for c in flat.columns if c not in UNFILLED])


@query
def order_events(spark, directory):
    return _flat_events(_events(spark, directory))


@query
def event_envelope(spark, directory):
    records = to_envelope(_events(spark, directory), key="event_type")
    parsed = records.select(
        F.decode("key", "UTF-8").alias("record_key"),
        F.from_json(F.decode("value", "UTF-8"), order_event_schema).alias("event"),
    )
    return _flat_events(parsed.select("record_key", "event.*"), "record_key")


@query
def kinesis_records(spark, directory):
    records = to_envelope(_events(spark, directory), shape="kinesis")
    event = F.from_json(F.decode("Data", "UTF-8"), order_event_schema)
    # Behind a generator, else each field would be parsed out of the text by itself.
    parsed = records.select("PartitionKey", F.inline(F.array(event)))
    return parsed.select(
        F.col("PartitionKey").alias("partition_key"), "event_id", "order_details.total_amount"
    )


@query
def validate_events(spark, directory):
    """Typed records: those without an event type are rejected."""
    event_type = F.when(F.col("event_id") % 10 != 0, F.col("event_type"))
    events = warehouse.table(spark, directory, "events")
    valid = split_valid(events.select("event_id", event_type.alias("event_type")))
    return valid.accepted.withColumn("verdict", F.lit("accepted")).unionByName(
        valid.rejected.withColumn("verdict", F.lit("rejected"))
    )


@query
def validate_json(spark, directory):
    """Raw JSON records: numbers, nulls, absent fields, bad JSON are rejected."""
    case = F.col("event_id") % 5
    events = warehouse.table(spark, directory, "events").select(
        "event_id",
        F.when(case == 0, '{"event_type": 5}')
        .when(case == 1, '{"event_type": null}')
        .when(case == 2, F.to_json(F.struct("value")))
        .when(case == 3, F.concat("props", F.lit("}{")))
        .otherwise(F.to_json(F.struct("event_type", "value")))
        .alias("body"),
    )
    valid = split_valid(events, json="body")
    return (
        valid.accepted.withColumn("verdict", F.lit("accepted"))
        .unionByName(valid.rejected.withColumn("verdict", F.lit("rejected")))
        .select("event_id", "verdict")
    )


@query
def validate_documents_query(spark, directory):
    """Raw JSON against a schema: one kind of fault for each of eight cases."""
    case = F.col("event_id") % 10
    whole = F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("type"), "value",
        F.array(F.struct(F.lit(1).alias("n")), F.struct(F.lit(2).alias("n"))).alias("parts"),
    )
    text = F.to_json(whole)
    body = (
        F.when(case == 0, F.concat(text, F.lit("}")))
        .when(case == 1, F.to_json(F.struct("value")))
        .when(case == 2, F.regexp_replace(text, '"type":"[a-z]*"', '"type":7'))
        .when(case == 3, F.regexp_replace(text, '"type":"[a-z]*"', '"type":null'))
        .when(case == 4, F.regexp_replace(text, '"n":2', '"n":2.5'))
        .when(case == 5, F.regexp_replace(text, '"n":2', '"n":3000000000'))
        .when(case == 6, F.regexp_replace(text, '"parts":.*', '"parts":{}}'))
        .when(case == 7, F.regexp_replace(text, '^.', '{"more":1,'))
        .when(case == 8, F.lit("[1]"))
        .otherwise(text)
    )
    schema = T.StructType.fromDDL("id bigint, type string, value double, parts array<struct<n:int>>")
    events = warehouse.table(spark, directory, "events").select("event_id", "value", body.alias("body"))
    valid = validate_documents(events, "body", schema, required=["id", "type", "parts[].n"], strict=True)
    accepted = valid.accepted.select(
        "event_id", F.lit("").alias("path"), F.lit("accepted").alias("reason"), F.col("document.value").alias("value")
    )
    faults = valid.rejected.select("event_id", F.explode("faults").alias("fault"))
    return accepted.unionByName(
        faults.select("event_id", "fault.path", "fault.reason", F.lit(None).cast("double").alias("value"))
    )


# --- draws ------------------------------------------------------------------


@query
def reciprocal_choice_hist(spark, directory):
    """How often each k was drawn for each order, out of 3, 5 and 30."""
    orders = warehouse.orders(spark, directory)
    drawn = orders.select(draw(SEED, "hist", F.col("order_id")).alias("drawn"))
    choices = [
        F.struct(F.lit(n).alias("n"), reciprocal_choice(F.col("drawn"), n).alias("k"))
        for n in (3, 5, 30)
    ]
    return (
        drawn.select(F.explode(F.array(*choices)).alias("choice"))
        .groupBy("choice.n", "choice.k")
        .agg(F.count(F.lit(1)).alias("n_draws"))
    )


@query
def draw_clients(spark, directory):
    index = dense_index(warehouse.clients(spark, directory), "address_id")
    orders = warehouse.orders(spark, directory).select("order_id")
    return draw_rows(orders, index, SEED, "client", F.col("order_id"))


@query
def draw_products(spark, directory):
    """A drawn product for each order line."""
    index = dense_index(warehouse.products(spark, directory), "product_id")
    lines = warehouse.order_lines(spark, directory).select("order_id", "pos")
    return draw_rows(lines, index, SEED, "product", F.col("order_id"), F.col("pos"))


# --- sinks and streams ------------------------------------------------------


@query
def append_roundtrip(spark, directory):
    """Append two runs of events to one table and read it back."""
    path = scratch_path(spark, "events")
    with kept(_composed(spark, directory).accepted, "composed") as orders:
        for run in (RUN, "second"):
            append_events(to_events(orders, run=run), path, by_date=True, few_dates=True)
    return _flat_events(read_table(spark, path, schema=order_event_schema))


@query
def append_replayed(spark, directory):
    """Two runs, one of them repeated, and one that breaks off after some files."""
    path = scratch_path(spark, "events")
    with kept(_composed(spark, directory).accepted, "composed") as orders:
        events = {run: to_events(orders, run=run) for run in (RUN, "second", "broken")}
        broken = F.when(F.crc32("event_id") % 1_000 == 0, F.raise_error(F.lit("broken off")))
        torn = events["broken"].withColumn("event_id", F.coalesce(broken.cast("string"), "event_id"))
        for run, rows in ((RUN, events[RUN]), ("broken", torn), ("second", events["second"]), (RUN, events[RUN])):
            try:
                append_events(rows, path, by_date=True, few_dates=True, run=run)
            except RuntimeError:
                if run != "broken":
                    raise
    sweep_runs(spark, path, older_than=0)
    return _flat_events(read_events(spark, path))


@query
def written_once(spark, directory):
    """Events and rejected orders of a run, computed once and written twice over."""
    path, rejected = scratch_path(spark, "events"), scratch_path(spark, "rejected")
    catalog = prepare_catalog(*warehouse.dimensions(spark, directory))
    orders, lines = warehouse.orders(spark, directory), warehouse.order_lines(spark, directory)
    for _ in range(2):
        write_orders(orders, lines, catalog, path, rejected, run=RUN, as_of=AS_OF)
    accepted = read_events(spark, path).select("order_id", F.lit("accepted").alias("outcome"))
    schema = T.StructType.fromDDL("order_id string, reason string, n_lines long")
    refused = read_runs(spark, rejected, schema).select("order_id", F.col("reason").alias("outcome"))
    return accepted.unionByName(refused)


@query
def read_damaged_query(spark, directory):
    """Lines of csv and json of which every fifth is damaged."""
    events = warehouse.table(spark, directory, "events").select("event_id", "event_type", "value")
    case = F.col("event_id") % 5
    number, kind, value = F.col("event_id").cast("string"), F.col("event_type"), F.col("value").cast("string")
    lines = {
        "csv": F.when(case == 0, F.concat_ws(",", number, kind, F.lit("much")))
        .when(case == 1, F.concat_ws(",", number, kind, value, F.lit("more")))
        .otherwise(F.concat_ws(",", number, kind, value)),
        "json": F.when(case == 0, F.concat(F.lit('{"event_id":'), number, F.lit(',"value":"much"}')))
        .when(case == 1, F.concat(F.lit('{"event_id":'), number))
        .otherwise(F.to_json(F.struct("*"))),
    }
    schema = T.StructType.fromDDL("event_id bigint, event_type string, value double")
    found = []
    for name, line in lines.items():
        path = scratch_path(spark, "damaged")
        events.select(line.alias("value")).write.text(path)
        rows = read_damaged(spark, path, name, schema)
        good = rows.good.select("event_id", F.lit("good").alias("state"), F.lit("").alias("reasons"))
        first = F.regexp_extract("text", "[0-9]+", 0).cast("bigint").alias("event_id")
        bad = rows.bad.select(first, F.lit("bad").alias("state"), F.array_join("reasons", ", ").alias("reasons"))
        found.append(good.unionByName(bad).withColumn("format", F.lit(name)))
    return found[0].unionByName(found[1])


@query
def read_formats(spark, directory):
    """Write and read a table in each format."""
    customers = warehouse.table(spark, directory, "customer")
    root = scratch_path(spark, "formats")
    options = {"csv": {"header": "true"}}
    copies = []
    for name in FORMATS:
        path = f"{root}/{name}"
        write_table(customers, path, name, options=options.get(name))
        copy = read_table(spark, path, name, customers.schema, options.get(name))
        copies.append(copy.withColumn("format", F.lit(name)))
    return reduce(DataFrame.unionByName, copies).select(
        "format", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


@query
def published_lines(spark, directory):
    """Publish events as JSON lines and read them back."""
    path = scratch_path(spark, "published")
    publish(_events(spark, directory), "text", {"path": path, "compression": "gzip"})
    return _flat_events(read_table(spark, path, "json", order_event_schema))


def _orders_with_lines(spark, directory, files):
    """Shuffled once, as plain lines, to so many partitions."""
    line = F.struct("pos", "product_id", "quantity")
    lines = warehouse.order_lines(spark, directory).repartition(files, "order_id")
    lines = lines.groupBy("order_id").agg(F.collect_list(line).alias("lines"))
    orders = warehouse.orders(spark, directory).select("order_id", "address_id")
    return orders.repartition(files, "order_id").join(lines, "order_id", "left")


def _file_stream(spark, source, schema, files=None):
    """A stream of so many files in a batch, or of all that are new."""
    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(source)


@query
def stream_orders(spark, directory):
    """Orders with their lines as a file stream, turned into a table of events."""
    source = scratch_path(spark, "orders")
    table = scratch_path(spark, "stream")
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write_table(_orders_with_lines(spark, directory, files), source)
    start_order_stream(
        # Two batches, or a few more, of as many files as there are tasks to write them.
        _file_stream(spark, source, read_table(spark, source).schema, files // 2),
        prepare_catalog(*warehouse.dimensions(spark, directory)),
        table,
        scratch_path(spark, "stream-checkpoint"),
        as_of=AS_OF,
        ids_run=RUN,
    ).awaitTermination()
    return _flat_events(read_table(spark, table, schema=order_event_schema))


@query
def stream_once(spark, directory):
    """Every order sent twice, and a third time after a restart of the stream."""
    source = scratch_path(spark, "orders")
    table, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = materialize(_orders_with_lines(spark, directory, tasks), "orders")
    catalog = prepare_catalog(*warehouse.dimensions(spark, directory))
    sent = 0
    for copies in (2, 1):
        for _ in range(copies):
            write_table(orders, source, mode="append")
        # Every copy has as many files, and is a batch.
        sent += copies
        files = len(read_table(spark, source).inputFiles()) // sent
        start_order_stream(
            _file_stream(spark, source, orders.schema, files), catalog, table, checkpoint,
            as_of=AS_OF, ids_run=RUN,
        ).awaitTermination()
    return _flat_events(read_table(spark, table, schema=order_event_schema))


@query
def stream_lines(spark, directory):
    """Order lines as a stream: orders close when complete or in time, and late lines
    are counted.

    Of every tenth order the last line comes late; every tenth misses one line that
    never comes, so it closes with those it has.
    """
    source = scratch_path(spark, "lines")
    table, rejected = scratch_path(spark, "stream"), scratch_path(spark, "rejected")
    lines = warehouse.order_lines(spark, directory)
    whole = Window.partitionBy("order_id")
    case = F.expr("cast(substr(order_id, 5) as bigint) % 10")
    told = (
        lines.withColumns({"first": F.min("pos").over(whole), "last": F.max("pos").over(whole), "case": case})
        .withColumn("late", F.expr("`case` = 0 and pos = last and first < last"))
        .join(warehouse.orders(spark, directory).select("order_id", "address_id"), "order_id")
    )
    counted = F.count_if(~F.col("late")).over(whole)
    n_lines = counted + F.when(F.col("case") == 1, 1).otherwise(0)
    told = materialize(told.withColumn("n_lines", n_lines), "lines")
    columns = ["order_id", "address_id", "n_lines", "pos", "product_id", "quantity"]
    stray = told.where("late").select(*columns).limit(1).withColumn("order_id", F.lit(None).cast("string"))
    catalog = prepare_catalog(*warehouse.dimensions(spark, directory))
    checkpoint = scratch_path(spark, "stream-checkpoint")
    # A batch each, in this order: the lines, the late ones, and at last one that stands
    # alone. The stream goes on from its checkpoint, as files do not mark off batches.
    for part in (told.where("not late"), told.where("late"), stray.coalesce(1)):
        write_table(part.select(*columns), source, mode="append")
        start_order_stream(
            gather_orders(_file_stream(spark, source, stray.schema), wait="1 millisecond"),
            catalog,
            table,
            checkpoint,
            rejected_path=rejected,
            as_of=AS_OF,
            ids_run=RUN,
        ).awaitTermination()
    events = read_table(spark, table, schema=order_event_schema).select(
        "order_id", F.lit("accepted").alias("outcome"),
        F.size("order_details.items").cast("bigint").alias("n_lines"), "order_details.total_amount",
    )
    refused = read_table(spark, rejected).select(
        "order_id", F.col("reason").alias("outcome"), "n_lines", F.lit(None).cast("double").alias("total_amount")
    )
    return events.unionByName(refused)


@query
def stream_published(spark, directory):
    """A stream of events, published as JSON lines."""
    source = scratch_path(spark, "events")
    path = scratch_path(spark, "stream-published")
    append_events(_events(spark, directory), source)
    stream = spark.readStream.schema(order_event_schema).parquet(source)
    publish(
        stream,
        "text",
        {"path": path, "compression": "gzip"},
        checkpoint=scratch_path(spark, "publish-checkpoint"),
    ).awaitTermination()
    return _flat_events(read_table(spark, path, "json", order_event_schema))
