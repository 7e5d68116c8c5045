import math
import random

import pytest
from pyspark.sql import functions as F

from ordermill.functions import exact_sum, exact_total
from ordermill.operators import build_items, order_documents, order_totals, product_measures
from tests.conftest import rows


def values(n, seed=3):
    rng = random.Random(seed)
    return [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-3, 11) for _ in range(n)] + [0.1, 1e17, -1e17, 2.0**61, -3.0]


def bits(df):
    return {r[0].hex() if r[0] is not None else None for r in df.collect()}


def test_equal_bits_in_any_order(spark):
    data = values(5_000)
    df = spark.createDataFrame([(v,) for v in data], "x double")
    found = set()
    for n in (1, 8, 211):
        for seed in (1, 2):
            found |= bits(df.orderBy(F.rand(seed)).repartition(n).agg(exact_sum(F.col("x"))))
    found |= bits(df.agg(exact_total(F.collect_list("x"))))
    assert len(found) == 1
    assert float.fromhex(found.pop()) == pytest.approx(math.fsum(data), rel=1e-15, abs=1e-12)


def test_exact_for_values_of_a_grid(spark):
    rng = random.Random(9)
    data = [rng.randint(-(1 << 40), 1 << 40) / 1024 for _ in range(3_000)]
    df = spark.createDataFrame([(v,) for v in data], "x double")
    assert df.agg(exact_sum(F.col("x"))).first()[0] == math.fsum(data)


@pytest.mark.parametrize("data, total", [
    ([], None), ([None], None), ([None, 1.5], 1.5), ([float("inf"), 1.0], float("inf")), ([1e300, -1e300, 2.5], 2.5),
    ([-0.1] * 10, None), ([float("inf"), float("-inf")], float("nan")), ([float("nan"), 1.0], float("nan")), ([-1.0, 0.25], -0.75),
])
def test_odd_values(spark, data, total):
    df = spark.createDataFrame([(v,) for v in data], "x double")
    found = df.agg(exact_sum(F.col("x"))).first()[0]
    if data == [-0.1] * 10:
        assert found == math.fsum(data)
    elif total is not None and math.isnan(total):
        assert math.isnan(found)
    else:
        assert found == total


def test_of_an_array(spark):
    df = spark.sql("select array(0.1D, 0.2D, 0.3D) a, array() b, array(1D, null) c, cast(null as array<double>) d, array(1e300D, 1D) e")
    found = df.select(*[exact_total(F.col(c).cast("array<double>")) for c in "abcde"]).first()
    assert tuple(found) == (math.fsum([0.1, 0.2, 0.3]), 0.0, None, None, 1e300)


def test_flat_and_nested_totals_have_equal_bits(spark, shop):
    rng = random.Random(4)
    packages = [("p", k, "n", 1, 1, 1, rng.random() * 9, rng.randint(1, 999), 0) for k in range(20)]
    packages = spark.createDataFrame(packages, shop.packages.schema)
    products = [
        (f"q{k}", f"Q{k}", "c", None, rng.random() * 99, "EUR", [("p", rng.randrange(25), rng.randint(1, 5)) for _ in range(4)])
        for k in range(30)
    ]
    products = spark.createDataFrame(products, shop.products.schema)
    lines = [(f"o{k % 7}", k, f"q{rng.randrange(30)}", rng.randint(1, 9)) for k in range(700)]
    lines = spark.createDataFrame(lines, "order_id string, pos int, product_id string, quantity int")
    columns = ["order_id", "n_items", "total_amount", "total_volume", "total_weight"]
    nested = order_documents(lines, build_items(products, packages), exact=True).accepted
    wanted = rows(nested, *columns)
    for n in (1, 8, 211):
        measures = product_measures(products.repartition(3), packages, exact=True)
        flat = order_totals(lines.orderBy(F.rand(n)).repartition(n), measures, exact=True).accepted
        assert rows(flat, *columns) == wanted
    assert len(wanted) == 7


def test_an_element_of_an_array_is_looked_at_once(spark):
    """What is used again is kept: such functions are interpreted, not compiled."""
    df = spark.sql("select array(1.5D, null) as v, id from range(1)")
    plan = df.select(exact_total(F.col("v")).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("isnan(") <= 3
