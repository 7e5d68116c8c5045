"""Random small shops, computed once by Spark and once by plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from ordermill.operators import build_items, order_documents, order_totals, product_measures
from ordermill.schemas import packages_schema, products_schema
from tests.conftest import LINES, rows


def maybe(rng, value, chance=0.15):
    return None if rng.random() < chance else value


def random_shop(seed):
    rng = random.Random(seed)
    names = ["a", "b", "c", None]
    packages = [
        (rng.choice(names), maybe(rng, k), "box", 1, 1, 1,
         maybe(rng, rng.randint(1, 40) / 4), maybe(rng, rng.randint(1, 9)), 1)
        for k in (1, 2, 3) for _ in range(2)
    ]
    products = [
        (f"p{rng.randint(0, 11)}", f"name {k}", None, None, maybe(rng, k + 0.5, 0.05), None,
         [(rng.choice(names), maybe(rng, rng.randint(1, 3)), maybe(rng, rng.randint(1, 5), 0.03))
          for _ in range(rng.randint(0, 4))])
        for k in range(14)
    ]
    lines = [
        (f"o{rng.randint(0, 25)}", pos, f"p{rng.randint(0, 12)}", maybe(rng, rng.randint(1, 9), 0.02))
        for pos in range(70)
    ]
    return packages, products, lines


def expected_items(packages, products):
    items = {}
    for product in products:
        header = (not product[6], product[1], product[4])
        entries = []
        for pos, (package_id, subpackage_id, quantity) in enumerate(product[6]):
            matches = [
                p for p in packages
                if None not in (package_id, subpackage_id) and p[:2] == (package_id, subpackage_id)
            ] or [(None,) * 9]
            entries += [
                ((product[1], pos), package_id, subpackage_id, quantity, m[6], m[7]) for m in matches
            ]
        item = items.setdefault(product[0], {"headers": [], "entries": []})
        item["headers"].append(header)
        item["entries"] += entries
    for item in items.values():
        item["empty"], item["name"], item["price"] = min(item["headers"], key=lambda h: h[:2])
    return items


def expected_orders(packages, products, lines, on_empty):
    items = expected_items(packages, products)
    orders = {}
    for order_id, pos, product_id, quantity in lines:
        orders.setdefault(order_id, []).append((pos, product_id, quantity))
    totals = {}
    for order_id, order in orders.items():
        picked = [(items.get(p), q) for _, p, q in order]
        if any(i is None for i, _ in picked):
            continue
        if on_empty == "drop_item":
            picked = [(i, q) for i, q in picked if not i["empty"]]
        if not picked:
            continue
        if on_empty == "drop_order" and any(i["empty"] for i, _ in picked):
            continue
        if any(q is None or i["price"] is None or any(e[3] is None for e in i["entries"])
               for i, q in picked):
            continue

        def measure(k):
            return sum(
                q * e[3] * (1 if e[k] is None else e[k]) for i, q in picked for e in i["entries"]
            )

        amount = sum(q * i["price"] for i, q in picked)
        totals[order_id] = (len(picked), amount, float(measure(5)), float(measure(4)))
    return totals


TOTALS = ("order_id", "n_items", "total_amount", "total_volume", "total_weight")


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("on_empty", ["drop_order", "drop_item", "keep"])
def test_totals_equal_plain_loops(spark, seed, on_empty):
    packages, products, lines = random_shop(seed)
    shop = (
        spark.createDataFrame(products, products_schema),
        spark.createDataFrame(packages, packages_schema),
    )
    frame = spark.createDataFrame(lines, LINES)
    wanted = sorted((k, *v) for k, v in expected_orders(packages, products, lines, on_empty).items())
    nested = order_documents(frame, build_items(*shop), on_empty=on_empty)
    flat = order_totals(frame, product_measures(*shop), on_empty=on_empty)
    assert wanted
    assert rows(nested.accepted, *TOTALS) == sorted(wanted, key=repr)
    assert rows(flat.accepted, *TOTALS) == sorted(wanted, key=repr)
    ids = {line[0] for line in lines}
    assert {r[0] for r in rows(nested.rejected)} == ids - {w[0] for w in wanted}
    assert rows(nested.rejected) == rows(flat.rejected)


def test_parts_equal_plain_loops(spark):
    packages, products, lines = random_shop(4)
    items = build_items(
        spark.createDataFrame(products, products_schema),
        spark.createDataFrame(packages, packages_schema),
    )
    frame = spark.createDataFrame(lines, LINES)
    parts = order_documents(frame, items, on_empty="drop_item", max_packages=2).accepted
    sums = parts.groupBy("order_id").agg(*[F.sum(t).alias(t) for t in TOTALS[1:]])
    wanted = expected_orders(packages, products, lines, "drop_item")
    assert rows(sums, *TOTALS) == sorted(((k, *v) for k, v in wanted.items()), key=repr)
