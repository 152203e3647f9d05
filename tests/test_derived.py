"""The network derived from orders: neighbours across blocks, and one shuffle of the items."""

import datetime

from pyspark.sql import functions as F

from wayloom.plans import derived

ITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string"
)


def write_orders(spark, folder, orders):
    day = datetime.datetime(2020, 1, 1)
    rows = [(key, 3, node, i, day, 1.0, 0.1, 0.02, "N") for key, nodes in orders for i, node in enumerate(nodes)]
    spark.createDataFrame(rows, ITEM).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i,) for i in range(10)], "s_suppkey long").write.parquet(f"{folder}/supplier.parquet")


def test_turns_reach_the_next_two_roads_in_any_block(spark, tmp_path):
    width = 1 << derived.BLOCK_BITS
    keys = [*range(width - 6, width + 7), 2 * width - 1, 2 * width + 1, 5 * width - 1, 5 * width, -1, 0, 3]
    orders = {k: [k % 4, (k + 1) % 4, 5] if k % 5 else [8, 9] for k in keys}
    orders[width + 4] = [6, 6]  # not a line
    write_orders(spark, str(tmp_path), [*orders.items(), (None, [1, 2])])
    found = derived.features(spark, str(tmp_path), references=True).filter("type = 'segment'")
    got = {r.id: r.prohibited_transitions for r in found.collect()}
    roads = {k: {f"n{n}" for n in nodes} for k, nodes in orders.items() if len(set(nodes)) > 1}
    expected = {None: None}
    for k, nodes in roads.items():
        first = nodes & roads.get(k + 1, set())
        second = roads.get(k + 1, set()) & roads.get(k + 2, set())
        steps = [(min(first), str(k + 1))] if first else None
        if steps and k % 5 == 0 and second:
            steps.append((min(second), str(k + 2)))
        expected[str(k)] = steps
    assert {k: [tuple(s) for s in t[0].sequence] if t else None for k, t in got.items()} == expected
    assert any(expected.values())


def test_items_are_shuffled_once(spark, tmp_path):
    write_orders(spark, str(tmp_path), [(k, [k % 3, 7]) for k in range(20)])
    table = derived.features(spark, str(tmp_path), references=True).filter(F.col("type") == "segment")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
