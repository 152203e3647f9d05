import pytest
from pyspark.sql import functions as F

from wayloom.operators import network, references
from wayloom.operators.skew import hot_keys, salted_join


@pytest.fixture(scope="module")
def sides(spark):
    # One key holds a third of all rows; others have one to three.
    key = F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string")))
    left = spark.range(1200).select("id", key.alias("key"), (F.col("id") % 5).alias("v"))
    right = spark.range(0, 400, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("w"))
    return left, right.unionByName(spark.createDataFrame([("hub", -1), ("hub", -2)], "key string, w long"))


def same(a, b):
    columns = sorted(a.columns)
    return sorted(map(str, a.select(*columns).collect())) == sorted(map(str, b.select(*columns).collect()))


def test_hot_keys_and_their_shares(sides):
    assert [tuple(r) for r in hot_keys(sides[0], ["key"], 100).collect()] == [("hub", 4)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_task", [20, 10**6])
def test_salted_join_equals_plain_join(sides, how, rows_per_task):
    left, right = sides
    salted = salted_join(left, right, ["key"], how, [F.col("id")], rows_per_task=rows_per_task)
    assert same(salted, left.join(right, "key", how))


def test_salted_join_with_condition(sides):
    left, right = sides
    salted = salted_join(left, right, ["key"], "inner", [F.col("id")], (F.col("v") > 2) | (F.col("w") > 90), rows_per_task=20)
    assert same(salted, left.join(right, "key").filter((F.col("v") > 2) | (F.col("w") > 90)))


def test_null_keys_stay_and_are_spread(sides):
    left, right = sides
    holes = left.withColumn("key", F.when(F.col("id") % 4 != 0, F.col("key")))
    salted = salted_join(holes, right, ["key"], "left", [F.col("id")], rows_per_task=50)
    assert same(salted, holes.join(right, "key", "left"))
    assert hot_keys(holes.filter("key is null"), ["key"], 10).count() == 0


def test_hub_rows_are_spread(sides):
    left, _ = sides
    hot = hot_keys(left, ["key"], 50)
    shares = left.join(hot, "key").withColumn("share", F.pmod(F.xxhash64("id"), F.col("_shares")))
    sizes = [r["count"] for r in shares.groupBy("share").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 100


def test_hub_connector_in_a_third_of_all_pairs(spark):
    lines = spark.range(300).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("id"),
        F.lit("segment").alias("type"),
        F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))).alias("geometry"),
        F.array(
            *[
                F.struct(c.alias("connector_id"), F.lit(0.0).alias("at"))
                for c in (F.lit("hub"), F.concat(F.lit("c"), F.col("id").cast("string")), F.lit("gone"))
            ]
        ).alias("connectors"),
    )
    points = spark.range(300).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("id"), F.col("id").cast("double").alias("x"))
    points = points.unionByName(spark.createDataFrame([("hub", -1.0)], "id string, x double")).select(
        "id", F.lit("connector").alias("type"), F.array(F.struct("x", F.lit(0.0).alias("y"))).alias("geometry")
    )
    features = lines.unionByName(points, allowMissingColumns=True)
    spread, plain = (network.join_connectors(features, rows_per_task=n) for n in (10, 10**6))
    assert same(spread, plain)
    row = spread.filter("id = 's7'").first()
    assert [(c.connector_id, c.connector_geometry and c.connector_geometry.x) for c in row.joined_connectors] == [
        ("hub", -1.0), ("c7", 7.0), ("gone", None),
    ]


def test_many_items_with_one_target(spark):
    pieces = spark.createDataFrame(
        [("t", i, i / 4, (i + 1) / 4, [(f"n{i}", 0.0), (f"n{i + 1}", 1.0)]) for i in range(4)],
        "id string, piece_no int, start_lr double, end_lr double, connectors array<struct<connector_id:string,at:double>>",
    )
    items = spark.range(500).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("id"),
        F.lit(0).alias("piece_no"),
        F.lit("prohibited_transitions").alias("kind"),
        F.lit(0).alias("item"),
        F.lit(0).alias("step"),
        F.lit("t").alias("segment_id"),
        F.lit("n2").alias("connector_id"),
        F.when(F.col("id") % 2 == 0, "n1").alias("next_connector_id"),
        F.when(F.col("id") % 4 == 1, "forward").alias("final_heading"),
    )
    found = references.match_items(items, pieces, rows_per_task=50)
    counts = {tuple(r)[:1]: r["count"] for r in found.groupBy("ref_start_lr").count().collect()}
    # Between n1 and n2 for items in the middle, and for those not heading forward.
    assert counts == {(0.25,): 250 + 125, (0.5,): 125}
