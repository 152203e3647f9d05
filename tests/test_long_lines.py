"""Searches by halving against plain counting, and a line of 20,000 vertices."""

import random
import time

import pytest
from pyspark.sql import functions as F

from shapes import SEGMENT_DDL
from wayloom.functions.binding import halvings, leading, pick
from wayloom.operators import cutting
from wayloom.operators.placement import _may_lie_on

JOINED = SEGMENT_DDL + (
    ", joined_connectors array<struct<connector_index:int,connector_id:string,"
    "connector_geometry:struct<x:double,y:double>,connector_at:double>>, rules array<struct<value:int,between:array<double>>>"
)


def test_leading_places(spark):
    rng = random.Random(2)
    rows = [(sorted(rng.uniform(0, 1) for _ in range(n)), rng.uniform(-0.1, 1.1)) for n in [0, 1, 2, 3, 7, 8, 9, 100] * 20]
    df = spark.createDataFrame(rows, "a array<double>, v double")
    found = df.select("a", "v", leading(halvings(F.size("a")), lambda i: pick(F.col("a"), i) < F.col("v")).alias("n"))
    for r in found.collect():
        assert r.n == sum(x < r.v for x in r.a)
    assert df.limit(1).select(halvings(F.lit(None).cast("int"))).first()[0] in (None, [1])


def test_edges_that_hold_a_point_are_near_it(spark):
    """No edge on which a point counts as lying is left out by the box."""
    from wayloom.functions.geodesy import distance

    rng = random.Random(3)
    rows = []
    for _ in range(20_000):
        lat, lon, size = rng.uniform(-84, 84), rng.uniform(-179, 179), 10 ** rng.uniform(-6, -2.2)
        ax, ay, bx, by = lon, lat, lon + rng.uniform(-size, size), lat + rng.uniform(-size, size)
        t, off = rng.uniform(-0.01, 1.01), rng.choice([0, 1e-8, 1e-7, 1e-6])
        rows.append((ax, ay, bx, by, ax + t * (bx - ax) + rng.uniform(-off, off), ay + t * (by - ay) + rng.uniform(-off, off)))
    df = spark.createDataFrame(rows, "ax double, ay double, bx double, by double, px double, py double")
    c = F.col
    point = lambda p: F.struct(c(f"{p}x").alias("x"), c(f"{p}y").alias("y"))
    whole = distance(c("ax"), c("ay"), c("bx"), c("by"))
    legs = distance(c("ax"), c("ay"), c("px"), c("py")) + distance(c("bx"), c("by"), c("px"), c("py"))
    judged = df.select((F.abs(legs - whole) < 0.001).alias("on"), _may_lie_on(point("p"), point("a"), point("b"), whole).alias("near"))
    counts = {(r.on, r.near): r["count"] for r in judged.groupBy("on", "near").count().collect()}
    assert (True, False) not in counts and counts[True, True] > 5_000


@pytest.mark.parametrize("vertices", [20_000])
def test_long_line_with_many_references(spark, vertices):
    rng = random.Random(5)
    line = [(-122 + i * 1e-5, 47 + (i % 7) * 1e-6) for i in range(vertices)]
    middle = lambda i: tuple((a + b) / 2 for a, b in zip(line[i], line[i + 1]))
    spots = sorted(rng.sample(range(1, vertices - 1), 60))
    # Every third connector lies in the middle of an edge.
    places = [line[0], *(middle(i) if n % 3 == 0 else line[i] for n, i in enumerate(spots)), line[-1]]
    listed = [(f"c{n}", 0.5) for n in range(len(places))]
    joined = [(n, f"c{n}", p, 0.5) for n, p in enumerate(places)]
    values = sorted(rng.uniform(0.001, 0.999) for _ in range(2_000))
    rules = [(n, [values[2 * n], values[2 * n + 1]]) for n in range(1_000)]
    df = spark.createDataFrame([("long", "segment", line, listed, joined, rules)], JOINED)
    begun = time.perf_counter()
    row = cutting.split_points(df, ["rules"]).select("_unplaced", F.size("_placed").alias("placed"), "_points", "_total").first()
    assert time.perf_counter() - begun < 40
    assert row["_unplaced"] == 0 and row.placed == 62
    added = [p for p in row["_points"] if p.is_added]
    assert 1_900 < len(added) <= 2_000
    assert all(a.metres < b.metres for a, b in zip(added, added[1:]))
    for p in added[::100]:
        assert p.lr == pytest.approx(p.metres / row["_total"])
        assert line[p.vertex][0] - 1e-7 <= p.x <= line[p.vertex + 1][0] + 1e-7
