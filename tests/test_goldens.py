"""Placement and cutting against known results; positions and pieces must match exactly."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from shapes import as_pairs, coords

from wayloom.functions import lineref
from wayloom.functions.binding import bind
from wayloom.operators import cutting, placement

# Published cases that must match, in the file beside this one.
GOLDENS = json.loads((Path(__file__).parent / "goldens.json").read_text())
JOINED = "array<struct<connector_index:int,connector_id:string,connector_geometry:struct<x:double,y:double>>>"
SCHEMA = f"case int, id string, geometry array<struct<x:double,y:double>>, joined_connectors {JOINED}, lrs array<double>"


def points(spark, rows):
    table = []
    for case, (id_, line, connectors, lrs) in enumerate(rows):
        joined = [(i, str(i), coords(p)[0]) for i, p in enumerate(connectors or [])]
        table.append((case, id_, coords(line), joined, [float(v) for v in sorted(set(lrs or []))]))
    placed = placement.place_connectors(placement.measure(spark.createDataFrame(table, SCHEMA)))
    return placement.place_lr_values(placed, F.col("lrs"), 7, 0.01)


def test_connectors_on_vertices(spark):
    cases = GOLDENS["place_connector"]
    rows = points(spark, [("s", line, [point], None) for _, point, line in cases]).orderBy("case").collect()
    for (expected, point, _), row in zip(cases, rows, strict=True):
        (found,) = row["_points"]
        assert found.id == "0" and (found.x, found.y) == coords(point)[0]
        # Published positions are only this exact.
        assert abs(found.lr - expected) < 0.0037


def test_positions_to_points(spark):
    cases = GOLDENS["locate_lrs"]
    rows = points(spark, [("1", line, None, lrs) for _, lrs, line in cases]).orderBy("case").collect()
    for (expected, lrs, _), row in zip(cases, rows, strict=True):
        assert [(p.x, p.y) for p in row["_points"]] == [coords(p)[0] for p in expected]
        assert [p.id for p in row["_points"]] == [f"1@{lr}" for lr in lrs]
        assert all(p.is_added for p in row["_points"])


def test_pieces(spark):
    cases = GOLDENS["cut_lines"]
    assert len(cases) == 15
    table = points(spark, [("", line, connectors, lrs) for _, line, connectors, lrs, _ in cases])
    rows = bind(table, _cut=cutting.cut(F.col("_points"), F.col("geometry"))).orderBy("case").collect()
    for (label, _, _, _, expected), row in zip(cases, rows, strict=True):
        assert [as_pairs(p.geometry) for p in row["_cut"]] == [coords(e) for e in expected], label


# Length 1000 m, piece from 0 to 0.5.
RESCOPED = [
    ([0.0, 0.8], True, None),
    ([0.7, 0.8], False, None),
    ([0.1, 0.4], True, [0.2, 0.8]),
    ([0.0, 0.499991], True, None),
    ([0.49998, 0.8], True, [0.99996, 1.0]),
    ([0.499991, 0.8], False, None),
]


def test_rescoped_ranges(spark):
    table = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(RESCOPED)], "i int, r array<double>")
    one = lineref.rescope_range(F.col("r"), F.lit(0.0), F.lit(500.0), F.lit(1000.0), 0.01)
    for (_, applies, between), row in zip(RESCOPED, table.select("i", one.alias("s")).orderBy("i").collect(), strict=True):
        assert row.s.applies == applies
        assert row.s["between"] == (pytest.approx(between, abs=1e-5) if between else None)
