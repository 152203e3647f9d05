import math
import random
import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from shapes import as_pairs, coords

from wayloom.functions import geodesy, lineref, lines
from wayloom.functions.binding import number_text
from wayloom.functions.polygon import meets_polygon, polygon_rings
from wayloom.functions.schema_walk import choose_columns, columns_holding
from wayloom.sources import wkb

LINE = "id int, g array<struct<x:double,y:double>>"


def test_number_text_follows_ids(spark):
    values = [0.5, 0.02877969, 0.0012, 0.001, 0.00095, 0.0001, 1.25e-05, 1e-05, 3e-12, 1.0, 0.0, 0.42000000000000004]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in table.select(number_text(F.col("v"))).collect()] == [repr(v) for v in values]


def test_repeats(spark):
    table = spark.createDataFrame(
        [(0, [(0.0, 0.0), (1.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 2.0)]), (1, [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)])], LINE
    )
    rows = table.select(lines.has_repeats(F.col("g")), lines.without_repeats(F.col("g"))).collect()
    assert [r[0] for r in rows] == [True, False]
    assert all(as_pairs(r[1]) == [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)] for r in rows)


def test_running_totals_over_several_blocks(spark):
    values = [random.Random(1).random() * 100 for _ in range(5000)]
    expected = [0.0]
    for v in values:
        expected.append(expected[-1] + v)
    table = spark.createDataFrame([(values,), ([],), (values[:33],)], "v array<double>")
    got = [r[0] for r in table.select(lines.running_totals(F.col("v"))).collect()]
    assert got == [expected, [0.0], expected[:34]]


def test_geodesic_known_distances(spark):
    # One degree along the equator and along the meridian at it, on WGS84.
    table = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (179.5, 0.0, -179.5, 0.0)], "a double, b double, c double, d double")
    got = [r[0] for r in table.select(geodesy.distance(*[F.col(c) for c in "abcd"])).collect()]
    assert got == pytest.approx([111319.4908, 110574.3886, 111319.4908], abs=1e-3)


def test_points_along_agree_with_distances(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(300):
        rows.append((rnd.uniform(-170, 170), rnd.uniform(-70, 70), rnd.uniform(0, 2 * math.pi), 10 ** rnd.uniform(0, 5), rnd.random()))
    table = spark.createDataFrame(rows, "x double, y double, az double, d double, t double")
    start = F.col("x"), F.col("y")
    ends = table.withColumn("e", geodesy.point_along(*start, F.col("az"), F.col("d"))).cache()
    end = F.col("e.x"), F.col("e.y")
    part = F.col("d") * F.col("t")
    direct = geodesy.point_along(*start, F.col("az"), part)
    checked = ends.select(
        (geodesy.distance(*start, *end) - F.col("d")).alias("off"),
        geodesy.point_on_edge(*start, *end, F.col("d"), part).alias("p"),
        direct.alias("q"),
    )
    for r in checked.collect():
        assert abs(r.off) < 1e-4
        assert abs(r.p.x - r.q.x) < 2e-10 and abs(r.p.y - r.q.y) < 2e-10


def crosses(line):
    """Plain check of all pairs of edges."""
    line = [p for i, p in enumerate(line) if i == 0 or p != line[i - 1]]
    side = lambda a, b, p: math.copysign(1, v) if (v := (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])) else 0
    edges = list(zip(line, line[1:]))
    for i, (a, b) in enumerate(edges):
        for j in range(i + 1, len(edges)):
            c, d = edges[j]
            shared = (b, a, d) if j == i + 1 else (a, b, c) if i == 0 and j == len(edges) - 1 and a == d else None
            if shared:
                s, p, q = shared
                if side(s, p, q) == 0 and (p[0] - s[0]) * (q[0] - s[0]) + (p[1] - s[1]) * (q[1] - s[1]) > 0:
                    return True
                continue
            apart = any(max(a[k], b[k]) < min(c[k], d[k]) or max(c[k], d[k]) < min(a[k], b[k]) for k in (0, 1))
            if not apart and side(a, b, c) * side(a, b, d) <= 0 and side(c, d, a) * side(c, d, b) <= 0:
                return True
    return False


def test_self_intersection_against_all_pairs(spark):
    rnd = random.Random(3)
    cases = [
        [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)],
        [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)],
        [(0.0, 0.0), (2.0, 0.0), (1.0, 0.0)],
        [(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 0.0)],
        [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)],
        [(0.0, 0.0), (1.0, 1.0)],
    ]
    for n in (5, 40, 90, 200):
        for _ in range(12):
            x, line = 0.0, []
            for _ in range(n):
                x += rnd.choice([1, 1, 1, 2, 0 if n < 41 else 1])
                line.append((x, float(rnd.randint(0, 3))))
            if rnd.random() < 0.5:
                k = rnd.randrange(n)
                line.append((line[k][0], line[k][1] + rnd.choice([0.0, 0.5])))
            cases.append(line)
    table = spark.createDataFrame(list(enumerate(cases)), LINE)
    got = dict(table.select("id", lines.is_self_intersecting(F.col("g"))).collect())
    expected = {i: crosses(c) for i, c in enumerate(cases)}
    assert got == expected and {True, False} == set(expected.values())


def test_length_buckets(spark):
    bounds = [0.0, 0.01, 0.011, 0.1, 1.0, 1.5, 100.0, 1000.0, 10000.0, 10000.1]
    table = spark.createDataFrame([(b,) for b in bounds], "m double")
    assert "".join(r[0][0] for r in table.select(lines.length_bucket(F.col("m"))).collect()) == "AABBCDDEFG"


# ---------------------------------------------------------------- polygon


def test_polygon_text_is_checked():
    assert len(polygon_rings("MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5),(5.1 5.1,5.2 5.1,5.2 5.2,5.1 5.1)))")) == 3
    for bad in ("", "POINT (1 2)", "POLYGON ((0 0, 1 0, 1 1))", "POLYGON ((0 0, 1 0, 0 x, 0 0))", "POLYGON (0 0, 1 1)", "POLYGON ((0 0,1 0,1 1,0 0)"):
        with pytest.raises(ValueError):
            polygon_rings(bad)


def test_polygon_touching_counts(spark):
    ring = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))"
    cases = {
        "POINT (0.5 0.5)": True,
        "POINT (2 2)": False,
        "POINT (0 2)": True,
        "POINT (4 4)": True,
        "POINT (5 5)": False,
        "LINESTRING (-1 2, 5 2)": True,
        "LINESTRING (1.5 1.5, 2.5 2.5)": False,
        "LINESTRING (1.5 1.5, 3 3)": True,
        "LINESTRING (-1 5, 5 5)": False,
        "LINESTRING (-1 1, 1 -1)": True,
        "LINESTRING (-2 1, 1 -2)": False,
    }
    table = spark.createDataFrame([(i, coords(w)) for i, w in enumerate(cases)], LINE)
    got = table.select("id", meets_polygon(F.col("g"), polygon_rings(ring))).orderBy("id").collect()
    assert [r[1] for r in got] == list(cases.values())


# ---------------------------------------------------------------- binary geometry


def blob(points, order="<", kind=None, head=b""):
    mark = b"\x01" if order == "<" else b"\x00"
    kind = kind or (1 if len(points) == 1 else 2)
    count = struct.pack(order + "I", len(points)) if kind & 0xFF in (2,) or kind == 1002 else b""
    return mark + struct.pack(order + "I", kind) + head + count + b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in points)


def test_binary_forms():
    line = [(1.5, -2.25), (3.0, 4.0)]
    values = [
        blob(line),
        blob(line, ">"),
        None,
        blob(line[:1]),
        blob([(1.5, -2.25, 9.0), (3.0, 4.0, 9.0)], kind=1002),
        blob(line, kind=2 | 0x20000000, head=struct.pack("<I", 4326)),
        blob([(1.5, -2.25, 9.0), (3.0, 4.0, 9.0)], ">", kind=2 | 0x80000000),
        b"\x01\x03\x00\x00\x00\x00\x00\x00\x00",
        b"",
        blob(line)[:-3],
        blob(line),
    ]
    full = [{"x": x, "y": y} for x, y in line]
    expected = [full, full, None, full[:1], full, full, full, None, None, None, full]
    assert wkb.decode(pa.array(values, pa.binary())).to_pylist() == expected
    assert wkb.decode(pa.array(values, pa.binary()).slice(3, 5)).to_pylist() == expected[3:8]
    assert wkb.decode(pa.array([], pa.binary())).to_pylist() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.lists(st.tuples(*[st.floats(allow_nan=False, allow_infinity=False)] * 2), max_size=6), max_size=8))
def test_binary_round_trip(shapes):
    value = [None if s is None else [{"x": x, "y": y} for x, y in s] for s in shapes]
    array = pa.array(value, pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    assert wkb.decode(wkb.encode(array)).to_pylist() == [v or None for v in value]
    assert wkb.encode(array).to_pylist() == [blob(s) if s else None for s in shapes]


# ---------------------------------------------------------------- linear references

NESTED_DDL = (
    "id int, rules array<struct<value:string,between:array<double>>>, "
    "names struct<primary:string,common:map<string,string>,rules:array<struct<value:string,between:array<double>>>>, "
    "deep array<struct<between:array<double>,parts:array<struct<a:int,between:array<double>>>,tags:array<string>>>, "
    "plain string, by_key map<string,struct<between:array<double>>>"
)


@pytest.fixture
def nested(spark):
    return T.StructType.fromDDL(NESTED_DDL)


def test_scoped_columns_are_found(nested):
    assert columns_holding(nested) == ["rules", "names", "deep"]
    assert choose_columns(["a", "b", "c"], [], ["b"]) == ["a", "c"]
    assert choose_columns(["a", "b", "c"], ["c", "a"], ["a"]) == ["c"]
    with pytest.raises(ValueError, match="zzz"):
        choose_columns(["a"], ["zzz"])


def test_split_values_at_any_depth(spark, nested):
    rows = [
        (0, [("p", [0.2, None]), ("q", None)], None, [([0.1, 1.0], [(1, [0.0, 0.7]), None], None), None], None, None),
        (1, None, None, None, None, None),
        (2, [], ("n", {"en": "x"}, None), None, None, None),
        (3, None, ("n", None, [("x", [0.3, 0.2])]), None, None, None),
    ]
    table = spark.createDataFrame(rows, nested)
    typed = [(F.col(c), nested[c].dataType) for c in ("rules", "names", "deep")]
    got = [r[1] for r in table.select("id", lineref.all_split_values(typed)).orderBy("id").collect()]
    assert got == [[0.0, 0.1, 0.2, 0.7, 1.0], [], [0.0, 1.0], [0.0, 0.2, 0.3, 1.0]]
    wrong = spark.createDataFrame([(0, [("p", [0.1])], None, None, None, None), (1, [("p", [0.1, 0.2])], None, None, None, None)], nested)
    assert [r[0] for r in wrong.select(lineref.has_malformed(typed)).collect()] == [True, False]


def test_rescoping_empties_upwards(spark, nested):
    rows = [
        (
            0,
            [("gone", [0.6, 0.9]), ("all", [0.0, 0.8]), ("part", [0.1, 0.3]), ("open", None), (None, None), None],
            ("n", {"en": "x", "fr": None}, [("gone", [0.7, 0.8])]),
            [([0.0, 0.5], [(1, [0.9, 1.0])], []), ([0.0, 0.25], [(2, [0.25, 0.5]), (3, [0.0, 0.2])], ["t", None])],
            "p",
            None,
        ),
        (1, [("gone", [0.6, 0.9])], (None, {"fr": None}, []), [], None, None),
    ]
    table = spark.createDataFrame(rows, nested)
    out = [
        lineref.rescope(F.col(c), nested[c].dataType, F.lit(0.0), F.lit(50.0), F.lit(100.0), 0.01).alias(c)
        for c in ("rules", "names", "deep", "plain")
    ]
    first, second = table.select("id", *out).orderBy("id").collect()
    assert [tuple(r) for r in first.rules] == [("all", None), ("part", [0.2, 0.6]), ("open", None)]
    assert tuple(first.names) == ("n", {"en": "x"}, None)
    (kept,) = first.deep
    assert kept["between"] == [0.0, 0.5] and [tuple(p) for p in kept.parts] == [(2, [0.5, 1.0]), (3, [0.0, 0.4])]
    assert kept.tags == ["t"] and first.plain == "p"
    assert (second.rules, second.names, second.deep, second.plain) == (None, None, None, None)
