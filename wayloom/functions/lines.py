"""Columns over a line held as ``array<struct<x: double, y: double>>``.

A line is one value of one row, so these never shuffle. Work inside a row stays near-linear
in the number of vertices: long lines go through blocks of about the square root of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayloom.functions.binding import indices, let, pick, stretch
from wayloom.functions.geodesy import distance

COORDS = "array<struct<x:double,y:double>>"
MIN_BLOCK = 32

# Names of the length classes, with inclusive upper bounds in metres.
LENGTH_BUCKETS = (
    (0.01, "A. <=1cm"),
    (0.1, "B. 1cm-10cm"),
    (1, "C. 10cm-1m"),
    (100, "D. 1m-100m"),
    (1000, "E. 100m-1km"),
    (10000, "F. 1km-10km"),
)
LONGEST_BUCKET = "G. >10km"


def is_line(coords: Column) -> Column:
    return F.coalesce(F.size(coords) >= 2, F.lit(False))


def differs(a: Column, b: Column) -> Column:
    """Exact difference of two coordinates."""
    return (a.x != b.x) | (a.y != b.y)


def edge_metres(coords: Column) -> Column:
    """Length of every edge of a line."""
    return let(
        coords,
        lambda c: F.zip_with(
            stretch(c, F.lit(0), F.size(c) - 1),
            stretch(c, F.lit(1), F.size(c) - 1),
            lambda a, b: distance(a.x, a.y, b.x, b.y),
        ),
    )


def line_metres(coords: Column) -> Column:
    return F.aggregate(edge_metres(coords), F.lit(0.0), lambda total, m: total + m)


def running_metres(coords: Column) -> Column:
    """Metres from the start of the line to each of its vertices."""
    return let(edge_metres(coords), running_totals)


def running_totals(values: Column) -> Column:
    """0 and every partial sum, added in order."""
    # Appending to an array copies it; blocks keep the copies short on long lines. Short ones are one block.
    block = F.greatest(F.lit(MIN_BLOCK), F.ceil(F.sqrt(F.size(values))).cast("int"))
    blocks = let(
        block,
        lambda b: F.transform(
            indices(F.ceil(F.size(values) / b).cast("int")), lambda k: stretch(values, k * b, b)
        ),
    )
    nothing = F.array().cast("array<double>")

    def add(acc: Column, m: Column) -> Column:
        return let(
            acc.total + m,
            lambda t: F.struct(t.alias("total"), F.array_append(acc.out, t).alias("out")),
        )

    def add_block(acc: Column, values_of_block: Column) -> Column:
        within = F.aggregate(
            values_of_block, F.struct(acc.total.alias("total"), nothing.alias("out")), add
        )
        return let(
            within,
            lambda w: F.struct(w.total.alias("total"), F.array_append(acc.blocks, w.out).alias("blocks")),
        )

    start = F.struct(F.lit(0.0).alias("total"), F.array().cast("array<array<double>>").alias("blocks"))
    one = F.aggregate(values, F.struct(F.lit(0.0).alias("total"), F.array(F.lit(0.0)).alias("out")), add, lambda acc: acc.out)
    several = F.concat(F.array(F.lit(0.0)), F.flatten(F.aggregate(blocks, start, add_block).blocks))
    return F.when(F.size(values) <= MIN_BLOCK, one).otherwise(several)


def without_repeats(coords: Column) -> Column:
    """Drop vertices equal to the one before them."""
    return let(
        coords,
        lambda c: F.filter(c, lambda p, i: (i == 0) | differs(p, pick(c, i - 1))),
    )


def has_repeats(coords: Column) -> Column:
    return let(
        coords,
        lambda c: F.exists(
            indices(F.size(c) - 1), lambda i: ~differs(pick(c, i), pick(c, i + 1))
        ),
    )


def length_bucket(metres: Column) -> Column:
    label = F.lit(LONGEST_BUCKET)
    for bound, name in reversed(LENGTH_BUCKETS):
        label = F.when(metres <= bound, name).otherwise(label)
    return label


def _side(a: Column, b: Column, p: Column) -> Column:
    return F.signum((b.x - a.x) * (p.y - a.y) - (b.y - a.y) * (p.x - a.x))


def boxes_meet(a: Column, b: Column, c: Column, d: Column) -> Column:
    return (
        (F.greatest(a.x, b.x) >= F.least(c.x, d.x))
        & (F.greatest(c.x, d.x) >= F.least(a.x, b.x))
        & (F.greatest(a.y, b.y) >= F.least(c.y, d.y))
        & (F.greatest(c.y, d.y) >= F.least(a.y, b.y))
    )


def edges_meet(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Edges a-b and c-d share at least one point."""
    return (
        boxes_meet(a, b, c, d)
        & (_side(a, b, c) * _side(a, b, d) <= 0)
        & (_side(c, d, a) * _side(c, d, b) <= 0)
    )


def _doubles_back(shared: Column, a: Column, b: Column) -> Column:
    """Edges shared-a and shared-b cover common ground next to the shared vertex."""
    return (_side(shared, a, b) == 0) & (
        (a.x - shared.x) * (b.x - shared.x) + (a.y - shared.y) * (b.y - shared.y) > 0
    )


def is_self_intersecting(coords: Column) -> Column:
    """The line passes twice through a point other than its closing one.

    Edges are grouped into blocks with a bounding box; only edges of blocks whose boxes
    meet get compared.
    """

    def test(c: Column) -> Column:
        edges = F.size(c) - 1
        block = F.greatest(F.lit(MIN_BLOCK), F.ceil(F.sqrt(edges)).cast("int"))
        return (
            F.when(edges < 2, F.lit(False))
            .when(edges <= MIN_BLOCK, _any_of_few(c, edges))
            .otherwise(let(block, lambda b: let(_blocks(c, edges, b), lambda bs: _any_pair(c, edges, bs))))
        )

    return F.when(F.size(coords) > 2, let(without_repeats(coords), test)).otherwise(F.lit(False))


def _blocks(c: Column, edges: Column, size: Column) -> Column:
    def box(k: Column) -> Column:
        return let(
            stretch(c, k * size, size + 1),
            lambda part: F.struct(
                (k * size).alias("first"),
                F.least(size, edges - k * size).alias("count"),
                F.array_min(F.transform(part, lambda p: p.x)).alias("x1"),
                F.array_max(F.transform(part, lambda p: p.x)).alias("x2"),
                F.array_min(F.transform(part, lambda p: p.y)).alias("y1"),
                F.array_max(F.transform(part, lambda p: p.y)).alias("y2"),
            ),
        )

    return F.transform(indices(F.ceil(edges / size).cast("int")), box)


def _pair_bad(c: Column, edges: Column, i: Column, j: Column) -> Column:
    a, b, p, q = pick(c, i), pick(c, i + 1), pick(c, j), pick(c, j + 1)
    closing = (i == 0) & (j == edges - 1) & ~differs(pick(c, 0), pick(c, edges))
    return (
        F.when(j == i + 1, _doubles_back(b, a, q))
        .when(~boxes_meet(a, b, p, q), F.lit(False))
        .when(closing, _doubles_back(a, b, p))
        .otherwise(edges_meet(a, b, p, q))
    )


def _any_of_few(c: Column, edges: Column) -> Column:
    """Each edge with all behind it."""
    return F.exists(
        indices(edges - 1),
        lambda i: F.exists(indices(edges - 1 - i), lambda k: _pair_bad(c, edges, i, i + 1 + k)),
    )


def _any_pair(c: Column, edges: Column, blocks: Column) -> Column:
    def edge_bad(i: Column, other: Column) -> Column:
        return F.exists(indices(other["count"]), lambda k: (other["first"] + k > i) & _pair_bad(c, edges, i, other["first"] + k))

    def blocks_bad(one: Column, other: Column) -> Column:
        meet = (
            (one["first"] <= other["first"])
            & (one.x2 >= other.x1)
            & (other.x2 >= one.x1)
            & (one.y2 >= other.y1)
            & (other.y2 >= one.y1)
        )
        return meet & F.exists(indices(one["count"]), lambda k: edge_bad(one["first"] + k, other))

    return F.exists(blocks, lambda one: F.exists(blocks, lambda other: blocks_bad(one, other)))
