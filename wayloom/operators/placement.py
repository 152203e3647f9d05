"""Find where a line gets cut: at its connectors and at its linear references.

Split points of a line form ``array<POINT>`` in the order they were found, which matters:
a new point may not have the coordinates of the one found just before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.functions.binding import bind, halvings, indices, leading, let, number_text, pick, stretch
from wayloom.functions.geodesy import distance, point_on_edge
from wayloom.functions.lines import differs, is_line, running_metres

POINT = "struct<id:string,x:double,y:double,lr:double,metres:double,vertex:int,is_added:boolean>"

# A connector this close to an edge, in metres, lies on it; edge ends are
# compared with the metres of a reference rounded to six digits.
ON_EDGE_M = 0.001
EDGE_END_M = 5e-7
#: Lists up to this length are looked through, longer ones searched by halving: most lines are short.
SHORT = 16


def _point(id_: Column, at: Column, lr: Column, metres: Column, vertex: Column, added: bool) -> Column:
    return F.struct(
        id_.cast("string").alias("id"),
        at.x.alias("x"),
        at.y.alias("y"),
        lr.cast("double").alias("lr"),
        metres.cast("double").alias("metres"),
        vertex.cast("int").alias("vertex"),
        F.lit(added).alias("is_added"),
    )


def _no_points() -> Column:
    return F.array().cast(f"array<{POINT}>")


def measure(lines: DataFrame) -> DataFrame:
    """Add ``_at``, the metres from the start at each vertex, and ``_total``; null if no line."""
    geometry = F.col("geometry")
    df = bind(lines, _at=F.when(is_line(geometry), running_metres(geometry)))
    return df.withColumn("_total", F.element_at("_at", -1))


def place_connectors(measured: DataFrame) -> DataFrame:
    """Add ``_placed`` (array<POINT>), ``_sought`` and ``_unplaced`` (how many were left over).

    The last connector belongs to the last vertex if it equals it. Any other belongs to the
    first vertex it equals; what equals none is looked for on the edges, in list order and
    never going back.
    """
    coords, at, total = F.col("geometry"), F.col("_at"), F.col("_total")
    usable = F.filter(
        F.coalesce(F.col("joined_connectors"), F.array()), lambda c: c.connector_geometry.isNotNull()
    )
    df = bind(measured, _usable=F.when(at.isNotNull(), F.sort_array(usable)))
    final = F.element_at(coords, F.size(coords))
    ends_line = let(
        F.try_element_at(F.col("_usable"), F.lit(-1)),
        lambda c: F.coalesce(~differs(c.connector_geometry, final), F.lit(False)),
    )
    df = bind(df, _ends=F.when(at.isNotNull(), ends_line))
    rest = F.when(F.col("_ends"), stretch(F.col("_usable"), F.lit(0), F.size("_usable") - 1)).otherwise(
        F.col("_usable")
    )
    matched = F.transform(
        rest,
        lambda c: F.struct(
            (F.array_position(coords, c.connector_geometry) - 1).cast("int").alias("vertex"), c.alias("c")
        ),
    )
    df = bind(df, _matched=matched)

    def on_vertex(m: Column) -> Column:
        metres = pick(at, m.vertex)
        return _point(m.c.connector_id, m.c.connector_geometry, F.try_divide(metres, total), metres, m.vertex, False)

    end = F.transform(
        F.filter(F.array(F.try_element_at(F.col("_usable"), F.lit(-1))), lambda _: F.col("_ends")),
        lambda c: _point(
            c.connector_id, c.connector_geometry, F.lit(1.0), total, F.size(coords) - 1, False
        ),
    )
    exact = F.transform(F.sort_array(F.filter("_matched", lambda m: m.vertex >= 0)), on_vertex)
    left_over = F.transform(F.filter("_matched", lambda m: m.vertex < 0), lambda m: m.c)
    df = bind(
        df,
        _sought=F.size("_matched"),
        _exact=F.concat(end, exact),
        _walk=_walk_edges(left_over, coords, at, total),
    )
    placed = F.when(at.isNotNull(), F.concat("_exact", "_walk.points"))
    return bind(df, _placed=placed, _unplaced=F.col("_walk.lost")).drop(
        "_usable", "_ends", "_matched", "_exact", "_walk"
    )


def _walk_edges(left_over: Column, coords: Column, at: Column, total: Column) -> Column:
    def triangle(c: Column, j: Column) -> Column:
        """Metres from both ends of an edge to a connector, and along the edge."""
        legs = F.array(
            F.struct(*_leg(pick(coords, j), c.connector_geometry)),
            F.struct(*_leg(pick(coords, j + 1), c.connector_geometry)),
            F.struct(*_leg(pick(coords, j), pick(coords, j + 1))),
        )
        return F.transform(legs, lambda s: distance(s.x1, s.y1, s.x2, s.y2))

    def hit(c: Column, j: Column) -> Column:
        metres = triangle(c, j)
        return let(
            metres,
            lambda d: F.when(
                F.abs(pick(d, 0) + pick(d, 1) - pick(d, 2)) < ON_EDGE_M,
                F.struct(
                    j.alias("edge"),
                    (pick(at, j) + pick(d, 0)).alias("metres"),
                    F.when(pick(d, 0) == pick(d, 2), j + 1).otherwise(j).alias("vertex"),
                ),
            ),
        )

    def place(acc: Column, c: Column, h: Column) -> Column:
        point = _point(c.connector_id, c.connector_geometry, F.try_divide(h.metres, total), h.metres, h.vertex, False)
        return _progress(h.edge, acc.lost, F.array_append(acc.points, point))

    def near(c: Column, j: Column) -> Column:
        return let(
            F.struct(pick(coords, j).alias("a"), pick(coords, j + 1).alias("b"), (pick(at, j + 1) - pick(at, j)).alias("m")),
            lambda e: _may_lie_on(c.connector_geometry, e.a, e.b, e.m),
        )

    def seek(acc: Column, c: Column) -> Column:
        # Once one is lost, the ones behind it are lost as well. Distances are for edges near the connector only.
        edges = F.transform(indices(F.size(coords) - 1 - acc.edge), lambda k: acc.edge + k)
        ahead = F.when(
            acc.lost == 0,
            F.filter(F.transform(F.filter(edges, lambda j: near(c, j)), lambda j: hit(c, j)), lambda h: h.isNotNull()),
        )
        return let(
            pick(ahead, 0),
            lambda h: F.when(h.isNull(), _progress(acc.edge, acc.lost + 1, acc.points)).otherwise(place(acc, c, h)),
        )

    return F.aggregate(left_over, _progress(F.lit(0), F.lit(0), _no_points()), seek)


def _may_lie_on(p: Column, a: Column, b: Column, metres: Column) -> Column:
    """False only for points that are surely not on an edge, by its box and the room around it.

    The legs from both ends to a point on the edge exceed it by less than ON_EDGE_M, so the point is within
    sqrt(ON_EDGE_M * metres / 2) of the straight edge, and that leaves its box by less than metres^2 * tan(lat)
    / 5e7. Edges above 1 km, near a pole or across the date line always may.
    """
    lat = F.greatest(F.abs(a.y), F.abs(b.y))
    room = F.sqrt(ON_EDGE_M * metres) + 2 * ON_EDGE_M + metres * metres * F.tan(F.radians(lat)) / 5e7
    up = room / 110_000.0
    aside = up / F.cos(F.radians(lat))
    within = (
        (p.x >= F.least(a.x, b.x) - aside)
        & (p.x <= F.greatest(a.x, b.x) + aside)
        & (p.y >= F.least(a.y, b.y) - up)
        & (p.y <= F.greatest(a.y, b.y) + up)
    )
    return (metres > 1_000.0) | (lat > 85.0) | (F.abs(a.x - b.x) > 180.0) | within


def _leg(a: Column, b: Column) -> list[Column]:
    return [a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")]


def _progress(edge: Column, lost: Column, points: Column) -> Column:
    return F.struct(edge.alias("edge"), lost.alias("lost"), points.alias("points"))


def keep_outermost(placed: DataFrame) -> DataFrame:
    """For cutting at references only: first and last connector along the line."""
    ordered = in_line_order(F.col("_all"))
    ends = let(
        ordered,
        lambda p: F.when(F.size(p) > 0, F.array(pick(p, 0), pick(p, F.size(p) - 1))).otherwise(p),
    )
    return bind(placed.withColumnRenamed("_placed", "_all"), _placed=F.when(F.col("_all").isNotNull(), ends)).drop("_all")


def in_line_order(points: Column) -> Column:
    """Sort points along the line, those at the same position in the order they were found."""
    numbered = F.transform(points, lambda p, i: F.struct(p.lr.alias("lr"), i.alias("i"), p.alias("p")))
    return F.transform(F.sort_array(numbered), lambda n: n.p)


def locate(lr: Column, coords: Column, at: Column, total: Column, precision: int, steps: Column | None = None) -> Column:
    """``struct(vertex, x, y)``: rounded point at a fraction of the line, and the vertex before it.

    The edge is found by halving; ``steps`` are the halvings of the number of edges, if they are at hand.
    """
    target = lr * total
    steps = halvings(F.size(at) - 1) if steps is None else steps
    scanned = F.size(F.filter(at, lambda m, i: (i > 0) & (target - m > EDGE_END_M)))
    searched = leading(steps, lambda i: target - pick(at, i + 1) > EDGE_END_M)
    passed = F.when(F.size(at) <= SHORT, scanned).otherwise(searched)
    edge = F.least(passed, F.size(coords) - 2)

    def on_edge(j: Column) -> Column:
        legs = F.struct(
            *_leg(pick(coords, j), pick(coords, j + 1)),
            (pick(at, j + 1) - pick(at, j)).alias("m"),
            (target - pick(at, j)).alias("into"),
        )
        return let(
            let(legs, lambda e: point_on_edge(e.x1, e.y1, e.x2, e.y2, e.m, F.least(e.into, e.m))),
            lambda p: F.struct(
                j.alias("vertex"), F.round(p.x, precision).alias("x"), F.round(p.y, precision).alias("y")
            ),
        )

    return let(edge, on_edge)


def lr_text(lr: Column) -> Column:
    """Position text in the id of an added point; the line's own ends are whole numbers."""
    return F.when(lr == 0, "0").when(lr == 1, "1").otherwise(number_text(lr))


def place_lr_values(placed: DataFrame, values: Column, precision: int, min_dist_m: float) -> DataFrame:
    """Add ``_points``: the placed connectors followed by points for linear references.

    References come in ascending order. One gets a point only if it is farther than the
    minimum from all connectors and from the reference added before it, and if its rounded
    point differs from the point found last.
    """
    coords, at, total = F.col("geometry"), F.col("_at"), F.col("_total")
    existing = F.col("_placed")

    def add(acc: Column, lr: Column) -> Column:
        # Of the connectors' positions only the ones on either side of the value can be the nearest.
        below = leading(F.col("_near_steps"), lambda i: pick(F.col("_near"), i) < lr)
        searched = let(below, lambda k: F.least(F.abs(pick(F.col("_near"), k) - lr), F.abs(pick(F.col("_near"), k - 1) - lr)))
        scanned = F.array_min(F.transform("_near", lambda at_lr: F.abs(at_lr - lr)))
        nearest = F.least(F.when(F.size("_near") <= SHORT, scanned).otherwise(searched), F.abs(lr - acc.lr))
        too_close = F.coalesce(nearest * total <= min_dist_m, F.lit(False))
        return F.when(too_close, acc).otherwise(
            let(locate(lr, coords, at, total, precision, F.col("_at_steps")), lambda p: append(acc, lr, p))
        )

    def append(acc: Column, lr: Column, p: Column) -> Column:
        point = _point(F.concat(F.col("id"), F.lit("@"), lr_text(lr)), p, lr, lr * total, p.vertex, True)
        return F.when(F.coalesce(differs(acc, p), F.lit(True)), _fold(lr, p.x, p.y, F.array_append(acc.points, point))).otherwise(acc)

    last = pick(existing, F.size(existing) - 1)
    start = _fold(F.lit(None).cast("double"), last.x, last.y, _no_points())
    near = F.array_sort(F.filter(F.transform(existing, lambda p: p.lr), lambda lr: lr.isNotNull()))
    df = bind(placed, _lrs=F.when(at.isNotNull(), values), _near=near, _at_steps=halvings(F.size(at) - 1))
    df = bind(df, _near_steps=halvings(F.size("_near")))
    added = F.aggregate("_lrs", start, add, lambda acc: acc.points)
    points = F.when(at.isNotNull(), F.concat(existing, added))
    return bind(df, _points=points).drop("_lrs", "_near", "_near_steps", "_at_steps")


def _fold(lr: Column, x: Column, y: Column, points: Column) -> Column:
    return F.struct(lr.alias("lr"), x.alias("x"), y.alias("y"), points.alias("points"))
