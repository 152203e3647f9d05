
from __future__ import annotations

import hashlib
import importlib.util
import math
import tempfile
import uuid
from collections.abc import Callable
from itertools import pairwise
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oracles import OUTERMOST, assemble, metres
from wayloom.functions import lineref, lines
from wayloom.functions.binding import bind, pick
from wayloom.functions.polygon import polygon_rings
from wayloom.operators import areas, cutting, filters, layout, network, placement, references, reports
from wayloom.plans import derived, splitter
from wayloom.plans.config import SplitConfig
from wayloom.sources import catalog, manifests
from wayloom.sources.feature_io import (
    FeatureIO,
    Stage,
    read_features,
    read_parquet,
    spread_scan,
    write_features,
    write_parquet,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_OWN_SCRATCH: dict[str, str] = {}


def query(name: str, sql: str | None = None, **parts: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            ORACLES[name] = assemble(sql, **parts)
        return run

    return register


# ---------------------------------------------------------------- stored stages


def scratch(spark: SparkSession, sf_dir: str) -> str:
    """Folder for stages, in the one the cluster shares; a local session gets its own."""
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _OWN_SCRATCH.setdefault(app, tempfile.mkdtemp(prefix="wayloom-"))
    return f"{base.rstrip('/')}/{app}/{hashlib.sha1(sf_dir.encode()).hexdigest()[:12]}"


def stage(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A step that many queries start from, computed once per session and read back."""
    return read_parquet(spark, manifests.location(spark, _stage(spark, sf_dir, name, make)))


def _stage(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> str:
    path = f"{scratch(spark, sf_dir)}/{name}"
    if not manifests.is_whole(spark, manifests.current(spark, path)):

        def fill(folder: str) -> None:
            df = make()
            with spread_scan(df):
                write_parquet(df, folder)

        manifests.add_version(spark, path, fill)
    return path


def stored_features(spark: SparkSession, sf_dir: str) -> str:
    """Path of the features as a user stores them, with binary geometry."""
    path = f"{scratch(spark, sf_dir)}/stored"
    if not manifests.is_whole(spark, manifests.current(spark, path)):
        manifests.add_version(spark, path, lambda folder: write_features(features(spark, sf_dir), folder))
    return manifests.location(spark, path)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "features", lambda: derived.features(spark, sf_dir, references=True))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.segments(features(spark, sf_dir))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "joined", lambda: network.join_connectors(features(spark, sf_dir)))


def chosen(spark: SparkSession, sf_dir: str) -> list[str]:
    return splitter.lr_columns(features(spark, sf_dir))


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(
        spark, sf_dir, "split", lambda: cutting.split_segments(joined(spark, sf_dir), chosen(spark, sf_dir))
    )


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(
        spark,
        sf_dir,
        "pieces",
        lambda: references.mark_referring(cutting.explode_pieces(split(spark, sf_dir), chosen(spark, sf_dir))),
    )


def final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(
        spark,
        sf_dir,
        "final",
        lambda: splitter.assemble(features(spark, sf_dir), pieces(spark, sf_dir), split(spark, sf_dir)),
    )


def whole(column: str | Column, name: str | None = None) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("long").alias(name or column)


def rounded(column: str | Column, digits: int, name: str | None = None) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, digits).alias(name or column)


def xy(point: Column) -> list[Column]:
    return [rounded(point.x, 7, "x"), rounded(point.y, 7, "y")]


# ---------------------------------------------------------------- sources


@query("io1_parquet_scan", "SELECT s_suppkey, s_name FROM supplier")
def _(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")


@query(
    "io4_stored_features",
    """SELECT seg::VARCHAR AS id, idx, round(x, 7) AS x, round(y, 7) AS y FROM vv UNION ALL
    SELECT cid, 0, round(x, 7), round(y, 7) FROM con""",
)
def _(spark, sf_dir):
    stored = read_features(spark, stored_features(spark, sf_dir))
    return network.vertices(stored).select("id", whole("idx"), rounded("x", 7), rounded("y", 7))


@query(
    "io11_published_table",
    """SELECT 'segment' AS type, count(*) AS count FROM piece UNION ALL SELECT 'connector',
    (SELECT count(*) FROM con) + (SELECT count(*) FROM added WHERE seg NOT IN (SELECT seg FROM fail))""",
)
def _(spark, sf_dir):
    result = final(spark, sf_dir)
    spark.sql("DROP TABLE IF EXISTS wayloom_split")
    catalog.publish(spark, "wayloom_split", manifests.location(spark, f"{scratch(spark, sf_dir)}/final"), result.schema)
    return reports.type_counts(spark.table("wayloom_split"))


@query("io11_bucketed_join", "SELECT seg::VARCHAR AS id, count(*) AS pieces, max(n) AS vertices FROM piece JOIN net USING (seg) GROUP BY seg")
def _(spark, sf_dir):
    location = f"{scratch(spark, sf_dir)}/bucketed-{uuid.uuid4().hex}"
    lines = segments(spark, sf_dir).select("id", F.size("geometry").alias("vertices"))
    split_up = network.segments(final(spark, sf_dir)).select("id", "start_lr", "end_lr")
    for name, table in (("wayloom_lines", lines), ("wayloom_pieces", split_up)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        catalog.publish_bucketed(table, name, f"{location}/{name}", buckets=8)
    met = spark.table("wayloom_pieces").join(spark.table("wayloom_lines").hint("merge"), "id")
    return met.groupBy("id").agg(F.count("*").alias("pieces"), whole(F.max("vertices"), "vertices"))


# ---------------------------------------------------------------- filters

POLYGON = (
    "POLYGON ((-121.9985 47.0003, -121.9955 47.0008, -121.9960 47.0021, -121.9990 47.0017, -121.9985 47.0003))"
)


def _polygon_edges(wkt: str = POLYGON) -> str:
    ring = polygon_rings(wkt)[0]
    rows = ", ".join(f"({a[0]!r}e0, {a[1]!r}e0, {b[0]!r}e0, {b[1]!r}e0)" for a, b in zip(ring, ring[1:]))
    return f"SELECT * FROM (VALUES {rows}) AS p(cx, cy, dx, dy)"


MEETS_POLYGON = """SELECT DISTINCT id FROM (
        SELECT id, idx FROM allv, poly WHERE (cy > y) <> (dy > y) AND x < cx + (y - cy) * (dx - cx) / (dy - cy)
        GROUP BY id, idx HAVING count(*) % 2 = 1
        UNION ALL SELECT id, idx FROM alle, poly WHERE greatest(x, x2) >= least(cx, dx) AND greatest(cx, dx) >= least(x, x2)
            AND greatest(y, y2) >= least(cy, dy) AND greatest(cy, dy) >= least(y, y2)
            AND sign((x2 - x) * (cy - y) - (y2 - y) * (cx - x)) * sign((x2 - x) * (dy - y) - (y2 - y) * (dx - x)) <= 0
            AND sign((dx - cx) * (y - cy) - (dy - cy) * (x - cx)) * sign((dx - cx) * (y2 - cy) - (dy - cy) * (x2 - cx)) <= 0)"""
MEETS_PARTS = {
    "poly": _polygon_edges(),
    "allv": "SELECT seg::VARCHAR AS id, idx, x, y FROM vv UNION ALL SELECT cid, 0, x, y FROM con",
    "alle": """SELECT seg::VARCHAR AS id, idx, x, y, x2, y2 FROM em UNION ALL SELECT cid, 0, x, y, x, y FROM con""",
}


@query("f1_spatial_filter", MEETS_POLYGON, **MEETS_PARTS)
def _(spark, sf_dir):
    return filters.spatial_filter(features(spark, sf_dir), POLYGON).select("id")


def _star(spikes: int) -> str:
    """A ring that goes in and out around the network's middle."""
    points = []
    for i in range(2 * spikes):
        turn, reach = math.pi * i / spikes, 1.0 if i % 2 else 0.55
        points.append(f"{-121.9957 + 0.0035 * reach * math.cos(turn):.9f} {47.00151 + 0.0013 * reach * math.sin(turn):.9f}")
    return f"POLYGON (({', '.join([*points, points[0]])}))"


@query("f1_indexed_polygon", MEETS_POLYGON, **MEETS_PARTS | {"poly": _polygon_edges(_star(250))})
def _(spark, sf_dir):
    return filters.spatial_filter(features(spark, sf_dir), _star(250)).select("id")


def _diamond(node: str, reach: str) -> list[tuple[str, str]]:
    """Corners around a supplier's place, as pairs of x and y that Spark and SQL compute alike."""
    x, y = f"(-122e0 + ({node} % 100) * 9e-5)", f"(47e0 + ({node} % 31) * 1e-4)"
    corners = ((f"{x} - {reach}", f"{y} - 1.1e-5"), (f"{x} + 1.3e-5", f"{y} - {reach}"), (f"{x} + {reach}", f"{y} + 1.7e-5"))
    corners += ((f"{x} - 1.9e-5", f"{y} + {reach}"),)
    return [*corners, corners[0]]


_REACH = "((1 + s_suppkey % 3) * 4.3e-5)"


@query(
    "f1_polygon_table",
    "SELECT DISTINCT id, polygon_id FROM (" + MEETS_POLYGON.removeprefix("SELECT DISTINCT id FROM (")
    .replace("SELECT id, idx FROM allv", "SELECT id, idx, polygon_id FROM allv")
    .replace("GROUP BY id, idx", "GROUP BY id, idx, polygon_id")
    .replace("SELECT id, idx FROM alle", "SELECT id, idx, polygon_id FROM alle"),
    **MEETS_PARTS | {"poly": " UNION ALL ".join(
        f"SELECT s_suppkey AS polygon_id, {a[0]} AS cx, {a[1]} AS cy, {b[0]} AS dx, {b[1]} AS dy FROM supplier"
        for a, b in pairwise(_diamond("s_suppkey", _REACH))
    )},
)
def _(spark, sf_dir):
    corners = ", ".join(f"struct({x} AS x, {y} AS y)" for x, y in _diamond("s_suppkey", _REACH))
    diamonds = read_parquet(spark, f"{sf_dir}/supplier.parquet").selectExpr("s_suppkey AS polygon_id", f"array(array({corners})) AS rings")
    # Blocks of some ten metres: these polygons are small.
    return areas.meeting_polygons(features(spark, sf_dir), diamonds, finest=13).select("id", whole("polygon_id"))


@query("f1_boxed_filter", MEETS_POLYGON, **MEETS_PARTS)
def _(spark, sf_dir):
    def bound(pick_one, axis):
        return pick_one(F.transform("geometry", lambda p: p[axis])).cast("float")

    def boxed() -> DataFrame:
        sides = (("xmin", F.array_min, "x"), ("xmax", F.array_max, "x"), ("ymin", F.array_min, "y"), ("ymax", F.array_max, "y"))
        box = F.struct(*(bound(one, axis).alias(name) for name, one, axis in sides))
        return features(spark, sf_dir).withColumn("bbox", box)

    return filters.spatial_filter(stage(spark, sf_dir, "boxed", boxed), POLYGON).select("id")


@query(
    "f3_within_box",
    """SELECT id FROM (SELECT seg::VARCHAR AS id, x, y FROM vv UNION ALL SELECT cid, x, y FROM con) GROUP BY id
    HAVING min(x) >= -121.998 AND min(y) >= 47.0004 AND max(x) <= -121.993 AND max(y) <= 47.0026""",
)
def _(spark, sf_dir):
    def bound(pick_one, axis):
        return pick_one(F.transform("geometry", lambda p: p[axis]))

    box = F.struct(
        bound(F.array_min, "x").alias("xmin"),
        bound(F.array_max, "x").alias("xmax"),
        bound(F.array_min, "y").alias("ymin"),
        bound(F.array_max, "y").alias("ymax"),
    )
    boxed = features(spark, sf_dir).select("id", box.alias("bbox"))
    return boxed.filter(filters.within_box(-121.998, 47.0004, -121.993, 47.0026)).select("id")


@query("f4_connector_rows", "SELECT cid AS id, round(x, 7) AS x, round(y, 7) AS y FROM con")
def _(spark, sf_dir):
    return network.connectors(features(spark, sf_dir)).select("id", *xy(pick(F.col("geometry"), 0)))


@query(
    "f8_errors",
    "SELECT fail.seg::VARCHAR AS id, reason AS error_message, round(total, 3) AS length FROM fail JOIN tot USING (seg)",
)
def _(spark, sf_dir):
    failed = reports.errors(split(spark, sf_dir))
    return failed.select("id", "error_message", rounded("length_before_split", 3, "length"))


@query(
    "p4_failure_rules",
    """SELECT reason AS error_message, count(*) AS segments FROM (SELECT net.seg, CASE
        WHEN net.seg % 11 = 1 THEN 'geometry is not a line'
        WHEN net.seg % 11 = 5 THEN 'connector is not on the line'
        WHEN net.seg % 11 = 3 THEN CASE WHEN net.seg IN (SELECT seg FROM lrv) THEN 'connector list or position is missing'
            ELSE 'fewer than two split points' END
        WHEN reason LIKE 'fewer%' THEN reason
        WHEN net.seg % 11 = 4 THEN 'connector list or position is missing'
        WHEN net.seg % 11 = 2 AND net.seg IN (SELECT seg FROM rules) THEN 'linear reference is not a pair'
        ELSE coalesce(reason, '') END AS reason FROM net LEFT JOIN fail USING (seg)) GROUP BY reason""",
)
def _(spark, sf_dir):
    base = joined(spark, sf_dir)
    fault = F.col("id").cast("long") % 11
    astray = F.struct(
        F.lit(-1).alias("connector_index"),
        F.lit("astray").alias("connector_id"),
        F.struct(F.lit(-100.0).alias("x"), F.lit(10.0).alias("y")).alias("connector_geometry"),
        F.lit(None).cast("double").alias("connector_at"),
    )
    triple = F.transform(
        "rules",
        lambda r: F.struct(r.value.alias("value"), F.array_append(r["between"], pick(r["between"], 1)).alias("between")),
    )
    unplaced = F.transform(
        "connectors", lambda c: F.struct(c.connector_id.alias("connector_id"), F.lit(None).cast("double").alias("at"))
    )
    faulty = (
        base.withColumn("geometry", F.when(fault == 1, F.slice("geometry", 1, 1)).otherwise(F.col("geometry")))
        .withColumn("rules", F.when(fault == 2, triple).otherwise(F.col("rules")))
        .withColumn("connectors", F.when(fault == 4, unplaced).when(fault != 3, F.col("connectors")))
        .withColumn(
            "joined_connectors",
            F.when(fault == 5, F.concat(F.array(astray), "joined_connectors")).when(fault != 3, F.col("joined_connectors")),
        )
    )
    result = cutting.split_segments(faulty, chosen(spark, sf_dir))
    return result.groupBy("error_message").agg(F.count(F.lit(1)).alias("segments"))


# ---------------------------------------------------------------- network


@query(
    "w1_next_vertex",
    """SELECT seg::VARCHAR AS id, idx, round(x, 7) AS x, round(y, 7) AS y, round(x2, 7) AS x2, round(y2, 7) AS y2 FROM em""",
)
def _(spark, sf_dir):
    edges = network.edges(segments(spark, sf_dir))
    return edges.select("id", whole("idx"), *[rounded(c, 7) for c in ("x", "y", "x2", "y2")])


@query("g1_edge_metres", "SELECT seg::VARCHAR AS id, idx, round(m, 3) AS metres FROM em")
def _(spark, sf_dir):
    return network.edges(segments(spark, sf_dir)).select("id", whole("idx"), rounded("metres", 3))


@query(
    "w2_running_metres",
    "SELECT seg::VARCHAR AS id, idx, round(at_m, 3) AS start_m FROM run WHERE idx < last_idx",
)
def _(spark, sf_dir):
    return network.edges(segments(spark, sf_dir)).select("id", whole("idx"), rounded("start_m", 3))


@query("a10_line_metres", "SELECT seg::VARCHAR AS id, round(total, 3) AS metres FROM tot")
def _(spark, sf_dir):
    return segments(spark, sf_dir).select("id", rounded(lines.line_metres(F.col("geometry")), 3, "metres"))


@query(
    "w3_without_repeats",
    "SELECT seg::VARCHAR AS id, i AS idx, round(x, 7) AS x, round(y, 7) AS y FROM dv",
)
def _(spark, sf_dir):
    clean = segments(spark, sf_dir).select("id", lines.without_repeats(F.col("geometry")).alias("geometry"))
    return network.vertices(clean).select("id", whole("idx"), rounded("x", 7), rounded("y", 7))


@query(
    "j1_locate_pairs",
    """SELECT seg::VARCHAR AS segment_id, ci AS connector_index, cid AS connector_id, round(x, 7) AS x, round(y, 7) AS y,
    round(spot, 6) AS connector_at FROM loc""",
)
def _(spark, sf_dir):
    table = features(spark, sf_dir)
    located = network.locate_pairs(network.connector_pairs(table), network.connector_positions(table))
    return located.select(
        "segment_id", whole("connector_index"), "connector_id", *xy(F.col("connector_geometry")), rounded("connector_at", 6)
    )


@query(
    "a1_gather_connectors",
    """SELECT seg::VARCHAR AS segment_id, count(*) AS connectors, count(x) AS located, arg_min(cid, ci) AS first,
    arg_max(cid, ci) AS last FROM loc GROUP BY seg""",
)
def _(spark, sf_dir):
    table = features(spark, sf_dir)
    located = network.locate_pairs(network.connector_pairs(table), network.connector_positions(table))
    entries = F.col("joined_connectors")
    return network.gather_pairs(located).select(
        "segment_id",
        whole(F.size(entries), "connectors"),
        whole(F.size(F.filter(entries, lambda c: c.connector_geometry.isNotNull())), "located"),
        pick(entries, 0).connector_id.alias("first"),
        F.element_at(entries, -1).connector_id.alias("last"),
    )


@query(
    "j2_join_connectors",
    """SELECT net.seg::VARCHAR AS id, n AS vertices, count(loc.ci) AS connectors FROM net LEFT JOIN loc USING (seg)
    GROUP BY net.seg, n""",
)
def _(spark, sf_dir):
    table = network.join_connectors(features(spark, sf_dir))
    return table.select(
        "id", whole(F.size("geometry"), "vertices"), whole(F.coalesce(F.size("joined_connectors"), F.lit(0)), "connectors")
    )


def _attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.struct(
        F.col("o_orderstatus").alias("value"),
        F.array(F.lit(0.25), F.lit(0.75) + (F.col("o_orderkey") % 4) / 100.0).alias("between"),
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(F.col("o_orderkey").cast("string").alias("id"), F.array(part).alias("status"))


@query(
    "j11_attached_attributes",
    """SELECT seg::VARCHAR AS id, round(lr, 9) AS lr FROM (SELECT seg, lr FROM lrv UNION
    SELECT seg, unnest([0e0, 25e-2, 75e-2 + (o_orderkey % 4) / 100e0, 1e0]) FROM net JOIN orders ON o_orderkey = seg)""",
)
def _(spark, sf_dir):
    table = network.attach_attributes(segments(spark, sf_dir), _attributes(spark, sf_dir))
    typed = [(F.col(c), table.schema[c].dataType) for c in splitter.lr_columns(table)]
    return table.select("id", F.explode(lineref.all_split_values(typed)).alias("lr")).select("id", rounded("lr", 9))


# ---------------------------------------------------------------- split points


@query(
    "l1_column_split_values",
    """SELECT seg::VARCHAR AS id, round(lr, 9) AS lr FROM (SELECT seg, lo AS lr FROM rules UNION SELECT seg, hi FROM rules
    UNION SELECT DISTINCT seg, unnest([0e0, 1e0]) FROM rules)""",
)
def _(spark, sf_dir):
    table = segments(spark, sf_dir)
    values = lineref.split_values(F.col("rules"), table.schema["rules"].dataType)
    return table.select("id", F.explode(values).alias("lr")).select("id", rounded("lr", 9))


@query("l2_all_split_values", "SELECT seg::VARCHAR AS id, round(lr, 9) AS lr, k - 1 AS rank FROM cand0")
def _(spark, sf_dir):
    table = segments(spark, sf_dir)
    typed = [(F.col(c), table.schema[c].dataType) for c in splitter.lr_columns(table)]
    values = table.select("id", F.posexplode(lineref.all_split_values(typed)).alias("rank", "lr"))
    return values.select("id", rounded("lr", 9), whole("rank"))


@query(
    "c1_place_connectors",
    """SELECT seg::VARCHAR AS id, seq - 1 AS found, cid AS connector_id, round(lr, 6) AS lr, round(m, 3) AS metres, vertex
    FROM placed""",
)
def _(spark, sf_dir):
    placed = placement.place_connectors(placement.measure(joined(spark, sf_dir)))
    return placed.select("id", F.posexplode("_placed").alias("found", "p")).select(
        "id", whole("found"), F.col("p.id").alias("connector_id"), rounded("p.lr", 6, "lr"),
        rounded("p.metres", 3, "metres"), whole("p.vertex", "vertex"),
    )


@query(
    "c2_connectors_on_edges",
    """SELECT seg::VARCHAR AS id, CASE WHEN vx IS NULL THEN ev ELSE vx END AS vertex,
        round(CASE WHEN is_end THEN 1e0 WHEN vx IS NULL THEN em_m / total ELSE vx_m / total END, 6) AS lr FROM (
        SELECT c.seg, any_value(total) AS total, bool_or(r.idx = r.last_idx AND r.x = c.px AND r.y = c.py) AS is_end,
            CASE WHEN bool_or(r.idx = r.last_idx AND r.x = c.px AND r.y = c.py) THEN max(r.last_idx)
                ELSE min(r.idx) FILTER (WHERE r.x = c.px AND r.y = c.py) END AS vx,
            min(r.at_m) FILTER (WHERE r.x = c.px AND r.y = c.py) AS vx_m,
            min(h.idx) AS ev, arg_min(h.along, h.idx) AS em_m
        FROM mid c JOIN tot ON tot.seg = c.seg JOIN run r ON r.seg = c.seg LEFT JOIN hits h ON h.seg = c.seg AND h.idx = r.idx
        GROUP BY c.seg)""",
    mid="""SELECT em.seg, (x + x2) / 2e0 AS px, (y + y2) / 2e0 AS py FROM em JOIN net USING (seg) WHERE idx = (n - 1) // 2""",
    hits=f"""SELECT em.seg, em.idx, at_m + {metres('em.x', 'em.y', 'px', 'py')} AS along FROM em JOIN mid ON mid.seg = em.seg
        JOIN run ON run.seg = em.seg AND run.idx = em.idx
        WHERE abs({metres('em.x', 'em.y', 'px', 'py')} + {metres('em.x2', 'em.y2', 'px', 'py')} - m) < 0.001""",
)
def _(spark, sf_dir):
    k = F.floor((F.size("geometry") - 1) / 2).cast("int")
    a, b = pick(F.col("geometry"), k), pick(F.col("geometry"), k + 1)
    entry = F.struct(
        F.lit(0).alias("connector_index"),
        F.lit("mid").alias("connector_id"),
        F.struct(((a.x + b.x) / 2.0).alias("x"), ((a.y + b.y) / 2.0).alias("y")).alias("connector_geometry"),
    )
    table = bind(segments(spark, sf_dir), joined_connectors=F.array(entry))
    placed = placement.place_connectors(placement.measure(table))
    return placed.select("id", F.explode("_placed").alias("p")).select("id", whole("p.vertex", "vertex"), rounded("p.lr", 6, "lr"))


@query(
    "o7_outermost_connectors",
    """SELECT seg::VARCHAR AS id, 0::BIGINT AS pos, cid AS connector_id, round(lr, 6) AS lr FROM ends_of WHERE up = 1 UNION ALL
    SELECT seg::VARCHAR, 1, cid, round(lr, 6) FROM ends_of WHERE down = 1""",
)
def _(spark, sf_dir):
    placed = placement.place_connectors(placement.measure(joined(spark, sf_dir)))
    ends = placement.keep_outermost(placed).select("id", F.posexplode("_placed").alias("pos", "p"))
    return ends.select("id", whole("pos"), F.col("p.id").alias("connector_id"), rounded("p.lr", 6, "lr"))


@query(
    "l4_locate_values",
    "SELECT seg::VARCHAR AS id, round(lr, 9) AS lr, vertex, px AS x, py AS y FROM cand",
)
def _(spark, sf_dir):
    table = placement.measure(segments(spark, sf_dir))
    typed = [(F.col(c), table.schema[c].dataType) for c in chosen(spark, sf_dir)]
    values = bind(table, _lrs=lineref.all_split_values(typed))
    where = F.transform(
        "_lrs",
        lambda v: F.struct(v.alias("lr"), placement.locate(v, F.col("geometry"), F.col("_at"), F.col("_total"), 7).alias("p")),
    )
    return values.select("id", F.explode(where).alias("w")).select(
        "id", rounded("w.lr", 9, "lr"), whole("w.p.vertex", "vertex"), F.col("w.p.x").alias("x"), F.col("w.p.y").alias("y")
    )


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutting.split_points(joined(spark, sf_dir), chosen(spark, sf_dir))


@query(
    "l3_added_points",
    "SELECT seg::VARCHAR AS id, cid AS point_id, round(lr, 6) AS lr, vertex, x, y FROM added",
)
def _(spark, sf_dir):
    points = _points(spark, sf_dir).select("id", F.explode("_points").alias("p")).filter("p.is_added")
    return points.select(
        "id", F.col("p.id").alias("point_id"), rounded("p.lr", 6, "lr"), whole("p.vertex", "vertex"),
        F.col("p.x").alias("x"), F.col("p.y").alias("y"),
    )


@query(
    "o2_ordered_split_points",
    """SELECT seg::VARCHAR AS id, row_number() OVER (PARTITION BY seg ORDER BY lr, seq) - 1 AS rank, cid AS point_id,
    round(lr, 6) AS lr, is_added FROM pts""",
)
def _(spark, sf_dir):
    ordered = _points(spark, sf_dir).select("id", F.posexplode(placement.in_line_order(F.col("_points"))).alias("rank", "p"))
    return ordered.select("id", whole("rank"), F.col("p.id").alias("point_id"), rounded("p.lr", 6, "lr"), "p.is_added")


# ---------------------------------------------------------------- pieces


@query(
    "w4_pieces",
    """SELECT seg::VARCHAR AS id, piece_no, s_id AS start_id, e_id AS end_id, round(s_lr, 6) AS start_lr, round(e_lr, 6) AS end_lr
    FROM piece""",
)
def _(spark, sf_dir):
    opened = split(spark, sf_dir).select("id", F.posexplode("pieces").alias("piece_no", "p"))
    return opened.select(
        "id", whole("piece_no"), "p.start_id", "p.end_id", rounded("p.start_lr", 6, "start_lr"), rounded("p.end_lr", 6, "end_lr")
    )


@query(
    "l6_piece_vertices",
    "SELECT seg::VARCHAR AS id, piece_no, n, round(x, 7) AS x, round(y, 7) AS y FROM piece_v",
)
def _(spark, sf_dir):
    opened = pieces(spark, sf_dir).select("id", "piece_no", F.posexplode("geometry").alias("n", "p"))
    return opened.select("id", whole("piece_no"), whole("n"), *xy(F.col("p")))


@query(
    "l8_added_connectors",
    "SELECT cid AS id, 'connector' AS type, x, y FROM added WHERE seg NOT IN (SELECT seg FROM fail)",
)
def _(spark, sf_dir):
    return cutting.added_connectors(split(spark, sf_dir)).select("id", "type", *xy(pick(F.col("geometry"), 0)))


PIECE_CONNECTORS = "SELECT seg::VARCHAR AS id, piece_no, pos, cid AS connector_id, round(spot, 6) + 0e0 AS spot FROM pcon"


def _open_connectors(table: DataFrame) -> DataFrame:
    opened = table.select("id", "piece_no", F.posexplode("connectors").alias("pos", "c"))
    return opened.select("id", whole("piece_no"), whole("pos"), "c.connector_id", rounded("c.at", 6, "spot"))


@query("l9_piece_connectors", PIECE_CONNECTORS)
def _(spark, sf_dir):
    return _open_connectors(pieces(spark, sf_dir))


@query("l9b_connector_ids", "SELECT seg::VARCHAR AS id, piece_no, pos, cid AS connector_id FROM pcon")
def _(spark, sf_dir):
    listed = joined(spark, sf_dir).withColumn("connector_ids", F.transform("connectors", lambda c: c.connector_id))
    cut = cutting.explode_pieces(cutting.split_segments(listed, chosen(spark, sf_dir)), chosen(spark, sf_dir))
    opened = cut.select("id", "piece_no", F.posexplode("connector_ids").alias("pos", "connector_id"))
    return opened.select("id", whole("piece_no"), whole("pos"), "connector_id")


@query("l9_inner_connectors", PIECE_CONNECTORS, **OUTERMOST)
def _(spark, sf_dir):
    config = SplitConfig(split_at_connectors=False)
    outer = cutting.split_segments(joined(spark, sf_dir), chosen(spark, sf_dir), config)
    return _open_connectors(cutting.explode_pieces(outer, chosen(spark, sf_dir), config))


@query(
    "r1_rescope_ranges",
    """SELECT seg::VARCHAR AS id, piece_no, ri AS rule, applies, round(lo, 6) AS lo, round(hi, 6) AS hi FROM scoped""",
)
def _(spark, sf_dir):
    opened = split(spark, sf_dir).select("id", "rules", "length_before_split", F.posexplode("pieces").alias("piece_no", "p"))
    p = F.col("p")
    one = lineref.rescope_range(
        F.col("r.between"), p.start_m, p.end_m - p.start_m, F.col("length_before_split"), 0.01
    )
    scoped = opened.select("*", F.posexplode("rules").alias("rule", "r")).withColumn("s", one)
    ends = [rounded(pick(F.col("s.between"), i), 6, name) for i, name in enumerate(("lo", "hi"))]
    return scoped.select("id", whole("piece_no"), whole("rule"), "s.applies", *ends)


@query(
    "r2_rescoped_values",
    """SELECT seg::VARCHAR AS id, piece_no, row_number() OVER (PARTITION BY seg, piece_no ORDER BY ri) - 1 AS pos, value,
    round(lo, 6) AS lo, round(hi, 6) AS hi FROM scoped WHERE applies""",
)
def _(spark, sf_dir):
    opened = pieces(spark, sf_dir).select("id", "piece_no", F.posexplode("rules").alias("pos", "r"))
    ends = [rounded(pick(F.col("r.between"), i), 6, name) for i, name in enumerate(("lo", "hi"))]
    return opened.select("id", whole("piece_no"), whole("pos"), "r.value", *ends)


@query(
    "r3_excluded_column",
    """SELECT seg::VARCHAR AS id, piece_no, count(ri) AS rules, round(sum(lo), 6) AS lo FROM piece LEFT JOIN rules USING (seg)
    GROUP BY seg, piece_no""",
    lrv="SELECT seg, unnest([0e0, 1e0]) AS lr FROM met",
)
def _(spark, sf_dir):
    columns = splitter.lr_columns(features(spark, sf_dir), SplitConfig(lr_columns_to_exclude=["rules"]))
    table = cutting.explode_pieces(cutting.split_segments(joined(spark, sf_dir), columns), columns)
    stale = F.aggregate("rules", F.lit(0.0), lambda t, r: t + pick(r["between"], 0))
    return table.select("id", whole("piece_no"), whole(F.coalesce(F.size("rules"), F.lit(0)), "rules"), rounded(stale, 6, "lo"))


@query("m1_length_buckets", "SELECT seg::VARCHAR AS id, piece_no, bucket FROM bucket")
def _(spark, sf_dir):
    opened = split(spark, sf_dir).select("id", F.posexplode("pieces").alias("piece_no", "p"))
    return opened.select("id", whole("piece_no"), lines.length_bucket(F.col("p.end_m") - F.col("p.start_m")).alias("bucket"))


@query(
    "m2_self_intersecting",
    "SELECT seg::VARCHAR AS id, seg IN (SELECT seg FROM crossed) AS crosses FROM net",
)
def _(spark, sf_dir):
    return segments(spark, sf_dir).select("id", lines.is_self_intersecting(F.col("geometry")).alias("crosses"))


@query("m3_piece_metrics", "SELECT seg::VARCHAR AS id, piece_no, key, value FROM metric")
def _(spark, sf_dir):
    return pieces(spark, sf_dir).select("id", whole("piece_no"), F.explode("metrics").alias("key", "value"))


@query(
    "m4_segment_lengths",
    """SELECT seg::VARCHAR AS id, round(before, 3) AS before, round(after, 3) AS after FROM audit""",
)
def _(spark, sf_dir):
    return split(spark, sf_dir).select(
        "id", rounded("length_before_split", 3, "before"), rounded("length_after_split", 3, "after")
    )


# ---------------------------------------------------------------- turns and destinations


@query("t1_pruned_turns", "SELECT seg::VARCHAR AS id, piece_no, c1 AS first_connector FROM ptrn")
def _(spark, sf_dir):
    opened = pieces(spark, sf_dir).select("id", "piece_no", F.explode("prohibited_transitions").alias("t"))
    return opened.select("id", whole("piece_no"), pick(F.col("t.sequence"), 0).connector_id.alias("first_connector"))


@query(
    "t2_turn_items",
    """SELECT seg::VARCHAR AS id, piece_no, 0::BIGINT AS item, step, ref::VARCHAR AS segment_id, cid AS connector_id,
    next_cid AS next_connector_id, final_heading FROM titem""",
)
def _(spark, sf_dir):
    items = references.reference_items(pieces(spark, sf_dir), destinations=False)
    return items.select(
        "id", whole("piece_no"), whole("item"), whole("step"), "segment_id", "connector_id", "next_connector_id", "final_heading"
    )


@query(
    "j4_referenced_pieces",
    """SELECT seg::VARCHAR AS id, piece_no FROM piece WHERE seg IN (SELECT ref FROM titem)""",
)
def _(spark, sf_dir):
    table = pieces(spark, sf_dir)
    return references.referenced_pieces(table, references.reference_items(table, destinations=False)).select("id", whole("piece_no"))


@query(
    "j4_referenced_ends",
    """SELECT DISTINCT p.seg::VARCHAR AS segment_id, c.cid AS connector_id, round(s_lr, 6) AS start_lr, round(e_lr, 6) AS end_lr
    FROM piece p JOIN pcon c ON c.seg = p.seg AND c.piece_no = p.piece_no JOIN titem t ON t.ref = p.seg AND t.cid = c.cid""",
)
def _(spark, sf_dir):
    table = pieces(spark, sf_dir)
    items = references.reference_items(table, destinations=False)
    key = ["segment_id", "connector_id"]
    met = references.referenced_ends(table, items).join(items.select(*key).distinct(), key)
    return met.select("segment_id", "connector_id", rounded("start_lr", 6), rounded("end_lr", 6)).distinct()


@query(
    "t4_matched_turn_items",
    """SELECT seg::VARCHAR AS id, piece_no, step, round(s_lr, 6) AS ref_start_lr, round(e_lr, 6) AS ref_end_lr FROM tmatch""",
)
def _(spark, sf_dir):
    table = pieces(spark, sf_dir)
    matches = references.match_items(references.reference_items(table, destinations=False), table).distinct()
    return matches.select("id", whole("piece_no"), whole("step"), rounded("ref_start_lr", 6), rounded("ref_end_lr", 6))


@query(
    "t6_resolved_turns",
    """SELECT seg::VARCHAR AS id, piece_no, step, round(s_lr, 6) AS start_lr, round(e_lr, 6) AS end_lr FROM tdone""",
)
def _(spark, sf_dir):
    resolved = references.resolve_references(pieces(spark, sf_dir), destinations=False)
    steps = resolved.select("id", "piece_no", F.explode("prohibited_transitions").alias("t")).select(
        "id", "piece_no", F.posexplode("t.sequence").alias("step", "s")
    )
    return steps.select("id", whole("piece_no"), whole("step"), rounded("s.start_lr", 6, "start_lr"), rounded("s.end_lr", 6, "end_lr"))


@query("d1_pruned_destinations", "SELECT seg::VARCHAR AS id, piece_no, c1 AS from_connector_id FROM ditem")
def _(spark, sf_dir):
    opened = pieces(spark, sf_dir).select("id", "piece_no", F.explode("destinations").alias("d"))
    return opened.select("id", whole("piece_no"), "d.from_connector_id")


@query(
    "d3_resolved_destinations",
    """SELECT seg::VARCHAR AS id, piece_no, ref::VARCHAR AS to_segment_id, cid AS to_connector_id,
    round(s_lr, 6) AS start_lr, round(e_lr, 6) AS end_lr FROM dmatch""",
)
def _(spark, sf_dir):
    resolved = references.resolve_references(pieces(spark, sf_dir), turns=False)
    opened = resolved.select("id", "piece_no", F.explode("destinations").alias("d"))
    return opened.select(
        "id", whole("piece_no"), "d.to_segment_id", "d.to_connector_id",
        rounded("d.to_segment_start_lr", 6, "start_lr"), rounded("d.to_segment_end_lr", 6, "end_lr"),
    )


@query(
    "k1_piece_keys",
    "SELECT concat(seg, '@', round(s_lr, 6)::VARCHAR, '-', round(e_lr, 6)::VARCHAR) AS key FROM piece",
)
def _(spark, sf_dir):
    table = pieces(spark, sf_dir)
    return table.select(cutting.piece_key(F.col("id"), F.round("start_lr", 6), F.round("end_lr", 6)).alias("key"))


@query("k1_reference_keys", "SELECT count(*) AS keys, count(DISTINCT (ref, s_lr, e_lr)) AS distinct_keys FROM dmatch")
def _(spark, sf_dir):
    resolved = references.resolve_references(pieces(spark, sf_dir), turns=False)
    d = F.col("d")
    key = cutting.piece_key(d.to_segment_id, d.to_segment_start_lr, d.to_segment_end_lr)
    keys = resolved.select(F.explode("destinations").alias("d")).select(key.alias("key"))
    return keys.agg(F.count("key").alias("keys"), F.count_distinct("key").alias("distinct_keys"))


# ---------------------------------------------------------------- reports and whole results


@query(
    "a5_metric_profile",
    """SELECT key, value, count(*) AS value_count, round(count(*) / (SELECT count(*) FROM piece) * 100, 2) AS percentage
    FROM metric GROUP BY key, value""",
)
def _(spark, sf_dir):
    return reports.metric_profile(final(spark, sf_dir))


@query(
    "a6_length_audit",
    """SELECT trunc(sum(before))::BIGINT AS total_length_before_split, trunc(sum(after))::BIGINT AS total_length_after_split,
    trunc(sum(CASE WHEN after - before < 0 THEN after - before ELSE 0e0 END))::BIGINT AS length_removed,
    trunc(sum(CASE WHEN after - before > 0 THEN after - before ELSE 0e0 END))::BIGINT AS length_added FROM audit""",
)
def _(spark, sf_dir):
    return reports.length_audit(split(spark, sf_dir))


@query(
    "a7_error_profile",
    """SELECT reason IS NULL AS is_success, coalesce(reason, '') AS error, sum(greatest(n, 1))::BIGINT AS count FROM (
    SELECT net.seg, reason, count(piece_no) AS n FROM net LEFT JOIN fail USING (seg) LEFT JOIN piece USING (seg)
    GROUP BY net.seg, reason) GROUP BY ALL""",
)
def _(spark, sf_dir):
    return reports.error_profile(split(spark, sf_dir))


@query(
    "a8_splits_histogram",
    """SELECT number_of_splits, count(*) AS count FROM (SELECT count(*) AS number_of_splits FROM piece GROUP BY seg)
    GROUP BY number_of_splits""",
)
def _(spark, sf_dir):
    return reports.splits_histogram(pieces(spark, sf_dir))


@query(
    "a9_type_counts",
    "SELECT type, count(*) AS count FROM feat GROUP BY type",
)
def _(spark, sf_dir):
    return reports.type_counts(features(spark, sf_dir))


@query(
    "u1_all_connectors",
    """SELECT cid AS id, round(x, 7) AS x, round(y, 7) AS y FROM con UNION ALL
    SELECT cid, x, y FROM added WHERE seg NOT IN (SELECT seg FROM fail)""",
)
def _(spark, sf_dir):
    return splitter.all_connectors(features(spark, sf_dir), split(spark, sf_dir)).select("id", *xy(pick(F.col("geometry"), 0)))


FINAL_ROWS = """SELECT 'segment' AS type, seg::VARCHAR AS id, round(s_lr, 6) AS start_lr, round(e_lr, 6) AS end_lr,
    (SELECT count(*) FROM pcv2 c WHERE c.seg = piece.seg AND c.rn = piece.rn) AS vertices FROM piece UNION ALL
    SELECT 'connector', cid, NULL, NULL, 1 FROM con UNION ALL
    SELECT 'connector', cid, NULL, NULL, 1 FROM added WHERE seg NOT IN (SELECT seg FROM fail)"""


def _final_rows(table: DataFrame) -> DataFrame:
    return table.select("type", "id", rounded("start_lr", 6), rounded("end_lr", 6), whole(F.size("geometry"), "vertices"))


@query("u2_final_features", FINAL_ROWS)
def _(spark, sf_dir):
    return _final_rows(final(spark, sf_dir))


#: A corner of the network.
SMALL_POLYGON = "POLYGON ((-122.0005 46.9995, -121.9992 46.9995, -121.9995 47.00035, -122.0005 47.0002, -122.0005 46.9995))"


@query(
    "io4_by_place",
    f"SELECT id.kind AS type, id.name AS id, id.s AS start_lr FROM ({MEETS_POLYGON})",
    poly=_polygon_edges(SMALL_POLYGON),
    allv="""SELECT {'kind': 'segment', 'name': p.seg::VARCHAR, 's': round(s_lr, 6)} AS id, n AS idx, x, y
      FROM piece_v v JOIN piece p ON p.seg = v.seg AND p.piece_no = v.piece_no UNION ALL
      SELECT {'kind': 'connector', 'name': cid, 's': NULL}, 0, x, y FROM con UNION ALL
      SELECT {'kind': 'connector', 'name': cid, 's': NULL}, 0, x, y FROM added WHERE seg NOT IN (SELECT seg FROM fail)""",
    alle="""SELECT * FROM (SELECT id, idx, x, y, coalesce(lead(x) OVER w, CASE WHEN idx = 0 THEN x END) AS x2,
      coalesce(lead(y) OVER w, CASE WHEN idx = 0 THEN y END) AS y2 FROM allv WINDOW w AS (PARTITION BY id ORDER BY idx))
      WHERE x2 IS NOT NULL""",
)
def _(spark, sf_dir):
    path = f"{scratch(spark, sf_dir)}/final_by_place"
    if not manifests.is_whole(spark, manifests.current(spark, path)):
        manifests.add_version(spark, path, lambda folder: layout.write_by_place(final(spark, sf_dir), folder))
    stored = read_parquet(spark, manifests.location(spark, path))
    return filters.spatial_filter(stored, SMALL_POLYGON).select("type", "id", rounded("start_lr", 6))


@query("p3_staged_split", FINAL_ROWS)
def _(spark, sf_dir):
    io = FeatureIO(stored_features(spark, sf_dir), f"{scratch(spark, sf_dir)}/staged")
    return _final_rows(splitter.split_network(spark, io))


def _staged(spark: SparkSession, sf_dir: str) -> FeatureIO:
    """A finished run over the stored features, made once per session."""
    io = FeatureIO(stored_features(spark, sf_dir), f"{scratch(spark, sf_dir)}/reported")
    if not io.manifest(spark, Stage.final_output):
        splitter.split_network(spark, io)
    return io


@query(
    "a11_stage_counts",
    """SELECT '2_joined' AS stage, count(*) AS rows FROM net UNION ALL SELECT '3_raw_split', count(*) FROM net UNION ALL
    SELECT '4_segments_splits', count(*) FROM piece UNION ALL SELECT 'final', (SELECT count(*) FROM piece) +
    (SELECT count(*) FROM con) + (SELECT count(*) FROM added WHERE seg NOT IN (SELECT seg FROM fail))""",
)
def _(spark, sf_dir):
    found = splitter.run_report(spark, _staged(spark, sf_dir))
    return found.filter("report = 'rows'").select("stage", F.col("value").alias("rows"))


@query(
    "p3_run_report",
    """SELECT 'lengths' AS report, 'total_length_before_split' AS key, b AS value FROM sums UNION ALL
    SELECT 'lengths', 'total_length_after_split', f FROM sums UNION ALL SELECT 'lengths', 'length_removed', r FROM sums UNION ALL
    SELECT 'lengths', 'length_added', g FROM sums UNION ALL
    SELECT 'outcomes', coalesce(reason, ''), sum(greatest(n, 1))::BIGINT FROM (SELECT net.seg, reason, count(piece_no) AS n
      FROM net LEFT JOIN fail USING (seg) LEFT JOIN piece USING (seg) GROUP BY net.seg, reason) GROUP BY reason UNION ALL
    SELECT 'splits', n::VARCHAR, count(*) FROM (SELECT count(*) AS n FROM piece GROUP BY seg) GROUP BY n UNION ALL
    SELECT 'types', 'segment', count(*) FROM piece UNION ALL SELECT 'types', 'connector', (SELECT count(*) FROM con) +
      (SELECT count(*) FROM added WHERE seg NOT IN (SELECT seg FROM fail)) UNION ALL
    SELECT 'metrics', concat(key, ' ', value), count(*) FROM metric GROUP BY key, value""",
    sums="""SELECT trunc(sum(before))::BIGINT AS b, trunc(sum(after))::BIGINT AS f,
      trunc(sum(CASE WHEN after < before THEN after - before ELSE 0e0 END))::BIGINT AS r,
      trunc(sum(CASE WHEN after > before THEN after - before ELSE 0e0 END))::BIGINT AS g FROM audit""",
)
def _(spark, sf_dir):
    return splitter.run_report(spark, _staged(spark, sf_dir)).filter("report NOT IN ('rows', 'lines')").select("report", "key", "value")


@query("io10_reused_split", FINAL_ROWS)
def _(spark, sf_dir):
    io = FeatureIO(stored_features(spark, sf_dir), f"{scratch(spark, sf_dir)}/reused")
    splitter.split_network(spark, io)
    return _final_rows(splitter.split_network(spark, io))


@query("io8_hooked_split", FINAL_ROWS)
def _(spark, sf_dir):
    folder, source = f"{scratch(spark, sf_dir)}/hooked", stored_features(spark, sf_dir)

    def read(session, name, _):
        return read_parquet(session, source if name == Stage.read_input else f"{folder}-{name.value}")

    def write(df, name, _):
        write_parquet(df, f"{folder}-{name.value}")

    io = FeatureIO(source, folder, read, lambda session, name, _: False, write)
    return _final_rows(splitter.split_network(spark, io))


@query("p3_one_plan_split", FINAL_ROWS)
def _(spark, sf_dir):
    path = f"{scratch(spark, sf_dir)}/cut"
    return _final_rows(splitter.split_features(features(spark, sf_dir), split_path=path))


def entry(spark: SparkSession) -> DataFrame:
    """Split the derived road network of the smallest tables."""
    return final(spark, "/root/testdata/sf0.001").select("type", "id", "start_lr", "end_lr", "connectors", "metrics")


# ------------------------------------------------ operators for training data, where they are installed

TRAINING_DATA: dict[str, Query] = {}
TRAINING_DATA_ORACLES: dict[str, str] = {}
if importlib.util.find_spec("wayloom.llm") and importlib.util.find_spec("wayloom.llm.queries"):
    from wayloom.llm import queries as llm_queries

    TRAINING_DATA.update(llm_queries.QUERIES)
    TRAINING_DATA_ORACLES.update(llm_queries.ORACLES)
    found = importlib.util.find_spec("corpus_pipeline")
    # The one beside this file, not that of another copy on the search path.
    if found and Path(found.origin).resolve().parent == Path(__file__).resolve().parent:
        import corpus_pipeline

        TRAINING_DATA["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            TRAINING_DATA_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Query]:
    return QUERIES | TRAINING_DATA


def oracle_sql() -> dict[str, str]:
    return ORACLES | TRAINING_DATA_ORACLES
