"""Cut lines at their split points and describe the pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayloom.functions.binding import bind, indices, let, number_text, pick, stretch
from wayloom.functions.lineref import all_split_values, has_malformed, rescope
from wayloom.functions.lines import (
    differs,
    is_line,
    is_self_intersecting,
    length_bucket,
    line_metres,
    without_repeats,
)
from wayloom.operators import placement
from wayloom.operators.references import (
    DESTINATIONS,
    TURN_REFERENCES,
    TURNS,
    prune_destinations,
    prune_turns,
    turn_references,
)
from wayloom.plans.config import DEFAULT_CONFIG, SplitConfig
from wayloom.sources.feature_io import with_coordinates

# Why a segment yields no pieces.
NOT_A_LINE = "geometry is not a line"
ZERO_LENGTH = "length is zero"
NOT_ON_LINE = "connector is not on the line"
NO_CONNECTOR = "no connector to start from"
FEW_POINTS = "fewer than two split points"
NO_POSITION = "connector list or position is missing"
MALFORMED_RANGE = "linear reference is not a pair"
CLOSED_PIECE = "piece starts and ends in the same point"
FAILURES = (
    NOT_A_LINE, ZERO_LENGTH, NOT_ON_LINE, NO_CONNECTOR, FEW_POINTS, NO_POSITION, MALFORMED_RANGE, CLOSED_PIECE,
)

SPLIT_COLUMNS = [
    "is_success",
    "error_message",
    "pieces",
    "added_connectors",
    "length_before_split",
    "length_after_split",
    "length_diff",
    "original_self_intersecting",
]


def cut(points: Column, coords: Column) -> Column:
    """Pieces between consecutive points; one that shrinks to a single coordinate drops out."""
    corner = lambda p: F.array(F.struct(p.x.alias("x"), p.y.alias("y")))

    def between(a: Column, b: Column) -> Column:
        inner = stretch(coords, a.vertex + 1, b.vertex - a.vertex)
        return piece(a, b, without_repeats(F.concat(corner(a), inner, corner(b))))

    def piece(a: Column, b: Column, geometry: Column) -> Column:
        return F.struct(
            a.id.alias("start_id"),
            a.lr.alias("start_lr"),
            a.metres.alias("start_m"),
            b.id.alias("end_id"),
            b.lr.alias("end_lr"),
            b.metres.alias("end_m"),
            geometry.alias("geometry"),
        )

    def all_pieces(p: Column) -> Column:
        untouched = (F.size(p) == 2) & (pick(p, 0).lr == 0) & (pick(p, 1).lr == 1)
        several = F.transform(
            indices(F.size(p) - 1),
            lambda i: let(F.struct(pick(p, i).alias("a"), pick(p, i + 1).alias("b")), lambda e: between(e.a, e.b)),
        )
        whole = F.array(piece(pick(p, 0), pick(p, 1), coords))
        return F.when(untouched, whole).otherwise(F.filter(several, lambda s: F.size(s.geometry) > 1))

    return let(placement.in_line_order(points), all_pieces)


def split_points(
    joined: DataFrame, lr_columns: list[str], config: SplitConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Add ``_at``, ``_total``, ``_placed``, ``_unplaced`` and ``_points`` to joined segments."""
    joined = with_coordinates(joined)
    df = placement.place_connectors(placement.measure(joined))
    if not config.split_at_connectors:
        df = placement.keep_outermost(df)
    return placement.place_lr_values(
        df,
        all_split_values(_typed(joined, lr_columns)),
        config.point_precision,
        config.lr_split_point_min_dist_meters,
    )


def split_segments(
    joined: DataFrame, lr_columns: list[str], config: SplitConfig = DEFAULT_CONFIG
) -> DataFrame:
    """One row per segment with its pieces, added connectors, lengths and failure, if any.

    All work is native and inside the row, so nothing is shuffled. A failed segment keeps its
    row, with a reason and without pieces.
    """
    joined = with_coordinates(joined)
    df = bind(split_points(joined, lr_columns, config), _cut=cut(F.col("_points"), F.col("geometry")))
    df = bind(df, _cut_m=F.aggregate("_cut", F.lit(0.0), lambda t, p: t + line_metres(p.geometry)))
    df = bind(df, error_message=_failure(df, lr_columns, config))
    ok = F.col("error_message") == ""
    added = F.transform(
        F.filter("_points", lambda p: p.is_added),
        lambda p: F.struct(p.id.alias("id"), F.array(F.struct(p.x.alias("x"), p.y.alias("y"))).alias("geometry")),
    )
    before = F.coalesce("_total", F.lit(0.0))
    after = F.when(ok | (F.col("error_message") == CLOSED_PIECE), F.col("_cut_m")).otherwise(0.0)
    kept = [c for c in joined.columns if c not in ("geometry", "joined_connectors")]
    return df.select(
        *kept,
        ok.alias("is_success"),
        "error_message",
        F.when(ok, F.col("_cut")).otherwise(F.filter("_cut", lambda _: F.lit(False))).alias("pieces"),
        F.when(ok, added).otherwise(F.filter(added, lambda _: F.lit(False))).alias("added_connectors"),
        before.alias("length_before_split"),
        after.alias("length_after_split"),
        (after - before).alias("length_diff"),
        F.when(ok, is_self_intersecting(F.col("geometry"))).alias("original_self_intersecting"),
    )


def _failure(df: DataFrame, lr_columns: list[str], config: SplitConfig) -> Column:
    """First reason why the segment fails, empty if it does not."""
    some_piece = F.size("_cut") > 0
    closed = F.exists("_cut", lambda p: ~differs(pick(p.geometry, 0), F.element_at(p.geometry, F.size(p.geometry))))
    no_position = F.col("connectors").isNull() | F.exists("connectors", lambda c: c["at"].isNull())
    reason = (
        F.when(~is_line(F.col("geometry")), NOT_A_LINE)
        .when((F.col("_total") == 0) & (F.col("_sought") > 0), ZERO_LENGTH)
        .when(F.col("_unplaced") > 0, NOT_ON_LINE)
    )
    if not config.split_at_connectors:
        reason = reason.when(F.size("_placed") == 0, NO_CONNECTOR)
    return (
        reason.when(F.size("_points") < 2, FEW_POINTS)
        .when(some_piece & no_position, NO_POSITION)
        .when(F.exists("_cut", lambda p: p.end_m == p.start_m), ZERO_LENGTH)
        .when(some_piece & has_malformed(_typed(df, lr_columns)), MALFORMED_RANGE)
        .when(closed, CLOSED_PIECE)
        .otherwise("")
    )


def piece_connectors(piece: Column, connectors: Column, total_m: Column) -> Column:
    """Both ends, and in between them connectors not cut at, by position within the piece."""

    def entry(id_: Column, at: Column, rank: Column) -> Column:
        return F.struct(at.alias("lr"), rank.cast("int").alias("rank"), id_.alias("connector_id"))

    inner = F.filter(
        F.transform(connectors, lambda c, i: entry(c.connector_id, c["at"], i + 2)),
        lambda c: (c.lr > piece.start_lr)
        & (c.lr < piece.end_lr)
        & (c.connector_id != piece.start_id)
        & (c.connector_id != piece.end_id),
    )
    ends = F.array(
        entry(piece.start_id, piece.start_lr, F.lit(0)), entry(piece.end_id, piece.end_lr, F.lit(1))
    )
    return F.transform(
        F.sort_array(F.concat(ends, inner)),
        lambda c: F.struct(
            c.connector_id.alias("connector_id"),
            F.round(F.try_divide(c.lr * total_m - piece.start_m, piece.end_m - piece.start_m), 9).alias("at"),
        ),
    )


def piece_metrics(length_m: Column, original_crosses: Column, piece_crosses: Column) -> Column:
    """Length class, and flags for self-intersection that are only there when true."""
    flags = F.map_from_arrays(
        F.array(F.lit("length"), F.lit("original_self_intersecting"), F.lit("split_self_intersecting")),
        F.array(length_bucket(length_m), F.when(original_crosses, "true"), F.when(piece_crosses, "true")),
    )
    return F.map_filter(flags, lambda _, v: v.isNotNull())


def explode_pieces(
    split: DataFrame, lr_columns: list[str], config: SplitConfig = DEFAULT_CONFIG
) -> DataFrame:
    """One row per piece: the segment's columns as they hold on it, ``piece_no``,
    ``start_lr``, ``end_lr``, ``metrics``, and ``turn_restrictions`` where turns exist."""
    types = {f.name: f.dataType for f in split.schema}
    kept = [c for c in split.columns if c not in SPLIT_COLUMNS]
    opened = split.filter("is_success").select(
        *kept,
        F.col("length_before_split").alias("_total"),
        "original_self_intersecting",
        F.posexplode("pieces").alias("piece_no", "_piece"),
    )
    piece, total = F.col("_piece"), F.col("_total")
    length = piece.end_m - piece.start_m
    opened = bind(opened, _connectors=piece_connectors(piece, F.col("connectors"), total))
    overlap = config.lr_split_point_min_dist_meters
    columns: dict[str, Column] = {c: F.col(c) for c in kept}
    for name in lr_columns:
        if name in columns:
            columns[name] = rescope(columns[name], types[name], piece.start_m, length, total, overlap)
    columns["connectors"] = F.col("_connectors").cast(types["connectors"].toNullable())
    if "connector_ids" in columns:
        columns["connector_ids"] = F.transform("_connectors", lambda c: c.connector_id)
    if TURNS in columns:
        columns[TURNS] = prune_turns(columns[TURNS], types[TURNS], F.col("_connectors"))
    if DESTINATIONS in columns:
        columns[DESTINATIONS] = prune_destinations(columns[DESTINATIONS], types[DESTINATIONS], F.col("_connectors"))
    pieces = opened.select(
        *[c.alias(name) for name, c in columns.items()],
        piece.geometry.alias("geometry"),
        "piece_no",
        piece.start_lr.alias("start_lr"),
        piece.end_lr.alias("end_lr"),
        piece_metrics(length, F.col("original_self_intersecting"), is_self_intersecting(piece.geometry)).alias("metrics"),
    )
    if TURNS in columns:
        pieces = pieces.withColumn(TURN_REFERENCES, turn_references(F.col(TURNS)))
    return pieces


def added_connectors(split: DataFrame) -> DataFrame:
    """Connector rows for points that no connector existed for."""
    rows = split.select(F.explode("added_connectors").alias("c"))
    return rows.select("c.id", "c.geometry", F.lit("connector").alias("type"))


def piece_key(id_: Column, start_lr: Column, end_lr: Column) -> Column:
    """One-column key of a piece or of a reference to it."""
    return F.concat(id_, F.lit("@"), number_text(start_lr), F.lit("-"), number_text(end_lr))


def _typed(df: DataFrame, names: list[str]) -> list[tuple[Column, T.DataType]]:
    return [(F.col(n), df.schema[n].dataType) for n in names if n in df.columns]
