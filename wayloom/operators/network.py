"""Feature rows: segments joined with their connectors, lines opened into vertices and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.functions.binding import bind, indices, pick, stretch
from wayloom.functions.lines import edge_metres, running_totals
from wayloom.operators.skew import salted_join
from wayloom.sources.feature_io import coordinates


def segments(features: DataFrame) -> DataFrame:
    return features.filter(F.col("type") == "segment")


def connectors(features: DataFrame) -> DataFrame:
    return features.filter(F.col("type") == "connector")


def connector_positions(features: DataFrame) -> DataFrame:
    """``connector_id`` and its point, from the connector rows."""
    return connectors(features).select(
        F.col("id").alias("connector_id"), pick(coordinates(features), 0).alias("connector_geometry")
    )


def connector_pairs(features: DataFrame) -> DataFrame:
    """One row per segment and entry of its connector list; segments without any drop out."""
    entries = F.transform(
        "connectors",
        lambda c, i: F.struct(
            c.connector_id.alias("connector_id"), c["at"].alias("connector_at"), i.alias("connector_index")
        ),
    )
    return (
        segments(features)
        .select(F.col("id").alias("segment_id"), F.explode(entries).alias("c"))
        .select("segment_id", "c.*")
    )


def locate_pairs(pairs: DataFrame, positions: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Give every pair its connector's point, null where the connector is missing.

    A hub connector may be in a large share of all pairs, so its rows are salted.
    """
    return salted_join(
        pairs,
        positions,
        ["connector_id"],
        "left",
        spread_by=[F.col("segment_id"), F.col("connector_index")],
        rows_per_task=rows_per_task,
    )


def gather_pairs(pairs: DataFrame) -> DataFrame:
    """Located connectors per segment in list order; no longer than the segment's own list."""
    entry = F.struct("connector_index", "connector_id", "connector_geometry", "connector_at")
    return pairs.groupBy("segment_id").agg(F.sort_array(F.collect_list(entry)).alias("joined_connectors"))


def join_connectors(features: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Segments with ``joined_connectors``; those without connectors stay, with null.

    Only ids and points travel to meet the connectors. The wide rows move once, by id, with
    their geometry in the form it is stored in.
    """
    located = locate_pairs(connector_pairs(features), connector_positions(features), rows_per_task)
    gathered = gather_pairs(located).withColumnRenamed("segment_id", "id")
    return segments(features).join(gathered, "id", "left")


def attach_attributes(features: DataFrame, attributes: DataFrame) -> DataFrame:
    """Add columns of another table by id; linear references in them get found like any.

    An id may occur once in the other table; if one is repeated the job fails and names it, instead
    of multiplying features.
    """
    repeated = F.concat(F.lit("repeated id among the attributes: "), F.col("id"))
    names = [c for c in attributes.columns if c != "id"]
    once = attributes.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), *(F.first(c).alias(c) for c in names))
    sure = F.when(F.col("_n") > 1, F.raise_error(repeated).cast("string")).otherwise(F.col("id"))
    return features.join(once.select(sure.alias("id"), *names), "id", "left")


def vertices(lines: DataFrame) -> DataFrame:
    """One row per vertex: ``id, idx, x, y``."""
    return lines.select("id", F.posexplode("geometry").alias("idx", "p")).select("id", "idx", "p.x", "p.y")


def edges(lines: DataFrame) -> DataFrame:
    """One row per edge with its far vertex, length and metres from the line's start.

    The order is the row's own, so neither a shuffle nor a sort is needed.
    """
    measured = bind(lines.select("id", "geometry"), _metres=edge_metres(F.col("geometry")))
    measured = bind(measured, _starts=running_totals(F.col("_metres")))
    last = F.size("geometry") - 1
    zipped = F.arrays_zip(
        indices(last).alias("idx"),
        stretch(F.col("geometry"), F.lit(0), last).alias("a"),
        stretch(F.col("geometry"), F.lit(1), last).alias("b"),
        F.col("_metres").alias("metres"),
        stretch(F.col("_starts"), F.lit(0), last).alias("start_m"),
    )
    opened = measured.select("id", F.explode(zipped).alias("e"))
    fields: list[Column] = [
        F.col("e.idx").alias("idx"),
        F.col("e.a.x").alias("x"),
        F.col("e.a.y").alias("y"),
        F.col("e.b.x").alias("x2"),
        F.col("e.b.y").alias("y2"),
        F.col("e.metres").alias("metres"),
        F.col("e.start_m").alias("start_m"),
    ]
    return opened.select("id", *fields)
