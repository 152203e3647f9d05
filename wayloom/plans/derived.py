"""A road network made from order tables: orders are lines, suppliers are junctions.

An order's items are the vertices of its line, in item order, each at its supplier's place.
One supplier in seven has no connector feature. The next order number is the next road.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayloom.functions.binding import bind, pick
from wayloom.functions.lines import running_metres


def _x(node: Column) -> Column:
    return F.lit(-122.0) + (node % 100) * F.lit(9e-5)


def _y(node: Column) -> Column:
    return F.lit(47.0) + (node % 31) * F.lit(1e-4)


def _name(node: Column) -> Column:
    return F.concat(F.lit("n"), node.cast("string"))


def lines(spark: SparkSession, sf_dir: str, by_block: bool = False) -> DataFrame:
    """``seg`` and its ordered ``items``; lines need at least two different junctions.

    A line is one feature, hence one row, however its items were stored; ``by_block`` it is a row of each ``block`` that
    it is in.
    """
    item = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    stored = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    blocks = ["block"] if by_block else []
    return (
        (_by_block(stored) if by_block else stored)
        .groupBy(*blocks, F.col("l_orderkey").alias("seg"))
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .filter(F.size(F.array_distinct(F.transform("items", lambda i: i.l_suppkey))) >= 2)
    )


def _junctions() -> Column:
    """Both ends of a line and about every third vertex in between, with its number."""
    return F.filter(
        F.transform("items", lambda i, n: F.struct(n.alias("n"), i.alias("i"))),
        lambda v: (v.n == 0) | (v.n == F.size("items") - 1) | (v.i.l_partkey % 3 == 0),
    )


def line_features(spark: SparkSession, sf_dir: str, references: bool = False) -> DataFrame:
    """Segments with geometry, connectors and one linearly referenced column, ``rules``; maybe with turns and destinations."""
    geometry = F.transform(
        "items", lambda i: F.struct(_x(i.l_suppkey).alias("x"), _y(i.l_suppkey).alias("y"))
    )
    found = with_turns(lines(spark, sf_dir, by_block=True)) if references else lines(spark, sf_dir)
    df = bind(found, geometry=geometry)
    df = bind(df, _at=running_metres(F.col("geometry")))
    total = F.element_at("_at", -1)
    connectors = F.transform(
        _junctions(),
        lambda v: F.struct(
            _name(v.i.l_suppkey).alias("connector_id"), F.try_divide(pick(F.col("_at"), v.n), total).alias("at")
        ),
    )
    lo = lambda i: i.l_discount + F.lit(0.0)
    rules = F.transform(
        F.filter("items", lambda i: i.l_partkey % 2 == 0),
        lambda i: F.struct(
            i.l_returnflag.alias("value"), F.array(lo(i), lo(i) + F.lit(0.3) + i.l_tax).alias("between")
        ),
    )
    return df.select(
        "seg",
        F.col("seg").cast("string").alias("id"),
        F.lit("segment").alias("type"),
        "geometry",
        connectors.alias("connectors"),
        F.when(F.size(rules) > 0, rules).alias("rules"),
        *(["prohibited_transitions", "destinations"] if references else []),
    )


def connector_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = F.col("s_suppkey")
    return (
        spark.read.parquet(f"{sf_dir}/supplier.parquet")
        .filter(node % 7 != 3)
        .select(
            _name(node).alias("id"),
            F.lit("connector").alias("type"),
            F.array(F.struct(_x(node).alias("x"), _y(node).alias("y"))).alias("geometry"),
        )
    )


#: Orders with neighbouring numbers, in powers of two, that are kept together.
BLOCK_BITS = 8


def _by_block(items: DataFrame) -> DataFrame:
    """Rows by blocks of neighbouring roads; the first two roads of a block are in the block before as well."""
    block = F.shiftright("l_orderkey", BLOCK_BITS)
    first_two = F.col("l_orderkey").bitwiseAND((1 << BLOCK_BITS) - 1) < 2
    blocks = F.when(first_two, F.array(block, block - 1)).otherwise(F.array(block))
    return items.withColumn("block", F.explode(blocks)).repartition("block")


def with_turns(lines: DataFrame) -> DataFrame:
    """Lines by blocks with ``prohibited_transitions`` and ``destinations`` onto the next two roads.

    Roads are neighbours by number, and a block holds all neighbours of its own roads.
    """
    nodes = F.transform(_junctions(), lambda v: _name(v.i.l_suppkey))
    ahead = Window.partitionBy("block").orderBy("seg")
    met = bind(lines, nodes=nodes)
    road = F.struct("seg", "nodes")
    met = met.withColumns({"one": F.lead(road, 1).over(ahead), "two": F.lead(road, 2).over(ahead)})
    met = met.filter(F.shiftright("seg", BLOCK_BITS).eqNullSafe(F.col("block")))
    following = lambda by: F.when(F.col(by).seg == F.col("seg") + (1 if by == "one" else 2), F.col(by).nodes)
    met = bind(met, nodes1=following("one"), nodes2=following("two"))
    shared = lambda a, b: F.array_min(F.array_intersect(a, b))
    met = bind(met, first=shared("nodes", "nodes1"), second=shared("nodes1", "nodes2"))
    heading = F.when(F.col("seg") % 3 == 0, "forward").when(F.col("seg") % 3 == 1, "backward")
    final_heading = F.when(F.col("seg") % 2 == 0, "forward").otherwise("backward")

    def step(node: str, by: int) -> Column:
        return F.struct(
            F.col(node).alias("connector_id"), (F.col("seg") + by).cast("string").alias("segment_id")
        )

    through = (F.col("seg") % 5 == 0) & F.col("second").isNotNull()
    turn = F.struct(
        F.when(through, F.array(step("first", 1), step("second", 2))).otherwise(F.array(step("first", 1))).alias("sequence"),
        final_heading.alias("final_heading"),
        F.struct(heading.alias("heading")).alias("when"),
        F.lit(None).cast("array<double>").alias("between"),
    )
    destination = F.struct(
        F.array(F.struct(F.col("first").alias("value"), F.lit("street").alias("type"))).alias("labels"),
        F.lit(None).cast("array<string>").alias("symbols"),
        F.col("first").alias("from_connector_id"),
        (F.col("seg") + 1).cast("string").alias("to_segment_id"),
        pick(F.col("nodes1"), 0).alias("to_connector_id"),
        F.struct(heading.alias("heading")).alias("when"),
        final_heading.alias("final_heading"),
    )
    given = lambda item: F.when(F.col("first").isNotNull(), F.array(item))
    return met.withColumns({"prohibited_transitions": given(turn), "destinations": given(destination)})


def features(spark: SparkSession, sf_dir: str, references: bool = False) -> DataFrame:
    """The feature table; with ``references`` segments carry turns and destinations."""
    segments = line_features(spark, sf_dir, references)
    return segments.drop("seg").unionByName(connector_features(spark, sf_dir), allowMissingColumns=True)
