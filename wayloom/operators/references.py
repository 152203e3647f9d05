"""Point turn restrictions and destinations at pieces instead of whole segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayloom.functions.binding import let, none_if_empty, pick
from wayloom.operators.bloom import DEFAULT_BITS, bloom_filter, may_be_in
from wayloom.operators.skew import salted_join

TURNS = "prohibited_transitions"
DESTINATIONS = "destinations"
TURN_REFERENCES = "turn_restrictions"

# Types of the two resolved columns.
RESOLVED_TURNS = (
    "array<struct<"
    "sequence:array<struct<connector_id:string,segment_id:string,start_lr:double,end_lr:double>>,"
    "final_heading:string,"
    "when:struct<heading:string,during:string,using:array<string>,recognized:array<string>,"
    "mode:array<string>,vehicle:array<struct<dimension:string,comparison:string,value:double,unit:string>>>,"
    "between:array<double>>>"
)
RESOLVED_DESTINATIONS = (
    "array<struct<"
    "labels:array<struct<value:string,type:string>>,symbols:array<string>,"
    "from_connector_id:string,to_segment_id:string,to_segment_start_lr:double,to_segment_end_lr:double,"
    "to_connector_id:string,when:struct<heading:string>,final_heading:string>>"
)


def resolved_type(ddl: str) -> T.DataType:
    return T._parse_datatype_string(ddl)


def _heading(scoped: Column, item_type: T.StructType) -> Column:
    """``when.heading`` or empty text; the field itself may be missing from the schema."""
    when = next((f.dataType for f in item_type if f.name == "when"), None)
    if not isinstance(when, T.StructType) or "heading" not in when.names:
        return F.lit("")
    return F.coalesce(scoped["when"]["heading"], F.lit(""))


def _entered_by(connectors: Column, heading: Column, connector_id: Column) -> Column:
    """A piece with two ends has the connector at the end its heading leads to."""
    first, second = pick(connectors, 0).connector_id, pick(connectors, 1).connector_id
    return (
        (F.size(connectors) == 2)
        & ((heading != "forward") | (second == connector_id))
        & ((heading != "backward") | (first == connector_id))
        & ((first == connector_id) | (second == connector_id))
    )


def prune_turns(turns: Column, turns_type: T.ArrayType, connectors: Column) -> Column:
    """Turns that start at this piece; null if none does."""
    return none_if_empty(
        F.filter(
            turns,
            lambda t: (F.size(t.sequence) > 0)
            & _entered_by(connectors, _heading(t, turns_type.elementType), pick(t.sequence, 0).connector_id),
        )
    )


def prune_destinations(destinations: Column, destinations_type: T.ArrayType, connectors: Column) -> Column:
    """Destinations signposted from this piece; null if none is."""

    def holds(d: Column) -> Column:
        heading = _heading(d, destinations_type.elementType)
        return (heading != "") & (d.from_connector_id != "") & _entered_by(connectors, heading, d.from_connector_id)

    return none_if_empty(F.filter(destinations, holds))


def turn_references(turns: Column) -> Column:
    """All sequence items of a piece's turns in one flat array."""

    def item(t: Column, tr: Column, s: Column, i: Column) -> Column:
        return F.struct(
            tr.cast("int").alias("tr_index"),
            i.cast("int").alias("sequence_index"),
            s.segment_id.alias("segment_id"),
            s.connector_id.alias("connector_id"),
            pick(t.sequence, i + 1).connector_id.alias("next_connector_id"),
            t.final_heading.alias("final_heading"),
        )

    return F.flatten(
        F.transform(turns, lambda t, tr: F.transform(t.sequence, lambda s, i: item(t, tr, s, i)))
    )


def reference_items(pieces: DataFrame, turns: bool = True, destinations: bool = True) -> DataFrame:
    """One row per turn sequence item and per destination, with the piece that carries it.

    A destination looks like the last item of a turn.
    """

    def entry(kind: str, item: Column, step: Column, segment: Column, at: Column, then: Column, heading: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            item.alias("item"),
            step.alias("step"),
            segment.alias("segment_id"),
            at.alias("connector_id"),
            then.alias("next_connector_id"),
            heading.alias("final_heading"),
        )

    def turn(r: Column) -> Column:
        return entry(TURNS, r.tr_index, r.sequence_index, r.segment_id, r.connector_id, r.next_connector_id, r.final_heading)

    def destination(d: Column, i: Column) -> Column:
        nothing = F.lit(None).cast("string")
        return entry(DESTINATIONS, i, F.lit(0), d.to_segment_id, d.to_connector_id, nothing, d.final_heading)

    lists = [F.transform(TURN_REFERENCES, turn)] if turns else []
    lists += [F.transform(DESTINATIONS, destination)] if destinations else []
    return pieces.select("id", "piece_no", F.explode(F.concat(*[F.coalesce(x, F.array()) for x in lists])).alias("r")).select(
        "id", "piece_no", "r.*"
    )


def piece_ends(pieces: DataFrame) -> DataFrame:
    """One row per piece and connector on it, by the segment it came from."""
    ids = F.transform("connectors", lambda c: c.connector_id)
    return pieces.select(
        F.col("id").alias("segment_id"), "start_lr", "end_lr", ids.alias("piece_connectors"), F.posexplode(ids).alias("position", "connector_id")
    )


def referenced_pieces(pieces: DataFrame, items: DataFrame) -> DataFrame:
    """Only pieces of segments that some item refers to."""
    referenced = items.select(F.col("segment_id").alias("id"))
    return pieces.join(referenced, "id", "left_semi")


def referenced_ends(pieces: DataFrame, items: DataFrame, bits: int = DEFAULT_BITS) -> DataFrame:
    """Piece ends that some item may refer to: nearly all others are dropped where they are read."""
    key = ["segment_id", "connector_id"]
    found = bloom_filter(items, key, bits)
    return piece_ends(pieces).filter(may_be_in(found, [F.col(c) for c in key], bits))


def match_items(
    items: DataFrame, pieces: DataFrame, rows_per_task: int | None = None, bits: int = DEFAULT_BITS
) -> DataFrame:
    """Items with ``ref_start_lr, ref_end_lr`` of the piece they mean; unmatched ones drop out.

    A last item (or destination) heading forward enters a piece at its first connector,
    otherwise at its second. An item in the middle means the piece holding both its
    connector and the next one. Segment and connector together form the join key, so an
    item meets only the few pieces around its connector, never all of the segment; items
    are salted because many may share one target. A Bloom filter of the keys keeps pieces that
    nothing refers to from being shuffled.
    """
    last = F.col("next_connector_id").isNull()
    entry = F.when(F.coalesce(F.col("final_heading") == "forward", F.lit(False)), 0).otherwise(1)
    through = F.exists("piece_connectors", lambda c: c == F.col("next_connector_id"))
    return salted_join(
        items,
        referenced_ends(pieces, items, bits),
        ["segment_id", "connector_id"],
        "inner",
        spread_by=[F.col(c) for c in ("id", "piece_no", "kind", "item", "step")],
        condition=(last & (F.col("position") == entry)) | (~last & through),
        rows_per_task=rows_per_task,
    ).select(*items.columns, F.col("start_lr").alias("ref_start_lr"), F.col("end_lr").alias("ref_end_lr"))


def gather_matches(matches: DataFrame) -> DataFrame:
    """Matches per referring piece, sorted; no more than its own items have candidates."""
    match = F.struct("kind", "item", "step", "ref_start_lr", "ref_end_lr")
    return matches.groupBy("id", "piece_no").agg(F.sort_array(F.collect_list(match)).alias("_matches"))


def write_turns(turns: Column, turns_type: T.ArrayType, matches: Column) -> Column:
    """Turns whose every item has a piece, with its range in the item; null if none has.

    Of several pieces that fit one item the first along the segment is taken.
    """
    target = resolved_type(RESOLVED_TURNS).elementType
    step_type = target["sequence"].dataType.elementType
    source = turns_type.elementType
    source_step = source["sequence"].dataType.elementType

    def found(i: Column, j: Column) -> Column:
        return pick(F.filter(matches, lambda m: (m.kind == TURNS) & (m.item == i) & (m.step == j)), 0)

    def steps(t: Column, i: Column) -> Column:
        return F.transform(
            t.sequence,
            lambda s, j: let(
                found(i, j),
                lambda m: conform(s, source_step, step_type, start_lr=m.ref_start_lr, end_lr=m.ref_end_lr),
            ),
        )

    written = F.transform(turns, lambda t, i: conform(t, source, target, sequence=steps(t, i)))
    return none_if_empty(F.filter(written, lambda t: F.forall(t.sequence, lambda s: s.start_lr.isNotNull())))


def write_destinations(destinations: Column, destinations_type: T.ArrayType, matches: Column) -> Column:
    """Each destination once per piece it leads to, with that piece's range; null if none."""
    target = resolved_type(RESOLVED_DESTINATIONS).elementType
    source = destinations_type.elementType

    def per_match(d: Column, i: Column) -> Column:
        return F.transform(
            F.filter(matches, lambda m: (m.kind == DESTINATIONS) & (m.item == i)),
            lambda m: conform(d, source, target, to_segment_start_lr=m.ref_start_lr, to_segment_end_lr=m.ref_end_lr),
        )

    return none_if_empty(F.flatten(F.transform(destinations, per_match)))


def resolve_references(
    pieces: DataFrame,
    turns: bool = True,
    destinations: bool = True,
    rows_per_task: int | None = None,
    bits: int = DEFAULT_BITS,
) -> DataFrame:
    """Write the pieces that turns and destinations refer to into both columns.

    Only narrow items travel to find their pieces, and of pieces only the ends that may be meant;
    ``bits`` is the size of the filter that tells, ten for each item or more. Where stored pieces are laid out by whether
    they refer to others, only those that do are shuffled to get the answers back; all others
    pass straight through.
    """
    turns = turns and TURN_REFERENCES in pieces.columns
    destinations = destinations and DESTINATIONS in pieces.columns
    if not turns and not destinations:
        return pieces
    laid_out = REFERS in pieces.columns
    referring = pieces.filter(F.col(REFERS) == 1) if laid_out else pieces
    items = reference_items(referring, turns, destinations)
    matches = gather_matches(match_items(items, pieces, rows_per_task, bits))
    both = referring.join(matches, ["id", "piece_no"], "left")
    if laid_out:
        nothing = F.lit(None).cast(both.schema["_matches"].dataType)
        both = both.unionByName(pieces.filter(F.col(REFERS) != 1).withColumn("_matches", nothing))
    if turns:
        both = both.withColumn(TURNS, write_turns(F.col(TURNS), pieces.schema[TURNS].dataType, F.col("_matches")))
    if destinations:
        both = both.withColumn(
            DESTINATIONS,
            write_destinations(F.col(DESTINATIONS), pieces.schema[DESTINATIONS].dataType, F.col("_matches")),
        )
    return both.drop("_matches")


# Marks pieces that carry references, so that stored pieces can be laid out by it.
REFERS = "refers"


def mark_referring(pieces: DataFrame) -> DataFrame:
    """Add a column that is 1 for pieces with turns or destinations, else 0."""
    refers = F.lit(False)
    for column in (TURN_REFERENCES, DESTINATIONS):
        if column in pieces.columns:
            refers = refers | F.coalesce(F.size(column) > 0, F.lit(False))
    return pieces.withColumn(REFERS, refers.cast("int"))


def conform(value: Column, source: T.DataType, target: T.DataType, **given: Column) -> Column:
    """Rebuild a value as another type by field name; missing fields are null."""
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return F.transform(value, lambda e: conform(e, source.elementType, target.elementType))
    if not (isinstance(target, T.StructType) and isinstance(source, T.StructType)):
        return value.cast(target)
    fields = []
    for f in target:
        if f.name in given:
            made = given[f.name]
        elif f.name in source.names:
            made = conform(value[f.name], source[f.name].dataType, f.dataType)
        else:
            made = F.lit(None).cast(f.dataType)
        fields.append(made.alias(f.name))
    return F.when(value.isNotNull(), F.struct(*fields))
