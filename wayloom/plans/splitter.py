"""The split from features to features, in one plan or stage by stage."""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayloom.functions.schema_walk import choose_columns, columns_holding
from wayloom.operators.bloom import DEFAULT_BITS, bits_for
from wayloom.operators.changes import Changes, changed_keys, same_columns, with_content_key
from wayloom.operators.cutting import FAILURES, added_connectors, explode_pieces, split_segments
from wayloom.operators.filters import spatial_filter
from wayloom.operators.layout import by_place
from wayloom.operators.network import connectors, join_connectors
from wayloom.operators.references import (
    DESTINATIONS,
    REFERS,
    RESOLVED_DESTINATIONS,
    RESOLVED_TURNS,
    TURNS,
    mark_referring,
    resolve_references,
)
from wayloom.operators.reports import observed, run_rows
from wayloom.plans.config import DEFAULT_CONFIG, SplitConfig
from wayloom.sources import manifests
from wayloom.sources.feature_io import FeatureIO, Stage, geometry_encoding, read_parquet, spread_scan, with_wkb, write_parquet

# Names of columns that a split makes; an input may not have them.
OWN_COLUMNS = frozenset(
    "start_lr end_lr metrics piece_no pieces joined_connectors added_connectors turn_restrictions refers cut_from is_success "
    "error_message length_before_split length_after_split length_diff original_self_intersecting".split()
)
#: Raised when lines are cut differently from before, so that no piece is taken from an older version.
CUT_RULES = 1
SPLIT_FIELDS = {"start_lr": "double", "end_lr": "double", "metrics": "map<string,string>"}


def lr_columns(features: DataFrame, config: SplitConfig = DEFAULT_CONFIG) -> list[str]:
    """Columns with linear references that this split cuts at and rescopes."""
    return choose_columns(
        columns_holding(features.schema), config.lr_columns_to_include, config.lr_columns_to_exclude
    )


def all_connectors(features: DataFrame, split: DataFrame) -> DataFrame:
    """Connectors of the input and the ones added at linear references."""
    added = added_connectors(split)
    if geometry_encoding(features) == "wkb":
        added = with_wkb(added)
    return connectors(features).unionByName(added, allowMissingColumns=True).select(*features.columns)


def assemble(features: DataFrame, pieces: DataFrame, split: DataFrame, references_seen: int | None = None) -> DataFrame:
    """Resolved pieces and all connectors in one table: the input's columns and three more.

    How many references the pieces hold, if that is known, sets the size of the filter for their targets.
    """
    bits = DEFAULT_BITS if references_seen is None else bits_for(references_seen)
    points = all_connectors(features, split)
    for column, resolved in ((TURNS, RESOLVED_TURNS), (DESTINATIONS, RESOLVED_DESTINATIONS)):
        if column in points.columns:
            points = points.withColumn(column, F.lit(None).cast(resolved))
    for column, kind in SPLIT_FIELDS.items():
        points = points.withColumn(column, F.lit(None).cast(kind))
    columns = [*features.columns, *SPLIT_FIELDS]
    if geometry_encoding(features) == "wkb":
        pieces = with_wkb(pieces)
    return resolve_references(pieces, bits=bits).select(*columns).unionByName(points.select(*columns))


def split_features(
    features: DataFrame,
    filter_wkt: str | None = None,
    config: SplitConfig = DEFAULT_CONFIG,
    split_path: str | None = None,
) -> DataFrame:
    """The whole split without named stages; suits small tables.

    Pieces, references and added connectors all come from the cut lines. Those are stored under
    ``split_path`` if it is given, so that lines are cut once; otherwise all is one lazy plan.
    """
    kept = spatial_filter(features, filter_wkt) if filter_wkt else features
    chosen = lr_columns(kept, config)
    split = split_segments(join_connectors(kept), chosen, config)
    if split_path:
        write_parquet(split, split_path)
        split = read_parquet(features.sparkSession, split_path)
    return assemble(kept, explode_pieces(split, chosen, config), split)


def split_network(
    spark: SparkSession,
    io: FeatureIO,
    filter_wkt: str | None = None,
    config: SplitConfig = DEFAULT_CONFIG,
    on_stage: Callable[[Stage, int], None] | None = None,
) -> DataFrame:
    """Split the features that ``io`` reads, keep every stage, and return the result.

    Each stage is read back from storage, so nothing is computed twice and a lost executor
    costs at most the tasks of one stage. Geometry is decoded once, where lines are cut. A stage is
    only reused if its files are all there and it came from the same input files, polygon and settings.
    Otherwise lines are cut anew only if they or their connectors changed: under the same settings the
    others, and their pieces, are taken from the version before (:class:`Changes`).
    If the input's files change while they are read, no stage made from them becomes current and
    RuntimeError is raised. ``on_stage`` hears how many rows each stage wrote; :func:`run_report` tells
    the rest of what was seen.
    """
    own = sorted(OWN_COLUMNS & set(io.read_stored(spark, Stage.read_input).columns))
    if own:
        raise ValueError(f"the input has columns that the split makes itself: {', '.join(own)}")
    chosen_settings = {k: v for k, v in vars(config).items() if k != "reuse_existing_intermediate_outputs"}
    state = io.input_state(spark)
    rules = {"cut_rules": CUT_RULES, **chosen_settings}
    settings = json.dumps([io.input_path, state, filter_wkt, rules], sort_keys=True)
    # Without keys nothing can be taken over; a hook's storage keeps only one version.
    keyed = not io.custom_write_hook

    def unchanged() -> None:
        if io.input_state(spark) != state:
            raise RuntimeError(f"files of {io.input_path} changed while they were read")

    def stage(
        name: Stage, make: Callable[[], DataFrame], partition_by: tuple[str, ...] = (), heavy: bool = False
    ) -> DataFrame:
        if not (config.reuse_existing_intermediate_outputs and io.check_exists(spark, name, settings)):
            df = make()
            with spread_scan(df) if heavy else nullcontext():
                store(name, df, partition_by)
        return io.read_stored(spark, name)

    def store(name: Stage, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        if io.custom_write_hook:
            # A hook may write later, or not at once.
            io.write(df, name, partition_by, settings)
            if on_stage:
                on_stage(name, io.read_stored(spark, name).count())
            return
        if io.by_place and name == Stage.final_output:
            df = by_place(df)
        df, seen = observed(df, name.value, FAILURES)

        def report() -> dict:
            told = seen()
            if name == Stage.raw_split:
                afresh = recut.get("cut", told["rows"])
                told["lines"] = {"cut": afresh, "taken": told["rows"] - afresh}
            return told

        io.write(df, name, partition_by, settings, report, unchanged if name in from_input else None)
        if on_stage:
            on_stage(name, report()["rows"])

    def version_before(name: Stage) -> manifests.Manifest | None:
        """The current version, if it is whole and follows the same rules, though maybe for other input."""
        found = io.manifest(spark, name) if keyed and config.reuse_existing_intermediate_outputs else None
        same = found is not None and found.settings.startswith("[") and json.loads(found.settings)[-1] == json.loads(settings)[-1]
        return found if same and manifests.is_whole(spark, found) else None

    def cut_lines() -> DataFrame:
        if lines_before is None:
            return split_segments(joined, chosen, config)
        stored = read_parquet(spark, lines_before.location)
        keys, seen = changed_keys(joined, stored)

        def fill(folder: str) -> dict:
            write_parquet(keys, folder)
            return dict(seen.get)

        found = manifests.add_version(spark, io.changes_path, fill, settings)
        changes = Changes(read_parquet(spark, found.location), found.rows)
        fresh = split_segments(changes.changed(joined), chosen, config)
        if not same_columns(stored, fresh):
            return split_segments(joined, chosen, config)
        recut.update(cut=found.report["cut"], changes=changes)
        return fresh.unionByName(changes.same(stored))

    def open_pieces() -> DataFrame:
        opened = lambda lines: mark_referring(explode_pieces(lines, chosen, config))
        # Pieces of the same run as the lines that stayed: the keys that changed are the same.
        kin = lines_before is not None and pieces_before is not None and lines_before.settings == pieces_before.settings
        if "changes" not in recut or not kin:
            return opened(split)
        stored = read_parquet(spark, pieces_before.location)
        changes = recut["changes"]
        fresh = with_wkb(opened(changes.changed(split)))  # as it is stored
        return fresh.unionByName(changes.same(stored)) if same_columns(stored, fresh) else opened(split)

    def source() -> DataFrame:
        return io.read_stored(spark, Stage.read_input)

    # Stages that read the input itself; later ones come from these.
    from_input = {Stage.spatial_filter} if filter_wkt is not None else {Stage.joined, Stage.final_output}
    features = source() if filter_wkt is None else stage(
        Stage.spatial_filter, lambda: spatial_filter(source(), filter_wkt)
    )
    chosen = lr_columns(features, config)
    recut: dict = {}
    lines_before, pieces_before = version_before(Stage.raw_split), version_before(Stage.segment_splits_exploded)
    joined = stage(
        Stage.joined, lambda: with_content_key(join_connectors(features)) if keyed else join_connectors(features)
    )
    split = stage(Stage.raw_split, cut_lines, heavy=True)
    # Laid out by whether a piece refers to others, so that resolving reads each row once.
    pieces = stage(
        Stage.segment_splits_exploded,
        open_pieces,
        partition_by=(REFERS,),
    )
    known = io.manifest(spark, Stage.segment_splits_exploded)
    store(Stage.final_output, assemble(features, pieces, split, known.report.get("references") if known else None))
    return io.read(spark, Stage.final_output)


def run_report(spark: SparkSession, io: FeatureIO) -> DataFrame:
    """What the last run saw while it wrote its stages, as rows of stage, report, key and value.

    ``rows`` of each stage; ``lines`` cut and taken over; ``lengths`` before and after, ``outcomes`` and ``splits`` for each segment;
    ``types`` and ``metrics`` of the result. Comes from the manifests; stages that hooks store have none.
    """
    found = {s.value: m.report for s in Stage if s != Stage.read_input and (m := io.manifest(spark, s))}
    cut_lines = io.read_stored(spark, Stage.raw_split) if Stage.raw_split.value in found else None
    rows = run_rows(found, cut_lines)
    return spark.createDataFrame(rows, "stage string, report string, key string, value bigint")
