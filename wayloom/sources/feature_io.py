"""Read and write the feature table and the stages of a split.

In memory a geometry is ``array<struct<x, y>>``; on disk it is well-known binary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from enum import Enum
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayloom.sources import manifests
from wayloom.sources.wkb import decode_wkb, encode_wkb

GEOMETRY = "geometry"

# How files are laid out.
COMPRESSION = "zstd"
ROW_GROUP_BYTES = 16 * 1024 * 1024
TASKS_PER_CORE = 4
#: Rows of a page of a column where rows lie by place: the least that a reader can skip.
PAGE_ROWS = 500


class Stage(Enum):
    """Stages of a split; values are fixed, they name the stored outputs."""

    read_input = "input"
    spatial_filter = "1_spatially_filtered"
    joined = "2_joined"
    raw_split = "3_raw_split"
    segment_splits_exploded = "4_segments_splits"
    final_output = "final"


ReadHook = Callable[[SparkSession, Stage, str], DataFrame]
ExistsHook = Callable[[SparkSession, Stage, str], bool]
WriteHook = Callable[[DataFrame, Stage, str], None]


class FeatureIO:
    """Where a split reads its features from and keeps its stages.

    Own hooks may replace all access; they come all three or not at all. A hook gets the
    input path for the input and the output prefix for every other stage. With ``by_place`` the result
    is stored in order of place, with a box for each row (``bbox``), for readers of small areas.
    """

    def __init__(
        self,
        input_path: str,
        output_path_prefix: str,
        custom_read_hook: ReadHook | None = None,
        custom_exists_hook: ExistsHook | None = None,
        custom_write_hook: WriteHook | None = None,
        by_place: bool = False,
    ):
        hooks = (custom_read_hook, custom_exists_hook, custom_write_hook)
        if any(hooks) and not all(hooks):
            raise AssertionError("hooks for reading, existence and writing must be given together")
        self.by_place = by_place
        self.input_path = input_path.rstrip("/")
        self.output_path_prefix = output_path_prefix.rstrip("/")
        self.custom_read_hook, self.custom_exists_hook, self.custom_write_hook = hooks

    def default_path_for_step(self, stage: Stage) -> str:
        if stage == Stage.read_input:
            return self.input_path
        return f"{self.output_path_prefix}_{stage.value}"

    @property
    def changes_path(self) -> str:
        """Where keys of changed lines are kept, which later runs don't need."""
        return f"{self.output_path_prefix}_changes"

    def _hook_path(self, stage: Stage) -> str:
        return self.input_path if stage == Stage.read_input else self.output_path_prefix

    def location(self, spark: SparkSession, stage: Stage) -> str:
        """Where the stage's rows lie now: the input itself, or a stage's current version."""
        path = self.default_path_for_step(stage)
        return path if stage == Stage.read_input else manifests.location(spark, path)

    def read(self, spark: SparkSession, stage: Stage) -> DataFrame:
        df = self.read_stored(spark, stage)
        return df if stage == Stage.raw_split else with_coordinates(df)

    def read_stored(self, spark: SparkSession, stage: Stage) -> DataFrame:
        """As :meth:`read`, with geometry left in the form it is stored in.

        A stage is read from the version that is current now, whatever is written later.
        """
        if self.custom_read_hook:
            df = self.custom_read_hook(spark, stage, self._hook_path(stage))
        else:
            # Files of the input may differ in their columns; a stage's own files don't.
            merge = stage == Stage.read_input
            df = read_parquet(spark, self.location(spark, stage), merge)
        return df if stage == Stage.raw_split else with_valid_geometry(df)

    def input_state(self, spark: SparkSession) -> str:
        """What the input's files are at this moment; empty if a hook reads it."""
        return "" if self.custom_read_hook else manifests.input_digest(spark, self.input_path)

    def check_exists(self, spark: SparkSession, stage: Stage, settings: str = "") -> bool:
        """Whether the stage is whole and was made with the same settings; a hook decides by itself."""
        if self.custom_exists_hook:
            return self.custom_exists_hook(spark, stage, self.output_path_prefix)
        found = manifests.current(spark, self.default_path_for_step(stage))
        return manifests.is_whole(spark, found, settings)

    def manifest(self, spark: SparkSession, stage: Stage) -> manifests.Manifest | None:
        """What is known of the stage's current version; nothing if hooks store it."""
        return None if self.custom_write_hook else manifests.current(spark, self.default_path_for_step(stage))

    def write(
        self,
        df: DataFrame,
        stage: Stage,
        partition_by: tuple[str, ...] = (),
        settings: str = "",
        observed: Callable[[], dict[str, Any]] | None = None,
        check: Callable[[], None] | None = None,
    ) -> None:
        """Store a stage as a new version; ``observed`` tells afterwards what was seen of its rows."""
        if self.custom_write_hook:
            self.custom_write_hook(df, stage, self.output_path_prefix)
            return

        def fill(folder: str) -> dict[str, Any] | None:
            if stage == Stage.raw_split:
                write_parquet(df, folder, partition_by)
            else:
                small_pages = {"parquet.page.row.count.limit": PAGE_ROWS} if self.by_place and stage == Stage.final_output else {}
                write_features(df, folder, partition_by, **small_pages)
            return observed() if observed else None

        manifests.add_version(df.sparkSession, self.default_path_for_step(stage), fill, settings, check=check)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A Parquet table; with ``merge_schema`` its files may have different columns."""
    reader = spark.read.format("parquet")
    return (reader.option("mergeSchema", True) if merge_schema else reader).load(path)


def read_features(
    spark: SparkSession, path: str, merge_schema: bool = True, geometry_column: str = GEOMETRY
) -> DataFrame:
    """Features from Parquet; GeoParquet files are Parquet files with a binary geometry."""
    return with_coordinates(read_parquet(spark, path, merge_schema), geometry_column)


def geometry_encoding(df: DataFrame, geometry_column: str = GEOMETRY) -> str | None:
    """``wkb``, ``coords``, or None where the column is missing or of another type."""
    found = next((f.dataType for f in df.schema if f.name == geometry_column), None)
    if isinstance(found, T.BinaryType):
        return "wkb"
    if isinstance(found, T.ArrayType) and isinstance(found.elementType, T.StructType):
        return "coords" if set(found.elementType.names) >= {"x", "y"} else None
    return None


def has_coordinates(spark: SparkSession, path: str, geometry_column: str = GEOMETRY) -> bool:
    """Stored geometry needs no decoding; anything unreadable means no."""
    try:
        return geometry_encoding(read_parquet(spark, path), geometry_column) == "coords"
    except AnalysisException:
        return False


def with_valid_geometry(df: DataFrame, geometry_column: str = GEOMETRY) -> DataFrame:
    if geometry_encoding(df, geometry_column) is None:
        raise ValueError(f"the features need a column `{geometry_column}` of binary or coordinates")
    return df


def coordinates(df: DataFrame, geometry_column: str = GEOMETRY) -> Column:
    """The geometry as coordinates, decoded only where it is stored as binary."""
    column = F.col(geometry_column)
    stored = geometry_encoding(with_valid_geometry(df, geometry_column), geometry_column)
    return column if stored == "coords" else decode_wkb(column)


def with_coordinates(df: DataFrame, geometry_column: str = GEOMETRY) -> DataFrame:
    if geometry_encoding(df, geometry_column) == "coords":
        return df
    return df.withColumn(geometry_column, coordinates(df, geometry_column))


def with_wkb(df: DataFrame, geometry_column: str = GEOMETRY) -> DataFrame:
    if geometry_encoding(df, geometry_column) == "coords":
        return df.withColumn(geometry_column, encode_wkb(F.col(geometry_column)))
    return df


def write_features(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), **options: Any) -> None:
    write_parquet(with_wkb(df), path, partition_by, **options)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), **options: Any) -> None:
    writer = (
        df.write.mode("overwrite")
        .options(**options)
        .option("compression", COMPRESSION)
        .option("parquet.block.size", ROW_GROUP_BYTES)
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


@contextmanager
def spread_scan(df: DataFrame) -> Iterator[None]:
    """Plan the scans of a heavy stage with a few tasks for each core.

    Cutting lines takes far more time per byte than reading them. So a small input is dealt over all
    cores, down to one row group for each task; a large one keeps the session's task size.
    """
    spark, name = df.sparkSession, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    usual = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    stored = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    even = stored // (TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    spark.conf.set(name, str(min(usual, max(even, ROW_GROUP_BYTES))))
    try:
        yield
    finally:
        spark.conf.set(name, before)
