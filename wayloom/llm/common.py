"""What several operators of this subpackage share: scratch tables, folds, small Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayloom.operators.skew import salted_join

#: Most rows of a narrow table that is sent to all tasks: about 50 MB of keys and values.
BROADCAST_ROWS = 500_000
#: What the contracts call white space: a blank and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which the whole cluster shares.

    A local session without that setting gets a folder of its own, and keeps it as the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="wayloom-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """The rows written as a table and read back: they are computed once and outlive executors."""
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def join_few(left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[Column]) -> DataFrame:
    """Left join with a table that has one row for each key; no row is lost.

    A small table is sent to all tasks; a larger one is joined by shuffling, with the rows of keys that
    hold more than an even share dealt over several tasks.
    """
    if right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, "left")
    return salted_join(left, right, keys, "left", spread_by)


def join_by_label(rows: DataFrame, per_label: DataFrame, label: str, spread_by: str = "vec_id") -> DataFrame:
    """Each row with the columns of its label's one row; null labels meet as well."""
    keys = {"_absent": F.col(label).isNull(), "_key": F.coalesce(F.col(label).cast("string"), F.lit(""))}
    left, right = rows.withColumns(keys), per_label.withColumns(keys).drop(label)
    return join_few(left, right, [*keys], [F.col(spread_by)]).drop(*keys)


def fold(key: str | Column, modulus: int) -> Column:
    """crc32 of the key's text modulo `modulus`; a null key counts as an empty text."""
    c = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def give_back_memory() -> None:
    """Return what a finished task has freed to the system: its Python worker lives on and serves other stages."""
    gc.collect()
    trim_memory()


def trim_memory() -> None:
    """Return freed pages to the system: many short texts leave holes that the allocator would keep."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def give_back_heaps(spark: SparkSession) -> None:
    """Let the executors collect their heaps, which returns what earlier stages left there: pages once touched stay otherwise.

    As many tasks as there are cores, so that every executor gets some; they read and write nothing.
    """
    tasks = spark.sparkContext.defaultParallelism
    collected = F.java_method(F.lit("java.lang.System"), F.lit("gc"))
    spark.range(0, tasks, 1, tasks).select(collected.alias("done")).write.format("noop").mode("overwrite").save()


def giving_back(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A task over batches that returns its memory at its end."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back_memory()

    return task


def giving_back_group(run: Callable[[pa.Table], pa.Table], least_bytes: int = 4 << 20) -> Callable:
    """A task over one group that returns its memory after groups of some size."""

    def task(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            if table.nbytes >= least_bytes:
                give_back_memory()

    return task


def giving_back_cogroup(run: Callable[[pa.Table, pa.Table], pa.Table], least_bytes: int = 4 << 20) -> Callable:
    """As :func:`giving_back_group`, over one group of two tables."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            if left.nbytes + right.nbytes >= least_bytes:
                give_back_memory()

    return task


def row_batches(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that none holds much more than `most_bytes`; one row may still be longer.

    What the work on a cut has freed is returned before the next one.
    """
    for batch in batches:
        n = batch.num_rows
        step = max(1, n * most_bytes // max(1, batch.nbytes))
        for at in range(0, n, step):
            yield batch.slice(at, step)
            trim_memory()


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
