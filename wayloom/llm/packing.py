"""Best-fit decreasing packing of whole documents into windows of a fixed number of tokens.

Documents longer than a window are first cut into full windows; what is left is packed. Best-fit
decreasing looks at lengths only, and there are at most `window` of them. So the pass over the
corpus counts lengths, the planner packs the *histogram* (items of one length, and open windows with
the same content, are handled as groups), and each piece finds its place from its length and its
rank among the pieces of that length. The result is that of best-fit decreasing over all pieces at
once, but no task and no driver holds more than one row for each length and partition.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayloom.llm.common import give_back_memory, row_batches, scratch, stored, text_of
from wayloom.llm.tokens import byte_bpe, default_paths

WINDOW = 1024
END_ID = 0


class CapacityTree:
    """Segment tree over remaining capacities: which have open windows, and the least at or above a size."""

    def __init__(self, largest: int) -> None:
        self.leaves = 1
        while self.leaves <= largest:
            self.leaves *= 2
        self.some = [False] * (2 * self.leaves)

    def mark(self, capacity: int, some: bool) -> None:
        i = capacity + self.leaves
        self.some[i] = some
        while i > 1:
            i //= 2
            self.some[i] = self.some[2 * i] or self.some[2 * i + 1]

    def tightest(self, size: int) -> int | None:
        i = size + self.leaves
        if self.some[i]:
            return size
        while i > 1:
            if i % 2 == 0 and self.some[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.some[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Places for `counts[length]` pieces of each length.

    Rows (length, first rank, pieces a window, windows, first window, offset), by length and rank: the
    pieces of that length from that rank on fill so many windows one after the other, each with so
    many pieces, from that offset on. At most a few groups arise for each length.
    """
    tree, open_groups = CapacityTree(window), defaultdict(list)

    def put(windows: int, used: int, content: list[tuple[int, int, int, int]]) -> None:
        if windows:
            open_groups[window - used].append((windows, content))
            tree.mark(window - used, True)

    def part(content: list[tuple[int, int, int, int]], skip: int) -> list[tuple[int, int, int, int]]:
        return [(size, rank + skip * each, each, offset) for size, rank, each, offset in content]

    for size in sorted((s for s in counts if counts[s]), reverse=True):
        left, rank = counts[size], 0
        while left:
            capacity = tree.tightest(size)
            if capacity is None:
                capacity, windows, content = window, -(-left // (window // size)), []
            else:
                windows, content = open_groups[capacity].pop(0)
                tree.mark(capacity, bool(open_groups[capacity]))
            each, used = capacity // size, window - capacity
            full = min(windows, left // each)
            put(full, used + each * size, [*content, (size, rank, each, used)])
            rank, left = rank + full * each, left - full * each
            if full < windows and left:
                put(1, used + left * size, [*part(content, full), (size, rank, left, used)])
                rank, left, full = rank + left, 0, full + 1
            if content:
                put(windows - full, used, part(content, full))
    rows, first = [], 0
    for groups in open_groups.values():
        for windows, content in groups:
            rows += [(size, rank, each, windows, first, offset) for size, rank, each, offset in content]
            first += windows
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " _part int, _rank bigint, ids binary"
)


def cut(docs: DataFrame, window: int, paths: tuple[str, str], with_ids: bool) -> DataFrame:
    """Pieces of all documents, with their rank among the task's pieces of that length."""

    def pieces_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = byte_bpe(*paths), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, dtype=np.int64)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in row_batches(batches, 1 << 20):
            rows = []
            encoded = encoder.batch_ids(batch.column(1).to_pylist())
            for doc, own in zip(batch.column(0).to_pylist(), encoded, strict=True):
                data = own.tobytes() + end
                total = len(data) // 4
                for start in range(0, total, window):
                    ids = data[4 * start : 4 * (start + window)]
                    n = len(ids) // 4
                    rows.append((doc, start, n, zlib.crc32(ids), total, part, seen[n], ids if with_ids else None))
                    seen[n] += 1
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            kinds = [*[pa.int64()] * 5, pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_part", "_rank", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from pieces_of(batches)
        finally:
            # Encoder and chunks would stay in the worker through all later stages.
            byte_bpe.cache_clear()
            give_back_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, PIECES)


def pack(
    docs: DataFrame, window: int = WINDOW, paths: tuple[str, str] | None = None, with_ids: bool = True
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    Every row of `docs` is a document of its own, whatever its doc_id (null and repeated ids stay as
    they are). A null or empty text has the end id alone. `ids` holds little-endian unsigned 32-bit
    ids. Other columns of `docs` are not looked at. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    base = scratch(spark)
    pieces = stored(cut(docs, window, paths or default_paths(), with_ids), f"{base}/pieces")
    # One row for each task and length.
    tasks = pieces.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    tasks = stored(tasks, f"{base}/tasks")
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    places = plan(counts, window)
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = tasks.select("_part", "length", F.coalesce(before, F.lit(0)).alias("_before"))
    ranked = pieces.join(firsts, ["_part", "length"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_rank", *["ids"] * with_ids]
    ranked = ranked.select(*kept)
    shape = ranked.drop("_rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride = int(places[:, 1].max()) + int(max(counts.values(), default=0)) + 1 if len(places) else 1
        keys = places[:, 0] * stride + places[:, 1]
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            row = places[np.searchsorted(keys, size * stride + rank, side="right") - 1]
            at = rank - row[:, 1]
            columns = {c: batch.column(c) for c in batch.schema.names if c != "_rank"}
            columns["sequence_id"] = pa.array(row[:, 4] + at // row[:, 2])
            columns["offset"] = pa.array(row[:, 5] + at % row[:, 2] * size)
            yield pa.RecordBatch.from_pydict(columns)

    return ranked.mapInArrow(run, shape)


def padded_length(filled: Column | str) -> Column:
    """Tokens of a stored sequence: a power of two stays as it is, everything else goes to WINDOW."""
    n = F.col(filled) if isinstance(filled, str) else filled
    return F.when(n.bitwiseAND(n - 1) == 0, n).otherwise(F.lit(WINDOW))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed windows themselves: sequence_id, filled, padded, ids (padded with END_ID)."""
    grouped = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("filled"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
    )
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    padded = padded_length("filled")
    filled_up = F.rpad(joined, (4 * padded).cast("int"), F.lit(b"\0"))
    return grouped.select("sequence_id", "filled", padded.alias("padded"), filled_up.alias("ids"))
