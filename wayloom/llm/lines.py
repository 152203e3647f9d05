"""Lines that occur in many documents are dropped from all of them, by levelled sorted runs of line hashes.

The corpus comes in batches. Each batch gives a run: its distinct line hashes in order, with the
number of documents that have them. Runs are stored in levels; FANOUT runs of a level are merged
into one run of the next (`LineRuns`). Once all batches have added their runs, the batches' lines are
merge-joined with the runs' frequent hashes, and each document loses the lines found there.
Hashes have 128 bits. Line hashes, counts and dropped lists are shuffled, all of them combined
before; texts move once, to meet their dropped lines.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayloom.llm.common import SPACE, giving_back, row_batches, scratch, stored, text_of

BATCHES = 4
FANOUT = 3
_SPACE = SPACE.encode()


def keys_of(text: str, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text in UTF-8, and the 128-bit hash of each line's key; None for keys below `min_chars`."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    keys = [line.strip(_SPACE).lower() for line in lines]
    # Bytes that don't continue a character are its code points.
    long = (lambda k: len(k) >= min_chars) if min_chars <= 1 else (lambda k: len(k.decode("utf-8", "replace")) >= min_chars)
    return lines, [xxhash.xxh3_128_digest(k) if long(k) else None for k in keys]


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """_d1, _d2 (hash of the text) and h1, h2 (hash of a key), each key once for each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            found: list[bytes] = []
            sizes = []
            for text in batch.column(2).to_pylist():
                own = {h for h in keys_of(text, min_chars)[1] if h}
                found.extend(own)
                sizes.append(len(own))
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(halves[:, i].copy()) for i in (0, 1))],
                ["_d1", "_d2", "h1", "h2"],
            )

    rows = docs.select(*_text_hash(), text_of().alias("text"))
    return rows.mapInArrow(giving_back(run), "_d1 bigint, _d2 bigint, h1 bigint, h2 bigint")


def _text_hash() -> list:
    return [F.xxhash64(text_of()).alias("_d1"), F.xxhash64(F.lit("second"), text_of()).alias("_d2")]


class LineRuns:
    """Stored runs (h1, h2, n) in order of their hashes, by level."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT) -> None:
        self.spark, self.path, self.fanout, self.made = spark, path, fanout, 0
        self.levels: list[list[DataFrame]] = []

    def _store(self, counts: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.made += 1
        ordered = counts.sortWithinPartitions("h1", "h2")
        self.levels[level].append(stored(ordered, f"{self.path}/level{level}-{self.made}"))

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def add(self, hashes: DataFrame) -> None:
        """A batch adds its run; a full level is compacted into the next."""
        self._store(hashes.groupBy("h1", "h2").agg(F.count("*").alias("n")), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._store(self._merged(runs), level + 1)
            level += 1

    def frequent(self, least: int) -> DataFrame:
        """h1, h2 of the lines that at least so many documents have, over all runs."""
        runs = [run for level in self.levels for run in level]
        return self._merged(runs).where(F.col("n") >= least).select("h1", "h2")


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = BATCHES) -> DataFrame:
    """doc (all columns of the row), kept (its text without the dropped lines), n_lines and n_dropped.

    A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of at
    least `min_chars` code points that at least `min_docs` rows have lose all their lines everywhere. Every
    row counts as a document of its own, repeated rows and ids included. A null or empty text has
    one empty line. Columns of any name are carried in `doc`. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    base = scratch(spark)
    hashes = line_hashes(docs, min_chars).withColumn("_batch", F.pmod("_d1", F.lit(batches)).cast("int"))
    hashes.write.partitionBy("_batch").parquet(f"{base}/lines")
    lines = spark.read.schema(hashes.schema).parquet(f"{base}/lines")
    runs = LineRuns(spark, f"{base}/runs")
    for i in range(batches):
        runs.add(lines.where(F.col("_batch") == i))
    frequent = stored(runs.frequent(min_docs), f"{base}/frequent")
    hits = lines.join(frequent, ["h1", "h2"])
    dropped = hits.groupBy("_d1", "_d2").agg(F.collect_set(F.struct("h1", "h2")).alias("_drop"))
    dropped = stored(dropped, f"{base}/dropped")
    rows = docs.select(F.struct("*").alias("doc"), *_text_hash(), text_of().alias("_text"))
    joined = rows.join(dropped, ["_d1", "_d2"], "left")
    joined = joined.select("doc", "_text", F.col("_drop.h1").alias("_h1"), F.col("_drop.h2").alias("_h2"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            out: list[tuple[str, int, int]] = []
            for text, one, two in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if not one:
                    out.append((text, text.count("\n") + 1, 0))
                    continue
                gone = np.array([one, two], dtype="<i8").T.tobytes()
                gone = {gone[i : i + 16] for i in range(0, len(gone), 16)}
                lines, keys = keys_of(text, min_chars)
                kept = [line for line, key in zip(lines, keys, strict=True) if key not in gone]
                out.append((b"\n".join(kept).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(kept)))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc", "kept", "n_lines", "n_dropped"],
            )

    shape = rows.select("doc").schema.add("kept", "string").add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(giving_back(run), shape)
