"""Vector code compression: codebooks by Lloyd's rounds that compare only what may have changed.

A vector of whole numbers is cut into equal parts; each part is stored as the index of its nearest
codebook entry. After an update only some entries have moved. A part whose own entry stayed keeps an
exact distance, so no entry that stayed can beat it: it meets the moved entries alone. A part whose own
entry moved meets all entries. Ties go to the lower index throughout, so every round equals a full scan.

Rows carry their state (indices, distances) from one written table to the next. What the driver holds
is the codebooks: parts x entries x width numbers at any number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import drop_folder, join_by_label, scratch, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Rows compared at a time: a matrix of rows x entries numbers.
CHUNK = 4096
#: A distance that no long holds; the part is then compared with all entries.
UNKNOWN = -1
MOST = 2**63 - 1


@dataclass(frozen=True)
class Compressed:
    """``codes``: vec_id, label, code array<int>, error long; ``codebooks``: parts x entries x width."""

    codes: DataFrame
    codebooks: np.ndarray
    evaluated: list[int]
    """Distances computed by each assignment; the first one is a full scan."""

    def codebooks_sha256(self) -> str:
        """Of all whole-numbered components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and v = floor(scale * x); rows with a null vector or a null or non-finite part are left out."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return rows.where(F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform(x, lambda e: F.floor(e * scale)).alias("v")
    )


def matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Lists as rows of one length, filled up with zeros."""
    lengths = np.asarray(vectors.value_lengths())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances: through doubles where those hold every step, else by unbounded whole numbers."""
    most = max((abs(int(f(a))) for a in (x, book) if a.size for f in (np.min, np.max)), default=0)
    if 4 * x.shape[1] * most**2 < 2**52:
        a, b = x.astype(float), book.astype(float)
        return ((a**2).sum(1)[:, None] - 2 * (a @ b.T) + (b**2).sum(1)).astype(np.int64)
    a, b = x.astype(object), book.astype(object)
    return np.array([[((r - e) ** 2).sum() for e in b] for r in a], dtype=object).reshape(len(x), len(book))


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the lowest index of the least distance, and that distance."""
    found = [distances(x[at : at + CHUNK], book) for at in range(0, len(x), CHUNK)]
    return np.concatenate([d.argmin(1) for d in found]), np.concatenate([d.min(1) for d in found])


def reassign(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entries after an update, from the ones before; and how many distances that took.

    `moved` marks entries that changed; `code` is -1 and `dist` UNKNOWN where nothing is known.
    """
    stayed = (dist != UNKNOWN) & ~moved[code]
    entries = np.flatnonzero(moved)
    evaluated = int((~stayed).sum()) * len(book) + int(stayed.sum()) * len(entries)
    code, dist = code.copy(), dist.copy()
    if not stayed.all():
        code[~stayed], least = nearest(x[~stayed], book)
        dist = dist.astype(np.result_type(dist, least))
        dist[~stayed] = least
    if len(entries) and stayed.any():
        found, least = nearest(x[stayed], book[entries])
        found = entries[found]
        better = (least < dist[stayed]) | ((least == dist[stayed]) & (found < code[stayed]))
        rows = np.flatnonzero(stayed)[better]
        dist = dist.astype(np.result_type(dist, least))
        code[rows], dist[rows] = found[better], least[better]
    return code, dist, evaluated


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays((np.arange(n + 1) * width).astype(np.int32), pa.array(values.ravel(), kind))


def _assigned(state: DataFrame, books: np.ndarray, moved: np.ndarray) -> DataFrame:
    """The state with each part at its nearest entry."""
    parts, _, width = books.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = matrix(batch.column("v"), parts * width)
            code = matrix(batch.column("code"), parts).astype(np.int64)
            dist = matrix(batch.column("dist"), parts)
            evaluated = 0
            codes, found = np.empty((n, parts), np.int64), []
            for p in range(parts):
                own = x[:, p * width : (p + 1) * width]
                codes[:, p], least, done = reassign(own, books[p], moved[p], code[:, p], dist[:, p])
                found.append(least)
                evaluated += done
            dists = np.stack(found, axis=1)
            error = np.minimum(dists.sum(1), MOST)
            kept = np.where(dists <= MOST, dists, UNKNOWN).astype(np.int64)
            counted = np.zeros(n, np.int64)
            counted[:1] = evaluated
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    batch.column("v"),
                    _lists(codes, pa.int32()),
                    _lists(kept, pa.int64()),
                    pa.array(error.astype(np.int64), pa.int64()),
                    pa.array(counted, pa.int64()),
                ],
                ["vec_id", "label", "v", "code", "dist", "error", "evaluated"],
            )

    label = state.schema["label"].dataType.simpleString()
    shape = f"vec_id bigint, label {label}, v array<bigint>, code array<int>, dist array<bigint>, error bigint, evaluated bigint"
    return state.mapInArrow(run, shape)


def _sums(state: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """part, entry, rows and the sum of each component; a task adds up its rows before the shuffle."""
    parts, entries, width = shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), object)
        for batch in batches:
            x = matrix(batch.column("v"), parts * width)
            code = matrix(batch.column("code"), parts)
            small = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) * (1 + len(x)) < 2**62
            for p in range(parts):
                own = x[:, p * width : (p + 1) * width]
                added = np.zeros((entries, width), np.int64 if small else object)
                np.add.at(added, code[:, p], own if small else own.astype(object))
                total[p] += added
                count[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(count)
        sums = np.array([Decimal(int(s)) for s in total[p, e].ravel()], object).reshape(len(p), width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e], pa.int64()), _lists(sums, pa.decimal128(38, 0))],
            ["part", "entry", "rows", "sums"],
        )

    added = state.select("v", "code").mapInArrow(run, "part int, entry int, rows bigint, sums array<decimal(38,0)>")
    sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    return added.groupBy("part", "entry").agg(F.sum("rows").alias("rows"), *sums)


def compress(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Compressed:
    """Codes and errors of all usable rows, and the codebooks after `rounds` updates.

    Usable are rows whose `embedding` is there, without null or non-finite parts; each gives one row,
    repeated vec_ids and vectors included. A codebook starts from the vectors of the `entries` smallest
    vec_ids (null ids last; equal ids by vector); fewer rows give fewer entries, and an empty table no
    rows. Vectors are cut at a common length, the longest one rounded up to a multiple of `parts`; where
    a vector is shorter it counts as 0, so vectors without components are all zero. Components beyond a
    long count as the largest (smallest) one, as do errors. Null labels are kept. Other columns are not
    looked at.
    """
    spark = rows.sparkSession
    base = scratch(spark)
    kept = stored(whole_vectors(rows, scale), f"{base}/vectors")
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    width = -(-(longest or 0) // parts)
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    start = matrix(pa.array([r["v"] for r in first], pa.list_(pa.int64())), parts * width)
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    moved = np.ones(books.shape[:2], bool)
    unknown = lambda value, kind: F.array_repeat(F.lit(value), parts).cast(kind)
    state = kept.withColumns({"code": unknown(-1, "array<int>"), "dist": unknown(UNKNOWN, "array<bigint>")})
    evaluated = []
    before = f"{base}/vectors"
    for turn in range(rounds + 1):
        path = f"{base}/state{turn}"
        state = stored(_assigned(state.select("vec_id", "label", "v", "code", "dist"), books, moved), path)
        drop_folder(spark, before)
        before = path
        evaluated.append(int(state.agg(F.sum("evaluated")).first()[0] or 0))
        if turn < rounds:
            updated = books.copy()
            for r in _sums(state, books.shape).collect():
                updated[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["rows"] for i in range(width)]
            moved, books = (updated != books).any(axis=2), updated
    return Compressed(state.select("vec_id", "label", "code", "error"), books, evaluated)


def digest(found: Compressed) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (of all rows with the same label), codebooks_sha256."""
    code = F.concat_ws("", F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    whole = found.codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    totals = whole.select("label", F.least("_sum", F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return join_by_label(found.codes, totals, "label").select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(found.codebooks_sha256()).alias("codebooks_sha256")
    )
