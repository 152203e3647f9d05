"""Well-known-binary points and lines to coordinate arrays and back, by Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from wayloom.functions.lines import COORDS

POINT_KIND, LINE_KIND = 1, 2
_COORD = pa.struct([("x", pa.float64()), ("y", pa.float64())])


def decode(blobs: pa.Array) -> pa.Array:
    """Coordinates of each point or line; null for null, other kinds and truncated values."""
    blobs = pa.concat_arrays(blobs.chunks) if isinstance(blobs, pa.ChunkedArray) else blobs
    blobs = blobs.cast(pa.large_binary())
    rows = len(blobs)
    _, offset_buffer, data_buffer = blobs.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, rows + 1, blobs.offset * 8) if rows else np.zeros(1, np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer and data_buffer.size else np.zeros(1, np.uint8)
    valid = blobs.is_valid().to_numpy(zero_copy_only=False)
    start, size = offsets[:-1], np.diff(offsets)
    usable = valid & (size >= 5)
    little = usable & (data[np.where(usable, start, 0)] == 1)
    kind = _uint32(data, start + 1, little, usable)
    has_srid = usable & ((kind & 0x20000000) != 0)
    iso, base = np.divmod(kind & 0x0FFFFFFF, 1000)
    extra = np.where(kind & 0x80000000, 1, 0) + np.where(kind & 0x40000000, 1, 0)
    width = 8 * (2 + extra + np.array([0, 1, 1, 2])[np.minimum(iso, 3)])
    head = start + 5 + np.where(has_srid, 4, 0)
    line = usable & (base == LINE_KIND) & (size >= head - start + 4)
    count = np.where(line, _uint32(data, head, little, line), np.where(usable & (base == POINT_KIND), 1, 0)).astype(np.int64)
    first = head + np.where(line, 4, 0)
    good = usable & ((base == POINT_KIND) | line) & (first - start + count * width <= size)
    count = np.where(good, count, 0)
    out = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(rows), count)
    place = first[row] + (np.arange(out[-1]) - out[:-1][row]) * width[row]
    x, y = (_float64(data, place + shift, little[row]) for shift in (0, 8))
    coords = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], fields=list(_COORD))
    marks = pa.array(np.append(out.astype(np.int32), 0)[: rows + 1], mask=np.append(~good, False))
    return pa.ListArray.from_arrays(marks, coords)


def encode(lines: pa.Array) -> pa.Array:
    """Little-endian point for one coordinate, line for more; null for null and empty."""
    lines = pa.concat_arrays(lines.chunks) if isinstance(lines, pa.ChunkedArray) else lines
    count = np.asarray(lines.value_lengths().fill_null(0)).astype(np.int64)
    coords = lines.flatten()
    xy = np.empty((len(coords), 2), "<f8")
    xy[:, 0] = np.asarray(coords.field("x"))
    xy[:, 1] = np.asarray(coords.field("y"))
    head = np.where(count > 1, 9, np.where(count == 1, 5, 0))
    offsets = np.concatenate([[0], np.cumsum(head + 16 * count)])
    data = np.zeros(offsets[-1], np.uint8)
    some, many = count > 0, count > 1
    at = offsets[:-1]
    data[at[some]] = 1
    data[at[some] + 1] = np.where(many[some], LINE_KIND, POINT_KIND)
    for byte in range(4):
        data[at[many] + 5 + byte] = (count[many] >> (8 * byte)) & 0xFF
    row = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    place = (at + head)[row] + 16 * nth
    data[place[:, None] + np.arange(16)] = xy.view(np.uint8).reshape(-1, 16)
    validity = pa.array(some).buffers()[1] if len(count) else None
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(count), [validity, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    ).cast(pa.binary())


def _gather(data: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(data[place[:, None] + np.arange(width)])


def _uint32(data: np.ndarray, place: np.ndarray, little: np.ndarray, where: np.ndarray) -> np.ndarray:
    value = np.zeros(len(place), np.int64)
    raw = _gather(data, place[where], 4)
    value[where] = np.where(little[where], raw.view("<u4")[:, 0], raw.view(">u4")[:, 0])
    return value


def _float64(data: np.ndarray, place: np.ndarray, little: np.ndarray) -> np.ndarray:
    raw = _gather(data, place, 8)
    return np.where(little, raw.view("<f8")[:, 0], raw.view(">f8")[:, 0])


def decode_wkb(column: Column) -> Column:
    return F.arrow_udf(_decode_batch, COORDS)(column)


def encode_wkb(column: Column) -> Column:
    return F.arrow_udf(_encode_batch, "binary")(column)


def _decode_batch(blobs: pa.Array) -> pa.Array:
    return decode(blobs)


def _encode_batch(lines: pa.Array) -> pa.Array:
    return encode(lines)


_decode_batch.__annotations__ = {"blobs": pa.Array, "return": pa.Array}
_encode_batch.__annotations__ = {"lines": pa.Array, "return": pa.Array}
