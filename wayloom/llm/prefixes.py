"""Prefix trie of conversations from sorted order, without building a tree.

Conversations are sorted by their turns, so the members of a trie node are neighbours. For each row the
length of the prefix that it shares with the row before (its LCP) is kept. A prefix of depth d at row i
has as members the rows around i between which no LCP is below d; each candidate finds both ends by
itself, by binary search over a sparse table of range minima. A row brings in the nodes deeper than
its LCP, in the order of a walk through the trie, so that a subtree is a range of candidates and its
sums are differences of running sums.

The order is cut into blocks of bounded size, one row of a table each. A node within a block is finished
there. A node that crosses blocks gives one partial row for each block it meets, under the block it
starts in, which a second sparse table over the blocks' lowest LCPs finds. Partial rows are few: at
most the depth of a conversation for each block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import join_few, row_batches, scratch, stored, text_of

FAMILY = 5
MOST_HEAD = 9
#: Turns and conversations of a block. All tasks get 28 bytes for each block.
BLOCK = 65_536
KEY_BYTES = 16
NOTHING = hashlib.sha256(b"").hexdigest()

#: Rows of a block's result: finished nodes, partial rows of crossing ones, and members of long runs of equal conversations.
NODE, PARTIAL, END = 0, 1, 2
ROOT = -1
_BLOCKS = (
    "part int, sub int, rows int, first_size int, lcp0 int, lowest int, "
    "first binary, last binary, convs binary, sizes binary, lcps binary, bytes binary"
)
_LINKS = "part int, sub int, start bigint, lcp0 int, lowest int, first_size int"
_FOUND = (
    "kind int, block int, depth bigint, pos bigint, conv_id bigint, parent_conv_id bigint, parent_block int, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, bytes bigint, ends_sha256 string"
)
_NAMES = [c.split()[0] for c in _FOUND.split(", ")]
_TYPES = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[c.split()[1]] for c in _FOUND.split(", ")]


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, keys (a hash of each turn's role and text) and bytes (of each text), in turn order.

    A conversation is the first h turns of its family's first one (the id rounded toward 0 to a multiple
    of 5; none if there is no such conversation), then its own turns from the h-th on.
    """
    role, text = text_of("role"), text_of("text")
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(F.unhex(F.sha2(content.cast("binary"), 256)), 1, KEY_BYTES).alias("key"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    family = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")
    grouped = turns.groupBy(family).agg(F.collect_list(F.struct("conv_id", "turn", "role", "key", "bytes")).alias("items"))
    members = F.array_distinct(F.transform("items", lambda i: i.conv_id))
    opened = grouped.select("family", "items", F.explode(members).alias("conv_id"))

    def of(conv: str) -> F.Column:
        own = F.filter("items", lambda i: i.conv_id == F.col(conv))
        return F.sort_array(F.transform(own, lambda i: F.struct(i.turn, i.role, i.key, i.bytes)))

    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_HEAD).cast("int")
    built = opened.select("conv_id", head.alias("h"), of("family").alias("base"), of("conv_id").alias("own"))
    turn = F.concat(F.slice("base", F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own") + 1))
    return built.select("conv_id", turn.alias("t")).select(
        "conv_id", F.col("t.key").alias("keys"), F.col("t.bytes").alias("bytes")
    )


# ------------------------------------------------------------- range minima


def minima(values: np.ndarray) -> np.ndarray:
    """Sparse table: row k holds at i the least of the 2**k values from i on; beyond the end it repeats row k-1."""
    table = [values]
    while 2 ** len(table) <= len(values):
        half, above = 2 ** (len(table) - 1), table[-1]
        row = above.copy()
        row[:-half] = np.minimum(above[:-half], above[half:])
        table.append(row)
    return np.stack(table)


def last_of(table: np.ndarray, i: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The furthest r >= i so that all of i+1..r are at least d."""
    n, r = table.shape[1], i.copy()
    for k in range(len(table) - 1, -1, -1):
        r += np.where((r + 2**k < n) & (table[k][np.minimum(r + 1, n - 1)] >= d), 2**k, 0)
    return r


def first_of(table: np.ndarray, i: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The furthest l <= i so that all of l+1..i are at least d."""
    left = i.copy()
    for k in range(len(table) - 1, -1, -1):
        left -= np.where((left >= 2**k) & (table[k][np.maximum(left - 2**k + 1, 0)] >= d), 2**k, 0)
    return left


def least_between(table: np.ndarray, i: np.ndarray, r: np.ndarray) -> np.ndarray:
    k = np.frexp((r - i + 1).astype(float))[1] - 1
    return np.minimum(table[k, i], table[k, r - 2**k + 1])


# ------------------------------------------------------------------- blocks


def _shared(before: np.ndarray, after: np.ndarray) -> int:
    n = min(len(before), len(after))
    differ = np.flatnonzero((before[:n] != after[:n]).any(axis=1))
    return int(differ[0]) if len(differ) else n


def _keys(values: pa.Array) -> np.ndarray:
    fixed = values.cast(pa.binary(KEY_BYTES))
    return np.frombuffer(fixed.buffers()[1], "<u8").reshape(-1, 2)[fixed.offset : fixed.offset + len(fixed)]


def _lcps(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each row with the one before; the first one's is 0."""
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    both = np.concatenate([[0], np.minimum(sizes[1:], sizes[:-1])])
    row = np.repeat(np.arange(len(sizes)), both)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
    differ = (keys[at[row] + depth] != keys[at[row - 1] + depth]).any(axis=1)
    lcp = both.copy()
    np.minimum.at(lcp, row[differ], depth[differ])
    return lcp


def sorted_blocks(texts: DataFrame, turns: int, conversations: int) -> DataFrame:
    """The conversations in order, as blocks of up to BLOCK turns and conversations (one may be longer)."""
    tasks = max(1, -(-(turns + conversations) // BLOCK))
    placed = texts.repartitionByRange(tasks, "keys", "conv_id").sortWithinPartitions("keys", "conv_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub, last, held, weight = 0, None, [], 0

        def out() -> pa.RecordBatch:
            nonlocal sub, last
            part = held[0][0]
            convs, sizes, keys, sent = (np.concatenate([h[i] for h in held]) for i in range(1, 5))
            lcp = _lcps(keys, sizes)
            first, end = keys[: sizes[0]], keys[len(keys) - sizes[-1] :]
            lcp[0] = -1 if last is None else _shared(last, first)
            row = [part, sub, len(convs), sizes[0], lcp[0], lcp[1:].min(initial=2**31 - 1), first.tobytes(), end.tobytes()]
            row += [convs.astype("<i8").tobytes(), sizes.astype("<i4").tobytes(), lcp.astype("<i4").tobytes(), sent.astype("<i8").tobytes()]
            sub, last = sub + 1, end.copy()
            kinds = [pa.int32()] * 6 + [pa.binary()] * 6
            names = [c.split()[0] for c in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in row_batches(batches, 32 * BLOCK):
            sizes = np.asarray(batch.column("keys").value_lengths()).astype(np.int64)
            keys = _keys(batch.column("keys").flatten())
            sent = batch.column("bytes").flatten().to_numpy(zero_copy_only=False)
            held.append((batch.column("part")[0].as_py(), batch.column("conv_id").to_numpy(), sizes, keys, sent))
            weight += len(sizes) + len(keys)
            if weight >= BLOCK:
                yield out()
                held, weight = [], 0
        if held:
            yield out()

    return placed.select(F.spark_partition_id().alias("part"), "conv_id", "keys", "bytes").mapInArrow(run, _BLOCKS)


def linked(blocks: DataFrame) -> DataFrame:
    """Of each block its number of rows before, the LCP of its first row with the row before, and its lowest LCP."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, last = 0, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                first = np.frombuffer(r["first"], "<u8").reshape(-1, 2)
                if r["sub"] == 0:
                    r["lcp0"] = -1 if last is None else _shared(last, first)
                out.append((r["part"], r["sub"], start, r["lcp0"], min(r["lcp0"], r["lowest"]), r["first_size"]))
                start, last = start + r["rows"], np.frombuffer(r["last"], "<u8").reshape(-1, 2)
            columns = zip(*out, strict=True) if out else [[]] * 6
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            names = [c.split()[0] for c in _LINKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    ends = blocks.select("part", "sub", "rows", "first_size", "lcp0", "lowest", "first", "last")
    return ends.coalesce(1).sortWithinPartitions("part", "sub").mapInArrow(run, _LINKS)


# -------------------------------------------------------------------- nodes


def _batch(n: int, **columns: object) -> pa.RecordBatch:
    arrays = []
    for name, kind in zip(_NAMES, _TYPES, strict=True):
        value = columns.get(name)
        if isinstance(value, np.ndarray):
            arrays.append(pa.array(value, kind))
        elif isinstance(value, list):
            arrays.append(pa.array(value, kind))
        elif isinstance(value, tuple):
            arrays.append(pa.array(value[0], kind, mask=value[1]))
        else:
            arrays.append(pa.array([value] * n, kind))
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def block_nodes(
    no: int, convs: np.ndarray, sizes: np.ndarray, lcp: np.ndarray, sent: np.ndarray, links: dict[str, np.ndarray], lows: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Finished nodes of a block, its share of the crossing ones, and members of runs that cross its borders."""
    n = len(convs)
    ahead = no + 1 < len(links["lcp0"])
    after = int(links["lcp0"][no + 1]) if ahead else -1
    run_goes_on = ahead and after == links["first_size"][no + 1]
    lcp = lcp.copy()
    lcp[0] = links["lcp0"][no]
    deep = np.maximum(lcp, 0)
    table, least = minima(lcp), minima(convs)
    at = np.concatenate([[0], np.cumsum(sizes)])
    # Candidates: the prefixes that a row brings in.
    new = sizes - deep
    place = np.concatenate([[0], np.cumsum(new)])
    i = np.repeat(np.arange(n), new)
    d = np.arange(len(i)) - place[i] + deep[i] + 1
    r = last_of(table, i, d)
    crosses = (r == n - 1) & (after >= d)
    members = r - i + 1
    conv = least_between(least, i, r) if len(i) else i
    size = sent[at[i] + d - 1]
    leaves = np.concatenate([[0], np.cumsum(np.append(lcp[1:], after) < sizes)])
    saved = np.concatenate([[0], np.cumsum(np.where(crosses, 0, (members - 1) * size))])
    # Parents: the candidate before, or for a row's first one the prefix as long as its LCP, by its left end.
    parent = np.arange(len(i)) - 1
    parent_block = np.full(len(i), no)
    turning = np.flatnonzero(d == deep[i] + 1)
    up = d[turning] - 1
    left = first_of(table, i[turning], up)
    earlier = (left == 0) & (lcp[0] >= up) & (up > 0)
    parent[turning] = np.where((up == 0) | earlier, -1, place[left] + up - deep[left] - 1)
    # Crossing nodes from before: the prefixes that the first row shares with the row before.
    shared = np.arange(1, max(int(lcp[0]), 0) + 1)
    begun = first_of(lows, np.full(len(shared), no - 1), shared) if len(shared) else shared
    begun = np.where(lows[0][begun] >= shared, begun - 1, begun) if len(shared) else shared
    parent_block[turning] = np.where(up == 0, ROOT, np.where(earlier, begun[np.minimum(up, len(begun)) - 1] if len(begun) else ROOT, no))
    inside = parent >= 0
    children = np.bincount(parent[inside], minlength=len(i)) if len(i) else np.zeros(0, np.int64)
    known = inside.copy()
    known[inside] = ~crosses[parent[inside]]
    # Members that end at a node are its first rows, all equal; their ids ascend.
    same = lcp == sizes
    breaks = np.append(np.flatnonzero(~same), n)
    ends = np.full(len(i), NOTHING, object)
    for c in np.flatnonzero(d == sizes[i]).tolist():
        a, e = int(i[c]), int(breaks[np.searchsorted(breaks, i[c], "right")])
        if e == n and run_goes_on:
            ends[c] = None
            yield _batch(n - a, kind=END, block=no, depth=int(d[c]), conv_id=convs[a:])
        else:
            ends[c] = hashlib.sha256(",".join(map(str, convs[a:e].tolist())).encode()).hexdigest()
    lead = int(breaks[0]) if no > 0 and same[0] and sizes[0] > 0 else 0
    if lead:
        yield _batch(lead, kind=END, block=int(begun[sizes[0] - 1]), depth=int(sizes[0]), conv_id=convs[:lead])
    empty = int((sizes == 0).sum())
    if empty:
        yield _batch(empty, kind=END, block=ROOT, depth=0, conv_id=convs[sizes == 0])
    columns = {
        "depth": d,
        "pos": links["start"][no] + i,
        "conv_id": conv,
        "parent_conv_id": (np.where(known, conv[parent], 0) if len(i) else conv, ~known),
        "parent_block": (parent_block, known),
        "n_convs": members,
        "n_children": children,
        "n_leaves": leaves[r + 1] - leaves[i],
        "saved_tokens": saved[place[r + 1]] - saved[np.arange(len(i))],
        "bytes": size,
        "ends_sha256": ends,
    }
    for kind, rows in ((NODE, np.flatnonzero(~crosses)), (PARTIAL, np.flatnonzero(crosses))):
        if len(rows):
            own = {k: (v[0][rows], v[1][rows]) if isinstance(v, tuple) else v[rows] for k, v in columns.items()}
            yield _batch(len(rows), kind=kind, block=no, **own)
    if len(shared):
        end = last_of(table, np.zeros(len(shared), np.int64), shared)
        yield _batch(
            len(shared),
            kind=PARTIAL,
            block=begun,
            depth=shared,
            conv_id=least_between(least, np.zeros(len(shared), np.int64), end),
            n_convs=end + 1,
            n_children=np.bincount(up[earlier], minlength=len(shared) + 1)[1:],
            n_leaves=leaves[end + 1],
            saved_tokens=saved[place[end + 1]],
        )
    yield _batch(
        1,
        kind=PARTIAL,
        block=ROOT,
        depth=0,
        pos=0,
        conv_id=int(convs.min()),
        n_convs=n,
        n_children=int((d == 1).sum()),
        n_leaves=int(leaves[-1]),
        saved_tokens=int(saved[-1]),
        bytes=0,
    )


def _found(blocks: DataFrame, links: dict[str, np.ndarray]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, order = minima(links["lowest"]), (links["part"].astype(np.int64) << 32) | links["sub"]
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                no = int(np.searchsorted(order, (r["part"] << 32) | r["sub"]))
                read = lambda name, kind: np.frombuffer(r[name], kind).astype(np.int64)  # noqa: B023, E731
                yield from block_nodes(
                    no, read("convs", "<i8"), read("sizes", "<i4"), read("lcps", "<i4"), read("bytes", "<i8"), links, lows
                )

    return blocks.select("part", "sub", "convs", "sizes", "lcps", "bytes").mapInArrow(run, _FOUND)


def _long_runs(ends: DataFrame) -> DataFrame:
    """ends_sha256 of runs that cross blocks: their ids pass by in order, one at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: tuple[int, int], state: hashlib._Hash) -> pa.RecordBatch:
            values = [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([state.hexdigest()])]
            return pa.RecordBatch.from_arrays(values, ["block", "depth", "long_run"])

        key, state = None, hashlib.sha256()
        for batch in batches:
            for block, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("block", "depth", "conv_id")), strict=True):
                if (block, depth) != key:
                    if key:
                        yield out(key, state)
                    key, state = (block, depth), hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
        if key:
            yield out(key, state)

    keys = ["block", "depth"]
    dealt = ends.select(*keys, "conv_id").repartition(*keys).sortWithinPartitions(*keys, "conv_id")
    return dealt.mapInArrow(run, "block int, depth bigint, long_run string")


def _with_subtrees(crossing: DataFrame) -> DataFrame:
    """Adds what crossing nodes save within the subtree of each; there are few of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        pos, n, size = (rows.column(c).to_numpy() for c in ("pos", "n_convs", "bytes"))
        order = np.lexsort((rows.column("depth").to_numpy(), pos))
        total = np.concatenate([[0], np.cumsum(((n - 1) * size)[order])])
        first = np.empty(len(order), np.int64)
        first[order] = np.arange(len(order))
        saved = rows.column("saved_tokens").to_numpy() + total[np.searchsorted(pos[order], pos + n - 1, "right")] - total[first]
        where = rows.schema.get_field_index("saved_tokens")
        yield from rows.set_column(where, "saved_tokens", pa.array(saved, pa.int64())).to_batches()

    return crossing.coalesce(1).mapInArrow(run, crossing.schema)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without conv_id belong to no conversation and are left out. Null turns come first; turns of equal
    number are ordered by role, then by a hash of the text, repeated rows included. A null role or text is
    empty; texts are taken whole. Turns are told apart by 128 bits of a hash. No conversation gives no row,
    not even a root. Other columns are not looked at. A conversation is one row, as hashes of its turns.
    """
    base = scratch(conversations.sparkSession)
    texts = stored(rebuilt(conversations), f"{base}/rebuilt")
    count = texts.agg(F.sum(F.size("keys")).alias("turns"), F.count("*").alias("conversations")).first()
    blocks = stored(sorted_blocks(texts, count["turns"] or 0, count["conversations"]), f"{base}/blocks")
    table = linked(blocks).toPandas()
    links = {name: table[name].to_numpy() for name in table.columns}
    found = stored(_found(blocks, links), f"{base}/found")
    keys = ["block", "depth"]
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    once = [F.max(c).alias(c) for c in ("pos", "bytes", "parent_block", "ends_sha256")]
    crossing = found.where(F.col("kind") == PARTIAL).groupBy(*keys).agg(F.min("conv_id").alias("conv_id"), *sums, *once)
    crossing = crossing.join(_long_runs(found.where(F.col("kind") == END)), keys, "left")
    crossing = stored(_with_subtrees(crossing), f"{base}/crossing")
    above = crossing.select(F.col("block").alias("parent_block"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_above"))
    ends = F.coalesce("ends_sha256", "long_run", F.lit(NOTHING)).alias("ends_sha256")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    crossing = crossing.join(above, ["parent_block", "depth"], "left").withColumn("parent_conv_id", F.col("_above"))
    finished = join_few(found.where(F.col("kind") == NODE), above, ["parent_block", "depth"], [F.col("conv_id")])
    finished = finished.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return finished.select(*columns, "ends_sha256").union(crossing.select(*columns, ends))
