"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

1. Documents with the same shingle set are one class; only classes are compared.
2. Blocks of columns: every batch of rows sends its entries (shingle, class), packed, to the block of
   the shingle. A block finds the shingles that several classes have; all others can't overlap.
3. Size bounds: partners overlap in at least 80 % of the larger set. A class of which fewer
   shingles are shared has none. The others put their shingles in order, rarest first; partners meet
   in the first n - ceil(0.8 n) + 1 of them.
4. Overlaps are counted exactly for pairs of classes that meet. In ROUNDS rounds, every class that meets
   others is compared with one pivot of each posting list, which connects most of what belongs together.
   Then all posting lists are put together by pivot, and the sparse product of the classes of a group
   with each other is taken block by block, so every link is counted, in one group of those that its
   classes share. Out come each class's number of linked rows and, of the links that join two
   components, one for each component, so a large group of near copies gives no square of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import giving_back, giving_back_group, row_batches, scratch, stored, text_of
from wayloom.llm.components import components
from wayloom.llm.shingles import WordHashes, shingle_sets

SIZE = 5
PERCENT = 80
#: Entries of the incidence matrix in a block of columns.
BLOCK_ENTRIES = 1_500_000
#: Rounds of comparisons with pivots before the product by blocks.
ROUNDS = 2
#: About so many shingles on a side of a block of the product, and overlaps counted at a time.
BLOCK_SHINGLES = 1_000_000


def shingle_keys(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, text_hash, n_shingles and set_key (hash of the set, null for an empty one) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in row_batches(batches, 4 << 20):
            sets = shingle_sets(batch.column(2).to_pylist(), size, cache)
            keys = [_key(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(map(len, sets)), pa.int64()), pa.array(keys, pa.int64())],
                ["doc_id", "text_hash", "n_shingles", "set_key"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
    return rows.mapInArrow(giving_back(run), "doc_id bigint, text_hash bigint, n_shingles bigint, set_key bigint")


def _key(shingles: np.ndarray) -> int:
    value = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return value - (1 << 64) if value >> 63 else value


def _gaps(entries: np.ndarray) -> bytes:
    """Ascending shingles as the gaps between them, in six bytes each if those hold them, else in eight."""
    gaps = np.diff(entries, prepend=np.uint64(0))
    if len(gaps) > 1 and gaps[1:].max() < 1 << 48:
        first = gaps[:1].tobytes()
        return first + gaps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return gaps.astype("<u8").tobytes()


def _from_gaps(packed: bytes, count: int) -> np.ndarray:
    if len(packed) == 8 * count:
        return np.cumsum(np.frombuffer(packed, "<u8"), dtype=np.uint64)
    gaps = np.zeros((count, 8), dtype=np.uint8)
    gaps[0] = np.frombuffer(packed[:8], np.uint8)
    gaps[1:, :6] = np.frombuffer(packed[8:], np.uint8).reshape(-1, 6)
    return np.cumsum(gaps.view("<u8")[:, 0], dtype=np.uint64)


def _incidence(docs: DataFrame, size: int, blocks: int) -> DataFrame:
    """Packed entries: block, keys and sizes of the classes of a batch, shingles in order, their class's place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in row_batches(batches, 6 << 20):
            # Copies within a batch are sent once.
            classes = {_key(s): s for s in shingle_sets(batch.column(0).to_pylist(), size, cache) if len(s)}
            if not classes:
                continue
            sizes = np.array(list(map(len, classes.values())), dtype="<u4")
            keys = np.fromiter(classes, dtype="<i8", count=len(classes))
            entries = np.concatenate(list(classes.values()))
            own = np.repeat(np.arange(len(keys), dtype="<u4"), sizes)
            order = np.argsort(entries)
            entries, own = entries[order], own[order]
            # Blocks are ranges of the upper half of the hash.
            edges = (np.arange(1, blocks, dtype=np.uint64) << np.uint64(32)) // np.uint64(blocks) << np.uint64(32)
            bounds = [0, *np.searchsorted(entries, edges).tolist(), len(entries)]
            rows: list[tuple[int, bytes, bytes, bytes, bytes]] = []
            for block in range(blocks):
                at = slice(bounds[block], bounds[block + 1])
                if at.start < at.stop:
                    used, place = np.unique(own[at], return_inverse=True)
                    packed = place.astype("<u2" if len(used) < 1 << 16 else "<u4").tobytes()
                    rows.append((block, keys[used].tobytes(), sizes[used].tobytes(), _gaps(entries[at]), packed))
            kinds = (pa.int32(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["block", "keys", "sizes", "shingles", "places"],
            )

    rows = docs.select(text_of().alias("text"))
    return rows.mapInArrow(giving_back(run), "block int, keys binary, sizes binary, shingles binary, places binary")


def _shared_entries(incidence: DataFrame, row_blocks: int) -> DataFrame:
    """Entries of shingles that several classes have: row_block, set_key, n, shingle, df."""

    def run(table: pa.Table) -> pa.Table:
        keys, sizes, shingles = [], [], []
        columns = [table.column(c).to_pylist() for c in ("keys", "sizes", "shingles", "places")]
        for k, s, h, p in zip(*columns, strict=True):
            own = np.frombuffer(k, "<i8")
            place = np.frombuffer(p, "<u2" if len(own) < 1 << 16 else "<u4")
            entries = _from_gaps(h, len(place))
            keys.append(own[place])
            sizes.append(np.frombuffer(s, "<u4")[place])
            shingles.append(entries)
        key, n, shingle = map(np.concatenate, (keys, sizes, shingles))
        # Runs of several entries first; then, among these few, copies of a class from other batches go.
        order = np.argsort(shingle, kind="stable")
        key, n, shingle = key[order], n[order], shingle[order]
        again = shingle[1:] == shingle[:-1]
        several = np.concatenate([[False], again]) | np.concatenate([again, [False]])
        key, n, shingle = key[several], n[several], shingle[several]
        order = np.lexsort((key, shingle))
        key, n, shingle = key[order], n[order], shingle[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1])
        key, n, shingle = key[new], n[new], shingle[new]
        _, inverse, count = np.unique(shingle, return_inverse=True, return_counts=True)
        df = count[inverse]
        kept = df > 1
        key = key[kept]
        block = (key.astype(np.uint64) >> np.uint64(33)) % np.uint64(row_blocks)
        return pa.table(
            {
                "row_block": pa.array(block.astype(np.int32)),
                "set_key": pa.array(key),
                "n": pa.array(n[kept].astype(np.int32)),
                "shingle": pa.array(shingle[kept].view(np.int64)),
                "df": pa.array(df[kept].astype(np.int32)),
            }
        )

    return incidence.groupBy("block").applyInArrow(giving_back_group(run), "row_block int, set_key bigint, n int, shingle bigint, df int")


def _candidates(entries: DataFrame, percent: int) -> DataFrame:
    """Classes that can have partners: set_key, n, shingles (the shared ones, rarest first), prefix (how many to look at)."""

    def run(table: pa.Table) -> pa.Table:
        key, n, shingle, df = (table.column(c).to_numpy() for c in ("set_key", "n", "shingle", "df"))
        order = np.lexsort((shingle, df, key))
        key, n, shingle = key[order], n[order], shingle[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
        shared = np.diff(np.concatenate([starts, [len(key)]]))
        size = n[starts].astype(np.int64)
        good = 100 * shared >= percent * size
        prefix = size - -(-percent * size // 100) + 1 - (size - shared)
        entry = np.repeat(good, shared)
        offsets = np.concatenate([[0], np.cumsum(shared[good])]).astype(np.int32)
        return pa.table(
            {
                "set_key": pa.array(key[starts][good]),
                "n": pa.array(size[good].astype(np.int32)),
                "shingles": pa.ListArray.from_arrays(pa.array(offsets), pa.array(shingle[entry])),
                "prefix": pa.array(prefix[good].astype(np.int32)),
            }
        )

    return entries.groupBy("row_block").applyInArrow(giving_back_group(run), "set_key bigint, n int, shingles array<bigint>, prefix int")


def _sized(a: str, b: str, percent: int) -> Column:
    """Whether the sizes alone allow a link."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _links(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of classes, those that link, by their exact overlap."""
    one = rows.select(F.col("set_key").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    two = rows.select(F.col("set_key").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    met = pairs.join(one, "a").join(two, "b")
    return met.where(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _connected(rows: DataFrame, copies: DataFrame, percent: int, base: str) -> tuple[DataFrame, DataFrame]:
    """node and label of all classes that link with another class, and the number of rows (linked) that each (set_key) links with.

    `copies` has the number of rows of each class; a class's own rows are not among `linked`.
    """
    posts = rows.select("set_key", "n", F.explode(F.slice("shingles", F.lit(1), F.col("prefix"))).alias("shingle"))
    several = posts.groupBy("shingle").agg(F.count("*").alias("_n")).where("_n > 1").select("shingle")
    posts = stored(posts.join(several, "shingle"), f"{base}/posts")
    links, labels = None, None

    def labelled() -> DataFrame:
        if labels is None:
            return posts.withColumn("label", F.col("set_key"))
        known = labels.withColumnRenamed("node", "set_key")
        return posts.join(known, "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))

    def mixed(stage: str) -> DataFrame:
        """Entries of posting lists in which several components meet."""
        lists = stored(labelled(), f"{base}/labelled-{stage}")
        kept = lists.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        return lists.join(kept.select("shingle"), "shingle")

    def compare(pairs: DataFrame, stage: str) -> None:
        nonlocal links, labels
        ordered = pairs.select(F.least("set_key", "other").alias("a"), F.greatest("set_key", "other").alias("b"))
        found = stored(_links(ordered.distinct(), rows, percent), f"{base}/links-{stage}")
        links = found if links is None else links.union(found)
        labels = components(links, f"{base}/components-{stage}")

    for round_no in range(ROUNDS):
        lists = mixed(f"round{round_no}")
        # The same pivot in lists of the same classes, so the distinct pairs stay few.
        pivot = F.min(F.struct(F.xxhash64(F.lit(round_no), "set_key"), "set_key", "n", "label")).alias("p")
        pivots = lists.groupBy("shingle").agg(pivot)
        pairs = lists.join(pivots, "shingle").where(F.col("label") != F.col("p.label"))
        pairs = pairs.where(_sized("n", "p.n", percent)).select("set_key", F.col("p.set_key").alias("other"))
        compare(pairs, f"round{round_no}")

    lists = stored(labelled(), f"{base}/rest")
    product = stored(_block_links(lists, rows, copies, percent, base), f"{base}/links-rest")
    found = product.where("b is not null").select("a", "b")
    counts = product.where("linked is not null").groupBy(F.col("a").alias("set_key")).agg(F.sum("linked").alias("linked"))
    return components(found if links is None else links.union(found), f"{base}/components-rest"), counts


def _block_links(lists: DataFrame, rows: DataFrame, copies: DataFrame, percent: int, base: str) -> DataFrame:
    """From posting lists (shingle, set_key, n, label): rows (a, null, linked), parts of the number of rows
    that link with class a, and links (a, b) between components.

    Lists with the same pivot make a group. Its classes are multiplied with each other, in blocks of
    about BLOCK_SHINGLES a side. Two classes that share several groups are counted in the least of them.
    """
    pivot = F.min(F.struct(F.xxhash64("set_key"), "set_key")).alias("p")
    # The order of the pivots' hashes, so that the least shared group is the largest one as a rule.
    group = lists.groupBy("shingle").agg(pivot).select("shingle", F.xxhash64("p.set_key").alias("group"))
    members = stored(lists.join(group, "shingle").select("group", "set_key", "n", "label").distinct(), f"{base}/members")
    parts = members.groupBy("group").agg(F.sum("n").alias("_all"), F.count("*").alias("_members")).where("_members > 1")
    groups = members.groupBy("set_key").agg(F.collect_set("group").alias("groups"))
    members = members.join(parts.drop("_members"), "group").join(groups, "set_key").join(rows.drop("prefix", "n"), "set_key")
    members = members.join(copies, "set_key")
    shares = F.greatest(F.lit(1), F.ceil(F.col("_all") / BLOCK_SHINGLES)).cast("int")
    place = F.pmod(F.xxhash64(F.lit("place"), "set_key"), shares).cast("int")
    every = F.explode(F.sequence(F.lit(0), shares - 1))
    earlier = F.filter("groups", lambda g: g < F.col("group")).alias("earlier")
    kept = ["group", "set_key", "n", "label", "copies", "shingles", earlier]
    left = members.select(*kept, place.alias("_i"), every.alias("_j"), F.lit(True).alias("_left"))
    right = members.select(*kept, place.alias("_j"), every.alias("_i"), F.lit(False).alias("_left"))

    def run(table: pa.Table) -> pa.Table:
        key, n, label, copies, is_left = (table.column(c).to_numpy() for c in ("set_key", "n", "label", "copies", "_left"))
        shared = _Product(table.column("shingles"), ~is_left)
        before = _Product(table.column("earlier"), ~is_left)
        # Components as far as this block knows them.
        _, local = np.unique(label, return_inverse=True)
        rows: list[tuple[int, int | None, int | None]] = []
        for i in np.flatnonzero(is_left):
            new = ~is_left & (key != key[i]) & (before.overlaps(i) == 0)
            if not new.any():
                continue
            overlap = shared.overlaps(i)
            where = np.flatnonzero(new & (overlap > 0) & (100 * overlap >= percent * (n[i] + n - overlap)))
            if not len(where):
                continue
            rows.append((int(key[i]), None, int(copies[where].sum())))
            other = where[local[where] != local[i]]
            if len(other):
                # One link to each component is enough.
                names, first = np.unique(local[other], return_index=True)
                rows += [(int(key[i]), int(key[j]), None) for j in other[first]]
                local[np.isin(local, names)] = local[i]
        a, b, linked = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "linked": pa.array(linked, pa.int64())})

    blocks = left.unionByName(right).groupBy("group", "_i", "_j")
    return blocks.applyInArrow(giving_back_group(run), "a bigint, b bigint, linked bigint")


class _Product:
    """Overlaps of one row of a list column with all rows that are `on_right`, in parts of BLOCK_SHINGLES."""

    def __init__(self, column: pa.ChunkedArray, on_right: np.ndarray) -> None:
        lists = column.combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        self.tokens = lists.flatten().to_numpy()
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        owner = np.repeat(np.arange(len(counts)), counts)
        used = on_right[owner]
        order = np.argsort(self.tokens[used], kind="stable")
        # The right side by columns: the rows that have a token.
        self.column, self.entry = self.tokens[used][order], owner[used][order]

    def overlaps(self, i: int) -> np.ndarray:
        own = self.tokens[self.starts[i] : self.starts[i + 1]]
        overlap = np.zeros(len(self.starts) - 1, dtype=np.int64)
        if not len(own):
            return overlap
        begin, end = np.searchsorted(self.column, own), np.searchsorted(self.column, own, side="right")
        total = np.cumsum(end - begin)
        for part in np.split(np.arange(len(own)), np.searchsorted(total, np.arange(BLOCK_SHINGLES, total[-1], BLOCK_SHINGLES))):
            counts = (end - begin)[part]
            at = np.repeat(begin[part] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            overlap += np.bincount(self.entry[at], minlength=len(overlap))
        return overlap


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links), set_key (the row's class), text_hash and
    n_links (other rows that it links with) of every row.

    Two rows link when their sets of distinct `size`-word shingles have a Jaccard similarity of
    `percent` / 100 or more. Rows without words link with nothing and keep their own doc_id. Repeated
    rows link with each other. Null ids don't count for the least doc_id; a component of
    null ids alone has a null component_id. Other columns are not looked at. An empty table gives an empty table.
    """
    base = scratch(docs.sparkSession)
    keys = stored(shingle_keys(docs, size), f"{base}/keys")
    entries = keys.agg(F.sum("n_shingles")).first()[0] or 0
    blocks = max(32, entries // BLOCK_ENTRIES)
    shared = _shared_entries(_incidence(docs, size, blocks), blocks)
    rows = stored(_candidates(shared, percent), f"{base}/rows")
    classes = keys.where(F.col("set_key").isNotNull()).groupBy("set_key")
    classes = stored(classes.agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies")), f"{base}/copies")
    labels, counts = _connected(rows, classes.select("set_key", "copies"), percent, base)
    classes = classes.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left").join(counts, "set_key", "left")
    classes = stored(classes.withColumn("label", F.coalesce("label", "set_key")), f"{base}/classes")
    least = classes.groupBy("label").agg(F.min("least_id").alias("component_id"))
    n_links = (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    ids = stored(classes.join(least, "label").select("set_key", "component_id", n_links), f"{base}/ids")
    found = keys.join(ids, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    links = F.coalesce("n_links", F.lit(0)).alias("n_links")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), "set_key", "text_hash", links)
