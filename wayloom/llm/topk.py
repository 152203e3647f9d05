"""Exact top-k by inner product: pivot tables give bounds, candidates are evaluated in bound order.

Vectors are integers: floor(scale * x). With one more component, sqrt(R^2 - |x|^2) for rows (R the
longest row) and 0 for queries, the inner product falls as the distance grows, so the k largest
products are the k nearest rows. Distances of every row to many pivots are computed once, with the
block. Rows of a block are grouped by their nearest pivot; the largest gap between a query's distance to a
pivot and the range of a group's distances to it is a lower bound of the distance to all of the group.
Queries evaluate groups together, by rising bound, and leave out those whose bound exceeds their k-th
distance; so results are exact. Pivots come from a bounded sample; every row is indexed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayloom.llm.common import scratch, stored

SCALE = 64
PIVOTS = 32
#: Rows of an index block, queries of a query block.
BLOCK_ROWS = 8192
BLOCK_QUERIES = 1024
#: Candidates evaluated before the first look at the stopping rule; doubled after each look.
STEP = 512
#: Queries that look together.
AT_ONCE = 128
MOST = 2**63 - 1
_BLOCK = "dim int, ids binary, vectors binary"


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v (whole-numbered doubles); rows without id or with null or non-finite parts are left out."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    usable = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~F.coalesce(bad, F.lit(True))
    return rows.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale).cast("double")).alias("v")
    )


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """The vectors as matrices of up to `rows` rows and one length each, as they lie in the partitions."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, parts = held.pop(dim)
            values = [[dim], [np.array(ids, "<i8").tobytes()], [np.array(parts, "<f8").tobytes()]]
            return pa.RecordBatch.from_arrays(
                [pa.array(values[0], pa.int32()), pa.array(values[1], pa.binary()), pa.array(values[2], pa.binary())],
                ["dim", "ids", "vectors"],
            )

        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), batch.column(1)
            for i, vec_id in enumerate(ids):
                v = lists[i].values.to_numpy(zero_copy_only=False)
                own = held.setdefault(len(v), ([], []))
                own[0].append(vec_id)
                own[1].append(v)
                if len(own[0]) == rows:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)

    return vectors.mapInArrow(run, _BLOCK)


def _pivots(vectors: DataFrame, count: int) -> dict[int, np.ndarray]:
    """By length of vectors: pivots far from each other, chosen from 16 rows for each."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "v").limit(16 * count).collect()
    chosen: dict[int, np.ndarray] = {}
    for dim in {len(r["v"]) for r in sample}:
        rows = np.array([r["v"] for r in sample if len(r["v"]) == dim]).reshape(-1, dim)
        taken, far = [0], np.full(len(rows), np.inf)
        while len(taken) < min(count, len(rows)):
            far = np.minimum(far, ((rows - rows[taken[-1]]) ** 2).sum(1))
            taken.append(int(far.argmax()))
        chosen[dim] = rows[taken]
    return chosen


def _exact(vectors: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as doubles where those hold every product exactly, else as unbounded whole numbers."""
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(others).max(initial=0)) * max(1, vectors.shape[-1])
    if most < 2**53:
        return vectors, others
    whole = np.vectorize(int, otypes=[object])
    return whole(vectors), whole(others)


def _search(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, pivots: np.ndarray, k: int
) -> Iterator[tuple[int, list[int], list[int]]]:
    """The k best rows of a block for each query, by elimination with pivot distances."""
    length2 = (rows**2).sum(1)
    reach2 = length2.max(initial=0.0)
    p2 = (pivots**2).sum(1)
    # |(x, lift) - (p, 0)|^2 = |x|^2 - 2 x p + |p|^2 + R^2 - |x|^2
    row_to = np.sqrt(np.maximum(reach2 - 2 * rows @ pivots.T + p2, 0.0))
    # Rows by their nearest pivot; of a group the least and largest distances to all pivots.
    nearest = row_to.argmin(axis=1) if len(pivots) else np.zeros(len(rows), dtype=np.int64)
    order = np.argsort(nearest, kind="stable")
    rows, ids = rows[order], ids[order]
    cuts = np.append(np.unique(nearest[order], return_index=True)[1], len(rows))
    low, high = (f.reduceat(row_to[order], cuts[:-1], axis=0) for f in (np.minimum, np.maximum))
    q2 = (queries**2).sum(1)
    query_to = np.sqrt(np.maximum(q2[:, None] - 2 * queries @ pivots.T + p2, 0.0))
    exact_queries, exact_rows = _exact(queries, rows)
    for at in range(0, len(queries), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        to = query_to[some, None, :]
        bound = np.maximum(low - to, to - high).max(axis=2, initial=0.0)
        best = _search_groups(exact_queries[some], query_ids[some], q2[some] + reach2, exact_rows, ids, bound, cuts, k)
        for query, found in zip(query_ids[some].tolist(), best, strict=True):
            yield query, [v for _, v in found], [-s for s, _ in found]


def _search_groups(
    queries: np.ndarray, query_ids: np.ndarray, reach2: np.ndarray, rows: np.ndarray, ids: np.ndarray, bound: np.ndarray,
    cuts: np.ndarray, k: int,
) -> list[list[tuple[int, int]]]:
    """Of some queries the k best (-score, vec_id), from the groups of rows whose bounds don't exceed their k-th distances."""
    slack = 1e-6 * (1.0 + np.sqrt(reach2))
    best: list[list[tuple[int, int]]] = [[] for _ in queries]
    limit = np.full(len(queries), np.inf)  # the k-th distance; a row whose bound is larger scores less
    least: list = [-np.inf] * len(queries)  # the k-th score
    near_first = np.argsort(bound.sum(axis=0))
    ahead = np.cumsum((cuts[1:] - cuts[:-1])[near_first])
    start, step = 0, STEP
    while start < len(near_first):
        # So many groups as hold the next `step` candidates.
        stop = max(start + 1, int(np.searchsorted(ahead, step)))
        groups, start, step = near_first[start:stop], stop, int(ahead[stop - 1]) + 2 * step
        asked = np.flatnonzero(bound[:, groups].min(axis=1) <= limit + slack)
        if not len(asked):
            continue
        at = np.concatenate([np.arange(cuts[g], cuts[g + 1]) for g in groups])
        scores, own = queries[asked] @ rows[at].T, ids[at]
        good = own != query_ids[asked, None]
        scores[~good] = -np.inf  # the query's own rows
        kth = np.array([least[i] for i in asked], dtype=scores.dtype)
        if len(at) > k:
            kth = np.maximum(kth, np.partition(scores, -k, axis=1)[:, -k])
        good &= scores >= kth[:, None]
        for row in np.flatnonzero(good.any(axis=1)).tolist():
            i, found = int(asked[row]), np.flatnonzero(good[row])
            if len(found) > k:
                found = found[np.lexsort((own[found], -scores[row, found]))[:k]]
            new = zip(scores[row, found].tolist(), own[found].tolist(), strict=True)
            best[i] = sorted([*best[i], *((-int(s), v) for s, v in new)])[:k]
            if len(best[i]) == k:
                least[i] = -best[i][-1][0]
                limit[i] = np.sqrt(max(0.0, float(reach2[i] - 2 * least[i])))
    return best


def top_k(rows: DataFrame, is_query: Column, k: int = 20, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query row its k largest integer products.

    Queries are the usable rows for which `is_query` (over vec_id) holds; candidates are all usable
    rows of the same vector length with another vec_id, ties to the smaller vec_id; a vec_id that
    occurs in several rows stands for several candidates, and as a query it is answered once, from its
    smallest vector. Fewer than k candidates give fewer rows; an empty table gives none. A product beyond
    a long counts as the largest (or smallest) one.
    """
    spark = rows.sparkSession
    base = scratch(spark)
    vectors = stored(integer_vectors(rows), f"{base}/vectors")
    chosen = _pivots(vectors, pivots)
    asked = vectors.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    index = stored(blocks(vectors, BLOCK_ROWS).withColumn("_no", F.monotonically_increasing_id()), f"{base}/index")
    queries = stored(blocks(asked, BLOCK_QUERIES), f"{base}/queries")
    # Every block of queries goes to every block of rows: the stated query set against all rows.
    numbers = index.select("_no", F.col("dim").alias("_dim"))
    sent = queries.join(numbers, F.col("dim") == F.col("_dim")).select(
        "_no", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")
    )
    pairs = index.join(sent, "_no").select("dim", "ids", "vectors", "q_ids", "q_vectors")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                ids, q_ids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["q_ids"], "<i8")
                a = np.frombuffer(r["vectors"], "<f8").reshape(len(ids), dim)
                q = np.frombuffer(r["q_vectors"], "<f8").reshape(len(q_ids), dim)
                for query, found, score in _search(q, q_ids, a, ids, chosen.get(dim, a[:0]), k):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([query] * len(found), pa.int64()),
                            pa.array(found, pa.int64()),
                            pa.array([min(max(s, -MOST), MOST) for s in score], pa.int64()),
                        ],
                        ["query_id", "vec_id", "score"],
                    )

    found = pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
