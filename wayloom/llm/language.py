"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are taken by tasks over a bounded sample of labelled rows (`sample_rows`, chosen by a hash of
the id, so alike on every run); what reaches the driver is one count for each language and bucket. The
log-probability matrix (languages x BUCKETS) is broadcast; batches are scored sparsely: the buckets
of a text's n-grams pick matrix rows, which are summed for each text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import row_batches, text_of

#: Features, a power of two; the matrix has 128 KB for each language.
BUCKETS = 1 << 15
SIZES = (1, 2, 3)
#: About so many labelled rows are learned from.
SAMPLE_ROWS = 20_000
UNKNOWN = "und"
#: Characters looked at together; longer texts are scored piece by piece.
PIECE = 1 << 16
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)


def buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a lower-cased text, by pieces that overlap so that each n-gram counts once."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for start in range(0, len(points), PIECE):
        for size in SIZES:
            piece = points[start : start + PIECE + size - 1]
            n = len(piece) - size + 1
            if n <= 0:
                continue
            mixed = np.full(n, size, dtype=np.uint32)
            for i in range(size):
                mixed = (mixed ^ piece[i : i + n]) * _MIX[i]
                mixed ^= mixed >> np.uint32(15)
            yield mixed & np.uint32(BUCKETS - 1)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def learn(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities (BUCKETS x languages) with the languages' priors in the last row.

    `rows` has _id, text and lang; rows without text or lang are left out. Every language of the
    sample counts; the smoothing is add-one over BUCKETS.
    """
    usable = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    total = usable.count()
    part = min(1.0, sample_rows / max(1, total))
    position = F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1_000_003)) / 1_000_003

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                count = counts.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))
                count[BUCKETS] += 1
                for found in buckets(text):
                    count[:BUCKETS] += np.bincount(found, minlength=BUCKETS)
        for lang, count in counts.items():
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(count[at])],
                ["lang", "bucket", "n"],
            )

    sample = usable.where(position < part).select("text", F.col("lang").cast("string"))
    counted = sample.mapInArrow(run, "lang string, bucket int, n bigint")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS + 1, len(langs)))
    column = np.array([langs.index(x) for x in found.column("lang").to_pylist()], dtype=int)
    counts[found.column("bucket").to_numpy(), column] = found.column("n").to_numpy()
    model = np.empty_like(counts, dtype=np.float32)
    model[:BUCKETS] = np.log((counts[:BUCKETS] + 1) / (counts[:BUCKETS].sum(0) + BUCKETS))
    model[BUCKETS] = np.log(np.maximum(counts[BUCKETS], 1) / max(1.0, counts[BUCKETS].sum()))
    return langs, model


def identify_language(docs: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, _training, lang_pred and score (the probability given to lang_pred) of every row.

    `training` says which rows may be learned from; their lang is never looked at for predictions.
    A null text, or one without a letter, is `und` with score 0; so is every text if there was
    nothing to learn from. Of equal languages the first by name is taken. Other columns are not
    looked at.
    """
    usable = docs.where(training).select(F.col("doc_id").alias("_id"), text_of().alias("text"), F.col("lang"))
    langs, model = learn(usable, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for batch in row_batches(batches):
            out: list[tuple[str, float]] = []
            for text in batch.column(2).to_pylist():
                if not names or not has_letter(text):
                    out.append((UNKNOWN, 0.0))
                    continue
                total = table[BUCKETS].astype(np.float64)
                for found in buckets(text):
                    total += table[found].sum(axis=0, dtype=np.float64)
                odds = np.exp(total - total.max())
                best = int(odds.argmax())
                out.append((names[best], float(odds[best] / odds.sum())))
            columns = list(zip(*out, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64())],
                ["doc_id", "_training", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), training.alias("_training"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, _training boolean, lang_pred string, score double")
