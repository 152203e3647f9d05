"""Vector codes against plain rounds that compare everything."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayloom.llm import codes, common

SHAPE = "vec_id bigint, embedding array<double>, label int, code string, dist int, v int, rows int"


def table(spark, rows):
    """Embeddings with columns whose names clash with those the operator uses."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SHAPE)


def plain(rows, parts, entries, rounds, scale):
    """Codes with errors in table order, and the codebooks; whole numbers of any size."""
    cap = lambda v: min(max(v, -(2**63)), 2**63 - 1)
    kept = [
        (i, [cap(math.floor(x * scale)) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    cut = lambda v, p: (v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [
        [min((far(cut(v, p), e), j) for j, e in enumerate(books[p])) for p in range(parts)] for _, v, _ in kept
    ]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), f in zip(kept, found, strict=True) if f[p][1] == j]
                if own:
                    books[p][j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = [
        (i, label, [j for _, j in f], min(sum(d for d, _ in f), codes.MOST))
        for (i, _, label), f in zip(kept, assign(), strict=True)
    ]
    return out, books


def order(row):
    return repr(row)


@pytest.mark.parametrize("limit", [codes.MOST, 0])
def test_codes_equal_plain_rounds(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    rng = random.Random(5)
    vector = lambda: [round(rng.uniform(-1, 1), 2) for _ in range(8)]
    rows = [(i, vector(), rng.choice([0, 0, 0, 1, None])) for i in range(120)]
    rows += [rows[3], (7, vector(), 1), (None, vector(), None)]  # repeated row, repeated id, no id
    rows += [(200, None, 1), (201, [0.1, None], 1), (202, [float("nan")] * 8, 1), (203, [float("inf")] * 8, 2)]
    rows += [(204 + i, rows[0][1], 3) for i in range(40)]  # ties
    rows += [(300, [], 1), (301, [0.5] * 5, 1)]
    found = codes.compress(table(spark, rows), entries=16, rounds=3, scale=16)
    want, books = plain(rows, 4, 16, 3, 16)
    got = [(r["vec_id"], r["label"], r["code"], r["error"]) for r in found.codes.collect()]
    assert sorted(got, key=order) == sorted(want, key=order)
    assert found.codebooks.tolist() == books
    assert found.evaluated[0] == len(want) * 4 * 16
    assert all(later < found.evaluated[0] for later in found.evaluated[1:])
    per_label = {}
    for _, label, _, error in want:
        per_label[label] = per_label.get(label, 0) + error
    digest = codes.digest(found).collect()
    text = {(r[0], "".join(f"{c:02x}" for c in r[2]), r[3], per_label[r[1]]) for r in want}
    assert {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in digest} == text
    assert len(digest) == len(want)


def test_codes_of_large_components(spark):
    """Beyond what doubles hold, distances stay exact; errors beyond a long are the largest one."""
    rng = random.Random(6)
    rows = [(i, [rng.choice([1e6, 3e9, 1e17, 1e300, -1e300]) + rng.random() for _ in range(4)], 1) for i in range(30)]
    found = codes.compress(table(spark, rows), entries=2, rounds=2)
    want, books = plain(rows, 4, 2, 2, codes.SCALE)
    got = [(r["vec_id"], r["label"], r["code"], r["error"]) for r in found.codes.collect()]
    assert sorted(got, key=order) == sorted(want, key=order)
    assert found.codebooks.tolist() == books
    assert codes.digest(found).agg(F.max("label_error")).first()[0] == codes.MOST


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1), (2, [], None)]])
def test_codes_of_nothing(spark, rows):
    got = codes.digest(codes.compress(table(spark, rows))).collect()
    assert [(r["vec_id"], r["code"], r["error"]) for r in got] == [(i, "00000000", 0) for i, v, _ in rows if v is not None]


def test_moved_entries_alone_are_compared():
    rng = np.random.default_rng(7)
    x = rng.integers(-9, 9, (500, 3))
    before = rng.integers(-9, 9, (20, 3))
    after = before.copy()
    after[[2, 11]] = rng.integers(-9, 9, (2, 3))
    moved = (after != before).any(axis=1)
    code, dist = codes.nearest(x, before)
    got, least, evaluated = codes.reassign(x, after, moved, code, dist)
    want, want_least = codes.nearest(x, after)
    assert got.tolist() == want.tolist() and least.tolist() == want_least.tolist()
    again = int(moved[code].sum())
    assert evaluated == again * 20 + (500 - again) * int(moved.sum())
