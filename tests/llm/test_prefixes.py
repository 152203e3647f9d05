"""The trie of prefixes against one that spells out every prefix."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from wayloom.llm import common, prefixes

SHAPE = "conv_id bigint, turn bigint, role string, text string, depth int, keys string, block int"


def table(spark, rows):
    """Conversations with columns whose names clash with those the operator gives or uses."""
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SHAPE)


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role, tie, text))
    turns = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    members, ending = {}, {}
    for c in turns:
        base = (abs(c) - abs(c) % 5) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        built = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(built) + 1):
            members.setdefault(tuple(built[:d]), []).append(c)
        ending.setdefault(tuple(built), []).append(c)
    out = []
    for node, found in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in below if not any(m[:-1] == n and m for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ids = ",".join(map(str, sorted(ending.get(node, []))))
        out.append(
            (
                min(found),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(found),
                sum(bool(m) and m[:-1] == node for m in members),
                len(leaves),
                saved,
                hashlib.sha256(ids.encode()).hexdigest(),
            )
        )
    return out


def nodes(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return [tuple(r[n] for n in names) for r in df.collect()]


@pytest.mark.parametrize(("block", "limit"), [(4, 0), (16, common.BROADCAST_ROWS), (64, 0), (1 << 16, 0)])
def test_trie_equals_spelled_out_prefixes(spark, monkeypatch, block, limit):
    monkeypatch.setattr(prefixes, "BLOCK", block)
    monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    rng = random.Random(block)
    rows = []
    for c in [*range(60), *range(1000, 1040), -3, -5, -7, 2**62]:
        for turn in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "", None, "é😀"])))
    for c in range(2000, 2080):  # one conversation many times
        rows += [(c, turn, "user", f"same {turn}") for turn in range(10)]
    rows += [(3000, t, "user", "x" * (t or 2)) for t in (None, 3, None, 3, 7)]  # ties and null turns
    rows += [(3005, None, None, None)] * 3  # repeated rows
    rows += [(c, 0, "user", "alone") for c in (4001, 4002, 4003, 4004)]  # no first one of the family
    rows += [(4010, t, "user", "long " * 5_000 * t) for t in range(3)]
    rows += [(None, 1, "user", "of no conversation")]
    rng.shuffle(rows)
    got = nodes(prefixes.prefix_trie(table(spark, rows)))
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(1, 0, "u", "x")], [(4001, 0, "u", "x"), (4002, 0, "u", "x")]])
def test_trie_of_little(spark, rows):
    assert sorted(nodes(prefixes.prefix_trie(table(spark, rows))), key=repr) == sorted(plain(rows), key=repr)


def test_extents_by_range_minima():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = rng.integers(0, 4, n)
        table = prefixes.minima(values)
        i, d = rng.integers(0, n, 200), rng.integers(0, 5, 200)
        right, left = prefixes.last_of(table, i, d), prefixes.first_of(table, i, d)
        for a, depth, r, le in zip(i, d, right, left, strict=True):
            assert all(values[a + 1 : r + 1] >= depth) and (r == n - 1 or values[r + 1] < depth)
            assert all(values[le + 1 : a + 1] >= depth) and (le == 0 or values[le] < depth)
        end = np.minimum(i + rng.integers(0, n, 200), n - 1)
        assert prefixes.least_between(table, i, end).tolist() == [values[a : e + 1].min() for a, e in zip(i, end, strict=True)]
