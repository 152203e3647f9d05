"""The search by groups of rows is exact, whatever the groups, and queries look together."""

import numpy as np
import pytest

from wayloom.llm import topk


@pytest.mark.parametrize(("scale", "step", "pivots"), [(1, 8, 6), (1, 512, 6), (1, 8, 0), (10**9, 8, 6)])
def test_search_by_groups_is_exact(monkeypatch, scale, step, pivots):
    monkeypatch.setattr(topk, "STEP", step)
    rng = np.random.default_rng(3)
    rows = np.floor(rng.standard_normal((400, 5)) * 64) * scale
    rows[40:90] = rows[40]  # copies
    ids = np.arange(400)
    ids[100:130] = 100  # many rows of one id, and that id a query whose own rows score best
    rows[100:130] = rows[100:130] * 0.01 + rows[:, 0].max() * 4
    rows = np.floor(rows)
    asked = np.arange(0, 400, 20)
    got = list(topk._search(rows[asked], ids[asked], rows, ids, rows[: pivots * 3 : 3], 9))
    whole = [[int(x) for x in v] for v in rows]
    for (query, found, scores), at in zip(got, asked, strict=True):
        every = [(-sum(a * b for a, b in zip(whole[at], v, strict=True)), int(i)) for v, i in zip(whole, ids) if i != ids[at]]
        assert query == ids[at] and [(-s, i) for s, i in zip(scores, found, strict=True)] == sorted(every)[:9]


def test_queries_look_together_and_far_groups_are_left_out(monkeypatch):
    evaluated, plain = [], topk._search_groups

    def spy(queries, query_ids, reach2, rows, ids, bound, cuts, k):
        evaluated.append((len(queries), bound.shape[1]))
        far = bound.max(axis=1) > 0
        assert far.all()
        return plain(queries, query_ids, reach2, rows, ids, bound, cuts, k)

    monkeypatch.setattr(topk, "_search_groups", spy)
    rng = np.random.default_rng(4)
    middles = np.array([[900.0, 0.0], [-900.0, 0.0], [0.0, 900.0], [0.0, -900.0]])
    rows = np.floor(np.repeat(middles, 100, axis=0) + rng.standard_normal((400, 2)) * 8)
    got = list(topk._search(rows[:200], np.arange(200), rows, np.arange(400), rows[[0, 100, 200, 300]], 5))
    assert len(got) == 200 and evaluated == [(128, 4), (72, 4)]
    assert all(v < 100 for q, found, _ in got if q < 100 for v in found)
