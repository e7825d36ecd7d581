"""The dual-tree search against brute force on vectors with and without structure."""

import numpy as np
import pytest

from tidemill.llm import topk_search


def _vectors(kind, n, dim, pick):
    if kind == "clustered":
        centres = pick.integers(-200, 200, (40, dim))
        return (centres[pick.integers(0, 40, n)] + pick.integers(-6, 7, (n, dim))).astype(float)
    if kind == "copies":
        return np.repeat(pick.integers(-9, 9, (max(1, n // 100), dim)), 100, axis=0)[:n].astype(float)
    return pick.integers(-200, 200, (n, dim)).astype(float)


@pytest.mark.parametrize("kind", ["clustered", "copies", "random"])
@pytest.mark.parametrize("n, dim", [(1, 3), (6, 2), (700, 3), (4000, 32), (12000, 16)])
def test_search_is_that_of_brute_force(kind, n, dim):
    pick = np.random.default_rng(n + dim)
    data = _vectors(kind, n, dim, pick)
    ids = pick.permutation(10 * n)[:len(data)]
    own = np.arange(0, len(data), 7)
    q_id, score, found, products = topk_search._search(data[own], ids[own], data, ids, 5)
    whole = data[own] @ data.T
    got = {i: [(int(a), int(b)) for a, b in zip(s, f) if np.isfinite(a)][::-1] for i, s, f in zip(q_id, score, found)}
    for row, i in enumerate(own):
        others = np.flatnonzero(ids != ids[i])
        order = others[np.lexsort((ids[others], -whole[row, others]))][:5]
        assert got[ids[i]] == [(int(whole[row, j]), int(ids[j])) for j in order]
    assert products <= len(own) * len(data)
    if n == 12000 and kind != "random":
        # most pairs are left out by their bounds, or as copies
        assert products < 0.4 * len(own) * len(data)


@pytest.mark.parametrize("kind", ["clustered", "copies", "random"])
def test_nodes_cover_their_points(kind):
    tree = topk_search.CoverTree(_vectors(kind, 3000, 16, np.random.default_rng(5)))
    assert sorted(tree.order) == list(range(3000))
    seen = []

    def check(node):
        own = tree.sorted[node.start:node.stop]
        assert np.linalg.norm(own - node.centre, axis=1).max() <= node.radius + 1e-6
        assert len(node.children) <= topk_search.FANOUT
        assert all(c.stop > c.start for c in node.children)
        if node.children:
            assert [c.start for c in node.children] + [node.stop] == [node.start] + [c.stop for c in node.children]
            assert all(c.stop - c.start < node.stop - node.start for c in node.children)
            for c in node.children:
                check(c)
        else:
            seen.append(node.stop - node.start)
            assert node.stop - node.start <= topk_search.LEAF or node.radius == 0
    check(tree.root)
    assert sum(seen) == 3000
