import hashlib
import random

import numpy as np
import pytest

from tallyworks.llm import centroids

ROWS = "vec_id long, embedding array<double>, v string, cluster string, n int, key int"


def by_hand(rows, k, rounds, seed=2, width=4):
    """All distances, every round, in Python's whole numbers."""
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    heads = [v for _, v in sorted(good, key=lambda r: (digest(r[0]), r[1]))[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        own = [min((square(v, c), j) for j, c in enumerate(heads)) for _, v in good]
        if turn < rounds:
            for j in range(len(heads)):
                members = [v for (_, v), (_, i) in zip(good, own) if i == j]
                if members:
                    heads[j] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for (i, _), (d, j) in zip(good, own):
        name = hashlib.sha256(",".join(map(str, heads[j])).encode()).hexdigest()
        out.append((i, j, d, sum(e for e, c in own if c == j), sum(e for e, _ in own), name))
    return out


def compared(df, k, rounds, width=4):
    rows = [(r[0], r.embedding) for r in df.collect()]
    got = centroids.cluster(df, k=k, rounds=rounds, width=width).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(by_hand(rows, k, rounds, width=width), key=str)
    return got


@pytest.mark.parametrize("spread", [0.05, 1.0, 300_000.0])
def test_equals_plain_rounds(frame, spread):
    random.seed(7)
    rows = []
    for i in range(600):
        middle = [(i % 6) * spread, (i % 4) * spread, 0.0, -spread]
        rows.append((i, [m + random.gauss(0, spread / 9) for m in middle], "x", "y", 1, 2))
    got = compared(frame(rows, ROWS).repartition(5), 12, 5)
    assert sum(r.scans for r in got) < 0.8 * 6 * len(got)  # bounds spare many scans


def test_odd_rows_ties_and_copies(frame):
    nan, inf = float("nan"), float("inf")
    vectors = [[0, 0, 0, 0], [1, 0, 0, 0], [1, 0, 0, 0], [-1, 0, 0, 0], [0.5, 0, 0, 0], [0, 1, 0, -1], [0.25, 0.25, 0, 0]]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors * 3)]
    rows += [(1, [1.0, 0.0, 0.0, 0.0]), (1, [9.0, 0.0, 0.0, 0.0]), (None, [2.0, 0.0, 0.0, 0.0]), (50, None), (51, [])]
    rows += [(52, [1.0, 2.0, 3.0]), (53, [nan, 0.0, 0.0, 0.0]), (54, [inf, 0.0, 0.0, 0.0]), (55, [None, 0.0, 0.0, 0.0])]
    df = frame([(*r, "x", "y", 1, 2) for r in rows], ROWS)
    for k in (1, 3, 9, 100):
        compared(df, k, 5)


def test_hot_vector(frame):
    random.seed(1)
    rows = [(i, [1.0, 1.0, 1.0, 1.0] if i % 3 else [random.random() for _ in range(4)], "", "", 0, 0) for i in range(900)]
    compared(frame(rows, ROWS), 8, 4)


def test_empty_table_and_nothing_kept(frame):
    assert centroids.cluster(frame([], ROWS), width=4).count() == 0
    assert centroids.cluster(frame([(1, None, "", "", 0, 0)], ROWS), width=4).count() == 0


def test_too_large_a_number_is_an_error(frame):
    with pytest.raises(Exception, match="exceeds"):
        centroids.cluster(frame([(1, [1e30, 0.0, 0.0, 0.0], "", "", 0, 0)], ROWS), width=4).count()


def test_loosening_is_a_bound_and_less_than_the_drift():
    random_of = np.random.default_rng(4)
    tighter = 0
    for _ in range(200):
        k, width = 6, random_of.integers(1, 9)
        old = random_of.integers(-100, 100, (k, width))
        new = old + random_of.integers(-12, 12, (k, width)) * random_of.integers(0, 2, (k, 1))
        radius = random_of.uniform(0, 80, k)
        loses = centroids.loosening(old, new, radius)
        drift = np.linalg.norm(new - old, axis=1)
        for i in range(k):
            others = [j for j in range(k) if j != i]
            tighter += loses[i] < drift[others].max() - 1e-6
            way = random_of.normal(size=(400, width))
            way /= np.linalg.norm(way, axis=1, keepdims=True)
            x = old[i] + way * radius[i] * random_of.uniform(0, 1, (400, 1)) ** 0.2
            for j in others:
                nearer = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert nearer.max() <= loses[i] + 1e-6
    assert tighter > 500


def test_distances_are_exact_at_any_size():
    for reach in (100, 2**20, centroids.largest_component(64)):
        random_of = np.random.default_rng(reach)
        x, c = (random_of.integers(-reach, reach + 1, (n, 64)) for n in (20, 5))
        wanted = [[sum((int(p) - int(q)) ** 2 for p, q in zip(a, b)) for b in c] for a in x]
        assert centroids.squared_distances(x, c).tolist() == wanted
