import numpy as np
import pytest

from tallyworks.llm import neighbours

VECTORS = "vec_id long, embedding array<float>, cell string, v int"


def exact(rows, queries, k):
    """Nearest by comparing with every row."""
    clean = {(i, tuple(v)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in queries:
        if (q, tuple(v or ())) not in clean:
            continue
        near = sorted(
            (float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), i) for i, w in clean if i != q and len(w) == len(v)
        )
        out[q] = near[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def single(x):
    return [float(np.float32(c)) for c in x]


@pytest.mark.parametrize("cell_rows", [4096, 16])
def test_recall_on_clusters(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(neighbours, "CELL_ROWS", cell_rows)
    random = np.random.default_rng(1)
    centres = random.normal(size=(10, 24))
    rows = [(i, single(centres[i % 10] + 0.6 * random.normal(size=24))) for i in range(900)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], VECTORS).repartition(3)
    got = found(neighbours.nearest(df, df.where("vec_id % 100 = 0")))
    wanted = exact(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert got.keys() == wanted.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in wanted[q]}) for q in wanted)
    assert hits / 90 >= 0.9
    for q, near in got.items():
        vectors = dict(rows)
        for score, i in near:
            assert score == pytest.approx(np.linalg.norm(np.array(vectors[i]) - np.array(vectors[q])), abs=1e-12)


def test_small_table_with_ties_copies_and_bad_vectors(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(30)] + [(100, [0.0, 1.0, 0.0]), (101, [0.0, 0.0, 1.0]), (102, [0.0, 0.0, -1.0])]
    rows += [(200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 0.0]), (204, [nan, 1.0, 1.0]), (205, [inf, 1.0, 1.0]),
             (300, [1.0, 2.0]), (400, [2.0, 2.0]), (100, [0.0, 1.0, 0.0]), (None, [1.0, 1.0, 0.0])]
    df = frame([(*r, "c", 1) for r in rows], VECTORS)
    got = found(neighbours.nearest(df, df.where("vec_id % 100 = 0 or vec_id = 5")))
    wanted = exact([r for r in rows if r[0] is not None], [r for r in rows if r[0] is not None and (r[0] % 100 == 0 or r[0] == 5)], 10)
    assert got == wanted


def test_double_precision_vectors(spark):
    rows = [(i, [1.0 + i * 1e-9, 2.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(neighbours.nearest(df, df.where("vec_id = 0"), k=3))
    assert [i for _, i in got[0]] == [1, 2, 3]
    assert got == exact(rows, rows[:1], 3)


def test_many_copies_of_a_query(frame):
    df = frame([(i, [1.0, 1.0], "c", 1) for i in range(500)], VECTORS)
    got = found(neighbours.nearest(df, df.where("vec_id % 100 = 0")))
    assert got[0] == [(0.0, i) for i in range(1, 11)]
    assert got[300] == [(0.0, i) for i in range(10)]


def test_empty_table(frame):
    df = frame([], VECTORS)
    assert neighbours.nearest(df, df).count() == 0


def test_two_hashes_per_table(spark):
    random = np.random.default_rng(2)
    rows = [(i, single(random.normal(size=5))) for i in range(300)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], VECTORS)
    got = found(neighbours.nearest(df, df.where("vec_id % 100 = 0"), hashes=2, probes=40))
    wanted = exact(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert sum(len({i for _, i in got[q]} & {i for _, i in wanted[q]}) for q in wanted) >= 27


def test_rotation_keeps_lengths_and_angles():
    x = np.random.default_rng(3).normal(size=(7, 48))
    y = neighbours.rotated(x, 5)
    assert np.allclose(x @ x.T, y @ y.T)
