import random

import pytest

import corpus_pipeline
from tallyworks.llm import mixing
from tallyworks.llm.queries import op10_mixing
from tests.conftest import SMALL

DOCS = "doc_id long, source string, text string, target string, _stretch int"


def targets_by_hand(sizes, most=3):
    """Share by weight; stop the sources above their limit, share again."""
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in stopped)
        free = sum(w for s, w in weights.items() if s not in stopped)
        out = {s: float(most * sizes[s]) if s in stopped else rest * w / free for s, w in weights.items()}
        above = {s for s in sizes if s not in stopped and out[s] > most * sizes[s]}
        if not above:
            return out
        stopped |= above


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken(spark, seed):
    random.seed(seed)
    rows = []
    for s in ["a", "b", "c", "Z", "é", None, "", "only empty"]:
        for _ in range(random.choice([1, 5, 60])):
            n = 0 if s == "only empty" else random.randint(0, 30) * (20 if s == "b" else 1)
            rows.append((len(rows), s, " \n".join(["w"] * n) + random.choice(["", " ", "\t"])))
    rows += [(len(rows), "a", None), rows[0], rows[0], (None, "c", "x y")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], DOCS).repartition(3)
    got = mixing.plan(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    wanted = targets_by_hand(sizes)
    taken = {s: 0 for s in sizes}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * len(r.positions)
        assert all(0 <= p <= 1 for p in r.positions)
        taken[r.source] += r.taken
    for s in sizes:
        largest = max([r.size for r in got if r.source == s])
        assert wanted[s] <= taken[s] + 1e-6 and taken[s] < wanted[s] + largest + 1e-6
    again = mixing.plan(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_position_inverts_the_demand(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 101).crossJoin(spark.createDataFrame([(-1.0,), (-0.3,), (0.0,), (0.7,), (1.0,)], "tilt double"))
    df = df.select((F.col("id") / 100).alias("share"), "tilt")
    for r in df.withColumn("t", mixing.position(F.col("share"), F.col("tilt"))).collect():
        assert (1 - r.tilt) * r.t + r.tilt * r.t**2 == pytest.approx(r.share, abs=1e-9)


def test_curriculum_moves_a_source_later(frame):
    rows = [(i, s, "w " * 10, tilt) for i, (s, tilt) in enumerate([("early", -0.9), ("late", 0.9)] * 200)]
    order = mixing.mix(frame(rows, "doc_id long, source string, text string, tilt double"), weights=even).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    first, last = order[: len(order) // 4], order[-(len(order) // 4) :]
    assert sum(r.source == "early" for r in first) > 0.7 * len(first)
    assert sum(r.source == "late" for r in last) > 0.7 * len(last)


def even(sources):
    return mixing.cycling_weights(sources, (1,))


def test_empty_table_and_no_words(frame):
    assert mixing.plan(frame([], DOCS)).count() == 0
    row = mixing.plan(frame([(1, "a", None, "t", 1)], DOCS)).first()
    assert (row.size, row.target, row.taken, row.positions) == (0, 0.0, 0, [])


def test_words(frame):
    texts = ["", " ", "a", " a b ", "a\u00a0b\x0bc\x0cd\x1ce", "é\r\nü", None, "x" * 10**6]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", mixing.n_words("text"))
    got = [r[1] for r in sorted(df.collect())]
    import re

    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_places_are_the_training_order(frame):
    rows = [(i, f"s{i % 7}", "w " * (1 + i % 5), "t", 1) for i in range(210)]
    df = frame(rows, DOCS).drop("target")
    got = mixing.plan(df, mixing.cycling_schedule).collect()
    copies = [(p, r.doc_id, r.source, place) for r in got for p, place in zip(r.positions, r.places, strict=True)]
    assert [c[3] for c in sorted(copies)] == list(range(len(copies)))
    assert [(r.position, r.doc_id, r.source, r.place) for r in mixing.mix(df, mixing.cycling_schedule).collect()] == sorted(copies)


def test_stage_and_query_follow_a_schedule(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = corpus_pipeline.mixing_sources(spark, docs, SMALL).collect()
    firsts = [r.places[0] for r in rows if r.places]
    assert firsts == sorted(firsts) and all(r.places for r in rows[: len(firsts)])
    early, late = ([p for r in rows for p in r.positions if r.source == s] for s in ("src0", "src10"))
    assert sum(early) / len(early) < 0.45 and sum(late) / len(late) > 0.55  # tilts -0.6 and 0.6
    assert [r.doc_id for r in op10_mixing(spark, SMALL).collect()][: len(firsts)] == [r.doc_id for r in rows][: len(firsts)]
