import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.operators import pulls

SCHEMA = "k string, j int, m long, v long"


def facts(seed, n, span):
    random.seed(seed)
    keys = [("a", 1), ("a", 2), (None, 1), ("hot", 9), ("hot", 9), ("hot", 9)]
    return [(*random.choice(keys), random.choice([None, random.randint(-span, span)]), random.randint(0, 9)) for _ in range(n)]


def by_hand(rows):
    out = {}
    for k, j, m, v in rows:
        total, members = out.setdefault((k, j), [0, set()])
        out[k, j][0] = total + v
        if m is not None:
            members.add(m)
    return {key: (total, len(members)) for key, (total, members) in out.items()}


def totals(summaries):
    return {(r.k, r.j): (r.total, r.members) for r in pulls.totals(summaries, ["k", "j"], "total", "members").collect()}


@pytest.mark.parametrize("listed", [0, 3, 512])
@pytest.mark.parametrize("span", [4, 200, 100_000])
def test_merged_pulls_equal_all_facts(frame, monkeypatch, listed, span):
    monkeypatch.setattr(pulls, "LISTED", listed)
    parts = [facts(i, n, span) for i, n in enumerate((300, 40, 900, 1))]
    stored = [pulls.summarise(frame(p, SCHEMA), ["k", "j"], "m", "v") for p in parts]
    union = stored[0].unionByName(stored[1]).unionByName(stored[2]).unionByName(stored[3])
    wanted = by_hand([r for p in parts for r in p])
    assert totals(union) == wanted
    # merged summaries are summaries again, in any order
    early = pulls.merged(stored[2].unionByName(stored[0]), ["k", "j"])
    late = pulls.merged(early.unionByName(stored[3]), ["k", "j"]).unionByName(stored[1])
    assert totals(late) == wanted


def test_large_sets_are_bitmaps(frame):
    rows = [("a", 1, m, 1) for m in range(1, 5_001)] + [("b", 1, m, 1) for m in range(1, 6)]
    made = {r.k: r for r in pulls.summarise(frame(rows, SCHEMA), ["k", "j"], "m", "v").collect()}
    assert made["a"].bits is not None and not made["a"].members and made["a"].total == 5_000
    assert made["b"].bits is None and len(made["b"].members) == 5


def test_pulls_may_be_empty(frame):
    empty = pulls.summarise(frame([], SCHEMA), ["k", "j"], "m", "v")
    assert totals(empty) == {}
    some = facts(1, 50, 9)
    assert totals(empty.unionByName(pulls.summarise(frame(some, SCHEMA), ["k", "j"], "m", "v"))) == by_hand(some)


@pytest.mark.parametrize("draw", [lambda: random.gauss(0, 1), lambda: float(random.randint(1, 4)), lambda: random.random() ** 9])
def test_sketches_stay_within_their_rank_error(frame, draw):
    random.seed(11)
    rows = [(random.choice("ab"), draw() if random.random() < 0.9 else None) for _ in range(30_000)]
    parts = [frame(rows[i::5], "g string, v double") for i in range(5)]
    stored = [pulls.sketched(p, ["g"], ["v"]) for p in parts]
    union = stored[0]
    for s in stored[1:]:
        union = pulls.merged_sketches(union.unionByName(s), ["g"])
    shares = {"none": 0.0, "low": 0.25, "mid": 0.5, "high": 0.75, "most": 0.99, "all": 1.0}
    for r in pulls.quantiles(union, ["g"], shares).collect():
        values = np.sort([v for g, v in rows if g == r.g and v is not None])
        assert r.n == len(values) and r["column"] == "v"
        for name, share in shares.items():
            assert r[name] in values
            first, last = np.searchsorted(values, r[name], "left"), np.searchsorted(values, r[name], "right")
            assert first / len(values) <= share + pulls.RANK_ERROR and last / len(values) >= share - pulls.RANK_ERROR


def test_sketch_without_values(frame):
    df = frame([("a", None), ("b", 2.0), ("b", float("nan"))], "g string, v double")
    got = {r.g: r for r in pulls.quantiles(pulls.sketched(df, ["g"], ["v"]), ["g"], {"mid": 0.5}).collect()}
    assert (got["b"].n, got["b"].mid) == (1, 2.0)
    assert (got["a"].n, got["a"].mid) == (0, None)


def test_lists_carry_no_bitmap(frame):
    """A bucket of a few members does not hold an empty bitmap of 4 KB while it is put together."""
    stored = pulls.summarise(frame([("a", 1, 5, 1), ("b", 1, 6, 1)], SCHEMA), ["k", "j"], "m", "v")
    plan = pulls.totals(stored, ["k", "j"], "total", "members")._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_or_agg" in plan
    assert not [line for line in plan.splitlines() if "bitmap_or_agg" in line and "collect_" in line]
