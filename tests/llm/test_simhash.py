import random

import numpy as np
import pytest
import xxhash

from tallyworks.llm import simhash
from tallyworks.llm.components import components
from tallyworks.llm.queries import op4_simhash
from tests.conftest import SMALL


def print_by_hand(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, radius):
    """Component of every position, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two", "A b C d e\x0bf", "x " * 3000 + "é ü\u00a0ß", "a b c a b c"])
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 1000)
    assert simhash.fingerprint(None if text is None else text.encode(), 3) == print_by_hand(text)


def clustered(n, seed):
    random.seed(seed)
    out = {0, 1}
    while len(out) < n:
        base = random.getrandbits(64)
        for _ in range(random.choice([1, 1, 1, 5, 30])):
            out.add(base)
            for _ in range(random.randint(1, 3)):
                base ^= 1 << random.randrange(64)
    return list(out)[:n]


@pytest.mark.parametrize("leaf_rows", [50, 10_000])
@pytest.mark.parametrize("radius", [0, 2, 3])
def test_links_connect_what_all_pairs_connect(spark, leaf_rows, radius):
    prints = clustered(1500, radius)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long").repartition(3)
    found = {r.node: r.root for r in components(simhash.links(df, radius, leaf_rows), "a", "b").collect()}
    by_root = {}
    for p in signed:
        by_root.setdefault(found.get(p, p), set()).add(p)
    by_hand = {}
    for p, g in zip(signed, groups_by_hand(prints, radius)):
        by_hand.setdefault(g, set()).add(p)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_hand.values()))


def test_query_equals_all_pairs(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [print_by_hand(r.text) for r in rows]
    groups = groups_by_hand(prints, 2)
    expected = {r.doc_id: (f"{p:016x}", rows[g].doc_id) for r, p, g in zip(rows, prints, groups)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash(spark, SMALL).collect()}
    assert got == expected


def test_nulls_repeats_and_clashing_columns(frame):
    rows = [(3, "a b c d", "x", 1), (1, "a b c d", "y", 1), (1, "a b c d", "y", 1), (None, "a b c d", "x", 1),
            (7, None, "x", 1), (8, "", "x", 1), (9, "completely different words here", "x", 1)]
    df = frame(rows, "doc_id long, text string, fingerprint string, leaf int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (1, 1), (None, 1), (7, 7), (8, 7), (9, 9)], key=str)
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 7, 9]


def test_empty_table(frame):
    df = frame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.deduplicate(df).count() == 0


def test_components_of_a_long_path_and_a_hub(frame):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (None, 3), (70, 71), (71, 70)]
    got = {r.node: r.root for r in components(frame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)} | {70: 70, 71: 70}


def test_rows_that_share_a_key_but_not_a_text(frame):
    own = ["red fox jumps over seven walls", "nine grey owls watch the quiet lake", "some bread and salt on an old table"]
    rows = [(1, t) for t in own] + [(2, t) for t in own] + [(1, own[0])] + [(3, "a far away tune that nobody else sings")]
    kept = simhash.deduplicate(frame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == sorted([(1, t) for t in own] + [rows[-1]])
