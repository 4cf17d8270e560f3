import random

import pytest

from tallyworks.llm import substrings


def by_hand(docs, width):
    out = []
    tokens = [(i, (t or "").encode().split()) for i, t in docs]
    firsts = {}
    for i, words in tokens:
        for at in range(len(words) - width + 1 if i is not None else 0):
            gram = tuple(words[at : at + width])
            firsts[gram] = min(firsts.get(gram, i), i)
    for i, words in tokens:
        gone = set()
        for at in range(len(words) - width + 1 if i is not None else 0):
            if firsts[tuple(words[at : at + width])] < i:
                gone |= set(range(at, at + width))
        kept = b" ".join(w for n, w in enumerate(words) if n not in gone).decode()
        starts = [n for n in sorted(gone) if n - 1 not in gone]
        ends = [n + 1 for n in sorted(gone) if n + 1 not in gone]
        out.append((i, len(words), len(gone), kept, list(zip(starts, ends))))
    return sorted(out, key=str)


@pytest.mark.parametrize("group_rows, block_bytes", [(10**6, 10**7), (40, 10**7), (40, 400), (3, 150)])
def test_equals_brute_force(spark, group_rows, block_bytes):
    random.seed(group_rows)
    say = lambda n, v: " ".join(random.choice(v) for _ in range(n))
    shared = [say(30, "abcdefgh") for _ in range(4)]
    docs = [(i * 7 % 41 - 5, say(random.randint(0, 40), "abÉ") + "\n " + random.choice([*shared, ""])) for i in range(41)]
    docs += [(3, None), (4, ""), (None, shared[0]), docs[0], docs[0], (100, shared[1] * 40)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, id int, block string").repartition(5)
    got = substrings.remove_repeats(df, 6, group_rows=group_rows, block_bytes=block_bytes).collect()
    assert sorted(((*r[:4], [tuple(s) for s in r.repeats]) for r in got), key=str) == by_hand(docs, 6)


def test_empty_table(frame):
    assert substrings.remove_repeats(frame([], "doc_id long, text string")).count() == 0


def test_short_texts_only(frame):
    got = substrings.remove_repeats(frame([(1, "a b"), (2, "a b")], "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, 2, 0, "a b", []), (2, 2, 0, "a b", [])]
