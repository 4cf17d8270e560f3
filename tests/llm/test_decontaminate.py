import random

import pytest

from tallyworks.llm import decontaminate as op

BENCH = "item_id long, text string, n_words int"
DOCS = "doc_id long, text string, hits string, item_id long"


def by_hand(docs, items, width):
    out = []
    for doc_id, text, *_ in docs:
        words = op.words_of(text.encode() if text is not None else None)
        hit, owners = set(), set()
        for item, body, *_ in items:
            own = op.words_of(body.encode() if body is not None else None)
            size = min(width, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                for j in range(len(words) - size + 1):
                    if words[j : j + size] == own[i : i + size]:
                        hit |= set(range(j, j + size))
                        owners |= {str(item)} if item is not None else set()
        out.append((doc_id, len(words), len(hit), sorted(owners)))
    return sorted(out, key=str)


@pytest.fixture
def cases():
    random.seed(3)
    say = lambda n: " ".join(random.choice(["a", "B", "c1", "é", "ÿz"]) for _ in range(n))
    items = [(i, say(random.randint(1, 8)), 1) for i in range(12)]
    items += [(50, None, 1), (51, "", 1), (52, "...", 1), (None, "zz top", 1), (items[0][0], items[0][1], 1)]
    docs = [(i, say(random.randint(0, 60)), "x", 7) for i in range(30)]
    docs += [(90, None, "x", 7), (91, "", "x", 7), (None, "so zz, TOP!", "x", 7), docs[0], docs[0]]
    docs.append((92, "w " * 50_000 + items[3][1], "x", 7))
    return docs, items


@pytest.mark.parametrize("block", [10**6, 9])
def test_scan_equals_brute_force(frame, cases, block):
    docs, items = cases
    found = op.scan(frame(docs, DOCS), frame(items, BENCH), width=4, block=block).collect()
    got = sorted(
        ((r.doc_id, r.n_words, sum(h.end - h.start for h in r["hits"]), list(r["items"])) for r in found), key=str
    )
    assert got == by_hand(docs, items, 4)


def test_flags_and_removals(frame):
    docs = frame([(1, "x a b, c d y", None), (2, "clean text", None), (3, None, None)], "doc_id long, text string, source string")
    bench = frame([(10, "A B C D")], "item_id long, text string")
    assert [(r.doc_id, r.n_hit, r.n_items, r.contaminated) for r in op.flag(docs, bench, 4).orderBy("doc_id").collect()] == [
        (1, 4, 1, True), (2, 0, 0, False), (3, 0, 0, False)
    ]
    assert sorted(r.doc_id for r in op.remove_documents(docs, bench, 4).collect()) == [2, 3]
    spans = op.remove_spans(docs, bench, 4)
    assert {r.doc_id: r.text for r in spans.collect()} == {1: "x  y", 2: "clean text", 3: None}
    assert spans.columns == docs.columns


def test_empty_tables(frame):
    docs, bench = frame([], "doc_id long, text string"), frame([], "item_id long, text string")
    some = frame([(1, "a b")], "doc_id long, text string")
    assert op.flag(docs, frame([(1, "a")], "item_id long, text string")).count() == 0
    assert op.flag(some, bench).first().contaminated is False


def test_hash_collisions_are_verified():
    known = op.GramSet([(b"a b", "1"), (b"c", "2")])
    known.hashes = lambda columns: __import__("numpy").zeros(len(columns[0]), dtype="uint64")
    known.__init__([(b"a b", "1"), (b"b a", "3"), (b"c", "2")])
    assert known.scan([b"b", b"a", b"x", b"c"]) == ([(0, 2), (3, 4)], {"2", "3"})
