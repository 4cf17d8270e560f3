import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyworks.llm import infill
from tests.conftest import SMALL

CLASHING = "doc_id long, text string, _text string, h1 int, n string, output string, form int"


def by_hand(key, text, rate=90, spm=20, marks=infill.SENTINELS):
    """A row of the result for units of one code point."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return key, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, s, m = marks
    form = "spm" if h[3] % 100 < spm else "psm"
    out = {"psm": p + text[:a] + s + text[b:] + m + text[a:b], "spm": s + text[b:] + p + text[:a] + m + text[a:b]}
    return key, n, form, a, b - a, out[form]


def compared(df, **settings):
    rows = df.select("doc_id", "text").collect()
    made = infill.fill_in_middle(df, **settings)
    got = made.withColumn("back", infill.restored(sentinels=settings.get("sentinels", infill.SENTINELS))).collect()
    names = {"rate": "rate", "spm_rate": "spm", "sentinels": "marks"}
    wanted = [by_hand(*r, **{names[k]: v for k, v in settings.items() if k in names}) for r in rows]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(wanted, key=str)
    assert sorted(r.back for r in got) == sorted(r.text or "" for r in rows)
    return got


def test_given_documents(spark):
    got = compared(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


TEXTS = [
    None, "", "a", "\n", "é́\r\n文字🙂", "<P>", "x<S>y", "<M", "a<M>", "<<P", "P>", "<P<S", "<", "\x00b\x1c", " ",
]


@pytest.mark.parametrize("spm", [0, 100])
def test_odd_texts(frame, spm):
    rows = [(i, t, "x", 1, "n", "o", 2) for i, t in enumerate(TEXTS)]
    rows += rows[:5] + [(None, "no key", None, None, None, None, None), (None, None, None, None, None, None, None)]
    rows += [(7, "same key, another text", "x", 1, "n", "o", 2)]
    compared(frame(rows, CLASHING), rate=100, spm_rate=spm)


def test_very_long_text_is_matched_in_stretches(frame):
    long = "línea de texto 文\n" * 130_000
    assert len(long) > 2 * infill.MOST_REPEATS
    got = compared(frame([(i, long + str(i)) for i in range(3)] + [(9, "short")], "doc_id long, text string"), rate=100)
    assert all(r.n == len(long) + 1 for r in got if r.doc_id < 3)


def test_empty_table(frame):
    assert infill.fill_in_middle(frame([], "doc_id long, text string")).count() == 0


@given(st.text(max_size=60), st.integers(1, 7))
def test_ends_in_stretches_equal_one_match(text, most):
    assert infill.unit_ends(text) == list(range(1, len(text) + 1)) == infill.unit_ends(text, most=most)


def test_other_units(frame):
    words = r"\S+\s*"
    assert infill.unit_ends("one two  three", words) == [4, 9, 14] == infill.unit_ends("one two  three", words, most=5)
    assert infill.unit_ends(" starts with a blank", words) is None
    assert infill.unit_ends(" starts with a blank", words, most=5) is None
    assert infill.unit_ends("é🙂\r\n", r"\X") == [2, 3, 5]
    df = frame([(i, "alpha beta gamma delta ") for i in range(40)] + [(99, " no")], "doc_id long, text string")
    for r in infill.fill_in_middle(df, unit=words, rate=100).collect():
        if r.doc_id == 99:
            assert (r.n, r.form, r.output) == (None, "plain", " no")
        else:
            assert r.n == 4 and r.prefix_chars in (0, 6, 11, 17, 23)


def test_rates_and_marks(frame):
    df = frame([(i, f"text number {i}") for i in range(2000)], "doc_id long, text string")
    got = compared(df)
    share = lambda form: sum(r.form == form for r in got) / len(got)
    assert share("plain") == pytest.approx(0.1, abs=0.03) and share("spm") == pytest.approx(0.18, abs=0.03)
    compared(df, sentinels=("|a|", "(b", "[c]"))


def test_a_key_named_like_an_output_is_an_error(frame):
    with pytest.raises(ValueError):
        infill.fill_in_middle(frame([(1, "t")], "n long, text string"), key="n")
