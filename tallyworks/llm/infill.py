"""Fill-in-middle: texts cut at two places and reordered, so that a model learns to write what is missing."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.store import small_batches

#: What starts the prefix, the suffix and the middle in an output.
SENTINELS = ("<P>", "<S>", "<M>")

#: A text is cut into units of this pattern; any code point, line feeds included, by default.
CODE_POINT = "."

#: The library holds about 110 bytes for every repetition of a group and gives up at about 5 million of them. Texts of more
#: code points than this are matched in stretches of so many units, one match each.
MOST_REPEATS = 1 << 20

#: An output batch is handed on once it holds so many code points.
BATCH_CHARS = 8_000_000


def unit_ends(text: str, unit: str = CODE_POINT, most: int = MOST_REPEATS) -> list[int] | None:
    """Where each unit of ``text`` ends; None if it is not a run of units.

    One full match of ``(unit)*`` keeps every repetition of its group, whose ends are the places where a text can be cut.
    Only a text of more than ``most`` code points is matched stretch by stretch, and its units may then not depend on
    what follows a stretch.
    """
    if len(text) <= most:
        match = regex.compile(f"({unit})*", regex.DOTALL).fullmatch(text)
        return match and match.ends(1)
    some, ends = regex.compile(f"({unit}){{1,{most}}}", regex.DOTALL), []
    while (ends[-1] if ends else 0) < len(text):
        match = some.match(text, ends[-1] if ends else 0)
        if match is None or match.end() == match.pos:
            return None
        ends.extend(match.ends(1))
    return ends


def draws(key: str, seed: int) -> list[Column]:
    """Four whole numbers: the first four groups of 8 digits of the hex sha256 of ``seed:key`` (null key: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    unit: str = CODE_POINT,
    rate: int = 90,
    spm_rate: int = 20,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """Every document as ``key, n, form, prefix_chars, middle_chars, output``; ``key`` keeps its name.

    A text of ``n`` units is cut after the smaller and the larger of ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units into prefix,
    middle and suffix. ``form`` is ``plain`` (the text as it is) if the text is empty, holds a sentinel, or ``h3 % 100``
    is ``rate`` or more; else ``spm`` (suffix, prefix, middle) if ``h4 % 100`` is less than ``spm_rate``, else ``psm`` (prefix,
    suffix, middle). ``prefix_chars`` and ``middle_chars`` are code points, null in plain rows.

    Null text is empty, with 0 units. A text that is not a run of units stays plain, with ``n`` null. A null key draws as an
    empty one. Repeated rows give repeated rows; rows that share a key share its draws. Texts of any length are cut, beyond
    ``MOST_REPEATS`` code points in several matches. Other columns are left out, so no name can clash but that of the key with
    an output column, which is an error. An empty table gives no rows. No row needs another one: nothing is shuffled.
    """
    if key in ("n", "form", "prefix_chars", "middle_chars", "output"):
        raise ValueError(f"{key} is the name of an output column")
    drawn = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"), *draws(key, seed))
    schema = drawn.select(key).schema
    for name, kind in (("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long")):
        schema = schema.add(name, kind)
    schema = schema.add("output", "string")
    starts = tuple(sentinels)
    first, second, third = starts
    batch_chars = BATCH_CHARS

    def reordered(whole, h1, h2, h3, h4):
        ends = unit_ends(whole, unit)
        n = None if ends is None else len(ends)
        if not n or h3 % 100 >= rate or any(s in whole for s in starts):
            return n, "plain", None, None, whole
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (ends[cut - 1] if cut else 0 for cut in (low, high))
        prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
        if h4 % 100 < spm_rate:
            return n, "spm", len(prefix), len(middle), "".join((second, suffix, first, prefix, third, middle))
        return n, "psm", len(prefix), len(middle), "".join((first, prefix, second, suffix, third, middle))

    def writing(batches):
        for batch in batches:
            inputs = [batch.column(c) for c in ("_text", "h1", "h2", "h3", "h4")]
            begin, rows, chars = 0, [], 0
            for at in range(batch.num_rows):
                rows.append(reordered(*(c[at].as_py() for c in inputs)))
                chars += len(rows[-1][-1])
                if chars >= batch_chars or at + 1 == batch.num_rows:
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                    made = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                    keys = batch.column(0).slice(begin, len(rows))
                    names = [key, "n", "form", "prefix_chars", "middle_chars", "output"]
                    yield pa.RecordBatch.from_arrays([keys, *made], names=names)
                    begin, rows, chars = at + 1, [], 0

    return small_batches(drawn).mapInArrow(writing, schema)


def restored(
    output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS
) -> Column:
    """The exact text, rebuilt from the output and its form alone."""
    first, second, third = sentinels

    def after(mark, rest):  # what follows the first ``mark``
        return F.substr(rest, F.instr(rest, mark) + len(mark))

    def before(mark, rest):
        return F.substr(rest, F.lit(1), F.instr(rest, mark) - 1)

    whole = F.col(output)
    inner = after(first, whole)
    psm = [before(second, inner), after(third, whole), before(third, after(second, inner))]
    inner = after(second, whole)
    spm = [before(third, after(first, inner)), after(third, whole), before(first, inner)]
    join = lambda parts: reduce(lambda a, b: F.concat(a, b), parts)
    return F.when(F.col(form) == "psm", join(psm)).when(F.col(form) == "spm", join(spm)).otherwise(whole)
