"""Language identification: the mixture of languages of a document, by expectation-maximisation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType

from tallyworks.llm.store import save, small_batches

#: Hash buckets of letter trigrams, and the most cells (languages times buckets) of a model that is broadcast.
BUCKETS = 1 << 16
MOST_CELLS = 1 << 25

#: Smoothing of trigram counts; rounds of expectation-maximisation; cost of a language, in log(n) per language.
SMOOTHING, ROUNDS, PENALTY = 0.5, 12, 1.0

#: Languages with no more than this share are tried for removal together.
TRACE = 0.005

#: Trigrams counted at once, so that a long text needs no more memory than others.
PIECE = 1 << 18


def letters() -> np.ndarray:
    """For every code point: whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def trigrams(text: str | None, letter: np.ndarray):
    """Yield hash buckets of the letter trigrams of a text in lower case, words bounded by one blank."""
    for at in range(0, len(text or ""), PIECE):
        # two characters of overlap keep the trigrams at the seams
        codes = np.frombuffer(text[max(0, at - 2) : at + PIECE].lower().encode("utf-32-le"), dtype=np.uint32)
        codes = np.where(letter[codes], codes, 32)
        codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
        codes = codes[(codes != 32) | np.r_[True, codes[:-1] != 32]]
        middle = codes[1:-1] != 32
        a, b, c = codes[:-2][middle], codes[1:-1][middle], codes[2:][middle]
        if len(b):
            mixed = (a * np.uint64(0x1F35B) + b) * np.uint64(0x9E3779B97F4A7C15) + c * np.uint64(0xC2B2AE3D27D4EB4F)
            yield ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(8)).astype(np.int64) % BUCKETS


def counted(text: str | None, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of a text and how often each occurs."""
    pieces = [np.unique(grams, return_counts=True) for grams in trigrams(text, letter)]
    if len(pieces) == 1:
        return pieces[0]
    table = np.zeros(BUCKETS, dtype=np.int64)
    for grams, counts in pieces:
        table[grams] += counts
    return np.flatnonzero(table), table[np.flatnonzero(table)]


def held_out(key: str) -> Column:
    """Rows never learned from: crc32 of the key as text leaves 2 when divided by 4. A null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Log-likelihood of every trigram in every language, from all rows with a text and a language.

    Each task counts the trigrams of its texts; the counts are summed by
    language and bucket. The model has a row of ``BUCKETS`` numbers per language, an error is
    raised if that exceeds ``MOST_CELLS``.
    """
    picked = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )

    def counting(batches):
        letter, tables = letters(), {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if lang not in tables:
                    tables[lang] = np.zeros(BUCKETS, dtype=np.int64)
                for grams in trigrams(text, letter):
                    np.add.at(tables[lang], grams, 1)
        for lang, table in tables.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(table[used])],
                names=["lang", "bucket", "n"],
            )

    counts = save(
        small_batches(picked).mapInArrow(counting, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")),
        "trigrams",
    )
    known = counts.select("lang").distinct()
    most = MOST_CELLS // BUCKETS
    names = sorted(r.lang for r in known.limit(most + 1).collect())
    if len(names) > most:
        raise ValueError(f"more than {most} languages")
    number = {name: i for i, name in enumerate(names)}
    model = np.full((len(names), BUCKETS), SMOOTHING)
    for batch in counts.toArrow().to_batches():
        rows = np.array([number[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
        model[rows, np.asarray(batch.column("bucket"))] += np.asarray(batch.column("n"))
    return names, (model / model.sum(axis=1, keepdims=True)).astype(np.float32)


def mixture(model: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The languages of a document and their proportions.

    Expectation-maximisation for the proportions of all languages; then the language with the least share (the first,
    if equal) goes as long as the log-likelihood less ``PENALTY`` log(n) per language does not fall. All languages with hardly a
    trace go in one step if that stands the same comparison: so a short passage of another language in a long text keeps its share.
    """
    n = counts.sum()
    likely = model[:, grams]

    def fitted(which, share):
        part = likely[which]
        for _ in range(ROUNDS):
            new = share * (part @ (counts / (share @ part))) / n
            moved = np.abs(new - share).max()
            share = new
            if moved < 1e-3:
                break
        share = share / share.sum()
        return share, float(counts @ np.log(share @ part)) - PENALTY * len(which) * np.log(n + 1)

    which = np.arange(len(model))
    share, value = fitted(which, np.full(len(which), 1 / len(which), dtype=np.float32))
    while len(which) > 1:
        hardly = share <= TRACE
        tries = [np.arange(len(which)) != share.argmin()]
        if hardly.sum() > 1 and not hardly.all():
            tries.insert(0, ~hardly)
        for keep in tries:
            less, lower = fitted(which[keep], share[keep] / share[keep].sum())
            if lower >= value:
                which, share, value = which[keep], less, lower
                break
        else:
            break
    return which, share


def predict(
    docs: DataFrame, names: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Add ``lang_pred`` (the language of the largest share), ``score`` (its share) and ``shares`` to ``docs``' key.

    A text that is null or without letters is ``und`` with score 0, and so is any text if no language was learned.
    Whole texts are read, piece by piece. Repeated rows stay repeated.
    """
    learned = docs.sparkSession.sparkContext.broadcast(model)
    picked = small_batches(docs).select(*[c for c in dict.fromkeys([key, "held_out"]) if c in docs.columns],
                                        F.col(text).alias("_text"))
    kept = [c for c in picked.columns if c != "_text"]
    schema = picked.select(*kept).schema.add("lang_pred", StringType()).add("score", DoubleType())
    schema = schema.add("shares", MapType(StringType(), DoubleType()))

    def predicting(batches):
        letter, model = letters(), learned.value
        for batch in batches:
            langs, scores, shares = [], [], []
            for text in batch.column("_text").to_pylist():
                used, counts = counted(text, letter)
                if not len(used) or not names:
                    langs.append("und")
                    scores.append(0.0)
                    shares.append([])
                    continue
                which, share = mixture(model, used, counts.astype(np.float32))
                best = int(share.argmax())
                langs.append(names[which[best]])
                scores.append(min(1.0, float(share[best])))
                shares.append([(names[w], float(s)) for w, s in zip(which, share)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                   pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                names=[*kept, "lang_pred", "score", "shares"],
            )

    return picked.mapInArrow(predicting, schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict every row: ``key, held_out, lang_pred, score, shares``.

    A prediction depends on the text alone.
    """
    marked = docs.select(key, F.col(text).alias("text"), F.col(lang).alias("lang"), held_out(key).alias("held_out"))
    names, model = learn(marked.where(~F.col("held_out") & F.col(key).isNotNull()))
    return predict(marked, names, model, key)
