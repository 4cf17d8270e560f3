"""Mixing sources to target weights along a curriculum whose weights change over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.ordering import running, same
from tallyworks.llm.store import save

#: Words: runs of characters other than blank, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"

#: A source gives at most so many times its own words.
MOST_REPEATS = 3


def n_words(text: str) -> Column:
    """Number of words of a text, 0 for null: where a word starts, the character before is none or blank."""
    flat = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    return F.coalesce(F.length(F.regexp_replace(flat, BLANKS, "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)``: all words shared by weight.

    No target exceeds ``most`` times its source; the excess is shared by weight
    among the others until none is above. A round is one small aggregate, and
    every round stops at least one more source.
    """
    sizes = save(sizes, "sizes")
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    stopped, bound = -1, F.lit(False)
    while True:
        row = sizes.agg(
            F.count_if(bound).alias("stopped"),
            F.coalesce(F.sum(F.when(bound, most * F.col("source_size"))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~bound, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        free_words, free_weight = total - row.taken, row.weight
        if row.stopped == stopped or not free_weight:
            break
        stopped, bound = row.stopped, most * F.col("source_size") <= F.col("weight") * (free_words / free_weight)
    share = F.try_divide(F.col("weight") * F.lit(free_words).cast("double"), F.lit(free_weight).cast("double"))
    return sizes.withColumn(
        "target", F.when(bound, (most * F.col("source_size")).cast("double")).otherwise(F.coalesce(share, F.lit(0.0)))
    )


def cycling_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Add ``weight``: the numbers of ``cycle`` dealt to the sources in code point order, null last."""
    return _dealt(sources, weight=cycle)


def cycling_schedule(
    sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), tilts: tuple[float, ...] = (-0.6, 0.0, 0.6, 0.3, -0.3)
) -> DataFrame:
    """``cycling_weights`` and ``tilt``: how each source's weight falls or rises over time, dealt in the same order."""
    return _dealt(sources, weight=cycle, tilt=tilts)


def _dealt(sources: DataFrame, **cycles: tuple) -> DataFrame:
    """Columns whose values are dealt in turn to the sources, which are ranked once."""
    ordered = sources.withColumn("_last", F.col("source").isNull().cast("int")).withColumn("_one", F.lit(1))
    placed = running(ordered, [], ["_last", "source"], "_one", "_rank")
    at = lambda cycle: (F.col("_rank") % len(cycle) + 1).cast("int")
    return placed.select(
        *sources.columns, *[F.element_at(F.array(*map(F.lit, c)), at(c)).alias(n) for n, c in cycles.items()]
    )


def position(share: Column, tilt: Column) -> Column:
    """The time at which a source has met a ``share`` of its demand.

    A source with tilt ``a`` has weight ``1 + a (2t - 1)`` at time ``t`` from 0
    to 1, so its cumulative demand is the integral ``(1 - a) t + a t^2``. This is
    its inverse, in a form that holds for ``a = 0`` too.
    """
    root = F.sqrt(F.pow(1 - tilt, F.lit(2)) + 4 * tilt * share)
    return F.least(F.lit(1.0), F.coalesce(F.try_divide(2 * share, 1 - tilt + root), F.lit(0.0)))


def plan(docs: DataFrame, weights=cycling_weights, most: int = MOST_REPEATS, key: str = "doc_id") -> DataFrame:
    """How often every document is taken, and where in the training order.

    ``docs`` has ``key``, ``source``, ``text`` and may have ``tilt`` (-1 to 1, one
    value per source: the slope of its weight over time, 0 for constant); without it the
    ``tilt`` that ``weights`` gives a source counts. Within a
    source documents queue in the order of the md5 of their key, and the queue is passed as often
    as the target asks: a document is taken once for every pass on which its first
    word lies before the target. Returns a row per document: ``size``, ``source_size``,
    ``target``, ``taken`` words (of the copies placed), ``positions`` (times from 0 to 1, one for
    each copy taken) and ``places`` (the ranks of these copies among the copies of all sources, from 0,
    by position, ties by key). Null text has no words; null is a source of its own; repeated rows
    queue one after another; documents without words are never taken.
    """
    tilt = F.col("tilt").cast("double") if "tilt" in docs.columns else F.lit(None).cast("double")
    rows = save(
        docs.select(
            key, "source", n_words("text").alias("size"), tilt.alias("_tilt"),
            F.md5(F.col(key).cast("string").cast("binary")).alias("_order"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "sized",
    )
    sources = targets(weights(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), most)
    queued = running(rows, ["source"], ["_order", key, "size"], "size", "_before")
    given = sources["tilt"].cast("double") if "tilt" in sources.columns else F.lit(None).cast("double")
    joined = queued.join(sources, same(queued, sources, ["source"]), "left").select(
        *[queued[c] for c in queued.columns if c != "_tilt"], "source_size", "target",
        F.coalesce(queued["_tilt"], given, F.lit(0.0)).alias("_tilt"),
    )
    # pass p of the queue starts at p times the source's words
    passes = F.filter(
        F.array(*[F.lit(p) for p in range(most)]),
        lambda p: (F.col("size") > 0) & (p * F.col("source_size") + F.col("_before") < F.col("target")),
    )
    when = lambda p: position((p * F.col("source_size") + F.col("_before")) / F.col("target"), F.col("_tilt"))
    known = [key, "source", "size", "source_size", "target"]
    copies = joined.select("_row", *known, F.posexplode_outer(F.transform(passes, when)).alias("_pass", "_position"))
    # a document never taken is one row without a position, after all copies
    copies = copies.withColumn("_one", F.col("_position").isNotNull().cast("int")).withColumn("_none", 1 - F.col("_one"))
    order = ["_none", "_position", key, "source", "_pass"]
    placed = running(copies, [], order, "_one", "_place")
    copy = F.when(F.col("_one") == 1, F.struct("_pass", "_position", "_place"))
    whole = placed.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in known], F.sum(F.col("size") * F.col("_one")).cast("long").alias("taken"),
        F.sort_array(F.collect_list(copy)).alias("_copies"),
    )
    part = lambda field: F.transform("_copies", lambda c: c[field])
    return whole.select(*known, "taken", part("_position").alias("positions"), part("_place").alias("places"))


def mix(docs: DataFrame, weights=cycling_weights, most: int = MOST_REPEATS, key: str = "doc_id") -> DataFrame:
    """The training order: one row for every copy taken, range-sorted by ``place``: by ``position``, ties by key."""
    planned = plan(docs, weights, most, key)
    copies = planned.select(key, "source", "size", F.explode(F.arrays_zip("positions", "places")).alias("_copy")).select(
        key, "source", "size", F.col("_copy.positions").alias("position"), F.col("_copy.places").alias("place")
    )
    return copies.repartitionByRange("place").sortWithinPartitions("place")


def in_order(planned: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of a plan range-sorted by the place of their first copy; documents never taken come last, by key."""
    order = [F.get("places", F.lit(0)).asc_nulls_last(), F.col(key).asc_nulls_last()]
    return planned.repartitionByRange(*order).sortWithinPartitions(*order)
