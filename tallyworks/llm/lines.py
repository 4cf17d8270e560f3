"""Line deduplication: winnowed line hashes find repeated runs, later occurrences are deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.rows import CALLER, packed, unpacked
from tallyworks.llm.store import save

#: A repeated run has two lines at least, or one line of so many words.
LONG_WORDS = 50

BLANKS = r"[\x20\x09-\x0D]+"


def _trimmed(line: Column) -> Column:
    """Without blanks, tabs, returns and form feeds at both ends."""
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def _hash(line: Column) -> Column:
    """96 bits of a line: two independent hashes."""
    return F.struct(F.xxhash64(line).alias("x"), F.hash(line).alias("y"))


def _marked(text: str, long_words: int) -> Column:
    """The lines of a text that are not blank: place in the text, hash, whether long."""
    lines = F.transform(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1),
        lambda line, i: F.struct(i.alias("at"), _trimmed(line).alias("line")),
    )
    return F.transform(
        F.filter(lines, lambda s: s["line"] != ""),
        lambda s: F.struct(
            s["at"].alias("at"),
            _hash(s["line"]).alias("h"),
            # cheap bound first: a line of n words has 2n - 1 characters at least
            ((F.length(s["line"]) >= 2 * long_words - 1)
             & (F.size(F.split(_trimmed(F.regexp_replace(s["line"], BLANKS, " ")), " ")) >= long_words)).alias("long"),
        ),
    )


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", long_words: int = LONG_WORDS) -> DataFrame:
    """``(key, row, at)``: lines to delete, as places in the text split at line feeds. ``row`` is the hash of
    the text: with the key it tells rows apart.

    Lines are compared without blanks at their ends; blank lines are neither
    compared nor deleted. Two lines in a row, or one of ``long_words`` words, are
    a unit; a unit is repeated if the same unit starts at an earlier place, in
    order of key, row and line, and the lines of repeated units are deleted.

    Winnowing: of every two neighbouring line hashes the smaller one (the later, if
    equal) is a fingerprint, and so is every long line; any repeated run of two
    lines shares a fingerprint with its first occurrence. Fingerprints seen at
    one place only drop out. Those left are joined by position with the units
    around them, on both sides, so that a match extends as long as units match;
    what they match is the earliest place of the unit, not every pair of places.
    Groups are reduced to their earliest place before the shuffle.
    """
    marked = docs.select(F.col(key).alias("key"), _hash(F.col(text)).alias("row"), _marked(text, long_words).alias("m"))
    pairs = F.transform(
        F.when(F.size("m") > 1, F.sequence(F.lit(0), F.size("m") - 2)).otherwise(F.array().cast("array<int>")),
        lambda i: _unit(F.get("m", i), F.get("m", i + 1)),
    )
    longs = F.transform(F.filter("m", lambda s: s["long"]), _alone)
    units = save(
        marked.select("key", "row", F.explode(F.concat(pairs, longs)).alias("u")).select("key", "row", "u.*"), "units"
    )
    place = F.struct("key", "row", "at")
    prints = units.groupBy("print").agg(F.count("*").alias("n")).where("n > 1")
    shared = units.join(prints.select("print"), "print", "left_semi")
    # a unit has one print: keyed by the unit alone, no step needs all rows of a print in one task
    first = shared.groupBy("unit").agg(F.min(place).alias("first"))
    hits = shared.join(first, "unit").where(F.col("first") < place)
    return hits.select("key", "row", F.explode("covers").alias("at"))


def _unit(a: Column, b: Column) -> Column:
    """Two lines in a row under their winnowed fingerprint."""
    return F.struct(
        F.when(a["h"] < b["h"], a["h"]).otherwise(b["h"]).alias("print"),
        F.struct(a["h"].alias("a"), b["h"].alias("b")).alias("unit"),
        a["at"].alias("at"),
        F.array(a["at"], b["at"]).alias("covers"),
    )


def _alone(a: Column) -> Column:
    return F.struct(
        a["h"].alias("print"),
        F.struct(a["h"].alias("a"), F.lit(None).cast("struct<x:bigint,y:int>").alias("b")).alias("unit"),
        a["at"].alias("at"),
        F.array(a["at"]).alias("covers"),
    )


def deduplicate_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", long_words: int = LONG_WORDS, counts: bool = True
) -> DataFrame:
    """Delete later occurrences of repeated runs of lines; with ``counts`` adds ``n_lines`` and ``n_removed``, which
    replace columns of these names. All other columns stay as they are, whatever their names.

    Every row stays, also one that loses all its lines (its text is then empty).
    Every row loses its own lines only: rows that share a key, or have none (these come first in order), are told apart
    by a hash of their text. Of rows with the same key and text one is the first, and what repeats in
    the others is deleted. Null text stays null and has no lines.
    """
    several = docs.groupBy(F.col(key).alias("key"), _hash(F.col(text)).alias("row")).agg(F.count("*").alias("n"))
    fates = repeated_lines(docs, key, text, long_words).withColumn("n", F.lit(1).cast("long")).unionByName(
        several.where("n > 1").withColumn("at", F.lit(None).cast("int"))
    )
    fates = save(
        fates.groupBy(F.col("key").alias("_key"), F.col("row").alias("_hash")).agg(
            F.collect_set("at").alias("_gone"), F.max("n").alias("_n")
        ),
        "fates",
    )
    rows = packed(docs, key, text).withColumn("_row", _hash(F.col(text)))
    # the fates grow with the rows: the same join at every size
    joined = rows.join(fates.hint("merge"), _met(rows, fates, key), "left").where("_n is null or _n = 1")
    copies = fates.where("_n > 1")
    turn = F.row_number().over(Window.partitionBy(key, "_row").orderBy(F.xxhash64(F.lit(0), CALLER)))
    marked, at = _marked(text, long_words), lambda s: s["at"]
    # all lines of a later copy belong to units of the first, but a short line alone
    again = F.when((F.size(marked) > 1) | F.exists(marked, lambda s: s["long"]), F.transform(marked, at))
    again = F.coalesce(again, F.array().cast("array<int>"))
    copies = rows.join(copies, _met(rows, copies, key)).withColumn("_turn", turn)
    copies = copies.withColumn("_gone", F.when(F.col("_turn") == 1, F.col("_gone")).otherwise(again)).drop("_turn")
    joined = joined.unionByName(copies)
    lines = F.split(F.col(text), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("_gone", i)), "\n")
    n_lines = F.coalesce(F.size(F.filter(lines, lambda line: _trimmed(line) != "")), F.lit(0)).cast("long")
    made = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept).alias(text)
    done = joined.select(
        key, CALLER, made,
        F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(n_lines).alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
    if not counts:
        return done.select(*unpacked(docs, key, text))
    return done.select(*unpacked(docs, key, without=(text, "n_lines", "n_removed")), text, "n_lines", "n_removed")


def _met(rows: DataFrame, fates: DataFrame, key: str) -> Column:
    return rows[key].eqNullSafe(fates["_key"]) & (rows["_row"] == fates["_hash"])
