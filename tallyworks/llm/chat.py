"""Chat formatting: reply trees, their root-to-leaf paths, and the best of them as conversations."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.ordering import running, same
from tallyworks.llm.store import save, small_batches

#: The template, and the control strings of this and other templates that texts must not contain as such.
ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>\n"
CONTROL = ["<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: ``<|>`` goes first: its two control strings share a character, so it is broken in two places.
ESCAPED = re.compile("|".join(map(re.escape, ["\\", "<|>", *CONTROL])))
TURN = re.compile(f"{re.escape(ROLE)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)

#: A conversation is written in pieces of about so many characters, cut between turns.
PIECE_CHARS = 1_000_000

FORMATTED = (
    "tree_id {key}, path_rank int, piece int, formatted string, loss array<struct<start:int,length:int>>"
)


def escape(text: str) -> str:
    """Break control strings with a backslash after their first character; double backslashes."""
    return ESCAPED.sub(_broken, text)


def _broken(match: re.Match) -> str:
    found = match[0]
    if found == "\\":
        return "\\\\"
    return "<\\|\\>" if found == "<|>" else found[0] + "\\" + found[1:]


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def chosen_paths(nodes: DataFrame, paths: int = 1) -> DataFrame:
    """Root-to-leaf paths of reply trees: ``(tree_id, path_rank, up, node_id)``, ``up`` steps above the leaf.

    ``nodes`` has ``tree_id``, ``node_id``, ``parent_id`` and ``score``. Paths are ranked within a tree by
    the mean score of their nodes, then by length, then by the leaf's id; the
    first ``paths`` of each tree are returned.

    Self-joins double the steps from round to round: after k rounds a node knows its ancestor
    2^k steps up and the scores in between, so a path of n turns takes log2(n) joins. Going back from
    the chosen leaves, each round adds the ancestors 2^k steps above those found,
    every ancestor once. A parent that is not there makes its child a root. Nodes on a cycle
    reach no root and belong to no path. Repeated nodes count once, null scores as 0.
    """
    unique = nodes.groupBy("tree_id", "node_id").agg(
        F.min(F.struct("parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("n")
    )
    ids = unique.select(F.col("tree_id").alias("_t"), F.col("node_id").alias("_p"))
    linked = unique.select("tree_id", "node_id", "n.*")
    level = save(
        linked.join(ids, linked["tree_id"].eqNullSafe(ids["_t"]) & (linked["parent_id"] == ids["_p"]), "left").select(
            "tree_id", "node_id", F.col("_p").alias("up"), F.col("score").alias("total"), F.lit(1).alias("length")
        ),
        "steps",
    )
    first, levels = level, []
    live, done = level.where("up is not null"), level.where("up is null")
    rounds = max(1, level.count()).bit_length() + 1
    while live.limit(1).count() and len(levels) < rounds:
        levels.append(live)
        # only nodes that have not reached their root take the next step
        a, b = live.alias("a"), live.unionByName(done).alias("b")
        met = F.col("a.tree_id").eqNullSafe(F.col("b.tree_id")) & (F.col("a.up") == F.col("b.node_id"))
        level = save(
            a.join(b, met).select(
                "a.tree_id", "a.node_id", F.col("b.up").alias("up"),
                (F.col("a.total") + F.col("b.total")).alias("total"),
                (F.col("a.length") + F.col("b.length")).alias("length"),
            ),
            "steps",
        )
        live, done = level.where("up is not null"), done.unionByName(level.where("up is null"))
    ends = done.drop("up")
    parents = first.where("up is not null").select(F.col("tree_id").alias("_t"), F.col("up").alias("_p")).distinct()
    leaf = F.col("tree_id").eqNullSafe(F.col("_t")) & (F.col("node_id") == F.col("_p"))
    rank = Window.partitionBy("tree_id").orderBy(
        F.desc(F.col("total") / F.col("length")), F.desc("length"), F.asc("node_id")
    )
    found = ends.join(parents, leaf, "left_anti").withColumn("path_rank", F.row_number().over(rank))
    found = save(
        found.where(F.col("path_rank") <= paths).select("tree_id", "path_rank", F.lit(0).alias("up"), "node_id"), "paths"
    )
    for k in reversed(range(len(levels))):
        jump = levels[k].select(
            F.col("tree_id").alias("_t"), F.col("node_id").alias("_n"), F.col("up").alias("_up")
        )
        above = found.join(jump, found["tree_id"].eqNullSafe(jump["_t"]) & (found["node_id"] == jump["_n"])).select(
            "tree_id", "path_rank", (F.col("up") + (1 << k)).alias("up"), F.col("_up").alias("node_id")
        )
        found = save(found.unionByName(above), "paths")
    return found


def format_paths(nodes: DataFrame, paths: int = 1, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """The chosen paths as conversations: ``tree_id, path_rank, piece, formatted, loss``.

    ``nodes`` has also ``role`` and ``text`` (null: empty). ``loss`` lists the stretches of
    ``formatted`` to learn from, those of assistant texts. A conversation is one row, or, beyond ``piece_chars``
    characters, several pieces in order, cut between turns: no conversation is held whole.
    Of repeated nodes one text is kept, the least.
    """
    found = chosen_paths(nodes.select("tree_id", "node_id", "parent_id", "score"), paths)
    said = nodes.groupBy("tree_id", "node_id").agg(
        F.min(F.struct(*[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])).alias("said")
    )
    joined = found.join(said, same(found, said, ["tree_id", "node_id"])).select(
        found["tree_id"], "path_rank", "up", "said.role", "said.text"
    )
    by_path = small_batches(joined).repartition("tree_id", "path_rank").sortWithinPartitions(
        "tree_id", "path_rank", F.desc("up")
    )
    kind = joined.schema["tree_id"].dataType

    def writing(batches):
        at, piece, parts, loss, size = None, 0, [], [], 0

        def row():
            spans = [{"start": s, "length": n} for s, n in loss]
            return {"tree_id": at[0], "path_rank": at[1], "piece": piece, "formatted": "".join(parts), "loss": spans}

        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("tree_id", "path_rank", "role", "text")]
            for tree, path, role, text in zip(*columns):
                if at is not None and ((tree, path) != at or size >= piece_chars):
                    rows.append(row())
                    piece = piece + 1 if (tree, path) == at else 0
                    parts, loss, size = [], [], 0
                at = (tree, path)
                head, body = f"{ROLE}{escape(role)}{TEXT}", escape(text)
                if role == "assistant":
                    loss.append((size + len(head), len(body)))
                parts.append(head + body + END)
                size += len(parts[-1])
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
        if at is not None:
            yield pa.RecordBatch.from_pylist([row()], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(FORMATTED.format(key=kind.simpleString()))
    arrow = to_arrow_schema(schema)
    return by_path.mapInArrow(writing, schema)


def conversations_as_trees(conversations: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Plain conversations (``conv_id, turn, role, text``) as trees with one branch.

    Rows follow one another by turn, then role, then text; each replies to the one before.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    if extra is not None:
        rows = rows.unionByName(extra)
    placed = running(rows.withColumn("_one", F.lit(1)), ["conv_id"], ["turn", "role", "text"], "_one", "node_id")
    return placed.select(
        F.col("conv_id").alias("tree_id"), "node_id",
        F.when(F.col("node_id") > 0, F.col("node_id") - 1).alias("parent_id"),
        F.lit(0.0).alias("score"), "role", "text",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What the written conversations hold: turns, digests and lengths, read from the pieces alone.

    A row for each ``tree_id`` and ``path_rank``: ``n_turns``, ``turns_sha256`` (role, line feed, text, line feed per turn),
    ``loss_chars`` and ``loss_sha256`` (text under the loss mask, unescaped), ``formatted_chars``.
    Digests are fed piece by piece.
    """
    import hashlib

    schema = formatted.select("tree_id", "path_rank").schema
    for name, kind in (
        ("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"), ("loss_sha256", "string"),
        ("formatted_chars", "long"),
    ):
        schema = schema.add(name, kind)
    ordered = formatted.repartition("tree_id", "path_rank").sortWithinPartitions("tree_id", "path_rank", "piece")

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def reading(batches):
        at, state = None, None

        def row():
            turns, n, loss, learned, chars = state
            values = (*at, n, turns.hexdigest(), learned, loss.hexdigest(), chars)
            return dict(zip(arrow.names, values))

        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("tree_id", "path_rank", "formatted", "loss")]
            for tree, path, text, spans in zip(*columns):
                if (tree, path) != at:
                    if at is not None:
                        rows.append(row())
                    at, state = (tree, path), [hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said in parse(text):
                    state[0].update(f"{role}\n{said}\n".encode())
                    state[1] += 1
                for span in spans:
                    learned = unescape(text[span["start"] : span["start"] + span["length"]])
                    state[2].update(learned.encode())
                    state[3] += len(learned)
                state[4] += len(text)
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
        if at is not None:
            yield pa.RecordBatch.from_pylist([row()], schema=arrow)

    return small_batches(ordered).mapInArrow(reading, schema)
