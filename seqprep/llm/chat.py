"""Chat formatting of reply trees.

A message answers at most one other message of its tree. Iterated self-joins
with doubled jumps give every message its score along the path from the root;
leaves are ranked by that score; the chosen leaves' paths are recovered by the
same jumps backwards and each becomes one formatted conversation.

Shuffles: the joins move narrow rows (ids and scores), the number of rounds is
the logarithm of the deepest tree, and each round is written to the shared
folder, so that no plan grows. Texts are joined once, to the chosen paths. A
key (tree, message) is unique, so no join has a hot key however large a tree
is; a conversation is one output row and so meets in one task.

Defined results: null texts and roles count as empty; a message whose parent is
missing is a root; a null tree is one tree of its own; empty input gives an
empty table; other columns are ignored. Message ids must be unique in a tree and
not null, and replies must not form a cycle (an error says so).

Template, per turn: ``[INST]`` role ``[/INST]`` text ``</s>``. Control strings
inside roles and texts get a backslash after their first character and every
backslash is doubled, so that the output can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from seqprep.session import write_shared

# The control strings of the template.
OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
CONTROL = r"(<)(/?s>|<SYS>>|</SYS>>)|(\[)(/?INST\])"
NO_TREE = -(2**63)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\)|\\", "$1")


# --- paths --------------------------------------------------------------------


def jumps(messages: DataFrame) -> list[DataFrame]:
    """Tables ``(tree, id, up, score)``, the k-th with the ancestor 2^k replies above.

    ``up`` is null from the root on; ``score`` is the sum over the messages from
    ``id`` (included) to ``up`` (excluded).
    """
    own = messages.select("tree", "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = own.select("tree", F.col("id").alias("parent"), F.lit(True).alias("_known"))
    first = own.join(known, ["tree", "parent"], "left").select(
        "tree", "id", F.when(F.col("_known"), F.col("parent")).alias("up"), "score"
    )
    levels = [write_shared(first, "replies")]
    rounds = max(1, levels[0].count()).bit_length() + 1
    while not levels[-1].filter("up is not null").isEmpty():
        if len(levels) > rounds:
            raise ValueError("replies form a cycle")
        a = levels[-1]
        b = a.select("tree", F.col("id").alias("up"), F.col("up").alias("_next"), F.col("score").alias("_more"))
        joined = a.filter("up is not null").join(b, ["tree", "up"], "left")
        on = joined.select("tree", "id", F.col("_next").alias("up"), (F.col("score") + F.col("_more")).alias("score"))
        levels.append(write_shared(on.unionByName(a.filter("up is null")), "replies"))
    return levels


def chosen_paths(levels: list[DataFrame], best: int = 1) -> DataFrame:
    """``(tree, leaf, rank, id)`` for the messages on the ``best`` highest-scored paths of each tree.

    Ties go to the smaller leaf.
    """
    parents = levels[0].filter("up is not null").select("tree", F.col("up").alias("id")).distinct()
    leaves = levels[-1].join(parents, ["tree", "id"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "id")
    ranked = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    paths = ranked.select("tree", F.col("id").alias("leaf"), "rank", "id")
    for level in reversed(levels[:-1]):
        step = level.filter("up is not null").select("tree", "id", "up")
        above = paths.join(step, ["tree", "id"]).select("tree", "leaf", "rank", F.col("up").alias("id"))
        paths = write_shared(paths.unionByName(above), "paths")
    return paths


# --- format -------------------------------------------------------------------


def format_paths(messages: DataFrame, paths: DataFrame, depth: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``(tree, leaf, rank, formatted, loss_spans)``: one conversation per path.

    ``loss_spans``: (start, length) in ``formatted``, code points from 0, of the
    texts of ``trained_role``.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(OPEN), escape(role), F.lit(MIDDLE))
    turns = (
        paths.join(messages.select("tree", "id", "role", "text"), ["tree", "id"])
        .join(depth, ["tree", "id"])
        .select("tree", "leaf", "rank", F.struct("depth", head.alias("head"), escape(text).alias("body"), (role == trained_role).alias("trained")).alias("turn"))
    )
    grouped = turns.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE)))

    def grow(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.char_length(turn["head"])
        own = F.array(F.struct(begin.alias("start"), F.char_length(turn["body"]).alias("length")))
        return F.struct(
            (begin + F.char_length(turn["body"]) + len(CLOSE)).alias("at"),
            F.when(turn["trained"], F.concat(state["spans"], own)).otherwise(state["spans"]).alias("spans"),
        )

    start = F.expr("named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, length: int>>))")
    return grouped.select(
        "tree", "leaf", "rank",
        F.array_join(pieces, "").alias("formatted"),
        F.aggregate("turns", start, grow, lambda s: s["spans"]).alias("loss_spans"),
    )


def depths(levels: list[DataFrame]) -> DataFrame:
    """``(tree, id, depth)``, roots 0: the same jumps with one point per message."""
    counted = levels[0].select("tree", "id", "up", F.lit(1).alias("depth"))
    for _ in levels[1:]:
        b = counted.select("tree", F.col("id").alias("up"), F.col("up").alias("_next"), F.col("depth").alias("_more"))
        joined = counted.filter("up is not null").join(b, ["tree", "up"])
        on = joined.select("tree", "id", F.col("_next").alias("up"), (F.col("depth") + F.col("_more")).alias("depth"))
        counted = write_shared(on.unionByName(counted.filter("up is null")), "depths")
    return counted.select("tree", "id", (F.col("depth") - 1).alias("depth"))


def format_trees(messages: DataFrame, best: int = 1, trained_role: str = "assistant") -> DataFrame:
    """``messages``: tree, id, parent, role, text, score. One row per chosen path."""
    messages = messages.withColumn("tree", F.coalesce(F.col("tree"), F.lit(NO_TREE)))
    levels = jumps(messages)
    made = format_paths(messages, chosen_paths(levels, best), depths(levels), trained_role)
    return made.withColumn("tree", F.nullif(F.col("tree"), F.lit(NO_TREE)))


def messages_of(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as trees without branches, in the order of the turns.

    Rows with the same turn follow each other by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "role", "text", F.row_number().over(order).alias("id"))
    return numbered.select(
        F.col("conv_id").alias("tree"), F.col("id").cast("long").alias("id"),
        F.when(F.col("id") > 1, F.col("id") - 1).cast("long").alias("parent"), "role", "text", F.lit(1.0).alias("score"),
    )


# --- reading back ---------------------------------------------------------------


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text)."""
    parts = F.split(formatted, CLOSE)
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)
    split = lambda p: F.split(p, r"\[/INST\]")
    return F.transform(
        whole,
        lambda p: F.struct(
            unescape(F.substring(split(p)[0], len(OPEN) + 1, 2**31 - 1)).alias("role"), unescape(split(p)[1]).alias("text")
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are read back."""
    made = formatted.select(
        F.col("tree").alias("conv_id"), "formatted",
        read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
