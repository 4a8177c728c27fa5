"""Reply trees as conversations: paths, ranking, template and loss mask.

A message has a tree, an id within it, the id it replies to, a role, a text and a score. Its ancestors
come from self-joins that double the distance each time, so a path of n messages takes
log2(n) rounds. Every path from a root to a leaf is a branch; a tree's branches are ranked by
the mean of their scores, ties by leaf id.

Defined results: a null tree is a tree of its own; a message whose parent is not there is a root; of
rows with one id the smallest stays; a null id is dropped, nothing can reply to it or name it;
messages that reply in a circle have no root and belong to no branch; null scores count zero, null
roles and texts as empty.

**Template.** A turn is ``<s>``, role, line feed, text, ``</s>``. In roles and texts backslashes are doubled
and every control string gets a backslash behind its first character, so none is left and
the texts come back exactly. The loss mask lists the code-point spans of the assistant's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.stored import stored

OPEN, CLOSE = "<s>", "</s>"
#: Strings that templates use for control; none is left inside a text.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_AFTER = r"(?=\||/?s>|</?SYS>>)"
_INST = r"(?=/?INST\])"

TURNS = "array<struct<role:string,text:string>>"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"(<{_AFTER}|\[{_INST})", r"$1\\")


def unescaped(text: Column) -> Column:
    single = F.regexp_replace(text, rf"(?:(<)\\{_AFTER}|(\[)\\{_INST})", "$1$2")
    return F.replace(single, F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    """A single backslash before an n is a line feed, a doubled one is not."""
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def _messages(messages: DataFrame) -> DataFrame:
    """One row per tree and id, without its text."""
    return (
        messages.where(F.col("id").isNotNull())
        .groupBy("tree", "id")
        .agg(F.min(F.struct("parent", "role", "text", "score")).alias("m"))
        .select("tree", "id", "m.*")
    )


def branches(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """(tree, leaf, rank, score, place, id): the messages of every branch, from the root at place 0.

    `keep` limits the branches per tree to the best. Only ids move here.
    """
    slim = stored(
        _messages(messages).select(F.coalesce(F.col("tree").cast("string"), F.lit("")).alias("key"), F.col("tree").isNull().alias("lost"), "tree", "id", "parent", "score"),
        "tree_messages",
    )
    on = ["key", "lost"]
    present = slim.select(*on, F.col("id").alias("parent"))
    up = slim.where(F.col("parent").isNotNull()).join(present, [*on, "parent"]).select(*on, "id", F.col("parent").alias("ancestor"))
    leaves = slim.join(up.select(*on, F.col("ancestor").alias("id")).distinct(), [*on, "id"], "left_anti")
    paths = leaves.select(*on, F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("distance"))
    up = stored(up, "tree_parents")
    reach, most = 1, slim.count()
    while reach < 2 * most and not up.isEmpty():
        further = (
            paths.join(up, [*on, "id"])
            .select(*on, "leaf", F.col("ancestor").alias("id"), (F.col("distance") + reach).alias("distance"))
        )
        paths = stored(paths.unionByName(further), "tree_paths")
        again = up.select(*on, F.col("id").alias("ancestor"), F.col("ancestor").alias("beyond"))
        up = stored(up.join(again, [*on, "ancestor"]).select(*on, "id", F.col("beyond").alias("ancestor")), "tree_ancestors")
        reach *= 2
    circling = up.select(*on, F.col("id").alias("leaf"))
    paths = paths.join(circling, [*on, "leaf"], "left_anti")
    rooted = slim.select(*on, "tree", "id", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    whole = paths.join(rooted, [*on, "id"])
    best = (
        whole.groupBy(*on, "tree", "leaf")
        .agg(F.avg("score").alias("score"), F.max("distance").alias("length"))
        .withColumn("rank", F.row_number().over(Window.partitionBy(*on).orderBy(F.desc("score"), F.asc("leaf"))))
    )
    if keep is not None:
        best = best.where(F.col("rank") <= keep)
    return paths.join(best, [*on, "leaf"]).select(
        *on, "tree", "leaf", "rank", "score", (F.col("length") - F.col("distance")).alias("place"), "id"
    )


def format_branches(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """(tree, leaf, rank, score, formatted, loss): one conversation per chosen branch."""
    on = ["key", "lost"]
    texts = _messages(messages).select(
        F.coalesce(F.col("tree").cast("string"), F.lit("")).alias("key"),
        F.col("tree").isNull().alias("lost"),
        "id",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(OPEN), escaped_role(F.col("role")), F.lit("\n"))
    turns = (
        branches(messages, keep)
        .join(texts, [*on, "id"])
        .withColumn("body", escaped(F.col("text")))
        .withColumn("head", head)
        .withColumn("width", F.char_length("head") + F.char_length("body") + len(CLOSE))
    )
    before = Window.partitionBy(*on, "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.withColumn("end", F.sum("width").over(before) - len(CLOSE)).withColumn("start", F.col("end") - F.char_length("body"))
    turn = F.struct("place", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), "role", "start", "end")
    listed = placed.groupBy(*on, "tree", "leaf", "rank", "score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return listed.select(
        "tree",
        "leaf",
        "rank",
        "score",
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))
        ).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: role and text as they were."""
    pieces = F.filter(F.split(formatted, CLOSE), lambda p: p != "")
    bare = F.transform(pieces, lambda p: F.substr(p, F.lit(len(OPEN) + 1)))
    return F.transform(
        bare,
        lambda p: F.struct(
            unescaped_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescaped(F.substr(p, F.char_length(F.substring_index(p, "\n", 1)) + 2)).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, as it was."""
    spans = F.transform(
        loss, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return F.array_join(spans, "")


def chains(conversations: DataFrame) -> DataFrame:
    """Conversations as trees without branching: every turn replies to the one before it.

    Turns of one number are in the order of role and text, a null number comes first.
    """
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    order = Window.partitionBy("__key").orderBy("turn", "role", "text")
    return (
        conversations.select(key.alias("__key"), F.col("conv_id").cast("long").alias("tree"), "turn", "role", "text")
        .withColumn("id", F.row_number().over(order).cast("long"))
        .select("tree", "id", (F.when(F.col("id") > 1, F.col("id") - 1)).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
    )


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from the output."""
    formatted = format_branches(chains(conversations), keep=1)
    back = formatted.select(
        F.col("tree").alias("conv_id"),
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss")).alias("learned"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )
