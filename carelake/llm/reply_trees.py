"""Reply trees to training conversations (DataFrame functions only).

A message names its parent. Self-joins that double their reach find every
node's ancestors 1, 2, 4, ... steps up; with them, the list of (leaf, ancestor)
pairs doubles its depth each turn, so a thread of n replies takes log n joins.
The joins carry ids only. A branch's score is the sum of its messages' scores;
the best branches of each tree are kept, and each is formatted as one
conversation.

Template: ``<s>``, then the turns in order.

    system       <<SYS>>\\n{text}\\n<</SYS>>\\n
    user         [INST] {text} [/INST]
    assistant    <a> {text} </s>
    any other    <|role={role}|> {text} </turn>\\n

Control strings inside a text (or a role) get a ``~`` after their first
character; those that already have such marks get one more, so taking one away
restores the text. Other texts stay as they are. The loss mask holds the places
of assistant texts, in code points of the formatted conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import materialise

START = "<s>"
#: What follows the first character of each control string, by that character.
_AFTER = {r"\[": r"/?INST\]", "<": r"(?:/?s>|a>|</?SYS>>|/turn>|\|)", r"\|": ">"}
_ESCAPE = "|".join(f"{first}(?=~*+{rest})" for first, rest in _AFTER.items())
_UNESCAPE = "|".join(f"(?<={first})~(?=~*+{rest})" for first, rest in _AFTER.items())
#: Before each turn of a formatted conversation.
_TURN = r"(?=<<SYS>>|\[INST\]|<a>|<\|)"
_NAMED, _END = "<|role=", " </turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit("$0~"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit(""))


def _by_role(role: Column, system, user, assistant, other) -> Column:
    return (F.when(role == "system", system).when(role == "user", user).when(role == "assistant", assistant).otherwise(other))


def opening(role: Column) -> Column:
    """What stands before a turn's text."""
    return _by_role(role, F.lit("<<SYS>>\n"), F.lit("[INST] "), F.lit("<a> "),
                    F.concat(F.lit(_NAMED), escape(role), F.lit("|> ")))


def closing(role: Column) -> Column:
    """What stands after a turn's text."""
    return _by_role(role, F.lit("\n<</SYS>>\n"), F.lit(" [/INST]"), F.lit(" </s>"), F.lit(_END))


def _ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """For k = 0, 1, ...: (tree, node, up) with the ancestor 2**k steps up; and the
    nodes (tree, node) that lie on or below a cycle."""
    here = nodes.select("tree", F.col("node").alias("parent"))
    # a parent that the tree does not hold makes a root
    up = materialise(nodes.where("parent IS NOT NULL").select("tree", "node", "parent")
                     .join(here.distinct(), ["tree", "parent"]).select("tree", "node", F.col("parent").alias("up")), "reply-up")
    largest = nodes.groupBy("tree").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    steps, reach = [], 1
    while reach <= largest and up.limit(1).count():
        steps.append(up)
        up = materialise(up.join(up.select("tree", F.col("node").alias("up"), F.col("up").alias("next")), ["tree", "up"])
                         .select("tree", "node", F.col("next").alias("up")), "reply-up")
        reach *= 2
    # whoever still has an ancestor as far up as the tree has nodes never meets a root
    return steps, up.select("tree", "node")


def branches(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """(tree, leaf, rank, node, pos): the nodes of the ``keep`` best branches of each
    tree (all, if None), from the root (pos 0) to the leaf.

    ``messages`` has tree, node, parent and score (a number; null counts as 0), node
    ids unique in their tree and neither tree nor node null. A node whose parent is
    null or unknown is a root. Branches are ranked by the sum of their scores, ties
    by the smaller leaf. Nodes on or below a cycle belong to no branch."""
    nodes = messages.select("tree", "node", "parent", F.coalesce(F.col("score"), F.lit(0)).cast("decimal(38,9)").alias("score"))
    steps, endless = _ancestors(nodes)
    sound = nodes.join(endless, ["tree", "node"], "left_anti") if steps else nodes
    inner = sound.select("tree", F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
    leaves = sound.join(inner, ["tree", "node"], "left_anti")
    pairs = materialise(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "reply-paths")
    for k, step in enumerate(steps):
        # every pair so far reaches less than 2**k steps up
        further = pairs.join(step.withColumnRenamed("up", "above"), ["tree", "node"]).select(
            "tree", "leaf", F.col("above").alias("node"), (F.col("up") + 2 ** k).alias("up"))
        pairs = pairs.unionByName(materialise(further, "reply-paths"))
    scored = (pairs.join(nodes.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf")
              .agg(F.sum("score").alias("score"), F.max("up").alias("depth")))
    if keep is None:
        best = scored.withColumn("rank", F.lit(None).cast("int"))
    else:
        # the best of each slice of a tree's branches, then the best of these
        order = [F.col("score").desc(), F.col("leaf").asc()]
        part = F.pmod(F.xxhash64("leaf"), F.lit(64))
        some = scored.withColumn("r", F.row_number().over(Window.partitionBy("tree", part).orderBy(*order))).where(F.col("r") <= keep)
        best = some.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order))).where(F.col("rank") <= keep)
    return (pairs.join(best.select("tree", "leaf", "rank", "depth"), ["tree", "leaf"])
            .select("tree", "leaf", "rank", "node", (F.col("depth") - F.col("up")).alias("pos")))


def format_branches(messages: DataFrame, chosen: DataFrame) -> DataFrame:
    """(tree, leaf, rank, formatted, loss_spans): one conversation per chosen branch.
    ``messages`` has tree, node, role and text; null texts and roles are empty.
    ``loss_spans`` lists start (from 0) and length of each assistant text."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = (chosen.join(messages.select("tree", "node", role.alias("role"), escape(text).alias("body")), ["tree", "node"])
             .withColumns({"head": opening(F.col("role")), "tail": closing(F.col("role"))})
             .withColumn("width", F.length("head") + F.length("body") + F.length("tail")))
    before = Window.partitionBy("tree", "leaf", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("width").over(before), F.lit(0)) + len(START) + F.length("head")
    piece = F.struct(F.col("pos"), F.concat("head", "body", "tail").alias("piece"),
                     F.when(F.col("role") == "assistant", F.struct(F.col("start"), F.length("body").alias("length"))).alias("span"))
    return (turns.withColumn("start", start.cast("int")).groupBy("tree", "leaf", "rank")
            .agg(F.array_sort(F.collect_list(piece)).alias("turns"))
            .select("tree", "leaf", "rank", F.concat(F.lit(START), F.array_join("turns.piece", "")).alias("formatted"),
                    F.array_compact("turns.span").alias("loss_spans")))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    def turn(t: Column) -> Column:
        marks = [("system", "<<SYS>>\n", "\n<</SYS>>\n"), ("user", "[INST] ", " [/INST]"), ("assistant", "<a> ", " </s>")]
        named = F.split(t, r"\|> ", 2)
        out = F.struct(unescape(F.substr(named[0], F.lit(len(_NAMED) + 1))).alias("role"),
                       unescape(F.left(named[1], F.length(named[1]) - len(_END))).alias("text"))
        for role, head, tail in marks:
            body = F.substr(t, F.lit(len(head) + 1), F.length(t) - (len(head) + len(tail)))
            out = F.when(F.startswith(t, F.lit(head)), F.struct(F.lit(role).alias("role"), unescape(body).alias("text"))).otherwise(out)
        return out
    body = F.substr(formatted, F.lit(len(START) + 1))
    return F.when(body == "", F.expr("CAST(array() AS array<struct<role:string,text:string>>)")).otherwise(
        F.transform(F.split(body, _TURN), turn))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, in order, unescaped."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"])))


def chains(conversations: DataFrame) -> DataFrame:
    """A table of conversations (conv_id, turn, role, text) as messages: each row
    replies to the one before it, by turn (null first); equal turns by role, then
    text. Repeated rows are turns of their own; rows without a conv_id make up one
    conversation. ``tree`` is the conv_id as text (null: empty)."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("node", place.cast("long"))
            .select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "conv_id", "node",
                    F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0).alias("score"), "role", "text"))


def conversation_digest(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all
    read back from the formatted conversations. An empty table gives no rows."""
    messages = materialise(chains(conversations), "reply-messages")
    formatted = format_branches(messages, branches(messages, keep=1))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.withColumns({"turns": read_turns(F.col("formatted")),
                                  "loss": F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "")})
    return read.select(
        F.when(F.col("tree") != "", F.col("tree")).cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
