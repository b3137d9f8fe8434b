"""Reply trees as chat training texts: paths from root to leaf, ranked by score, one formatted conversation each.

A message names the message it replies to; a message without one, or whose parent is not in the table, is a root.
Everything is done by iterative self-joins on message ids, so a tree of any size or depth is spread over all
tasks, and the number of rounds is the logarithm of the depth:

1. *Doubling*: round ``k`` joins each message with its ancestor ``2^k`` steps up and adds up the depth and the scores in
   between. At the end each message knows its root, depth and path score.
2. *Leaves* are the messages nobody replies to. Each is one branch; branches are ranked within their tree by the mean score of
   their messages, then by their own id.
3. *Enumeration*: starting from the leaves of the chosen branches, the rounds are walked from the longest step to the
   shortest; each adds to every message found so far its ancestor ``2^k`` steps further up. So every message of a path
   is found exactly once.

A path becomes one text, by a template with control strings. A text or role that contains a control string, or what looks like an
escaped one, gets one more backslash in it; reading back takes that away again, so the turns come back exactly as they were.
The loss mask marks the texts of the assistant.

Defined results: a null text or role is empty. A null score counts as 0. Messages with a null id are left out. Of several messages with
one id all are kept as rows of the table, so ids must be unique (:func:`chained` makes them so). Messages on a
cycle, or below one, have no root and belong to no path. An empty table gives an empty result. A formatted conversation is one value, so
a single conversation must fit in a row (2 GB); nothing else is gathered by tree or by conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.llm.ranks import ranked
from searchtide.llm.shared import staged

#: control strings of the template
START, END = "<|im_start|>", "<|im_end|>"
#: whose texts are learned
LEARNED = "assistant"


# --- paths --------------------------------------------------------------------------------------


def chained(rows: DataFrame, tree_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages (``id, parent, tree, role, text, score``) of linear conversations: each turn replies to the one before it.

    Turns are in order of ``turn`` (nulls first), then of role and a hash of the text. Ids are places in the order of all rows, so
    the parent is the place before, if that is of the same conversation.
    """
    named = rows.select(F.col(tree_col).alias("tree"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = [F.col("tree").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.xxhash64("text")]
    placed = ranked(named, order, "id", "turns")
    before = placed.select(F.col("tree").alias("tree_before"), (F.col("id") + 1).alias("id"), F.lit(True).alias("any"))
    joined = placed.join(before, "id", "left")
    follows = F.col("any") & F.col("tree_before").eqNullSafe(F.col("tree"))
    return staged(joined.select(
        "id", F.when(follows, F.col("id") - 1).alias("parent"), "tree", "role", "text", F.lit(0.0).alias("score")), "messages")


def _steps(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestors ``1, 2, 4, ...`` steps up (``id, up``), and depth and path score of every message that has a root."""
    links = messages.where("id is not null").select(
        "id", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).cast("double").alias("total"))
    known = links.select(F.col("id").alias("up"), F.lit(True).alias("known"))
    # messages without a parent are no rows of a join, whose null keys would meet in one task
    replies = links.where("up is not null").join(known, "up", "left")
    replies = replies.select("id", F.when(F.col("known"), F.col("up")).alias("up"), "depth", "total")
    now, steps = staged(links.where("up is null").unionByName(replies), "links"), []
    most = now.count()
    # a path has at most as many messages as there are; what still has an ancestor then is on a cycle
    while (1 << len(steps)) <= most and not (open_ := now.where("up is not null")).isEmpty():
        steps.append(open_.select("id", "up"))
        above = now.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("further"))
        climbed = open_.join(above, "up").select(
            "id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("further")).alias("total"))
        now = staged(now.where("up is null").unionByName(climbed), "links")
    return steps, now.where("up is null").select("id", "depth", "total")


def branches(messages: DataFrame, reached: DataFrame) -> DataFrame:
    """The leaves (``leaf, tree, depth, mean_score, branch``); ``branch`` 1 is the best of its tree.

    The rank within a tree comes from places in the order of all leaves, less the place of the tree's first leaf; no
    tree is gathered.
    """
    parents = messages.where("parent is not null").select(F.col("parent").alias("id")).distinct()
    leaves = messages.select("id", "tree").join(reached, "id").join(parents, "id", "left_anti")
    scored = leaves.select(F.col("id").alias("leaf"), "tree", "depth", (F.col("total") / F.col("depth")).alias("mean_score"))
    order = [F.col("tree").asc_nulls_first(), F.col("mean_score").desc(), F.col("leaf")]
    placed = ranked(scored, order, "place", "leaves")
    first = placed.groupBy(F.col("tree").alias("of")).agg(F.min("place").alias("first"))
    return placed.join(first, F.col("tree").eqNullSafe(F.col("of"))).select(
        "leaf", "tree", "depth", "mean_score", (F.col("place") - F.col("first") + 1).alias("branch"))


def paths(messages: DataFrame, most_branches: int | None = None) -> DataFrame:
    """Every message of the ``most_branches`` best branches of each tree (none: of all), in rows ``leaf, tree, branch, position, id``.

    ``position`` counts from 1 at the root.
    """
    steps, reached = _steps(messages)
    chosen = branches(messages, reached)
    if most_branches is not None:
        chosen = chosen.where(F.col("branch") <= most_branches)
    found = staged(chosen.select("leaf", "tree", "branch", F.col("depth").alias("position"), F.col("leaf").alias("id")), "paths")
    for k in reversed(range(len(steps))):
        higher = found.join(steps[k], "id").select("leaf", "tree", "branch", (F.col("position") - (1 << k)).alias("position"), F.col("up").alias("id"))
        found = staged(found.unionByName(higher), "paths")
    return found


# --- template -----------------------------------------------------------------------------------


def escaped(text: Column) -> Column:
    r"""One backslash more in each ``<|``, ``<\|``, ``<\\|``, ...: no control string is left, and taking one away undoes it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """A role also loses its line breaks, which end it in the template."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def plain(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def plain_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", plain(role))


def formatted(messages: DataFrame, most_branches: int | None = None) -> DataFrame:
    """One row per chosen path: ``leaf, tree, branch, n_turns, formatted`` and ``learned``, the spans of the loss mask.

    A span is start and end (exclusive) in code points of ``formatted``.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(START), escaped_role(role), F.lit("\n"))
    turns = messages.select("id", head.alias("head"), escaped(text).alias("body"), (role == LEARNED).alias("learn"))
    rows = paths(messages, most_branches).join(turns, "id")
    turn = F.struct("position", F.concat("head", "body", F.lit(f"{END}\n")).alias("piece"), F.length("head").alias("before"),
                    F.length("body").alias("inside"), "learn")
    grouped = rows.groupBy("leaf", "tree", "branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # the mask: lengths are added up from turn to turn
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,stop:long>>").alias("spans"))

    def follow(done: Column, t: Column) -> Column:
        begin = done["at"] + t["before"]
        span = F.struct(begin.alias("start"), (begin + t["inside"]).alias("stop"))
        return F.struct((done["at"] + F.length(t["piece"])).alias("at"),
                        F.when(t["learn"], F.array_append(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    return grouped.select(
        "leaf", "tree", "branch", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.aggregate("turns", start, follow)["spans"].alias("learned"))


_TURN = re.compile(re.escape(START) + "(.*?)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def turns_of(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    found, at = [], 0
    for turn in _TURN.finditer(text):
        if turn.start() != at:
            break
        found.append((plain_role(turn[1]), plain(turn[2])))
        at = turn.end()
    if at != len(text):
        raise ValueError(f"not a formatted conversation from character {at} on")
    return found


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of formatted conversations as read from their text and mask.

    ``tree, branch, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("formatted"), batch.column("learned")):
                text, whole, loss, chars = text.as_py(), hashlib.sha256(), hashlib.sha256(), 0
                turns = turns_of(text)
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                for span in spans.as_py():
                    said = plain(text[span["start"] : span["stop"]])
                    chars += len(said)
                    loss.update(said.encode())
                out.append((len(turns), whole.hexdigest(), chars, loss.hexdigest(), len(text)))
            columns = [pa.array(c) for c in zip(*out)] if out else [pa.array([], t) for t in (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("branch"), *columns], [
                "tree", "branch", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = conversations.schema["tree"].dataType.simpleString()
    return conversations.select("tree", "branch", "formatted", "learned").mapInArrow(
        digested, f"tree {kind}, branch long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
