"""Chat formatting by quotation linking.

Messages quote one another as mail does: lines that begin with one or more `>`, as many as the quote is deep. Passages are
runs of lines of one level; they are normalised (A-Z lower-cased, white space single) and hashed. A quoted passage is
joined to the first message whose own words have it, as a whole, a paragraph or a line: in the same conversation before
the quoting turn, else anywhere. Replies make trees, and conversations are put out in reply order, without quotes.

A message that quotes nothing known answers the turn before it. So a conversation is made of branches: each begins with a
message that answers an older turn and goes on in order of turns. A branch comes after all of the branch that it leaves;
of several the one that leaves latest comes first, as in a walk through the tree of replies. Where a branch starts follows
from the sizes of branches, summed up and down the tree by doubling: one row a branch and round, however deep it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.llm.common import broadcast_if_small, carried, dealt_in_order, map_arrow, row_numbers, settle

_LINES = re.compile(r"\r\n|\r|\n")
_MARK = re.compile(r"(?:[ \t]*>)+[ \t]?")
_NO_ID = -(2**63)
#: The branch of a conversation's first messages; a branch that begins with a reply is named by a later turn.
_MAIN = _NO_ID
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def passage_key(text: str) -> bytes | None:
    """128 bits of the normalised passage; None if nothing is left of it."""
    plain = " ".join(re.split(r"[\x20\x09-\x0D]+", text.translate(_UPPER).strip(" \t\n\x0b\x0c\r")))
    return hashlib.blake2b(plain.encode(), digest_size=16).digest() if plain else None


def parse(text: str) -> tuple[str, list[bytes], list[tuple[int, bytes]]]:
    """A message's own text, the keys of its own passages, and level and key of what it quotes."""
    own: list[str] = []
    runs: list[tuple[int, list[str]]] = []  # neighbouring lines of one level; blank lines part them
    blocks: dict[tuple[int, int], list[str]] = {}  # all lines of a level in a block of quotes
    block, level = 0, 0
    for line in _LINES.split(text):
        mark = _MARK.match(line)
        before, level = level, mark[0].count(">") if mark else 0
        words = line[mark.end() :] if mark else line
        block += level > 0 and before == 0
        if not level:
            own.append(words)
        blocks.setdefault((level, block if level else 0), []).append(words)
        if not words.strip():
            runs.append((level, []))
        elif runs and runs[-1][0] == level and level == before:
            runs[-1][1].append(words)
        else:
            runs.append((level, [words]))
    found: dict[tuple[int, bytes], None] = {}
    passages = [(at, "\n".join(lines)) for (at, _), lines in blocks.items()]
    passages += [(at, "\n".join(lines)) for at, lines in runs] + [(at, line) for at, lines in runs for line in lines]
    for at, passage in passages:
        if key := passage_key(passage):
            found[at, key] = None
    return "\n".join(own).strip(), [k for at, k in found if not at], [(at, k) for at, k in found if at]


def parsed(messages: DataFrame) -> DataFrame:
    """row, conv, turn (null as the least), conv_id, role, text without quotes, own keys and quotes of every message."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse(text or "") for text in batch.column("text").to_pylist()]
            quotes = [[{"level": level, "key": key} for level, key in f[2]] for f in found]
            columns = [batch.column(c) for c in names]
            columns += [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.list_(pa.binary())),
                pa.array(quotes, pa.list_(pa.struct([("level", pa.int32()), ("key", pa.binary())]))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "own", "own_keys", "quotes"])

    names = ["conv_id", "turn", "role"]
    typed = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    schema = (
        "conv_id long, turn long, role string, own string, own_keys array<binary>, quotes array<struct<level:int,key:binary>>"
    )
    found = map_arrow(typed, run, schema)
    return found.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce("conv_id", F.lit(_NO_ID)).alias("conv"),
        F.coalesce("turn", F.lit(_NO_ID)).alias("at"),
        "*",
    )


def links(messages: DataFrame) -> DataFrame:
    """row, reply (turn in the same conversation) and source (conv and turn elsewhere) of the rows with a quote that is known.

    Of several quotes the outermost counts, then the latest turn. First messages are found by minima taken before the
    shuffle, so a passage that a third of all messages hold is one row in the join. It has the origins in two conversations
    (ranks are limited before the shuffle, too): the second is for the conversation that holds the first one, but not
    before the quoting turn.
    """
    quotes = settle(
        messages.select("row", "conv", "at", F.explode("quotes").alias("q")).select(
            "row", "conv", "at", "q.level", "q.key"
        ),
        "quotes",
    )
    wanted = broadcast_if_small(settle(quotes.select("key").distinct(), "quote-keys"), 32)
    held = messages.select("conv", "at", F.explode("own_keys").alias("key")).join(wanted, "key", "left_semi")
    firsts = settle(held.groupBy("key", "conv").agg(F.min("at").alias("first")), "quote-firsts")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("conv"))
    least = firsts.select("key", F.struct("conv", "first").alias("origin"), rank.alias("rank")).filter("rank <= 2")
    nth = [F.min(F.when(F.col("rank") == k, F.col("origin"))).alias(name) for k, name in ((1, "source"), (2, "other"))]
    every = settle(least.groupBy("key").agg(*nth), "quote-sources")
    met = quotes.join(broadcast_if_small(firsts, 48), ["key", "conv"], "left").join(
        broadcast_if_small(every, 64), "key", "left"
    )
    before = F.col("first") < F.col("at")
    here = F.when(before, F.struct("level", (-F.col("first")).alias("late")))
    apart = F.when(F.col("source.conv") != F.col("conv"), F.struct("level", "source")).when(
        ~before & F.col("other").isNotNull(), F.struct("level", F.col("other").alias("source"))
    )
    return met.groupBy("row").agg(
        (-F.min(here)["late"]).alias("reply"), F.min(apart)["source"].alias("source")
    )


def branches(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The messages with `branch` (the turn it began with, _MAIN in the first one), and where each branch starts: the number
    of messages of its conversation that come before it.

    A branch is followed by those that leave it, the latest first, each with all that leave it in turn.
    """
    begins = F.when(F.col("reply") != F.col("at") - 1, F.col("at"))
    dealt = dealt_in_order(linked.withColumn("begins", begins), "conv", "at", "row")
    inside = Window.partitionBy("conv", "_part").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("branch", F.max("begins").over(inside)).join(
        carried(dealt, "conv", F.max("begins"), F.max), ["conv", "_part"]
    )
    branch = F.coalesce(F.greatest("branch", "_before"), F.lit(_MAIN)).alias("branch")
    placed = settle(placed.withColumn("branch", branch).drop("_part", "_before"), "quote-branches")
    heads = placed.filter("begins IS NOT NULL").groupBy("conv", "begins").agg(F.min("reply").alias("leaves"))
    at = placed.groupBy("conv", F.col("at").alias("leaves")).agg(F.max("branch").alias("up"))
    own = settle(placed.groupBy("conv", "branch").agg(F.count("*").alias("own")), "quote-sizes")
    tree = heads.join(at, ["conv", "leaves"]).select("conv", F.col("begins").alias("branch"), "leaves", "up")
    tree = settle(tree.join(own, ["conv", "branch"]), "quote-tree")

    # Messages of a branch and all that leave it: what lies less than 1, 2, 4, ... branches below.
    below = _doubled(tree.select("conv", "branch", "up", F.col("own").alias("sum")), _taken_up)
    sized = tree.drop("own").join(below.select("conv", "branch", F.col("sum").alias("size")), ["conv", "branch"])
    # Before a branch come the one it leaves, and what leaves that one later; then what is before that one.
    family = F.concat_ws("/", "conv", "up").alias("family")
    ordered = dealt_in_order(sized.select("*", family, (-F.col("leaves")).alias("late")), "family", "late", "branch")
    earlier = Window.partitionBy("family", "_part").orderBy("late", "branch").rowsBetween(Window.unboundedPreceding, -1)
    summed = ordered.withColumn("past", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    summed = summed.join(carried(ordered, "family", F.sum("size"), F.sum), ["family", "_part"])
    parents = own.select("conv", F.col("branch").alias("up"), "own")
    before = (F.col("past") + F.coalesce("_before", F.lit(0)) + F.col("own")).cast("long").alias("sum")
    offsets = settle(summed.join(parents, ["conv", "up"]).select("conv", "branch", "up", before), "quote-offsets")
    return placed, _doubled(offsets, _handed_down).select("conv", "branch", F.col("sum").alias("starts"))


def _taken_up(state: DataFrame) -> DataFrame:
    """Adds to each branch the sums of those whose `up` it is."""
    given = state.filter(F.col("up") != _MAIN).groupBy("conv", F.col("up").alias("branch")).agg(F.sum("sum").alias("more"))
    met = state.join(given, ["conv", "branch"], "left")
    return met.withColumn("sum", F.col("sum") + F.coalesce("more", F.lit(0))).drop("more")


def _handed_down(state: DataFrame) -> DataFrame:
    """Adds to each branch the sum of its `up`."""
    given = state.select("conv", F.col("branch").alias("up"), F.col("sum").alias("more"))
    met = state.join(given, ["conv", "up"], "left")
    return met.withColumn("sum", F.col("sum") + F.coalesce("more", F.lit(0))).drop("more")


def _doubled(state: DataFrame, added: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(conv, branch, up, sum) after rounds in which `up` is 1, 2, 4, ... branches away: as many as the logarithm of the
    nesting, with one row a branch in each."""
    state = settle(state, "quote-rounds")
    while not state.filter(F.col("up") != _MAIN).isEmpty():
        further = state.select("conv", F.col("branch").alias("up"), F.col("up").alias("next"))
        met = added(state).join(further, ["conv", "up"], "left")
        state = settle(met.select("conv", "branch", F.coalesce("next", F.lit(_MAIN)).alias("up"), "sum"), "quote-rounds")
    return state


def reply_ordered(messages: DataFrame) -> DataFrame:
    """conv_id, position (gapless from 0 in reply order), turn, role, text, reply_to, quotes, source_conv and source_turn.

    `text` has no quotes; `reply_to` is the turn that is answered: that of the outermost known quote, else the turn before
    by number, null for a conversation's first message. `source_*` is where a passage quoted from another conversation
    came from. Null conv_ids make one conversation, a null turn comes first in its own, null text counts as empty.
    Repeated rows are messages of their own at the same turn. Further columns are left out. No rows give no rows.
    """
    read = settle(parsed(messages), "messages")
    linked = read.drop("own_keys").join(broadcast_if_small(settle(links(read), "quote-links"), 64), "row", "left")
    placed, starts = branches(linked)
    met = placed.join(broadcast_if_small(settle(starts, "quote-starts"), 64), ["conv", "branch"], "left")
    ordered = row_numbers(met.withColumn("starts", F.coalesce("starts", F.lit(0))), "conv", "starts", "at", "row")
    starts = broadcast_if_small(settle(read.groupBy("conv").agg(F.min("at").alias("first")), "quote-starts"), 32)
    reply = F.coalesce("reply", F.when(F.col("at") > F.col("first"), F.col("at") - 1))
    return ordered.join(starts, "conv").select(
        "conv_id",
        F.col("_number").alias("position"),
        "turn",
        "role",
        F.col("own").alias("text"),
        reply.alias("reply_to"),
        F.size("quotes").alias("quotes"),
        F.col("source.conv").alias("source_conv"),
        F.col("source.first").alias("source_turn"),
    )
