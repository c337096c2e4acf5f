"""Conversations as one prefix tree: what they share at their start is written once.

A node is a turn in the context of all turns before it. Conversations are put into the order of
their paths, which is the order of a depth-first walk; the first one that passes a node leads it
and writes it. So every conversation writes one stretch of nodes, those that nobody before it
has, and all stretches in a row are the token stream of the forest. A token here is a code point.
A node's position ids continue those of its parent, and it attends to its ancestors, which are a
few intervals of the stream.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import col
from millrace.operators.numbering import number_rows
from millrace.session import materialise

START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|n|>"
LEARNED = "assistant"
ROW = 256  # turns handled as one row
STRETCH = math.inf  # turns from its start that a conversation may share with others: all of them
BLOCK = 4096  # rows whose running totals are one task's; pieces of a conversation put into one piece


@dataclass
class Forest:
    """``nodes``: node, branch, place, position, role, segment, loss_first, loss_end, attends. ``paths``: conv_id, spans.

    ``node`` numbers the stream, ``place`` is a node's first token in it, ``position`` the position
    id of that token; both rise by one from token to token. ``attends`` are the intervals of places
    that the last token of the node sees, itself included; an earlier token sees what lies
    before it. Tokens from ``loss_first`` to ``loss_end`` of the segment are under the loss mask;
    both are null where nothing is. ``spans`` are the intervals of nodes that make up a conversation.
    """

    nodes: DataFrame
    paths: DataFrame


def escaped(text: Column) -> Column:
    r"""Without ``<|``: every ``<`` and ``|`` with only backslashes between them get one more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def segment(role: Column, text: Column) -> Column:
    """One turn in the template. The role ends at the line end, so its own line ends are control strings."""
    role = F.replace(escaped(F.coalesce(role, F.lit(""))), F.lit("\n"), F.lit(LINE))
    return F.concat(F.lit(START), role, F.lit("\n"), escaped(F.coalesce(text, F.lit(""))), F.lit(END))


def _header(written: Column) -> Column:
    return F.char_length(F.substring_index(written, "\n", 1)) + 1


def role_of(written: Column) -> Column:
    role = F.substr(F.substring_index(written, "\n", 1), F.lit(len(START) + 1))
    return unescaped(F.replace(role, F.lit(LINE), F.lit("\n")))


def text_of(written: Column, first: Column | None = None, end: Column | None = None) -> Column:
    """The text between the marks, or between two places of the segment."""
    first = _header(written) if first is None else first
    end = F.char_length(written) - len(END) if end is None else end
    return unescaped(F.substr(written, first.cast("int") + 1, (end - first).cast("int")))


def _before(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """With sums ``before_<value>`` over all rows of a smaller key; keys are dense numbers.

    Blocks of rows are summed first, so no task walks along all of them.
    """
    block = F.floor(F.col(key) / BLOCK)
    inside = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(block.alias("_block")).agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    sums = sums.select("_block", *[F.coalesce(F.sum(f"_sum_{v}").over(ahead), F.lit(0)).alias(f"_ahead_{v}") for v in values])
    rows = df.withColumn("_block", block)
    rows = rows.withColumns({f"_in_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    total = {f"before_{v}": F.col(f"_in_{v}") + F.col(f"_ahead_{v}") for v in values}
    return rows.join(sums, "_block").withColumns(total).select(*df.columns, *total)


def _stretches(written: DataFrame) -> DataFrame:
    """conv_id, stretch, turns, chars, before, seed, n: up to ROW turns (k, key, chars), after ``before`` code points of the conversation.

    ``seed`` is a digest of all earlier stretches: the sum of the digests of their places and turns, in four parts.
    """
    narrow = written.select("conv_id", "turn", F.unhex(F.md5("segment")).alias("key"), F.char_length("segment").cast("long").alias("chars"))
    numbered = number_rows(narrow, "turn", "k", within=["conv_id"], start=0)
    rows = numbered.groupBy("conv_id", F.floor(F.col("k") / ROW).alias("stretch")).agg(
        F.sort_array(F.collect_list(F.struct("k", "key", "chars"))).alias("turns"), F.sum("chars").alias("chars")
    )
    rows = materialise(rows, "stretches")
    # a conversation of any length is narrow here: one row for each ROW of its turns
    keys = F.array_join(F.transform("turns", lambda t: F.hex(t.key)), ",")
    narrow = rows.select("conv_id", "stretch", "chars", F.md5(F.concat(F.col("stretch").cast("string"), F.lit(","), keys)).alias("digest"))
    parts = {f"part_{i}": F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)}
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    seed = F.unhex(F.md5(F.concat_ws(",", *[F.sum(part).over(earlier) for part in parts])))
    starts = narrow.withColumns(parts).select("conv_id", "stretch", F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("before"), seed.alias("seed"))
    starts = starts.alias("s")
    same = F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("r.stretch") == F.col("s.stretch"))
    return rows.alias("r").join(starts, same).select("r.*", "s.before", "s.seed", F.size("r.turns").cast("long").alias("n"))


def _tails(stretches: DataFrame) -> DataFrame:
    """conv_id, tail: what follows the first stretch, where something does; tails compare as the turns in them.

    Pieces of conversations are named by their rank among all distinct ones, and names are put into longer
    pieces until each conversation is one; a name stands for as many turns in all pieces but the last ones.
    """
    rows = stretches.filter("stretch > 0").select("conv_id", (F.col("stretch") - 1).alias("at"), F.transform("turns", lambda t: t.key).alias("tail"))
    while rows.agg(F.max("at")).head()[0]:
        names = number_rows(rows.select("tail").distinct(), "tail", "rank", start=0)
        pieces = rows.join(names, "tail").groupBy("conv_id", F.floor(F.col("at") / BLOCK).alias("piece"))
        pieces = pieces.agg(F.sort_array(F.collect_list(F.struct("at", "rank"))).alias("names"))
        rows = materialise(pieces.select("conv_id", F.col("piece").alias("at"), F.transform("names", lambda x: x.rank).alias("tail")), "tails")
    return rows.select("conv_id", "tail")


def _ahead(turns: str) -> Column:
    """Code points of the turns before each one in the array."""
    return F.transform(turns, lambda x, i: F.aggregate(F.slice(turns, F.lit(1), i), F.lit(0).cast("long"), lambda s, t: s + t.chars))


def _led(stretches: DataFrame) -> DataFrame:
    """o, leader, first_k, end_k, first, end: whom each conversation meets on its path, and where."""
    # a node is known by the digest of its parent's digest and its own turn
    digests = F.aggregate(
        "turns",
        F.array().cast("array<binary>"),
        lambda done, t: F.array_append(done, F.unhex(F.md5(F.concat(F.coalesce(F.try_element_at(done, F.lit(-1)), F.col("seed")), t.key)))),
    )
    met = F.arrays_zip(digests.alias("node"), F.col("turns").alias("turn"), _ahead("turns").alias("ahead"))
    met = stretches.select("o", "before", F.inline(met)).filter(F.col("turn.k") < STRETCH)
    met = met.select("o", "node", "turn.k", "turn.chars", (F.col("before") + F.col("ahead")).alias("at"))
    leaders = met.groupBy("node").agg(F.min("o").alias("leader"))
    return met.join(leaders, "node").groupBy("o", "leader").agg(
        F.min("k").alias("first_k"), (F.max("k") + 1).alias("end_k"), F.min("at").alias("first"), F.max(F.col("at") + F.col("chars")).alias("end")
    )


def _joined(intervals: str) -> Column:
    """Ascending intervals of a column, those that touch put together."""
    firsts = F.filter(intervals, lambda x, i: ~F.get(intervals, i - 1).end.eqNullSafe(x.first))
    ends = F.filter(intervals, lambda x, i: ~F.get(intervals, i + 1).first.eqNullSafe(x.end))
    return F.transform(F.arrays_zip(firsts.alias("a"), ends.alias("b")), lambda x: F.struct(x.a.first.alias("first"), x.b.end.alias("end")))


def format_conversations(rows: DataFrame) -> Forest:
    """The forest of all conversations of ``rows`` (conv_id, turn, role, text; other columns are left out).

    Turns go by ``turn``, nulls first, equal ones by the digest of their segment; repeated rows are turns
    of their own. Null roles and texts are empty; rows with a null conv_id are one conversation. Starts of any
    length are shared, and equal conversations share all nodes. A conversation of any length is many rows.
    """
    written = rows.select("conv_id", "turn", segment(col("role"), col("text")).alias("segment"))
    stretches = materialise(_stretches(written), "stretches")
    whole = stretches.groupBy("conv_id").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars")).alias("w")
    heads = stretches.filter("stretch = 0").select("conv_id", F.transform("turns", lambda t: t.key).alias("head")).alias("h")
    heads = heads.join(whole, F.col("h.conv_id").eqNullSafe(F.col("w.conv_id"))).join(_tails(stretches).alias("t"), F.col("h.conv_id").eqNullSafe(F.col("t.conv_id")), "left")
    heads = number_rows(heads.select("h.conv_id", F.struct("head", "tail").alias("path"), "n", "w.chars"), "path", "o", start=0)
    heads = materialise(heads.drop("path"), "paths")
    order = heads.select("conv_id", "o").alias("h")
    led = stretches.alias("s").join(order, F.col("s.conv_id").eqNullSafe(F.col("h.conv_id"))).select("h.o", "turns", "before", "seed")
    led = materialise(_led(led), "led")

    # what is left after the shared start is a branch
    shared = led.filter("leader < o").groupBy("o").agg(F.max("end_k").alias("k"), F.max("end").alias("at"))
    branches = heads.select("conv_id", "o", "n", "chars").join(shared, "o", "left").na.fill(0, ["k", "at"])
    branches = branches.select("conv_id", "o", "k", "at", (F.col("n") - F.col("k")).alias("own"), (F.col("chars") - F.col("at")).alias("own_chars"))
    branches = materialise(_before(branches, "o", ["own", "own_chars"]), "branches")

    by = branches.select(F.col("o").alias("leader"), F.col("before_own") - F.col("k"), F.col("before_own_chars") - F.col("at")).toDF("leader", "to_node", "to_place")
    spans = led.filter("leader < o").join(by, "leader").select(
        "o",
        F.struct(
            "first_k",
            F.struct((F.col("first_k") + F.col("to_node")).alias("first"), (F.col("end_k") + F.col("to_node")).alias("end")).alias("nodes"),
            F.struct((F.col("first") + F.col("to_place")).alias("first"), (F.col("end") + F.col("to_place")).alias("end")).alias("places"),
        ).alias("span"),
    )
    # s spans are s starts of others, no two equally long: a conversation with many is in a table with s * s / 2 turns
    spans = spans.groupBy("o").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    branches = branches.join(spans, "o", "left")
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    above = F.coalesce(F.transform("spans", lambda s: s.places), none)
    through = F.coalesce(F.transform("spans", lambda s: s.nodes), none)
    own = F.struct(F.col("before_own").alias("first"), (F.col("before_own") + F.col("own")).alias("end"))
    through = F.when(F.col("own") > 0, F.array_append(through, own)).otherwise(through)
    branches = materialise(branches.withColumn("above", above).withColumn("through", through).drop("spans"), "branches")
    paths = branches.select("conv_id", _joined("through").alias("spans"))

    # the nodes of a branch see the intervals above it, the last of which may touch the branch's own
    branches = branches.select("conv_id", "o", "k", "at", "before_own", "before_own_chars", _joined("above").alias("above"))
    last = F.try_element_at("above", F.lit(-1))
    touches = F.coalesce(last.end == F.col("before_own_chars"), F.lit(False))
    branches = branches.withColumn("since", F.when(touches, last.first).otherwise(F.col("before_own_chars")))
    branches = branches.withColumn("above", F.slice("above", F.lit(1), F.size("above") - touches.cast("int")))

    s, b = stretches.alias("s"), branches.alias("b")
    met = s.join(b, F.col("s.conv_id").eqNullSafe(F.col("b.conv_id"))).select("s.turns", "s.before", "b.*")
    met = met.select("*", F.inline(F.arrays_zip(F.col("turns").alias("t"), _ahead("turns").alias("ahead"))))
    place = F.col("before_own_chars") + F.col("before") + F.col("ahead") - F.col("at")
    nodes = met.filter(F.col("t.k") >= F.col("k")).select(
        (F.col("before_own") + F.col("t.k") - F.col("k")).alias("node"),
        F.col("o").alias("branch"),
        place.alias("place"),
        (F.col("before") + F.col("ahead")).alias("position"),
        F.col("t.key").alias("key"),
        F.array_append("above", F.struct(F.col("since").alias("first"), (place + F.col("t.chars")).alias("end"))).alias("attends"),
    )
    texts = written.groupBy(F.unhex(F.md5("segment")).alias("key")).agg(F.max("segment").alias("segment"))
    learned = role_of(F.col("segment")) == LEARNED
    nodes = nodes.join(texts, "key").select(
        "node", "branch", "place", "position", role_of(F.col("segment")).alias("role"), "segment",
        F.when(learned, _header(F.col("segment"))).alias("loss_first"),
        F.when(learned, F.char_length("segment") - len(END)).alias("loss_end"),
        "attends",
    )
    return Forest(materialise(nodes, "nodes"), materialise(paths, "paths"))


def _turns(forest: Forest) -> DataFrame:
    """conv_id, k (a place in its conversation), segment, loss_first, loss_end of every turn."""
    spans = forest.paths.select("conv_id", F.posexplode("spans").alias("at", "span")).select("conv_id", "at", "span.*")
    # a span of any length: first in steps, then node by node
    steps = spans.select("conv_id", "at", "end", F.explode(F.sequence("first", F.col("end") - 1, F.lit(BLOCK).cast("long"))).alias("step"))
    each = steps.select("conv_id", "at", F.explode(F.sequence("step", F.least(F.col("step") + BLOCK, "end") - 1)).alias("node"))
    return each.join(forest.nodes, "node").select("conv_id", F.struct("at", "node").alias("k"), "segment", "loss_first", "loss_end")


def _parsed(turns: DataFrame, *columns: str) -> DataFrame:
    written = F.col("segment")
    masked = F.coalesce(text_of(written, F.col("loss_first"), F.col("loss_end")), F.lit(""))
    return turns.select(*columns, role_of(written).alias("role"), text_of(written).alias("text"), masked.alias("learned"))


def read_back(forest: Forest) -> DataFrame:
    """conv_id, k, segment, role, text, learned: every turn of every conversation, from the forest alone.

    ``learned`` is the text under the loss mask, empty where nothing is.
    """
    return _parsed(_turns(forest), "conv_id", "k", "segment")


def digests(forest: Forest) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation, read back.

    A digest goes through the turns in their order, one at a time, so its task holds one batch of them.
    """
    turns = _turns(forest)
    kind = dict(turns.dtypes)["conv_id"]
    # a segment is taken apart only after it has been shuffled
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "k").withColumn("chars", F.char_length("segment"))
    ordered = _parsed(ordered, "conv_id", "chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None  # conv_id, n_turns, digest, loss_chars, digest, formatted_chars
        done: list[list] = []

        def closed() -> pa.RecordBatch:
            rows = [[r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]] for r in done]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=names)

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.null(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            types[0] = batch.schema.field("conv_id").type
            for conv, chars, role, text, learned in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                now[3] += len(learned)
                now[4].update(learned.encode())
                now[5] += chars
            if done:
                yield closed()
        if now is not None:
            done.append(now)
            yield closed()

    return ordered.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
