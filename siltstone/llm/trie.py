"""The prefix trie of conversations, and totals over its subtrees by time-forward processing.

A node is a sequence of first turns that conversations share. It is known by its depth and 128 bits: the exclusive or of a hash of
(depth, turn) over its turns. Running hashes of very long conversations are taken in spans of turns, whose ends are then
carried over.

Totals go from the leaves to the root. Nodes that few conversations share hang in pieces: below the topmost such node on their
path, and cut again at every multiple of a span of depths. Whole pieces are dealt to shards. Each shard's nodes are sorted by Spark in
reverse level order, deepest first, and gone through once: a node takes the messages addressed to it from a priority queue, adds its
own values, and sends the total to its parent. The queue holds a bounded number of messages; the rest lies in sorted runs
on disk. What the pieces' roots send goes to the crown: the nodes that many conversations share, and those pieces that have
others below them. The crown is gone through in the same way, once, by one task; it has at most `SHARDS` nodes of each depth, whatever the
number of conversations. Pieces with others below them are then gone through again, with what those sent.
"""

from __future__ import annotations

import hashlib
import heapq
import marshal
from collections.abc import Iterator
from itertools import chain
from tempfile import TemporaryFile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.frames import stored

SHARDS = 4096
SPAN = 1024  # turns
QUEUE = 500_000  # messages that a task holds in memory
GROUP = 100  # conversations share heads within so many ids
MOST_SHARED = 5  # turns
_RUNS = 32  # files of spilled messages that a task reads at once
_BLOCK = 4096

Batches = Iterator[pa.RecordBatch]
_KEY = ("depth", "high", "low")
_UP = ("up_depth", "up_high", "up_low")
_PIECE = ("piece_depth", "piece_high", "piece_low")
_TOTALS = ("n_children", "n_leaves", "saved_tokens")


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank, turn_print, chars): the rows of `conversations` (conv_id, turn, role, text, anything else) in their order, from 0.

    Turns are ordered by `turn`, null first, then role, then the digest of both; equal rows are turns of their own. A null
    role or text is empty. Rows without a conv_id belong to no conversation and are left out. The order is made by ranges over all rows,
    so one conversation may hold any share of them.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role), F.lit(":"), role, text))
    keys = ("conv_id", "turn", "role", "digest", "row")
    rows = conversations.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), digest.alias("digest"), F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"))
    rows = stored(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("conv_id", "part").orderBy(*keys[1:])
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv_id", "part").count().select(
        "conv_id", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    numbered = rows.withColumn("k", F.row_number().over(inside)).join(counts, ["conv_id", "part"])
    return stored(numbered.select(
        "conv_id", (F.col("before") + F.col("k") - 1).alias("rank"), F.unhex("digest").alias("turn_print"), "chars"), "ordered")


def plain_paths(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The steps and sizes of conversations as they are, from `ordered` turns."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    steps = turns.select("conv_id", (F.col("rank") + 1).alias("depth"), "turn_print", "chars")
    return steps, stored(sizes, "sizes", small=True)


def with_shared_heads(turns: DataFrame, group: int = GROUP, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Steps and sizes of conversations whose first h turns are those of the first of their group of `group` ids.

    h is the unsigned crc32 of the decimal conv_id modulo `most` + 1. The first h turns come from conversation
    conv_id - conv_id % group, all if it has fewer, none if there is no such one; the conversation's own turns after its first
    h follow. A conversation can come out without a turn; it has a row in the sizes all the same.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1))
    sizes = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes", small=True)
    mine = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("head_id"), h.alias("h"))
    given = sizes.select(F.col("conv_id").alias("head_id"), F.col("n").alias("head_n"))
    mine = mine.join(given, "head_id", "left").withColumn("take", F.least("h", F.coalesce("head_n", F.lit(0))))
    mine = stored(mine.select("conv_id", "head_id", "h", "take", (F.col("take") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")), "heads", small=True)
    heads = turns.where((F.col("rank") < most) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "head_id")
    shared = mine.select("conv_id", "head_id", "take").join(heads, "head_id").where("rank < take").select(
        "conv_id", (F.col("rank") + 1).alias("depth"), "turn_print", "chars")
    own = turns.join(mine.select("conv_id", "h", "take"), "conv_id").where("rank >= h").select(
        "conv_id", (F.col("take") + F.col("rank") - F.col("h") + 1).alias("depth"), "turn_print", "chars")
    return shared.union(own), mine.select("conv_id", "n_turns")


def _paths(steps: DataFrame, sizes: DataFrame, span: int) -> DataFrame:
    """(conv_id, depth, high, low, up_depth, up_high, up_low, chars, ends): each conversation's nodes, the root included."""
    depth = F.col("depth")
    rows = steps.select(
        "conv_id", "depth", "chars", F.floor((depth - 1) / span).alias("span"),
        F.xxhash64("depth", "turn_print").alias("own_high"), F.xxhash64("turn_print", "depth", F.lit(1)).alias("own_low"))
    inside = Window.partitionBy("conv_id", "span").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = stored(rows.select(
        "conv_id", "depth", "chars", "span", "own_high", "own_low",
        F.bit_xor("own_high").over(inside).alias("high"), F.bit_xor("own_low").over(inside).alias("low")), "spans")
    so_far = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.where(depth % span == 0).select(
        "conv_id", (F.col("span") + 1).alias("span"),
        F.bit_xor("high").over(so_far).alias("carry_high"), F.bit_xor("low").over(so_far).alias("carry_low"))
    later = rows.where("span > 0").join(carried, ["conv_id", "span"]).select(
        "conv_id", "depth", "chars", "own_high", "own_low",
        F.col("high").bitwiseXOR(F.col("carry_high")).alias("high"), F.col("low").bitwiseXOR(F.col("carry_low")).alias("low"))
    rows = rows.where("span = 0").select(*later.columns).union(later)
    none = F.lit(0).cast("long")
    nodes = rows.select(
        "conv_id", "depth", "high", "low", (depth - 1).alias("up_depth"), F.col("high").bitwiseXOR(F.col("own_high")).alias("up_high"),
        F.col("low").bitwiseXOR(F.col("own_low")).alias("up_low"), "chars")
    roots = sizes.select("conv_id", none.alias("depth"), none, none, F.lit(-1).cast("long"), none, none, none)
    return nodes.union(roots).join(sizes.select("conv_id", "n_turns"), "conv_id").select(*nodes.columns, (F.col("n_turns") == depth).alias("ends"))


class Messages:
    """A priority queue that holds `limit` messages in memory, and sorted runs of the others on disk.

    The runs are files without a name in the task's own temporary folder, as Spark's sort has; they go with the task.
    """

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.made = limit, [], [], 0

    def send(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) >= self.limit:
            self._spill()

    def _spill(self) -> None:
        held = iter(sorted(self.heap))
        if len(self.runs) >= _RUNS:
            held, self.runs = heapq.merge(held, *[chain((head,), rest) for head, _, rest in self.runs]), []
        file = TemporaryFile()
        while block := [m for _, m in zip(range(_BLOCK), held)]:
            marshal.dump(block, file)
        file.seek(0)
        self.heap, self.made = [], self.made + 1
        self._advance(self.made, self._rest(file))

    @staticmethod
    def _rest(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from marshal.load(file)
                except EOFError:
                    return

    def _advance(self, number: int, rest: Iterator[tuple]) -> None:
        head = next(rest, None)
        if head is not None:
            heapq.heappush(self.runs, (head, number, rest))

    def take(self, key: tuple) -> Iterator[tuple]:
        """The messages for a key; all smaller keys have been asked for before."""
        while self.heap and self.heap[0][:3] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:3] == key:
            message, number, rest = heapq.heappop(self.runs)
            self._advance(number, rest)
            yield message


def _forward(limit: int):
    """Goes through nodes, deepest first: totals are added to n_children, n_leaves and saved_tokens; a `top` sends nothing."""

    def run(batches: Batches) -> Batches:
        messages = Messages(limit)
        for batch in batches:
            held = {name: batch.column(batch.schema.get_field_index(name)).to_pylist() for name in (*_KEY, *_UP, "top", *_TOTALS)}
            children, leaves, saved = (held[name] for name in _TOTALS)
            for i, (depth, high, low, up_depth, up_high, up_low, top) in enumerate(zip(*[held[n] for n in (*_KEY, *_UP, "top")])):
                for message in messages.take((-depth, high, low)):
                    children[i] += 1
                    leaves[i] += message[3]
                    saved[i] += message[4]
                if not top:
                    messages.send((-up_depth, up_high, up_low, leaves[i], saved[i]))
            for name, values in zip(_TOTALS, (children, leaves, saved)):
                batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(values, pa.int64()))
            yield batch
        assert not messages.heap and not messages.runs, "messages without an addressee"

    return run


def _reversed_levels(rows: DataFrame, limit: int) -> DataFrame:
    """`rows`, dealt already, gone through by each task in reverse level order."""
    return rows.sortWithinPartitions(F.desc("depth"), "high", "low").mapInArrow(_forward(limit), rows.schema)


def _named(columns: tuple, names: tuple) -> list[Column]:
    return [F.col(c).alias(n) for c, n in zip(columns, names)]


def _totals(nodes: DataFrame, paths: DataFrame, sizes: DataFrame, convs: int, weight: int, span: int, deepest: int, limit: int) -> DataFrame:
    """The nodes with their totals in place of their own values."""
    heavy = nodes.where(F.col("n_convs") > weight)
    # The root, which all paths have, is known without a join.
    tops = paths.where("depth > 0").select("conv_id", *_KEY).join(heavy.select(*_KEY), list(_KEY)).groupBy("conv_id").agg(
        (F.max("depth") + 1).alias("top_depth"))
    tops = stored(sizes.select("conv_id").join(tops, "conv_id", "left").select(
        "conv_id", F.coalesce("top_depth", F.lit(int(convs > weight))).cast("long").alias("top_depth")), "tops", small=True)
    # The nodes where a conversation's path enters a piece.
    enters = (F.col("depth") == F.col("top_depth")) | (F.col("depth") > F.col("top_depth")) & (F.col("depth") % span == 0)
    cuts = paths.select("conv_id", *_KEY).join(tops, "conv_id").where(enters).select("conv_id", *_named(_KEY, _PIECE))
    light = nodes.where(F.col("n_convs") <= weight).join(tops, "conv_id").withColumn(
        "piece_depth", F.greatest("top_depth", F.col("depth") - F.col("depth") % span)).drop("top_depth")
    light = light.join(cuts, ["conv_id", "piece_depth"]).select(*nodes.columns, *_PIECE)
    top = (F.col("depth") == F.col("piece_depth")) & (F.col("high") == F.col("piece_high")) & (F.col("low") == F.col("piece_low"))
    pieces = light.withColumn("top", top).repartition(*_PIECE)
    partial = stored(_reversed_levels(pieces, limit), "partial")

    roots = partial.where("top")
    none = F.lit(0).cast("long")
    crown = heavy.select(*nodes.columns).withColumns({"top": F.lit(False), **{p: none for p in _PIECE}})
    to_crown, done = roots, partial.drop("top", *_PIECE)
    if deepest >= span:
        # Pieces that others hang on: known by a cut whose parent lies in a piece.
        parents = partial.select(*_named(_KEY, _UP), *_named(_PIECE, ("on_depth", "on_high", "on_low")))
        inner = stored(roots.where((F.col("depth") > 0) & (F.col("depth") % span == 0)).select(*_KEY, *_UP).join(
            parents, list(_UP)), "inner", small=True)
        on = ("on_depth", "on_high", "on_low")
        linked = inner.select(*_named(on, _PIECE)).distinct()
        # A root sends to the piece that its parent lies in, or to the node of the crown that its parent is.
        sent = roots.join(inner.drop(*_UP), list(_KEY), "left")
        sent = sent.withColumns({u: F.coalesce(o, u) for u, o in zip(_UP, on)}).drop(*on)
        crown = crown.union(sent.join(linked, list(_PIECE), "left_semi").withColumn("top", F.lit(False)).select(*crown.columns))
        to_crown = sent.join(linked, list(_PIECE), "left_anti")
        done = partial.join(linked, list(_PIECE), "left_anti").drop("top", *_PIECE)
    raked = to_crown.groupBy(*_UP).agg(
        F.count("*").alias("more_children"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
    raked = raked.select(*_named(_UP, _KEY), "more_children", "more_leaves", "more_saved")
    more = {t: F.col(t) + F.coalesce(m, F.lit(0)) for t, m in zip(_TOTALS, ("more_children", "more_leaves", "more_saved"))}
    crown = crown.join(raked, list(_KEY), "left").withColumns(more).drop("more_children", "more_leaves", "more_saved")
    crown = crown.withColumn("top", F.col("depth") == 0).select(*partial.columns)
    crown = stored(_reversed_levels(crown.repartition(1), limit), "crown")
    done = done.union(crown.where(F.col("n_convs") > weight).select(*done.columns))
    if deepest >= span:
        whole = crown.where(F.col("n_convs") <= weight).select(*_KEY, *_TOTALS)  # roots of pieces that others hang on
        whole = roots.select(*_KEY, *_TOTALS).join(whole.select(*_KEY), list(_KEY), "left_anti").union(whole)
        arrived = whole.join(inner.select(*_KEY, *_UP), list(_KEY)).groupBy(*_UP).agg(
            F.count("*").alias("more_children"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        again = light.join(linked, list(_PIECE), "left_semi").join(arrived.select(
            *_named(_UP, _KEY), "more_children", "more_leaves", "more_saved"), list(_KEY), "left").withColumns(more)
        again = again.select(*light.columns).withColumn("top", top).repartition(*_PIECE)
        done = done.union(_reversed_levels(again, limit).select(*done.columns))
    return done


def _runs(batches: Batches) -> Batches:
    """Sorted (depth, high, low, conv_id): the ids of a node that stand together, joined by commas."""
    for batch in batches:
        if not batch.num_rows:
            continue
        depth, high, low, ids = (np.asarray(c) for c in batch.columns)
        new = np.ones(len(ids), bool)
        new[1:] = (depth[1:] != depth[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        starts = np.flatnonzero(new)
        named = list(map(str, ids.tolist()))
        joined = [",".join(named[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])]
        at = pa.array(starts)
        yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns], pa.array(joined)], [*_KEY, "conv_id", "joined"])


def _digests(batches: Batches) -> Batches:
    """Sorted (depth, high, low, conv_id, joined): one digest for each node, of its runs in order."""
    key = digest = None
    for batch in batches:
        keys, digests = [], []
        for *own, _, joined in zip(*[c.to_pylist() for c in batch.columns]):
            if own == key:
                digest.update(b",")
            else:
                if key:
                    keys.append(key)
                    digests.append(digest.hexdigest())
                key, digest = own, hashlib.sha256()
            digest.update(joined.encode())
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([k[i] for k in keys], pa.int64()) for i in range(3)], pa.array(digests, pa.string())], [*_KEY, "ends_sha256"])
    if key:
        yield pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in key], pa.array([digest.hexdigest()])], [*_KEY, "ends_sha256"])


def _ends(paths: DataFrame) -> DataFrame:
    """(depth, high, low, ends_sha256) of the nodes where conversations end.

    The ids are brought into order by ranges over (node, id), and written as runs in the tasks; then each node's
    runs, a few for each range, are digested one after the other without being held.
    """
    ids = paths.where("ends").select(*_KEY, "conv_id")
    keys = (*_KEY, "conv_id")
    runs = ids.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        _runs, "depth bigint, high bigint, low bigint, conv_id bigint, joined string")
    return runs.repartition(*_KEY).sortWithinPartitions(*keys).mapInArrow(
        _digests, "depth bigint, high bigint, low bigint, ends_sha256 string")


def prefix_trie(steps: DataFrame, sizes: DataFrame, shards: int = SHARDS, span: int = SPAN, limit: int = QUEUE) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `steps` (conv_id, depth from 1 without gaps, turn_print, chars) are the turns of conversations, `sizes` (conv_id, n_turns) has
    all conversations, those without turns too. A node is named by its smallest member and its depth; parent_conv_id is its
    parent's smallest member, null for the root. saved_tokens sums over the subtree each node's members beyond the first times the
    code points of its last text. ends_sha256 is the digest of the ids, ascending and joined by commas, of members that end there. Repeated
    conversations are members of the same nodes. Without any conversation there is no node. The arguments change the cost, not the rows.
    """
    sizes = sizes.withColumn("conv_id", F.col("conv_id").cast("long"))
    paths = _paths(steps.withColumn("conv_id", F.col("conv_id").cast("long")), sizes, span)
    nodes = paths.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), *[F.min(u).alias(u) for u in _UP], F.count("*").alias("n_convs"),
        F.count_if("ends").alias("n_ends"), F.min("chars").alias("chars"))
    nodes = stored(nodes.select(
        *_KEY, *_UP, "conv_id", "n_convs", F.col("n_ends"), F.lit(0).cast("long").alias("n_children"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), "nodes")
    convs, rows, deepest = (v or 0 for v in nodes.agg(F.max("n_convs"), F.sum("n_convs"), F.max("depth")).first())
    weight, span = max(1, convs // shards), max(span, rows // shards)
    done = stored(_totals(nodes, paths, sizes, convs, weight, span, deepest, limit), "totals")
    parents = nodes.select(*_named(_KEY, _UP), F.col("conv_id").alias("parent_conv_id"))
    ends = done.where("n_ends > 0").join(_ends(paths), list(_KEY))
    rest = done.where("n_ends = 0").withColumn("ends_sha256", F.sha2(F.lit(b""), 256)).select(*ends.columns)
    found = ends.union(rest).join(parents, list(_UP), "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", *_TOTALS, "ends_sha256")
