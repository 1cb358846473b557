"""Byte-level BPE: texts to token ids by the merge ranks of a public vocabulary, and ids back to bytes.

A long text is cut into chunks that overlap. Each chunk is split into pre-tokens on its own, from wherever it happens to start;
where two neighbours have a pre-token boundary in common inside the overlap, they agree from there on, because the pattern
never looks back. The text is stitched at those places, and the pieces between them are encoded apart from each other. From an
overlap without a common boundary (one pre-token fills it) to the end, the text stays in one piece. Ids are held as little-endian
unsigned 32-bit integers; decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import slices, stored, typed

CHUNK = 32_768  # characters
OVERLAP = 512
_AHEAD = 4  # characters that the pattern may look at beyond a boundary
_KEPT = 250_000  # words, and matches of the pattern, that a worker remembers, twice over
_NONE = 1 << 62
_BYTES = [bytes([b]) for b in range(256)]
_GAP, _SINGLE = re.compile(r"\s | \s"), re.compile(r"(?<=\S) (?=\S)")


def _merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair of lowest rank is merged first, of equal ones the leftmost."""
    if piece in ranks:
        return [ranks[piece]]
    count = len(piece)
    if count <= 64:
        get, parts = ranks.get, [_BYTES[b] for b in piece]
        pairs = [get(piece[i:i + 2], _NONE) for i in range(count - 1)]
        while pairs:
            best = min(pairs)
            if best == _NONE:
                break
            at = pairs.index(best)
            joined = parts[at] + parts.pop(at + 1)
            parts[at] = joined
            del pairs[at]
            if at < len(pairs):
                pairs[at] = get(joined + parts[at + 1], _NONE)
            if at:
                pairs[at - 1] = get(parts[at - 1] + joined, _NONE)
        return [ranks[p] for p in parts]
    # Long ones: a heap of pairs over linked parts.
    ends, after, before = list(range(1, count + 1)), list(range(1, count + 1)), list(range(-1, count - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < count:
            end = ends[after[i]]
            rank = ranks.get(piece[i:end])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end))

    for i in range(count - 1):
        offer(i)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not ends[i] or after[i] >= count or ends[after[i]] != end:
            continue
        gone = after[i]
        ends[i], after[i], ends[gone] = end, after[gone], 0
        if after[i] < count:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    found, i = [], 0
    while i < count:
        found.append(ranks[piece[i:ends[i]]])
        i = after[i]
    return found


class _Memory(dict):
    """Packed ids of texts by `find`. When it is full it is begun anew, and what is asked for again is taken over from the one before."""

    def __init__(self, find: Callable[[str], bytes]):
        self.find, self.before = find, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.before.get(text)
        if ids is None:
            ids = self.find(text)
        if len(text) <= 64:
            if len(self) >= _KEPT:
                self.before = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Codec:
    """Encodes and decodes by one file of ranks; remembers words.

    A match of the pattern never goes on past a single space between two characters that are no white space, and starts with
    it if it holds it at all: with `apart` such a text is encoded word by word. That holds for patterns whose only
    spaces are an optional one in front and runs of white space.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        by_id = {v: k for k, v in self.ranks.items()}
        self.pieces = pa.array([by_id.get(i) for i in range(max(by_id, default=-1) + 1)], pa.large_binary())
        self.split = regex.compile(pattern)
        self.matched = _Memory(self._match)  # words with other marks beside them have matches in common
        self.spaced = _Memory(lambda word: self.plain(f" {word}"))
        self.apart = all(len(self.split.findall(f"{a} {b}")) > 1 and self.split.match(f"{a} {b}").end() == len(a)
                         for a in ("a", "1", "!", "'", "é", "'s") for b in ("b", "2", "?", "'", "漢", "'s", "'re"))

    def _match(self, match: str) -> bytes:
        ids = _merge(match.encode(), self.ranks)
        return pack(f"<{len(ids)}I", *ids)

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.matched.__getitem__, self.split.findall(text)))

    def encode(self, text: str) -> bytes:
        if not self.apart:
            return self.plain(text)
        first, *rest = _SINGLE.split(text) if _GAP.search(text) else text.split(" ")
        return self.plain(first) + b"".join(map(self.spaced.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        found = self.pieces.take(pa.array(np.frombuffer(ids, "<u4")))
        if found.null_count:
            raise KeyError("an id without an entry")
        if not len(found):
            return b""
        _, offsets, data = found.buffers()
        ends = np.frombuffer(offsets, "<i8")
        first, last = int(ends[found.offset]), int(ends[found.offset + len(found)])
        return data[first:last].to_pybytes()

    def boundaries(self, text: str) -> list[int]:
        return [m.start() for m in self.split.finditer(text)]


@cache
def codec(path: str, pattern: str) -> Codec:
    """One for each worker."""
    return Codec(path, pattern)


Batches = Iterator[pa.RecordBatch]


def _encode(path: str, pattern: str, decoded: bool = False) -> Callable[[Batches], Batches]:
    """Replaces the first column, texts, by their ids, and if `decoded` the bytes of these."""

    def run(batches: Batches) -> Batches:
        own = codec(path, pattern)
        for batch in batches:
            for part in slices(batch):
                found = [own.encode(t.as_py() or "") for t in part.column(0)]
                back = [pa.array(map(own.decode, found), pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.binary()), *back, *part.columns[1:]],
                    ["ids", *["decoded"] * decoded, *part.schema.names[1:]])

    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch):
                for i in range(part.num_rows):
                    text = part.column(0)[i].as_py()
                    starts = range(0, max(len(text) - overlap, 1), chunk)
                    for begin in range(0, len(starts), 256):
                        at = starts[begin:begin + 256]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([text[s:s + chunk + overlap] if s != starts[-1] else text[s:] for s in at], pa.string()),
                            pa.array([part.column(1)[i].as_py()] * len(at), pa.int64()),
                            pa.array(range(begin, begin + len(at)), pa.int32()),
                            pa.array([s == starts[-1] for s in at], pa.bool_())], ["chunk", "row", "k", "last"])

    return run


def _edges(path: str, pattern: str, chunk: int, overlap: int):
    def run(batches: Batches) -> Batches:
        own = codec(path, pattern)
        for batch in batches:
            heads, tails = [], []
            for text, last in zip(batch.column(0), batch.column(3)):
                text = text.as_py()
                at = own.boundaries(text)
                heads.append([p for p in at if p < overlap])
                # Not after white space: the match before would look different at the end of a piece.
                tails.append([] if last.as_py() else [
                    p - chunk for p in at if chunk <= p <= len(text) - _AHEAD and not text[p - 1].isspace()])
            kind = pa.list_(pa.int32())
            sizes = pa.array([len(t.as_py()) for t in batch.column(0)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:4], sizes, pa.array(heads, kind), pa.array(tails, kind)], ["row", "k", "last", "size", "heads", "tails"])

    return run


def _joined(path: str, pattern: str, decoded: bool):
    def run(batches: Batches) -> Batches:
        own = codec(path, pattern)
        for batch in batches:
            found = [b"".join(parts.as_py()) for parts in batch.column(0)]
            back = [pa.array(map(own.decode, found), pa.binary())] if decoded else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), *back, batch.column(1)], ["ids", *["decoded"] * decoded, "row"])

    return run


def encode(
    docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, decoded: bool = False,
) -> DataFrame:
    """The columns of `docs` but text, after a first column `token_ids`: binary, 4 bytes for each id.

    With `decoded`, a column of that name follows with the bytes that the ids decode to.

    The ids are those of whole texts: each match of `pattern` is merged on its own, without special tokens. `path` is a
    file of ranks that every executor has. A null or empty text has no ids. Repeated rows are encoded alike. A column of
    the name `token_ids` is replaced; an empty table gives an empty result.
    """
    back = ["decoded"] * decoded
    columns = [c for c in docs.columns if c not in ("text", "token_ids", *back)]
    rows = docs.select(F.coalesce("text", F.lit("")).alias("own_text"), F.struct(F.lit(0).alias("_"), *columns).alias("own_row"))
    length = F.length("own_text")
    kind = rows.schema["own_row"].dataType
    both = {c: "binary" for c in ("ids", *back)}
    short = rows.where(length <= chunk).mapInArrow(_encode(path, pattern, decoded), typed(**both, own_row=kind))

    # Only long texts are shuffled.
    long = stored(rows.where(length > chunk).withColumn("row", F.monotonically_increasing_id()), "long")
    chunks = stored(long.select("own_text", "row").mapInArrow(
        _cut(chunk, overlap), "chunk string, row bigint, k int, last boolean").repartition("row", "k"), "chunks")
    edges = stored(chunks.mapInArrow(
        _edges(path, pattern, chunk, overlap), "row bigint, k int, last boolean, size int, heads array<int>, tails array<int>"), "edges", small=True)
    cuts = edges.select("row", (F.col("k") + 1).alias("k"), "tails").join(edges.select("row", "k", "heads"), ["row", "k"]).select(
        "row", "k", F.array_min(F.array_intersect("tails", "heads")).alias("cut"))
    # A chunk is known to have found the true boundaries if it and all before it have a cut; the others go on in one piece.
    sure = cuts.where("cut is not null").groupBy("row").agg(F.array_sort(F.collect_list("k")).alias("starts")).select(
        "row", F.size(F.filter("starts", lambda s, i: s == i + 1)).alias("sure"))
    plan = edges.select("row", "k", "last", "size").join(cuts, ["row", "k"], "left").join(
        cuts.select("row", (F.col("k") - 1).alias("k"), F.col("cut").alias("next")), ["row", "k"], "left").join(
        sure, "row", "left").withColumn("sure", F.coalesce("sure", F.lit(0)))
    begin = F.when(F.col("k") <= F.col("sure"), F.coalesce("cut", F.lit(0))).otherwise(0)
    upto = F.when(F.col("last"), F.col("size")).otherwise(chunk + F.when(F.col("k") < F.col("sure"), F.col("next")).otherwise(0))
    whole = (F.col("k") < F.col("sure")) | (F.col("k") == F.col("sure")) & F.col("last")
    plan = stored(plan.select(
        "row", "k", F.least("k", "sure").alias("piece"), begin.alias("begin"), (upto - begin).alias("length"), whole.alias("whole")), "plan", small=True)
    parts = chunks.join(plan.hint("merge"), ["row", "k"]).select(
        F.expr("substring(chunk, begin + 1, length)").alias("text"), "row", "k", "piece", "whole")
    joined = parts.where("not whole").groupBy("row", "piece").agg(F.array_sort(F.collect_list(F.struct("k", "text"))).alias("p")).select(
        F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"), "row", "piece")
    pieces = parts.where("whole").select("text", "row", "piece").union(joined)
    encoded = stored(pieces.mapInArrow(_encode(path, pattern), "ids binary, row bigint, piece int"), "pieces")
    long_ids = encoded.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p")).select(
        F.transform("p", lambda x: x["ids"]).alias("parts"), "row").mapInArrow(_joined(path, pattern, decoded), typed(**both, row="bigint"))
    long = long_ids.join(long.select("row", "own_row").hint("merge"), "row").select(*both, "own_row")
    return short.union(long).select(F.col("ids").alias("token_ids"), *back, *[F.col("own_row").getField(c).alias(c) for c in columns])


def _decode(path: str, pattern: str):
    def run(batches: Batches) -> Batches:
        own = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, field="token_ids"):
                found = pa.array([own.decode(i.as_py() or b"") for i in part.column(0).field("token_ids")], pa.binary())
                yield pa.RecordBatch.from_arrays([found, part.column(0)], ["decoded", "own_row"])

    return run


def decode(frame: DataFrame, path: str, pattern: str) -> DataFrame:
    """The columns of `frame` (token_ids and anything else) after a first column `decoded`: the bytes of the ids.

    Null ids decode to no bytes. An id that the vocabulary lacks fails. A column of the name `decoded` is replaced.
    """
    columns = [c for c in frame.columns if c != "decoded"]
    rows = frame.select(F.struct(*columns).alias("own_row"))
    kind = rows.schema["own_row"].dataType
    return rows.mapInArrow(_decode(path, pattern), typed(decoded="binary", own_row=kind)).select("decoded", "own_row.*")
