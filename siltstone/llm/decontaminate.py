"""Benchmark decontamination: windows of a document the size of a benchmark item, compared by SimHash, then exactly.

Windows and items are sets of word shingles weighted by how often they occur in them. A window's 64-bit SimHash is held against the items'
through a multi-index: eight blocks of eight bits, where a fingerprint within the radius must come within an eighth of it in
at least one block. What the index and the radius let through is verified by the exact weighted similarity, sum of the smaller counts /
sum of the larger ones.

Which items a window is held against is decided by shingles. An item at the similarity asked for lacks no more than a part
of its weight in the window, so one of any shingles that weigh more than that part together must be there: each item is posted
under such shingles, the rarest of the block, and under no others. Items that a document has too few shingles of over all its text are
dropped next. Pairs of windows and items that share nothing are never made, whatever the number of items of one size.

The work is a pass over the documents without a shuffle. Items are taken in blocks of a bounded size. With one block that pass does it all; with
several, it keeps the documents with any posted shingle, found by a bit table of fixed size, and each block goes over those alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import row_print, slices, stored, typed
from siltstone.llm.words import hash_words, mix, split_words, window_hashes

SHINGLE_WORDS = 5
SIMILARITY = 80  # per cent
#: Fingerprints at similarity 0.8 differ in 9.7 of 64 bits on average (standard deviation 2.9).
RADIUS = 24
BLOCK_WORDS = 1_000_000  # of items, sent to the tasks at once
_SIEVE = 1 << 20  # places of a block's bit table
_WIDE_SIEVE = 1 << 27  # of that for all blocks
_ROWS = 1 << 16  # shingles of items that are looked at together

Batches = Iterator[pa.RecordBatch]


def _signs(shingles: np.ndarray) -> np.ndarray:
    """Rows of 64 signs."""
    bits = np.unpackbits(mix(shingles).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """Rows of 8 bytes from rows of 64 sums."""
    return np.packbits(sums > 0, axis=1)


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... for each of the sizes, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _item_shingles(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, shingle, count) of items that have words, by item and shingle; one shorter than `width` is a single shingle."""
    sizes = np.diff(offsets)
    items, found = [], []
    for kind in np.unique(np.minimum(sizes[sizes > 0], width)).tolist():
        own = np.flatnonzero(np.minimum(sizes, width) == kind)
        counts = sizes[own] - kind + 1
        at = np.repeat(offsets[own], counts) + _runs(counts)
        items.append(np.repeat(own, counts))
        found.append(window_hashes(hashes, kind)[at])
    if not items:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    item, shingle = np.concatenate(items), np.concatenate(found)
    order = np.lexsort((shingle, item))
    item, shingle = item[order], shingle[order]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (shingle[1:] != shingle[:-1])
    starts = np.flatnonzero(new)
    return item[starts], shingle[starts], np.diff(np.append(starts, len(item)))


class Items:
    """Items of one block as arrays: their shingles and counts, their fingerprints, and the postings of each shingle width."""

    def __init__(self, ids: list, texts: list[str], width: int, radius: int, similarity: int = SIMILARITY):
        self.radius, self.similarity = radius, similarity
        words, offsets = split_words(pa.array(texts, pa.large_string()), lower=True)
        sizes = np.diff(offsets)
        item, self.shingles, self.counts = _item_shingles(hash_words(words), offsets, width)
        have = np.flatnonzero(sizes)
        item = np.searchsorted(have, item)
        self.ids, self.sizes = [ids[i] for i in have.tolist()], sizes[have]
        self.kinds = np.minimum(self.sizes, width)
        self.starts = np.searchsorted(item, np.arange(len(have) + 1))
        self.totals = self.sizes - self.kinds + 1
        sums = np.zeros((len(have), 64), np.int32)
        for k in range(0, len(item), _ROWS):
            part = slice(k, k + _ROWS)
            np.add.at(sums, item[part], _signs(self.shingles[part]) * self.counts[part, None].astype(np.int32))
        self.prints = _fingerprints(sums)
        # Shingles that weigh more than an item may lack, those in the fewest items first.
        _, place, spread = np.unique(self.shingles, return_inverse=True, return_counts=True)
        order = np.lexsort((self.shingles, spread[place], item))
        before = np.cumsum(self.counts[order]) - self.counts[order]
        weight = before - np.repeat(before[self.starts[:-1]], np.diff(self.starts))
        posted = order[100 * weight <= (100 - similarity) * self.totals[item[order]]]
        self.tables, self.sieves = {}, {}
        for kind in np.unique(self.kinds).tolist():
            own = posted[self.kinds[item[posted]] == kind]
            own = own[np.lexsort((item[own], self.shingles[own]))]
            values, at = np.unique(self.shingles[own], return_index=True)
            self.tables[kind] = values, np.append(at, len(own)), item[own].astype(np.int32)
            self.sieves[kind] = np.zeros(_SIEVE, bool)
            self.sieves[kind][values & np.uint64(_SIEVE - 1)] = True

    def posted_under(self, kind: int, shingles: np.ndarray) -> np.ndarray:
        """The items that are posted under any of some distinct shingles."""
        values, starts, posts = self.tables[kind]
        place = np.searchsorted(values, shingles)
        place = place[values[np.minimum(place, len(values) - 1)] == shingles]
        counts = starts[place + 1] - starts[place]
        return np.unique(posts[np.repeat(starts[place], counts) + _runs(counts)])

    def heavy_enough(self, items: np.ndarray, shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Those of `items` that a text with these (sorted) shingles can hold, by the weight that the two have in common."""
        kept = []
        sizes = self.starts[items + 1] - self.starts[items]
        for part in np.split(np.arange(len(items)), np.flatnonzero(np.diff(np.cumsum(sizes) // _ROWS)) + 1):
            if not len(part):
                continue
            own, n = items[part], sizes[part]
            at = np.repeat(self.starts[own], n) + _runs(n)
            place = np.minimum(np.searchsorted(shingles, self.shingles[at]), len(shingles) - 1)
            common = np.where(shingles[place] == self.shingles[at], np.minimum(counts[place], self.counts[at]), 0)
            kept.append(own[100 * np.add.reduceat(common, np.cumsum(n) - n) >= self.similarity * self.totals[own]])
        return np.concatenate(kept) if kept else items

    def within(self, item: int, prints: np.ndarray) -> np.ndarray:
        """Which of the windows with these fingerprints are within the radius of an item's."""
        apart = np.bitwise_count(prints ^ self.prints[item])
        found = np.flatnonzero((apart <= self.radius // 8).any(axis=1))
        return found[apart[found].sum(axis=1) <= self.radius]


def _windows(places: np.ndarray, inside: int, last: int) -> np.ndarray:
    """Starts, up to `last`, of windows of `inside` shingles that hold any of these places."""
    marks = np.zeros(last + 2, np.int32)
    np.add.at(marks, np.clip(places - inside + 1, 0, last + 1), 1)
    np.add.at(marks, np.minimum(places, last) + 1, -1)
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


def _prints_of(shingles: np.ndarray, starts: np.ndarray, inside: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints of the windows of `inside` shingles at these starts, some at a time."""
    for run in np.split(starts, np.flatnonzero(np.diff(starts) > inside) + 1):
        for k in range(0, len(run), 4096):
            part = run[k:k + 4096]
            low, high = int(part[0]), int(part[-1])
            sums = np.zeros((high + inside - low + 1, 64), np.int32)
            np.cumsum(_signs(shingles[low:high + inside]), axis=0, out=sums[1:])
            yield part, _fingerprints(sums[part - low + inside] - sums[part - low])


def _search(items: Items, hashes: np.ndarray, tally: Callable[..., None] | None = None) -> Iterator[tuple[int, int, int, int, int]]:
    """(item, start, words, common, all) of the best window of one text for each item that it matches.

    `tally` is told how many pairs of windows and items there were, are within the radius, and match.
    """
    count = len(hashes)
    for kind in items.tables:
        if count < kind:
            continue
        shingles = window_hashes(hashes, kind)
        sieved = np.unique(shingles[items.sieves[kind][shingles & np.uint64(_SIEVE - 1)]])
        if not len(sieved):
            continue
        candidates = items.posted_under(kind, sieved)
        if not len(candidates):
            continue
        candidates = items.heavy_enough(candidates, *np.unique(shingles, return_counts=True))
        for item in candidates.tolist():
            own = slice(items.starts[item], items.starts[item + 1])
            wanted = dict(zip(items.shingles[own].tolist(), items.counts[own].tolist()))
            size, total = int(items.sizes[item]), int(items.totals[item])
            inside, last = min(size, count) - kind + 1, max(count - size, 0)
            starts = _windows(np.flatnonzero(np.isin(shingles, items.shingles[own])), inside, last)
            best, near, match = None, 0, 0
            for part, prints in _prints_of(shingles, starts, inside):
                for start in part[items.within(item, prints)].tolist():
                    near += 1
                    seen: dict[int, int] = {}
                    for s in shingles[start:start + inside].tolist():
                        if s in wanted:
                            seen[s] = seen.get(s, 0) + 1
                    common = sum(min(n, wanted[s]) for s, n in seen.items())
                    every = inside + total - common
                    if 100 * common >= items.similarity * every:
                        match += 1
                        if best is None or common * best[3] > best[2] * every:
                            best = start, min(size, count), common, every
            if tally:
                tally(len(starts), near, match)
            if best:
                yield (item, *best)


def _marks(sieves: dict[int, np.ndarray], hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The texts with any shingle that a bit table knows."""
    hit = np.zeros(len(hashes) + 1, np.int64)
    for kind, sieve in sieves.items():
        marks = sieve[window_hashes(hashes, kind) & np.uint64(len(sieve) - 1)]
        hit[1:len(marks) + 1] += marks
    hit = np.cumsum(hit)
    return hit[offsets[1:]] > hit[offsets[:-1]]


def _matches(items: Items, texts: pa.Array) -> Iterator[tuple[int, tuple[int, int, int, int, int]]]:
    """The hits of each text that has any, with its number."""
    words, offsets = split_words(texts, lower=True)
    hashes = hash_words(words)
    for i in np.flatnonzero(_marks(items.sieves, hashes, offsets)).tolist():
        for found in _search(items, hashes[offsets[i]:offsets[i + 1]]):
            yield i, found


def _scan(held):
    def run(batches: Batches) -> Batches:
        items = held.value
        for batch in batches:
            for part in slices(batch):
                hits = list(_matches(items, part.column(0)))
                rows, found = [i for i, _ in hits], [f for _, f in hits]
                at = pa.array(rows, pa.int64())
                column = lambda k, kind: pa.array([f[k] for f in found], kind)
                yield pa.RecordBatch.from_arrays([
                    part.column(1).take(at), part.column(2).take(at), column(0, pa.int32()), column(1, pa.int32()),
                    column(2, pa.int32()), pa.array([f[3] / f[4] for f in found], pa.float64()),
                ], ["doc_id", "text_print", "item", "start", "n_words", "similarity"])

    return run


def _drop(held):
    def run(batches: Batches) -> Batches:
        items = held.value
        for batch in batches:
            for part in slices(batch, field="text"):
                clean = np.ones(part.num_rows, bool)
                clean[[i for i, _ in _matches(items, part.column(0).field("text"))]] = False
                yield part.filter(pa.array(clean))

    return run


def _suspects(held, wanted: bool, field: str | None = None):
    """Rows with, or without, any shingle that the wide bit tables know."""

    def run(batches: Batches) -> Batches:
        sieves = held.value
        for batch in batches:
            for part in slices(batch, field=field):
                words, offsets = split_words(part.column(0) if field is None else part.column(0).field(field), lower=True)
                yield part.filter(pa.array(_marks(sieves, hash_words(words), offsets) == wanted))

    return run


class _Benchmark:
    """The items that have a text, in blocks of about `block_words` words (of six bytes), each collected when it is its turn."""

    def __init__(self, benchmark: DataFrame, width: int, similarity: int, radius: int, block_words: int):
        self.given = benchmark.where("text is not null").select("item_id", "text")
        self.how = width, radius, similarity
        size = self.given.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
        self.count = max(1, -(-size // (6 * block_words)))

    def block(self, k: int) -> Items:
        rows = self.given.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(self.count)) == k).collect()
        return Items([r["item_id"] for r in rows], [r["text"] for r in rows], *self.how)

    def sieves(self) -> dict[int, np.ndarray]:
        """Bit tables of all blocks' posted shingles, whose size doesn't grow with them."""
        found: dict[int, np.ndarray] = {}
        for k in range(self.count):
            for kind, (values, _, _) in self.block(k).tables.items():
                found.setdefault(kind, np.zeros(_WIDE_SIEVE if kind == self.how[0] else _SIEVE, bool))[
                    values & np.uint64((_WIDE_SIEVE if kind == self.how[0] else _SIEVE) - 1)] = True
        return found


def contaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS, similarity: int = SIMILARITY,
    radius: int = RADIUS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, text_print, item_id, start, n_words, similarity): each document with each item that it holds.

    The best window of the document is given, of equal ones the first: its first word, its words, its similarity. Words are runs
    without white space, A-Z lower-cased. An item of fewer than `width` words is one shingle; a document shorter than
    the item is one window. A text that is null or has no words matches nothing, on either side. Repeated documents and
    repeated items give repeated rows; a null id is kept. Other columns are left out; empty tables give an empty result.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    rows = docs.select("text", "doc_id", row_print(F.col("text")).alias("text_print"))
    bench = _Benchmark(benchmark, width, similarity, radius, block_words)
    if bench.count > 1:
        sieves = spark.sparkContext.broadcast(bench.sieves())
        rows = stored(rows.mapInArrow(_suspects(sieves, True), rows.schema), "suspects")
        sieves.destroy()
    found = None
    for k in range(bench.count):
        items = bench.block(k)
        held = spark.sparkContext.broadcast(items)
        schema = typed(doc_id=kind, text_print="bigint", item="int", start="int", n_words="int", similarity="double")
        names = spark.createDataFrame(list(enumerate(items.ids)), typed(item="int", item_id=item_kind))  # of one block
        hits = rows.mapInArrow(_scan(held), schema).join(F.broadcast(names), "item").select(
            "doc_id", "text_print", "item_id", "start", "n_words", "similarity")
        if bench.count > 1:
            hits = stored(hits, "hits", small=True)
            held.destroy()
        found = hits if found is None else found.union(hits)
    return found


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS, similarity: int = SIMILARITY,
    radius: int = RADIUS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """`docs` without the rows that hold a benchmark item; the columns are unchanged, nothing is shuffled."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(*docs.columns).alias("own_row"))
    schema, clean = rows.schema, None
    bench = _Benchmark(benchmark, width, similarity, radius, block_words)
    if bench.count > 1:
        sieves = spark.sparkContext.broadcast(bench.sieves())
        clean = stored(rows.mapInArrow(_suspects(sieves, False, "text"), schema), "clean")
        rows = stored(rows.mapInArrow(_suspects(sieves, True, "text"), schema), "suspects")
        sieves.destroy()
    for k in range(bench.count):
        held = spark.sparkContext.broadcast(bench.block(k))
        rows = rows.mapInArrow(_drop(held), schema)
        if bench.count > 1:
            rows = stored(rows, "kept")
            held.destroy()
    return (rows if clean is None else clean.union(rows)).select("own_row.*")
