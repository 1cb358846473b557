"""Spelling variants: words one code point apart, found by probing the edits of each word in Bloom filters.

The vocabulary is put into blocked Bloom filters, one for each word length, whose blocks are 64 bits wide: a probe reads one
place. The filters are broadcast, and every edit of every word is probed without being spelled out: its hash, a sum over the places of
the word, follows from the word's own by taking terms away or adding them. Only the edits that a filter holds are spelled and
shuffled, to an exact join with the vocabulary, which drops what a filter let through in error.

Of two words with a deletion between them the longer one finds the shorter; of two with a replacement, the one with the smaller
letter finds the other. So insertions needn't be probed, and each pair comes up once.

The filters of one round take `ROUND_BYTES` at most. A larger vocabulary is cut by a hash of the words into several rounds, each
with filters of its own, so what is broadcast has a bound that doesn't grow with the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import slices, stored
from siltstone.llm.words import mix

MIN_LENGTH = 7
MIN_COUNT = 2
DOMINANCE = 10  # times its own count that a word's form must occur
MISPRINT = 31  # one in so many (document, word) pairs loses a letter
LETTERS = "A-Za-zÀ-ÿ"
ROUND_BYTES = 16 << 20
BITS = 24  # of a filter for each word
PROBES = 5  # bits of a block that a word sets
LONGEST = 255  # longer words share one filter
_EDITS = 1 << 20  # that are worked out at once
_SPELLED = 16 << 20  # characters that are written out at once

Batches = Iterator[pa.RecordBatch]


def _found(shortest: int):
    runs = re.compile(f"[{LETTERS}]{{{shortest},}}").findall

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch):
                counts: Counter = Counter()
                lowered = pc.ascii_lower(pc.fill_null(part.column(0), ""))
                for text, doc in zip(lowered, part.column(1)):
                    start = f"{doc.as_py() if doc.is_valid else ''}:".encode()
                    seeded = zlib.crc32(start)
                    for word, n in Counter(runs(text.as_py())).items():
                        h = zlib.crc32(word.encode(), seeded)
                        if h % MISPRINT == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < shortest:
                                continue
                        counts[word] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    return run


def vocabulary(docs: DataFrame, shortest: int = MIN_LENGTH, least: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of `shortest` code points or more that occur `least` times or more in all whole texts.

    Words are maximal runs of Latin letters, A-Z lower-cased, counted for each slice of texts before they are shuffled. A word that is
    drawn as a misprint by its document and spelling loses one letter. A null text has no words; a null id counts as
    an empty one in the draw. Repeated rows are counted each.
    """
    found = docs.select("text", "doc_id").mapInArrow(_found(shortest), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def letter_values(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value for each code point."""
    return mix(codes.astype(np.uint64) * np.uint64(0x9E3779B1))


def place_values(count: int) -> np.ndarray:
    """An odd 64-bit value for each place of a word, counted from its end."""
    return mix(np.arange(count, dtype=np.uint64) + np.uint64(1 << 40)) | np.uint64(1)


def _shard(length: int) -> int:
    return min(length, LONGEST + 1)


def _place(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash, and the bits that it has there."""
    spread = mix(hashes)
    block = ((spread >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = np.zeros(len(spread), np.uint64)
    for k in range(PROBES):
        bits |= np.uint64(1) << ((spread >> np.uint64(6 * k)) & np.uint64(63))
    return block.astype(np.int64), bits


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words of each length: their numbers, and their code points one row for each."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    starts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for begin, end in zip(starts, [*starts[1:], len(order)]):
        at = order[begin:end]
        size = int(lengths[at[0]])
        step = max(1, _EDITS // size)
        for k in range(0, len(at), step):
            part = at[k:k + step]
            codes = np.frombuffer("".join([words[i] for i in part]).encode("utf-32-le"), np.uint32)
            yield part, codes.reshape(len(part), size)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (letter_values(codes) * place_values(codes.shape[1])[::-1]).sum(axis=1, dtype=np.uint64)


class Filters(dict):
    """Blocks by word length, one at least for each length that occurs."""

    def holds(self, length: int, hashes: np.ndarray) -> np.ndarray:
        blocks = self.get(_shard(length))
        if blocks is None:
            return np.zeros(len(hashes), bool)
        at, bits = _place(hashes, len(blocks))
        return blocks[at] & bits == bits


def _blocks_of(words: int) -> int:
    return max(1, words * BITS // 64)


def _built(sizes: dict[int, int]):
    def run(batches: Batches) -> Batches:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, codes in by_length(batch.column(0).to_pylist()):
                shard = _shard(codes.shape[1])
                blocks = held.setdefault(shard, np.zeros(sizes[shard], np.uint64))
                at, bits = _place(word_hashes(codes), len(blocks))
                np.bitwise_or.at(blocks, at, bits)
        for shard, blocks in held.items():
            used = np.flatnonzero(blocks)
            for k in range(0, len(used), 1 << 16):
                at = used[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard] * len(at), pa.int32()), pa.array(at), pa.array(blocks[at].view(np.int64))], ["shard", "block", "bits"])

    return run


def build_filters(words: DataFrame, sizes: dict[int, int]) -> Filters:
    """The filters of a round's words; `sizes` has the blocks of each length, which bound what comes to the driver.

    A length's words meet by block, so the driver gets each used block once.
    """
    found = words.select("word").mapInArrow(_built(sizes), "shard int, block bigint, bits bigint")
    packed = found.groupBy("shard", "block").agg(F.bit_or("bits").alias("bits")).toArrow()
    filters = Filters({shard: np.zeros(n, np.uint64) for shard, n in sizes.items()})
    shards = np.asarray(packed["shard"])
    for shard, blocks in filters.items():
        own = np.flatnonzero(shards == shard)
        blocks[np.asarray(packed["block"])[own]] = np.asarray(packed["bits"])[own].view(np.uint64)
    return filters


def edits_held(codes: np.ndarray, letters: np.ndarray, holds) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, letter) of the deletions (letter 0) and of the replacements by a larger letter that `holds` lets through.

    `codes` has words of one length, `letters` all code points in order. Of a run of equal letters only the first is deleted.
    """
    count, size = codes.shape
    values, places = letter_values(codes), place_values(size)[::-1]
    with np.errstate(over="ignore"):
        terms = values * places
        whole = terms.sum(axis=1, dtype=np.uint64)
        # Without the letter at i, those before it move one place towards the end.
        moved = np.zeros((count, size), np.uint64)
        if size > 1:
            np.cumsum(values[:, :-1] * places[1:], axis=1, out=moved[:, 1:])
        after = whole[:, None] - np.cumsum(terms, axis=1)
        deleted = moved + after
    first = np.ones((count, size), bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    row, place = np.nonzero(first)
    held = holds(size - 1, deleted[row, place])
    yield row[held], place[held], np.zeros(held.sum(), np.uint32)

    own = letter_values(letters)
    step = max(1, _EDITS // max(1, count * len(letters)))
    for begin in range(0, size, step):
        part = slice(begin, min(begin + step, size))
        with np.errstate(over="ignore"):
            less = whole[:, None] - terms[:, part]
            replaced = less[:, :, None] + own * places[part, None]
        row, place, letter = np.nonzero(letters > codes[:, part, None])
        held = holds(size, replaced[row, place, letter])
        yield row[held], place[held] + begin, letters[letter[held]]


def _probed(filters, letters: np.ndarray, cut: tuple[int, int]):
    number, rounds = cut

    def run(batches: Batches) -> Batches:
        held = filters.value

        def holds(length: int, hashes: np.ndarray) -> np.ndarray:
            if rounds == 1:
                return held.holds(length, hashes)
            found = np.flatnonzero(round_of(hashes, rounds) == number)
            out = np.zeros(len(hashes), bool)
            out[found] = held.holds(length, hashes[found])
            return out

        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            for numbers, codes in by_length(words):
                step = max(1, _EDITS // (codes.shape[1] * (len(letters) + 1)))
                for begin in range(0, len(numbers), step):
                    for row, place, letter in edits_held(codes[begin:begin + step], letters, holds):
                        some = max(1, _SPELLED // codes.shape[1])
                        for k in range(0, len(row), some):
                            part = slice(k, k + some)
                            at = numbers[row[part] + begin]
                            spelled = [words[i][:p] + (chr(c) if c else "") + words[i][p + 1:]
                                       for i, p, c in zip(at.tolist(), place[part].tolist(), letter[part].tolist())]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(spelled, pa.string()), batch.column(0).take(pa.array(at)), counts.take(pa.array(at))],
                                ["edit", "word", "n"])

    return run


def round_of(hashes: np.ndarray, rounds: int) -> np.ndarray:
    return mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(rounds)


def _in_round(cut: tuple[int, int]):
    number, rounds = cut

    def run(batches: Batches) -> Batches:
        for batch in batches:
            words = batch.column(0).to_pylist()
            kept = [numbers[round_of(word_hashes(codes), rounds) == number] for numbers, codes in by_length(words)]
            if kept:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(kept)))], ["word"])

    return run


def near_words(words: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, n, near, near_n): both directions of each pair of `words` (word, n) that are one insertion, deletion or replacement apart.

    `words` has each word once, and is read several times. An empty table gives no pairs.
    """
    spark = words.sparkSession
    length = F.least(F.char_length("word"), F.lit(LONGEST + 1))
    held = {r["shard"]: r["count"] for r in words.groupBy(length.alias("shard")).count().collect()}
    rounds = max(1, -(-8 * sum(map(_blocks_of, held.values())) // round_bytes))
    sizes = {shard: _blocks_of(-(-n // rounds)) for shard, n in held.items()}
    # At most as many as there are letters in the words' alphabet.
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct().collect()
    letters = np.array(sorted(ord(r["letter"]) for r in letters if r["letter"]), np.uint32)
    pairs = None
    for cut in [(k, rounds) for k in range(rounds)]:
        own = words if rounds == 1 else words.select("word").mapInArrow(_in_round(cut), "word string")
        filters = spark.sparkContext.broadcast(build_filters(own, sizes))
        edits = stored(words.select("word", "n").mapInArrow(
            _probed(filters, letters, cut), "edit string, word string, n bigint"), "edits")
        filters.unpersist()
        pairs = edits if pairs is None else pairs.union(edits)
    other = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = pairs.join(other, F.col("edit") == F.col("near")).select("word", "n", "near", "near_n")
    return found.union(found.select("near", "near_n", "word", "n"))


def variants(words: DataFrame, dominance: int = DOMINANCE, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of `words` (word, n; each word once).

    A word's form is its near word with the largest n, of equal ones the smallest, if that n is `dominance` times its own or more; its
    root is the end of the chain of forms, itself if it has none. Counts grow along a chain by that factor, so chains are
    short and a few joins that double the step reach their ends. An empty table gives an empty result.
    """
    if dominance < 2:
        raise ValueError("the count of a form must be at least twice that of its word")
    near = near_words(words, round_bytes)
    best = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))
    judged = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(best).alias("best"), F.min("n").alias("n"))
    formed = F.col("n") * dominance <= -F.col("best.less")
    judged = stored(judged.select(
        "word", "n_near", F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")), "judged")
    chains = judged.where("form is not null").select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 0
    steps = 1
    while dominance ** steps <= most:  # as many hops as a chain can have
        chains = stored(chains, "chains", small=True)
        onward = chains.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        chains = chains.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
        steps *= 2
    found = words.join(judged, "word", "left").join(chains, "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """The variants of the vocabulary of `docs` (doc_id, text, anything else). Other columns are left out."""
    return variants(stored(vocabulary(docs), "vocabulary"), round_bytes=round_bytes)
