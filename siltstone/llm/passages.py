"""Passages that occur more than once: found through anchors at the positions of a difference cover.

A difference cover of a period holds, for any two positions, an offset below the period that takes both onto it. So any two
equal windows of `window` words share an aligned anchor: a run of `window - period + 1` words that starts on the cover in both
texts. Only anchors are hashed and shuffled, a quarter of the positions with a period of 21. Where an anchor occurs twice, it
is extended: the windows around it are hashed whole (96 bits) and counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.frames import row_print, slices, stored, typed
from siltstone.llm.words import hash_words, split_words, window_hashes

WINDOW_WORDS = 35
PERIOD = 21
_SECOND_BASE = 0x2545F4914F6CDD1D


def difference_cover(period: int) -> list[int]:
    """The first smallest set of residues whose differences are all residues, by search."""
    if period == 1:
        return [0]
    size = 1
    while True:
        size += 1
        if size * (size - 1) + 1 < period:
            continue
        stack = [[0]]
        while stack:
            held = stack.pop()
            if len(held) == size:
                if len({(a - b) % period for a in held for b in held}) == period:
                    return held
                continue
            left = (size - len(held)) * (size + len(held) - 1)
            if len({(a - b) % period for a in held for b in held}) + left >= period:
                stack.extend(held + [k] for k in range(period - 1, held[-1], -1))


def _cover_positions(count: int, cover: np.ndarray, period: int) -> np.ndarray:
    """The positions below `count` on the cover, in order."""
    whole = (np.arange(0, max(count, 0), period)[:, None] + cover).ravel()
    return whole[whole < count]


def _salts(keys: np.ndarray) -> np.ndarray:
    """0 for the only or first of equal keys, which stands for them all; the others are numbered from 1, apart from each other.

    The first of several is negative: -1.
    """
    order = np.argsort(keys, kind="stable")
    equal = np.zeros(len(keys) + 1, bool)
    equal[1:-1] = keys[order][1:] == keys[order][:-1]
    salts = np.zeros(len(keys), np.int32)
    salts[order[equal[:-1]]] = np.arange(1, np.count_nonzero(equal) + 1)
    salts[order[~equal[:-1] & equal[1:]]] = -1
    return salts


def _anchors(window: int, period: int):
    cover, length = np.array(difference_cover(period)), window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words, offsets = split_words(part.column(0))
                hashes = window_hashes(hash_words(words), length)
                at = [_cover_positions(n - length + 1, cover, period) if n >= window else np.zeros(0, np.int64)
                      for n in np.diff(offsets).tolist()]
                sizes = [len(a) for a in at]
                rows = pa.array(np.repeat(np.arange(len(at)), sizes))
                numbers = np.concatenate([np.arange(n) for n in sizes])
                values = hashes[np.concatenate(at) + np.repeat(offsets[:-1], sizes)] if len(rows) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([
                    part.column(1).take(rows), part.column(2).take(rows), pa.array(numbers.astype(np.int32)),
                    pa.array(values.view(np.int64)), pa.array(_salts(values))], ["doc_id", "text_print", "number", "anchor", "salt"])

    return run


def _windows(window: int, period: int):
    cover = np.array(difference_cover(period))
    reach = period - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words, offsets = split_words(part.column(0))
                hashes = hash_words(words)
                one, two = window_hashes(hashes, window), window_hashes(hashes, window, _SECOND_BASE)
                rows, starts = [], []
                for i, numbers in enumerate(part.column(3)):
                    begin, count = offsets[i], offsets[i + 1] - offsets[i] - window + 1
                    n = np.asarray(numbers.values)
                    at = n // len(cover) * period + cover[n % len(cover)]
                    marks = np.zeros(count + 1, np.int32)
                    np.add.at(marks, np.maximum(at - reach, 0), 1)
                    np.add.at(marks, np.minimum(at + 1, count), -1)
                    found = np.flatnonzero(np.cumsum(marks[:-1]))
                    rows.append(np.full(len(found), i))
                    starts.append(found + begin)
                rows, at = np.concatenate(rows), np.concatenate(starts)
                low = (two[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(1).take(pa.array(rows)), part.column(2).take(pa.array(rows)),
                    pa.array((at - offsets[rows]).astype(np.int32)), pa.array(one[at].view(np.int64)), pa.array(low),
                    pa.array(_salts(one[at] ^ two[at])),
                ], ["doc_id", "text_print", "start", "high", "low", "salt"])

    return run


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys occur more than once.

    Rows that a task has seen repeat are known to; each keeps to itself, under its own salt. Only the first of them stands
    for its key here, so a key has one row for each slice of texts at most, however often it occurs.
    """
    known = F.col("salt") != 0
    same = Window.partitionBy(*keys, F.greatest("salt", F.lit(0)))
    counted = rows.withColumn("seen", F.sum(F.when(known, 2).otherwise(1)).over(same))
    return counted.where("seen > 1")


def _without(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts, counts, gone = [], [], []
                for text, starts in zip(part.column(0).cast(pa.large_binary()), part.column(2)):
                    words = text.as_py().split() if text.is_valid else []
                    removed = 0
                    if starts.is_valid:
                        marks = np.zeros(len(words) + 1, np.int32)
                        at = np.asarray(starts.values)
                        np.add.at(marks, at, 1)
                        np.add.at(marks, at + window, -1)
                        free = np.cumsum(marks[:-1]) == 0
                        removed = len(words) - int(free.sum())
                        texts.append(b" ".join([words[k] for k in np.flatnonzero(free)]))
                    else:
                        texts.append(b" ".join(words))
                    counts.append(len(words))
                    gone.append(removed)
                yield pa.RecordBatch.from_arrays([
                    part.column(1), pa.array(texts, pa.binary()).cast(pa.string()),
                    pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], ["doc_id", "text", "n_words", "n_removed"])

    return run


def remove_passages(docs: DataFrame, window: int = WINDOW_WORDS, period: int = PERIOD) -> DataFrame:
    """For each row of `docs` (doc_id, text, anything else): doc_id, text (the words kept, with one space between), n_words, n_removed.

    Every word is removed that lies in a run of `window` words of its text which also starts elsewhere, in the same or any
    other row; what is elsewhere is judged on the input. A text that is null, empty or shorter than `window` words loses
    nothing (a null one comes back empty). Repeated rows are occurrences of each other. A null doc_id is like any other.
    Other columns are left out; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType
    texts = docs.select("text", "doc_id", row_print(F.col("text")).alias("text_print"))
    anchors = texts.mapInArrow(
        _anchors(window, period), typed(doc_id=kind, text_print="bigint", number="int", anchor="bigint", salt="int"))
    hits = stored(
        _repeated(anchors, "anchor").groupBy("doc_id", "text_print").agg(F.collect_set("number").alias("numbers")), "hits", small=True)
    hits = hits.withColumnsRenamed({"doc_id": "hit_id", "text_print": "hit_print"})
    near = texts.join(hits, texts.doc_id.eqNullSafe(hits.hit_id) & (texts.text_print == hits.hit_print))
    windows = near.select("text", "doc_id", "text_print", "numbers").mapInArrow(
        _windows(window, period), typed(doc_id=kind, text_print="bigint", start="int", high="bigint", low="int", salt="int"))
    spans = stored(
        _repeated(windows, "high", "low").groupBy("doc_id", "text_print").agg(F.collect_set("start").alias("starts")), "spans", small=True)
    spans = spans.withColumnsRenamed({"doc_id": "hit_id", "text_print": "hit_print"})
    marked = texts.join(spans, texts.doc_id.eqNullSafe(spans.hit_id) & (texts.text_print == spans.hit_print), "left")
    return marked.select("text", "doc_id", "starts").mapInArrow(
        _without(window), typed(doc_id=kind, text="string", n_words="bigint", n_removed="bigint"))
