"""Token counts under a unigram vocabulary, without making the tokens.

All vocabulary pieces in a text are enumerated by an Aho-Corasick automaton; going over them by where they end, the best score and
the number of pieces on the best path are carried along. Of equal scores the piece that starts first wins. A character that is
no piece itself costs the lowest score less ten, and counts as its bytes where the vocabulary has pieces for bytes, else as
one unknown piece for a run of such characters.

No piece of the vocabulary goes on past a space that follows something else, so that the best path of a text is made of the best
paths between such spaces, and each different word is scored once per slice of rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import slices, typed

SPACE = "▁"
_PENALTY = 10.0
_KEPT = 200_000


def read_pieces(path: str) -> tuple[list[tuple[str, float]], bool]:
    """The plain pieces of a vocabulary file with their scores, and whether it has a piece for each byte."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain], sum(map(model.is_byte, ids)) == 256


class Counter(dict):
    """Piece counts by word; remembers words."""

    def __init__(self, pieces: list[tuple[str, float]], bytes_known: bool):
        self.machine = ahocorasick.Automaton()
        for piece, score in pieces:
            self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - _PENALTY
        self.bytes_known = bytes_known
        # Whether best paths always pass between a non-space and a space.
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece, _ in pieces)

    def __missing__(self, word: str) -> int:
        found = self.count(word)
        if len(word) <= 64:
            if len(self) >= _KEPT:
                self.clear()
            self[word] = found
        return found

    def count(self, text: str) -> int:
        """Pieces on the best path over a text whose spaces are marked."""
        size = len(text)
        if not size:
            return 0
        best, count, open_run = [0.0] + [None] * size, [0] * (size + 1), [False] * (size + 1)
        matches = self.machine.iter(text)
        end_of, held = next(matches, (size, None))
        for end in range(1, size + 1):
            score, pieces, run = None, 0, False
            while end_of == end - 1:  # longest first, so that of equal scores the first start stays
                length, own = held
                start = end - length
                if score is None or best[start] + own > score:
                    score, pieces = best[start] + own, count[start] + 1
                end_of, held = next(matches, (size, None))
            char = text[end - 1]
            if char not in self.single:
                own = best[end - 1] + self.unknown
                if score is None or own > score:
                    score, run = own, True
                    pieces = count[end - 1] + (len(char.encode()) if self.bytes_known else not open_run[end - 1])
            best[end], count[end], open_run[end] = score, pieces, run
        return count[size]

    def text(self, text: str) -> int:
        """Pieces of a raw text: one space is put before it, and spaces become marks; nothing else is changed."""
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.apart:
            return self.count(marked)
        return sum(self[w] for w in re.findall(f"{SPACE}+[^{SPACE}]*", marked))


@cache
def counter(path: str) -> Counter:
    """One for each worker."""
    return Counter(*read_pieces(path))


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            for part in slices(batch):
                texts = pc.fill_null(part.column(0), "").cast(pa.large_string())
                counts = np.zeros(part.num_rows, np.int64)
                # Words apart by one space: each different one is looked up once.
                odd = np.asarray(pc.match_substring_regex(texts, f"  |^ | $|^$|{SPACE}")) | (not own.apart)
                plain = np.flatnonzero(~odd)
                if len(plain):
                    lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
                    coded = lists.flatten().dictionary_encode()
                    each = np.fromiter((own[SPACE + w] for w in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
                    offsets = np.asarray(lists.offsets)
                    counts[plain] = np.add.reduceat(each[np.asarray(coded.indices)], offsets[:-1] - offsets[0])
                for i in np.flatnonzero(odd):
                    counts[i] = own.text(texts[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(counts), part.column(1)], ["n", "own_row"])

    return run


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """The columns of `docs` but text, then n_tokens: the pieces of the best path over the whole text.

    `path` is a vocabulary file that every executor has. A null or empty text has none. Repeated rows are counted alike. A
    column of the name `n_tokens` is replaced; an empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c not in ("text", "n_tokens")]
    rows = docs.select(F.col("text").alias("own_text"), F.struct(F.lit(0).alias("_"), *columns).alias("own_row"))
    found = rows.mapInArrow(_count(path), typed(n="bigint", own_row=rows.schema["own_row"].dataType))
    return found.select(*[F.col("own_row").getField(c).alias(c) for c in columns], F.col("n").alias("n_tokens"))
