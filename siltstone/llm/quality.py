"""Quality rules: counts over whole texts, and a decision list learned from labelled ones.

Sequential covering: a rule grows on two thirds of the labelled rows by the threshold that gains most (FOIL's measure), and loses
its last conditions again as long as the other third favours that; rules are added while they are precise enough there, and
each takes the rows it covers with it. The list becomes one ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import row_print, slices, typed
from siltstone.llm.words import hash_words, split_words, window_hashes

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
SAMPLE = 20_000  # labelled rows that the list is learned from, at most

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_upper", "n_lower", "n_marks", "n_distinct", "n_top")
#: Shares that the learned conditions are about, from the counts.
SHARES = {
    "mean_word": ("word_chars", "n_words"), "symbols": ("n_symbols", "word_chars"), "marks": ("n_marks", "word_chars"),
    "upper": ("n_upper", "n_letters"), "repeated": ("n_repeat_words", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
    "distinct": ("n_distinct", "n_words"), "top_word": ("n_top", "n_words"), "words_a_line": ("n_words", "n_lines"),
}


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_IS = {
    "n_symbols": _table(SYMBOLS), "n_upper": _table(bytes(range(65, 91))), "n_lower": _table(bytes(range(97, 123))),
    "n_marks": _table(b"!\"'(),-./:;?@[\\]^_`{}~+="),
}


def counts_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of COUNTS and a few more for each text; a null text is an empty one."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    words, offsets = split_words(texts.cast(pa.large_string()))
    sizes = np.diff(offsets)
    found = {"n_words": sizes, "word_chars": _per_text(np.asarray(pc.utf8_length(words)), offsets)}
    places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[places[0]:places[-1]]
    for name, table in _IS.items():
        found[name] = _per_text(table[data], places - places[0])
    hashes = hash_words(words)
    windows = window_hashes(hashes, WINDOW)
    more = {name: np.zeros(len(texts), np.int64) for name in ("n_dup_lines", "n_lines", "n_repeat_words", "n_distinct", "n_top")}
    for i, (text, start, size) in enumerate(zip(texts.to_pylist(), offsets[:-1].tolist(), sizes.tolist())):
        if not size:
            continue
        lines = text.split(b"\n")
        if len(lines) > 1:
            lines = [x for x in lines if x.split(None, 1)]
        more["n_lines"][i] = len(lines)
        more["n_dup_lines"][i] = len(lines) - len(set(lines))
        _, n = np.unique(hashes[start:start + size], return_counts=True)
        more["n_distinct"][i], more["n_top"][i] = len(n), n.max()
        if size > WINDOW:
            own = windows[start:start + size - WINDOW + 1]
            order = np.argsort(own, kind="stable")
            equal = np.diff(own[order].view(np.int64)) == 0
            if equal.any():
                twice = np.zeros(len(own), bool)
                twice[order[1:][equal]] = True
                twice[order[:-1][equal]] = True
                marks = np.zeros(size + 1, np.int32)
                at = np.flatnonzero(twice)
                np.add.at(marks, at, 1)
                np.add.at(marks, at + WINDOW, -1)
                more["n_repeat_words"][i] = np.count_nonzero(np.cumsum(marks[:-1]))
    return found | more


def _measure(carried: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, field="text"):
                rows = part.column(0)
                counts = counts_of(rows.field("text"))
                own = pa.StructArray.from_arrays([rows.field(c) for c in carried], carried)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(counts[c].astype(np.int64)) for c in (*COUNTS, *_MORE)), own], [*COUNTS, *_MORE, "own_row"])

    return run


def measured(docs: DataFrame, *carried: str) -> DataFrame:
    """For each row of `docs` (text and anything else) the counts, and the columns `carried` (or all) as `own_row`.

    Words are runs without white space. `n_symbols` counts SYMBOLS; `n_dup_lines` the lines with a word that equal an earlier
    one; `n_repeat_words` the words in runs of five that the text has twice or more. A null text has no words.
    """
    carried = carried or tuple(docs.columns)
    fields = {c: "bigint" for c in (*COUNTS, *_MORE)}
    own = docs.select(F.struct(*carried).alias("own_row")).schema["own_row"].dataType
    needed = [c for c in docs.columns if c in (*carried, "text")]
    return docs.select(F.struct(*needed).alias("own_row")).mapInArrow(_measure(carried), typed(**fields, own_row=own))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated runs."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def share(name: str) -> Column:
    """A share of SHARES; 0 where there is nothing to share."""
    above, below = SHARES[name]
    below = F.col("n_upper") + F.col("n_lower") if below == "n_letters" else F.col(below)
    return F.when(below > 0, F.col(above) / below).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    """`name` at least `limit`, or below it."""

    name: str
    above: bool
    limit: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.name] >= self.limit if self.above else values[self.name] < self.limit

    def column(self) -> Column:
        return share(self.name) >= self.limit if self.above else share(self.name) < self.limit

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.limit:g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
    held = among.copy()
    for c in rule:
        held &= c.holds(values)
    return held


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, among: np.ndarray, conditions: int, cuts: int) -> Rule:
    rule: Rule = ()
    while len(rule) < conditions:
        p, n = int((bad & among).sum()), int((~bad & among).sum())
        if not p or not n:
            break
        best, chosen = 0.0, None
        for name, v in values.items():
            for limit in np.unique(np.quantile(v[bad & among], np.linspace(0, 1, cuts), method="nearest")):
                for above in (True, False):
                    held = among & (v >= limit if above else v < limit)
                    p1 = int((bad & held).sum())
                    if not p1:
                        continue
                    n1 = int(held.sum()) - p1
                    gain = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p / (p + n)))
                    if gain > best + 1e-9:
                        best, chosen = gain, Condition(name, above, float(limit))
        if chosen is None:
            break
        rule += (chosen,)
        among = among & chosen.holds(values)
    return rule


def learn(
    values: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, conditions: int = 4, rules: int = 16, cuts: int = 24, least: int = 5,
) -> list[Rule]:
    """An ordered list of rules that cover `bad` rows; the rows are given by their shares. Every third row is for pruning."""
    prune = np.arange(len(bad)) % 3 == 2
    left, found = np.ones(len(bad), bool), []
    while len(found) < rules:
        rule = _grow(values, bad, left & ~prune, conditions, cuts)
        if not rule:
            break

        def worth(k: int) -> float:
            held = _covers(rule[:k], values, left & prune)
            p = int((bad & held).sum())
            return (p + 1) / (int(held.sum()) + 2)

        rule = rule[:max(range(len(rule), 0, -1), key=worth)]
        held, tried = _covers(rule, values, left), _covers(rule, values, left & prune)
        if (bad & held).sum() < least or not tried.any() or (bad & tried).sum() < precision * tried.sum() or (bad & held).sum() < precision * held.sum():
            break
        found.append(rule)
        left &= ~held
    return found


def learned_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> list[Rule]:
    """A decision list from at most `sample` of the rows of `docs` that `labels` (doc_id, quality: 0 or 1) covers.

    Rows that fail the base rules are decided already and teach nothing. The sample is taken by a hash of the id. A row labelled more than once has its lowest label; null ids and labels are left out.
    Without rows of either label the list is empty.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    many = labels.count()  # about twice the sample lies below the cutoff, however many partitions there are
    lot = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    known = known.withColumn("lot", lot).where(F.col("lot") <= 2.0 * sample / max(many, 1))
    known = known.orderBy("lot", "doc_id").limit(sample).select(F.col("doc_id").alias("known_id"), "quality")
    rows = docs.select("text", "doc_id").join(F.broadcast(known), F.col("doc_id") == F.col("known_id")).select(
        "text", "quality", F.xxhash64("doc_id", row_print(F.col("text"))).alias("order"))
    rows = measured(rows, "quality", "order").where(~base_failed()).select("own_row.*", *[share(n).alias(n) for n in SHARES])
    rows = rows.orderBy("order", *SHARES).limit(sample).collect()
    bad = np.array([r["quality"] == 0 for r in rows], bool)
    if not bad.any() or bad.all():
        return []
    return learn({n: np.array([r[n] for r in rows], float) for n in SHARES}, bad, **options)


def rejects(rules: list[Rule]) -> Column:
    """Whether the first rule that fits rejects a measured row; none: it doesn't."""
    verdict = None
    for rule in rules:
        fits = F.lit(True)
        for c in rule:
            fits &= c.column()
        verdict = F.when(fits, True) if verdict is None else verdict.when(fits, True)
    return F.lit(False) if verdict is None else verdict.otherwise(False)


def judged(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """For each row of `docs` (doc_id, text, anything else): doc_id, the counts of COUNTS, base_failed, kept.

    `kept` is false if `base_failed`, else what the list learned from `labels` says. A null text has no words and fails.
    Repeated rows are judged alike; other columns are left out; an empty table gives an empty result.
    """
    rules = learned_rules(docs, labels, **options)
    return measured(docs, "doc_id").select(
        "own_row.doc_id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & ~rejects(rules)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """`docs` without the rows that are rejected; the columns are unchanged."""
    rules = learned_rules(docs, labels, **options)
    return measured(docs).where(~base_failed() & ~rejects(rules)).select("own_row.*")
