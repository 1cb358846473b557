import random

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm.quality import COUNTS, SYMBOLS, counts_of, judged, keep_good, learn, learned_rules
from tests.llm.cases import messy, nothing, prose, split, texts_of

FOLDER = "/root/testdata/sf0.01"


def expected(text):
    words = split(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    repeated = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    seen, twice = set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            twice += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(chr(c)) for c in SYMBOLS), twice, len(repeated))


def odd_texts():
    draw = random.Random(1)
    texts = ["\n".join(" ".join(prose(draw.randrange(9), draw.randrange(9), 3)) for _ in range(draw.randrange(9))) for _ in range(150)]
    return [*texts, "a b c d e", "a b c d e a b c d e", "x " * 40, "#*$%&|<> é ß 漢", "l\n l\nl\n\n\n l\nl", "a\r\na\r\n", "w" * 50]


def test_counts():
    texts = [None, "", *odd_texts()]
    found = counts_of(pa.array(texts))
    assert [tuple(int(found[c][i]) for c in COUNTS) for i in range(len(texts))] == [expected(t) for t in texts]


def test_judged_rows(spark):
    frame = messy(spark, odd_texts())
    none = spark.createDataFrame([], "doc_id long, quality long, text string")
    found = judged(frame, none).collect()
    want = []
    for i, t in texts_of(frame):
        counts = expected(t)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        want.append((i, *counts, failed, not failed))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    kept = keep_good(frame, none)
    assert kept.columns == frame.columns and kept.count() == sum(w[-1] for w in want)
    assert judged(nothing(spark), none).collect() == [] and keep_good(nothing(spark), none).collect() == []


def test_a_conjunction_is_learned_and_pruned():
    draw = np.random.default_rng(2)
    values = {n: draw.random(3000) for n in ("a", "b", "c")}
    bad = (values["a"] >= 0.7) & (values["b"] < 0.4) | (values["c"] >= 0.95)
    noisy = bad ^ (draw.random(3000) < 0.02)
    rules = learn(values, noisy)
    fresh = {n: draw.random(3000) for n in values}
    said = np.zeros(3000, bool)
    for rule in rules:
        held = np.ones(3000, bool)
        for c in rule:
            held &= c.holds(fresh)
        said |= held
    truth = (fresh["a"] >= 0.7) & (fresh["b"] < 0.4) | (fresh["c"] >= 0.95)
    assert (said == truth).mean() > 0.93 and len(rules) <= 8
    assert learn(values, np.zeros(3000, bool)) == [] and learn({n: v[:2] for n, v in values.items()}, bad[:2]) == []


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_held_out_labels(spark, tables):
    """Learned on half of the labels, the list agrees with the other half."""
    docs, labels = tables
    half = labels.where("doc_id % 2 = 0")
    rows = judged(docs, half).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows)
    assert len(rows) > 150 and right >= 0.95 * len(rows)


def test_the_sample_is_bounded_and_stable(spark, tables):
    docs, labels = tables
    assert learned_rules(docs, labels, sample=150) == learned_rules(docs.repartition(5), labels.repartition(3), sample=150)
    assert learned_rules(docs.limit(0), labels) == []
