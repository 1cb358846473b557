import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltstone.llm.decontaminate import Items, _search, contaminated, remove_contaminated
from siltstone.llm.words import hash_words, mix, split_words
from tests.llm.cases import messy, nothing, prose, split, texts_of

BENCHMARK = StructType([StructField("item_id", LongType()), StructField("text", StringType()), StructField("doc_id", LongType())])


def grams(words, width):
    return Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def expected(docs, items, width=5, similarity=80):
    out = []
    for i, t in docs:
        words = [w.lower() for w in split(t)]
        for name, own in items:
            own = [w.lower() for w in split(own)]
            kind, best = min(width, len(own)), None
            if not own or len(words) < kind:
                continue
            want = grams(own, kind)
            if not want & grams(words, kind):
                continue
            for s in range(max(len(words) - len(own), 0) + 1):
                have = grams(words[s:s + len(own)], kind)
                common = sum((have & want).values())
                every = sum(have.values()) + sum(want.values()) - common
                if 100 * common >= similarity * every and (best is None or common / every > best[2]):
                    best = s, min(len(own), len(words)), common / every
            if best:
                out.append((i, name, *best))
    return out


def benchmark_and_texts():
    draw = random.Random(8)
    items = [(k, " ".join(prose(300 + k, 12 + 4 * k, 2000))) for k in range(12)]
    items += [(50, "Short item"), (51, "one"), (52, " "), (53, None), (None, " ".join(prose(400, 20, 2000))), (54, items[3][1].upper()),
              (55, " ".join(["yes"] * 30))]
    texts = []
    for k in range(60):
        words = prose(1000 + k, draw.randrange(3, 80), 2000)
        _, item = items[draw.randrange(12)]
        own = (item or "").split()
        for _ in range(k % 3):
            own[draw.randrange(len(own) // 4)] = "edited"
        words[len(words) // 2:len(words) // 2] = own[:len(own) - k % 4]
        texts.append(" ".join(words))
    return items, [*texts, "a short ITEM here", "Short\titem", items[5][1], items[6][1] + " tail", "yes " * 80, "yes " * 28]


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_against_all_windows(spark, block_words):
    items, texts = benchmark_and_texts()
    frame = messy(spark, texts).where("doc_id is null or doc_id != 5")
    bench = spark.createDataFrame([(i, t, 7) for i, t in items], BENCHMARK)
    found = contaminated(frame, bench, block_words=block_words).select("doc_id", "item_id", "start", "n_words", "similarity").collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    want = expected(texts_of(frame), items)
    assert len(want) > 25
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    bad = {w[0] for w in want}
    kept = remove_contaminated(frame, bench, block_words=block_words)
    assert kept.columns == frame.columns
    assert Counter(texts_of(kept)) == Counter((i, t) for i, t in texts_of(frame) if i not in bad)


def test_the_index_returns_all_within_the_radius():
    draw = np.random.default_rng(3)
    items = Items(list(range(40)), [" ".join(prose(k, 20)) for k in range(40)], 5, 24)
    flips = np.zeros((3000, 64), np.uint8)
    for row in flips:
        row[draw.choice(64, draw.integers(0, 40), replace=False)] = 1
    prints = items.prints[draw.integers(0, 40, 3000)] ^ np.packbits(flips, axis=1)
    for item in range(40):
        near = np.bitwise_count(prints ^ items.prints[item]).sum(axis=1) <= 24
        assert items.within(item, prints).tolist() == np.flatnonzero(near).tolist()
    assert mix(np.arange(3, dtype=np.uint64)).dtype == np.uint64


def test_items_as_arrays():
    texts = ["a b a b a b a b", "", "one two", " ".join(prose(1, 30)), "ONE  Two", "x"]
    items = Items(list(range(6)), texts, 3, 24, 80)
    assert items.ids == [0, 2, 3, 4, 5] and items.totals.tolist() == [6, 1, 28, 1, 1] and items.kinds.tolist() == [3, 2, 3, 2, 1]
    assert items.counts[items.starts[0]:items.starts[1]].tolist() == [3, 3]
    for kind, (values, starts, posts) in items.tables.items():
        for item in np.flatnonzero(items.kinds == kind):
            own = slice(items.starts[item], items.starts[item + 1])
            under = {v for v, a, b in zip(values.tolist(), starts, starts[1:]) if item in posts[a:b]}
            weight = sum(n for s, n in zip(items.shingles[own].tolist(), items.counts[own].tolist()) if s in under)
            assert under and 100 * weight > 20 * items.totals[item], "more than an item may lack"
    assert Items([], [], 3, 24).tables == {}


def test_very_many_items_of_one_size_take_little_memory():
    """As arrays, and a text is held against the items that it has shingles of, not against all of their size."""
    base = prose(5, 50, 100_000)
    texts = [" ".join(base[:25] + prose(k, 25, 100_000)) for k in range(20_000)]
    tracemalloc.start()
    items = Items(list(range(20_000)), texts, 5, 24)
    text = " ".join(prose(10**6, 3000, 100_000) + texts[777].split() + prose(10**6 + 1, 3000, 100_000) + base[:25])
    tracemalloc.reset_peak()
    pairs = []
    words, offsets = split_words(pa.array([text], pa.large_string()), lower=True)
    hashes = hash_words(words)
    found = list(_search(items, hashes, lambda *n: pairs.append(n)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(f[0], f[1], f[3], f[4]) for f in found] == [(777, 3000, 46, 46)], found
    assert len(pairs) <= 2 and peak < 400 << 20  # item 5 repeats what all begin with


def test_empty_tables(spark):
    items, texts = benchmark_and_texts()
    bench = spark.createDataFrame([(i, t, 7) for i, t in items], BENCHMARK)
    none = spark.createDataFrame([], BENCHMARK)
    assert contaminated(nothing(spark), bench).collect() == []
    assert contaminated(messy(spark, texts), none).collect() == []
    assert remove_contaminated(messy(spark, texts), none).count() == messy(spark, texts).count()
