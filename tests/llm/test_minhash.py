import random

import pytest

from siltstone.llm.minhash import _across, keep_one, near_duplicates
from tests.llm.cases import messy, nothing, prose, split, texts_of


def shingles(text, width):
    words = [w.lower() for w in split(text)]
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def expected(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    groups = list(range(len(rows)))

    def root(i):
        while groups[i] != i:
            i = groups[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                groups[root(i)] = root(j)
    names = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            names[root(k)] = min(names.get(root(k), i), i)
    out = []
    for k, (i, _) in enumerate(rows):
        name = names.get(root(k)) if sets[k] else i
        out.append((i, len(sets[k]), name, i == name))
    return out


def near_copies():
    draw, texts = random.Random(5), []
    for family in range(12):
        base = prose(family, 40 + 15 * family)
        for k in range(12):
            words = list(base)
            for _ in range(k % 6):
                words[draw.randrange(len(words))] = f"new{draw.randrange(10 ** 6)}"
            texts.append(" ".join(words[:len(words) - k % 3]).upper() if k % 2 else "\n".join(words))
    texts += [" ".join(prose(99, 60)) + " " + " ".join(prose(500 + k, k)) for k in range(40)]  # a passage many share
    texts += ["a b c", "A  b\tc", "a b", "a b c d e f"]
    return texts


@pytest.mark.parametrize("width", [4, 5])
def test_against_all_pairs(spark, no_broadcast, width):
    frame = messy(spark, near_copies())
    found = [tuple(r) for r in near_duplicates(frame, width=width).select("doc_id", "n_shingles", "component_id", "kept").collect()]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(found, key=key) == sorted(expected(texts_of(frame), width), key=key)


def test_a_large_group_of_copies_at_the_threshold(spark):
    """Copies that only a common original, itself among them, links."""
    draw, base = random.Random(3), prose(1, 150, 4000)
    texts = [" ".join(base)]
    for _ in range(250):
        words = list(base)
        for _ in range(draw.randrange(2, 7)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10 ** 7)}"
        texts.append(" ".join(words))
    frame = messy(spark, texts)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame, width=4).where("doc_id >= 100").collect()}
    assert found == {r[0]: r[2] for r in expected(texts_of(frame), 4) if (r[0] or 0) >= 100}


def test_parts_of_one_hub_are_not_paired_without_common_shingles(spark, no_broadcast):
    sets = {0: list(range(4000))} | {k: list(range(100 * k, 100 * k + 100)) for k in range(1, 31)}
    sets |= {31: [*range(105, 205)], 32: [*range(204, 295), *range(3900, 3909)], 33: [*range(300, 391), *range(5000, 5003)]}
    left = spark.createDataFrame([(1, k, k) for k in sets], "post long, node long, component long")
    hubs = spark.createDataFrame([(1, 9, 0)], "post long, weight long, hub long")
    found = _across(left, hubs, spark.createDataFrame(list(sets.items()), "node long, shingles array<long>"), 80)
    pairs = {(r["a"], r["b"]) for r in found.collect()}
    alike = {(a, b) for a in sets for b in sets if a > b and 180 * len({*sets[a]} & {*sets[b]}) >= 80 * (len(sets[a]) + len(sets[b]))}
    assert alike == {(31, 1), (32, 2), (33, 3)} and alike <= pairs
    assert len(pairs) < 10


def test_keep_one_and_empty_table(spark):
    frame = messy(spark, near_copies())
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    want = {(i, t) for (i, t), r in zip(texts_of(frame), expected(texts_of(frame), 5)) if r[3] or i is None and r[2] is None}
    assert set(texts_of(kept)) == want
    assert near_duplicates(nothing(spark)).collect() == []
