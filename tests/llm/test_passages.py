import random
from collections import Counter

import numpy as np
import pytest

from siltstone.llm.passages import _salts, difference_cover, remove_passages
from tests.llm.cases import messy, nothing, prose, split, texts_of


def expected(rows, window):
    words = [split(t) for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((i, b" ".join(x for k, x in enumerate(w) if k not in gone).decode(), len(w), len(gone)))
    return out


def passages():
    draw, texts = random.Random(2), []
    shared = [prose(900 + k, 34 + k, 3000) for k in range(6)]  # one is a word too short to count
    for k in range(80):
        own = prose(k, draw.randrange(5, 90), 3000)
        for s in draw.sample(shared, draw.randrange(3)):
            at = draw.randrange(len(own))
            own[at:at] = s
        texts.append(draw.choice([" ", "\n", " \t "]).join(own))
    twice = prose(77, 40, 3000)
    return [*texts, texts[4], " ".join([*twice, "x", *twice]), " ".join(["a"] * 90), " ".join(["a"] * 36), " ".join(prose(5, 35))]


@pytest.mark.parametrize("window, period", [(35, 21), (35, 13), (8, 5), (1, 1)])
def test_against_brute_force(spark, no_broadcast, window, period):
    frame = messy(spark, passages())
    found = [tuple(r) for r in remove_passages(frame, window, period).select("doc_id", "text", "n_words", "n_removed").collect()]
    want = expected(texts_of(frame), window)
    assert Counter(found) == Counter(want)
    assert sum(w[3] > 0 for w in want) > 40


@pytest.mark.parametrize("period", [1, 2, 3, 7, 13, 21, 31])
def test_any_two_positions_share_an_offset_onto_the_cover(period):
    cover = set(difference_cover(period))
    assert all(any((i + d) % period in cover and (j + d) % period in cover for d in range(period)) for i in range(period) for j in range(period))


def test_the_perfect_cover_of_21_is_found():
    assert len(difference_cover(21)) == 5


def test_salts():
    keys = np.array([5, 7, 5, 9, 5, 7], np.uint64)
    salts = _salts(keys)
    assert salts[3] == 0 and [salts[0], salts[1]] == [-1, -1] and len({*salts[[2, 4, 5]].tolist()}) == 3 and min(salts[[2, 4, 5]]) > 0
    assert len(_salts(np.zeros(0, np.uint64))) == 0


def test_empty_table(spark):
    assert remove_passages(nothing(spark)).collect() == []
