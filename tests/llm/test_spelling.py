import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from siltstone.llm import spelling
from tests.llm.cases import messy, nothing, prose, texts_of


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def expected(words, dominance=10):
    out = {}
    for w, n in words.items():
        others = [(-words[v], v) for v in words if v != w and near(v, w)]
        best = min(others, default=None)
        form = best[1] if best and -best[0] >= dominance * n else None
        out[w] = (form, n, len(others), -best[0] if form else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows)


def counted(rows, shortest=7, least=2):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= shortest:
                found[word] += 1
    return {w: n for w, n in found.items() if n >= least}


def invented(seed=3):
    draw = random.Random(seed)
    words = {}
    for k in range(60):
        base = "".join(draw.choice("abcé") for _ in range(draw.randrange(7, 10)))
        words[base] = draw.choice([3, 40, 40, 4000])
        for _ in range(12):
            i, way = draw.randrange(len(base)), draw.randrange(3)
            new = base[:i] + ("" if way == 0 else draw.choice("abcéÿ")) + base[i + (way != 1):]
            words.setdefault(new, draw.choice([1, 2, 4, 400]))
            base = draw.choice([base, new])
    long = "xy" * 300
    return words | {"a" * 9: 50, "a" * 8: 5, "a" * 10: 500, "b": 7, "c": 70, long: 4, long[:-1]: 60, "z" + long: 4}


@pytest.mark.parametrize("round_bytes", [spelling.ROUND_BYTES, 64])
def test_variants_against_brute_force(spark, no_broadcast, round_bytes):
    words = invented()
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(5)
    found = sorted(tuple(r) for r in spelling.variants(frame, round_bytes=round_bytes).collect())
    want = expected(words)
    assert found == want
    assert sum(r[1] is not None for r in want) > 50 and any(r[1] != r[2] for r in want if r[1])


def test_documents_against_brute_force(spark, no_broadcast):
    texts = [" ".join(w.replace("w", "Wörterei") for w in prose(k, 300, 60)) for k in range(30)]
    texts += ["Straßenbahn ÀÉÎÕÜÿþ×÷ straßenbahN", "short words only", "Straßenbahn, straßenbahm straßenbahn1straßenbahn"]
    frame = messy(spark, texts)
    found = sorted(tuple(r) for r in spelling.spelling_variants(frame).collect())
    assert found == expected(counted(texts_of(frame)))
    assert len(found) > 2


def test_every_edit_is_probed_with_the_hash_of_its_spelling():
    letters = np.array(sorted(map(ord, "abcé")), np.uint32)
    for word in ("abca", "aab", "é"):
        codes = np.array([[ord(c) for c in word]], np.uint32)
        seen = {}

        def holds(length, hashes):
            seen.setdefault(length, []).extend(hashes.tolist())
            return np.ones(len(hashes), bool)

        edits = {word[:p] + (chr(c) if c else "") + word[p + 1:]
                 for _, at, with_ in spelling.edits_held(codes, letters, holds) for p, c in zip(at.tolist(), with_.tolist())}
        want = {word[:i] + word[i + 1:] for i in range(len(word))} | {
            word[:i] + c + word[i + 1:] for i in range(len(word)) for c in "abcé" if c > word[i]}
        assert edits == want
        hashed = {h for edit in want for h in spelling.word_hashes(np.array([[ord(c) for c in edit]], np.uint32).reshape(1, -1)).tolist()}
        assert {h for hs in seen.values() for h in hs} == hashed


def test_filters_hold_all_words_and_few_others(spark):
    words = spark.range(20_000).selectExpr("concat('w', lpad(id, 8, '0')) AS word")
    held = spelling.build_filters(words, {9: spelling._blocks_of(20_000)})

    def share(first, last):
        codes = np.array([[ord(c) for c in f"w{i:08}"] for i in range(first, last)], np.uint32)
        return held.holds(9, spelling.word_hashes(codes)).mean()

    assert share(0, 20_000) == 1.0 and share(30_000, 60_000) < 0.005
    assert not held.holds(8, np.arange(5, dtype=np.uint64)).any()


def test_empty_table(spark):
    assert spelling.spelling_variants(nothing(spark)).collect() == []


def test_a_dominance_that_allows_cycles_is_refused(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([("a", 1)], "word string, n bigint"), dominance=1)
