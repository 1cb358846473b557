import hashlib
import random
from collections import Counter

from siltstone.llm.lines import FACTOR, remove_repeated_lines
from tests.llm.cases import messy, nothing, prose, texts_of


def chunks(text):
    lines = text.split("\n")
    marks = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    sums = [None, None, *(marks[i - 1] + FACTOR * marks[i - 2] for i in range(2, len(lines)))]
    found = []
    for i, line in enumerate(lines):
        inner = 2 <= i <= len(lines) - 2
        low = inner and (i == 2 or sums[i] < sums[i - 1]) and sums[i] < sums[i + 1]
        run = inner and i > 2 and i % 2 == 0 and len(set(lines[i - 3:i + 2])) == 1
        if i == 0 or low or run:
            found.append([])
        found[-1].append(line)
    return found


def expected(rows):
    first = {}
    for i, t in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        for k, c in enumerate(chunks(t)):
            if len(c) > 1:
                place = (i is not None, i or 0, k)
                first[tuple(c)] = min(first.get(tuple(c), place), place)
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        kept, gone = [], 0
        for k, c in enumerate(chunks(t)):
            if len(c) > 1 and first[tuple(c)] < (i is not None, i or 0, k):
                gone += len(c)
            else:
                kept.extend(c)
        out.append((i, "\n".join(kept), len(t.split("\n")), gone))
    return out


def found(frame):
    return [tuple(r) for r in remove_repeated_lines(frame).select("doc_id", "text", "n_lines", "n_removed_lines").collect()]


def corpus():
    shared = [" ".join(prose(i, 8)) for i in range(30)]
    texts = []
    for k in range(60):
        own = [" ".join(prose(1000 + k * 20 + j, 6)) for j in range(k % 7 + 1)]
        at = k % len(own)
        texts.append("\n".join(own[:at] + shared[k % 3 * 10:k % 3 * 10 + 9] + own[at:]))
    return [*texts, texts[3], texts[3] + "\n" + texts[3], "\n\n\n\n", "x\n" * 500]


def test_against_brute_force(spark, no_broadcast):
    frame = messy(spark, corpus())
    want = expected(texts_of(frame))
    assert Counter(found(frame)) == Counter(want)
    assert sum(w[3] for w in want) > 200


def test_a_passage_gives_the_same_chunks_wherever_it_stands():
    passage = [" ".join(prose(i, 8)) for i in range(40)]
    inside = [chunks("\n".join([*(f"lead {k} {j}" for j in range(k)), *passage])) for k in range(1, 6)]
    common = set.intersection(*({tuple(c) for c in x} for x in inside))
    assert sum(map(len, common)) > 30


def test_no_chunk_is_a_single_line():
    draw = random.Random(4)
    for _ in range(300):
        lines = [f"line {draw.randrange(draw.choice([1, 2, 3, 50]))}" for _ in range(draw.randrange(1, 40))]
        sizes = [len(c) for c in chunks("\n".join(lines))]
        assert sum(sizes) == len(lines) and (min(sizes) > 1 or sizes == [1])


def test_copies_of_several_lines_lose_them_all(spark):
    draw = random.Random(6)
    texts = ["\n".join(" ".join(prose(draw.randrange(10**6), 5)) for _ in range(draw.randrange(2, 30))) for _ in range(40)]
    rows = {r[0]: r for r in found(messy(spark, texts + texts))}
    for k in range(40):
        assert rows[100 + k][1] == texts[k] and rows[140 + k][1] == "" and rows[140 + k][2] == rows[140 + k][3]


def test_lines_that_alternate_or_repeat_are_cut_into_pairs():
    for period in (["a"], ["a", "b"], ["b", "a"]):
        for lead in range(4):
            found = chunks("\n".join([*(f"x{k}" for k in range(lead)), *period * 20, "end", "of it"]))
            pairs = Counter(tuple(c) for c in found)
            assert max(pairs.values()) >= 7 and len(max(pairs, key=pairs.get)) == 2


def test_columns_and_empty_table(spark):
    frame = messy(spark)
    assert remove_repeated_lines(frame).columns == [*frame.columns, "n_lines", "n_removed_lines"]
    assert found(nothing(spark)) == []
