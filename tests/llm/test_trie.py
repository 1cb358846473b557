import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from siltstone.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, rank string, depth int, n bigint"


def in_order(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), text or ""))
    return {c: [(r, x) for _, _, r, _, x in sorted(turns)] for c, turns in convs.items()}


def with_heads(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + own[h:]
    return out


def expected(convs):
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in sorted(nodes, key=len, reverse=True):
        leaves[path] += not children[path]
        saved[path] += (len(nodes[path]) - 1) * (len(path[-1][1]) if path else 0)
        if path:
            children[path[:-1]] += 1
            leaves[path[:-1]] += leaves[path]
            saved[path[:-1]] += saved[path]
    return sorted((
        min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
        hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in nodes.items())


def rows_of(frame):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in frame.select(*columns).collect()))


def talks(seed=4):
    draw, rows = random.Random(seed), []
    starts = [[("user", f"hello {k}"), ("assistant", f"hi ä {k}" * k)] for k in range(4)]
    for c in range(700, 1010):
        turns = [*draw.choice(starts)[:draw.randrange(3)], *[("user", f"t{draw.randrange(3)}") for _ in range(draw.randrange(6))]]
        rows += [(c, k * 2 - 3, r, x) for k, (r, x) in enumerate(turns)]
    for c in range(2000, 2120):  # copies of one conversation
        rows += [(c, k, "user", f"same {k}") for k in range(7)]
    long = [(k, "user", f"turn {k % 7}") for k in range(90)]
    rows += [(c, *t) for c in (3000, 3001, 3002) for t in long[:90 - 5 * (c % 3)]]
    rows += [(3003, *t) for t in long[:40]] + [(3003, 41, "user", "leaves the path")]
    rows += [(5, None, None, None), (5, None, "user", ""), (5, 1, "", "x"), (5, 1, "", "x"), (None, 1, "user", "nobody's"),
             (-7, 1, "user", "minus"), (-7, 2, "user", "more"), (0, 1, "user", "minus"), (199, 3, None, "alone")]
    draw.shuffle(rows)
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA).repartition(6)


@pytest.mark.parametrize("shards, span, limit", [(trie.SHARDS, trie.SPAN, trie.QUEUE), (8, 16, 5), (3, 8, 40), (1, 32, 3)])
def test_against_brute_force(spark, no_broadcast, shards, span, limit, monkeypatch):
    rows = talks()
    turns = trie.ordered(frame_of(spark, rows))
    convs = in_order(rows)
    monkeypatch.setattr(trie, "_totals", lambda *a, own=trie._totals: own(*a[:5], min(a[5], span), *a[6:]))
    plain = trie.prefix_trie(*trie.plain_paths(turns), shards, span, limit)
    assert rows_of(plain) == expected(convs)


@pytest.mark.parametrize("shards, span", [(trie.SHARDS, trie.SPAN), (8, 16)])
def test_shared_heads_against_brute_force(spark, no_broadcast, shards, span):
    rows = talks(5)
    found = trie.prefix_trie(*trie.with_shared_heads(trie.ordered(frame_of(spark, rows))), shards, span)
    want = expected(with_heads(in_order(rows)))
    assert rows_of(found) == want
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in want), "a conversation without turns"


def test_messages_spill_and_come_back_in_order(monkeypatch):
    monkeypatch.setattr(trie, "_RUNS", 3)
    draw = random.Random(1)
    queue, held, got = trie.Messages(limit=7), [], []
    for level in range(50, 0, -1):
        for key in sorted({m[:3] for m in held if m[0] == -level}):
            taken = list(queue.take(key))
            assert sorted(taken) == sorted(m for m in held if m[:3] == key)
            got += taken
        for _ in range(60):
            message = (-(level - draw.randrange(1, 5)), draw.randrange(9) - 4, draw.randrange(2), draw.randrange(5), 1 << draw.randrange(80))
            queue.send(message)
            held.append(message)
        assert len(queue.heap) < 7
    assert queue.made > 100 and len(got) > 2000


def test_a_long_list_of_ends_is_digested_in_runs(spark):
    rows = [(c, 1, "user", "all the same") for c in range(30_000)]
    found = trie.prefix_trie(*trie.plain_paths(trie.ordered(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"))))
    ends = hashlib.sha256(",".join(map(str, range(30_000))).encode()).hexdigest()
    assert rows_of(found)[-1][3:] == (30_000, 0, 1, 29_999 * 12, ends)


def test_empty_table(spark):
    turns = trie.ordered(spark.createDataFrame([], SCHEMA))
    assert trie.prefix_trie(*trie.with_shared_heads(turns)).collect() == []
