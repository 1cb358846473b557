import hashlib
import zlib

import pytest

from siltstone.llm.sharding import shard_by_bytes
from tests.llm.cases import messy, nothing, prose, texts_of


@pytest.mark.parametrize("options", [{}, {"shards": 5, "ranges": 7, "sample": 12}, {"shards": 3, "ranges": 40, "sample": 60}, {"ranges": 3, "range_rows": 9}])
def test_against_a_sorted_list(spark, options):
    texts = [" ".join(prose(k % 50, k % 90)) for k in range(300)] + ["a copy of a third of all rows"] * 150
    frame = messy(spark, texts)
    shards = options.get("shards", 8)
    rows = [(hashlib.md5((t or "").encode()).hexdigest(), i is not None, i or 0, t) for i, t in texts_of(frame)]
    rows.sort(key=lambda r: r[:3])
    total = sum(len((t or "").encode()) + 1 for *_, t in rows)
    want, at, slots = [], 0, [0] * shards
    for _, known, i, t in rows:
        data = (t or "").encode()
        shard = at * shards // total
        want.append((i if known else -1, len(data) + 1, zlib.crc32(data), shard, slots[shard]))
        slots[shard] += 1
        at += len(data) + 1
    found = [(r[0] if r[0] is not None else -1, *r[1:]) for r in shard_by_bytes(frame, **options).collect()]
    assert sorted(found) == sorted(want)


def test_shards_are_even(spark):
    frame = messy(spark).where("doc_id != 5").union(messy(spark, ["x" * (k % 40) for k in range(4000)]).where("doc_id >= 100"))
    sizes = [r["s"] for r in shard_by_bytes(frame).groupBy("shard").sum("size").withColumnRenamed("sum(size)", "s").collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 80


def test_empty_table(spark):
    assert shard_by_bytes(nothing(spark)).collect() == []
