import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm.frames import slices
from siltstone.llm.words import hash_words, mix, split_words, window_hashes
from tests.llm.cases import prose

TEXTS = [None, "", " \t\r\n\x0b\x0c", "one", " two words ", "Ä É x A", *(" ".join(prose(k, k)) for k in range(60)), None]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("start", [0, 4])
@pytest.mark.parametrize("lower", [False, True])
def test_words(kind, start, lower):
    texts = pa.array(TEXTS, kind).slice(start)
    words, offsets = split_words(texts, lower)
    for i, text in enumerate(TEXTS[start:]):
        want = (text or "").encode().split()
        assert [w.encode() for w in words[int(offsets[i]):int(offsets[i + 1])].to_pylist()] == [w.lower() if lower else w for w in want]


@pytest.mark.parametrize("limit", [1, 300, 10 ** 6])
def test_slices_hold_every_row_in_order(limit):
    rows = pa.RecordBatch.from_arrays([pa.array(TEXTS), pa.array(range(len(TEXTS)))], ["text", "n"])
    nested = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([pa.array(TEXTS), pa.array(range(len(TEXTS)))], ["text", "n"])], ["row"])
    assert [x for part in slices(rows, limit) for x in zip(part.column(0).to_pylist(), part.column(1).to_pylist())] == list(zip(TEXTS, range(len(TEXTS))))
    assert [x for part in slices(nested, limit, "text") for x in part.column(0).field("text").to_pylist()] == TEXTS
    for part in slices(nested, limit, "text"):
        words, _ = split_words(part.column(0).field("text"))
        assert len(words) == sum(len((t or "").encode().split()) for t in part.column(0).field("text").to_pylist())


@pytest.mark.parametrize("size", [1, 2, 5, 8, 9, 35])
def test_windows_are_equal_where_their_words_are(size):
    words = [f"w{x}" for x in np.random.default_rng(1).integers(0, 3, 400)]
    hashes = window_hashes(hash_words(pa.array(words)), size)
    by_words = {}
    for i, h in enumerate(hashes.tolist()):
        by_words.setdefault(tuple(words[i:i + size]), set()).add(h)
    assert len(hashes) == 400 - size + 1
    assert all(len(v) == 1 for v in by_words.values()) and len(set(hashes.tolist())) == len(by_words)


def test_short_input_and_mixing():
    assert len(window_hashes(np.zeros(3, np.uint64), 4)) == 0
    assert len(np.unique(mix(np.arange(10_000, dtype=np.uint64)))) == 10_000
