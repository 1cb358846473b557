import random

import public_tokenizers
import pytest
import tokenizers
from tokenizers import models

from siltstone.llm.unigram import SPACE, Counter, count_tokens, read_pieces
from tests.llm.cases import messy, nothing, prose, texts_of

PATH = public_tokenizers.path("piece_bpe_32k.model")


def reference(pieces, bytes_known):
    """A count by a unigram tokenizer over the same pieces."""
    spare = [(f"<0x{i:02X}>", -1e12) for i in range(256)] if bytes_known else []
    model = tokenizers.Tokenizer(models.Unigram([("<unk>", 0.0), *spare, *pieces], 0, bytes_known))
    return lambda text: len(model.encode(SPACE + text.replace(" ", SPACE)).ids) if text else 0


@pytest.fixture(scope="module")
def pieces():
    return read_pieces(PATH)


@pytest.mark.parametrize("bytes_known", [True, False])
def test_random_texts(pieces, bytes_known):
    count, want, draw = Counter(pieces[0], bytes_known), reference(pieces[0], bytes_known), random.Random(1)
    for _ in range(1500):
        text = "".join(draw.choice(f"abcdethe  \nñé漢😀.,!?{SPACE}") for _ in range(draw.randint(0, 60)))
        assert count.text(text) == want(text), repr(text)


def test_equal_scores():
    for seed in range(150):
        draw = random.Random(seed)
        own = {c: -float(draw.randint(1, 3)) for c in f"ab{SPACE}"} | {f"{SPACE}a": -2.0}
        own |= {"".join(draw.choice("abc") for _ in range(draw.randint(2, 4))): -float(draw.randint(1, 6)) for _ in range(12)}
        count, want = Counter(list(own.items()), False), reference(list(own.items()), False)
        for _ in range(30):
            text = "".join(draw.choice("abcd ") for _ in range(draw.randint(1, 30)))
            assert count.text(text) == want(text), (text, own)


def test_pieces_across_spaces():
    own = [("a", -1.0), ("b", -1.0), (SPACE, -1.0), (f"a{SPACE}b", -1.5)]
    count = Counter(own, False)
    assert not count.apart and count.text("a b") == reference(own, False)("a b") == 2


def test_query_form(spark, pieces):
    frame = messy(spark, [" ".join(prose(k, 50)) for k in range(20)] + ["two  spaces", " lead", "trail ", "long" * 60, f"{SPACE}x"])
    want = reference(*pieces)
    found = count_tokens(frame, PATH)
    assert found.columns == [*[c for c in frame.columns if c != "text"], "n_tokens"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in found.collect()), key=key) == sorted(
        ((i, want(t) if t else 0) for i, t in texts_of(frame)), key=key)
    assert count_tokens(nothing(spark), PATH).collect() == []
