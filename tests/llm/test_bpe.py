import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from siltstone.llm import bpe
from siltstone.llm.bpe import Codec, _merge, decode, encode
from tests.llm.cases import messy, nothing, prose

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_text(draw, size):
    return "".join(draw.choice("aabbcdeé ñß漢字😀\n\t   'rest.,!?0123") for _ in range(size))


def test_pieces_and_texts(reference):
    own, draw = Codec(PATH, PATTERN), random.Random(4)
    texts = [random_text(draw, draw.randrange(200)) for _ in range(400)]
    texts += [" lead", "trail ", "a\u2009 b", "a \u00a0b", "a\x1c b\x85 c", "a  b\n c \nd", "don 't do n't", "1 2", "! !", "a" * 500, "ab" * 700, " " * 300, "<|endoftext|>", "it's we'll 'r 're", "\r\n\r\n x", "é" * 200, "x" + "́" * 90]
    for text in texts:
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == reference.encode_ordinary(text), repr(text)
        assert own.decode(own.encode(text)) == text.encode()


def test_both_ways_of_merging_agree(reference):
    own, draw = Codec(PATH, PATTERN), random.Random(6)
    for _ in range(60):
        piece = "".join(draw.choice("abcdefghij") for _ in range(draw.randrange(65, 400))).encode()
        assert _merge(piece, own.ranks) == reference._core_bpe.encode_single_piece(piece)


@pytest.mark.parametrize("chunk, overlap", [(32_768, 512), (200, 40), (50, 8), (40, 3)])
def test_whole_texts_in_chunks(spark, reference, chunk, overlap):
    draw = random.Random(chunk)
    texts = [random_text(draw, draw.randrange(1200)) for _ in range(40)]
    texts += ["a" * 700, " " * 700, "x " + " " * 301 + "y" * 299 + " z's", "\n" * 333 + "q", "it's " * 150, " ".join(prose(1, 300))]
    frame = messy(spark, texts).where("doc_id is null or doc_id != 5")
    coded = encode(frame, PATH, PATTERN, chunk, overlap)
    assert coded.columns == ["token_ids", *[c for c in frame.columns if c != "text"]]
    back = decode(coded, PATH, PATTERN)
    at_once = encode(frame, PATH, PATTERN, chunk, overlap, decoded=True)
    assert at_once.columns == ["token_ids", "decoded", *coded.columns[1:]]
    assert sorted(map(str, at_once.select("doc_id", "token_ids", "decoded").collect())) == sorted(map(str, back.select("doc_id", "token_ids", "decoded").collect()))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    found = sorted(((r["doc_id"], np.frombuffer(r["token_ids"], "<u4").tolist(), bytes(r["decoded"])) for r in back.collect()), key=key)
    want = sorted(((r["doc_id"], reference.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()) for r in frame.collect()), key=key)
    assert found == want


def test_empty_table_and_no_ids(spark):
    assert decode(encode(nothing(spark), PATH, PATTERN), PATH, PATTERN).collect() == []
    none = spark.createDataFrame([(None, 1)], "token_ids binary, own_row int")
    assert [bytes(r["decoded"]) for r in decode(none, PATH, PATTERN).collect()] == [b""]


def test_words_with_other_marks_share_their_matches(monkeypatch):
    merged, own = [], bpe._merge
    monkeypatch.setattr(bpe, "_merge", lambda piece, ranks: merged.append(piece) or own(piece, ranks))
    monkeypatch.setattr(bpe, "_KEPT", 8)
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = "first qzxwvut, qzxwvut. qzxwvut; qzxwvut: (qzxwvut) qzxwvut! qzxwvut? qzxwvut\n1"
    ids = codec.encode(text)
    assert merged.count(b" qzxwvut") == 1 and codec.decode(ids) == text.encode() and codec.decode(b"") == b""
