"""Every stage on what the one before it kept, against its operator's brute-force form."""

import os
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from siltstone.llm.quality import judged
from tests.llm import test_decontaminate, test_lines, test_minhash
from tests.llm.cases import texts_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    kept = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], FOLDER).cache())
    return kept


def test_columns_and_sizes(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    counts = [s.count() for s in stages]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0] and counts[-1] == counts[-2]
    assert counts[1] < counts[0] and counts[3] < counts[2] and counts[4] < counts[3]


def test_quality_rules(spark, stages):
    found = {r["doc_id"]: r["kept"] for r in judged(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    assert Counter(texts_of(stages[1])) == Counter((i, t) for i, t in texts_of(stages[0]) if found[i])


def test_line_dedup(stages):
    want = test_lines.expected(texts_of(stages[1]))
    assert Counter((r["doc_id"], r["text"], r["n_chars"]) for r in stages[2].collect()) == Counter((i, t, len(t)) for i, t, *_ in want)


def test_near_dedup(stages):
    rows = texts_of(stages[2])
    assert Counter(texts_of(stages[3])) == Counter(r for r, e in zip(rows, test_minhash.expected(rows, 5)) if e[3])


def test_decontamination(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    bad = {x[0] for x in test_decontaminate.expected(texts_of(stages[3]), items)}
    assert bad and Counter(texts_of(stages[4])) == Counter(r for r in texts_of(stages[3]) if r[0] not in bad)


def test_tokens(stages):
    import tiktoken

    from siltstone.llm.bpe import codec

    ranks = codec(corpus_pipeline.TOKENIZER, corpus_pipeline.PATTERN).ranks
    reference = tiktoken.Encoding("own", pat_str=corpus_pipeline.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert Counter(texts_of(stages[5])) == Counter(texts_of(stages[4]))
    for r in stages[5].collect():
        ids = np.frombuffer(r["token_ids"], "<u4").tolist()
        assert ids == reference.encode_ordinary(r["text"]) and r["n_tokens"] == len(ids)


def test_run(spark, stages):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(shared))
    found = corpus_pipeline.run(spark, FOLDER)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before}
    assert "decontamination" in left and not left & {"work", "quality_rules", "line_dedup", "near_dedup"}, "earlier stages' folders go"
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(r["doc_id"] for r in stages[5].collect())
