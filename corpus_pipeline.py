"""From raw documents to token ids: rules, repeated lines, near duplicates, benchmark passages, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import bpe, decontaminate, lines, minhash, quality
from siltstone.llm.frames import stored
from siltstone.session import remove_folder, scratch_folder, working_folder

#: The ranks that texts are encoded by, and the pattern that splits them.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

#: Quality rules are learned, so SQL can't state the rows.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go. A null text has no words, so it goes; equal rows are judged alike."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines that stand in an earlier document go; `n_chars`, where there is one, follows the text.

    Documents stay, those without a line left too. A null text stays null; rows equal in doc_id and text lose the same lines.
    """
    found = lines.remove_repeated_lines(docs).select(*docs.columns)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays. Null texts and those without words are in no group, and stay."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. A null text holds none; equal rows are judged alike."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of `docs`, text being what the ids decode to, then token_ids (4 bytes for each id) and n_tokens.

    A null text comes back empty, without ids. Columns of these two names in `docs` are replaced.
    """
    found = bpe.encode(docs, TOKENIZER, PATTERN, decoded=True).withColumn("text", F.col("decoded").cast("string"))
    return found.select(*[c for c in docs.columns if c not in ("token_ids", "n_tokens")], "token_ids", F.expr("cast(octet_length(token_ids) div 4 as bigint)").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each but the last written to the shared folder and read back.

    What a stage has stored on its way goes when its result is written, and that result when the next one is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        place = scratch_folder(spark, name)
        with working_folder(spark):
            docs = stored(stage(spark, docs, sf_dir), name, path=place)
        if before:
            remove_folder(spark, before)
        before = place
    return STAGES[-1][1](spark, docs, sf_dir)
