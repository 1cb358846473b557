"""Line dedup: content-defined chunks of lines, removed where the same chunk of several lines stands earlier.

A number is made of each line's digest; where the rolling sum over the last two lines is lower than both sums beside it, a chunk
begins. The cut depends on the lines near it alone, so a passage gives the same chunks wherever it stands, and two cuts are never
next to each other: with the first and last line kept from standing alone, every chunk of a text of several lines has two lines or
more. Lines that alternate with period 2 have every second sum lower, and are cut into pairs; runs of one line, whose sums are all
equal, are cut into pairs as well. Chunks whose hash occurs more than once are grouped by their bytes; all but the first of
each group go. Only built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import row_print, stored

FACTOR = 31


def _chunked(rows: DataFrame) -> DataFrame:
    """`rows` (with `text`) with `chunks`: array of (at, lines, body), `at` being the chunk's number."""
    rows = rows.withColumn("lines", F.split("text", "\n", -1))
    rows = rows.withColumn("marks", F.transform("lines", lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long")))
    rows = rows.withColumn("sums", F.transform("marks", lambda x, i: F.when(i > 1, F.get("marks", i - 1) + FACTOR * F.get("marks", i - 2))))

    def opens(own: Column, i: Column) -> Column:
        low = (own < F.coalesce(F.get("sums", i - 1), own + 1)) & (own < F.get("sums", i + 1))
        # Of a run of one line, by whose marks it is told, every second place; not next to its ends, where sums differ.
        run = (i % 2 == 0) & (i > 2) & F.forall(F.array(F.lit(-3), F.lit(-2), F.lit(-1), F.lit(1)), lambda k: F.get("lines", i + k) == F.get("lines", i))
        return (i == 0) | (i > 1) & (i < F.size("lines") - 1) & (low | run)

    numbered = F.transform("sums", lambda x, i: F.when(opens(x, i), i))
    rows = rows.withColumn("opens", F.filter(numbered, lambda x: x.isNotNull()))
    length = lambda k: F.coalesce(F.get("opens", k + 1), F.size("lines")) - F.get("opens", k)
    return rows.withColumn("chunks", F.transform("opens", lambda o, k: F.struct(
        k.alias("at"), length(k).alias("lines"), F.array_join(F.slice("lines", o + 1, length(k)), "\n").alias("body")))).drop("marks", "sums", "opens")


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text, anything else) with `text` short of repeated chunks, then n_lines and n_removed_lines.

    The occurrence with the smallest doc_id stays, and of several in one text the first; a null doc_id comes before all others.
    Rows that are equal in doc_id and text count as one, and are treated alike. Lines are split at line feeds alone. A null
    text stays null with no lines; an empty one is a single empty line. A text of one line is left alone. A column that clashes with the two counts is
    replaced; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col("doc_id").alias("own_id"), F.col("text"), row_print(F.col("text")).alias("own_print"))
    # explode_outer: a plain one has the optimizer copy the chunks' expression into filters, and its lambdas into each other.
    chunks = _chunked(rows.select("own_id", "own_print", "text")).select(
        "own_id", "own_print", F.explode_outer("chunks").alias("c")).where("c.lines > 1").select(
        "own_id", "own_print", F.col("c.at").alias("at"), F.col("c.body").alias("body"), F.xxhash64("c.body").alias("hash"))
    repeated = chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    # Both sides of each join here grow with the corpus: none is broadcast, at any size.
    suspects = stored(chunks.join(repeated.select("hash").hint("merge"), "hash"), "suspects")
    place = F.struct("own_id", "own_print", "at")
    firsts = suspects.groupBy("hash", "body").agg(F.min(place).alias("first"))
    gone = (
        suspects.join(firsts.hint("merge"), ["hash", "body"]).where(~place.eqNullSafe(F.col("first")))
        .groupBy("own_id", "own_print").agg(F.collect_set("at").alias("gone"))
    )
    gone = stored(gone, "gone", small=True).withColumnsRenamed({"own_id": "gone_id", "own_print": "gone_print"})
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines")]
    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *[c for c in columns if c != "text"]).alias("row"), F.col("text"), F.col("doc_id").alias("own_id"), row_print(F.col("text")).alias("own_print"))
    marked = rows.join(gone.hint("merge"), rows.own_id.eqNullSafe(gone.gone_id) & (rows.own_print == gone.gone_print), "left")
    marked = _chunked(marked.select("row", "text", "gone"))
    stay = F.filter("chunks", lambda c: ~F.array_contains("gone", c["at"]))
    marked = marked.withColumn("stay", F.when(F.col("gone").isNotNull(), stay))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform("stay", lambda c: c["body"]), "\n"))
    return marked.select(
        *[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in columns],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(
            F.size("lines") - F.aggregate("stay", F.lit(0), lambda n, c: n + c["lines"])).cast("long").alias("n_removed_lines"))
