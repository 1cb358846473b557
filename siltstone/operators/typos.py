"""A typo map learned from the values of a column.

Values are counted, and each is posted under itself and all that it becomes when one or two of its characters are left out. Two values at
an edit distance of up to two have such a form in common, so rare and frequent values meet in an equi-join, without all pairs; the
edit distance then decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import lower_trim

DISTANCE = 2
LONGEST = 64
RATIO = 10


def _without_one(words: Column) -> Column:
    """All that the words of an array become when one character is left out."""
    return F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w)))))))


def _forms(word: Column, distance: int) -> Column:
    found = step = F.array(word)
    for _ in range(distance):
        step = _without_one(step)
        found = F.array_union(found, step)
    return found


def learn_typos(
    df: DataFrame, column: str, *, distance: int = DISTANCE, ratio: float = RATIO, least: int = 1, longest: int = LONGEST,
) -> DataFrame:
    """(value, rows, fixed, fixed_rows, distance): the values that are taken for misspellings of a more frequent one.

    Values are compared trimmed and lower-cased. Of the values up to `distance` edits away that have `ratio` times the rows, and `least` rows at
    least, the nearest is taken; of equally near ones the most frequent, then the first. A value's forms grow with the square of its
    length: those over `longest` characters are neither corrected nor corrected to; categories are short. NULL and blank values are left out.
    """
    word = lower_trim(F.col(column))
    counted = df.select(word.alias("value")).filter(F.length("value") > 0).groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
    posted = counted.filter(F.length("value") <= longest).select("value", "rows", F.explode(_forms(F.col("value"), distance)).alias("_form"))
    fixes = posted.filter(F.col("rows") >= least).select(F.col("value").alias("fixed"), F.col("rows").alias("fixed_rows"), "_form")
    met = posted.join(fixes, "_form").filter((F.col("fixed_rows") >= ratio * F.col("rows")) & (F.col("value") != F.col("fixed")))
    pairs = met.select("value", "rows", "fixed", "fixed_rows").distinct().withColumn("distance", F.levenshtein("value", "fixed"))
    best = F.min(F.struct("distance", (-F.col("fixed_rows")).alias("fewer"), "fixed"))
    return pairs.filter(F.col("distance") <= distance).groupBy("value", "rows").agg(best.alias("b")).select(
        "value", "rows", F.col("b.fixed").alias("fixed"), (-F.col("b.fewer")).alias("fixed_rows"), F.col("b.distance").alias("distance"))


def apply_typos(df: DataFrame, column: str, learned: DataFrame) -> DataFrame:
    """`df` with the column's learned misspellings replaced; other values stay as they are."""
    fixes = learned.select(F.col("value").alias("_word"), "fixed").withColumnRenamed("fixed", "_fixed")
    met = df.withColumn("_word", lower_trim(F.col(column))).join(fixes, "_word", "left")
    return met.withColumn(column, F.coalesce("_fixed", F.col(column))).select(*df.columns)
