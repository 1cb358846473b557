"""Config-driven cleaning of one table (Q12)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import vocab
from siltstone.functions.numbers import clean_number, non_negative
from siltstone.functions.text import fix_typos, snake_category
from siltstone.functions.times import parse_date_formats
from siltstone.operators.dedup import dedup_by
from siltstone.operators.missing import placeholders_to_null, trim_text
from siltstone.operators.quantiles import drop_outliers
from siltstone.sources.files import CORRUPT, split_corrupt


@dataclass(frozen=True)
class CleaningConfig:
    """What to clean in a table. `order` names the columns that choose a duplicate's survivor."""

    categorical: Sequence[str] = ()
    dates: Sequence[str] = ()
    numbers: Sequence[str] = ()
    positive: Sequence[str] = ()
    dedup: Sequence[str] = ()
    order: Sequence[str] = ()
    outliers: Sequence[str] = ()
    typos: dict[str, str] = field(default_factory=dict)
    epoch_dates: bool = False
    accuracy: int | None = None


def clean_table(df: DataFrame, config: CleaningConfig) -> DataFrame:
    """Corrupt rows, placeholders, blanks, casing, dates, numbers, duplicates, outliers, in this order."""
    if CORRUPT in df.columns:
        df, _ = split_corrupt(df)
    df = trim_text(placeholders_to_null(df))
    formats = (vocab.DATETIME_FORMAT, *vocab.DATE_FORMATS)
    repaired = {}
    for c in config.categorical:
        word = snake_category(F.col(c))
        repaired[c] = fix_typos(word, config.typos) if config.typos else word
    for c in config.dates:
        repaired[c] = parse_date_formats(F.col(c), formats, epoch=config.epoch_dates)
    for c in config.numbers:
        number = clean_number(F.col(c))
        repaired[c] = non_negative(number) if c in config.positive else number
    df = df.withColumns(repaired)
    if config.dedup:
        order = list(config.order) or [c for c in df.columns if c not in config.dedup]
        # One packed key: a filter on a key column (the outlier bounds) is then not pushed below the
        # window, where it would repeat the whole repair expression.
        keyed = df.withColumn("_key", F.struct(*config.dedup))
        df = dedup_by(keyed, ["_key"], [F.col(c).asc_nulls_last() for c in order]).drop("_key")
    else:
        df = df.dropDuplicates()
    for c in config.outliers:
        df = drop_outliers(df, c, accuracy=config.accuracy)
    return df


ORDERS_CONFIG = CleaningConfig(
    categorical=("status",),
    dates=("order_date", "created_at", "updated_at"),
    numbers=("subtotal", "discount_amount", "tax_amount", "shipping_cost", "total_amount"),
    positive=("subtotal", "tax_amount", "shipping_cost", "total_amount"),
    dedup=("customer_id", "order_date", "total_amount"),
    order=("id",),
    outliers=("total_amount",),
)
