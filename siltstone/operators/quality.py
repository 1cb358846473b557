"""Rules, routing, dead letters and replay (Q1-Q6, Q11, Q14 and the rule library)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab
from siltstone.functions import text
from siltstone.functions.numbers import clean_number
from siltstone.operators.dedup import near_twin_sums
from siltstone.operators.skew import skew_join


@dataclass(frozen=True)
class Rule:
    """A named defect: `broken` is true on rows that have it; `weight` feeds the review score.

    `rejects=False` only reports: the row is tagged but may still be accepted.
    """

    name: str
    broken: Column
    weight: int = 1
    rejects: bool = True


# --- rule library -------------------------------------------------------------------------------


def null_rule(column: str, name: str | None = None, weight: int = 3) -> Rule:
    return Rule(name or f"null_{column}", F.col(column).isNull(), weight)


def invalid_email(column: str = "email") -> Rule:
    return Rule("invalid_email", F.col(column).isNotNull() & ~text.is_email(F.col(column)), 2)


def phone_too_long(column: str = "phone") -> Rule:
    return Rule("phone_too_long", F.length(column) > vocab.MAX_PHONE_LENGTH, 1)


def outside_enum(column: str, valid: Sequence[str], name: str) -> Rule:
    """A present value that is not one of `valid` (compared trimmed, case-blind). Reports only."""
    wrong = F.col(column).isNotNull() & ~text.upper_trim(F.col(column)).isin(*valid)
    return Rule(name, wrong, 2, rejects=False)


def status_typo(column: str = "status", valid: Sequence[str] = vocab.ORDER_STATUSES) -> Rule:
    return outside_enum(column, valid, "status_typo")


def invalid_payment_method(column: str = "payment_method") -> Rule:
    snake = F.upper(text.snake_category(F.col(column)))
    wrong = F.col(column).isNotNull() & ~snake.isin(*vocab.PAYMENT_METHODS)
    return Rule("invalid_payment_method", wrong, 2, rejects=False)


def after(column: str, as_of: Column, name: str) -> Rule:
    """A time later than `as_of` (an argument: rules never read the clock)."""
    return Rule(name, F.col(column) > as_of, 2)


def future_order_date(as_of: Column, column: str = "order_date") -> Rule:
    return after(column, as_of, "future_order_date")


def future_created_at(as_of: Column, column: str = "created_at") -> Rule:
    return after(column, as_of, "future_created_at")


def implausible_year(column: str, as_of: Column) -> Rule:
    return Rule("implausible_year", F.year(column) > F.year(as_of) + 1, 2)


def negative(column: str, name: str | None = None) -> Rule:
    return Rule(name or f"negative_{column}", F.col(column) < 0, 3)


def zero_price(column: str = "price") -> Rule:
    """Ambiguous: a flash sale or an error."""
    return Rule("zero_price", F.col(column) == 0, 2)


def not_positive(column: str) -> Rule:
    return Rule(f"non_positive_{column}", F.col(column) <= 0, 3)


def sku_format_variant(column: str = "sku") -> Rule:
    return Rule("sku_format_variant", text.sku_canonical(F.col(column))["changed"], 1)


def truncated_name(column: str = "name") -> Rule:
    return Rule("truncated_name", F.length(column).between(3, 8), 1)


def text_rules(column: str) -> list[Rule]:
    c = F.col(column)
    return [
        Rule(f"cut_{column}", text.looks_truncated(c)),
        Rule(f"doubled_vowel_{column}", text.has_doubled_vowel(c)),
        Rule(f"shouting_{column}", text.is_shouting(c)),
        Rule(f"hidden_space_{column}", text.has_hidden_space(c)),
    ]


def with_repeat_flag(df: DataFrame, keys: Sequence[str], into: str) -> DataFrame:
    """Boolean column: the (non-NULL) key occurs on more than one row.

    Serves duplicate_email, duplicate_sku, duplicate_txn_id and duplicate_review.
    """
    repeated = (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1).select(*keys, F.lit(True).alias("_repeated"))
    )
    flagged = skew_join(df, repeated, keys, "left")
    return flagged.withColumn(into, F.coalesce("_repeated", F.lit(False))).select(*df.columns, into)


def with_orphan_flag(df: DataFrame, fk: str, parent: DataFrame, parent_key: str, into: str) -> DataFrame:
    """Boolean column: the reference is present and has no parent (mismatched_order_ref)."""
    known = parent.select(F.col(parent_key).alias(fk)).dropna().distinct().withColumn("_known", F.lit(True))
    judged = skew_join(df, known, [fk], "left")
    return judged.withColumn(into, F.col(fk).isNotNull() & F.col("_known").isNull()).select(*df.columns, into)


def flagged(column: str, weight: int = 2) -> Rule:
    """A rule from a boolean column made by one of the helpers above."""
    return Rule(column, F.col(column), weight)


# --- tagging and splitting ----------------------------------------------------------------------


def tag_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Q2. `_reasons` (names of broken rules, in rule order) and `_dirty_score` (their weight)."""
    hit = {r.name: F.coalesce(r.broken, F.lit(False)) for r in rules}
    names = F.array(*[F.when(hit[r.name], F.lit(r.name)) for r in rules])
    reasons = F.array_except(names, F.array(F.lit(None).cast("string")))  # stays in codegen
    score = reduce(
        lambda total, r: total + F.when(hit[r.name], r.weight).otherwise(0), rules, F.lit(0)
    )
    return df.withColumns({"_reasons": reasons, "_dirty_score": score})


def any_rejects(rules: Sequence[Rule]) -> Column:
    """True on rows that break a rejecting rule."""
    return reduce(
        lambda a, r: a | F.coalesce(r.broken, F.lit(False)), [r for r in rules if r.rejects], F.lit(False)
    )


def is_dirty(df: DataFrame, required: Sequence[str]) -> Column:
    """Flagged DIRTY or QUARANTINE, or a required column is missing. A missing flag means CLEAN."""
    flag = F.coalesce(F.col("_quality_flag"), F.lit(vocab.CLEAN)) if "_quality_flag" in df.columns else F.lit(vocab.CLEAN)
    gap = reduce(lambda a, c: a | F.col(c).isNull(), required, F.lit(False))
    return flag.isin(vocab.DIRTY, vocab.QUARANTINE) | gap


def split_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Q1. (clean, dirty): disjoint, and together the whole input."""
    dirty = is_dirty(df, required)
    return df.filter(~dirty), df.filter(dirty)


# --- repair and routing -------------------------------------------------------------------------


def auto_fix(
    df: DataFrame, reasons: str = "_reasons", sku: str = "sku", phone: str = "phone",
    flag: str = "_quality_flag",
) -> DataFrame:
    """Q3. Repair what has one right answer: SKU spelling and over-long phones.

    Only DIRTY rows all of whose reasons are repairable become CLEAN, with `_auto_fix_note`.
    Prices, amounts and order references are never touched.
    """
    fixable = {}
    if sku in df.columns:
        fixable["sku_format_variant"] = (sku, text.sku_canonical(F.col(sku))["canonical"], "sku normalised")
    if phone in df.columns:
        fixable["phone_too_long"] = (
            phone, text.phone_truncate(F.col(phone)), f"phone cut to {vocab.MAX_PHONE_LENGTH}"
        )
    known = F.array(*[F.lit(name) for name in fixable])
    whole = (
        (F.col(flag) == vocab.DIRTY)
        & (F.size(reasons) > 0)
        & (F.size(F.array_except(F.col(reasons), known)) == 0)
    )
    whole = F.coalesce(whole, F.lit(False))
    changes, notes = {}, []
    for name, (column, repaired, note) in fixable.items():
        hit = whole & F.array_contains(reasons, name)
        changes[column] = F.when(hit, repaired).otherwise(F.col(column))
        notes.append(F.when(hit, F.lit(note)))
    changes["_auto_fix_note"] = F.when(whole, F.concat_ws("; ", *notes))
    changes[flag] = F.when(whole, F.lit(vocab.CLEAN)).otherwise(F.col(flag))
    return df.withColumns(changes)


def route_quality(df: DataFrame, now: Column, flag: str = "_quality_flag") -> DataFrame:
    """Q4. `_route`: silver, dead_letter or quarantine. Run after `auto_fix`.

    A missing flag means CLEAN. Dead letters get `_dlq_ingested_at` and one more `_retry_count`.
    """
    state = F.coalesce(F.col(flag), F.lit(vocab.CLEAN))
    route = (
        F.when(state == vocab.CLEAN, "silver")
        .when(state == vocab.DIRTY, "dead_letter")
        .otherwise("quarantine")
    )
    tries = F.coalesce(F.col("_retry_count"), F.lit(0)) if "_retry_count" in df.columns else F.lit(0)
    out = df.withColumn("_route", route)
    dead = F.col("_route") == "dead_letter"
    return out.withColumns({
        "_dlq_ingested_at": F.when(dead, now),
        "_retry_count": F.when(dead, tries + 1).otherwise(tries),
    })


def routed(df: DataFrame) -> dict[str, DataFrame]:
    """The branches of a routed frame; auto_fixed is the repaired part of silver."""
    parts = {r: df.filter(F.col("_route") == r) for r in ("silver", "dead_letter", "quarantine")}
    if "_auto_fix_note" in df.columns:
        parts["auto_fixed"] = parts["silver"].filter(F.col("_auto_fix_note").isNotNull())
    return parts


DEAD_LETTER_COLUMNS = (
    "id", "_quality_flag", "_bronze_ingested_at", "_source", "_reasons", "_dirty_score", "raw_data",
)


def dead_letter_shape(df: DataFrame, source: str, now: Column) -> DataFrame:
    """One source's rejects in the common shape; absent columns are synthesised."""
    have = set(df.columns)

    def pick(name: str, otherwise: Column) -> Column:
        return (F.coalesce(F.col(name), otherwise) if name in have else otherwise).alias(name)

    return df.select(
        (F.col("id").cast("string") if "id" in have else F.lit(None).cast("string")).alias("id"),
        pick("_quality_flag", F.lit(vocab.DIRTY)),
        pick("_bronze_ingested_at", now),
        F.lit(source).alias("_source"),
        pick("_reasons", F.array().cast("array<string>")),
        pick("_dirty_score", F.lit(0)),
        (F.col("raw_data") if "raw_data" in have else F.lit(None).cast("string")).alias("raw_data"),
    )


def dead_letters(rejects: Mapping[str, DataFrame], now: Column) -> DataFrame:
    """Q5. All rejects, labelled by source."""
    shaped = [dead_letter_shape(df, source, now) for source, df in rejects.items()]
    return reduce(DataFrame.unionByName, shaped)


def replay_dead_letters(
    dlq: DataFrame, rules: Sequence[Rule], required: Sequence[str], accepted: DataFrame,
    key: Sequence[str], now: Column, max_retries: int = 3,
) -> DataFrame:
    """Q6. Try dead letters again: re-tag, repair, re-route.

    Rows out of retries and rows whose key has been accepted meanwhile are not replayed.
    """
    due = dlq.filter(F.coalesce(F.col("_retry_count"), F.lit(0)) < max_retries)
    due = skew_join(due, accepted.select(*key).dropna().distinct(), key, "left_anti")
    again = auto_fix(tag_rules(due.drop("_reasons", "_dirty_score", "_route", "_auto_fix_note"), rules))
    gap = reduce(lambda a, c: a | F.col(c).isNull(), required, F.lit(False))
    kept_dirty = (F.col("_quality_flag") == vocab.CLEAN) & gap
    again = again.withColumn(
        "_quality_flag", F.when(kept_dirty, vocab.DIRTY).otherwise(F.col("_quality_flag"))
    )
    return route_quality(again, now)


# --- checks -------------------------------------------------------------------------------------


def _tallied(
    df: DataFrame, tallies: Mapping[str, Sequence[Column]], references: Mapping[str, tuple[DataFrame, str]], near_keys: tuple | None,
) -> DataFrame:
    """One row of counts over `df`, which is read once: `_total` rows, `_distinct` ones, for each tally how often its conditions hold
    in all, for each reference the rows without a parent (`orphan_<column>`), and `_twins`, the distinct rows with an earlier near twin.

    Whole rows are grouped first, combined map-side; everything else is worked out from the groups, weighted by their size. They
    keep what is counted and the twins' keys, no other columns. A whole row is one key, so that the grouping doesn't stay in partitions
    that a join before it made by one column, whatever rows a hot value of it has.
    """
    rows = df.groupBy(F.struct(*df.columns).alias("_row")).agg(F.count(F.lit(1)).alias("_n")).select("_row.*", "_n")
    for fk, (parent, parent_key) in references.items():
        known = parent.select(F.col(parent_key).alias(fk)).dropna().distinct().withColumn(f"_has_{fk}", F.lit(True))
        rows = skew_join(rows, known, [fk], "left")
    held = {name: reduce(lambda x, c: x + F.when(c, 1).otherwise(0), conditions, F.lit(0)) for name, conditions in tallies.items()}
    held |= {f"orphan_{fk}": F.when(F.col(fk).isNotNull() & F.col(f"_has_{fk}").isNull(), 1).otherwise(0) for fk in references}
    names = {name: f"_c{k}" for k, name in enumerate(held)}
    counts = {"_total": F.col("_n"), "_distinct": F.lit(1).cast("bigint"), **{names[k]: c * F.col("_n") for k, c in held.items()}}
    if near_keys:
        flat = near_twin_sums(rows, counts, *near_keys)
    else:
        flat = rows.select(*[c.alias(k) for k, c in counts.items()], F.lit(0).cast("bigint").alias("_twins"))
    sums = flat.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in (*counts, "_twins")])
    return sums.withColumnsRenamed({v: k for k, v in names.items()})


def expectations(
    df: DataFrame, checks: Mapping[str, Column], *, unique: Sequence[str] = (), near_keys: tuple | None = None,
) -> DataFrame:
    """Q11. `(check, failed, total, passed)`; a check is a Column true on passing rows.

    All checks share one pass over `df`. A NULL outcome is a failure. Two checks are about rows together: with `unique`,
    `no_exact_duplicate` fails rows that repeat an earlier one in these columns; with `near_keys` (the arguments of
    `near_duplicates`), `no_near_duplicate` fails distinct rows with an earlier near twin. Only `unique` columns that aren't all columns take
    a pass of their own.
    """
    broken = {n: [~F.coalesce(c, F.lit(False))] for n, c in checks.items()}
    whole = set(unique) == set(df.columns)
    if near_keys or whole:
        one = _tallied(df, broken, {}, near_keys)
    else:
        one = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(c).alias(n) for n, (c,) in broken.items()])
    rows = [F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("failed"), F.col("_total").alias("total")) for n in checks]
    if whole:
        rows.append(F.struct(F.lit("no_exact_duplicate").alias("check"), (F.col("_total") - F.col("_distinct")).alias("failed"), F.col("_total").alias("total")))
    if near_keys:
        rows.append(F.struct(F.lit("no_near_duplicate").alias("check"), F.col("_twins").alias("failed"), F.col("_distinct").alias("total")))
    found = one.select(F.inline(F.array(*rows)))
    if unique and not whole:
        copies = df.groupBy(*unique).agg(F.count(F.lit(1)).alias("_n"))
        found = found.unionByName(copies.agg(
            F.lit("no_exact_duplicate").alias("check"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("failed"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total")))
    return found.withColumn("passed", F.col("failed") == 0)


@dataclass(frozen=True)
class Checklist:
    """What the checks after cleaning are to look at. Checks whose columns aren't given are left out."""

    required: Sequence[str] = ()
    dates: Sequence[str] = ()
    numbers: Sequence[str] = ()
    positive: Sequence[str] = ()
    rating: str | None = None
    categories: Sequence[str] = ()
    texts: Sequence[str] = ()
    unique: bool = False
    near_keys: tuple | None = None
    references: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)
    total: tuple[str, str, str, str, str] | None = None
    times: tuple[str, str] | None = None


def checklist(df: DataFrame, about: Checklist) -> DataFrame:
    """Q11. The twelve checks after cleaning, `(check, failed, total, passed)` in their order, from one pass over `df`.

    required_present, dates_formatted, numbers_numeric, no_negative, rating_in_range, lower_case, no_exact_duplicate, no_near_duplicate,
    references_exist, no_extra_space, totals_add_up, times_in_order. A row fails a check if any of its columns does; a missing value fails only
    `required_present`, and `totals_add_up` where a part of the total is missing. `total` names subtotal, discount, tax,
    shipping and their total, `times` the earlier and the later time. A row whose reference has no parent counts once for each such reference.
    """
    def any_of(conditions: Sequence[Column]) -> list[Column]:
        return [F.coalesce(reduce(lambda a, c: a | F.coalesce(c, F.lit(False)), conditions, F.lit(False)), F.lit(False))]

    words = lambda c: F.trim(F.col(c).cast("string"))
    cells: dict[str, Sequence[Column]] = {
        "required_present": any_of([F.col(c).isNull() | words(c).isin(*vocab.PLACEHOLDERS) for c in about.required]),
        "dates_formatted": any_of([~F.rlike(F.col(c).cast("string"), F.lit(r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?$")) for c in about.dates]),
        "numbers_numeric": any_of([~F.rlike(words(c), F.lit(r"^-?\d+(\.\d*)?$")) for c in about.numbers]),
        "no_negative": any_of([clean_number(F.col(c).cast("string")) < 0 for c in about.positive]),
        "lower_case": any_of([F.col(c) != F.lower(F.col(c)) for c in about.categories]),
        "no_extra_space": any_of([text.has_hidden_space(F.col(c)) for c in about.texts]),
    }
    given = {
        "required_present": about.required, "dates_formatted": about.dates, "numbers_numeric": about.numbers, "no_negative": about.positive,
        "rating_in_range": about.rating, "lower_case": about.categories, "no_exact_duplicate": about.unique, "no_near_duplicate": about.near_keys,
        "references_exist": about.references, "no_extra_space": about.texts, "totals_add_up": about.total, "times_in_order": about.times}
    if about.rating:
        cells["rating_in_range"] = any_of([~F.col(about.rating).between(1, 5)])
    if about.total:
        subtotal, discount, tax, shipping, total = map(F.col, about.total)
        cells["totals_add_up"] = [~F.coalesce(near(subtotal - discount + tax + shipping, total), F.lit(False))]
    if about.times:
        cells["times_in_order"] = any_of([F.col(about.times[0]) > F.col(about.times[1])])
    one = _tallied(df, cells, about.references, about.near_keys)
    failed = {n: F.col(n) for n in cells} | {
        "no_exact_duplicate": F.col("_total") - F.col("_distinct"), "no_near_duplicate": F.col("_twins"),
        "references_exist": reduce(lambda a, fk: a + F.col(f"orphan_{fk}"), about.references, F.lit(0))}
    rows = [F.struct(F.lit(n).alias("check"), failed[n].cast("bigint").alias("failed"),
                     F.col("_distinct" if n == "no_near_duplicate" else "_total").alias("total")) for n, columns in given.items() if columns]
    return one.select(F.inline(F.array(*rows))).withColumn("passed", F.col("failed") == 0)


def conversion_failures(df: DataFrame, typed: Mapping[str, Column]) -> DataFrame:
    """A9. Per column: values present as text that the typing expression turns into NULL."""
    one = df.agg(*[
        F.count_if(F.col(raw).isNotNull() & value.isNull()).alias(raw) for raw, value in typed.items()
    ])
    return one.unpivot([], list(typed), "column_name", "failures")


def near(a: Column, b: Column, tolerance: float = 0.01) -> Column:
    return F.abs(a - b) <= F.lit(tolerance)


def cross_checks(
    *, order_total: bool = False, item_total: bool = False, cost: bool = False,
    shipped: tuple[str, str] | None = None, estimated: tuple[str, str] | None = None,
) -> dict[str, Column]:
    """Q14. The cross-column identities, as checks for `expectations`."""
    checks: dict[str, Column] = {}
    if order_total:
        parts = F.col("subtotal") - F.col("discount_amount") + F.col("tax_amount") + F.col("shipping_cost")
        checks["order_total"] = near(parts, F.col("total_amount"))
    if item_total:
        checks["item_total"] = near(F.col("quantity") * F.col("unit_price"), F.col("total_price"))
    if cost:
        checks["cost_below_price"] = F.col("cost") <= F.col("price")
    if shipped:
        checks["shipped_before_delivered"] = F.col(shipped[0]) <= F.col(shipped[1])
    if estimated:
        checks["delivered_by_estimate"] = F.col(estimated[0]) <= F.col(estimated[1])
    return checks


def defect_matrix(
    df: DataFrame, table: str, *, text_columns: Sequence[str] = (), dates: Mapping[str, Column] | None = None,
    numbers: Sequence[str] = (), typos: Sequence[str] = (), ranges: Mapping[str, tuple] | None = None,
    unique: Sequence[str] = (), references: Mapping[str, tuple[DataFrame, str]] | None = None,
    near_keys: tuple | None = None,
) -> DataFrame:
    """A8. `(table_name, defect, cells)`: defects of cells, and of rows (exact and near duplicates, orphans), in one pass over `df`.

    Only `unique` columns that aren't all columns take a pass of their own.
    """
    words = [w for w in vocab.PLACEHOLDERS if w]
    texts = [F.col(c) for c in text_columns]
    number_text = [F.col(c) for c in numbers]
    present = [c.isNotNull() & ~F.trim(c).isin(*vocab.PLACEHOLDERS) for c in number_text]
    plain = [F.rlike(F.trim(c), F.lit(r"^-?\d+\.?\d*$")) for c in number_text]
    parsed = [clean_number(c) for c in number_text]
    cells = {
        "null": [F.col(c).isNull() for c in df.columns],
        "empty": [F.trim(c) == "" for c in texts],
        "placeholder": [F.trim(c).isin(*words) for c in texts],
        "bad_date": [
            F.col(c).isNotNull() & ~F.trim(F.col(c)).isin(*vocab.PLACEHOLDERS) & v.isNull()
            for c, v in (dates or {}).items()
        ],
        "bad_number": [p & ~s & n.isNotNull() for p, s, n in zip(present, plain, parsed)],
        "mixed_type": [p & n.isNull() for p, n in zip(present, parsed)],
        "typo": [text.lower_trim(F.col(c)).isin(*vocab.STATUS_TYPOS) for c in typos],
        "out_of_range": [
            ~clean_number(F.col(c)).between(low, high) for c, (low, high) in (ranges or {}).items()
        ],
        "casing": [F.col(c) != F.lower(F.col(c)) for c in typos],
        "hidden_space": [text.has_hidden_space(c) for c in texts],
    }
    references = references or {}
    whole = set(unique) == set(df.columns)
    one = _tallied(df, cells, references, near_keys)
    rows = {n: F.col(n) for n in (*cells, *(f"orphan_{fk}" for fk in references))}
    if whole:
        rows["duplicate"] = F.col("_total") - F.col("_distinct")
    if near_keys:
        rows["near_duplicate"] = F.col("_twins")
    found = one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("defect"), c.cast("bigint").alias("cells")) for n, c in rows.items()])))
    if unique and not whole:
        copies = df.groupBy(*unique).agg(F.count(F.lit(1)).alias("_n"))
        found = found.unionByName(copies.agg(
            F.lit("duplicate").alias("defect"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("cells")))
    return found.select(F.lit(table).alias("table_name"), "defect", "cells")
