"""Row and column rules that turn a raw property table into model-ready rows."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.contract import (
    CATEGORY_OPTIONS,
    FIELD_ALIASES,
    MODEL_FEATURES,
    NON_MODEL_COLUMNS,
    NUMERIC_FEATURES,
    OPTIONAL_DEFAULTS,
    TARGET,
    TrainingOptions,
    require_columns,
)
from parcelry.functions.columns import is_present, named

log = logging.getLogger(__name__)


def latest_per_key(
    df: DataFrame, key: str = "property_id", date: str = "snapshot_date", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Newest row of each key. Rows collapse per input partition before the shuffle,
    so a key that holds much of the table still sends one row per task.

    Rows of equal date are ordered by the tiebreak columns, and then by a digest of the row.
    """
    hashed = [named(f.name) for f in df.schema if not isinstance(f.dataType, T.MapType)]
    newest = F.struct(*[named(c) for c in (date, *tiebreak)], F.xxhash64(*hashed).alias("__digest"))
    row = F.max_by(F.struct(*[named(c) for c in df.columns]), newest)
    return df.groupBy(named(key).alias("__key")).agg(row.alias("__row")).select("__row.*")


def drop_duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop repeated rows; identical copies collapse before the shuffle.

    With columns, only those are read and compared, which lets the scan skip the others.
    """
    return df.select(*[named(c) for c in columns]).distinct() if columns else df.distinct()


def drop_non_model_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return df.drop(*[c for c in NON_MODEL_COLUMNS if c not in set(keep)])


def exclude_types(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Remove the listed property types. A missing type stays."""
    if not excluded or "property_type" not in df.columns:
        return df
    return df.filter(F.col("property_type").isNull() | ~F.col("property_type").isin(list(excluded)))


def cast_numeric(df: DataFrame) -> DataFrame:
    """Numeric features as DOUBLE. Text that is no number fails the job."""
    require_columns(df, NUMERIC_FEATURES)
    return df.withColumns({c: F.col(c).cast("double") for c in NUMERIC_FEATURES})


def outlier_condition(options: TrainingOptions) -> Column:
    price, area = F.col(options.target).cast("double"), F.col("living_area").cast("double")
    in_range = price.between(F.lit(options.min_price), F.lit(options.max_price))
    return in_range & (area >= F.lit(options.min_living_area)) & ~F.isnan(area) & ~F.isnan(price)


def remove_outliers(df: DataFrame, options: TrainingOptions, seen: Observation | None = None) -> DataFrame:
    """Keep rows inside the price and living area bounds; missing values fall out.

    An observation, if given, reports rows in and rows kept from the same pass. It pins
    the filter above it, so leave it out where the bounds should reach the file scan.
    """
    if not options.handle_outliers:
        return df
    if options.target not in df.columns:
        raise ValueError(f"remove_outliers needs the price column '{options.target}', which the table lacks")
    if "living_area" not in df.columns:
        log.warning("living_area is absent; no outliers are removed")
        return df
    keep = outlier_condition(options)
    if seen is not None:
        kept = F.count_if(F.coalesce(keep, F.lit(False)))
        df = df.observe(seen, F.count(F.lit(1)).alias("rows_in"), kept.alias("rows_kept"))
    return df.filter(keep)


def select_training_columns(df: DataFrame, target: str = TARGET, extra: Sequence[str] = ()) -> DataFrame:
    """Features then target, in contract order. Missing columns fail before any job."""
    require_columns(df, [*MODEL_FEATURES, target, *extra], "training columns")
    return df.select(*MODEL_FEATURES, target, *extra)


def clean(df: DataFrame, options: TrainingOptions, keep: Sequence[str] = ()) -> DataFrame:
    """Deduplicate raw rows, drop non-model columns, exclude types, cast numerics.

    With dedup_columns in the options only those are read and compared; name every column training needs.
    """
    rows = drop_non_model_columns(drop_duplicate_rows(df, options.dedup_columns or None), keep)
    return cast_numeric(exclude_types(rows, options.exclude_property_types))


def rename_aliases(df: DataFrame) -> DataFrame:
    """Older field names become feature names. Where both hold a value the older one wins."""
    chosen = {}
    for alias, feature in FIELD_ALIASES.items():
        if alias in df.columns:
            both = feature in df.columns
            chosen[feature] = F.coalesce(F.col(alias), F.col(feature)) if both else F.col(alias)
    return df.withColumns(chosen).drop(*FIELD_ALIASES) if chosen else df


def fill_optional(df: DataFrame) -> DataFrame:
    """Default for optional features that are absent or missing. For scoring only."""
    filled = {}
    for feature, default in OPTIONAL_DEFAULTS.items():
        if feature in df.columns:
            x = F.col(feature).cast("double")
            filled[feature] = F.when(is_present(x), x).otherwise(F.lit(default))
        else:
            filled[feature] = F.lit(default)
    return df.withColumns(filled)


def unseen_categories(df: DataFrame, options: Mapping[str, Sequence[str]] = CATEGORY_OPTIONS) -> DataFrame:
    """Category values outside the offered options, with their row counts."""
    pairs = [
        F.struct(
            F.lit(feature).alias("feature"),
            F.when(~named(feature).isin(list(values)), named(feature)).alias("value"),
        )
        for feature, values in options.items()
        if feature in df.columns
    ]
    long = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows"))


@dataclass(frozen=True)
class FieldRule:
    """What one request field must satisfy."""

    name: str
    required: bool = True
    low: float | None = None
    high: float | None = None
    above: float | None = None
    whole: bool = False


# Bounds for request records.
REQUEST_RULES = (
    FieldRule("bedrooms", low=0, high=20, whole=True),
    FieldRule("bathrooms", low=0, high=20),
    FieldRule("livingarea", above=0),
    FieldRule("latitude", required=False, low=-90, high=90),
    FieldRule("longitude", required=False, low=-180, high=180),
    FieldRule("propertytype"),
)

# The tighter bounds of the input form.
FORM_BOUNDS = {
    "bedrooms": (0, 20),
    "bathrooms": (0.0, 20.0),
    "livingarea": (100.0, 20000.0),
    "latitude": (35.5, 36.5),
    "longitude": (-115.5, -114.5),
}


def form_rules(required: Sequence[str]) -> tuple[FieldRule, ...]:
    """Rules of the input form: each required field, bounded where the form bounds it."""
    return tuple(FieldRule(f, True, *FORM_BOUNDS.get(f, (None, None))) for f in required)


def _broken(df: DataFrame, rule: FieldRule) -> list[Column]:
    """One column per fault of a rule. Text is read as a number where the rule asks for one."""
    kind = df.schema[rule.name].dataType
    given = named(rule.name)
    bounded = rule.whole or any(b is not None for b in (rule.low, rule.high, rule.above))
    text = isinstance(kind, T.StringType)
    missing = given.isNull() | (given == "") if text else given.isNull()
    checks = []
    x = None
    if isinstance(kind, T.NumericType):
        x = given.cast("double")
        missing = missing | F.isnan(x)
    elif text and bounded:
        x = F.expr(f"try_cast(`{rule.name.replace('`', '``')}` AS double)")
        checks.append((~missing & (x.isNull() | F.isnan(x)), "must be a number"))
    if rule.required:
        checks.insert(0, (missing, "required"))
    if x is not None:
        there = ~missing & ~F.isnan(x)
        if rule.whole:
            checks.append((there & (x != F.floor(x)), "must be a whole number"))
        if rule.low is not None:
            checks.append((there & (x < F.lit(float(rule.low))), f"must be >= {rule.low}"))
        if rule.high is not None:
            checks.append((there & (x > F.lit(float(rule.high))), f"must be <= {rule.high}"))
        if rule.above is not None:
            checks.append((there & (x <= F.lit(float(rule.above))), f"must be > {rule.above}"))
    return [F.when(bad, F.lit(f"{rule.name}: {what}")) for bad, what in checks]


def with_errors(df: DataFrame, rules: Sequence[FieldRule] = REQUEST_RULES) -> DataFrame:
    """Add an errors array; a row is valid when it is empty. A required field whose
    column is absent is an error on every row.
    """
    found = []
    for rule in rules:
        if rule.name in df.columns:
            found += _broken(df, rule)
        elif rule.required:
            found.append(F.lit(f"{rule.name}: required"))
    if not found:
        return df.withColumn("errors", F.array().cast("array<string>"))
    return df.withColumn("errors", F.array_compact(F.array(*found)))


def split_valid(df: DataFrame, rules: Sequence[FieldRule] = REQUEST_RULES) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the errors column, and rejected rows with it."""
    checked = with_errors(df, rules)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def reject_summary(checked: DataFrame) -> DataFrame:
    """Rows per error message."""
    return checked.select(F.explode("errors").alias("error")).groupBy("error").agg(
        F.count(F.lit(1)).alias("rows")
    )
