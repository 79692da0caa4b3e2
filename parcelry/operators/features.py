"""Imputing, scaling and one-hot encoding, fitted once and applied as plain expressions."""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.contract import CATEGORICAL_FEATURES, NUMERIC_FEATURES, require_columns
from parcelry.functions.columns import named, sql_double, sql_string, without_nan
from parcelry.operators.joins import lookup_join
from parcelry.operators.order_stats import Wanted, order_statistics
from parcelry.session import held, new_shared_path

ASSEMBLED = "features"


@dataclass(frozen=True)
class NumericFit:
    """median fills gaps; mean and scale are over the filled column."""

    name: str
    median: float
    mean: float
    scale: float


@dataclass(frozen=True)
class CategoryFit:
    """fill replaces a missing value; categories are sorted."""

    name: str
    fill: str
    categories: tuple[str, ...]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fit_numeric(df: DataFrame, names: Sequence[str]) -> list[NumericFit]:
    """Median, then mean and population deviation of the median-filled column.

    Filling k gaps of n values with the median m moves the mean of the present values mu by
    a known amount, so mean and deviation come from the pass that counts, with no second
    look at the filled column. A column of one value, and one whose deviation is within rounding of
    zero, is scaled by 1.
    """
    wanted = {c: Wanted(named(c), (0.5,)) for c in names}
    also = {"rows": F.count(F.lit(1))}
    for c in names:
        x = without_nan(named(c).cast("double"))
        also[f"mean {c}"] = F.avg(x)
        also[f"var {c}"] = F.var_pop(x)
        also[f"low {c}"], also[f"high {c}"] = F.min(x), F.max(x)
    stats = order_statistics(df, wanted, also)
    rows, fits = stats.also["rows"], []
    for c in names:
        present = stats.counts[c]
        if not present:
            raise ValueError(f"Numeric feature '{c}' has no values to fit on.")
        median, mu, spread = stats.values[c][0], stats.also[f"mean {c}"], stats.also[f"var {c}"]
        gaps = rows - present
        mean = (present * mu + gaps * median) / rows
        var = (present * (spread + (mu - mean) ** 2) + gaps * (median - mean) ** 2) / rows
        if stats.also[f"low {c}"] == stats.also[f"high {c}"]:
            mean, var = median, 0.0
        noise = rows * sys.float_info.epsilon
        fits.append(NumericFit(c, median, mean, 1.0 if var <= noise * var + (noise * mean) ** 2 else math.sqrt(var)))
    return fits


def category_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, value, rows) for all the columns together, counted before the shuffle."""
    pairs = [F.struct(F.lit(c).alias("feature"), named(c).cast("string").alias("value")) for c in names]
    long = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows"))


def fit_categorical(df: DataFrame, names: Sequence[str]) -> list[CategoryFit]:
    """Sorted categories and the most frequent one, the smallest among ties.

    The categories become names of the model's features and so go to the driver. To number
    the values of a column without that, see category_index.
    """
    if not names:
        return []
    by_feature: dict[str, list] = {c: [] for c in names}
    for r in category_counts(df, names).toLocalIterator():
        by_feature[r["feature"]].append((r["value"], r["rows"]))
    fits = []
    for c in names:
        counted = by_feature[c]
        if not counted:
            raise ValueError(f"Categorical feature '{c}' is missing on every row; nothing can be encoded.")
        fill = min(counted, key=lambda vr: (-vr[1], vr[0]))[0]
        fits.append(CategoryFit(c, fill, tuple(sorted(v for v, _ in counted))))
    return fits


def placed_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, value, part, at): the distinct values in sorted order over the parts of a range partitioning.

    Written before it is read, so that the places stay as they are however often they are used.
    """
    found = category_counts(df, names).select("feature", "value")
    ordered = found.repartitionByRange("feature", "value").sortWithinPartitions("feature", "value")
    path = new_shared_path(df.sparkSession, "numbered-values")
    ordered.withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    part = F.shiftright("at", 33).alias("part")  # the id holds the partition, then 33 bits of the place in it
    return df.sparkSession.read.parquet(path).select("feature", "value", part, "at")


def category_index(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, value, index): the place of each value among its column's sorted values, from 0.

    A number is the value's place in its own part after the rows of the parts before. No task holds more than
    a part, whatever the values share; only the sizes of the parts, a row a feature and part, go to the driver.
    """
    placed = placed_values(df, names)
    sizes = placed.groupBy("feature", "part").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first")).collect()
    starts, before = [], dict.fromkeys(names, 0)
    for r in sorted(sizes, key=lambda r: r["part"]):
        starts.append((r["feature"], r["part"], before[r["feature"]] - r["first"]))
        before[r["feature"]] += r["size"]
    parts = df.sparkSession.createDataFrame(starts, "feature string, part bigint, start bigint")
    return placed.join(parts, ["feature", "part"]).select("feature", "value", (F.col("at") + F.col("start")).alias("index"))


def encode_index(df: DataFrame, column: str, index: DataFrame) -> DataFrame:
    """df with `index`, the 0-based category of a column: a one-hot vector as its only non-zero place.

    Missing and unseen values have NULL. The lookup is joined, however many categories it holds.
    """
    own = index.where(F.col("feature") == column).select(F.col("value").alias("__value"), "index")
    rows = df.withColumn("__value", named(column).cast("string"))
    return lookup_join(rows, own, "__value", known_unique=True).select(*[named(c) for c in df.columns], "index")


def impute_numeric(df: DataFrame, fits: Sequence[NumericFit]) -> DataFrame:
    """Median in place of a missing number."""
    return df.withColumns(
        {f.name: F.coalesce(without_nan(named(f.name).cast("double")), F.lit(f.median)) for f in fits}
    )


def scale_numeric(df: DataFrame, fits: Sequence[NumericFit]) -> DataFrame:
    """Imputed numbers, centred and divided by the population deviation."""
    filled = impute_numeric(df, fits)
    return filled.withColumns({f.name: (named(f.name) - F.lit(f.mean)) / F.lit(f.scale) for f in fits})


def impute_categorical(df: DataFrame, fits: Sequence[CategoryFit]) -> DataFrame:
    """Most frequent category in place of a missing one."""
    return df.withColumns({f.name: F.coalesce(named(f.name), F.lit(f.fill)) for f in fits})


def one_hot(column: Column, categories: Sequence[str]) -> list[Column]:
    """A 0/1 column per category; unseen and missing values give zeros throughout."""
    return [F.when(column == F.lit(c), F.lit(1.0)).otherwise(F.lit(0.0)) for c in categories]


@dataclass(frozen=True)
class FittedPreprocessor:
    """Fitted constants of all features. Applying them is one projection."""

    numeric: tuple[NumericFit, ...]
    categorical: tuple[CategoryFit, ...]

    @property
    def input_columns(self) -> list[str]:
        return [f.name for f in self.numeric] + [f.name for f in self.categorical]

    @property
    def feature_names(self) -> list[str]:
        encoded = [f"{f.name}_{value}" for f in self.categorical for value in f.categories]
        return [f.name for f in self.numeric] + encoded

    def expressions(self) -> list[str]:
        """SQL text of each output feature, with every fitted value as a literal."""
        texts = []
        for f in self.numeric:
            x = f"cast({_quoted(f.name)} as double)"
            filled = f"coalesce(CASE WHEN NOT isnan({x}) THEN {x} END, {sql_double(f.median)})"
            texts.append(f"({filled} - {sql_double(f.mean)}) / {sql_double(f.scale)}")
        for f in self.categorical:
            value = f"coalesce(cast({_quoted(f.name)} as string), {sql_string(f.fill)})"
            texts += [f"CASE WHEN {value} = {sql_string(c)} THEN 1D ELSE 0D END" for c in f.categories]
        return texts

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Feature columns, after any columns to keep; everything else is dropped."""
        require_columns(df, self.input_columns)
        made = [F.expr(text).alias(name) for text, name in zip(self.expressions(), self.feature_names)]
        return df.select(*keep, *made)

    @property
    def binned_columns(self) -> tuple[list[str], list[str]]:
        """Columns that `stages` adds before the vector: the scaled numbers, and each category's place."""
        return [f"__f{i}" for i in range(len(self.numeric))], [f"__fi{i}" for i in range(len(self.categorical))]

    def stages(self, spark: SparkSession) -> list:
        """ML stages that add one feature vector column, in the order of feature_names.

        A category is looked up by hash and becomes one place of a sparse vector, so that the cost of a row
        does not grow with the number of categories.
        """
        numbers, places = self.binned_columns
        values, vectors = ([f"__{kind}{i}" for i in range(len(self.categorical))] for kind in ("fk", "fv"))
        filled = [f"coalesce(cast({_quoted(f.name)} as string), {sql_string(f.fill)})" for f in self.categorical]
        made = [f"{text} AS {name}" for text, name in zip([*self.expressions()[: len(numbers)], *filled], numbers + values)]
        stages = [SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")]
        if values:
            # an unseen value gets the place after the last, which the encoder drops
            lookups = [StringIndexerModel.from_labels(list(f.categories), v, p, "keep") for f, v, p in zip(self.categorical, values, places)]
            sample = PipelineModel(lookups).transform(spark.createDataFrame([], ", ".join(f"{v} string" for v in values)))
            stages += [*lookups, OneHotEncoder(inputCols=places, outputCols=vectors, dropLast=True).fit(sample)]
        return [*stages, VectorAssembler(inputCols=numbers + vectors, outputCol=ASSEMBLED)]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FittedPreprocessor:
        stored = json.loads(text)
        return FittedPreprocessor(
            tuple(NumericFit(**f) for f in stored["numeric"]),
            tuple(CategoryFit(f["name"], f["fill"], tuple(f["categories"])) for f in stored["categorical"]),
        )


class Preprocessor:
    """Fits and applies the feature transforms; applying before fitting is an error."""

    def __init__(self, numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES):
        self.numeric_features = list(numeric)
        self.categorical_features = list(categorical)
        self.fitted: FittedPreprocessor | None = None

    def fit(self, df: DataFrame, hold: bool = True) -> FittedPreprocessor:
        """Fit on the feature columns, held while the passes read them.

        hold=False suits a table the caller already keeps.
        """
        names = self.numeric_features + self.categorical_features
        require_columns(df, names)
        if hold:
            with held(df.select(*[named(c) for c in names])) as rows:
                return self.fit(rows, hold=False)
        self.fitted = FittedPreprocessor(
            tuple(fit_numeric(df, self.numeric_features)),
            tuple(fit_categorical(df, self.categorical_features)),
        )
        return self.fitted

    def fit_transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return self.fit(df).transform(df, keep)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return self._ready("transform").transform(df, keep)

    def get_feature_names(self) -> list[str]:
        return self._ready("reading feature names").feature_names

    def _ready(self, step: str) -> FittedPreprocessor:
        if self.fitted is None:
            raise RuntimeError(f"Call fit first: {step} needs a fitted preprocessor")
        return self.fitted
