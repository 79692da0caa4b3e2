"""Exact order statistics of every group, for any number of groups and groups of any size.

A group of at most gap_rows rows is sorted as one array. The few larger ones go through rounds: a
sketch of each open gap proposes cut values, one count per (group, cell) fixes exactly how many rows lie
under and on each cut, and so in which smaller gap a wanted rank falls. Groups, gaps and
counts stay tables throughout: nothing of them becomes a literal or goes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelry.functions.columns import named, sql_double, without_nan
from parcelry.operators.joins import lookup_join
from parcelry.operators.order_stats import CHANGED, GAP_ROWS, GRID_STEPS, MERGE_GROUPS, SKETCH_SIZE, Wanted, linear_grid
from parcelry.session import new_shared_path


def _ranks(wanted: Wanted, n: Column) -> list[list[Column]]:
    """The 0-based ranks that each quantile reads, as Wanted.ranks gives them for one known n."""
    found = []
    for q in wanted.quantiles:
        if wanted.rule == "count":
            found.append([F.greatest(F.ceil(n * F.lit(q)), F.lit(1)) - 1])
            continue
        position = (n - 1) * F.lit(q)
        if wanted.rule == "higher":
            found.append([F.ceil(position)])
        else:
            found.append([F.floor(position), F.least(F.floor(position) + 1, n - 1)])
    return found


def _rank_array(wanted: Wanted, n: Column) -> Column:
    return F.array(*[rank.cast("bigint") for ranks in _ranks(wanted, n) for rank in ranks])


def _values(wanted: Wanted, n: Column, at: Column) -> Column:
    """The quantiles from the data values at the ranks of _rank_array."""
    found, place = [], 0
    for q, ranks in zip(wanted.quantiles, _ranks(wanted, n)):
        if len(ranks) == 1:
            found.append(at[place])
        else:
            a, b = at[place], at[place + 1]
            t = (n - 1) * F.lit(q) - F.floor((n - 1) * F.lit(q))
            found.append(F.when(t >= 0.5, b - (b - a) * (1 - t)).otherwise(a + (b - a) * t))
        place += len(ranks)
    return F.array(*found)


def grouped_order_statistics(df: DataFrame, keys: Sequence[str], wanted: Wanted, gap_rows: int = GAP_ROWS) -> DataFrame:
    """(keys, rows, values): the wanted quantiles of each group, in the order asked for.

    NULL keys form groups like any other. NULL and NaN are skipped; a group without a number has 0 rows
    and NULL values. An infinite value fails the query. The table is read several times if a
    group exceeds gap_rows: pass a stored one.
    """
    x = without_nan(wanted.column.cast("double"))
    infinite = F.raise_error(F.lit("A group holds infinite values, which have no place in quantiles.")).cast("double")
    rows = df.select(F.struct(*[named(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("g"), x.alias("x"))
    rows = rows.withColumn("x", F.when(F.abs("x") == float("inf"), infinite).otherwise(F.col("x")))
    sizes = rows.groupBy("g").agg(F.count("x").alias("n")).where(F.col("n") > gap_rows)
    large = _stored(sizes, "large-groups")
    if large.isEmpty():
        found = _small(rows, wanted)
    else:
        marked = lookup_join(rows, large, "g", known_unique=True)
        small = _small(marked.where("n is null").select("g", "x"), wanted)
        found = small.unionByName(_large(rows.where("x is not null"), large, wanted, gap_rows))
    return found.select(*[F.col("g")[f"k{i}"].alias(k) for i, k in enumerate(keys)], F.col("n").alias("rows"), "values")


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _small(rows: DataFrame, wanted: Wanted) -> DataFrame:
    listed = rows.groupBy("g").agg(F.sort_array(F.collect_list("x")).alias("sorted"))
    n = F.size("sorted").cast("bigint")
    ranked = listed.select("g", n.alias("n"), F.transform(_rank_array(wanted, n), lambda r: F.get("sorted", r.cast("int"))).alias("at"))
    return ranked.select("g", "n", F.when(F.col("n") > 0, _values(wanted, F.col("n"), F.col("at"))).alias("values"))


def _large(rows: DataFrame, large: DataFrame, wanted: Wanted, gap_rows: int) -> DataFrame:
    """Ranks of the large groups. A gap (low, high), open at both ends and NULL where it has none, holds
    `size` rows after `below` others; a rank is settled once a counted cut stands on it.
    """
    ranks = F.array_distinct(_rank_array(wanted, F.col("n")))
    gaps = large.select(
        "g", F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        F.lit(0).cast("bigint").alias("below"), F.col("n").alias("size"), ranks.alias("ranks"),
    )
    settled = []
    while True:
        narrow = gaps.where(F.col("size") <= gap_rows)
        settled.append(_stored(_read(rows, narrow), "settled-ranks"))
        gaps = gaps.where(F.col("size") > gap_rows)
        if gaps.isEmpty():
            break
        placed = _stored(_placed(_counted(rows, _cut(rows, gaps))), "placed-ranks")
        if not placed.where("value is null and size >= old_size").isEmpty():
            raise RuntimeError(CHANGED)
        settled.append(placed.where("value is not null").select("g", "rank", "value"))
        open_ranks = placed.where("value is null").groupBy("g", "low", "high", "below", "size")
        gaps = _stored(open_ranks.agg(F.collect_list("rank").alias("ranks")), "open-gaps")
    every = settled[0]
    for more in settled[1:]:
        every = every.unionByName(more)
    by_rank = every.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("by_rank"))
    known = large.join(by_rank, "g", "left")
    lost = F.raise_error(F.lit(CHANGED)).cast("double")
    at = F.transform(_rank_array(wanted, F.col("n")), lambda r: F.coalesce(F.try_element_at("by_rank", r), lost))
    return known.select("g", "n", at.alias("at")).select("g", "n", _values(wanted, F.col("n"), F.col("at")).alias("values"))


def _inside(rows: DataFrame, gaps: DataFrame, *carried: str) -> DataFrame:
    """(g, low, x, carried) of the rows in the gaps. A group has as many gaps as quantiles at most, so
    they are joined as one array a group; a hot group's rows are split by the join, not met in one task.
    """
    one = F.struct("low", "high", *carried)
    listed = gaps.groupBy("g").agg(F.collect_list(one).alias("gaps"))
    met = rows.join(listed, "g").select("g", "x", F.explode("gaps").alias("gap"))
    after = F.col("gap.low").isNull() | (F.col("x") > F.col("gap.low"))
    before = F.col("gap.high").isNull() | (F.col("x") < F.col("gap.high"))
    return met.where(after & before).select("g", "gap.*", "x")


def _cut(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """The gaps with `cuts`: for each rank the values a little under and over it, by a sketch of the gap.

    Sketches merge in two levels, so no task merges those of all input partitions.
    """
    groups = (F.spark_partition_id() % F.lit(MERGE_GROUPS)).alias("merge_group")
    partly = _inside(rows, gaps).groupBy("g", "low", groups).agg(F.kll_sketch_agg_double("x", F.lit(SKETCH_SIZE)).alias("sketch"))
    merged = partly.groupBy("g", "low").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    same = (F.col("a.g") == F.col("b.g")) & F.col("a.low").eqNullSafe(F.col("b.low"))
    both = gaps.alias("a").join(merged.alias("b"), same).select("a.*", "b.sketch")
    steps = F.expr("array(" + ", ".join(sql_double(s) for s in linear_grid(GRID_STEPS)) + ")")
    both = both.withColumn("grid", F.kll_sketch_get_quantile_double("sketch", steps))

    def near(rank):
        at = (rank + 0.5 - F.col("below")) / F.col("size") * GRID_STEPS
        left, right = F.greatest(F.floor(at) - 1, F.lit(0)), F.least(F.ceil(at) + 1, F.lit(GRID_STEPS))
        return F.array(F.get("grid", left.cast("int")), F.get("grid", right.cast("int")))

    cuts = F.array_sort(F.array_distinct(F.flatten(F.transform("ranks", near))))
    return _stored(both.select(*gaps.columns, cuts.alias("cuts")), "cut-gaps")


def _counted(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """(gap, cell, rows): even cells lie between the cuts of a gap, odd ones on a cut."""
    x = F.col("x")
    under = F.size(F.filter("cuts", lambda c: c < x))
    cell = 2 * under + F.array_contains("cuts", x).cast("int")
    found = _inside(rows, cut, "below", "size", "ranks", "cuts").withColumn("cell", cell)
    return found.groupBy("g", "low", "cell").agg(
        F.count(F.lit(1)).alias("rows"), F.any_value(F.struct("high", "below", "size", "ranks", "cuts")).alias("gap")
    )


def _placed(counted: DataFrame) -> DataFrame:
    """A row per rank: its value if a cut stands on it, else the smaller gap it lies in."""
    order = Window.partitionBy("g", "low").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("gap.below") + F.coalesce(F.sum("rows").over(order), F.lit(0))
    cells = counted.withColumn("start", start)
    end = F.col("start") + F.col("rows")
    own = F.filter("gap.ranks", lambda r: (r >= F.col("start")) & (r < end))
    cells = cells.select("g", "low", "cell", "rows", "gap", "start", F.explode(own).alias("rank"))
    place = F.floor(F.col("cell") / 2).cast("int")
    on_cut = F.col("cell") % 2 == 1
    return cells.select(
        "g",
        "rank",
        F.when(on_cut, F.get("gap.cuts", place)).alias("value"),
        F.when(place > 0, F.get("gap.cuts", place - 1)).otherwise(F.col("low")).alias("low"),
        F.coalesce(F.get("gap.cuts", place), F.col("gap.high")).alias("high"),
        F.col("start").alias("below"),
        F.col("rows").alias("size"),
        F.col("gap.size").alias("old_size"),
    )


def _read(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """(g, rank, value) from gaps counted to hold gap_rows rows at most."""
    inside = _inside(rows, gaps, "below", "ranks")
    listed = inside.groupBy("g", "low").agg(
        F.sort_array(F.collect_list("x")).alias("sorted"), F.any_value(F.struct("below", "ranks")).alias("gap")
    )
    value = F.transform("gap.ranks", lambda r: F.struct(r.alias("rank"), F.get("sorted", (r - F.col("gap.below")).cast("int")).alias("value")))
    return listed.select("g", F.inline(value))
