"""Exact order statistics of whole columns without sorting or gathering them.

Spark's own exact percentile merges every distinct value into one task. Here mergeable
sketches only propose cut points; counting passes then fix, exactly, how many rows lie
below each cut, and so in which gap between cuts a wanted rank falls. Gaps shrink by a
large factor per pass. The last pass gathers a gap once it is known to hold few rows.
Every pass is a scan whose tasks send a few counts or sketches; sketches merge in two levels.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelry.functions.columns import sql_double, without_nan

GAP_ROWS = 250_000
SKETCH_SIZE = 4_000
GRID_STEPS = 400
MERGE_GROUPS = 200
CHANGED = "The table changed between passes; read it from a stored copy."


@dataclass(frozen=True)
class Wanted:
    """Quantiles of one numeric column.

    rule "linear" interpolates between neighbours, "higher" takes the upper neighbour,
    and "count" takes the ceil(n * q)-th smallest value.
    """

    column: Column
    quantiles: tuple[float, ...]
    rule: str = "linear"

    def ranks(self, n: int, q: float) -> tuple[int, ...]:
        if self.rule == "count":
            return (max(math.ceil(n * q), 1) - 1,)
        position = (n - 1) * q
        if self.rule == "higher":
            return (math.ceil(position),)
        below = math.floor(position)
        return (below, min(below + 1, n - 1))

    def value(self, n: int, q: float, at: Mapping[int, float]) -> float:
        ranks = self.ranks(n, q)
        if len(ranks) == 1:
            return at[ranks[0]]
        a, b = at[ranks[0]], at[ranks[1]]
        t = (n - 1) * q - ranks[0]
        return b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t


@dataclass(frozen=True)
class OrderStats:
    """Values and counts per wanted name, the extra aggregates asked for, and by_rank, the
    data values at every rank that was looked up.
    """

    values: dict[str, list[float] | None]
    counts: dict[str, int]
    also: dict = field(default_factory=dict)
    by_rank: dict[str, dict[int, float]] = field(default_factory=dict)


@dataclass(frozen=True)
class _Gap:
    """Open interval between two counted cuts. below = rows at or under the low cut."""

    low: float | None
    high: float | None
    below: int
    rows: int


class _Cuts:
    """Cut values of one column with the exact number of rows under and up to each."""

    def __init__(self, n: int):
        self.n = n
        self.known: dict[float, tuple[int, int]] = {}

    def locate(self, rank: int) -> float | _Gap:
        low, below = None, 0
        for cut in sorted(self.known):
            under, upto = self.known[cut]
            if rank < under:
                return _Gap(low, cut, below, under - below)
            if rank < upto:
                return cut
            low, below = cut, upto
        return _Gap(low, None, below, self.n - below)


def linear_grid(parts: int) -> tuple[float, ...]:
    """0 to 1 in equal steps, the last one exactly 1."""
    step = 1.0 / parts
    return tuple(i * step for i in range(parts)) + (1.0,)


def order_statistics(
    df: DataFrame,
    wanted: Mapping[str, Wanted],
    also: Mapping[str, Column] | None = None,
    gap_rows: int = GAP_ROWS,
) -> OrderStats:
    """Exact quantiles of several columns together, plus extra aggregates of the first pass.

    NULL and NaN are skipped. An empty column gives None.
    """
    names = list(wanted)
    fields = {name: f"__x{i}" for i, name in enumerate(names)}
    series = [without_nan(wanted[n].column.cast("double")).alias(fields[n]) for n in names]
    extra = dict(also or {})
    narrow = df.select(*series)

    measures = []
    for i, n in enumerate(names):
        x = F.col(fields[n])
        measures += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    measures += [c.alias(f"also{i}") for i, c in enumerate(extra.values())]
    head = (df.select("*", *series) if extra else narrow).agg(*measures).first()

    counts = {n: head[f"n{i}"] for i, n in enumerate(names)}
    cuts = {n: _Cuts(counts[n]) for n in names}
    found: dict[str, dict[int, float]] = {n: {} for n in names}
    for i, n in enumerate(names):
        if counts[n]:
            if math.isinf(head[f"lo{i}"]) or math.isinf(head[f"hi{i}"]):
                raise ValueError(f"'{n}' holds infinite values, which have no place in quantiles.")
            found[n] = {0: head[f"lo{i}"], counts[n] - 1: head[f"hi{i}"]}

    def open_ranks() -> dict[tuple[str, _Gap], list[int]]:
        waiting: dict[tuple[str, _Gap], set[int]] = {}
        for n in names:
            if not counts[n]:
                continue
            for rank in {r for q in wanted[n].quantiles for r in wanted[n].ranks(counts[n], q)}:
                if rank in found[n]:
                    continue
                place = cuts[n].locate(rank)
                if isinstance(place, _Gap):
                    waiting.setdefault((n, place), set()).add(rank)
                else:
                    found[n][rank] = place
        return {key: sorted(ranks) for key, ranks in waiting.items()}

    waiting = open_ranks()
    while wide := {k: r for k, r in waiting.items() if k[1].rows > gap_rows}:
        grids = _sketch_gaps(narrow, fields, cuts, list(wide))
        new: dict[str, set[float]] = {}
        for (n, gap), ranks in wide.items():
            for rank in ranks:
                new.setdefault(n, set()).update(_around(grids[(n, gap)], gap, rank))
        _count_cuts(narrow, fields, cuts, new)
        waiting = open_ranks()
        if set(wide) <= set(waiting):
            raise RuntimeError(CHANGED)
    if waiting:
        _read_gaps(narrow, fields, cuts, waiting, found)

    values = {
        n: [wanted[n].value(counts[n], q, found[n]) for q in wanted[n].quantiles] if counts[n] else None
        for n in names
    }
    return OrderStats(values, counts, {k: head[f"also{i}"] for i, k in enumerate(extra)}, found)


def _around(grid: list[float], gap: _Gap, rank: int) -> set[float]:
    """Grid values one step to either side of a rank, as far as they lie inside the gap."""
    at = (rank + 0.5 - gap.below) / gap.rows * GRID_STEPS
    left, right = math.floor(at) - 1, math.ceil(at) + 1
    inside = {grid[i] for i in (left, right) if 0 <= i <= GRID_STEPS}
    return inside or {grid[GRID_STEPS // 2]}


@dataclass(frozen=True)
class _Cells:
    """Numbers for the gaps between sorted points and for the points themselves.

    The splits put each point in a bucket of its own, [point, next double), so that ties with
    a point are counted apart. Bucketizer looks a value up by binary search; a CASE over many
    points would outgrow what the JVM compiles.
    """

    points: list[float]
    start: int

    @property
    def splits(self) -> list[float]:
        ends = {-math.inf, math.inf}
        return sorted(ends.union(*[{c, math.nextafter(c, math.inf)} for c in self.points]))

    def bucket(self, low: float | None) -> int:
        """Bucket that begins at low, exclusive; None stands for the first bucket."""
        return self.start + (self.splits.index(math.nextafter(low, math.inf)) if low is not None else 0)

    def at(self, point: float) -> int:
        return self.start + self.splits.index(point)


def _with_cells(narrow, fields, points: Mapping[str, list[float]]) -> tuple[DataFrame, dict[str, _Cells]]:
    """Add a cell number column per name. Cells of different names do not overlap."""
    cells, start = {}, 0
    for n, cuts in points.items():
        cells[n] = _Cells(cuts, start)
        start += 2 * len(cuts) + 2
    cut = [n for n in cells if cells[n].points]
    if cut:
        narrow = Bucketizer(
            splitsArray=[cells[n].splits for n in cut],
            inputCols=[fields[n] for n in cut],
            outputCols=[f"{fields[n]}_cell" for n in cut],
            handleInvalid="keep",
        ).transform(narrow)
    numbers = {}
    for n, c in cells.items():
        found = F.col(f"{fields[n]}_cell").cast("int") + c.start if c.points else F.lit(c.start)
        numbers[f"{fields[n]}_cell"] = found if c.points else F.when(F.col(fields[n]).isNotNull(), found)
    return narrow.withColumns(numbers), cells


def _rows_in_gaps(narrow, fields, cuts, gaps) -> tuple[DataFrame, dict[tuple, int]]:
    """(cell, x) for the rows that fall into the gaps, and the cell number of each gap."""
    names = sorted({n for n, _ in gaps})
    placed, cells = _with_cells(narrow, fields, {n: sorted(cuts[n].known) for n in names})
    number = {(n, gap): cells[n].bucket(gap.low) for n, gap in gaps}
    pairs = [F.struct(F.col(f"{fields[n]}_cell").alias("cell"), F.col(fields[n]).alias("x")) for n in names]
    long = placed.select(F.inline(F.array(*pairs)))
    return long.filter(F.col("cell").isin(sorted(number.values())) & F.col("x").isNotNull()), number


def _sketch_gaps(narrow, fields, cuts, gaps) -> dict[tuple, list[float]]:
    """Evenly spaced quantile estimates of each gap, from one sketch per gap.

    Sketches merge first within groups of input partitions and then into one, so that no
    single task merges the sketches of every input partition.
    """
    long, number = _rows_in_gaps(narrow, fields, cuts, gaps)
    groups = (F.spark_partition_id() % F.lit(MERGE_GROUPS)).alias("merge_group")
    partly = long.groupBy("cell", groups).agg(F.kll_sketch_agg_double("x", F.lit(SKETCH_SIZE)).alias("sketch"))
    merged = partly.groupBy("cell").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    steps = F.expr("array(" + ", ".join(sql_double(s) for s in linear_grid(GRID_STEPS)) + ")")
    rows = merged.select("cell", F.kll_sketch_get_quantile_double("sketch", steps).alias("grid")).collect()
    grids = {r["cell"]: r["grid"] for r in rows}
    if set(grids) != set(number.values()):
        raise RuntimeError(CHANGED)
    return {key: grids[cell] for key, cell in number.items()}


def _count_cuts(narrow, fields, cuts, new) -> None:
    """Count the rows under and up to each new cut; the counts make the result exact."""
    points = {n: sorted({*cuts[n].known, *values}) for n, values in new.items()}
    placed, cells = _with_cells(narrow, fields, points)
    numbers = F.array(*[F.col(f"{fields[n]}_cell") for n in points])
    long = placed.select(F.explode(numbers).alias("cell")).filter(F.col("cell").isNotNull())
    rows = {r["cell"]: r["rows"] for r in long.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).collect()}
    for n, c in cells.items():
        upto, low = 0, None
        for point in c.points:
            under = upto
            if low is None or math.nextafter(low, math.inf) < point:
                under += rows.get(c.bucket(low), 0)
            upto = under + rows.get(c.at(point), 0)
            cuts[n].known[point] = (under, upto)
            low = point


def _read_gaps(narrow, fields, cuts, waiting, found) -> None:
    """Read the remaining ranks from gaps counted to hold at most gap_rows rows each.

    The rows of a gap are sorted and numbered, which spills; the ranks wanted, many where a column has many quantiles, are
    a small table that meets them.
    """
    long, number = _rows_in_gaps(narrow, fields, cuts, list(waiting))
    asked = [(number[key], rank - key[1].below) for key, ranks in waiting.items() for rank in ranks]
    asked = pa.table({"cell": pa.array([c for c, _ in asked], pa.int32()), "place": pa.array([p for _, p in asked], pa.int32())})
    numbered = long.withColumn("place", F.row_number().over(Window.partitionBy("cell").orderBy("x")) - 1)
    met = numbered.join(F.broadcast(narrow.sparkSession.createDataFrame(asked)), ["cell", "place"])
    read = {(r["cell"], r["place"]): r["x"] for r in met.collect()}
    for key, ranks in waiting.items():
        places = [(number[key], rank - key[1].below) for rank in ranks]
        if not all(p in read for p in places):
            raise RuntimeError(CHANGED)
        found[key[0]].update((rank, read[p]) for rank, p in zip(ranks, places))


def quantiles(df: DataFrame, column: Column, parts: int, gap_rows: int = GAP_ROWS) -> list[float] | None:
    """Linear-interpolation quantiles of one column at parts + 1 even steps."""
    return order_statistics(df, {"x": Wanted(column, linear_grid(parts))}, gap_rows=gap_rows).values["x"]
