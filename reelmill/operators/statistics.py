"""Aggregates: exact medians, regression metrics, latest year."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from reelmill.functions.eras import NO_YEAR_FALLBACK

BUCKETS = 1000              # quantiles of an open interval that one pass takes
SKETCH = 10                 # times as fine as the quantiles is the sketch they come from
LAST_ROWS = 1 << 16         # rows of an interval whose distinct values are counted one by one


@dataclass(frozen=True)
class _Search:
    """The value at ``rank`` of ``column`` lies in [low, high]."""

    column: str
    rank: int
    low: float
    high: float
    rows: int               # in between, at most


@dataclass(frozen=True)
class Range:
    """Non-NULL count, least and greatest value of a column."""

    rows: int
    low: float | None
    high: float | None


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, Range]:
    """Ranges of all columns from one pass."""
    wanted = [f(c) for c in columns for f in (F.count, F.min, F.max)]
    totals = df.agg(*[total.alias(f"_{i}") for i, total in enumerate(wanted)]).first()
    return {c: Range(*totals[3 * i : 3 * i + 3]) for i, c in enumerate(columns)}


def exact_medians(
    df: DataFrame,
    columns: Sequence[str],
    ranges: dict[str, Range] | None = None,
    buckets: int = BUCKETS,
    last_rows: int = LAST_ROWS,
) -> dict[str, float | None]:
    """Exact interpolated median of every column, NULLs left out.

    Every pass takes, for all columns together, a mergeable quantile sketch of the values
    strictly inside the interval that holds the middle, and counts those below it and at
    its lower end. The next interval is the two quantiles around the middle, so a pass leaves
    some ``3 / buckets`` of the rows whatever the values' scale; an interval of few rows is
    counted value by value. No task holds the values: one pass for a small table, two for
    ten million rows, three for billions, beside the one for the ranges.
    """
    ranges = ranges or column_ranges(df, columns)
    found: dict[tuple[str, int], float] = {}
    searches = []
    ranks = {}
    for c in columns:
        n, low, high = ranges[c].rows, ranges[c].low, ranges[c].high
        ranks[c] = sorted({(n - 1) // 2, n // 2}) if n else []
        searches += [_Search(c, rank, float(low), float(high), n) for rank in ranks[c]]
    while searches:
        for s in searches:
            if s.low == s.high:
                found[s.column, s.rank] = s.low
        searches = [s for s in searches if s.low < s.high]
        few = [s for s in searches if s.rows <= last_rows]
        many = [s for s in searches if s.rows > last_rows]
        for s, value in zip(few, _counted(df, few)):
            found[s.column, s.rank] = value
        searches = _narrowed(df, many, buckets)
    return {
        c: sum(found[c, r] for r in ranks[c]) / len(ranks[c]) if ranks[c] else None
        for c in columns
    }


def _intervals(searches: list[_Search]) -> list[tuple[str, float, float]]:
    return sorted({(s.column, s.low, s.high) for s in searches})


def _value(column: str) -> Column:
    return F.col(column).cast("double")


def _narrowed(df: DataFrame, searches: list[_Search], buckets: int) -> list[_Search]:
    """The searches with the interval between the quantiles around their rank."""
    if not searches:
        return []
    steps = [k / buckets for k in range(buckets + 1)]
    intervals, wanted = _intervals(searches), []
    for column, low, high in intervals:
        value = _value(column)
        inside = (value > low) & (value < high)
        wanted += [
            F.count_if(value < low), F.count_if(value == low), F.count_if(inside),
            F.approx_percentile(F.when(inside, value), steps, SKETCH * buckets),
        ]
    totals = df.agg(*[total.alias(f"_{i}") for i, total in enumerate(wanted)]).first()
    narrowed = []
    for s in searches:
        k = 4 * intervals.index((s.column, s.low, s.high))
        below, at_low, inside, cuts = totals[k : k + 4]
        rank = s.rank - below - at_low          # among the values inside
        if rank < 0:
            low = high = s.low
        elif rank >= inside:
            low = high = s.high
        else:
            step = rank * buckets // inside
            low, high = cuts[max(step - 1, 0)], cuts[min(step + 2, buckets)]
        narrowed.append(_Search(s.column, s.rank, low, high, 4 * inside // buckets + 2))
    return narrowed


def _counted(df: DataFrame, searches: list[_Search]) -> list[float]:
    """The values themselves, from the counts of all distinct ones in the intervals."""
    if not searches:
        return []
    intervals = _intervals(searches)
    values = F.array(
        *[
            F.when(
                _value(c) <= high,
                F.struct(F.lit(i).alias("interval"), F.greatest(_value(c), F.lit(low)).alias("value"), (_value(c) < low).alias("below")),
            )
            for i, (c, low, high) in enumerate(intervals)
        ]
    )
    counted = df.select(F.inline(F.array_compact(values))).groupBy("interval", "below", "value").count()
    histogram: list[list] = [[] for _ in intervals]
    for row in sorted(counted.collect(), key=lambda r: (r["value"], not r["below"])):
        histogram[row["interval"]].append(row)
    found = []
    for s in searches:
        k = intervals.index((s.column, s.low, s.high))
        rank = s.rank
        for row in histogram[k]:
            if rank < row["count"]:
                found.append(row["value"])
                break
            rank -= row["count"]
    return found


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: row count, RMSE, MAE and R-squared, in a single pass.

    The spread around the mean comes from the mergeable population variance, so the
    mean is not needed first.
    """
    error = F.col(actual) - F.col(predicted)
    unexplained: Column = F.sum(error * error)
    spread: Column = F.var_pop(actual) * F.count(actual)
    r2 = F.when(spread > 0, 1 - unexplained / spread).otherwise(
        F.when(unexplained == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    return df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        r2.alias("r2"),
    )


def latest_year(ranges: dict[str, Range], column: str = "startYear") -> int:
    """The latest year, or the fallback where no year is known."""
    latest = ranges[column].high
    return NO_YEAR_FALLBACK if latest is None else int(latest)
