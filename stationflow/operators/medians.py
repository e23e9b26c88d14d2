"""Medians of many columns at once."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions import missing
from ..sources.storage import staged
from .blocks import ROWS_PER_BLOCK, running_total
from .scalars import one_row, with_scalars

SAMPLE_ROWS = 1_000_000
# Ten standard errors of the median's rank in a sample of that size.
MARGIN = 0.005
_LOW, _HIGH = float("-inf"), float("inf")


def value_counts(df: DataFrame, columns: Sequence[str], brackets: dict[str, list[float]] | None = None) -> DataFrame:
    """(column, value, n) for the non-null values; equal values are counted before they move.

    Values outside the bracket of their column are counted together, as -Infinity or Infinity.
    """

    def value(column: str) -> Column:
        number = F.col(column).cast("double")
        if not brackets or column not in brackets:
            return number.alias(column)
        low, high = brackets[column]
        return F.when(number < low, _LOW).when(number > high, _HIGH).otherwise(number).alias(column)

    return (
        df.select(*[value(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def _brackets(df: DataFrame, columns: Sequence[str], sample_rows: int, margin: float) -> dict[str, list[float]]:
    """Per column two values that very probably enclose the median; nothing for a table that is small anyway."""
    rows = df.count()
    if rows <= sample_rows:
        return {}
    ends = [0.5 - margin, 0.5 + margin]
    sample = df.sample(sample_rows / rows, seed=1)
    found = sample.agg(*[F.percentile_approx(F.col(c).cast("double"), ends).alias(c) for c in columns]).first()
    return {c: found[c] for c in columns if found[c] and all(map(math.isfinite, found[c]))}


def _medians(
    df: DataFrame,
    columns: Sequence[str],
    ranks: Callable[[Column], list[Column]],
    sample_rows: int | None,
    margin: float,
    rows_per_block: int | None,
) -> dict[str, float | None]:
    """Mean of the values at ``ranks(number of values)`` of each column.

    Ranking every distinct value would move a table of measurements once per column. So a sample first tells roughly
    where the median lies; only values in that bracket are told apart, and the others enter as counts. All rows
    are counted, so the ranks are exact. A median that falls outside its bracket is seen as such and computed again
    without one.
    """
    brackets = _brackets(df, columns, sample_rows, margin) if sample_rows else {}
    counts = staged(value_counts(df, columns, brackets), "value_counts")
    ranked = running_total(counts, ["column"], ["value"], F.col("n"), rows_per_block=rows_per_block)
    holds = F.lit(False)
    for rank in ranks(F.col("total")):
        holds = holds | F.col("running").between(rank, rank + F.col("n") - 1)
    middle = ranked.filter(holds).groupBy("column").agg(F.avg("value").alias("median"))
    found = {row["column"]: row["median"] for row in middle.collect()}
    missed = [c for c in brackets if c in found and not math.isfinite(found[c])]
    if missed:
        found |= _medians(df, missed, ranks, None, margin, rows_per_block)
    return {c: found.get(c) for c in columns}


def _one_row(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    schema = StructType([StructField(c, DoubleType()) for c in values])
    return one_row(df.sparkSession, values, schema)


def column_medians(
    df: DataFrame,
    columns: Sequence[str],
    accuracy: int | None = None,
    sample_rows: int | None = SAMPLE_ROWS,
    margin: float = MARGIN,
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """One row with the median of each column: the lower middle value, so always a value that occurs.

    The result is exact; NaN is the largest value. With ``accuracy`` it is ``percentile_approx`` instead: one pass, but the sketches of all tasks
    meet in one.
    """
    if accuracy is not None:
        return df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in columns])
    return _one_row(df, _medians(df, columns, lambda n: [F.ceil(n / 2)], sample_rows, margin, rows_per_block))


def exact_medians(
    df: DataFrame,
    columns: Sequence[str],
    sample_rows: int | None = SAMPLE_ROWS,
    margin: float = MARGIN,
    rows_per_block: int | None = ROWS_PER_BLOCK,
) -> DataFrame:
    """One row with the interpolated median of each column: the mean of the two middle values. NaN counts as missing."""
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])

    def middles(n: Column) -> list[Column]:
        return [F.floor((n + 1) / 2), F.ceil((n + 1) / 2)]

    return _one_row(df, _medians(numbers, columns, middles, sample_rows, margin, rows_per_block))


def fill_with(df: DataFrame, stats: DataFrame, default: float | None = None) -> DataFrame:
    """Replace nulls and NaN in the columns of the one-row frame ``stats``; ``default`` where the statistic is null."""
    filled = {
        c: F.coalesce(F.when(~missing(df, c), F.col(c)), F.col(f"_stats.{c}"), F.lit(default).cast("double"))
        for c in stats.columns
    }
    return with_scalars(df, stats).withColumns(filled).drop("_stats")


def median_impute(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Fill nulls with the column median, or 0.0 where the column has no value at all."""
    present = [c for c in columns if c in df.columns]
    return fill_with(df, column_medians(df, present, accuracy), 0.0)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: nulls per column; NaN counts as null."""
    return df.agg(*[F.count_if(missing(df, c)).alias(c) for c in (columns or df.columns)])


def exact_median_fill(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls and NaN with the interpolated median, in the numeric columns that have any.

    Finding those columns takes one pass that returns one row; a column without values stays null.
    """
    numeric = [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint", "tinyint")]
    wanted = [c for c in (columns or df.columns) if c in numeric]
    nulls = null_counts(df, wanted).first()
    incomplete = [c for c in wanted if nulls[c]]
    return fill_with(df, exact_medians(df, incomplete)) if incomplete else df
