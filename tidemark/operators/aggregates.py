"""Grouped measures. All of them combine on the map side, so hot keys cost one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import in_window, iso_week_start, ts

UNIT = 10_000


def min_max_by(df: DataFrame, keys: Sequence[str], mins: Mapping[str, str], maxs: Mapping[str, str]) -> DataFrame:
    """Earliest / latest values per key; the mappings give source column -> result name."""
    measures = [F.min(c).alias(n) for c, n in mins.items()] + [F.max(c).alias(n) for c, n in maxs.items()]
    return df.groupBy(*keys).agg(*measures)


def count_by(df: DataFrame, cols: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def count_window(df: DataFrame, column: str, as_of: date, start: int = -1, end: int = 0) -> DataFrame:
    """How many rows fall into a window of days."""
    return in_window(df, column, as_of, start, end).agg(F.count(F.lit(1)).alias("total"))


def units(value: str) -> Column:
    """Money (a SQL expression) as whole ten-thousandths, half away from zero.

    Exact for amounts up to 9e11; a long sums many times faster than a wide decimal, and
    unlike a sum of doubles it does not depend on the order of partitions. (A flapping last
    digit would change row hashes and send false deltas.)
    """
    return F.expr(f"if(({value}) < 0, -1L, 1L) * floor(abs(double({value})) * {UNIT} + 0.5D)")


def amount(total: str, places: int = 2) -> Column:
    """A sum of units (a SQL expression) as a decimal amount, half away from zero."""
    return F.expr(f"round(cast({total} as decimal(19,0)) / {UNIT}, {places})")


def money_sum(value: str, when: str | None = None, zero: bool = False) -> Column:
    """Sum of a column of units where a condition holds, as an amount in cents.

    Without any such row it is null, or 0 with ``zero``. Overflow is an error.
    """
    total = f"sum({value})" if when is None else f"sum({value}) filter (where {when})"
    return amount(f"coalesce({total}, 0L)" if zero else total)


def exact_sum(value: str, when: str, places: int = 2) -> Column:
    """Sum of a fractional amount (a SQL expression) where a condition holds, rounded once.

    For quotients and products, whose parts must not be rounded before the sum. Ten decimals
    are kept, so the sum does not depend on the order of partitions. Overflow is an error.
    """
    return F.expr(f"round(sum(cast({value} as decimal(28,10))) filter (where {when}), {places})")


def week_counts(sales: DataFrame, keys: Sequence[str], ts_col: str, count_col: str) -> DataFrame:
    """Units per key and ISO week (named by its Monday)."""
    return sales.groupBy(*keys, iso_week_start(ts_col).alias("week_start")).agg(
        F.sum(count_col).alias("sale_count")
    )


def week_lags(
    sales: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    count_col: str,
    as_of: date,
    lags: Mapping[int, str],
    window_days: int | None = None,
) -> DataFrame:
    """Units of single earlier weeks as columns, e.g. ``{1: "one_week_ago"}``.

    Weeks are told apart by their Monday, so week 1 of a year has a predecessor. With
    ``window_days`` only that many days before ``as_of`` count, and keys without a sale in
    them have no row.
    """
    if window_days is not None:
        sales = sales.where(F.col(ts_col) >= ts(as_of - timedelta(days=window_days)))
    monday = as_of - timedelta(days=as_of.weekday())
    weekly = week_counts(sales, keys, ts_col, count_col)
    columns = [
        F.max(F.when(F.col("week_start") == F.lit(monday - timedelta(weeks=n)), F.col("sale_count"))).alias(name)
        for n, name in lags.items()
    ]
    return weekly.groupBy(*keys).agg(*columns)


def outcome_summary(df: DataFrame, outcome: str, skipped: DataFrame | None = None) -> DataFrame:
    """One row: rows processed, succeeded, failed and skipped."""
    done = df.select(F.coalesce(F.col(outcome), F.lit("failed")).alias("o"))
    if skipped is not None:
        done = done.unionAll(skipped.select(F.lit("skipped").alias("o")))
    o = F.col("o")
    return done.agg(
        F.count(F.when(o != "skipped", 1)).alias("processed"),
        F.count(F.when(o == "success", 1)).alias("success"),
        F.count(F.when(~o.isin("success", "skipped"), 1)).alias("failed"),
        F.count(F.when(o == "skipped", 1)).alias("skipped"),
    )


def chunk_progress(df: DataFrame, chunk: str, failed: Column) -> DataFrame:
    """Processed and failed rows per chunk."""
    return df.groupBy(chunk).agg(
        F.count(F.when(~failed, 1)).alias("processed"), F.count(F.when(failed, 1)).alias("errors")
    )


def error_rate(progress: DataFrame, alert: float = 0.05) -> DataFrame:
    """Over all chunks: totals, errors per processed row (null without any) and the alert."""
    total = progress.agg(
        F.sum("processed").alias("total_processed"), F.sum("errors").alias("total_errors")
    )
    rate = F.try_divide(F.col("total_errors"), F.col("total_processed"))
    return total.withColumn("error_rate", rate).withColumn("alert", F.col("error_rate") > F.lit(alert))
