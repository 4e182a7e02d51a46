"""Everything that depends on "now" takes the clock as an argument.

Windows are half-open ranges on the raw timestamp column, so the predicate reaches the
Parquet reader.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID_FROM = "_valid_from"
VALID_UNTIL = "_valid_until"
VALID_FLAG = "_valid_flag"

FAR_FUTURE = datetime(2099, 12, 31, 23, 59, 59)
FAR_FUTURE_MIDNIGHT = datetime(2099, 12, 31)


def moment(value: date | datetime) -> datetime:
    return value if isinstance(value, datetime) else datetime.combine(value, time())


def ts(value: date | datetime) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def day(value: date | datetime) -> date:
    return value.date() if isinstance(value, datetime) else value


def hour_floor(value: date | datetime) -> datetime:
    return moment(value).replace(minute=0, second=0, microsecond=0)


def end_of_previous_day(value: date | datetime) -> datetime:
    return datetime.combine(day(value), time()) - timedelta(seconds=1)


def close_at(as_of: date | datetime, rule: str = "hour") -> datetime:
    """When a superseded version ends.

    ``hour``: one second before the current hour. ``seamless``: at the current hour,
    which is the start of the next version, so an as-of read has no gap. ``day``: the
    last second of the previous day.
    """
    if rule == "hour":
        return hour_floor(as_of) - timedelta(seconds=1)
    if rule == "seamless":
        return hour_floor(as_of)
    if rule == "day":
        return end_of_previous_day(as_of)
    raise ValueError(f"unknown close rule {rule!r}")


def stamp_scd(df: DataFrame, as_of: date | datetime, far_future: datetime = FAR_FUTURE) -> DataFrame:
    """Version columns of a row that opens at ``as_of``."""
    return df.withColumns(
        {VALID_FROM: ts(as_of), VALID_UNTIL: ts(far_future), VALID_FLAG: F.lit(True)}
    )


def in_window(df: DataFrame, column: str, as_of: date | datetime, start: int = -1, end: int = 0) -> DataFrame:
    """Rows whose day lies between ``as_of + start`` and ``as_of + end``, both included."""
    lo = day(as_of) + timedelta(days=start)
    hi = day(as_of) + timedelta(days=end + 1)
    return df.where((F.col(column) >= ts(lo)) & (F.col(column) < ts(hi)))


def opened_on(df: DataFrame, column: str, as_of: date | datetime, days_back: int = 1) -> DataFrame:
    """Rows of exactly one day, ``days_back`` before ``as_of``."""
    return in_window(df, column, as_of, start=-days_back, end=-days_back)


def months_back(value: date | datetime, months: int) -> date:
    """Calendar arithmetic: same day ``months`` earlier, clipped to the month's end."""
    d = day(value)
    index = d.year * 12 + d.month - 1 - months
    year, month = divmod(index, 12)
    first_of_next = date(year + (month + 1) // 12, (month + 1) % 12 + 1, 1)
    last = (first_of_next - timedelta(days=1)).day
    return date(year, month + 1, min(d.day, last))


def since(
    df: DataFrame,
    column: str,
    as_of: date | datetime,
    days: int | None = None,
    months: int | None = None,
    include_today: bool = True,
) -> DataFrame:
    """Rows from ``days`` or ``months`` before ``as_of`` on, with or without its own day."""
    if (days is None) == (months is None):
        raise ValueError("give days or months")
    lo = day(as_of) - timedelta(days=days) if days is not None else months_back(as_of, months)
    out = df.where(F.col(column) >= ts(lo))
    return out if include_today else out.where(F.col(column) < ts(day(as_of)))


def current_opened_today(
    df: DataFrame, as_of: date | datetime, country_col: str | None = None, country: str | None = None
) -> DataFrame:
    """Active versions whose validity started on the day of ``as_of`` (or later)."""
    out = df.where(F.col(VALID_FLAG) & (F.col(VALID_FROM) >= ts(day(as_of))))
    if country_col is not None:
        out = out.where(F.upper(F.col(country_col)) == country.upper())
    return out


def iso_week_start(column: Column | str) -> Column:
    """Monday of the ISO week; comparable across year ends, unlike week numbers."""
    col = F.col(column) if isinstance(column, str) else column
    return F.date_trunc("week", col).cast("date")
