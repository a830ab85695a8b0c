"""Row filters that the reports share. The clock is always an explicit ``as_of``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from scrimlens.functions.expressions import column

SOLO_QUEUE = 420
RECENT, PREVIOUS = "recent", "previous"


def moment(as_of: str | datetime, days_back: float = 0) -> Column:
    """Zone-less literal ``as_of - days``, cut to the second, so that it reaches the scan."""
    at = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    at = at.replace(microsecond=0, tzinfo=None) - timedelta(days=days_back)
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def since(ts: Column | str, as_of: str | datetime, days: float, open_end: bool = False) -> Column:
    """The last ``days`` days before ``as_of``, which itself is outside; ``open_end`` also takes what comes later.

    Pass ``"m.played_at"`` to qualify the column in a join.
    """
    begun = column(ts) >= moment(as_of, days)
    return begun if open_end else begun & (column(ts) < moment(as_of))


def window_side(ts: Column | str, as_of: str | datetime, days: float) -> Column:
    """``recent`` for the last N days before as_of, else ``previous``; filter to both windows first."""
    return F.when(since(ts, as_of, days), F.lit(RECENT)).otherwise(F.lit(PREVIOUS))


def solo(df: DataFrame, solo_only: bool = True, queue: Column | str = "queue_id") -> DataFrame:
    return df.where(column(queue) == SOLO_QUEUE) if solo_only else df


def with_role(df: DataFrame, role: Column | str, wanted: str | None = None) -> DataFrame:
    """One role, or every assigned role: ``<> ''`` drops the empty and the NULL ones."""
    return df.where(column(role) == wanted) if wanted else df.where(column(role) != "")


def from_day(as_of: str | datetime, days: int) -> Column:
    """Predicate on the text partition keys year, month, day."""
    first = F.date_format(F.date_sub(moment(as_of).cast("date"), days), "yyyyMMdd")
    return F.concat("year", "month", "day") >= first


def checked_days(days: int, most: int = 3650) -> int:
    if isinstance(days, bool) or not 1 <= int(days) <= most:
        raise ValueError(f"days must be a whole number from 1 to {most}")
    return int(days)
