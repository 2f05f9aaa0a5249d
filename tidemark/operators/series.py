"""Windows over daily series. A window partition holds one row per day, so its size is bounded
by the calendar and not by the number of facts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def lagged(measure: str, key: str | Sequence[str], day: str, rows: int = 1) -> Column:
    return F.lag(measure, rows).over(Window.partitionBy(*_keys(key)).orderBy(day))


def moving(
    measure: str, key: str | Sequence[str], day: str, rows: int,
    agg: Callable[[str], Column] = F.avg,
) -> Column:
    """Aggregate of the current and the `rows - 1` preceding rows."""
    window = Window.partitionBy(*_keys(key)).orderBy(day).rowsBetween(1 - rows, Window.currentRow)
    return agg(measure).over(window)


def moving_days(
    measure: str, key: str | Sequence[str], day: str, days: int,
    agg: Callable[[str], Column] = F.avg,
) -> Column:
    """Like `moving`, over calendar days: a missing day does not widen the window."""
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    window = Window.partitionBy(*_keys(key)).orderBy(number).rangeBetween(1 - days, 0)
    return agg(measure).over(window)


def running_in_month(measure: str, key: str | Sequence[str], day: str) -> Column:
    """Month-to-date total; rows of one day share the day's value."""
    window = Window.partitionBy(*_keys(key), F.trunc(F.col(day), "month")).orderBy(day)
    return F.sum(measure).over(window)
