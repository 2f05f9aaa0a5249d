"""Deterministic history model: anchored back-projection, growth and weekday intensity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .keys import hash_uniform


def day_index(day: Column, anchor: Column, days: int = K.HISTORY_DAYS) -> Column:
    """0 on the first day of the window, days-1 on the anchor."""
    return F.datediff(day, F.date_sub(anchor, days - 1))


def back_projection(
    key: Column, day: Column, anchor: Column, days: int = K.HISTORY_DAYS,
    seed: int = K.HISTORY_SEED, method: str = "murmur3",
) -> Column:
    """Factor that carries a measure back from the anchor: trend, season and jitter, bounded.

    It is exactly 1 on the anchor and later. The season's phase depends on the key alone, so
    each key keeps its own calendar over the whole window.
    """
    last = days - 1
    index = day_index(day, anchor, days)
    phase = hash_uniform(key, F.lit("static"), "phase", seed, method) * F.lit(K.FULL_TURN)
    noise = hash_uniform(key, day, "price", seed, method) - F.lit(0.5)
    trend = F.lit(-K.TREND_AMPLITUDE) * (F.lit(1.0) - index / F.lit(float(last)))
    season = F.lit(K.SEASON_AMPLITUDE) * F.sin(
        F.lit(2.0 * K.PI) * index / F.lit(K.SEASON_PERIOD_DAYS) + phase
    )
    factor = F.lit(1.0) + trend + season + F.lit(K.JITTER_AMPLITUDE) * noise
    bounded = F.greatest(F.lit(K.FACTOR_FLOOR), F.least(F.lit(K.FACTOR_CEILING), factor))
    return F.when(index >= last, F.lit(1.0)).otherwise(bounded)


def growth(day: Column, anchor: Column, days: int = K.HISTORY_DAYS) -> Column:
    """Share of a cumulative measure already reached on `day`; days before the window count as 0."""
    progress = F.greatest(day_index(day, anchor, days), F.lit(0)) / F.lit(float(days - 1))
    curve = F.lit(K.GROWTH_START) + F.lit(K.GROWTH_SPAN) * F.pow(progress, F.lit(K.GROWTH_POWER))
    return F.least(F.lit(1.0), curve)


def weekday_rate(day: Column, rates: dict[int, float] = K.WEEKDAY_KEEP_RATE) -> Column:
    """Keep rate of the weekday, 1 = Sunday."""
    table = F.array(*[F.lit(float(rates[n])) for n in range(1, 8)])
    return F.element_at(table, F.dayofweek(day))


def order_time(day: Column, hour_uniform: Column, minute_uniform: Column) -> Column:
    """Time of day inside opening hours."""
    hour = F.lit(K.ORDER_FIRST_HOUR) + F.floor(hour_uniform * K.ORDER_HOURS)
    minute = F.floor(minute_uniform * 60)
    return day.cast("timestamp_ntz") + F.make_interval(
        hours=hour.cast("int"), mins=minute.cast("int")
    )
