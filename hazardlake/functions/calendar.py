"""Date and time expressions. All of them assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazardlake import constants as k

PARTS = {"ano": F.year, "mes": F.month, "dia": F.dayofmonth, "hora": F.hour}


def parse_instant(text: Column) -> Column:
    """ISO-8601 text with ``Z`` or an offset to a timestamp; anything else to null."""
    return F.try_to_timestamp(text)


def hour_bucket(instant: Column) -> Column:
    return F.date_format(F.date_trunc("hour", instant), "yyyy-MM-dd'T'HH:mm:ss")


def with_calendar(df: DataFrame, source: str, parts=("ano", "mes", "dia")) -> DataFrame:
    """Add the calendar parts the frame does not have yet."""
    missing = {name: PARTS[name](F.col(source)) for name in parts if name not in df.columns}
    return df.withColumns(missing) if missing else df


def latency_ms(event_time: Column, as_of: Column | None = None) -> Column:
    now = F.current_timestamp() if as_of is None else as_of
    return (F.unix_micros(now) - F.unix_micros(event_time)) / 1000.0


def season(month: Column) -> Column:
    return F.when(month.between(6, 9), k.SUMMER).otherwise(k.REST_OF_YEAR)


def month_label(month: Column) -> Column:
    return F.try_element_at(F.array(*map(F.lit, k.MONTH_LABELS)), month.cast("int"))


def day_period(flag: Column) -> Column:
    (day, day_label), (night, night_label) = k.DAY_PERIODS.items()
    return F.when(flag == day, day_label).when(flag == night, night_label)
