"""Date keys, date parts, lenient timestamp parsing, calendars."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ORDER_DATE_FORMAT = "M/d/yyyy H:mm"  # fixed value: raw order date format


def parse_order_date(column: Column) -> Column:
    """Null, never an error, on text that is not a date."""
    return F.try_to_timestamp(column, F.lit(ORDER_DATE_FORMAT))


def parse_iso_timestamp(column: Column) -> Column:
    return F.try_to_timestamp(column)


def date_key(column: Column) -> Column:
    return F.date_format(column, "yyyyMMdd").cast("int")


def month_of_key(key: Column) -> Column:
    """``yyyyMM`` text from a ``yyyyMMdd`` integer."""
    return F.substring(key.cast("string"), 1, 6)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def monday_based_weekday(column: Column) -> Column:
    return F.weekday(column)


def weekday_number(day_name: Column) -> Column:
    """Monday = 0 ... Sunday = 6 from an English day name in any case; anything else is null."""
    names = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.lower(day_name))
    return F.when(position > 0, (position - 1).cast("int"))


def calendar_days(first: Column, last: Column) -> Column:
    """Every day from the month start one month before ``first`` to one month after ``last``."""
    return F.sequence(
        F.trunc(F.add_months(first, -1), "MM"), F.add_months(last, 1), F.expr("INTERVAL 1 DAY")
    )


def date_parts(full_date: Column) -> list[Column]:
    """The date dimension's columns, in contract order."""
    return [
        date_key(full_date).alias("date_key"),
        full_date.alias("full_date"),
        F.dayofmonth(full_date).alias("day"),
        F.month(full_date).alias("month"),
        F.quarter(full_date).alias("quarter"),
        F.year(full_date).alias("year"),
        F.date_format(full_date, "EEEE").alias("day_of_week"),
        (F.weekday(full_date) >= 5).alias("is_weekend"),
    ]
