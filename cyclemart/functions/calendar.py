"""Fiscal-cycle calendar: working days, cycle days, labels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.config import MONTH_NAMES


def is_working_day(day: Column, holidays: Sequence[date]) -> Column:
    """Monday to Saturday and not a holiday."""
    open_day = F.weekday(day) < 6
    return open_day & ~day.isin(*holidays) if holidays else open_day


def working_days(start: Column, end: Column, holidays: Sequence[date]) -> Column:
    """Number of working days in [start, end], by arithmetic instead of listing the days.

    Sundays up to a day n (days since 1970-01-01, a Thursday) are ``floor((n + 4) / 7)``.
    """
    def sundays_until(day: Column) -> Column:
        return F.floor((F.unix_date(day) + F.lit(4)) / F.lit(7))

    total = F.datediff(end, start) + F.lit(1)
    sundays = sundays_until(end) - sundays_until(F.date_sub(start, 1))
    closed = [F.when(F.lit(h).between(start, end), 1).otherwise(0) for h in holidays if h.weekday() < 6]
    off = reduce(lambda a, b: a + b, closed, F.lit(0))
    return F.greatest(total - sundays - off, F.lit(0)).cast("int")


def cycle_days(cycles: DataFrame, holidays: Sequence[date]) -> DataFrame:
    """Each cycle opened into its days. Turns "day between start and end" into an equality."""
    return (
        cycles.withColumn("dias_uteis", working_days(F.col("dtinic"), F.col("dtfin"), holidays))
        .withColumn("data_ref", F.explode(F.sequence("dtinic", "dtfin")))
        .withColumn("dia_util", is_working_day(F.col("data_ref"), holidays))
    )


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def cycle_label(dtref: Column) -> Column:
    """``Março / 2026``."""
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return F.concat_ws(" / ", F.element_at(names, F.month(dtref)), F.year(dtref).cast("string"))
