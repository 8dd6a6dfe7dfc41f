"""Report texts as columns: Brazilian money, percentages, subtitles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def _plain(value: Column, decimals: int) -> Column:
    """Decimal comma, no thousands mark."""
    return F.translate(F.format_number(value, decimals), ".,", ",")


def brl(value: Column) -> Column:
    """``R$ 1.234,56``; null is ``R$ 0,00``."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(_number(value), 2), ",.", ".,"))


def brl_compact(value: Column) -> Column:
    """``R$ 2,50M``, ``R$ 1,5K``, below a thousand as ``brl``."""
    v = _number(value)
    return (
        F.when(F.abs(v) >= 1e6, F.concat(F.lit("R$ "), _plain(v / 1e6, 2), F.lit("M")))
        .when(F.abs(v) >= 1e3, F.concat(F.lit("R$ "), _plain(v / 1e3, 1), F.lit("K")))
        .otherwise(brl(v))
    )


def percent(value: Column, decimals: int = 1) -> Column:
    """``95,7%``."""
    return F.concat(_plain(_number(value), decimals), F.lit("%"))


def ticket_count(value: Column) -> Column:
    """``1.234 transações``."""
    return F.concat(F.translate(F.format_number(value, 0), ",", "."), F.lit(" transações"))


def subtitle(reference: Column, complement: Column) -> Column:
    """``REF: x | COMP: y``, leaving out blank parts."""
    def part(mark: str, value: Column) -> Column:
        return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(mark), value))

    return F.concat_ws(" | ", part("REF: ", reference), part("COMP: ", complement))


def clean(value: Column) -> Column:
    """Trimmed text, null as the empty string."""
    return F.trim(F.coalesce(value, F.lit("")))


def match_name(value: Column) -> Column:
    return F.upper(F.trim(value))
