"""Optional filters. Each returns a Column, so Catalyst pushes it to the scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

Company = int | Sequence[int] | None


def all_of(*conditions: Column | None) -> Column:
    return reduce(and_, [c for c in conditions if c is not None], F.lit(True))


def in_period(day: Column, start: date | None, end: date | None) -> Column | None:
    """Applies only when both bounds are given."""
    return day.between(F.lit(start), F.lit(end)) if start and end else None


def for_sellers(seller: Column, seller_ids: Sequence[int] | None) -> Column | None:
    """An empty list means no filter."""
    return seller.isin(*seller_ids) if seller_ids else None


def for_company(company_col: Column, company: Company) -> Column:
    """None: any real company; a number: that one; a list: any of them; an empty list: nothing."""
    if company is None:
        return company_col > 0
    if isinstance(company, int):
        return company_col == company
    return company_col.isin(*company) if company else F.lit(False)


def any_movement() -> Column:
    return (F.col("valor_realizado") != 0) | (F.col("valor_devolucao") != 0) | (F.col("valor_meta_diaria") != 0)
