"""Daily totals by day, company and seller, from document lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.functions.calendar import month_start
from cyclemart.operators.levels import month_slice, place
from cyclemart.sources.documents import CANCEL, RETURN, SALE

DAY_KEYS = ("data_ref", "codemp", "codvend")
MEASURES = ("vlr_nota", "vlr_desconto", "qtd_transacoes", "vlr_devolucao", "vlr_cancelada")


def net_sale() -> Column:
    """Sale value with the discount rounded to cents."""
    return F.col("vlrtot") - F.round("vlrdesc", 2)


def net_value() -> Column:
    return F.col("vlrtot") - F.col("vlrdesc")


def cost_gap() -> Column:
    """The measure stored as discount: cost of the goods less what they sold for, so it is negative
    on a profitable sale."""
    return F.round("vlrcus", 2) * F.col("qtdneg") - net_sale()


def daily_sales(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*DAY_KEYS).agg(
        F.sum(net_sale()).alias("vlr_nota"),
        F.sum(cost_gap()).alias("vlr_desconto"),
        F.countDistinct("nunota").alias("qtd_transacoes"),
    )


def daily_returns(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*DAY_KEYS).agg(F.sum(net_value()).alias("vlr_devolucao"))


def daily_cancels(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*DAY_KEYS).agg(F.sum(net_value()).alias("vlr_cancelada"))


def daily_actuals(movements: DataFrame) -> DataFrame:
    """All three totals in one pass over the movements.

    Lines are added up per document first and tickets counted as documents with a sale. The item
    join leaves lines partitioned by document, so that step shuffles nothing, and the step to days
    combines before its shuffle.
    """
    return _document_totals(movements).groupBy(*DAY_KEYS).agg(*[F.sum(c).alias(c) for c in MEASURES])


def placed_actuals(movements: DataFrame) -> DataFrame:
    """``daily_actuals`` with the rows partitioned by month (``mes``) and the seller's slice of it (``fatia``), which is their
    only shuffle after the item join."""
    documents = _document_totals(movements).withColumns({
        "mes": month_start(F.col("data_ref")), "fatia": month_slice(movements.sparkSession, F.col("codvend").cast("bigint"))})
    return place(documents, "mes").groupBy("mes", "fatia", *DAY_KEYS).agg(*[F.sum(c).alias(c) for c in MEASURES])


def _document_totals(movements: DataFrame) -> DataFrame:
    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("tipo_mov") == kind, value)

    return movements.groupBy("nunota", *DAY_KEYS).agg(
        F.sum(of(SALE, net_sale())).alias("vlr_nota"),
        F.sum(of(SALE, cost_gap())).alias("vlr_desconto"),
        F.max(of(SALE, F.lit(1))).alias("qtd_transacoes"),
        F.sum(of(RETURN, net_value())).alias("vlr_devolucao"),
        F.sum(of(CANCEL, net_value())).alias("vlr_cancelada"),
    )
