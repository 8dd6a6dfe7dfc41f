"""Daily totals that increments can be added to, distinct documents included.

Sums add up by themselves. Documents are kept as bits: number ``n`` is bit ``n mod 64`` of word ``n div 64``. Words of the same
number are merged by OR, so a document counts once however many increments bring lines of it, and the number of documents is
the number of bits. A word takes one row, so a few documents take a few rows and consecutive numbers share one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.functions.calendar import month_start
from cyclemart.operators.daily import DAY_KEYS, cost_gap, net_sale, net_value
from cyclemart.operators.levels import month_slice, place
from cyclemart.sources.documents import CANCEL, RETURN, SALE

SUMS = ("vlr_nota", "vlr_desconto", "vlr_devolucao", "vlr_cancelada")
PARTIAL_KEYS = (*DAY_KEYS, "palavra")


def partial_actuals(movements: DataFrame) -> DataFrame:
    """Totals of some movements by day, company, seller and word of document numbers."""
    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("tipo_mov") == kind, value)

    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("nunota", F.lit(64)).cast("int"))
    return movements.withColumn("palavra", F.shiftright(F.col("nunota").cast("bigint"), 6)).groupBy(*PARTIAL_KEYS).agg(
        F.sum(of(SALE, net_sale())).alias("vlr_nota"), F.sum(of(SALE, cost_gap())).alias("vlr_desconto"),
        F.sum(of(RETURN, net_value())).alias("vlr_devolucao"), F.sum(of(CANCEL, net_value())).alias("vlr_cancelada"),
        F.bit_or(F.coalesce(of(SALE, bit), F.lit(0).cast("bigint"))).alias("documentos"))


def merge_partials(*parts: DataFrame, placed: bool = False) -> DataFrame:
    """Partials of several increments as one: what ``partial_actuals`` gives for all their movements. ``placed`` moves them by
    month (``mes``) and the seller's slice of it (``fatia``)."""
    rows, at = reduce(DataFrame.unionByName, parts), ()
    if placed:
        at = ("mes", "fatia")
        rows = place(rows.withColumns({
            "mes": month_start(F.col("data_ref")), "fatia": month_slice(rows.sparkSession, F.col("codvend").cast("bigint"))}), "mes")
    return rows.groupBy(*at, *PARTIAL_KEYS).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.bit_or("documentos").alias("documentos"))


def actuals_of(partials: DataFrame) -> DataFrame:
    """Daily totals as ``daily_actuals`` gives them, from merged partials, which stay where they are placed."""
    at = [c for c in ("mes", "fatia") if c in partials.columns]
    return partials.groupBy(*at, *DAY_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS], F.sum(F.bit_count("documentos")).alias("qtd_transacoes"))
