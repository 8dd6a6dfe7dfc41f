"""Report queries over sale rows: averages, goal performance, cancellation rates, shares, growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.functions.calendar import month_start
from cyclemart.operators.daily import net_value
from cyclemart.sources.documents import CANCEL, SALE

CENTS = "decimal(18,2)"


def sale_rows(movements: DataFrame) -> DataFrame:
    """One row per document line with its month, final amount and status."""
    status = F.when(F.col("tipo_mov") == SALE, F.lit("Completed")).when(F.col("tipo_mov") == CANCEL, F.lit("Cancelled"))
    return movements.select(
        month_start(F.col("data_ref")).alias("mes"), F.col("codvend").alias("id_vendedor"),
        F.col("codemp").alias("id_empresa"), "qtdneg", net_value().alias("final_amount"),
        F.coalesce(status, F.lit("Returned")).alias("sale_status"),
    )


def _mean(value: Column, count: Column) -> Column:
    return F.round(value.cast("decimal(22,4)") / count.cast("decimal(12,0)"), 2).cast(CENTS)


def row_average(rows: DataFrame) -> DataFrame:
    """Average amount per completed row (the KPI page averages per ticket instead)."""
    return rows.filter("sale_status = 'Completed'").groupBy("mes").agg(
        _mean(F.sum("final_amount"), F.count(F.lit(1))).alias("ticket_medio")
    )


def sales_by_seller(rows: DataFrame, sellers: DataFrame) -> DataFrame:
    totals = rows.filter("sale_status = 'Completed'").groupBy("mes", "id_vendedor").agg(
        F.count(F.lit(1)).alias("qtd_vendas"),
        F.sum("final_amount").alias("total_vendas"),
    )
    return totals.join(sellers.select("id_vendedor", "nome_comercial"), "id_vendedor").select(
        "mes", "id_vendedor", F.col("nome_comercial").alias("name"), "qtd_vendas", "total_vendas",
        _mean(F.col("total_vendas"), F.col("qtd_vendas")).alias("ticket_medio"),
    )


def performance_vs_goal(rows: DataFrame, goals: DataFrame, sellers: DataFrame) -> DataFrame:
    """Amount sold against each seller's goal of the month; sellers without sales count with 0."""
    sold = rows.filter("sale_status = 'Completed'").groupBy("mes", "id_vendedor").agg(
        F.sum("final_amount").alias("vendido")
    )
    return (
        goals.select("mes", "id_vendedor", "meta")
        .join(sellers.select("id_vendedor", F.col("nome_comercial").alias("name")), "id_vendedor")
        .join(sold, ["mes", "id_vendedor"], "left")
        .withColumn("vendido", F.coalesce("vendido", F.lit(0)))
        .withColumn("percentual_meta", F.when(F.col("meta") != 0, F.round(
            F.col("vendido").cast("decimal(22,4)") * 100 / F.col("meta").cast("decimal(15,2)"), 2)).cast(CENTS))
    )


def cancel_rate(rows: DataFrame, sellers: DataFrame) -> DataFrame:
    counts = rows.groupBy("mes", "id_vendedor").agg(
        F.count_if(F.col("sale_status") == "Cancelled").alias("qtd_canceladas"), F.count(F.lit(1)).alias("qtd_total")
    )
    return counts.join(sellers.select("id_vendedor", F.col("nome_comercial").alias("name")), "id_vendedor").withColumn(
        "taxa_cancelamento", _mean(F.col("qtd_canceladas") * 100, F.col("qtd_total"))
    )


def current_month(rows: DataFrame, sellers: DataFrame, month: Column) -> DataFrame:
    """Row count and total by seller for one month, whatever the status."""
    totals = rows.filter(F.col("mes") == month).groupBy("mes", "id_vendedor").agg(
        F.count(F.lit(1)).alias("qtd_vendas"), F.sum("final_amount").alias("total")
    )
    return totals.join(sellers.select("id_vendedor", F.col("nome_comercial").alias("name")), "id_vendedor")


def conversion_rate(events: DataFrame, lead: str, sale: str) -> DataFrame:
    """Sales per lead for each user."""
    counts = events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == lead).alias("leads"), F.count_if(F.col("event_type") == sale).alias("vendas")
    )
    rate = F.try_divide(F.col("vendas").cast("double"), F.col("leads").cast("double"))
    return counts.withColumn("conversao", F.coalesce(rate, F.lit(0.0)))


def share_of_all(totals: DataFrame, value: str) -> DataFrame:
    """Each row's percentage of the sum over all rows, which is one number and no group."""
    whole = totals.agg(F.sum(value).cast("double").alias("t")).scalar()
    return totals.withColumn("percentual", F.when(whole != 0, F.col(value).cast("double") / whole * 100).otherwise(0.0))


def share_of_total(totals: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Each row's percentage of its group's total."""
    whole = F.sum(value).over(Window.partitionBy(*by)).cast("double")
    return totals.withColumn("percentual", F.when(whole != 0, F.col(value).cast("double") / whole * 100).otherwise(0.0))


def period_matrix(rows: DataFrame, quarters: Sequence[int] = (1, 2, 3, 4)) -> DataFrame:
    """Sellers and years down, quarters across."""
    done = rows.filter("sale_status = 'Completed'").select(
        "id_vendedor", F.year("mes").alias("ano"), F.quarter("mes").alias("trimestre"), "final_amount"
    )
    pivoted = done.groupBy("id_vendedor", "ano").pivot("trimestre", list(quarters)).agg(F.sum("final_amount"))
    return pivoted.select(
        "id_vendedor", "ano", *[F.coalesce(F.col(f"`{q}`"), F.lit(0)).alias(f"t{q}") for q in quarters]
    )


def by_grain(fact: DataFrame, grain: str) -> DataFrame:
    """Realised value by day, month or quarter."""
    if grain not in ("day", "month", "quarter"):
        raise ValueError(f"unknown grain: {grain}")
    day = F.col("id_tempo")
    start = day if grain == "day" else F.trunc(day, grain)
    return fact.filter("id_empresa > 0").groupBy(start.alias("periodo")).agg(
        F.sum("valor_realizado").alias("realizado")
    ).withColumn("grao", F.lit(grain))


def growth(totals: DataFrame, keys: Sequence[str], period: str, value: str, follows: DataFrame | None = None) -> DataFrame:
    """Change against the previous period, as a percentage and a direction. ``follows`` names the period before each
    in ``anterior``; a period before without rows counts as 0. Without it the last period with rows is compared."""
    now = F.col(value).cast("double")
    if follows is None:
        with_before = totals.withColumn("anterior", F.lag(value).over(Window.partitionBy(*keys).orderBy(period)))
    else:
        past = totals.select(*keys, F.col(period).alias("_antes"), F.col(value).alias("_valor"))
        dated = totals.join(follows.select(period, F.col("anterior").alias("_antes")), period, "left")
        with_before = dated.join(past, [*keys, "_antes"], "left").select(
            *totals.columns, F.when(F.col("_antes").isNotNull(), F.coalesce("_valor", F.lit(0))).alias("anterior"))
    past = F.col("anterior").cast("double")
    return with_before.withColumns({
        "variacao": F.when(past != 0, (now - past) / past * 100),
        "tendencia": F.when(past.isNull(), F.lit(None)).when(now > past, "alta").when(now < past, "queda").otherwise("estável"),
    })
