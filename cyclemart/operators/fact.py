"""The daily sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.functions.calendar import year_month
from cyclemart.operators.daily import DAY_KEYS, MEASURES
from cyclemart.operators.goals import daily_goal
from cyclemart.schemas import TABLES

GOAL_COMPANY = 0
#: Where placed rows lie, see ``placed_actuals``.
PLACE = ("mes", "fatia")
MONEY = "decimal(15,2)"


def combine_actuals(sales: DataFrame, returns: DataFrame, cancels: DataFrame) -> DataFrame:
    """Separately built totals as one frame per key; needed where the three have separate sources."""
    parts = [
        part.select(*DAY_KEYS, *[F.col(c) if c in part.columns else F.lit(None).alias(c) for c in MEASURES])
        for part in (sales, returns, cancels)
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.groupBy(*DAY_KEYS).agg(*[F.sum(c).alias(c) for c in MEASURES])


def net_realised() -> Column:
    """Sales less returns, never below zero."""
    sold, returned = (F.coalesce(F.col(c), F.lit(0)) for c in ("vlr_nota", "vlr_devolucao"))
    return F.greatest(sold - returned, F.lit(0))


def commission(net: Column, percent: Column) -> Column:
    """``net · percent / 100`` without a decimal division."""
    return (
        net.cast("decimal(18,4)") * percent.cast("decimal(5,2)") * F.lit("0.01").cast("decimal(3,2)")
    ).cast(MONEY)


def actual_rows(actuals: DataFrame) -> DataFrame:
    def money(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).cast(MONEY)

    return actuals.select(
        *[c for c in PLACE if c in actuals.columns],
        *DAY_KEYS,
        net_realised().cast("decimal(18,4)").alias("liquido"),
        money("vlr_devolucao").alias("valor_devolucao"),
        money("vlr_cancelada").alias("valor_cancelado"),
        money("vlr_desconto").alias("valor_desconto"),
        F.coalesce("qtd_transacoes", F.lit(0)).cast("bigint").alias("qtd_transacoes"),
    )


def goal_rows(goals: DataFrame) -> DataFrame:
    per_day = daily_goal(F.col("meta_mensal"), F.col("dias_uteis"), F.col("dia_util"))
    return goals.select(
        *[c for c in PLACE if c in goals.columns], "data_ref", F.lit(GOAL_COMPANY).cast("bigint").alias("codemp"), "codvend",
        F.col("meta_mensal").cast(MONEY).alias("valor_meta_mensal"), per_day.cast(MONEY).alias("valor_meta_diaria"),
        "perc_comissao",
    )


def sales_fact(actuals: DataFrame, goals: DataFrame) -> DataFrame:
    """Actual rows per company and goal rows at company 0, with goal, net value and commission.

    The inputs are stacked and grouped rather than left-joined to a seed of keys, so each is read
    once. The stack is hashed on (day, seller): the grouping by company below it and the spread of
    the seller's rate over all companies above it then need no shuffle of their own. A key has at
    most one actual and one goal row, so ``max`` merges them without widening the amounts. Where both inputs are placed by
    month and slice, the stack is so already and is not moved at all.
    """
    stacked = actual_rows(actuals).unionByName(goal_rows(goals), allowMissingColumns=True)
    place = [c for c in PLACE if c in stacked.columns]
    amounts = [c for c in stacked.columns if c not in (*place, *DAY_KEYS)]
    hashed = stacked if place else stacked.repartition("data_ref", "codvend")
    keyed = hashed.groupBy(*place, *DAY_KEYS).agg(*[F.max(c).alias(c) for c in amounts])
    seller_day = Window.partitionBy(*place, "data_ref", "codvend")
    return _fact_rows(keyed.withColumn("taxa", F.max("perc_comissao").over(seller_day)))


def placed_fact(actuals: DataFrame, goals: DataFrame, days: DataFrame) -> DataFrame:
    """What ``sales_fact`` gives, from ``placed_actuals``, ``placed_goals`` and ``goal_days``.

    Most rows of a fact are days with a goal and no movement. Here they are opened last and in place: actual rows find their
    rate among the goals of their seller and month, which are few, so only these are ordered, and the opened days are
    neither moved nor ordered. Where cycles overlap, the one that started last counts, among those the seller has a goal in.
    """
    stacked = actual_rows(actuals).unionByName(
        goals.select(*PLACE, "codvend", "codmetavenda", "meta_mensal", "perc_comissao"), allowMissingColumns=True)
    is_goal = F.col("codmetavenda").isNotNull()
    amounts = [c for c in stacked.columns if c not in (*PLACE, *DAY_KEYS, "codmetavenda", "meta_mensal", "perc_comissao")]
    own = F.collect_list(F.when(is_goal, F.struct("codmetavenda", "perc_comissao"))).over(Window.partitionBy(*PLACE, "codvend"))
    valid = days.groupBy("data_ref").agg(F.sort_array(F.collect_list(F.struct("prioridade", "codmetavenda")), False).alias("_ciclos"))
    opened = days.groupBy("codmetavenda", "mes").agg(F.collect_list(F.struct(
        F.col("data_ref").alias("_dia"), "dias_uteis", "dia_util", "prioridade")).alias("_dias"))
    found = F.flatten(F.transform("_ciclos", lambda c: F.filter("_metas", lambda m: m["codmetavenda"] == c["codmetavenda"])))
    rated = stacked.withColumn("_metas", own).join(F.broadcast(valid), "data_ref", "left").withColumn(
        "taxa", F.when(~is_goal, F.get(found, F.lit(0))["perc_comissao"])).drop("_metas", "_ciclos")
    # A row of actuals has no cycle and passes the opening as it is.
    each_day = rated.join(F.broadcast(opened), ["codmetavenda", "mes"], "left").select(
        *[c for c in rated.columns], F.inline_outer("_dias"))
    per_day = daily_goal(F.col("meta_mensal"), F.col("dias_uteis"), F.col("dia_util"))
    keyed = each_day.select(
        *PLACE, F.coalesce("_dia", "data_ref").alias("data_ref"),
        F.when(is_goal, F.lit(GOAL_COMPANY)).otherwise(F.col("codemp")).cast("bigint").alias("codemp"), "codvend", *amounts, "taxa", "prioridade",
        F.col("meta_mensal").cast(MONEY).alias("valor_meta_mensal"), F.when(is_goal, per_day).cast(MONEY).alias("valor_meta_diaria"),
    ).groupBy(*PLACE, *DAY_KEYS).agg(
        *[F.max(c).alias(c) for c in (*amounts, "taxa")],
        *[F.max_by(c, "prioridade").alias(c) for c in ("valor_meta_mensal", "valor_meta_diaria")])
    return _fact_rows(keyed)


def _fact_rows(rated: DataFrame) -> DataFrame:
    """Rows of the fact table from merged amounts and their rate (``taxa``)."""
    def filled(value: Column, name: str) -> Column:
        return F.coalesce(value, F.lit(0)).cast(TABLES["fato_vendasdiarias"].schema[name].dataType).alias(name)

    fact = rated.select(
        F.col("data_ref").alias("id_tempo"),
        F.col("codvend").cast("bigint").alias("id_vendedor"),
        F.col("codemp").cast("bigint").alias("id_empresa"),
        filled(F.col("liquido"), "valor_realizado"),
        filled(commission(F.col("liquido"), F.col("taxa")), "valor_comissao"),
        *[filled(F.col(c), c) for c in ("valor_meta_diaria", "valor_meta_mensal", "valor_devolucao", "valor_cancelado",
                                        "valor_desconto", "qtd_transacoes")],
        year_month(F.col("data_ref")).alias("ano_mes"),
    )
    return fact.select(*TABLES["fato_vendasdiarias"].schema.names)
