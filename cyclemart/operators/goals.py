"""Goals by day: the cycle valid on a day, per seller."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.config import SalesRules
from cyclemart.functions.calendar import cycle_days, month_start
from cyclemart.functions.predicates import all_of, in_period
from cyclemart.operators.levels import month_slice, place


def goals_by_day(
    goal_sellers: DataFrame, goal_cycles: DataFrame, sellers: DataFrame, rules: SalesRules,
    start: date | None = None, end: date | None = None, placed: bool = False,
) -> DataFrame:
    """Goal, commission rate and working days for each day and seller.

    Cycles are opened into days first, so "valid on the day" is an equality and no range join is
    planned. Where cycles overlap, the one that started last counts. Goals are hashed by seller
    while they are still one row per cycle: the days then open in parallel, and the grouping by day
    and seller needs no shuffle of day rows. ``placed`` hashes them by the months (``mes``) of their cycle and the seller's
    slice (``fatia``) instead, so that the days lie where those of ``placed_actuals`` do.
    """
    per_cycle = goal_days(goal_cycles, rules, start, end)
    if placed:
        at, keys = ["codmetavenda", "mes"], ["mes", "fatia", "data_ref", "codvend"]
        goals = placed_goals(goal_sellers, sellers, per_cycle).join(F.broadcast(per_cycle), at)
    else:
        at, keys = ["codmetavenda"], ["data_ref", "codvend"]
        spread = int(goal_sellers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        goals = _known(goal_sellers, sellers).repartition(spread, "codvend").join(per_cycle.drop("mes"), at)
    latest = ("meta_mensal", "perc_comissao", "dias_uteis", "dia_util")
    return goals.groupBy(*keys).agg(*[F.max_by(c, "prioridade").alias(c) for c in latest])


def goal_days(goal_cycles: DataFrame, rules: SalesRules, start: date | None = None, end: date | None = None,
              wanted: DataFrame | None = None) -> DataFrame:
    """Days of each cycle with their month (``mes``) and the cycle's priority: a small table, cut to a period and, with
    ``wanted``, to some days (``data_ref``)."""
    days = cycle_days(goal_cycles, rules.holidays).filter(all_of(in_period(F.col("data_ref"), start, end)))
    if wanted is not None:
        days = days.join(wanted, "data_ref", "left_semi")
    priority = F.shiftleft(F.unix_date("dtinic").cast("bigint"), 32) + F.col("codmetavenda").cast("bigint")
    return days.select("codmetavenda", "data_ref", "dias_uteis", "dia_util", priority.alias("prioridade"),
                       month_start(F.col("data_ref")).alias("mes"))


def _known(goal_sellers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Goals of sellers that master data has, a row per seller and cycle."""
    return goal_sellers.join(sellers.select("codvend"), "codvend", "left_semi").select(
        "codmetavenda", F.col("codvend").cast("bigint").alias("codvend"),
        F.col("vlrmetavendedor").cast("decimal(15,2)").alias("meta_mensal"),
        F.col("perccomissao").cast("decimal(5,2)").alias("perc_comissao"))


def placed_goals(goal_sellers: DataFrame, sellers: DataFrame, days: DataFrame) -> DataFrame:
    """Goals, not yet opened into days, once per month (``mes``) that holds some of ``goal_days``, placed by month and slice
    of sellers (``fatia``)."""
    goals = _known(goal_sellers, sellers)
    months = goals.join(days.select("codmetavenda", "mes").distinct(), "codmetavenda")
    return place(months.withColumn("fatia", month_slice(goals.sparkSession, F.col("codvend"))), "mes")


def daily_goal(monthly: Column, working_days: Column, is_working_day: Column) -> Column:
    share = monthly.cast("double") / F.greatest(working_days, F.lit(1))
    return F.when(is_working_day & (monthly > 0), share).otherwise(F.lit(0.0))
