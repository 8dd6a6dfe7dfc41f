"""Warehouse loads: the whole history, a range of days, or the daily run with its look-back."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cyclemart.operators import dimensions
from cyclemart.operators.constraints import rejects, watched
from cyclemart.operators.cube import cube_rows, refresh_cube
from cyclemart.operators.daily import daily_actuals, placed_actuals
from cyclemart.operators.fact import placed_fact, sales_fact
from cyclemart.operators.goals import goal_days, goals_by_day, placed_goals
from cyclemart.operators.profiles import brand_profiles, customer_profiles, purchase_days, ranked_items
from cyclemart.operators.rankings import BRAND, CUSTOMER, company_lists, item_totals, rankings, rankings_of_totals
from cyclemart.schemas import TABLES
from cyclemart.session import materialise
from cyclemart.sources.retail import RetailSource
from cyclemart.sources.warehouse import Warehouse, shape
from cyclemart.streaming.late import forget_range

Range = tuple[date, date] | None
#: Lines that kept their days from being loaded, by the range of the load: a load done again replaces its own.
REJECTS = "_rejeitados"


def build_fact(source: RetailSource, period: Range = None, movements: DataFrame | None = None) -> DataFrame:
    """The fact of a period, from all movements of it or from the given ones."""
    start, end = period or (None, None)
    goals = goals_by_day(source.goal_sellers(), source.goal_cycles(), source.sellers(), source.rules, start, end)
    return sales_fact(daily_actuals(source.movements(period) if movements is None else movements), goals)


def build_stored_fact(source: RetailSource, movements: DataFrame | None = None) -> DataFrame:
    """The whole fact, placed by month and slice for its table."""
    days = goal_days(source.goal_cycles(), source.rules)
    goals = placed_goals(source.goal_sellers(), source.sellers(), days)
    return placed_fact(placed_actuals(source.movements() if movements is None else movements), goals, days)


def build_rankings(source: RetailSource, period: Range = None, **only) -> DataFrame:
    return rankings(source.sales(period), source.partners(), source.products(), source.rules, **only)


def build_totals(source: RetailSource, period: Range = None) -> DataFrame:
    """Sales by month, company, seller and ranked item, from which rankings and company lists are drawn."""
    return item_totals(source.sales(period), source.partners(), source.products())


def build_customer_profiles(source: RetailSource, ranked: DataFrame, period: Range = None,
                            as_of: date | None = None, **only) -> DataFrame:
    days = purchase_days(source.sales(period), source.sellers(), source.products(), ranked)
    return customer_profiles(days, ranked, source.products(), source.rules, as_of, **only)


def build_brand_profiles(source: RetailSource, ranked: DataFrame, period: Range = None, **only) -> DataFrame:
    return brand_profiles(source.sales(period), ranked, source.products(), source.rules, **only)


def dimension_rows(source: RetailSource) -> dict[str, DataFrame]:
    """Cycles first, then the five dimensions."""
    return {
        "dim_tempo_ref": dimensions.cycle_rows(source.goal_cycles()),
        "dim_vendedor": dimensions.seller_rows(source.sellers()),
        "dim_empresa": dimensions.company_rows(source.companies()),
        "dim_parceiro": dimensions.partner_rows(source.partners()),
        "dim_marca": dimensions.brand_rows(source.products()),
        "dim_produto": dimensions.product_rows(source.products()),
    }


def sync_dimensions(warehouse: Warehouse, source: RetailSource) -> None:
    for name, rows in dimension_rows(source).items():
        warehouse.upsert(name, rows)


def load_rankings_and_profiles(warehouse: Warehouse, source: RetailSource, start: date, end: date) -> None:
    """Rankings and profiles of every month the range touches, computed up to its last day. Where the warehouse holds later
    days of the last month, up to the last of these: lists of a whole month are not cut to a part of it."""
    first = start.replace(day=1)
    next_month = (end.replace(day=1) + timedelta(days=32)).replace(day=1)
    later = warehouse.fact(end, next_month - timedelta(days=1)).filter("id_empresa > 0").agg(F.max("id_tempo")).first()[0]
    end = max(end, later or end)
    months: list[date] = []
    month = first
    while month <= end:
        months.append(month)
        month = (month + timedelta(days=32)).replace(day=1)
    in_months = F.col("dtref").between(F.lit(first), F.lit(end))

    totals = materialise(build_totals(source, (first, end)), "item-totals")
    warehouse.replace_months("fato_rankings", rankings_of_totals(totals, source.rules), months)
    warehouse.replace_months("listas_empresa", company_lists(totals, source.rules), months)
    stored = warehouse.read("fato_rankings").filter(in_months)
    window_start = first - timedelta(days=source.rules.profile_days)
    profiles = build_customer_profiles(source, ranked_items(stored, CUSTOMER), (window_start, end), as_of=end)
    warehouse.upsert("fato_cliente_perfil", profiles.filter(in_months))
    warehouse.upsert("fato_marca_perfil", build_brand_profiles(source, ranked_items(stored, BRAND), (first, end)))


@dataclass(frozen=True)
class LoadResult:
    """State of each day, and the lines that kept days from being loaded."""

    days: DataFrame
    rejected: DataFrame | None = None

    @property
    def summary(self) -> DataFrame:
        return self.days.groupBy("situacao").agg(F.count(F.lit(1)).alias("dias"))


def load_range(warehouse: Warehouse, source: RetailSource, start: date, end: date, *, replace_days: bool = False,
               with_rankings: bool = True, rules: dict[str, Column] | None = None) -> LoadResult:
    """Recompute [start, end] in one pass and merge it into the warehouse.

    By key as a rule: rows of known keys are replaced, vanished keys stay. ``replace_days`` swaps
    whole days instead. Days without any row are reported and write nothing.

    ``rules`` are what document lines must keep, see ``constraints.line_rules``. Broken ones are counted while the
    fact is computed. Only if there are any are their lines looked for: they go to the table ``_rejeitados``, their days are
    reported as failed and keep what the warehouse holds of them, and the other days are loaded.
    """
    spark = warehouse.spark
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("id_tempo"))
    seen, lines = Observation(), source.movements((start, end))
    built = build_fact(source, (start, end), watched(lines, rules, seen) if rules else lines)
    rows, refused = materialise(shape(built, TABLES["fato_vendasdiarias"]), "fact-range"), None
    if rules and not seen.get["rejeitadas"]:
        warehouse.remove(f"{warehouse.path(REJECTS)}/inicio={start}/fim={end}")
    elif rules:
        refused = materialise(rejects(lines, rules), "rejects")
        refused.withColumns({"inicio": F.lit(start), "fim": F.lit(end)}).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("inicio", "fim").parquet(warehouse.path(REJECTS))
        failed = refused.select("id_tempo").distinct()
        rows = materialise(rows.join(failed, "id_tempo", "left_anti").select(*rows.columns), "fact-range")
    if replace_days:
        warehouse.replace_days(rows, days, staged=True)
    else:
        warehouse.upsert("fato_vendasdiarias", rows, staged=True)
    warehouse.insert_missing("dim_tempo", dimensions.time_rows(rows))
    refresh_cube(warehouse, start, end)
    forget_range(warehouse, start, end, None if refused is None else failed)
    if with_rankings:
        load_rankings_and_profiles(warehouse, source, start, end)
    counts = rows.groupBy("id_tempo").agg(F.count(F.lit(1)).alias("linhas"))
    status = days.join(counts, "id_tempo", "left").select(
        "id_tempo",
        F.coalesce("linhas", F.lit(0)).alias("linhas"),
        F.when(F.col("linhas").isNull(), "sem movimento").otherwise("carregado").alias("situacao"),
    )
    if refused is not None:
        lost = failed.select("id_tempo", F.lit("falhou").alias("_falhou"))
        status = status.join(lost, "id_tempo", "left").withColumn("situacao", F.coalesce("_falhou", "situacao")).drop("_falhou")
    return LoadResult(status, refused)


def daily_run(warehouse: Warehouse, source: RetailSource, target: date, *, reprocess: bool = True) -> LoadResult:
    """The scheduled run. With ``reprocess`` it covers the look-back, for late entries, and the
    look-ahead, for goals already set."""
    rules = source.rules
    start = target - timedelta(days=rules.lookback_days) if reprocess else target
    end = target + timedelta(days=rules.lookahead_days) if reprocess else target
    sync_dimensions(warehouse, source)
    return load_range(warehouse, source, start, end)


def full_load(warehouse: Warehouse, source: RetailSource, tables: Sequence[str]) -> None:
    """Whole-history load of the named tables, in dependency order."""
    if "dim_tempo_ref" in tables:
        warehouse.load("dim_tempo_ref", dimensions.cycle_rows(source.goal_cycles()))
    if "fato_vendasdiarias" in tables:
        warehouse.load("fato_vendasdiarias", build_stored_fact(source), placed=True)
    if "cubo_kpi" in tables:
        warehouse.load("cubo_kpi", cube_rows(warehouse.fact(), warehouse.read("dim_tempo_ref")))
    if "fato_rankings" in tables:
        warehouse.load("fato_rankings", build_rankings(source), placed=True)
    if "listas_empresa" in tables:
        warehouse.load("listas_empresa", company_lists(build_totals(source), source.rules))
    if "fato_cliente_perfil" in tables:
        ranked = ranked_items(warehouse.read("fato_rankings"), CUSTOMER)
        warehouse.load("fato_cliente_perfil", build_customer_profiles(source, ranked), placed=True)
    if "fato_marca_perfil" in tables:
        ranked = ranked_items(warehouse.read("fato_rankings"), BRAND)
        warehouse.load("fato_marca_perfil", build_brand_profiles(source, ranked), placed=True)
