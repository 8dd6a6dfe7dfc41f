"""KPIs over the daily fact, for one period or for every fiscal cycle at once.

``scope_period`` / ``scope_cycles`` tag fact rows with the ``dtref`` they count for; everything else
groups by it. Actuals filter by company, goals are those of the same sellers at company 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.config import SalesRules
from cyclemart.functions import text
from cyclemart.functions.calendar import cycle_days, is_working_day, working_days, year_month
from cyclemart.functions.predicates import Company, all_of, any_movement, for_company, for_sellers, in_period
from cyclemart.operators.fact import GOAL_COMPANY

RATE = "decimal(18,10)"


def scope_period(fact: DataFrame, start: date | None, end: date | None, dtref: date | None = None) -> DataFrame:
    """Rows of a period; on the stored fact the months outside it are not read. One bound alone is no filter."""
    both = (start, end) if start and end else (None, None)
    return fact.filter(all_of(in_period(F.col("id_tempo"), start, end)) & _months(fact, *both)).withColumn(
        "dtref", F.lit(dtref or start).cast("date")
    )


def _months(fact: DataFrame, start: date | None, end: date | None) -> Column:
    """Bound on the month partition of the fact, where it has one."""
    bound = F.lit(True)
    if "ano_mes" in fact.columns:
        if start is not None:
            bound = bound & (F.col("ano_mes") >= f"{start:%Y-%m}")
        if end is not None:
            bound = bound & (F.col("ano_mes") <= f"{end:%Y-%m}")
    return bound


def scope_cycles(fact: DataFrame, cycles: DataFrame) -> DataFrame:
    """Each row once for every cycle that holds its day. On the stored fact the days carry their month, so that
    chosen cycles prune the months to read while the query runs."""
    days = cycles.select("dtref", F.explode(F.sequence("dtinic", "dtfin")).alias("id_tempo"))
    if "ano_mes" not in fact.columns:
        return fact.join(days, "id_tempo")
    return fact.join(days.withColumn("ano_mes", year_month(F.col("id_tempo"))), ["ano_mes", "id_tempo"])


def _actual(company: Company) -> Column:
    return for_company(F.col("id_empresa"), company)


def _is_goal() -> Column:
    return F.col("id_empresa") == GOAL_COMPANY


def active_sellers(scoped: DataFrame, sellers: DataFrame, company: Company = None) -> DataFrame:
    """Sellers with any movement. Here no company means every row, goal rows included."""
    found = scoped.filter(any_movement())
    if company is not None:
        found = found.filter(_actual(company))
    return found.select("dtref", "id_vendedor").distinct().join(
        sellers.select("id_vendedor", "nome_comercial"), "id_vendedor"
    )


def eligible(scoped: DataFrame, sellers: DataFrame, company: Company = None,
             seller_ids: Sequence[int] | None = None, moved: Column | None = None) -> DataFrame:
    """Rows of the sellers a request is about: the given ones, else those active in the company.

    Activity is found by a window over (cycle, seller) instead of a second pass over the fact joined
    back to the first; the grouping by cycle and seller above it shuffles no more. ``moved`` says what an active
    row is where rows are not those of the fact.
    """
    chosen = all_of(for_sellers(F.col("id_vendedor"), seller_ids))
    rows = scoped.filter(chosen & (_is_goal() | _actual(company)))
    if company is None or seller_ids:
        return rows
    seller = Window.partitionBy("dtref", "id_vendedor")
    active = any_movement() if moved is None else moved
    found = F.max(F.when(active & _actual(company), 1).otherwise(0)).over(seller)
    return rows.withColumn("_ativo", found).filter("_ativo = 1").drop("_ativo").join(
        sellers.select("id_vendedor"), "id_vendedor", "left_semi"
    )


def daily_performance(rows: DataFrame, company: Company = None) -> DataFrame:
    """Realised value and goal by day, in one conditional pass."""
    return rows.groupBy("dtref", F.col("id_tempo").alias("date")).agg(
        F.coalesce(F.sum(F.when(_actual(company), F.col("valor_realizado"))), F.lit(0)).alias("realized"),
        F.coalesce(F.sum(F.when(_is_goal(), F.col("valor_meta_diaria"))), F.lit(0)).alias("meta"),
    )


def latest_rates(fact: DataFrame, rules: SalesRules) -> DataFrame:
    """Each seller's commission rate on the last day with commission since the floor date, over any
    company and whatever period is asked for. On one day the lowest company id counts."""
    valid = fact.filter(
        _months(fact, rules.rate_floor, None) & (F.col("id_tempo") >= F.lit(rules.rate_floor)) & (F.col("valor_comissao") > 0) & (F.col("valor_realizado") > 0)
    )
    last = Window.partitionBy("id_vendedor").orderBy(F.desc("id_tempo"), F.asc("id_empresa"))
    rate = F.col("valor_comissao").cast("double") / F.col("valor_realizado").cast("double")
    return valid.withColumn("_r", F.row_number().over(last)).filter("_r = 1").select(
        "id_vendedor", "id_tempo", "id_empresa", rate.cast(RATE).alias("taxa")
    )


def seller_totals(rows: DataFrame, company: Company = None, lines: Column | None = None) -> DataFrame:
    """Totals and goal per cycle and seller. ``linhas`` counts the actual rows, or adds up ``lines`` of them: 0 for a
    seller who only has a goal."""
    def total(column: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(_actual(company), F.col(column))), F.lit(0)).alias(name)

    return rows.groupBy("dtref", "id_vendedor").agg(
        total("valor_realizado", "v_realizado"),
        total("valor_devolucao", "v_devolucao"),
        total("valor_cancelado", "v_cancelado"),
        total("valor_desconto", "v_desconto"),
        total("qtd_transacoes", "v_tkts"),
        F.max(F.when(_is_goal(), F.col("valor_meta_mensal"))).alias("meta_vendedor"),
        F.coalesce(F.sum(F.when(_actual(company), F.lit(1) if lines is None else lines)), F.lit(0)).cast("bigint").alias("linhas"),
    )


def seller_stats(totals: DataFrame, rates: DataFrame) -> DataFrame:
    return totals.filter("linhas > 0").join(rates.select("id_vendedor", "taxa"), "id_vendedor", "left").select(
        "dtref", "id_vendedor", "v_realizado", "v_devolucao", "v_cancelado", "v_desconto", "v_tkts",
        F.col("taxa").alias("v_taxa"),
    )


def goal_total(totals: DataFrame) -> DataFrame:
    """Sum over sellers of their largest monthly goal in the cycle."""
    return totals.groupBy("dtref").agg(F.coalesce(F.sum("meta_vendedor"), F.lit(0)).alias("meta_total"))


def paid_commission(realised: Column, rate: Column, rules: SalesRules) -> Column:
    """Realised value times the seller's rate, the default rate for sellers without one."""
    return realised.cast("decimal(18,2)") * F.coalesce(rate, F.lit(rules.default_rate).cast(RATE))


def kpi_cards(totals: DataFrame, rates: DataFrame, rules: SalesRules) -> DataFrame:
    """Goal, realised, returned, cancelled, commission, discount, tickets and average ticket. The goal
    is summed from the same rows as the actuals, so the fact is grouped once."""
    rated = totals.join(rates.select("id_vendedor", "taxa"), "id_vendedor", "left")

    def added(column: str, name: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).alias(name)

    paid = paid_commission(F.col("v_realizado"), F.col("taxa"), rules)
    cards = rated.withColumn("_comissao", paid).groupBy("dtref").agg(
        added("meta_vendedor", "meta"),
        added("v_realizado", "realizado"),
        added("v_devolucao", "devolucao"),
        added("v_cancelado", "cancelado"),
        added("_comissao", "comissao"),
        added("v_desconto", "desconto"),
        added("v_tkts", "tkts"),
    )
    value, tickets = F.col("realizado").cast("double"), F.col("tkts")
    return cards.withColumns({
        "comissao": F.col("comissao").cast("decimal(24,2)"),
        "ticket_medio": F.when(tickets > 0, F.try_divide(value, tickets.cast("double"))).otherwise(F.lit(0.0)),
    })


def with_empty_cycles(cards: DataFrame, wanted: DataFrame) -> DataFrame:
    """A card for each ``dtref`` asked for: zeros where the request finds no rows."""
    filled = [F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name) for f in cards.schema if f.name != "dtref"]
    asked = wanted.select(F.col("dtref").alias("_dtref"))
    return asked.join(cards, F.col("_dtref").eqNullSafe(F.col("dtref")), "left").select(F.col("_dtref").alias("dtref"), *filled)


def realised_by_name(rows: DataFrame, sellers: DataFrame, company: Company = None) -> DataFrame:
    """Realised value per seller name. Sellers with the same name are added up; sellers that the
    dimension lacks drop out."""
    per_seller = rows.filter(_actual(company)).groupBy("dtref", "id_vendedor").agg(
        F.sum("valor_realizado").alias("valor")
    )
    return per_seller.join(sellers.select("id_vendedor", "nome_comercial"), "id_vendedor").groupBy(
        "dtref", F.col("nome_comercial").alias("name")
    ).agg(F.coalesce(F.sum("valor"), F.lit(0)).alias("realized"))


def top_sellers(by_name: DataFrame, rules: SalesRules) -> DataFrame:
    best = Window.partitionBy("dtref").orderBy(F.desc("realized"), F.asc("name"))
    return by_name.withColumn("posicao", F.row_number().over(best)).filter(F.col("posicao") <= rules.top_sellers)


@dataclass(frozen=True)
class Performance:
    daily: DataFrame
    cards: DataFrame
    ranking: DataFrame


def performance(fact: DataFrame, sellers: DataFrame, rules: SalesRules, *, seller_ids: Sequence[int] | None = None,
                start: date | None = None, end: date | None = None, company: Company = None,
                dtref: date | None = None, cycles: DataFrame | None = None) -> Performance:
    """The consolidated query: daily series, KPI cards and top sellers for a period, or for every
    cycle when ``cycles`` is given. The period and each cycle have a card, of zeros if nothing is found."""
    if cycles is not None:
        scoped, wanted = scope_cycles(fact, cycles), cycles
    else:
        scoped = scope_period(fact, start, end, dtref)
        wanted = fact.sparkSession.range(1).select(F.lit(dtref or start).cast("date").alias("dtref"))
    rows = eligible(scoped, sellers, company, seller_ids)
    cards = kpi_cards(seller_totals(rows, company), latest_rates(fact, rules), rules)
    return Performance(
        daily=daily_performance(rows, company),
        cards=with_empty_cycles(cards, wanted),
        ranking=top_sellers(realised_by_name(rows, sellers, company), rules),
    )


def selling_days(daily: DataFrame) -> DataFrame:
    """Days with realised value per cycle."""
    return daily.groupBy("dtref").agg(F.count_if(F.col("realized") > 0).alias("dias_com_venda"))


def tier_rate(attainment: Column, rules: SalesRules) -> Column:
    ladder = None
    for floor, rate in rules.tiers:
        hit = attainment >= F.lit(float(floor))
        value = F.lit(rate).cast("decimal(6,4)")
        ladder = F.when(hit, value) if ladder is None else ladder.when(hit, value)
    base = F.lit(rules.base_tier_rate).cast("decimal(6,4)")
    return base if ladder is None else ladder.otherwise(base)


def bonus(realised: Column, rate: Column, rules: SalesRules) -> Column:
    """What the tier pays above the base rate, in cents, never below zero."""
    value = realised.cast("decimal(18,2)")
    extra = value * rate - value * F.lit(rules.default_rate).cast("decimal(6,4)")
    return F.greatest(F.round(extra, 2), F.lit(0)).cast("decimal(18,2)")


def attainment(realised: Column, goal: Column) -> Column:
    return F.when(goal > 0, realised.cast("double") / goal.cast("double")).otherwise(F.lit(0.0))


def derived_kpis(cards: DataFrame, daily: DataFrame, cycles: DataFrame, rules: SalesRules) -> DataFrame:
    """Attainment, loss, discount, projection, remaining goal, bonus and total pay. ``daily`` is the daily series, or
    already the days with sales per cycle."""
    sold_days = daily if "dias_com_venda" in daily.columns else selling_days(daily)
    open_days = cycles.select("dtref", working_days(F.col("dtinic"), F.col("dtfin"), rules.holidays).alias("dias_uteis"))
    base = cards.join(sold_days, "dtref", "left").join(open_days, "dtref").withColumn(
        "dias_com_venda", F.greatest(F.coalesce("dias_com_venda", F.lit(0)), F.lit(1))
    )
    meta, real = F.col("meta").cast("double"), F.col("realizado").cast("double")
    discount, tickets = F.col("desconto").cast("double"), F.col("tkts").cast("double")
    lost = (F.col("devolucao") + F.col("cancelado")).cast("double")
    sold_or_lost = real + lost

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))

    rate = tier_rate(attainment(F.col("realizado"), F.col("meta")), rules)
    pay = bonus(F.col("realizado"), rate, rules)
    projected = real / F.col("dias_com_venda") * F.col("dias_uteis")
    return base.withColumns({
        "atingimento": attainment(F.col("realizado"), F.col("meta")),
        "total_perdido": lost,
        "perc_perdido": share(lost, sold_or_lost),
        "perc_desconto": share(discount, real + discount),
        "desconto_medio": F.when(tickets > 0, discount / tickets).otherwise(F.lit(0.0)),
        "projetado": projected,
        "perc_projetado": share(projected, meta),
        "media_diaria": real / F.col("dias_com_venda"),
        "restante": F.greatest(F.col("meta") - F.col("realizado"), F.lit(0)),
        "taxa_total": rate,
        "premio": pay,
        "remuneracao_total": F.col("comissao") + pay,
    })


def commission_tiers(totals: DataFrame, rates: DataFrame, rules: SalesRules) -> DataFrame:
    """Attainment, tier rate, commission, bonus and pay of every seller."""
    goal = F.coalesce(F.col("meta_vendedor"), F.lit(0))
    real = F.col("v_realizado")
    reached = attainment(real, goal)
    base = paid_commission(real, F.col("taxa"), rules).cast("decimal(24,2)")
    pay = bonus(real, tier_rate(reached, rules), rules)
    return totals.join(rates.select("id_vendedor", "taxa"), "id_vendedor", "left").select(
        "dtref", "id_vendedor", real.alias("realizado"), goal.alias("meta"), reached.alias("atingimento"),
        tier_rate(reached, rules).alias("taxa_total"), base.alias("comissao"), pay.alias("premio"),
        (base + pay).alias("remuneracao_total"),
    )


def chart_days(cards: DataFrame, daily: DataFrame, cycles: DataFrame, rules: SalesRules) -> DataFrame:
    """Every day of a cycle with realised value and goal. Working days share the total goal evenly;
    other days keep the stored goal; days without rows are 0."""
    spine = cycle_days(cycles, rules.holidays).select("dtref", F.col("data_ref").alias("date"), "dias_uteis", "dia_util")
    goals = cards.select("dtref", F.col("meta").alias("_meta"))
    total = F.coalesce("_meta", F.lit(0))
    each = F.when(F.col("dias_uteis") > 0, total.cast("double") / F.col("dias_uteis")).otherwise(F.lit(0.0))
    return spine.join(goals, "dtref", "left").join(daily, ["dtref", "date"], "left").select(
        "dtref",
        "date",
        F.coalesce(F.col("realized").cast("double"), F.lit(0.0)).alias("realized"),
        F.when(F.col("dia_util"), each).otherwise(F.coalesce(F.col("meta").cast("double"), F.lit(0.0))).alias("meta"),
    )


def calendar_spine(cycles: DataFrame, rules: SalesRules) -> DataFrame:
    return cycle_days(cycles, rules.holidays).select(
        "dtref", F.col("data_ref").alias("date"), is_working_day(F.col("data_ref"), rules.holidays).alias("dia_util")
    )


def cycle_summary(derived: DataFrame) -> DataFrame:
    """Four labelled values per cycle."""
    values = derived.select(
        "dtref",
        F.col("meta").cast("double").alias("Meta"),
        F.col("realizado").cast("double").alias("Realizado"),
        F.col("projetado").alias("Projetado"),
        F.col("restante").cast("double").alias("Falta"),
    )
    return values.unpivot("dtref", ["Meta", "Realizado", "Projetado", "Falta"], "rotulo", "valor")


def kpi_texts(derived: DataFrame) -> DataFrame:
    """The KPI page's texts, one column each."""
    meta, real = F.col("meta"), F.col("realizado")
    remaining = (
        F.when((meta == 0) & (real > 0), F.lit("Superado"))
        .when(meta > 0, text.brl(F.col("restante")))
        .otherwise(F.lit("R$ 0,00"))
    )
    estimate = F.when(meta > 0, F.concat(F.lit("Estimativa: "), text.percent(F.col("perc_projetado")))).otherwise(
        F.lit("Sem Meta")
    )
    return derived.select(
        "dtref",
        F.concat(F.lit("Resumo · "), F.date_format("dtref", "MM/yyyy")).alias("titulo"),
        text.brl(F.col("ticket_medio")).alias("ticket_medio"),
        text.ticket_count(F.col("tkts")).alias("transacoes"),
        text.brl(meta).alias("meta"),
        text.brl(real).alias("realizado"),
        F.concat(F.lit("Proj. "), text.brl_compact(F.col("projetado"))).alias("projetado"),
        text.percent(F.col("atingimento") * 100).alias("perc_realizado"),
        estimate.alias("perc_projetado"),
        remaining.alias("restante"),
        text.brl(F.col("media_diaria")).alias("media_diaria"),
        text.brl(F.col("total_perdido")).alias("total_perdido"),
        text.percent(F.col("perc_perdido")).alias("perc_perdido"),
        text.brl(F.col("devolucao")).alias("devolucao"),
        text.brl(F.col("cancelado")).alias("cancelado"),
        text.brl(F.col("desconto")).alias("desconto"),
        text.percent(F.col("perc_desconto")).alias("perc_desconto"),
        text.brl(F.col("desconto_medio")).alias("desconto_medio"),
        text.brl(F.col("comissao")).alias("comissao"),
        text.brl(F.col("premio")).alias("premio"),
        text.brl(F.col("remuneracao_total")).alias("remuneracao_total"),
    )


def companies(fact: DataFrame) -> DataFrame:
    """Companies with actual rows."""
    return fact.filter("id_empresa > 0").select("id_empresa").distinct().select(
        F.concat(F.lit("Empresa "), F.col("id_empresa").cast("string")).alias("label"), F.col("id_empresa").alias("value")
    )


def cycle_options(cycles: DataFrame) -> DataFrame:
    """Cycles with their label and ``start|end|reference`` value. The newest is marked as default;
    order by ``dtref`` descending for display."""
    newest = cycles.agg(F.max("dtref").alias("m")).scalar()
    label = F.coalesce(F.nullif(F.col("label"), F.lit("")), F.date_format("dtref", "MM/yyyy"))
    return cycles.select(
        "dtref",
        label.alias("label"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in ("dtinic", "dtfin", "dtref")]).alias("value"),
        (F.col("dtref") == newest).alias("padrao"),
    )


def parse_cycle(value: Column) -> Column:
    """``start|end|reference`` back into three dates."""
    parts = F.split(value, r"\|")
    return F.struct(
        parts[0].cast("date").alias("dtinic"), parts[1].cast("date").alias("dtfin"), parts[2].cast("date").alias("dtref")
    )


def seller_options(found: DataFrame) -> DataFrame:
    """``12 · Name`` labels."""
    return found.select(
        "dtref",
        F.concat_ws(" · ", F.col("id_vendedor").cast("string"), "nome_comercial").alias("label"),
        F.col("id_vendedor").alias("value"),
    )


