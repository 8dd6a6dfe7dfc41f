"""KPIs by cycle, company and seller, rolled up once.

A cell adds up the fact rows of a company and seller in a cycle. What does not add up is kept so that any choice of
companies and sellers can still be answered: days with sales as bits, goals as a maximum, the last day with
commission. Cards, rankings, tiers and derived KPIs then read the cube instead of the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.config import SalesRules
from cyclemart.functions.predicates import Company, any_movement, for_company
from cyclemart.operators import performance as K
from cyclemart.schemas import TABLES
from cyclemart.sources.warehouse import Warehouse

CUBE = "cubo_kpi"
#: Longest cycle whose days fit the bits of a cell.
MOST_DAYS = 64


def cube_rows(fact: DataFrame, cycles: DataFrame) -> DataFrame:
    """Cells of the given cycles from the fact."""
    scoped = K.scope_cycles(fact, cycles).join(cycles.select("dtref", "dtinic"), "dtref")
    at = F.date_diff("id_tempo", "dtinic")
    sold = F.when(F.col("valor_realizado") > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), at)).otherwise(F.lit(0).cast("bigint"))
    sold = F.when(at < MOST_DAYS, sold).otherwise(F.raise_error(F.lit(f"a cycle has more than {MOST_DAYS} days")))
    paid = (F.col("valor_comissao") > 0) & (F.col("valor_realizado") > 0)
    added = ("valor_realizado", "valor_devolucao", "valor_cancelado", "valor_desconto", "qtd_transacoes")
    cells = scoped.groupBy("dtref", "id_empresa", "id_vendedor").agg(
        *[F.sum(c).alias(c) for c in added], F.max("valor_meta_mensal").alias("valor_meta_mensal"), F.bool_or(any_movement()).alias("movimento"),
        F.count(F.lit(1)).alias("linhas"), F.bit_or(sold).alias("dias_venda"),
        F.max(F.when(paid, F.struct("id_tempo", "valor_comissao", "valor_realizado"))).alias("_u"))
    cells = cells.withColumns({"ultimo_dia": F.col("_u.id_tempo"), "ultima_comissao": F.col("_u.valor_comissao"), "ultimo_realizado": F.col("_u.valor_realizado")})
    return cells.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[CUBE].schema])


def refresh_cube(warehouse: Warehouse, start: date, end: date) -> None:
    """Recompute the cells of the cycles that a period touches, from the months of the fact they lie in. A warehouse
    without cycles or without the cube has none to recompute."""
    if not all(warehouse.exists(warehouse.current_path(warehouse.path(name))) for name in ("dim_tempo_ref", CUBE)):
        return
    cycles = warehouse.read("dim_tempo_ref").filter((F.col("dtinic") <= F.lit(end)) & (F.col("dtfin") >= F.lit(start)))
    touched = [r[0] for r in cycles.select("dtref").collect()]
    if touched:
        warehouse.replace_months(CUBE, cube_rows(warehouse.fact(), cycles), touched)


def latest_rates(cube: DataFrame, rules: SalesRules) -> DataFrame:
    """Each seller's commission rate as ``performance.latest_rates`` finds it in the fact."""
    last = Window.partitionBy("id_vendedor").orderBy(F.desc("ultimo_dia"), F.asc("id_empresa"))
    rate = F.col("ultima_comissao").cast("double") / F.col("ultimo_realizado").cast("double")
    valid = cube.filter(F.col("ultimo_dia") >= F.lit(rules.rate_floor))
    return valid.withColumn("_r", F.row_number().over(last)).filter("_r = 1").select(
        "id_vendedor", F.col("ultimo_dia").alias("id_tempo"), "id_empresa", rate.cast(K.RATE).alias("taxa"))


def totals(cube: DataFrame, sellers: DataFrame, company: Company = None, seller_ids: Sequence[int] | None = None) -> DataFrame:
    """Seller totals of every cycle in the cube, as ``performance.seller_totals`` gives them."""
    rows = K.eligible(cube, sellers, company, seller_ids, F.col("movimento"))
    return K.seller_totals(rows, company, F.col("linhas"))


def cards(cube: DataFrame, sellers: DataFrame, cycles: DataFrame, rules: SalesRules, company: Company = None,
          seller_ids: Sequence[int] | None = None) -> DataFrame:
    """KPI cards of every cycle, of zeros where nothing is found."""
    return K.with_empty_cycles(K.kpi_cards(totals(cube, sellers, company, seller_ids), latest_rates(cube, rules), rules), cycles)


def ranking(cube: DataFrame, sellers: DataFrame, rules: SalesRules, company: Company = None,
            seller_ids: Sequence[int] | None = None) -> DataFrame:
    rows = K.eligible(cube, sellers, company, seller_ids, F.col("movimento"))
    return K.top_sellers(K.realised_by_name(rows, sellers, company), rules)


def selling_days(cube: DataFrame, sellers: DataFrame, company: Company = None, seller_ids: Sequence[int] | None = None) -> DataFrame:
    """Days with realised value per cycle. Realised value is never below zero, so a day of any cell is a day of the choice."""
    rows = K.eligible(cube, sellers, company, seller_ids, F.col("movimento")).filter(for_company(F.col("id_empresa"), company))
    return rows.groupBy("dtref").agg(F.bit_count(F.bit_or("dias_venda")).cast("bigint").alias("dias_com_venda"))
