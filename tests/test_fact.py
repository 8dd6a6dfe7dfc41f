"""Hand-made documents, worked out by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cyclemart.config import SalesRules
from cyclemart.operators.daily import daily_actuals, daily_cancels, daily_returns, daily_sales, placed_actuals
from cyclemart.operators.fact import combine_actuals, placed_fact, sales_fact
from cyclemart.operators.goals import goal_days, goals_by_day, placed_goals
from cyclemart.sources.documents import (
    approved_sales, cancelled_sales, customer_returns, dated_headers, document_lines, movements,
)

RULES = SalesRules(holidays=(date(2026, 2, 17),))
HEADER = "nunota bigint, dtentsai timestamp_ntz, codemp bigint, codvend bigint, codparc bigint, codtipoper int, statusnfe string"
ITEM = "nunota bigint, codprod bigint, qtdneg decimal(15,2), vlrtot decimal(15,2), vlrdesc decimal(20,4), vlrcus decimal(15,2)"
DAY = datetime(2026, 2, 16, 18, 30)


def d(text):
    return Decimal(text)


def item(doc, product, qty, total, discount, cost):
    return (doc, product, d(qty), d(total), d(discount), d(cost))


@pytest.fixture
def tables(spark):
    headers = spark.createDataFrame([
        (1, DAY, 1, 7, 50, 3107, "A"), (2, DAY, 1, 7, 51, 3217, "A"), (3, DAY, 1, 7, 50, 3107, "P"),  # 3: not approved
        (4, DAY, 1, 7, 50, 9999, "A"),                                                                # 4: other operation
        (5, DAY, 1, 7, 50, 2201, None), (6, DAY, 2, 7, 50, 2200, "A"),
    ], HEADER)
    items = spark.createDataFrame([
        item(1, 1, "2", "100.00", "10.0050", "30.00"), item(1, 2, "1", "50.00", "0", "60.00"),
        item(2, 1, "1", "20.00", "0.0040", "5.00"), item(3, 1, "1", "999.00", "0", "1"), item(4, 1, "1", "999.00", "0", "1"),
        item(5, 1, "1", "30.00", "0.1234", "1.00"), item(6, 1, "1", "40.00", "0", "1.00"),
    ], ITEM)
    log = spark.createDataFrame([(9, DAY), (10, DAY)], "nunota bigint, dtneg timestamp_ntz")
    gone = spark.createDataFrame([
        (9, datetime(2026, 1, 1), 1, 7, 50, 3108, None), (10, datetime(2026, 1, 1), 1, 7, 50, 1, None),
    ], HEADER)
    gone_items = spark.createDataFrame([item(9, 1, "1", "12.00", "2.0001", "1"), item(10, 1, "1", "77.00", "0", "1")], ITEM)
    return headers, items, log, gone, gone_items


def test_daily_totals(tables):
    headers, items, log, gone, gone_items = tables
    lines = document_lines(dated_headers(headers), items)
    sale = daily_sales(approved_sales(lines, RULES)).first()
    # 100 - 10.01 (cents, half up) + 50 + 20 - 0.00
    assert sale.vlr_nota == d("159.99") and sale.qtd_transacoes == 2 and sale.data_ref == DAY.date()
    # cost 60 + 60 + 5 less what was sold
    assert sale.vlr_desconto == d("125") - d("159.99")
    back = {r.codemp: r.vlr_devolucao for r in daily_returns(customer_returns(lines, RULES)).collect()}
    assert back == {1: d("29.8766"), 2: d("40")}
    cancelled = daily_cancels(cancelled_sales(log, gone, gone_items, RULES)).collect()
    assert [(r.data_ref, r.vlr_cancelada) for r in cancelled] == [(DAY.date(), d("9.9999"))]


def test_one_pass_equals_separate_totals(tables):
    headers, items, log, gone, gone_items = tables
    lines = document_lines(dated_headers(headers), items)
    separate = combine_actuals(
        daily_sales(approved_sales(lines, RULES)), daily_returns(customer_returns(lines, RULES)),
        daily_cancels(cancelled_sales(log, gone, gone_items, RULES)),
    )
    fused = daily_actuals(movements(headers, items, log, gone, gone_items, RULES)).select(*separate.columns)
    assert fused.exceptAll(separate).isEmpty() and separate.exceptAll(fused).isEmpty()
    assert fused.count() == 2


def goals(spark, cycles, per_seller, sellers=(7, 8, 9), **period):
    return goals_by_day(
        spark.createDataFrame(per_seller, "codmetavenda int, codvend bigint, vlrmetavendedor decimal(15,2), perccomissao decimal(5,2)"),
        spark.createDataFrame(cycles, "codmetavenda int, dtref date, dtinic date, dtfin date"),
        spark.createDataFrame([(s,) for s in sellers], "codvend bigint"), RULES, **period,
    )


CYCLE = (1, date(2026, 2, 1), date(2026, 2, 10), date(2026, 2, 21))


def test_fact_nets_clips_and_spreads_the_rate(spark, tables):
    goal_days = goals(spark, [CYCLE], [(1, 7, d("1000"), d("1.50")), (1, 8, d("500"), d("2.00"))])
    fact = {(r.id_tempo, r.id_vendedor, r.id_empresa): r
            for r in sales_fact(daily_actuals(movements(*tables, RULES)), goal_days).collect()}
    one, two, goal = (fact[DAY.date(), 7, company] for company in (1, 2, 0))
    assert one.valor_realizado == d("130.11")          # 159.99 - 29.8766 = 130.1134
    assert one.valor_comissao == d("1.95")             # 1.5 % of 130.1134
    assert one.valor_cancelado == d("10.00") and one.qtd_transacoes == 2 and one.valor_meta_mensal == 0
    assert (two.valor_realizado, two.valor_devolucao, two.valor_comissao) == (0, d("40.00"), 0)  # more returned than sold
    assert goal.valor_meta_mensal == 1000 and goal.valor_realizado == 0
    assert goal.valor_meta_diaria == d("100.00")       # 12 days less a Sunday and a holiday
    assert fact[date(2026, 2, 15), 7, 0].valor_meta_diaria == 0   # Sunday
    assert fact[date(2026, 2, 17), 7, 0].valor_meta_diaria == 0   # holiday
    assert fact[date(2026, 2, 17), 7, 0].valor_meta_mensal == 1000
    assert fact[date(2026, 2, 20), 8, 0].valor_meta_diaria == d("50.00")  # goal only, nothing sold
    assert len(fact) == 2 * 12 + 2


def test_seller_without_goal_gets_no_rate(spark, tables):
    fact = sales_fact(daily_actuals(movements(*tables, RULES)), goals(spark, [CYCLE], [(1, 8, d("1"), d("1"))]))
    assert {r.valor_comissao for r in fact.filter("id_vendedor = 7").collect()} == {0}


def test_overlapping_cycles_keep_the_later_start(spark):
    later = (2, date(2026, 3, 1), date(2026, 2, 15), date(2026, 2, 18))
    found = goals(spark, [CYCLE, later], [(1, 7, d("1000"), d("1")), (2, 7, d("300"), d("2")), (1, 8, d("10"), d("1"))])
    by_day = {(r.data_ref.day, r.codvend): r.meta_mensal for r in found.collect()}
    assert len(by_day) == found.count() == 24
    assert [by_day[day, 7] for day in (14, 15, 18, 19)] == [1000, 300, 300, 1000]
    assert by_day[16, 8] == 10


def test_goals_need_a_known_seller_and_respect_the_period(spark):
    found = goals(spark, [CYCLE], [(1, 7, d("1"), d("1")), (1, 99, d("1"), d("1"))], start=date(2026, 2, 12), end=date(2026, 2, 13))
    assert sorted((r.codvend, r.data_ref.day) for r in found.collect()) == [(7, 12), (7, 13)]


def test_real_company_zero_merges_with_the_goal_row(spark):
    actuals = spark.createDataFrame(
        [(date(2026, 2, 16), 0, 7, d("80"), d("0"), 1, None, None)],
        "data_ref date, codemp bigint, codvend bigint, vlr_nota decimal(18,2), vlr_desconto decimal(18,4), "
        "qtd_transacoes bigint, vlr_devolucao decimal(18,4), vlr_cancelada decimal(18,4)")
    fact = sales_fact(actuals, goals(spark, [CYCLE], [(1, 7, d("1000"), d("1"))]))
    row = fact.filter(F.col("id_tempo") == F.lit(date(2026, 2, 16))).collect()
    assert len(row) == 1 and row[0].valor_realizado == 80 and row[0].valor_meta_mensal == 1000


def test_a_placed_fact_is_not_moved_again(spark, plan):
    """Days of goals open where the actuals of their month and seller lie; overlapping cycles and company 0 as elsewhere."""
    lines = spark.createDataFrame(
        [(1, "V", d0, emp, 7, d("10"), d("1"), d("2"), d("3")) for d0, emp in ((date(2026, 3, 20), 2), (date(2026, 3, 28), 0), (date(2026, 4, 2), 2))]
        + [(2, "D", date(2026, 4, 2), 2, None, d("4"), d("0"), d("2"), d("1"))],
        "nunota bigint, tipo_mov string, data_ref date, codemp bigint, codvend bigint, vlrtot decimal(15,2), vlrdesc decimal(20,4), vlrcus decimal(15,2), qtdneg decimal(15,2)")
    cycles = spark.createDataFrame([(1, date(2026, 3, 1), date(2026, 3, 30)), (2, date(2026, 3, 25), date(2026, 4, 5))],
                                   "codmetavenda int, dtinic date, dtfin date")
    wanted = spark.createDataFrame([(1, 7, d("100"), d("1")), (2, 7, d("500"), d("2")), (1, 8, d("50"), d("3"))],
                                   "codmetavenda int, codvend bigint, vlrmetavendedor decimal(15,2), perccomissao decimal(5,2)")
    sellers = spark.createDataFrame([(7, "a"), (8, "b")], "codvend bigint, apelido string")
    plain = sales_fact(daily_actuals(lines), goals_by_day(wanted, cycles, sellers, RULES))
    placed = sales_fact(placed_actuals(lines), goals_by_day(wanted, cycles, sellers, RULES, placed=True))
    assert placed.columns == plain.columns and sorted(map(str, placed.collect())) == sorted(map(str, plain.collect()))
    text = plan(placed)
    assert "Exchange" not in text[:text.index("Union")]


def test_goal_days_open_after_the_rates_are_spread(spark, plan):
    """Overlapping cycles, a cycle that a seller lacks, a rate that is null, company 0 and sellers without a name or goal."""
    march, april = date(2026, 3, 28), date(2026, 4, 2)
    lines = spark.createDataFrame(
        [(k, "VDC"[k % 3], day, emp, seller, d("10"), d("1"), d("2"), d("3"))
         for k, (day, emp, seller) in enumerate((day, emp, seller) for day in (date(2026, 3, 20), march, april, date(2026, 5, 1))
                                                for emp in (0, 2, 3) for seller in (7, 8, 9, None))],
        "nunota bigint, tipo_mov string, data_ref date, codemp bigint, codvend bigint, vlrtot decimal(15,2), vlrdesc decimal(20,4), vlrcus decimal(15,2), qtdneg decimal(15,2)")
    cycles = spark.createDataFrame([(1, date(2026, 3, 1), date(2026, 3, 30)), (2, date(2026, 3, 25), date(2026, 4, 5))],
                                   "codmetavenda int, dtinic date, dtfin date")
    wanted = spark.createDataFrame([(1, 7, d("100"), d("1")), (2, 7, d("500"), None), (1, 8, d("50"), d("3")), (1, 99, d("1"), d("1"))],
                                   "codmetavenda int, codvend bigint, vlrmetavendedor decimal(15,2), perccomissao decimal(5,2)")
    sellers = spark.createDataFrame([(7, "a"), (8, "b"), (9, "c")], "codvend bigint, apelido string")
    for chosen in (None, spark.createDataFrame([(march,), (april,)], "data_ref date")):
        some = lines if chosen is None else lines.join(chosen, "data_ref", "left_semi")
        own = goals_by_day(wanted, cycles, sellers, RULES)
        plain = sales_fact(daily_actuals(some), own if chosen is None else own.join(chosen, "data_ref", "left_semi"))
        days = goal_days(cycles, RULES, wanted=chosen)
        placed = placed_fact(placed_actuals(some), placed_goals(wanted, sellers, days), days)
        assert placed.columns == plain.columns and sorted(map(str, placed.collect())) == sorted(map(str, plain.collect()))
    text = plan(placed)
    assert text.index("Generate inline") < text.index("Window ") < text.index("Union") and "Sort " not in text[:text.index("Generate inline")]
    assert "Exchange" not in text[:text.index("Generate inline")] and "hashpartitioning(data_ref" not in text[:text.index("Union")]
