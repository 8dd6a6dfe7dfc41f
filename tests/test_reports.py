from datetime import date
from decimal import Decimal

import pytest

from cyclemart.operators import reports


def d(v):
    return Decimal(v)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(date(2026, 5, 1), 1, 1, d("10.005"), "Completed"), (date(2026, 5, 1), 1, 1, d("20"), "Completed"),
         (date(2026, 5, 1), 1, 1, d("5"), "Cancelled"), (date(2026, 8, 1), 2, 1, d("8"), "Completed"), (date(2026, 5, 1), 2, 1, d("1"), "Returned")],
        "mes date, id_vendedor bigint, id_empresa bigint, final_amount decimal(20,4), sale_status string")


@pytest.fixture
def sellers(spark):
    return spark.createDataFrame([(1, "Ana"), (2, "Bia")], "id_vendedor bigint, nome_comercial string")


def test_averages_and_rates(rows, sellers):
    assert {r.mes.month: r.ticket_medio for r in reports.row_average(rows).collect()} == {5: d("15.00"), 8: d("8.00")}
    by = {r.name: (r.qtd_vendas, r.ticket_medio) for r in reports.sales_by_seller(rows, sellers).collect()}
    assert by == {"Ana": (2, d("15.00")), "Bia": (1, d("8.00"))}
    rate = {(r.name, r.mes.month): r.taxa_cancelamento for r in reports.cancel_rate(rows, sellers).collect()}
    assert rate == {("Ana", 5): d("33.33"), ("Bia", 8): 0, ("Bia", 5): 0}


def test_goal_performance_keeps_sellers_without_sales(spark, rows, sellers):
    goals = spark.createDataFrame([(date(2026, 5, 1), 1, d("300")), (date(2026, 5, 1), 2, d("100"))], "mes date, id_vendedor bigint, meta decimal(15,2)")
    got = {r.name: (r.vendido, r.percentual_meta) for r in reports.performance_vs_goal(rows, goals, sellers).collect()}
    assert got == {"Ana": (d("30.0050"), d("10.00")), "Bia": (0, 0)}


def test_goals_with_cents(spark, sellers):
    rows = spark.createDataFrame([(date(2026, 5, 1), 1, 1, d("50.25"), "Completed")],
                                 "mes date, id_vendedor bigint, id_empresa bigint, final_amount decimal(20,4), sale_status string")
    goals = spark.createDataFrame([(date(2026, 5, 1), 1, d("100.50")), (date(2026, 5, 1), 2, d("0.40"))], "mes date, id_vendedor bigint, meta decimal(15,2)")
    got = {r.name: r.percentual_meta for r in reports.performance_vs_goal(rows, goals, sellers).collect()}
    assert got == {"Ana": d("50.00"), "Bia": 0}


def test_share_of_all_rows(spark):
    totals = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    assert {r.k: r.percentual for r in reports.share_of_all(totals, "v").collect()} == {"a": 25.0, "b": 75.0}
    assert reports.share_of_all(totals.limit(0), "v").count() == 0


def test_matrix_share_growth_and_grain(spark, rows):
    matrix = {r.id_vendedor: (r.ano, r.t2, r.t3) for r in reports.period_matrix(rows).collect()}
    assert matrix == {1: (2026, d("30.005"), 0), 2: (2026, 0, d("8"))}
    totals = spark.createDataFrame([("a", 1, 10), ("a", 2, 30), ("b", 1, 5)], "k string, p int, v int")
    assert sorted(r.percentual for r in reports.share_of_total(totals, ("k",), "v").collect()) == [25.0, 75.0, 100.0]
    steps = {(r.k, r.p): (r.variacao, r.tendencia) for r in reports.growth(totals, ("k",), "p", "v").collect()}
    assert steps == {("a", 1): (None, None), ("a", 2): (200.0, "alta"), ("b", 1): (None, None)}
    follows = spark.createDataFrame([(2, 1), (3, 2), (4, 3)], "p int, anterior int")
    gaps = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("a", 4, 15)], "k string, p int, v int")
    dated = {r.p: (r.anterior, r.variacao, r.tendencia) for r in reports.growth(gaps, ("k",), "p", "v", follows).collect()}
    assert dated == {1: (None, None, None), 3: (0, None, "alta"), 4: (30, -50.0, "queda")}
    fact = spark.createDataFrame([(date(2026, 5, 3), 1, 7), (date(2026, 6, 3), 1, 1), (date(2026, 5, 3), 0, 99)],
                                 "id_tempo date, id_empresa int, valor_realizado int")
    assert {(r.periodo, r.realizado) for r in reports.by_grain(fact, "quarter").collect()} == {(date(2026, 4, 1), 8)}
    assert reports.by_grain(fact, "day").count() == 2
    with pytest.raises(ValueError):
        reports.by_grain(fact, "week")


def test_conversion(spark):
    events = spark.createDataFrame([(1, "signup"), (1, "signup"), (1, "purchase"), (2, "purchase"), (3, "view")], "user_id bigint, event_type string")
    got = {r.user_id: r.conversao for r in reports.conversion_rate(events, "signup", "purchase").collect()}
    assert got == {1: 0.5, 2: 0.0, 3: 0.0}
