from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cyclemart.config import SalesRules
from cyclemart.operators import performance as K

RULES = SalesRules(holidays=(), rate_floor=date(2026, 1, 1))
START, END, REF = date(2026, 2, 26), date(2026, 3, 25), date(2026, 3, 1)
FACT = ("id_tempo date, id_vendedor bigint, id_empresa bigint, valor_realizado decimal(15,2), valor_devolucao decimal(15,2), "
        "valor_cancelado decimal(15,2), valor_comissao decimal(15,2), valor_desconto decimal(15,2), "
        "valor_meta_diaria decimal(15,2), valor_meta_mensal decimal(15,2), qtd_transacoes bigint")


def row(day, seller, company, real="0", back="0", cancelled="0", pay="0", disc="0", goal="0", monthly="0", tickets=0):
    return (day, seller, company, *map(Decimal, (real, back, cancelled, pay, disc, goal, monthly)), tickets)


D1, D2 = date(2026, 3, 2), date(2026, 3, 3)
ROWS = [
    row(D1, 1, 1, "100", "10", "5", "2", "7", tickets=2), row(D2, 1, 2, "50", pay="0.50", tickets=1),
    row(D1, 1, 0, goal="40", monthly="800"), row(D2, 1, 0, goal="40", monthly="900"),
    row(D1, 2, 1, "0", cancelled="30"),                       # only cancelled: not active in company 1
    row(D1, 2, 2, "200", pay="0", tickets=4), row(D1, 2, 0, goal="20", monthly="500"),
    row(D1, 3, 0, goal="10", monthly="100"),                  # only a goal
    row(D1, 9, 1, "70", tickets=1),                           # not in the dimension
    row(date(2026, 5, 1), 2, 2, "10", pay="0.30", tickets=1),  # later rate
    row(date(2025, 12, 1), 1, 1, "10", pay="9", tickets=1),   # before the floor
]


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(ROWS, FACT)


@pytest.fixture
def sellers(spark):
    return spark.createDataFrame([(1, "Ana"), (2, "Ana"), (3, "Bia")], "id_vendedor bigint, nome_comercial string")


@pytest.fixture
def cycles(spark):
    return spark.createDataFrame([(REF, START, END, "Março / 2026")], "dtref date, dtinic date, dtfin date, label string")


def run(fact, sellers, **request):
    return K.performance(fact, sellers, RULES, start=START, end=END, dtref=REF, **request)


def cards(found):
    return found.cards.first().asDict()


def test_all_companies(fact, sellers):
    found = cards(run(fact, sellers))
    assert found["realizado"] == 420 and found["meta"] == 900 + 500 + 100
    assert (found["devolucao"], found["cancelado"], found["desconto"], found["tkts"]) == (10, 35, 7, 8)
    # seller 1: 1 % (March 3rd is later than the 2nd); 2: 3 % from May; 9: default 1 %
    assert found["comissao"] == Decimal("1.50") + Decimal("6.00") + Decimal("0.70")
    assert found["ticket_medio"] == 420 / 8


def test_company_resolves_sellers(fact, sellers):
    found = cards(run(fact, sellers, company=1))
    # seller 2 only cancelled there, seller 9 is unknown, seller 3 has no row: seller 1 is left
    assert (found["realizado"], found["cancelado"], found["meta"], found["tkts"]) == (100, 5, 900, 2)
    both = cards(run(fact, sellers, company=[1, 2]))
    assert (both["realizado"], both["cancelado"], both["meta"]) == (350, 35, 1400)


def test_given_sellers_are_not_resolved_again(fact, sellers):
    found = cards(run(fact, sellers, company=1, seller_ids=[2]))
    assert (found["realizado"], found["cancelado"], found["meta"]) == (0, 30, 500)
    assert found["ticket_medio"] == 0.0


def test_empty_company_list_matches_nothing(fact, sellers):
    found = run(fact, sellers, company=[])
    card = cards(found)
    assert card.pop("dtref") == REF and set(card.values()) == {0} and found.cards.count() == 1
    assert found.daily.isEmpty() and found.ranking.isEmpty()


def test_cycles_without_rows_have_cards_of_zeros(spark, fact, sellers, cycles):
    empty = spark.createDataFrame([(date(2030, 1, 1), date(2029, 12, 26), date(2030, 1, 25), None)], cycles.schema)
    found = {r.dtref: (r.realizado, r.meta, r.tkts, r.ticket_medio) for r in K.performance(fact, sellers, RULES, cycles=cycles.union(empty)).cards.collect()}
    assert found.keys() == {REF, date(2030, 1, 1)} and found[date(2030, 1, 1)] == (0, 0, 0, 0.0)


def test_daily_series_and_top_sellers(fact, sellers):
    found = run(fact, sellers)
    assert {(r.date, float(r.realized), float(r.meta)) for r in found.daily.collect()} == {(D1, 370.0, 70.0), (D2, 50.0, 40.0)}
    assert [(r.posicao, r.name, float(r.realized)) for r in found.ranking.collect()] == [(1, "Ana", 350.0)]


def test_rates(fact):
    found = {r.id_vendedor: r for r in K.latest_rates(fact, RULES).collect()}
    assert {k: float(v.taxa) for k, v in found.items()} == {1: 0.01, 2: 0.03}


def test_rate_ties_take_the_lower_company(spark):
    fact = spark.createDataFrame([row(D1, 1, 2, "100", pay="5"), row(D1, 1, 1, "100", pay="3")], FACT)
    assert float(K.latest_rates(fact, RULES).first().taxa) == 0.03


def test_active_sellers_include_goal_only_sellers_without_company(fact, sellers):
    scoped = K.scope_period(fact, START, END, REF)
    assert {r.id_vendedor for r in K.active_sellers(scoped, sellers).collect()} == {1, 2, 3}
    assert {r.id_vendedor for r in K.active_sellers(scoped, sellers, company=1).collect()} == {1}
    assert K.active_sellers(scoped, sellers, company=[]).isEmpty()
    assert {r.label for r in K.seller_options(K.active_sellers(scoped, sellers, company=2)).collect()} == {"1 · Ana", "2 · Ana"}


def test_one_bound_is_no_period(fact):
    assert K.scope_period(fact, START, None).count() == len(ROWS)


def test_all_cycles_equal_the_single_period(fact, sellers, cycles):
    whole = K.performance(fact, sellers, RULES, cycles=cycles)
    single = run(fact, sellers)
    assert whole.cards.collect() == single.cards.collect()
    assert sorted(whole.daily.collect()) == sorted(single.daily.collect())


def test_overlapping_cycles_each_count_their_days(spark, fact, sellers, cycles):
    wider = spark.createDataFrame([(date(2026, 4, 1), D2, date(2026, 6, 1), None)], cycles.schema)
    found = {r.dtref: r.realizado for r in K.performance(fact, sellers, RULES, cycles=cycles.union(wider)).cards.collect()}
    assert found == {REF: 420, date(2026, 4, 1): 60}


def test_derived(fact, sellers, cycles):
    found = run(fact, sellers)
    got = K.derived_kpis(found.cards, found.daily, cycles, RULES).first()
    assert (got.dias_uteis, got.dias_com_venda) == (24, 2)
    assert got.projetado == 420 / 2 * 24 and got.media_diaria == 210
    assert got.total_perdido == 45 and got.perc_perdido == pytest.approx(45 / 465 * 100)
    assert got.restante == 1080 and got.atingimento == 420 / 1500
    texts = K.kpi_texts(K.derived_kpis(found.cards, found.daily, cycles, RULES)).first()
    assert texts.titulo == "Resumo · 03/2026" and texts.transacoes == "8 transações" and texts.restante == "R$ 1.080,00"
    assert texts.projetado == "Proj. R$ 5,0K" and texts.perc_projetado == "Estimativa: 336,0%"


def test_no_goal_texts(spark, sellers, cycles):
    fact = spark.createDataFrame([row(D1, 1, 1, "100", tickets=1)], FACT)
    found = run(fact, sellers)
    texts = K.kpi_texts(K.derived_kpis(found.cards, found.daily, cycles, RULES)).first()
    assert (texts.restante, texts.perc_projetado, texts.perc_realizado) == ("Superado", "Sem Meta", "0,0%")


@pytest.mark.parametrize("reached, rate", [
    (0.99, "0.0100"), (1.0, "0.0105"), (1.1, "0.0110"), (1.2, "0.0120"), (1.3, "0.0130"), (1.4, "0.0140"), (1.5, "0.0150"), (9.0, "0.0150"),
])
def test_tiers_and_bonus(spark, reached, rate):
    got = spark.range(1).select(
        K.tier_rate(F.lit(reached), RULES).alias("t"),
        K.bonus(F.lit(Decimal("1000.00")), K.tier_rate(F.lit(reached), RULES), RULES).alias("b"),
    ).first()
    assert got.t == Decimal(rate) and got.b == Decimal(1000) * (Decimal(rate) - Decimal("0.01"))


def test_chart_fills_every_day(fact, sellers, cycles):
    found = run(fact, sellers)
    days = {r.date: r for r in K.chart_days(found.cards, found.daily, cycles, RULES).collect()}
    assert len(days) == 28
    assert days[D1].realized == 370.0 and days[D1].meta == 1500 / 24
    assert days[date(2026, 3, 1)].meta == 0.0 and days[date(2026, 3, 4)].realized == 0.0


def test_commission_tiers(fact, sellers):
    rows = K.eligible(K.scope_period(fact, START, END, REF), sellers)
    got = {r.id_vendedor: r for r in K.commission_tiers(K.seller_totals(rows), K.latest_rates(fact, RULES), RULES).collect()}
    assert got[2].comissao == 6 and got[2].premio == 0 and got[2].atingimento == 0.4
    assert got[9].meta == 0 and got[9].comissao == Decimal("0.70") and got[3].realizado == 0


def test_summary_rows(fact, sellers, cycles):
    found = run(fact, sellers)
    got = {r.rotulo: r.valor for r in K.cycle_summary(K.derived_kpis(found.cards, found.daily, cycles, RULES)).collect()}
    assert got == {"Meta": 1500.0, "Realizado": 420.0, "Projetado": 5040.0, "Falta": 1080.0}
