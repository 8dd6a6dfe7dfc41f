import random
from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest

from cyclemart.config import SalesRules
from cyclemart.operators.levels import COMPANY, DETAIL, GLOBAL, SELLER, level_of
from cyclemart.operators.rankings import (
    CUSTOMER,
    company_lists,
    item_totals,
    ranking_lookup,
    ranking_totals,
    rankings,
    rankings_of_companies,
    rankings_of_companies_bounded,
)

RULES = SalesRules()
LINE = ("nunota bigint, data_ref date, codemp bigint, codvend bigint, codparc bigint, codprod bigint, "
        "vlrtot decimal(15,2), vlrdesc decimal(20,4)")
MAY, JUNE = date(2026, 5, 1), date(2026, 6, 1)


def line(company, seller, customer, product, value, day=date(2026, 5, 9)):
    return (1, day, company, seller, customer, product, Decimal(value), Decimal(0))


def ranked(spark, rows, **only):
    partners = spark.createDataFrame([(i, f"c{i}") for i in range(1, 40)], "codparc bigint, nomeparc string")
    products = spark.createDataFrame(
        [(i, f"p{i}", None if i % 5 == 0 else i % 5, None if i % 5 == 0 else f"m{i % 5}") for i in range(1, 40)],
        "codprod bigint, descrprod string, codmarca bigint, marca string")
    return rankings(spark.createDataFrame(rows, LINE), partners, products, RULES, **only)


def pick(df, **where):
    for key, value in where.items():
        df = df.filter(df[key] == value)
    return [(r.id_item, float(r.valor), r.posicao) for r in df.orderBy("posicao").collect()]


def test_ties_go_to_the_lower_id_and_lists_stop_at_ten(spark):
    rows = [line(1, 2, c, 1, "10") for c in range(20, 5, -1)] + [line(1, 2, 30, 1, "11")]
    found = pick(ranked(spark, rows, kinds=("CLIENTE",)), nivel=GLOBAL)
    assert found == [(30, 11.0, 1)] + [(c, 10.0, i) for i, c in enumerate(range(6, 15), 2)]


def test_levels_add_up(spark):
    rows = [line(1, 2, 5, 1, "10"), line(1, 3, 5, 1, "20"), line(2, 2, 5, 2, "40"), line(2, 2, 6, 5, "7")]
    df = ranked(spark, rows)
    clients = df.filter("tipo = 'CLIENTE'")
    assert pick(clients, nivel=GLOBAL) == [(5, 70.0, 1), (6, 7.0, 2)]
    assert pick(clients, nivel=COMPANY, id_empresa=1) == [(5, 30.0, 1)]
    assert pick(clients, nivel=SELLER, id_vendedor=2) == [(5, 50.0, 1), (6, 7.0, 2)]
    assert pick(clients, nivel=DETAIL, id_empresa=2, id_vendedor=2) == [(5, 40.0, 1), (6, 7.0, 2)]
    brands = df.filter("tipo = 'MARCA' and nivel = 3")
    assert {(r.id_item, r.label_item, float(r.valor)) for r in brands.collect()} == {
        (0, "SEM MARCA", 7.0), (1, "m1", 30.0), (2, "m2", 40.0)}


def test_real_zero_ids_do_not_meet_the_roll_up(spark):
    df = ranked(spark, [line(0, 0, 5, 1, "10"), line(1, 2, 5, 1, "5")], kinds=("CLIENTE",))
    assert pick(df, nivel=GLOBAL) == [(5, 15.0, 1)]
    assert pick(df, nivel=DETAIL, id_empresa=0, id_vendedor=0) == [(5, 10.0, 1)]
    assert pick(df, nivel=COMPANY, id_empresa=0) == [(5, 10.0, 1)]


def test_months_stand_alone_and_unknown_items_drop_out(spark):
    df = ranked(spark, [line(1, 2, 5, 1, "10"), line(1, 2, 6, 1, "3", date(2026, 6, 30)), line(1, 2, 999, 1, "50")],
                kinds=("CLIENTE",), levels=(GLOBAL,))
    assert pick(df, dtref=MAY) == [(5, 10.0, 1)]
    assert pick(df, dtref=JUNE) == [(6, 3.0, 1)]


@pytest.mark.parametrize("company, seller, level", [(0, 0, GLOBAL), (1, 0, COMPANY), (0, 2, SELLER), (1, 2, DETAIL)])
def test_level_of(company, seller, level):
    assert level_of(company, seller) == level


def lookup(spark, stored, **request):
    products = spark.createDataFrame([(1, "p1", " R1 ", None)], "id_produto bigint, nome_produto string, refforn string, complemento string")
    return ranking_lookup(stored, products, RULES, **request)


def test_lookup_of_several_companies_adds_their_stored_lists(spark):
    rows = [line(1, 2, c, 1, str(100 - c)) for c in range(1, 13)] + [line(2, 2, c, 1, "5") for c in (11, 12)]
    stored = ranked(spark, rows)
    found = lookup(spark, stored, company=[1, 2], dtref=MAY).filter("tipo = 'CLIENTE'")
    # customers 11 and 12 are not in company 1's ten, so only company 2 counts for them
    assert pick(found)[-1][1:] == (90.0, 10) and len(pick(found)) == 10
    product = lookup(spark, stored, company=[1, 2]).filter("tipo = 'PRODUTO'").first()
    assert (product.refforn, product.complemento) == ("R1", "")
    totals = {r.tipo: float(r.total) for r in ranking_totals(lookup(spark, stored, company=1)).collect()}
    assert totals["CLIENTE"] == sum(100 - c for c in range(1, 11))


def test_lookup_edge_requests(spark):
    stored = ranked(spark, [line(1, 2, 5, 1, "10")])
    assert lookup(spark, stored, company=[]).isEmpty()
    assert lookup(spark, stored, company=9).isEmpty()
    assert lookup(spark, stored, company=[1], seller=2).filter("tipo = 'CLIENTE'").first().id_item == 5
    assert lookup(spark, stored).filter("tipo = 'MARCA'").first().refforn == ""


def bounded(spark, rows, depth, companies=(1, 2)):
    """The list from cut lists and from all sales, and the periods whose sales the former read."""
    partners = spark.createDataFrame([(i, f"c{i}") for i in range(1, 200)], "codparc bigint, nomeparc string")
    products = spark.createDataFrame([(i, f"p{i}", i % 7 + 1, f"m{i % 7 + 1}") for i in range(1, 200)],
                                     "codprod bigint, descrprod string, codmarca bigint, marca string")
    lines, rules, read = spark.createDataFrame(rows, LINE), replace(RULES, list_depth=depth), []

    def sales(period):
        read.append(period)
        return lines.filter(lines.data_ref.between(*period))

    found = rankings_of_companies_bounded(company_lists(item_totals(lines, partners, products), rules), companies, rules,
                                          sales, partners, products)
    exact = rankings_of_companies(lines, partners, products, rules, companies)
    assert sorted(found.select(*exact.columns).collect()) == sorted(exact.collect())
    return found, read


@pytest.mark.parametrize("depth", [1, 10, 15, 40, 1000])
def test_cut_lists_of_several_companies_give_the_exact_list(spark, depth):
    rng, rows = random.Random(depth), []
    for day in (date(2026, 1, 31), date(2026, 2, 1), date(2026, 5, 9)):
        for _ in range(400):
            value = str(rng.choice((1, 5, 5, 20, -3, 400)) * rng.randint(1, 4))
            rows.append(line(rng.randint(1, 3), 2, min(rng.randint(1, 150), rng.randint(1, 150)), rng.randint(1, 150), value, day))
    found, read = bounded(spark, rows, depth)
    again = {(r.dtref, r.tipo) for r in found.filter("recalculado").collect()}
    assert found.first().grupos_recalculados == len(again)
    assert (not again and not read) if depth == 1000 else again
    if depth == 1:
        assert read == [(date(2026, 1, 1), date(2026, 5, 31))]


def test_a_list_stands_below_its_cut_offs_and_falls_at_a_tie(spark):
    # Twelve customers of both companies, the first ten far ahead; products and brands are whole lists.
    rows = [line(e, 2, c, 1, str(1000 - c if c <= 10 else 20)) for e in (1, 2) for c in range(1, 13)]
    found, read = bounded(spark, rows, depth=11)
    assert not read and found.first().grupos_recalculados == 0
    # Now those that a list lacks can reach the tenth: a tie that ids decide.
    rows = [line(e, 2, c, 1, "20") for e in (1, 2) for c in range(1, 13)]
    found, read = bounded(spark, rows, depth=11)
    assert read and {r.tipo for r in found.filter("recalculado").collect()} == {CUSTOMER}


def test_an_item_that_every_list_lacks_is_found(spark):
    rows = [line(e, 2, e * 20 + c, 1, str(100 + c)) for e in (1, 2) for c in range(12)] + [line(e, 2, 150, 1, "99") for e in (1, 2)]
    found, _ = bounded(spark, rows, depth=11)
    first = found.filter("tipo = 'CLIENTE' and posicao = 1").first()
    assert (first.id_item, float(first.valor), first.recalculado) == (150, 198.0, True)


def test_no_companies_or_no_sales_give_an_empty_list(spark):
    assert bounded(spark, [line(1, 2, 5, 1, "10")], 10, companies=())[0].isEmpty()
    assert bounded(spark, [], 10)[0].isEmpty()


def test_lists_of_sellers_are_drawn_where_their_totals_lie(spark, plan):
    """Lines are moved once to their seller's slice of the month; a code that repeats or lacks a name counts as often."""
    lines = spark.createDataFrame(
        [(date(2026, 2, 3), 1, 1, 5, 7, Decimal(4), Decimal(1)), (date(2026, 2, 4), None, 1, 5, 8, Decimal(2), Decimal(0)),
         (date(2026, 2, 5), 1, 2, 6, None, Decimal(9), Decimal(0))],
        "data_ref date, codemp bigint, codvend bigint, codparc bigint, codprod bigint, vlrtot decimal(15,2), vlrdesc decimal(20,4)")
    partners = spark.createDataFrame([(5, "Loja"), (5, "Loja"), (9, "Outra")], "codparc bigint, nomeparc string")
    products = spark.createDataFrame([(7, "Bolt", 3, "M"), (8, "Nut", None, None)], "codprod bigint, descrprod string, codmarca bigint, marca string")
    totals = item_totals(lines, partners, products)
    assert {(r.codemp, r.codvend, r.tipo, r.id_item, r.label_item, r.valor) for r in totals.collect()} == {
        (1, 1, "CLIENTE", 5, "Loja", Decimal(6)), (None, 1, "CLIENTE", 5, "Loja", Decimal(4)), (1, 1, "PRODUTO", 7, "Bolt", Decimal(3)),
        (None, 1, "PRODUTO", 8, "Nut", Decimal(2)), (1, 1, "MARCA", 3, "M", Decimal(3)), (None, 1, "MARCA", 0, "SEM MARCA", Decimal(2))}
    text = plan(rankings(lines, partners, products, SalesRules(), levels=(0, 2)))
    above = text[:text.index("Exchange")]
    assert "Expand" not in text and "Window" in above and above.count("Aggregate") >= 2
