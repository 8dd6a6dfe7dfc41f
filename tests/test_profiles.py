"""Profiles against a plain-Python brute force, and the lookups' edge cases."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest

from cyclemart.config import SalesRules
from cyclemart.operators import profiles as P
from cyclemart.operators.levels import ALL_LEVELS, COMPANY, DETAIL, GLOBAL, SELLER
from cyclemart.schemas import TABLES

RULES = SalesRules()
LINE = ("data_ref date, codemp bigint, codvend bigint, codparc bigint, codprod bigint, vlrtot decimal(15,2), vlrdesc decimal(20,4)")
PRODUCTS = [(i, f"produto {i}", i % 3 or None, f"m{i % 3}" if i % 3 else None, f"r{i}", None) for i in range(1, 13)]
SELLERS = [(1, "Ana"), (2, "Bia"), (3, "Ana"), (4, "Caio"), (5, "Davi")]  # two share a name


def month_end(day):
    return (day.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(900):
        client = 1 if rng.random() < 0.34 else rng.randint(2, 9)  # one client has a third of the rows
        rows.append((date(2026, 1, 1) + timedelta(days=rng.randint(0, 300)), rng.randint(1, 2), rng.randint(1, 5), client,
                     rng.randint(1, 12), Decimal(rng.randint(1, 40)), Decimal(0)))
    ranked = [(m, c) for m in (date(2026, 2, 1), date(2026, 7, 1), date(2026, 10, 1)) for c in (1, 2, 5, 77)]
    return rows, ranked


def frames(spark, data):
    rows, ranked = data
    return (
        spark.createDataFrame(rows, LINE), spark.createDataFrame(ranked, "dtref date, id_item bigint"),
        spark.createDataFrame(SELLERS, "codvend bigint, apelido string"),
        spark.createDataFrame(PRODUCTS, "codprod bigint, descrprod string, codmarca bigint, marca string, refforn string, compldesc string"),
    )


def expected_customers(data, as_of=None):
    rows, ranked = data
    names = dict(SELLERS)
    out = {}
    for month, client in ranked:
        end = min(month_end(month), as_of) if as_of else month_end(month)
        groups = defaultdict(list)
        for day, company, seller, c, product, value, _ in rows:
            if c == client and end - timedelta(days=180) <= day <= end:
                for level, emp, vend in ((GLOBAL, 0, 0), (COMPANY, company, 0), (SELLER, 0, seller), (DETAIL, company, seller)):
                    groups[level, emp, vend].append((day, names[seller], product, value))
        for (level, emp, vend), found in groups.items():
            by_product, by_seller = defaultdict(Decimal), defaultdict(Decimal)
            for _, seller, product, value in found:
                by_product[product] += value
                by_seller[seller] += value
            days = sorted({f[0] for f in found})
            gap = (days[-1] - days[0]).days / (len(days) - 1) if len(days) > 1 else 0.0
            out[month, level, client, emp, vend] = (
                [(f"produto {p}", v, f"r{p}", "") for p, v in sorted(by_product.items(), key=lambda x: (-x[1], x[0]))[:5]],
                [(n, v) for n, v in sorted(by_seller.items(), key=lambda x: (-x[1], x[0]))[:3]],
                gap,
            )
    return out


@pytest.mark.parametrize("as_of", [None, date(2026, 10, 12)])
def test_customer_profiles(spark, data, as_of):
    lines, ranked, sellers, products = frames(spark, data)
    df = P.customer_profiles(P.purchase_days(lines, sellers, products, ranked), ranked, products, RULES, as_of)
    found = {
        (r.dtref, r.nivel, r.id_cliente, r.id_empresa, r.id_vendedor):
            ([tuple(e) for e in r.top_produtos], [tuple(e) for e in r.top_vendedores], r.tempo_medio_compra)
        for r in df.collect()
    }
    assert found == expected_customers(data, as_of)


def test_gaps_alone_equal_the_profiles_gaps(spark, data):
    lines, ranked, sellers, products = frames(spark, data)
    df = P.repurchase_gaps(P.purchase_days(lines, sellers, products), ranked, RULES)
    found = {(r.dtref, r.nivel, r.codparc, r.codemp, r.codvend): r.tempo_medio_compra for r in df.collect()}
    assert found == {k: v[2] for k, v in expected_customers(data).items()}


def test_brand_profiles(spark, data):
    lines, _, _, products = frames(spark, data)
    ranked = [(date(2026, 3, 1), b) for b in (0, 1, 2)] + [(date(2026, 4, 1), 2)]
    df = P.brand_profiles(lines, spark.createDataFrame(ranked, "dtref date, id_item bigint"), products, RULES)
    expected = defaultdict(lambda: defaultdict(Decimal))
    for day, company, seller, _, product, value, _ in data[0]:
        key = (day.replace(day=1), product % 3)
        if key in set(ranked):
            for level, emp, vend in ((GLOBAL, 0, 0), (COMPANY, company, 0), (SELLER, 0, seller), (DETAIL, company, seller)):
                expected[(*key, level, emp, vend)][product] += value
    found = {(r.dtref, r.id_marca, r.nivel, r.id_empresa, r.id_vendedor): [(e.nome, e.valor) for e in r.top_produtos] for r in df.collect()}
    assert found == {k: [(f"produto {p}", v) for p, v in sorted(t.items(), key=lambda x: (-x[1], x[0]))[:5]] for k, t in expected.items()}


def test_unknown_products_and_sellers_drop_out(spark):
    rows = [(date(2026, 2, 3), 1, 1, 1, 1, Decimal(5), Decimal(0)), (date(2026, 2, 9), 1, 99, 1, 1, Decimal(5), Decimal(0)),
            (date(2026, 2, 20), 1, 1, 1, 99, Decimal(5), Decimal(0))]
    lines, ranked, sellers, products = frames(spark, (rows, [(date(2026, 2, 1), 1)]))
    row = P.customer_profiles(P.purchase_days(lines, sellers, products, ranked), ranked, products, RULES, levels=(GLOBAL,)).collect()
    assert len(row) == 1 and row[0].tempo_medio_compra == 0.0 and len(row[0].top_produtos) == 1


def stored_profile(spark):
    return spark.createDataFrame(
        [(5, 0, 0, [("Caneta ", Decimal(9), "", ""), ("lapis", Decimal(3), "X", "")], [("Ana", Decimal(12))], Decimal("2.50"), GLOBAL, date(2026, 2, 1))],
        TABLES["fato_cliente_perfil"].schema)


def test_customer_lookup_falls_back(spark):
    requests = spark.createDataFrame(
        [(date(2026, 2, 1), c, GLOBAL, 0, 0) for c in (5, 6, 7)],
        "dtref date, id_cliente bigint, nivel int, id_empresa bigint, id_vendedor bigint")
    partners = spark.createDataFrame([(6, "Loja 6")], "id_parceiro bigint, nome_parceiro string")
    found = {r.id_cliente: r for r in P.lookup_customer_profiles(requests, stored_profile(spark), partners).collect()}
    assert found[5].nome_cliente == "Cliente #5" and len(found[5].top_produtos) == 2 and found[5].tempo_medio_compra == 2.5
    assert found[6].nome_cliente == "Loja 6" and found[6].top_produtos == [] and found[6].top_vendedores == []
    assert found[7].nome_cliente == "Cliente #7" and found[7].tempo_medio_compra == 0.0


def test_brand_lookup_falls_back(spark):
    profile = spark.createDataFrame([(2, 0, 0, [("a", Decimal(1), "", "")], GLOBAL, date(2026, 2, 1))], TABLES["fato_marca_perfil"].schema)
    requests = spark.createDataFrame([(date(2026, 2, 1), b, GLOBAL, 0, 0) for b in (2, 3)],
                                     "dtref date, id_marca bigint, nivel int, id_empresa bigint, id_vendedor bigint")
    brands = spark.createDataFrame([(2, "Boa")], "id_marca bigint, nome_marca string")
    found = {r.id_marca: (r.nome_marca, len(r.top_produtos)) for r in P.lookup_brand_profiles(requests, profile, brands).collect()}
    assert found == {2: ("Boa", 1), 3: ("Marca #3", 0)}


def test_enrichment_prefers_a_reference_and_keeps_own_values(spark):
    products = spark.createDataFrame(
        [(1, "caneta", "", "sem ref"), (2, "CANETA", "R2", "azul"), (3, "Caneta", "R3", "preta"), (4, " LAPIS", "R4", "hb")],
        "id_produto bigint, nome_produto string, refforn string, complemento string")
    entries = P.listed(stored_profile(spark), "top_produtos", ("id_cliente",))
    found = {r.posicao: (r.refforn, r.complemento) for r in P.enrich_entries(entries, products).collect()}
    assert found == {1: ("R2", "azul"), 2: ("X", "hb")}


def test_share_and_json(spark):
    profile = stored_profile(spark)
    entries = P.with_share(P.listed(profile, "top_produtos", ("id_cliente",)), ("id_cliente",))
    assert sorted(round(r.percentual, 4) for r in entries.collect()) == [33.3333, 100.0]
    text = P.lists_to_json(profile)
    assert text.first().top_produtos.startswith('[{"nome":"Caneta "')
    assert P.lists_from_json(text, profile.schema).collect() == profile.collect()
    assert P.lists_from_json(profile, profile.schema).collect() == profile.collect()


def test_ranked_items_leave_out_customers_without_id(spark):
    ranks = spark.createDataFrame([("CLIENTE", 0), ("CLIENTE", 4), ("CLIENTE", 4), ("MARCA", 0)], "tipo string, id_item bigint")
    ranks = ranks.selectExpr("*", "date'2026-02-01' as dtref")
    assert [r.id_item for r in P.ranked_items(ranks, "CLIENTE").collect()] == [4]
    assert [r.id_item for r in P.ranked_items(ranks, "MARCA").collect()] == [0]
    assert len(ALL_LEVELS) == 4


def test_lookups_complete_what_lists_lack(spark):
    entry = "array<struct<nome:string,valor:decimal(15,2),refforn:string,complemento:string>>"
    keys = "dtref date, id_marca bigint, nivel int, id_empresa bigint, id_vendedor bigint"
    m, v = date(2026, 3, 1), Decimal("1.00")
    lists = [
        (m, 1, 3, 0, 0, [(" Bolt", v, "", "own"), ("Nut", v, None, None), ("Unknown", v, "", None)]),
        (m, 2, 3, 0, 0, [("Bolt", v, "x", "y")]), (m, 3, 3, 0, 0, []), (m, 4, 3, 0, 0, None)]
    found = spark.createDataFrame(lists, f"{keys}, top_produtos {entry}")
    products = spark.createDataFrame([(1, "BOLT ", "", "c1"), (2, "bolt", "r2", "c2"), (3, "nut", "r3", "")], "id_produto bigint, nome_produto string, refforn string, complemento string")
    brands = spark.createDataFrame([(1, "one")], "id_marca bigint, nome_marca string")
    asked = found.select("dtref", "id_marca", "nivel", "id_empresa", "id_vendedor").union(spark.createDataFrame([(m, 9, 3, 0, 0)], keys))
    got = {r.id_marca: (r.nome_marca, [tuple(e) for e in r.top_produtos]) for r in P.lookup_brand_profiles(asked, found, brands, products).collect()}
    assert got == {1: ("one", [(" Bolt", v, "r2", "own"), ("Nut", v, "r3", ""), ("Unknown", v, "", "")]), 2: ("Marca #2", [("Bolt", v, "x", "y")]),
                   3: ("Marca #3", []), 4: ("Marca #4", []), 9: ("Marca #9", [])}


def test_profiles_are_drawn_in_the_partition_of_the_customers_month(spark, plan, data):
    """One shuffle by month and customer, then lists and gaps without another; a product named twice is listed twice and
    sales without a company count where companies are rolled up only."""
    lines, ranked, sellers, products = frames(spark, data)
    text = plan(P.customer_profiles(P.purchase_days(lines, sellers, products, ranked), ranked, products, RULES))
    above = text[:text.index("Exchange")]
    assert "Expand" not in text and "Window" in above and above.count("Aggregate") >= 2 and "Join" not in above
    rows = [(date(2026, 2, 3), None, 1, 1, 1, Decimal(5), Decimal(0)), (date(2026, 2, 9), None, 1, 1, 1, Decimal(2), Decimal(0))]
    lines, ranked, sellers, products = frames(spark, (rows, [(date(2026, 2, 1), 1)]))
    twice = products.union(products.filter("codprod = 1"))
    found = P.customer_profiles(P.purchase_days(lines, sellers, twice, ranked), ranked, twice, RULES).collect()
    assert {(r.nivel, r.id_vendedor, r.tempo_medio_compra, len(r.top_produtos)) for r in found} == {(SELLER, 1, 6.0, 2), (GLOBAL, 0, 6.0, 2)}
    text = plan(P.brand_profiles(lines, ranked, products, RULES, levels=(DETAIL, SELLER)))
    assert "Expand" not in text and "Window" in text[:text.index("Exchange")]
