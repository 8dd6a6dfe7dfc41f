"""Totals that increments are added to, and the KPI cube."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cyclemart.operators import cube, partials
from cyclemart.operators import performance as K
from cyclemart.operators.daily import daily_actuals
from cyclemart.plans import loads
from cyclemart.session import materialise, working_path
from cyclemart.sources.increments import FOLD, Increments
from cyclemart.sources.retail import RETAIL_RULES, RetailSource
from cyclemart.sources.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "tipo_mov string, nunota long, data_ref date, codemp long, codvend long, vlrtot decimal(15,2), vlrdesc decimal(19,4), vlrcus decimal(15,2), qtdneg decimal(15,2)"


def movements(spark, n, seed):
    r = random.Random(seed)
    days = [date(2026, 3, 5), date(2026, 3, 6), date(2026, 4, 1)]
    rows = [(r.choice("VVVDC"), r.choice([1, 2, 63, 64, 65, -1, -64, 10**12, r.randint(0, 300)]), r.choice(days), r.randint(1, 2), r.randint(1, 2),
             Decimal(r.randint(1, 999)), Decimal(r.randint(0, 9)), Decimal(r.randint(1, 50)), Decimal(r.randint(1, 3))) for _ in range(n)]
    return spark.createDataFrame(rows, COLUMNS)


def totals(df):
    names = ("data_ref", "codemp", "codvend", *partials.SUMS, "qtd_transacoes")
    return sorted(tuple(float(r[c] or 0) if c not in names[:3] else r[c] for c in names) for r in df.collect())


def test_partials_of_increments_add_up(spark):
    parts = [movements(spark, 120, k) for k in range(3)]
    merged = partials.merge_partials(*[partials.partial_actuals(p) for p in parts])
    whole = parts[0].union(parts[1]).union(parts[2])
    assert totals(partials.actuals_of(merged)) == totals(daily_actuals(whole))
    again = partials.merge_partials(partials.merge_partials(partials.partial_actuals(parts[0]), partials.partial_actuals(parts[1])), partials.partial_actuals(parts[2]))
    assert totals(partials.actuals_of(again)) == totals(daily_actuals(whole))
    assert partials.actuals_of(partials.partial_actuals(whole.limit(0))).isEmpty()


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, working_path(spark, "test-increments")).create()


def test_replays_and_broken_folds_count_once(spark, warehouse):
    source = RetailSource(spark, FOLDER)
    lines = materialise(source.movements((date(1998, 2, 20), date(1998, 3, 10))), "lines")
    part = F.pmod(F.xxhash64("nunota", "codprod", "vlrtot"), F.lit(2))
    store = Increments(warehouse)
    assert store.names() == []
    for k in (0, 1, 1):
        store.add(f"lote-{k}", lines.filter(part == k), source)
    expected = totals(daily_actuals(lines))
    assert sorted(store.names()) == ["lote-0", "lote-1"] and totals(partials.actuals_of(store.read())) == expected
    # A fold that broke off after its rows were written counts for nothing.
    store._write(store.read(), f"{FOLD}broken")
    assert totals(partials.actuals_of(store.read())) == expected
    store.fold()
    assert len(store.names()) == 1 and totals(partials.actuals_of(store.read())) == expected
    # What a fold holds stays hidden, even if it is written again.
    store.add("lote-1", lines.filter(part == 1), source)
    assert len(store.names()) == 1 and totals(partials.actuals_of(store.read())) == expected
    store.add("lote-2", lines.limit(0), source)
    store.fold()
    assert totals(partials.actuals_of(store.read())) == expected
    march = totals(partials.actuals_of(store.read(["1998-03"])))
    assert march == [r for r in expected if r[0].month == 3]
    fact = loads.build_fact(source, (date(1998, 2, 20), date(1998, 3, 10))).filter("id_empresa > 0").select(*warehouse.fact().columns)
    stored = warehouse.fact().filter("id_empresa > 0")
    assert fact.exceptAll(stored).isEmpty() and stored.exceptAll(fact).isEmpty()


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_the_cube_follows_the_loads(spark, warehouse):
    source = RetailSource(spark, FOLDER)
    loads.sync_dimensions(warehouse, source)
    loads.load_range(warehouse, source, date(1998, 1, 10), date(1998, 4, 10), with_rankings=False)
    cycles = warehouse.read("dim_tempo_ref")
    before = {f for f in warehouse.read("cubo_kpi").inputFiles() if "1998-02-01" in f}
    loads.load_range(warehouse, source, date(1998, 3, 1), date(1998, 3, 20), with_rankings=False, replace_days=True)
    assert before <= set(warehouse.read("cubo_kpi").inputFiles())  # cycles that were not touched keep their files
    stored = warehouse.read("cubo_kpi")
    assert same(cube.cube_rows(warehouse.fact(), cycles), stored)
    sellers = warehouse.read("dim_vendedor")
    for company, ids in ((None, None), (1, None), ([1, 2], None), ([], None), (None, [3, 5])):
        answer = K.performance(warehouse.fact(), sellers, RETAIL_RULES, cycles=cycles, company=company, seller_ids=ids)
        assert same(answer.cards, cube.cards(stored, sellers, cycles, RETAIL_RULES, company, ids))
        assert same(answer.ranking, cube.ranking(stored, sellers, RETAIL_RULES, company, ids))
        sold = K.selling_days(answer.daily).filter("dias_com_venda > 0")
        assert same(sold, cube.selling_days(stored, sellers, company, ids).filter("dias_com_venda > 0"))
    read = cube.cards(stored, sellers, cycles, RETAIL_RULES).inputFiles()
    assert any("/cubo_kpi/" in f for f in read) and not any("/fato_vendasdiarias/" in f for f in read)


def test_cycles_too_long_for_the_cube_are_refused(spark):
    fact = spark.createDataFrame([(date(2026, 6, 1), 1, 1) + (Decimal(1),) * 7 + (1,)],
                                 "id_tempo date, id_vendedor long, id_empresa long, valor_meta_diaria decimal(15,2), valor_meta_mensal decimal(15,2), "
                                 "valor_realizado decimal(15,2), valor_devolucao decimal(15,2), valor_cancelado decimal(15,2), valor_comissao decimal(15,2), "
                                 "valor_desconto decimal(15,2), qtd_transacoes long")
    cycles = spark.createDataFrame([(date(2026, 3, 1), date(2026, 1, 1), date(2026, 12, 31))], "dtref date, dtinic date, dtfin date")
    with pytest.raises(Exception, match="more than 64 days"):
        cube.cube_rows(fact, cycles).collect()
