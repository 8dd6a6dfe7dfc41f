"""Range loads, the daily run and the stream, on a small copy of the retail tables."""

import shutil
from datetime import date, timedelta

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cyclemart.operators.constraints import line_rules
from cyclemart.plans import loads
from cyclemart.session import materialise, working_path
from cyclemart.sources.retail import RetailSource
from cyclemart.sources.warehouse import Warehouse
from cyclemart.streaming.late import late_days
from cyclemart.streaming.refresh import day_ranges, item_stream, refresh_batch, refresh_headers, start_refresh, touched_days, within_bound

FOLDER = "/root/testdata/sf0.001"
START, END = date(1998, 2, 1), date(1998, 3, 31)


@pytest.fixture(scope="module")
def source(spark):
    return RetailSource(spark, FOLDER)


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, working_path(spark, "test-load")).create()


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_period_build_equals_the_whole_build_in_the_period(source):
    whole = loads.build_fact(source).filter(F.col("id_tempo").between(F.lit(START), F.lit(END)))
    assert same(loads.build_fact(source, (START, END)), whole)


def test_range_load(source, warehouse):
    result = loads.load_range(warehouse, source, START, END)
    assert same(warehouse.fact(), loads.build_fact(source, (START, END)))
    assert warehouse.read("dim_tempo").count() == 59
    assert {r.situacao: r.dias for r in result.summary.collect()} == {"carregado": 59}
    months = {r.dtref for r in warehouse.read("fato_rankings").select("dtref").distinct().collect()}
    assert months == {date(1998, 2, 1), date(1998, 3, 1)}
    whole = loads.build_rankings(source).filter(F.col("dtref").isin(*months))
    assert same(warehouse.read("fato_rankings"), whole)
    assert {r.dtref for r in warehouse.read("fato_cliente_perfil").select("dtref").distinct().collect()} == months
    before = {t: warehouse.read(t).count() for t in ("fato_vendasdiarias", "fato_rankings", "fato_cliente_perfil", "fato_marca_perfil")}
    loads.load_range(warehouse, source, START, END)
    assert {t: warehouse.read(t).count() for t in before} == before


def test_rankings_of_an_open_month_stop_at_the_last_day(source, warehouse):
    loads.load_range(warehouse, source, date(1998, 3, 1), date(1998, 3, 10))
    expected = loads.build_rankings(source, (date(1998, 3, 1), date(1998, 3, 10)))
    assert same(warehouse.read("fato_rankings"), expected)


def test_a_load_that_ends_inside_a_loaded_month_keeps_its_lists_whole(source, warehouse):
    loads.load_range(warehouse, source, date(1998, 3, 1), date(1998, 3, 31))
    names = ("fato_rankings", "fato_cliente_perfil", "fato_marca_perfil")
    before = {n: materialise(warehouse.read(n), "before") for n in names}
    loads.load_range(warehouse, source, date(1998, 3, 1), date(1998, 3, 15))
    assert all(same(before[n], warehouse.read(n)) for n in names)


def test_daily_run_covers_look_back_and_look_ahead(source, warehouse):
    target = date(1998, 3, 20)
    loads.daily_run(warehouse, source, target)
    first, last = warehouse.fact().agg(F.min("id_tempo"), F.max("id_tempo")).first()
    assert (first, last) == (target - timedelta(days=60), target + timedelta(days=10))
    assert warehouse.read("dim_empresa").count() == 6 and warehouse.read("dim_tempo_ref").count() > 0
    loads.daily_run(warehouse, source, target + timedelta(days=11), reprocess=False)
    assert warehouse.fact().agg(F.max("id_tempo")).first()[0] == target + timedelta(days=11)


def test_days_without_rows_are_reported(source, warehouse):
    late = loads.load_range(warehouse, source, date(2002, 3, 1), date(2002, 3, 3), with_rankings=False)
    assert [r.situacao for r in late.days.collect()] == ["sem movimento"] * 3 and warehouse.fact().isEmpty()


@pytest.fixture
def growing(spark, tmp_path):
    """A source folder whose items arrive in several files."""
    for name in ("orders", "customer", "nation", "part", "supplier", "region"):
        shutil.copyfile(f"{FOLDER}/{name}.parquet", tmp_path / f"{name}.parquet")
    return RetailSource(spark, str(tmp_path))


def test_stream_of_several_batches_equals_the_batch_build(spark, growing, warehouse):
    items = spark.read.parquet(f"{FOLDER}/lineitem.parquet").filter("l_orderkey < 400")
    items.repartition(1).write.parquet(f"{growing.path}/lineitem.parquet")
    inbox = f"{growing.path}/inbox"
    items.repartition(3).write.parquet(inbox)
    state = working_path(spark, "state")
    for _ in range(2):  # a second start finds nothing new
        start_refresh(item_stream(spark, inbox, "*.parquet", files_per_batch=1), warehouse, growing, state).awaitTermination()
    days = touched_days(items, growing)
    expected = loads.build_fact(growing).join(days, "id_tempo", "left_semi")
    assert warehouse.fact().count() > 0 and same(warehouse.fact(), expected)


def test_item_files_added_later_reach_the_fact(spark, growing, warehouse):
    items = spark.read.parquet(f"{FOLDER}/lineitem.parquet").filter("l_orderkey < 400")
    whole = pq.read_table(f"{FOLDER}/lineitem.parquet", filters=[("l_orderkey", "<", 400)])
    odd = pc.equal(pc.bit_wise_and(whole["l_orderkey"], 1), 1)
    parts = whole.filter(pc.invert(odd)), whole.filter(odd)
    state = working_path(spark, "state")
    for part, name in zip(parts, ("lineitem", "lineitem-2"), strict=True):
        pq.write_table(part, f"{growing.path}/{name}.parquet")
        start_refresh(item_stream(spark, growing.path), warehouse, growing, state).awaitTermination()
    expected = loads.build_fact(growing).join(touched_days(items, growing), "id_tempo", "left_semi")
    assert same(warehouse.fact(), expected)
    assert growing.table("lineitem").count() == items.count()


def test_every_day_of_the_fact_is_in_a_cycle(source):
    fact = loads.build_fact(source)
    cycles = source.goal_cycles().select("dtref", F.explode(F.sequence("dtinic", "dtfin")).alias("id_tempo"))
    assert fact.join(cycles, "id_tempo", "left_anti").isEmpty()
    assert cycles.groupBy("id_tempo").count().where("count > 1").isEmpty()


def test_days_before_the_bound_are_reported_not_rebuilt(spark, source, warehouse):
    assert late_days(warehouse).isEmpty()
    items = source.table("lineitem").filter("l_orderkey < 100")
    touched = touched_days(items, source)
    since = date(1998, 1, 1)
    for _ in range(2):  # a replay notes the same days once
        refresh_batch(warehouse, source, since)(items, 0)
    assert same(late_days(warehouse).select("id_tempo"), touched.filter(F.col("id_tempo") < F.lit(since)))
    expected = loads.build_fact(source).join(within_bound(touched, since), "id_tempo", "left_semi")
    assert same(warehouse.fact(), expected) and not expected.isEmpty()
    # Another run, of a new stream or of the headers, adds its days and takes none away.
    noted = {r.id_tempo for r in late_days(warehouse).collect()}
    more = source.table("lineitem").filter("l_orderkey BETWEEN 100 AND 150")
    refresh_batch(warehouse, source, since)(more, 0)
    extra = {r.id_tempo for r in touched_days(more, source).collect() if r.id_tempo < since}
    assert {r.id_tempo for r in late_days(warehouse).collect()} == noted | extra and extra - noted
    # A load that covers days takes them off the list.
    loads.load_range(warehouse, source, date(1996, 1, 1), date(1996, 12, 31), with_rankings=False)
    assert {r.id_tempo for r in late_days(warehouse).collect()} == {d for d in noted | extra if d.year != 1996}


def test_scattered_days_are_read_by_their_months(spark):
    def ranges(*days):
        return day_ranges(spark.createDataFrame([(date.fromisoformat(d),) for d in days], "id_tempo date"))

    assert ranges("1995-01-02", "1998-03-05", "1998-03-20", "1998-04-01") == [(date(1995, 1, 2), date(1995, 1, 2)), (date(1998, 3, 5), date(1998, 4, 1))]
    many = ranges(*[f"{1990 + k}-0{1 + k % 3}-15" for k in range(9)], "1998-12-31")
    assert len(many) == 6 and many[0][0] == date(1990, 1, 15) and many[-1][1] == date(1998, 12, 31)



def test_changed_headers_touch_their_days(spark, growing, warehouse):
    items = spark.read.parquet(f"{FOLDER}/lineitem.parquet").filter("l_orderkey < 400")
    items.repartition(1).write.parquet(f"{growing.path}/lineitem.parquet")
    refresh_headers(warehouse, growing)  # notes the headers
    refresh_batch(warehouse, growing)(items, 0)
    before = warehouse.fact().agg(F.sum("valor_cancelado")).first()[0]
    orders = pq.read_table(f"{FOLDER}/orders.parquet")
    cancelled = pc.if_else(pc.less(orders["o_orderkey"], 100), "P", orders["o_orderstatus"])
    pq.write_table(orders.set_column(orders.schema.get_field_index("o_orderstatus"), "o_orderstatus", cancelled), f"{growing.path}/orders.parquet")
    refresh_headers(warehouse, growing)
    expected = loads.build_fact(growing).join(touched_days(items, growing), "id_tempo", "left_semi")
    assert same(expected, warehouse.fact().join(touched_days(items, growing), "id_tempo", "left_semi"))
    assert warehouse.fact().agg(F.sum("valor_cancelado")).first()[0] > before
    refresh_headers(warehouse, growing)  # nothing changed, nothing happens
    assert same(expected, warehouse.fact().join(touched_days(items, growing), "id_tempo", "left_semi"))


def damaged(spark, source, condition):
    path = working_path(spark, "test-damaged")
    worse = F.when(F.expr(condition), -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    source.table("lineitem").withColumn("l_quantity", worse).write.parquet(path)
    return RetailSource(spark, FOLDER, files={"lineitem": path})


def test_a_damaged_day_leaves_the_others_loaded(spark, source, warehouse):
    first = loads.load_range(warehouse, source, START, END, with_rankings=False, rules=line_rules())
    assert first.rejected is None and {r.situacao for r in first.summary.collect()} == {"carregado"}
    before = materialise(warehouse.fact(), "before")
    bad = damaged(spark, source, "l_orderkey % 50 = 0")
    again = loads.load_range(warehouse, bad, START, END, with_rankings=False, rules=line_rules())
    failed = {r.id_tempo for r in again.days.filter("situacao = 'falhou'").collect()}
    expected = {r.data_ref for r in bad.movements((START, END)).filter("qtdneg <= 0").collect()}
    assert failed == expected and 0 < len(failed) < 59
    # Failed days keep what was stored of them, and nothing else changed.
    assert same(warehouse.fact(), before)
    stored = spark.read.parquet(warehouse.path(loads.REJECTS))
    assert {r.id_tempo for r in stored.collect()} == expected and {tuple(r.regras) for r in stored.collect()} == {("quantidade positiva",)}
    refused = stored.count()
    loads.load_range(warehouse, bad, START, END, with_rankings=False, rules=line_rules())
    assert spark.read.parquet(warehouse.path(loads.REJECTS)).count() == refused > 0
    loads.load_range(warehouse, source, START, END, with_rankings=False, rules=line_rules())
    assert not warehouse.exists(f"{warehouse.path(loads.REJECTS)}/inicio={START}/fim={END}") and same(warehouse.fact(), before)


def test_nulls_are_refused_before_anything_is_written(spark, source, warehouse):
    rows = materialise(loads.build_fact(source, (START, START)), "rows")
    warehouse.upsert("fato_vendasdiarias", rows)
    before = materialise(warehouse.fact(), "before")
    for column in ("valor_comissao", "qtd_transacoes", "id_vendedor"):
        broken = rows.withColumn(column, F.when(F.col("id_empresa") > 0, F.col(column)))
        for write in (warehouse.upsert, warehouse.load):
            with pytest.raises(Exception, match=f"{column} is null"):
                write("fato_vendasdiarias", broken)
    assert same(warehouse.fact(), before)
