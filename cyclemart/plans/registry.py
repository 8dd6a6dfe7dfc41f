"""Every query by name. Each takes (spark, data folder) and returns a DataFrame over whole tables.

Source-level queries are lazy plans over the source tables. Report queries read the stored
warehouse tables, as the dashboards do.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclemart.functions import text
from cyclemart.functions.calendar import working_days
from cyclemart.functions.predicates import any_movement
from cyclemart.operators import access as A
from cyclemart.operators import constraints, cube, daily, dimensions, goals, performance, profiles, quality, reports
from cyclemart.operators import rankings as R
from cyclemart.operators.levels import COMPANY, GLOBAL
from cyclemart.plans import loads
from cyclemart.plans.present import present
from cyclemart.plans.stored import stored
from cyclemart.schemas import FACT_MEASURES, TABLES
from cyclemart.session import materialise, tune, working_path
from cyclemart.sources import documents
from cyclemart.sources.increments import Increments
from cyclemart.sources.retail import RETAIL_RULES, RetailSource
from cyclemart.sources.warehouse import Warehouse
from cyclemart.streaming import ledger
from cyclemart.streaming.late import late_days, note_late
from cyclemart.streaming.ledger import Landing
from cyclemart.streaming.refresh import item_stream, refresh_headers, start_refresh

Query = Callable[[SparkSession, str], DataFrame]
RULES = RETAIL_RULES
REFERENCE_CYCLE = date(1998, 3, 1)
CYCLE_START, CYCLE_END = date(1998, 2, 26), date(1998, 3, 25)
RELOAD_FROM, RELOAD_TO = date(1998, 1, 1), date(1998, 6, 30)
FIRST_LOAD_END = date(1998, 3, 31)

USERS = {
    "admin": A.User("ADMIN"),
    "manager": A.User("MANAGER", companies=(1, 2)),
    "stranded": A.User("MANAGER"),
    "seller": A.User("SELLER", seller_id=3),
    "unknown": A.User("GUEST"),
}

QUERIES: dict[str, Query] = {}


def query(build: Callable[[RetailSource], DataFrame]) -> Callable:
    """Register a builder under its function name."""
    def run(spark: SparkSession, path: str) -> DataFrame:
        return present(build(RetailSource(tune(spark), path)))

    QUERIES[build.__name__] = run
    return build


def _fact(src: RetailSource) -> DataFrame:
    return stored(src.spark, src.path, "fato_vendasdiarias").fact()


def _table(src: RetailSource, name: str) -> DataFrame:
    return stored(src.spark, src.path, name).read(name)


def _sellers(src: RetailSource) -> DataFrame:
    return dimensions.seller_rows(src.sellers())


def _cycles(src: RetailSource) -> DataFrame:
    return _table(src, "dim_tempo_ref")


def _kpis(src: RetailSource, **request) -> performance.Performance:
    return performance.performance(_fact(src), _sellers(src), RULES, cycles=_cycles(src), **request)


def _cards(src: RetailSource, company=None, seller_ids=None) -> DataFrame:
    return cube.cards(_table(src, cube.CUBE), _sellers(src), _cycles(src), RULES, company, seller_ids)


def _ranking(src: RetailSource, company=None) -> DataFrame:
    return cube.ranking(_table(src, cube.CUBE), _sellers(src), RULES, company)


def _totals(src: RetailSource) -> DataFrame:
    return cube.totals(_table(src, cube.CUBE), _sellers(src))


def _derived(src: RetailSource) -> DataFrame:
    days = cube.selling_days(_table(src, cube.CUBE), _sellers(src))
    return performance.derived_kpis(_cards(src), days, _cycles(src), RULES)


# sources to daily totals ----------------------------------------------------------------------

@query
def sales_daily(src):
    return daily.daily_sales(src.sales(cost=True))


@query
def returns_daily(src):
    return daily.daily_returns(src.returns())


@query
def cancels_daily(src):
    return daily.daily_cancels(src.cancels())


@query
def movements_daily(src):
    return daily.daily_actuals(src.movements()).select(
        *daily.DAY_KEYS, *[F.coalesce(c, F.lit(0)).alias(c) for c in (
            "vlr_nota", "vlr_desconto", "qtd_transacoes", "vlr_devolucao", "vlr_cancelada")]
    )


@query
def erp_movements(src):
    """The orders as ERP documents of mixed operations and fiscal states; cancelled ones lie in tables of their own and
    count from the day after in the cancel log, if it names them."""
    key = F.col("o_orderkey")
    sale, other_sale, back = RULES.sale_operations[0], RULES.sale_operations[1], RULES.return_operations[0]
    orders = src.table("orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    headers = orders.select(
        key.alias("nunota"), F.col("o_orderdate").alias("dtentsai"), (F.col("o_orderstatus") == "P").alias("_excluida"),
        F.when(key % 4 == 0, sale).when(key % 4 == 1, other_sale).when(key % 4 == 2, back).otherwise(1).alias("codtipoper"),
        F.when(key % 7 == 0, "D").otherwise(RULES.approved_status).alias("statusnfe"),
    )
    live, excluded = headers.filter("NOT _excluida").drop("_excluida"), headers.filter("_excluida").drop("_excluida")
    log = orders.filter((F.col("o_orderstatus") == "P") & (key % 3 == 0)).select(
        key.alias("nunota"), F.date_add(F.to_date("o_orderdate"), 1).alias("dtneg"))
    price, rate = F.col("l_extendedprice").cast("decimal(15,2)"), F.col("l_discount").cast("decimal(4,2)")
    items = src.table("lineitem", "l_orderkey", "l_extendedprice", "l_discount").select(
        F.col("l_orderkey").alias("nunota"), price.alias("vlrtot"), (price * rate).alias("vlrdesc"))
    return documents.movements(live, items, log, excluded, items, RULES).groupBy("data_ref", "tipo_mov").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum(F.col("vlrtot") - F.col("vlrdesc")).alias("valor"))


@query
def goals_by_day(src):
    found = goals.goals_by_day(src.goal_sellers(), src.goal_cycles(), src.sellers(), RULES)
    return found.withColumn("meta_diaria", goals.daily_goal(F.col("meta_mensal"), F.col("dias_uteis"), F.col("dia_util")))


@query
def working_days_by_cycle(src):
    return src.goal_cycles().select(
        "dtref", "dtinic", "dtfin", working_days(F.col("dtinic"), F.col("dtfin"), RULES.holidays).alias("dias_uteis")
    )


@query
def calendar_spine(src):
    return performance.calendar_spine(_cycles(src), RULES)


@query
def fact_daily(src):
    return loads.build_fact(src).drop("ano_mes")


@query
def fact_period(src):
    """The fact of one cycle, from period-pruned scans."""
    return loads.build_fact(src, (CYCLE_START, CYCLE_END)).drop("ano_mes")


# dimensions -----------------------------------------------------------------------------------

@query
def dim_time(src):
    return dimensions.time_rows(_fact(src)).drop("nome_mes", "dia_da_semana")


@query
def dim_seller(src):
    return dimensions.seller_rows(src.sellers()).select("id_vendedor", "nome_comercial")


@query
def dim_company(src):
    return dimensions.company_rows(src.companies())


@query
def dim_customer(src):
    return dimensions.partner_rows(src.partners())


@query
def dim_brand(src):
    return dimensions.brand_rows(src.products())


@query
def dim_product(src):
    return dimensions.product_rows(src.products())


@query
def dim_cycle(src):
    return dimensions.cycle_rows(src.goal_cycles())


# rankings -------------------------------------------------------------------------------------

RANK_COLUMNS = ("dtref", "nivel", "id_empresa", "id_vendedor", "posicao", "id_item", "label_item", "valor")


@query
def rank_customers(src):
    return loads.build_rankings(src, kinds=(R.CUSTOMER,)).select(*RANK_COLUMNS)


@query
def rank_brands(src):
    return loads.build_rankings(src, kinds=(R.BRAND,)).select(*RANK_COLUMNS)


@query
def rank_products(src):
    return loads.build_rankings(src, kinds=(R.PRODUCT,)).select(*RANK_COLUMNS)


@query
def rankings_all(src):
    return loads.build_rankings(src).select("tipo", *RANK_COLUMNS)


def _lookup(src, **request):
    return R.ranking_lookup(
        _table(src, "fato_rankings"), dimensions.product_rows(src.products()), RULES, **request
    )


@query
def rank_lookup(src):
    return _lookup(src, company=1)


@query
def rank_lookup_seller(src):
    return _lookup(src, company=1, seller=3, dtref=REFERENCE_CYCLE)


@query
def rank_multi_branch(src):
    return _lookup(src, company=[1, 2])


@query
def rank_multi_branch_exact(src):
    """The same two companies, from their sales instead of their stored lists."""
    return R.rankings_of_companies(src.sales(), src.partners(), src.products(), RULES, [1, 2])


@query
def rank_multi_branch_bounded(src):
    """The same again, from the companies' deep lists, and from sales only where their cut-offs leave it open."""
    lists = _table(src, "listas_empresa")
    return R.rankings_of_companies_bounded(lists, [1, 2], RULES, src.sales, src.partners(), src.products())


@query
def rank_totals(src):
    """Sum of every stored list, of all levels."""
    return R.ranking_totals(_table(src, "fato_rankings"), ("dtref", "nivel", "id_empresa", "id_vendedor", "tipo"))


# profiles -------------------------------------------------------------------------------------

DIMENSIONS = {
    "dim_tempo_ref": ("dtref", "label"), "dim_vendedor": ("id_vendedor", "nome_comercial"), "dim_empresa": ("id_empresa", "nome"),
    "dim_parceiro": ("id_parceiro", "nome_parceiro"), "dim_marca": ("id_marca", "nome_marca"), "dim_produto": ("id_produto", "nome_produto"),
}
CUSTOMER_KEYS = ("dtref", "nivel", "id_cliente", "id_empresa", "id_vendedor")
BRAND_KEYS = ("dtref", "nivel", "id_marca", "id_empresa", "id_vendedor")
ENTRY = ("posicao", "nome", "valor", "refforn", "complemento")


@query
def customer_profile(src):
    """Profile lists, one row per entry."""
    found = loads.build_customer_profiles(src, profiles.ranked_items(_table(src, "fato_rankings"), R.CUSTOMER))
    return _both_lists(found, *CUSTOMER_KEYS, "tempo_medio_compra")


def _both_lists(found: DataFrame, *columns: str) -> DataFrame:
    """Customer profiles with a row per entry of either list, or one of null entries where both are empty."""
    lists = F.concat(
        F.transform("top_produtos", lambda e, i: F.struct(
            F.lit("PRODUTO").alias("lista"), (i + 1).alias("posicao"), e["nome"].alias("nome"),
            e["valor"].alias("valor"), e["refforn"].alias("refforn"), e["complemento"].alias("complemento"))),
        F.transform("top_vendedores", lambda e, i: F.struct(
            F.lit("VENDEDOR").alias("lista"), (i + 1).alias("posicao"), e["nome"].alias("nome"),
            e["valor"].alias("valor"), F.lit("").alias("refforn"), F.lit("").alias("complemento"))),
    )
    return found.select(*columns, F.inline_outer(lists))


@query
def repurchase_gap(src):
    ranked = profiles.ranked_items(_table(src, "fato_rankings"), R.CUSTOMER)
    days = profiles.purchase_days(src.sales(), src.sellers(), src.products(), ranked)
    return profiles.repurchase_gaps(days, ranked, RULES).select(
        "dtref", "nivel", F.col("codparc").alias("id_cliente"), F.col("codemp").alias("id_empresa"),
        F.col("codvend").alias("id_vendedor"), "tempo_medio_compra",
    )


@query
def brand_profile(src):
    found = loads.build_brand_profiles(src, profiles.ranked_items(_table(src, "fato_rankings"), R.BRAND))
    return profiles.listed(found, "top_produtos", BRAND_KEYS)


def _requests(stored_profiles: DataFrame, items: DataFrame, item: str) -> DataFrame:
    """Every stored key, of all cycles, levels, companies and sellers, and every item overall in one cycle."""
    keys = ("dtref", "nivel", item, "id_empresa", "id_vendedor")
    everywhere = items.select(F.lit(REFERENCE_CYCLE).alias("dtref"), F.lit(GLOBAL).alias("nivel"), item,
                              F.lit(0).cast("bigint").alias("id_empresa"), F.lit(0).cast("bigint").alias("id_vendedor"))
    return stored_profiles.select(*keys).union(everywhere).distinct()


def _without_details(stored_profiles: DataFrame, some: Column) -> DataFrame:
    """Profiles as older loads stored them: some with entries that lack reference or complement."""
    plain = F.transform("top_produtos", lambda e, i: F.struct(
        e["nome"].alias("nome"), e["valor"].alias("valor"), F.when(i % 2 == 0, F.lit("")).otherwise(e["refforn"]).alias("refforn"),
        F.when(i % 3 == 0, F.lit(None)).otherwise(e["complemento"]).alias("complemento")))
    return stored_profiles.withColumn("top_produtos", F.when(some, plain).otherwise(F.col("top_produtos")))


@query
def profile_lookup_customer(src):
    """Every stored customer profile and, in one cycle, every customer: those without a profile get the defaults. Entries
    that lack product details are completed by name."""
    partners = dimensions.partner_rows(src.partners())
    found = _without_details(_table(src, "fato_cliente_perfil"), F.col("id_cliente") % 2 == 0)
    requests = _requests(found, partners.withColumnRenamed("id_parceiro", "id_cliente"), "id_cliente")
    looked = profiles.lookup_customer_profiles(requests, found, partners, dimensions.product_rows(src.products()))
    return _both_lists(looked, *CUSTOMER_KEYS, "nome_cliente", "tempo_medio_compra")


@query
def profile_lookup_brand(src):
    """Every stored brand profile and, in one cycle, every brand, with details completed by name."""
    brands = dimensions.brand_rows(src.products())
    found = _without_details(_table(src, "fato_marca_perfil"), F.col("id_marca") % 2 == 0)
    looked = profiles.lookup_brand_profiles(
        _requests(found, brands, "id_marca"), found, brands, dimensions.product_rows(src.products()))
    entries = F.transform("top_produtos", lambda e, i: F.struct((i + 1).alias("posicao"), *[e[c].alias(c) for c in ENTRY[1:]]))
    return looked.select(*BRAND_KEYS, "nome_marca", F.inline_outer(entries))


@query
def product_enrich(src):
    """Brand lists of all levels stored without product details, completed by product name."""
    plain = src.products(plain_name=True)
    bare = plain.withColumns({"refforn": F.lit(None).cast("string"), "compldesc": F.lit(None).cast("string")})
    ranked = profiles.ranked_items(_table(src, "fato_rankings"), R.BRAND)
    lists = profiles.brand_profiles(src.sales(), ranked, bare, RULES)
    found = profiles.enrich_entries(profiles.listed(lists, "top_produtos", BRAND_KEYS), dimensions.product_rows(plain))
    return found.select(*BRAND_KEYS, *ENTRY, text.subtitle(F.col("refforn"), F.col("complemento")).alias("subtitulo"))


@query
def profile_share(src):
    entries = profiles.listed(_table(src, "fato_cliente_perfil"), "top_produtos", CUSTOMER_KEYS)
    return profiles.with_share(entries, CUSTOMER_KEYS).select(
        *CUSTOMER_KEYS, "posicao", "nome", "valor", "percentual",
        text.subtitle(F.col("refforn"), F.col("complemento")).alias("subtitulo"),
    )


@query
def json_roundtrip(src):
    """Both lists of every profile to JSON text and back."""
    original = _table(src, "fato_cliente_perfil")
    as_text = profiles.lists_to_json(original)
    return _both_lists(profiles.lists_from_json(as_text, original.schema), *CUSTOMER_KEYS)


# lists ----------------------------------------------------------------------------------------

@query
def companies(src):
    return performance.companies(_fact(src))


@query
def active_sellers(src):
    scoped = performance.scope_cycles(_fact(src), _cycles(src))
    return performance.active_sellers(scoped, _sellers(src))


@query
def active_sellers_company(src):
    scoped = performance.scope_cycles(_fact(src), _cycles(src))
    return performance.seller_options(performance.active_sellers(scoped, _sellers(src), company=[1, 2]))


@query
def cycles(src):
    return performance.cycle_options(_cycles(src))


# KPIs of every cycle --------------------------------------------------------------------------

@query
def daily_performance(src):
    return _kpis(src).daily


@query
def seller_stats(src):
    rows = performance.eligible(performance.scope_cycles(_fact(src), _cycles(src)), _sellers(src))
    return performance.seller_stats(performance.seller_totals(rows), performance.latest_rates(_fact(src), RULES))


@query
def goal_total(src):
    rows = performance.eligible(performance.scope_cycles(_fact(src), _cycles(src)), _sellers(src))
    return performance.goal_total(performance.seller_totals(rows))


@query
def latest_rate(src):
    return performance.latest_rates(_fact(src), RULES)


@query
def kpi_summary(src):
    return _cards(src)


@query
def kpi_by_seller(src):
    """Realised value and goal of every seller in every cycle."""
    return _totals(src).withColumn("meta_vendedor", F.coalesce("meta_vendedor", F.lit(0)))


@query
def top5_sellers(src):
    return _ranking(src)


@query
def kpi_company(src):
    return _cards(src, company=1)


@query
def kpi_company_daily(src):
    return _kpis(src, company=[1, 2]).daily


@query
def kpi_company_top5(src):
    return _ranking(src, company=[2, 3])


@query
def kpi_no_company(src):
    """An empty company list matches nothing."""
    return _cards(src, company=[])


@query
def kpi_sellers(src):
    return _cards(src, seller_ids=[3, 5, 8])


@query
def kpi_two_cycles(src):
    """Seller totals of two cycles, which are chosen by the query: only the months they touch are read."""
    chosen = _cycles(src).filter(F.col("dtref").isin(REFERENCE_CYCLE, RELOAD_FROM))
    rows = performance.eligible(performance.scope_cycles(_fact(src), chosen), _sellers(src))
    return performance.seller_totals(rows).withColumn("meta_vendedor", F.coalesce("meta_vendedor", F.lit(0)))


@query
def kpi_half_period(src):
    """A period with one bound only is no filter: every day of the fact counts."""
    rows = performance.scope_period(_fact(src), REFERENCE_CYCLE, None)
    return performance.seller_totals(rows).withColumn("meta_vendedor", F.coalesce("meta_vendedor", F.lit(0)))


@query
def kpi_period(src):
    """One period, read from the month partitions that hold it."""
    warehouse = stored(src.spark, src.path, "fato_vendasdiarias")
    rows = performance.eligible(
        performance.scope_period(warehouse.fact(CYCLE_START, CYCLE_END), CYCLE_START, CYCLE_END, REFERENCE_CYCLE),
        _sellers(src),
    )
    rates = performance.latest_rates(warehouse.fact(RULES.rate_floor), RULES)
    return performance.kpi_cards(performance.seller_totals(rows), rates, RULES)


@query
def kpi_derived(src):
    return _derived(src)


@query
def kpi_texts(src):
    return performance.kpi_texts(_derived(src))


@query
def commission_tiers(src):
    return performance.commission_tiers(_totals(src), cube.latest_rates(_table(src, cube.CUBE), RULES), RULES)


@query
def chart_daily(src):
    return performance.chart_days(_cards(src), _kpis(src).daily, _cycles(src), RULES)


@query
def cycle_summary(src):
    return performance.cycle_summary(_derived(src))


# access ---------------------------------------------------------------------------------------

def _kpis_for(src: RetailSource, user: str, seller: int | None = None) -> DataFrame:
    scope = A.kpi_scope(USERS[user], seller=seller)
    company = scope.company if isinstance(scope.company, (int, type(None))) else list(scope.company)
    return _cards(src, company=company, seller_ids=scope.seller_ids)


@query
def access_admin(src):
    return _kpis_for(src, "admin")


@query
def access_manager(src):
    return _kpis_for(src, "manager")


@query
def access_seller(src):
    return _kpis_for(src, "seller")


@query
def access_unknown(src):
    return _kpis_for(src, "unknown")


@query
def access_denied_seller(src):
    """Realised value and goal that three users read of one seller: an administrator, a manager of companies, and a
    manager without any, who reads nothing."""
    found = [_kpis_for(src, user, seller=3).select(F.lit(user).alias("usuario"), "dtref", "realizado", "meta")
             for user in ("admin", "manager", "stranded")]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def access_ranking(src):
    """A manager who asks for a company outside the managed ones gets those instead."""
    scope = A.ranking_scope(USERS["manager"], company=4)
    return _lookup(src, company=list(scope.company), seller=scope.seller_ids[0])


@query
def access_profile(src):
    """The same manager's brand profiles fall back to the first managed company."""
    scope = A.profile_scope(USERS["manager"], company=4)
    found = _table(src, "fato_marca_perfil").filter(
        (F.col("nivel") == COMPANY) & (F.col("id_empresa") == scope.company) & (F.col("id_vendedor") == scope.seller_ids[0])
    )
    return profiles.listed(found, "top_produtos", ("dtref", "id_marca", "id_empresa")).drop("refforn", "complemento")


@query
def access_seller_list(src):
    scoped = performance.scope_cycles(_fact(src), _cycles(src))
    return A.allowed_sellers(performance.active_sellers(scoped, _sellers(src)), USERS["seller"])


def _policies(src: RetailSource) -> DataFrame:
    """One manager per pair of companies, the last of them inactive, and one login per seller."""
    managers = src.companies().select(
        F.concat(F.lit("gerente"), F.col("codemp").cast("string")).alias("username"), F.lit("manager").alias("role"),
        F.lit(None).cast("int").alias("seller_id"),
        F.array(F.col("codemp").cast("int"), (F.col("codemp") % 5 + 1).cast("int")).alias("managed_sellers"),
        F.when(F.col("codemp") == 5, F.lit(False)).alias("is_active"),
    )
    logins = src.sellers().select(
        F.concat(F.lit("vendedor"), F.col("codvend").cast("string")).alias("username"), F.lit("SELLER").alias("role"),
        F.col("codvend").cast("int").alias("seller_id"), F.lit(None).cast("array<int>").alias("managed_sellers"),
        F.lit(True).alias("is_active"),
    )
    return managers.unionByName(logins)


@query
def policy_view(src):
    """What readers of every role see of one view: an administrator, managers, one of them inactive, a seller and a stranger."""
    chief = src.spark.sql("SELECT 'chefe' AS username, 'admin' AS role, CAST(NULL AS INT) AS seller_id, CAST(NULL AS ARRAY<INT>) AS managed_sellers, CAST(NULL AS BOOLEAN) AS is_active")
    view = A.session_view(_fact(src), chief.unionByName(_policies(src)), "fato_permitido")
    found = []
    for reader in ("chefe", "gerente1", "gerente5", "vendedor3", "ninguem"):
        A.set_reader(src.spark, reader)
        rows = src.spark.table(view).groupBy("ano_mes").agg(F.sum("valor_realizado").alias("realizado"), F.count(F.lit(1)).alias("linhas"))
        # Read while the session has this reader.
        found.append(materialise(rows.select(F.lit(reader).alias("username"), "ano_mes", "realizado", "linhas"), "policy-view"))
    A.set_reader(src.spark, None)
    return reduce(DataFrame.unionByName, found)


@query
def policy_rows(src):
    """Realised value that each manager and seller may read, all users in one join."""
    by_month = _fact(src).groupBy("ano_mes", "id_empresa", "id_vendedor").agg(F.sum("valor_realizado").alias("valor"))
    return A.policy_rows(by_month, _policies(src)).groupBy("username", "ano_mes").agg(
        F.sum("valor").alias("realizado"), F.count(F.lit(1)).alias("linhas")
    )


# texts ----------------------------------------------------------------------------------------

@query
def report_formats(src):
    """Money, compact money, percentage and count texts for every seller and cycle."""
    rows = performance.eligible(performance.scope_cycles(_fact(src), _cycles(src)), _sellers(src))
    totals = performance.seller_totals(rows)
    reached = performance.attainment(F.col("v_realizado"), F.coalesce("meta_vendedor", F.lit(0)))
    return totals.select(
        "dtref", "id_vendedor",
        text.brl(F.col("v_desconto")).alias("dinheiro"),
        text.brl_compact(F.col("v_realizado")).alias("compacto"),
        text.percent(reached * 100).alias("percentual"),
        text.ticket_count(F.col("v_tkts")).alias("transacoes"),
    )


# writes ---------------------------------------------------------------------------------------

def _new_warehouse(src: RetailSource, label: str) -> Warehouse:
    return Warehouse(src.spark, working_path(src.spark, label))


@query
def upsert_fact(src):
    """A first load whose returns had not been booked yet, then the complete rows of a later range
    merged over it: known keys replaced, new keys added, the rest kept."""
    warehouse = _new_warehouse(src, "upsert").create("fato_vendasdiarias")
    full = materialise(loads.build_stored_fact(src), "fact")
    early = full.filter(F.col("id_tempo") <= F.lit(FIRST_LOAD_END)).withColumn(
        "valor_devolucao", F.lit(0).cast("decimal(15,2)")
    )
    warehouse.load("fato_vendasdiarias", early)
    change = full.filter(F.col("id_tempo") >= F.lit(RELOAD_FROM))
    warehouse.upsert("fato_vendasdiarias", change)
    warehouse.upsert("fato_vendasdiarias", change)
    return warehouse.read("fato_vendasdiarias").drop("ano_mes")


@query
def upsert_rankings(src):
    """A month that shrinks leaves no stale tail: full lists first, then lists of three."""
    warehouse = _new_warehouse(src, "rankings").create("fato_rankings")
    lists = materialise(loads.build_rankings(src), "ranks")
    warehouse.load("fato_rankings", lists)
    recent = lists.filter(F.col("dtref") >= F.lit(RELOAD_FROM))
    warehouse.replace_months("fato_rankings", recent.filter("posicao <= 3"))
    return warehouse.read("fato_rankings").select("tipo", *RANK_COLUMNS)


@query
def scd1_upsert(src):
    """Customers in credit, then customers with a finished order merged over them under new names:
    old names are lost, new customers added, the others kept."""
    rows = dimensions.partner_rows(src.partners())
    code = (F.col("c_custkey") + 1).alias("id_parceiro")
    in_credit = src.table("customer", "c_custkey", "c_acctbal").filter("c_acctbal >= 5000").select(code)
    finished = src.table("orders", "o_custkey", "o_orderstatus").filter("o_orderstatus = 'F'").select(
        (F.col("o_custkey") + 1).alias("id_parceiro")
    )
    before = rows.join(in_credit, "id_parceiro", "left_semi")
    after = rows.join(finished, "id_parceiro", "left_semi").withColumn(
        "nome_parceiro", F.concat("nome_parceiro", F.lit(" (novo)"))
    )
    warehouse = _new_warehouse(src, "scd1").create("dim_parceiro")
    warehouse.upsert("dim_parceiro", before)
    warehouse.upsert("dim_parceiro", after)
    return warehouse.read("dim_parceiro")


@query
def dimension_sync(src):
    """All six dimensions loaded with other names for every second id, then synchronised: new names replace old ones, missing
    ids are added, and an id the source does not have stays."""
    warehouse = _new_warehouse(src, "dimensions").create(*DIMENSIONS)
    rows = loads.dimension_rows(src)
    for name, (key, label) in DIMENSIONS.items():
        old = rows[name].filter(F.pmod(F.xxhash64(key), F.lit(2)) == 0).withColumn(label, F.lit("antes"))
        gone = rows[name].limit(0).unionByName(src.spark.range(1).select(*[
            F.lit(date(1900, 1, 1) if c == "dtref" else "-1").cast(rows[name].schema[c].dataType).alias(c) if c == key
            else F.lit(None).cast(rows[name].schema[c].dataType).alias(c) for c in rows[name].columns]))
        warehouse.load(name, old.unionByName(gone))
    loads.sync_dimensions(warehouse, src)
    found = [warehouse.read(name).select(F.lit(name).alias("tabela"), F.col(key).cast("string").alias("id"), F.col(label).alias("nome"))
             for name, (key, label) in DIMENSIONS.items()]
    return reduce(DataFrame.unionByName, found)


@query
def upsert_profiles(src):
    """Brand profiles of a first load with one product each, then later months merged over them in the warehouse."""
    found = _table(src, "fato_marca_perfil")
    warehouse = _new_warehouse(src, "brand-profiles").create("fato_marca_perfil")
    early = found.filter(F.col("dtref") < F.lit(RELOAD_TO))
    warehouse.load("fato_marca_perfil", early.withColumn("top_produtos", F.slice("top_produtos", 1, 1)))
    warehouse.upsert("fato_marca_perfil", found.filter(F.col("dtref") >= F.lit(RELOAD_FROM)))
    return profiles.listed(warehouse.read("fato_marca_perfil"), "top_produtos", BRAND_KEYS)


@query
def upsert_customer_profiles(src):
    """Customer profiles of a first load with one product each, then later months merged over them in the warehouse."""
    found = _table(src, "fato_cliente_perfil")
    warehouse = _new_warehouse(src, "profiles").create("fato_cliente_perfil")
    early = found.filter(F.col("dtref") < F.lit(RELOAD_TO))
    warehouse.load("fato_cliente_perfil", early.withColumn("top_produtos", F.slice("top_produtos", 1, 1)))
    warehouse.upsert("fato_cliente_perfil", found.filter(F.col("dtref") >= F.lit(RELOAD_FROM)))
    return _both_lists(warehouse.read("fato_cliente_perfil"), *CUSTOMER_KEYS)


@query
def insert_days(src):
    """Days of a first load under a name of their own, then all days: known days stay as they are."""
    days = dimensions.time_rows(_fact(src))
    warehouse = _new_warehouse(src, "days").create("dim_tempo")
    early = days.filter(F.col("id_tempo") <= F.lit(FIRST_LOAD_END)).withColumn("nome_mes", F.lit("primeira carga"))
    warehouse.insert_missing("dim_tempo", early)
    warehouse.insert_missing("dim_tempo", days)
    return warehouse.read("dim_tempo").select("id_tempo", "mes", "nome_mes")


@query
def quality_report(src):
    warehouse = stored(src.spark, src.path, "fato_vendasdiarias", "fato_rankings", "fato_cliente_perfil", "fato_marca_perfil")
    fact, ranks, brands = warehouse.fact(), warehouse.read("fato_rankings"), warehouse.read("fato_marca_perfil")
    lines = src.movements()
    return quality.quality_report(
        quality.duplicate_keys(fact, ("id_tempo", "id_vendedor", "id_empresa"), "chave unica do fato"),
        quality.duplicate_keys(ranks, ("dtref", "nivel", "id_vendedor", "id_empresa", "tipo", "posicao"),
                               "chave unica do ranking"),
        quality.missing_parents(fact, _sellers(src), "id_vendedor", "vendedor sem dimensao"),
        quality.duplicate_keys(brands, TABLES["fato_marca_perfil"].keys, "chave unica do perfil de marca"),
        quality.duplicate_keys(warehouse.read("fato_cliente_perfil"), TABLES["fato_cliente_perfil"].keys,
                               "chave unica do perfil de cliente"),
        quality.null_values(warehouse.read("fato_vendasdiarias", defaults=False),
                            FACT_MEASURES, "medidas nulas"),
        quality.failing_rows(lines, {"quantidade positiva": F.col("qtdneg") > 0, "valor nao negativo": daily.net_value() >= 0}),
        quality.failing_rows(src.goal_cycles(), {"mes entre 1 e 12": (F.col("codmetavenda") % 100).between(1, 12)}),
        quality.failing_rows(fact, {"meta so na empresa 0": ~((F.col("id_empresa") > 0) & (F.col("valor_meta_diaria") != 0))}),
        quality.duplicate_keys(src.table("lineitem", "l_orderkey", "l_linenumber"), ("l_orderkey", "l_linenumber"),
                               "item repetido na origem"),
    )


@query
def backfill_range(src):
    """A range recomputed into an empty warehouse, then once more: the second run changes nothing."""
    warehouse = _new_warehouse(src, "backfill").create()
    loads.load_range(warehouse, src, RELOAD_FROM, RELOAD_TO, with_rankings=False)
    loads.load_range(warehouse, src, RELOAD_FROM, RELOAD_TO, with_rankings=False, replace_days=True)
    return warehouse.fact(RELOAD_FROM, RELOAD_TO).drop("ano_mes")


@query
def backfill_status(src):
    """Rows and state of each day of a range that runs past the data."""
    warehouse = _new_warehouse(src, "status").create("fato_vendasdiarias", "dim_tempo")
    return loads.load_range(
        warehouse, src, date(2001, 9, 1), date(2002, 1, 31), with_rankings=False
    ).days


@query
def stream_refresh(src):
    """Goals loaded first, then the items in three sets of new files, by shipping date. The headers of one quarter are first
    known a day early and as open, and are put right before the last set. Ends equal to the batch fact."""
    spark = src.spark
    warehouse = _new_warehouse(src, "stream").create("fato_vendasdiarias")
    no_actuals = src.movements().filter(F.lit(False))
    warehouse.load("fato_vendasdiarias", loads.build_stored_fact(src, no_actuals), placed=True)

    folder, state = working_path(spark, "stream-source"), working_path(spark, "stream-state")
    inbox, headers = f"{folder}/items", f"{folder}/orders"
    growing = RetailSource(spark, src.path, src.rules, files={"lineitem": inbox, "orders": headers})
    items, orders = src.table("lineitem"), src.table("orders")
    shipped = F.to_date("l_shipdate")
    first, last = items.agg(F.min(shipped), F.max(shipped)).first()
    cuts = [first + (last - first) / 3, first + 2 * (last - first) / 3]
    part = F.when(shipped < F.lit(cuts[0]), 0).when(shipped < F.lit(cuts[1]), 1).otherwise(2)

    early = F.to_date("o_orderdate").between(F.lit(cuts[0]), F.lit(cuts[0] + timedelta(days=90)))
    orders.withColumns({
        "o_orderstatus": F.when(early, F.lit("O")).otherwise(F.col("o_orderstatus")),
        "o_orderdate": F.when(early, F.col("o_orderdate") - F.expr("interval 1 day")).otherwise(F.col("o_orderdate")),
    }).write.parquet(headers)
    refresh_headers(warehouse, growing)
    for k in range(3):
        items.filter(part == k).write.mode("append").parquet(inbox)
        if k == 2:
            orders.write.mode("overwrite").parquet(headers)
            refresh_headers(warehouse, growing)
        start_refresh(item_stream(spark, inbox, "*.parquet"), warehouse, growing, state).awaitTermination()
    return warehouse.read("fato_vendasdiarias").drop("ano_mes")


def _landed_months(src: RetailSource) -> tuple[DataFrame, DataFrame]:
    """Headers and items as they land, once a month. One document in five has a header before, with another day and as open;
    one in 97 gets its header ninety days late, one in 61 half a year late, if it is older than 400 days. The items of one in 31
    come seventy days late."""
    key = F.col("o_orderkey")
    old = F.to_date("o_orderdate") < F.date_sub(F.lit(src.span()[1]), 400)
    orders = src.table("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    ordered = F.to_date("o_orderdate")

    def month_after(day):
        return F.add_months(F.trunc(day, "month"), 1)

    final = orders.withColumn("carga", month_after(F.date_add(ordered, F.when(key % 97 == 0, 90).when((key % 61 == 0) & old, 180).otherwise(0))))
    early = orders.filter((key % 5 == 0) & ((key % 61 != 0) | ~old)).withColumns({
        "o_orderstatus": F.lit("O"), "o_orderdate": F.col("o_orderdate") - F.expr("interval 1 day"), "carga": F.trunc(ordered, "month")})
    items = src.table("lineitem", *ledger.ITEM_COLUMNS).join(orders.select(key.alias("l_orderkey"), ordered.alias("_dia")), "l_orderkey")
    arrival = month_after(F.date_add("_dia", F.when(F.col("l_orderkey") % 31 == 0, 70).otherwise(F.col("l_linenumber"))))
    # The given line numbers repeat within a document.
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ledger.ITEM_COLUMNS[1:]))
    return final.unionByName(early), items.withColumn("carga", arrival).withColumn("l_linenumber", number).drop("_dia")


@query
def load_quarantine(src):
    """A range whose source holds lines of negative quantity and lines without a value: their days fail and leave the others
    loaded. State of each day, rows stored for it, and lines refused."""
    path = working_path(src.spark, "damaged")
    key = F.col("l_orderkey")
    src.table("lineitem").withColumns({
        "l_quantity": F.when(key % 499 == 0, -F.col("l_quantity")).otherwise(F.col("l_quantity")),
        "l_extendedprice": F.when(key % 503 == 0, F.lit(None)).otherwise(F.col("l_extendedprice")),
    }).write.parquet(path)
    damaged = RetailSource(src.spark, src.path, src.rules, files={"lineitem": path})
    warehouse = _new_warehouse(src, "quarantine").create()
    found = loads.load_range(warehouse, damaged, RELOAD_FROM, RELOAD_TO, with_rankings=False, rules=constraints.line_rules())
    per_day = warehouse.read("fato_vendasdiarias").groupBy("id_tempo").agg(F.count(F.lit(1)).alias("gravadas"))
    days = found.days.join(per_day, "id_tempo", "left")
    if found.rejected is None:
        days = days.withColumn("rejeitadas", F.lit(0))
    else:
        days = days.join(found.rejected.groupBy("id_tempo").agg(F.count(F.lit(1)).alias("rejeitadas")), "id_tempo", "left")
    return days.select("id_tempo", "situacao", F.coalesce("gravadas", F.lit(0)).alias("gravadas"), F.coalesce("rejeitadas", F.lit(0)).alias("rejeitadas"))


@query
def increments_merged(src):
    """Lines in three increments, those of one document in several, added to a fact that holds goals only. The first two are
    folded into one, the last is replayed. Ends equal to the batch fact, distinct tickets included."""
    warehouse = _new_warehouse(src, "increments").create("fato_vendasdiarias")
    lines = materialise(src.movements(), "increment-lines")
    warehouse.load("fato_vendasdiarias", loads.build_stored_fact(src, lines.filter(F.lit(False))), placed=True)
    increments = Increments(warehouse)
    part = F.pmod(F.xxhash64("nunota", "codprod", "vlrtot"), F.lit(3))
    for k in (0, 1, 2, 2):
        increments.add(f"lote-{k}", lines.filter(part == k), src)
        if k == 1:
            increments.fold()
    return warehouse.read("fato_vendasdiarias").drop("ano_mes")


#: Streamed warehouses, one per application and data folder: the two queries below look at the same run.
_streamed: dict[tuple[str, str], tuple[Warehouse, Landing]] = {}


def _streamed_late(src: RetailSource) -> tuple[Warehouse, Landing]:
    key = (src.spark.sparkContext.applicationId, src.path)
    if key not in _streamed:
        _streamed[key] = stream_landed(src)
    return _streamed[key]


def stream_landed(src: RetailSource, cuts: tuple[float, ...] = (0.6,), new_state: bool = False) -> tuple[Warehouse, Landing]:
    """Files land in parts, neighbouring months in exchanged order, and are streamed into a fact that holds goals only.
    ``new_state`` starts the stream anew for every part."""
    warehouse = _new_warehouse(src, "ledger").create("fato_vendasdiarias")
    no_actuals = src.movements().filter(F.lit(False))
    warehouse.load("fato_vendasdiarias", loads.build_stored_fact(src, no_actuals), placed=True)
    folder = working_path(src.spark, "landing")
    landing = Landing(f"{folder}/headers", f"{folder}/items")
    first, last = (d.year * 12 + d.month for d in src.span())
    number = (F.year("carga") * 12 + F.month("carga")).bitwiseXOR(F.lit(1))
    bounds = [first - 2, *(int(first + (last - first) * c) for c in cuts), last + 12]
    tables = [materialise(t.withColumn("_numero", number), "landing-rows") for t in _landed_months(src)]
    for low, high in zip(bounds, bounds[1:], strict=False):
        for rows, path in zip(tables, (landing.headers, landing.items), strict=True):
            part = rows.filter((F.col("_numero") >= low) & (F.col("_numero") < high)).drop("_numero")
            part.repartition("carga").write.mode("append").partitionBy("carga").parquet(path)
        ledger.start(warehouse, src, landing, f"{folder}/state{low if new_state else ''}").awaitTermination()
    return warehouse, landing


@query
def stream_late(src):
    """Headers and items that land out of order, late, twice or months apart, streamed and settled: ends equal to the batch fact."""
    warehouse, landing = _streamed_late(src)
    noted = materialise(late_days(warehouse), "late-days")
    ledger.settle(warehouse, src, landing)
    note_late(warehouse, noted)
    return warehouse.read("fato_vendasdiarias").drop("ano_mes")


@query
def stream_late_days(src):
    """Days whose lines landed more than the look-back after them: noted by the stream, once each, for the nightly run."""
    return late_days(_streamed_late(src)[0])


# reports --------------------------------------------------------------------------------------

def _rows(src: RetailSource) -> DataFrame:
    return reports.sale_rows(src.movements())


@query
def ticket_row_avg(src):
    return reports.row_average(_rows(src))


@query
def sales_by_seller(src):
    return reports.sales_by_seller(_rows(src), _sellers(src))


@query
def perf_vs_goal(src):
    monthly = src.goal_sellers().join(src.goal_cycles(), "codmetavenda").select(
        F.col("dtref").alias("mes"), F.col("codvend").alias("id_vendedor"), F.col("vlrmetavendedor").alias("meta")
    )
    return reports.performance_vs_goal(_rows(src), monthly, _sellers(src))


@query
def cancel_rate(src):
    return reports.cancel_rate(_rows(src), _sellers(src))


@query
def current_month(src):
    rows = _rows(src)
    newest = src.table("orders", "o_orderdate").agg(F.trunc(F.max("o_orderdate"), "month").alias("m")).scalar()
    return reports.current_month(rows, _sellers(src), newest)


@query
def manager_semi(src):
    """Monthly totals of sellers active in the manager's companies, by semi join."""
    fact = _fact(src)
    mine = fact.filter(F.col("id_empresa").isin(*USERS["manager"].companies) & any_movement()).select("id_vendedor").distinct()
    return fact.filter("id_empresa > 0").join(mine, "id_vendedor", "left_semi").groupBy("ano_mes").agg(
        F.sum("valor_realizado").alias("realizado")
    )


@query
def conversion_rate(src):
    return reports.conversion_rate(src.table("events", "user_id", "event_type"), "signup", "purchase")


@query
def category_share(src):
    per_product = src.sales().groupBy("codprod").agg(F.sum(daily.net_value()).alias("valor"))
    by_category = per_product.join(src.products().select("codprod", "refforn"), "codprod").groupBy("refforn").agg(
        F.sum("valor").alias("valor")
    )
    return reports.share_of_all(by_category, "valor")


@query
def region_share(src):
    totals = _fact(src).filter("id_empresa > 0").groupBy("ano_mes", "id_empresa").agg(
        F.sum("valor_realizado").alias("valor")
    )
    return reports.share_of_total(totals, ("ano_mes",), "valor")


@query
def period_matrix(src):
    return reports.period_matrix(_rows(src))


@query
def ticket_vs_cancel(src):
    """Average ticket against cancellation rate per seller: two aggregates joined."""
    rows = performance.eligible(performance.scope_cycles(_fact(src), _cycles(src)), _sellers(src))
    tickets = performance.seller_totals(rows).groupBy("id_vendedor").agg(
        F.sum("v_realizado").alias("realizado"), F.sum("v_tkts").alias("tkts"), F.sum("v_cancelado").alias("cancelado")
    )
    value = F.col("realizado").cast("double")
    lost = F.col("cancelado").cast("double")
    return tickets.select(
        "id_vendedor",
        F.coalesce(F.try_divide(value, F.col("tkts").cast("double")), F.lit(0.0)).alias("ticket_medio"),
        F.coalesce(F.try_divide(lost, value + lost), F.lit(0.0)).alias("parte_cancelada"),
    )


@query
def grain_day(src):
    return reports.by_grain(_fact(src), "day")


@query
def grain_month(src):
    return reports.by_grain(_fact(src), "month")


@query
def grain_quarter(src):
    return reports.by_grain(_fact(src), "quarter")


@query
def growth_delta(src):
    """Realised value of each company by cycle against the cycle before."""
    rows = performance.scope_cycles(_fact(src), _cycles(src)).filter("id_empresa > 0")
    totals = rows.groupBy("dtref", "id_empresa").agg(F.sum("valor_realizado").alias("realizado"))
    cycles = _cycles(src)
    follows = cycles.select("dtref", F.date_sub("dtinic", 1).alias("dtfin")).join(
        cycles.select("dtfin", F.col("dtref").alias("anterior")), "dtfin").drop("dtfin")
    return reports.growth(totals, ("id_empresa",), "dtref", "realizado", follows)
