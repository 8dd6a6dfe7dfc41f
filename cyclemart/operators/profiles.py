"""Customer and brand profiles at four roll-up levels, and their lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.config import SalesRules
from cyclemart.functions.calendar import month_start
from cyclemart.functions.text import clean, match_name
from cyclemart.operators.daily import net_value
from cyclemart.operators.levels import ALL_LEVELS, COMPANY, DETAIL, GLOBAL, SELLER, at_levels, month_slice, place, roll_up
from cyclemart.operators.rankings import BRAND, CUSTOMER, branded_products
from cyclemart.schemas import MONEY

LEVEL_KEYS = ("nivel", "codemp", "codvend")


def ranked_items(stored_rankings: DataFrame, kind: str) -> DataFrame:
    """(month, item) pairs that any ranking of the kind lists."""
    found = stored_rankings.filter(F.col("tipo") == kind)
    if kind == CUSTOMER:
        found = found.filter(F.col("id_item") > 0)
    return found.select("dtref", "id_item").distinct()


def purchase_days(lines: DataFrame, sellers: DataFrame, products: DataFrame, ranked: DataFrame | None = None) -> DataFrame:
    """Sales with company, customer, seller, product and day: the input of customer profiles. Sales of
    sellers or products that master data lacks drop out here, once for all lists.

    With ``ranked`` only customers of some ranking count. Spark moves that semi join below the item
    join, so items of other customers are dropped before they are shuffled on.
    """
    if ranked is not None:
        lines = lines.join(ranked.select(F.col("id_item").alias("codparc")).distinct(), "codparc", "left_semi")
    sales = lines.select("codemp", "codparc", "codvend", "codprod", "data_ref", net_value().alias("valor"))
    return sales.join(products.select("codprod"), "codprod", "left_semi").join(
        sellers.select("codvend", F.col("apelido").alias("vendedor")), "codvend"
    )


def _in_windows(days: DataFrame, ranked: DataFrame, rules: SalesRules, as_of: date | None) -> DataFrame:
    """Each row once per month that ranks its customer and whose trailing window holds its day. A
    month's window ends on its last processed day: the end of the month, or ``as_of`` in the month
    that is still open.

    A customer's ranked months travel as one list, so rows are shuffled to it once and multiplied
    afterwards. The list is no longer than the history has months. The rows come partitioned by month and, as ``fatia``, by
    slices of its customers: whatever is grouped by month and customer from there on needs no shuffle.
    """
    months = ranked.groupBy(F.col("id_item").alias("codparc")).agg(F.collect_set("dtref").alias("meses"))
    day = F.col("data_ref")
    latest = F.date_add(day, rules.profile_days)
    if as_of:
        latest = F.greatest(day, F.least(latest, F.lit(as_of)))
    anchor = F.least(F.last_day("dtref"), F.lit(as_of)) if as_of else F.last_day("dtref")
    candidates = F.sequence(month_start(day), month_start(latest), F.expr("interval 1 month"))
    return place(
        days.join(months, "codparc")
        .withColumn("dtref", F.explode(candidates))
        .filter(F.array_contains("meses", F.col("dtref")) & day.between(F.date_sub(anchor, rules.profile_days), anchor))
        .drop("meses")
        .withColumn("fatia", month_slice(days.sparkSession, F.col("codparc")))
    )


def _in_order(entries: Column, *names: str) -> Column:
    """Entries by position, without the position."""
    return F.transform(F.array_sort(entries), lambda e: F.struct(*[e[n].alias(n) for n in names]))


def _names(products: DataFrame) -> DataFrame:
    """``nomes`` by product: a name with its details for every row of the product. They join the sales, which are far fewer
    than the list entries of all levels."""
    return products.filter("codprod IS NOT NULL").groupBy("codprod").agg(F.collect_list(F.struct(
        F.col("descrprod").alias("nome"), clean(F.col("refforn")).alias("refforn"), clean(F.col("compldesc")).alias("complemento"),
    )).alias("nomes"))


def _product_entries(entries: Column) -> Column:
    """The product list of (posicao, total, nomes) entries."""
    named = F.flatten(F.transform(entries, lambda e: F.transform(e["nomes"], lambda n: F.struct(
        e["posicao"].alias("posicao"), n["nome"].alias("nome"), e["total"].cast(MONEY).alias("valor"),
        n["refforn"].alias("refforn"), n["complemento"].alias("complemento")))))
    return _in_order(named, "nome", "valor", "refforn", "complemento")


def mean_gap(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean days between consecutive purchase days: the gaps add up to last minus first. One
    purchase day gives 0. ``days`` holds each day once per key."""
    gaps = F.count(F.lit(1)) - 1
    span = F.datediff(F.max("data_ref"), F.min("data_ref"))
    return days.groupBy(*keys).agg(
        F.when(gaps > 0, span / gaps).otherwise(F.lit(0.0)).alias("tempo_medio_compra")
    )


def repurchase_gaps(days: DataFrame, ranked: DataFrame, rules: SalesRules, as_of: date | None = None,
                    levels: Sequence[int] = ALL_LEVELS) -> DataFrame:
    return _gaps(_in_windows(days, ranked, rules, as_of), levels)


def _gaps(transactions: DataFrame, levels: Sequence[int]) -> DataFrame:
    profile = ["dtref", "fatia", "codparc"]
    level_days = roll_up(transactions, [*profile, "data_ref"], [F.count(F.lit(1)).alias("linhas")], levels)
    return mean_gap(level_days, [*profile, *LEVEL_KEYS]).drop("fatia")


def customer_profiles(days: DataFrame, ranked: DataFrame, products: DataFrame, rules: SalesRules,
                      as_of: date | None = None, levels: Sequence[int] = ALL_LEVELS) -> DataFrame:
    """Top products, top sellers and mean repurchase gap of every ranked customer over the trailing
    window of each month. ``days`` comes from ``purchase_days``.

    A sale of a level counts for its product, its seller and its day. All three are added up, ranked and gathered side by
    side in the partition of the customer's month. Sellers are told apart by name: rolled-up levels merge those who share one.
    """
    transactions = _in_windows(days.join(_names(products), "codprod"), ranked, rules, as_of)
    keys = ["dtref", "fatia", "codparc", *LEVEL_KEYS]
    product, seller, day = 0, 1, 2

    def counted(kind: int, code: Column | None = None, name: Column | None = None, names: Column | None = None) -> Column:
        nothing = F.lit(None)
        return F.struct(F.lit(kind).alias("lista"), (nothing if code is None else code).cast("bigint").alias("codigo"),
                        (nothing if name is None else name).cast("string").alias("texto"),
                        (nothing if names is None else names).cast(transactions.schema["nomes"].dataType).alias("nomes"))

    totals = at_levels(transactions, levels).filter("codemp IS NOT NULL AND codvend IS NOT NULL").select(*keys, "valor", F.inline(F.array(
        counted(product, F.col("codprod"), names=F.col("nomes")), counted(seller, name=F.col("vendedor")),
        counted(day, F.unix_date("data_ref")),
    ))).groupBy(*keys, "lista", "codigo", "texto", "nomes").agg(F.sum("valor").alias("total"))
    best = Window.partitionBy(*keys, "lista").orderBy(F.desc("total"), F.asc("codigo"), F.asc("texto"))
    kept = totals.withColumn("posicao", F.row_number().over(best)).filter(
        (F.col("lista") == day) | (F.col("posicao") <= F.when(F.col("lista") == product, rules.profile_products).otherwise(rules.profile_sellers)))

    def of(kind: int, value: Column) -> Column:
        return F.when(F.col("lista") == kind, value)

    gaps = F.count(of(day, F.lit(1))) - 1
    span = F.max(of(day, F.col("codigo"))) - F.min(of(day, F.col("codigo")))
    gathered = kept.groupBy(*keys).agg(
        F.collect_list(of(product, F.struct("posicao", "total", "nomes"))).alias("_produtos"),
        F.collect_list(of(seller, F.struct("posicao", F.col("texto").alias("nome"), F.col("total").cast(MONEY).alias("valor")))).alias("_vendedores"),
        F.when(gaps > 0, span / gaps).otherwise(F.lit(0.0)).alias("tempo_medio_compra"),
    )
    return gathered.select(
        F.col("codparc").alias("id_cliente"),
        F.col("codemp").alias("id_empresa"),
        F.col("codvend").alias("id_vendedor"),
        _product_entries(F.col("_produtos")).alias("top_produtos"),
        _in_order(F.col("_vendedores"), "nome", "valor").alias("top_vendedores"),
        "tempo_medio_compra",
        "nivel",
        "dtref",
    )


def brand_profiles(lines: DataFrame, ranked: DataFrame, products: DataFrame, rules: SalesRules,
                   levels: Sequence[int] = ALL_LEVELS) -> DataFrame:
    """Top products of every ranked brand in each month.

    Lists of a seller are drawn in the seller's slice of the month; for the others products are added up per slice, moved to
    their product, and cut before they are moved to their list.
    """
    brands = branded_products(products).select("codprod", "codmarca").join(_names(products), "codprod")
    wanted = ranked.select("dtref", F.col("id_item").alias("codmarca"))
    branded = lines.select(
        month_start(F.col("data_ref")).alias("dtref"), "codemp", "codvend", "codprod", net_value().alias("valor")
    ).join(brands, "codprod").join(wanted, ["dtref", "codmarca"], "left_semi")
    placed = place(branded.withColumn("fatia", month_slice(lines.sparkSession, F.col("codvend"))))
    item, total, parts = ["codmarca", "codprod", "nomes"], [F.sum("valor").alias("total")], []

    def lists(rolled: DataFrame, *keys: str) -> DataFrame:
        group = [*keys, "codmarca", *LEVEL_KEYS]
        best = Window.partitionBy(*group).orderBy(F.desc("total"), F.asc("codprod"))
        top = rolled.withColumn("posicao", F.row_number().over(best)).filter(F.col("posicao") <= rules.profile_products)
        return top.groupBy(*group).agg(_product_entries(F.collect_list(F.struct("posicao", "total", "nomes"))).alias("top_produtos"))

    of_sellers = [level for level in levels if level in (DETAIL, SELLER)]
    of_all = [level for level in levels if level in (COMPANY, GLOBAL)]
    if of_sellers:
        parts.append(lists(roll_up(placed, ["dtref", "fatia", *item], total, of_sellers), "dtref", "fatia").drop("fatia"))
    if of_all:
        summed = placed.groupBy("dtref", "fatia", *item, "codemp").agg(F.sum("valor").alias("valor"))
        by_product = summed.drop("fatia").withColumn("codvend", F.lit(0).cast("bigint")).repartition("dtref", "codprod")
        parts.append(lists(roll_up(by_product, ["dtref", *item], total, of_all), "dtref"))
    return reduce(DataFrame.unionByName, parts).select(
        F.col("codmarca").alias("id_marca"),
        F.col("codemp").alias("id_empresa"),
        F.col("codvend").alias("id_vendedor"),
        "top_produtos",
        "nivel",
        "dtref",
    )


def listed(profiles: DataFrame, array: str, keys: Sequence[str]) -> DataFrame:
    """One row per list entry, with its position."""
    return profiles.select(*keys, F.posexplode(array).alias("_i", "_e")).select(
        *keys, (F.col("_i") + 1).alias("posicao"), "_e.*"
    )


def with_share(entries: DataFrame, profile_keys: Sequence[str]) -> DataFrame:
    """Each entry's value as a percentage of the largest in its list."""
    whole = F.max("valor").over(Window.partitionBy(*profile_keys)).cast("double")
    value = F.col("valor").cast("double")
    return entries.withColumn("percentual", F.when(whole != 0, value / whole * 100).otherwise(F.lit(0.0)))


def name_details(products: DataFrame) -> DataFrame:
    """Reference and complement per cleaned product name. Among products that share a name, one with
    a reference is preferred, then the lowest id."""
    cleaned = products.select(
        match_name(F.col("nome_produto")).alias("_nome"), "id_produto",
        clean(F.col("refforn")).alias("_refforn"), clean(F.col("complemento")).alias("_complemento"),
    )
    best = Window.partitionBy("_nome").orderBy((F.col("_refforn") == "").cast("int"), "id_produto")
    return cleaned.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r", "id_produto")


def enrich_entries(entries: DataFrame, products: DataFrame) -> DataFrame:
    """Fill blank references and complements of list entries from the product with the same name.
    Only products whose name is listed are looked at."""
    named = entries.withColumn("_nome", match_name(F.col("nome")))
    wanted = products.withColumn("_nome", match_name(F.col("nome_produto"))).join(
        named.select("_nome").distinct(), "_nome", "left_semi"
    )
    joined = named.join(name_details(wanted), "_nome", "left")

    def filled(own: str, found: str) -> Column:
        return F.coalesce(F.nullif(clean(F.col(own)), F.lit("")), F.col(found), F.lit(""))

    return joined.withColumns({
        "refforn": filled("refforn", "_refforn"), "complemento": filled("complemento", "_complemento"),
    }).drop("_nome", "_refforn", "_complemento")


def enrich_lists(profiles: DataFrame, keys: Sequence[str], products: DataFrame) -> DataFrame:
    """Profiles whose product lists have every reference and complement that a product of the same name has.

    Lists that lack nothing pass by; of the others the entries are opened, completed and put together again in their
    order, so only they and the products they name are moved.
    """
    blank = F.exists("top_produtos", lambda e: (F.coalesce(e["refforn"], F.lit("")) == "") | (F.coalesce(e["complemento"], F.lit("")) == ""))
    lacking = F.coalesce(blank, F.lit(False))
    entry = profiles.schema["top_produtos"].dataType.elementType.names
    entries = enrich_entries(listed(profiles.filter(lacking), "top_produtos", keys), products)
    lists = entries.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("posicao", *entry))).alias("_l")).select(
        *keys, F.transform("_l", lambda e: F.struct(*[e[c].alias(c) for c in entry])).alias("_completa"))
    return profiles.join(lists, list(keys), "left").withColumn("top_produtos", F.coalesce("_completa", "top_produtos")).select(*profiles.columns)


def lookup_customer_profiles(requests: DataFrame, profiles: DataFrame, partners: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """The profile for each requested (dtref, id_cliente, nivel, id_empresa, id_vendedor), completed by product name where
    ``products`` are given. Without a profile the name, empty lists and a gap of 0 come back."""
    keys = ["dtref", "id_cliente", "nivel", "id_empresa", "id_vendedor"]
    names = partners.select(F.col("id_parceiro").alias("id_cliente"), "nome_parceiro")
    found = requests.select(*keys).join(profiles, keys, "left").join(names, "id_cliente", "left")
    if products is not None:
        found = enrich_lists(found, keys, products)
    schema = profiles.schema
    return found.select(
        *keys,
        F.coalesce("nome_parceiro", F.concat(F.lit("Cliente #"), F.col("id_cliente").cast("string"))).alias("nome_cliente"),
        F.coalesce("top_produtos", F.array().cast(schema["top_produtos"].dataType)).alias("top_produtos"),
        F.coalesce("top_vendedores", F.array().cast(schema["top_vendedores"].dataType)).alias("top_vendedores"),
        F.coalesce(F.col("tempo_medio_compra").cast("double"), F.lit(0.0)).alias("tempo_medio_compra"),
    )


def lookup_brand_profiles(requests: DataFrame, profiles: DataFrame, brands: DataFrame, products: DataFrame | None = None) -> DataFrame:
    keys = ["dtref", "id_marca", "nivel", "id_empresa", "id_vendedor"]
    found = requests.select(*keys).join(profiles, keys, "left").join(brands, "id_marca", "left")
    if products is not None:
        found = enrich_lists(found, keys, products)
    return found.select(
        *keys,
        F.coalesce("nome_marca", F.concat(F.lit("Marca #"), F.col("id_marca").cast("string"))).alias("nome_marca"),
        F.coalesce("top_produtos", F.array().cast(profiles.schema["top_produtos"].dataType)).alias("top_produtos"),
    )


def lists_to_json(profiles: DataFrame) -> DataFrame:
    """Lists as JSON text, for stores without array columns."""
    return profiles.withColumns({c: F.to_json(c) for c in ("top_produtos", "top_vendedores") if c in profiles.columns})


def lists_from_json(profiles: DataFrame, schema) -> DataFrame:
    """The reverse of ``lists_to_json``; columns that already hold lists pass through."""
    parsed = {
        c: F.from_json(c, schema[c].dataType)
        for c in ("top_produtos", "top_vendedores")
        if c in profiles.columns and profiles.schema[c].dataType.typeName() == "string"
    }
    return profiles.withColumns(parsed) if parsed else profiles


__all__ = [
    "BRAND", "CUSTOMER", "brand_profiles", "customer_profiles", "enrich_entries", "enrich_lists", "listed", "lists_from_json",
    "lists_to_json", "lookup_brand_profiles", "lookup_customer_profiles", "mean_gap", "name_details",
    "purchase_days", "ranked_items", "repurchase_gaps", "with_share",
]
