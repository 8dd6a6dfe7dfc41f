"""Top items by month: customers, brands and products at four roll-up levels."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.config import NO_BRAND, SalesRules
from cyclemart.functions.calendar import month_start
from cyclemart.functions.text import clean
from cyclemart.operators.daily import net_value
from cyclemart.operators.levels import ALL_LEVELS, COMPANY, DETAIL, GLOBAL, SELLER, month_slice, place, roll_up
from cyclemart.session import materialise

CUSTOMER, BRAND, PRODUCT = "CLIENTE", "MARCA", "PRODUTO"
KINDS = (CUSTOMER, BRAND, PRODUCT)


def branded_products(products: DataFrame) -> DataFrame:
    """Products with brand 0 "SEM MARCA" where they have none."""
    return products.withColumns({
        "codmarca": F.coalesce(F.col("codmarca").cast("bigint"), F.lit(NO_BRAND[0]).cast("bigint")),
        "marca": F.coalesce("marca", F.lit(NO_BRAND[1])),
    })


def item_totals(lines: DataFrame, partners: DataFrame, products: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """Sales by (month, company, seller, kind, item) with the item's label and, as ``fatia``, the seller's slice of the month.

    Lines take the items they count for along as one list, so each is moved once for all kinds, to its seller's slice of the
    month. They are added up there: lists of a seller need no further shuffle.
    """
    def label(kind: str, item: str, name: str):
        return F.struct(F.lit(kind).alias("tipo"), F.col(item).cast("bigint").alias("id_item"),
                        F.col(name).alias("label_item"))

    def labels(rows: DataFrame, key: str, name: str, *items: Column) -> DataFrame:
        """Items by code: those of all its rows, should a code repeat."""
        return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.flatten(F.collect_list(F.array(*items))).alias(name))

    product_items = [
        label(kind, item, name)
        for kind, item, name in ((PRODUCT, "codprod", "descrprod"), (BRAND, "codmarca", "marca"))
        if kind in kinds
    ]
    rows, lists = lines.select(month_start(F.col("data_ref")).alias("dtref"), "codemp", "codvend", "codparc", "codprod",
                               net_value().alias("valor")), []
    if CUSTOMER in kinds:
        rows = rows.join(labels(partners, "codparc", "_cliente", label(CUSTOMER, "codparc", "nomeparc")), "codparc", "left")
        lists.append("_cliente")
    if product_items:
        rows = rows.join(labels(branded_products(products), "codprod", "_produto", *product_items), "codprod", "left")
        lists.append("_produto")
    found = F.filter(F.concat(*[F.coalesce(F.col(c), F.array().cast(rows.schema[c].dataType)) for c in lists]), lambda e: e.isNotNull())
    keys = ("dtref", "fatia", "codemp", "codvend")
    placed = place(rows.select("dtref", month_slice(lines.sparkSession, F.col("codvend")).alias("fatia"), "codemp", "codvend",
                               "valor", found.alias("itens")))
    return placed.select(*keys, "valor", F.inline("itens")).groupBy(*keys, "tipo", "id_item", "label_item").agg(
        F.sum("valor").alias("valor"))


def rankings(lines: DataFrame, partners: DataFrame, products: DataFrame, rules: SalesRules,
             kinds: Sequence[str] = KINDS, levels: Sequence[int] = ALL_LEVELS) -> DataFrame:
    """The first ``ranking_size`` items of each (kind, month, level, company, seller), all months in
    one pass. Ties go to the lower id. Spark keeps only the leading rows of each group before the
    ranking shuffle, so the group that holds everything stays small."""
    return rankings_of_totals(item_totals(lines, partners, products, kinds), rules, levels)


def rankings_of_totals(totals: DataFrame, rules: SalesRules, levels: Sequence[int] = ALL_LEVELS) -> DataFrame:
    """Rankings from ``item_totals``. Lists of a seller are drawn where the seller's totals lie; for the others the totals are
    added up per slice, moved to their item, and cut before they are moved to their list."""
    item, total = ["tipo", "id_item", "label_item"], [F.sum("valor").alias("total")]
    placed, parts = place(totals), []

    def first(rolled: DataFrame, *keys: str) -> DataFrame:
        best = Window.partitionBy(*keys, "tipo", "nivel", "codemp", "codvend").orderBy(
            F.desc("total"), F.asc("id_item"), F.asc("label_item"))
        return rolled.withColumn("posicao", F.row_number().over(best)).filter(F.col("posicao") <= rules.ranking_size)

    of_sellers = [level for level in levels if level in (DETAIL, SELLER)]
    of_all = [level for level in levels if level in (COMPANY, GLOBAL)]
    if of_sellers:
        parts.append(first(roll_up(placed, ["dtref", "fatia", *item], total, of_sellers), "dtref", "fatia").drop("fatia"))
    if of_all:
        summed = placed.groupBy("dtref", "fatia", *item, "codemp").agg(F.sum("valor").alias("valor"))
        by_item = summed.drop("fatia").withColumn("codvend", F.lit(0).cast("bigint")).repartition("dtref", "tipo", "id_item")
        parts.append(first(roll_up(by_item, ["dtref", *item], total, of_all), "dtref"))
    return reduce(DataFrame.unionByName, parts).select(
        F.col("codvend").alias("id_vendedor"),
        F.col("codemp").alias("id_empresa"),
        "tipo",
        "id_item",
        F.col("total").cast("decimal(15,2)").alias("valor"),
        "posicao",
        "label_item",
        "nivel",
        "dtref",
    )


def rankings_of_companies(lines: DataFrame, partners: DataFrame, products: DataFrame, rules: SalesRules,
                          companies: Sequence[int], kinds: Sequence[str] = KINDS) -> DataFrame:
    """Exact lists over several companies together, from their lines: an item that misses the stored list of one of
    them counts with all its sales."""
    chosen = lines.filter(F.col("codemp").isin(*companies) if companies else F.lit(False))
    totals = item_totals(chosen, partners, products, kinds).groupBy("dtref", "tipo", "id_item", "label_item").agg(
        F.sum("valor").alias("total"))
    best = Window.partitionBy("dtref", "tipo").orderBy(F.desc("total"), F.asc("id_item"), F.asc("label_item"))
    return totals.withColumn("posicao", F.row_number().over(best)).filter(F.col("posicao") <= rules.ranking_size).select(
        "dtref", "tipo", "posicao", "id_item", "label_item", F.col("total").cast("decimal(15,2)").alias("valor"))


def company_lists(totals: DataFrame, rules: SalesRules) -> DataFrame:
    """The first ``list_depth`` items of each month, company and kind, unrounded, from ``item_totals``.

    ``cheia`` says that the list was cut, ``corte`` what an item that it lacks can add to a sum over companies: at most the
    last total of a cut list, nothing where the list is whole.
    """
    group = ("dtref", "codemp", "tipo")
    summed = totals.groupBy(*group, "id_item", "label_item").agg(F.sum("valor").alias("total"))
    best = Window.partitionBy(*group).orderBy(F.desc("total"), F.asc("id_item"), F.asc("label_item"))
    cut = F.col("cheia")
    return (
        summed.withColumn("posicao", F.row_number().over(best))
        .filter(F.col("posicao") <= rules.list_depth)
        .withColumn("cheia", F.count(F.lit(1)).over(Window.partitionBy(*group)) == rules.list_depth)
        .withColumn("_ultimo", F.coalesce(F.min("total").over(Window.partitionBy(*group)), F.lit(0)))
        .select(F.col("codemp").alias("id_empresa"), "tipo", "id_item", "label_item", "total", "posicao",
                F.when(cut, F.greatest("_ultimo", F.lit(0))).otherwise(0).alias("corte"), "cheia", "dtref")
    )


def rankings_of_companies_bounded(lists: DataFrame, companies: Sequence[int], rules: SalesRules,
                                  sales: Callable[[tuple[date, date]], DataFrame], partners: DataFrame,
                                  products: DataFrame) -> DataFrame:
    """What ``rankings_of_companies`` gives, from ``company_lists`` where these suffice.

    An item's sum is known if every cut list holds it. Any other item, listed or not, is bounded by what the lists that hold it
    say and the cut-offs of those that lack it. A (month, kind) stands if all these bounds lie below the last known item of the
    list asked for; a tie does not stand, since ids decide it. Only the others are counted again, from the ``sales`` of their
    months: ``recalculado`` marks their rows and ``grupos_recalculados`` counts them. The values collected are months and kinds.
    """
    group = ["dtref", "tipo"]
    chosen = lists.filter(F.col("id_empresa").isin(*companies) if companies else F.lit(False)).withColumn("_cut", F.col("cheia").cast("int"))
    caps = chosen.filter(F.col("posicao") == 1).groupBy(*group).agg(F.sum("corte").alias("_cap"), F.sum("_cut").alias("_lists"))
    items = chosen.groupBy(*group, "id_item", "label_item").agg(
        F.sum("total").alias("total"), F.sum("corte").alias("_own"), F.sum("_cut").alias("_in")).join(caps, group)
    known, whole = F.col("_in") == F.col("_lists"), Window.partitionBy(*group)
    best = whole.orderBy(known.desc(), F.desc("total"), F.asc("id_item"), F.asc("label_item"))
    bound = F.max(F.when(~known, F.col("total") + F.col("_cap") - F.col("_own"))).over(whole)
    last = F.max(F.when(known & (F.col("posicao") == rules.ranking_size), F.col("total"))).over(whole)
    below = F.greatest(bound, F.col("_cap")) < last
    found = materialise(
        items.withColumn("posicao", F.row_number().over(best))
        .withColumn("_stands", (F.col("_lists") == 0) | F.coalesce(below, F.lit(False)))
        .filter(F.col("posicao") <= rules.ranking_size)
        .select(*group, "posicao", "id_item", "label_item", F.col("total").cast("decimal(15,2)").alias("valor"), "_stands"),
        "company-lists")
    failed: dict[str, list[date]] = {}
    for row in found.filter(~F.col("_stands")).select(*group).distinct().collect():
        failed.setdefault(row.tipo, []).append(row.dtref)
    result = found.filter("_stands").drop("_stands").withColumn("recalculado", F.lit(False))
    if failed:
        months = sorted({month for found_open in failed.values() for month in found_open})
        # One pass: where sales are dated on the document, each further period would read all items again.
        last_day = (months[-1] + timedelta(days=32)).replace(day=1) - timedelta(days=1)
        lines = sales((months[0], last_day)).filter(month_start(F.col("data_ref")).isin(*months))
        asked = reduce(Column.__or__, [(F.col("tipo") == kind) & F.col("dtref").isin(*found_open) for kind, found_open in failed.items()])
        again = rankings_of_companies(lines, partners, products, rules, companies, tuple(failed)).filter(asked)
        result = result.unionByName(again.withColumn("recalculado", F.lit(True)))
    return result.withColumn("grupos_recalculados", F.lit(sum(map(len, failed.values()))))


def ranking_level(company: int | Sequence[int], seller: int) -> int:
    """Stored level that answers a lookup; 0 stands for "all"."""
    if isinstance(company, int) and company == 0:
        return GLOBAL if seller == 0 else SELLER
    return COMPANY if seller == 0 else DETAIL


def ranking_lookup(stored: DataFrame, products: DataFrame, rules: SalesRules, company: int | Sequence[int] = 0,
                   seller: int = 0, dtref: date | None = None) -> DataFrame:
    """Stored rankings for a seller and a company, with the reference and complement of products.

    Several companies are added up per item over their stored lists and ranked anew. An empty list
    of companies gives nothing.
    """
    several = not isinstance(company, int)
    companies = list(company) if several else [company]
    found = stored.filter((F.col("nivel") == ranking_level(company, seller)) & (F.col("id_vendedor") == seller))
    found = found.filter(F.col("id_empresa").isin(*companies) if companies else F.lit(False))
    if dtref is not None:
        found = found.filter(F.col("dtref") == F.lit(dtref))
    if several and len(companies) > 1:
        added = found.groupBy("dtref", "tipo", "id_item", "label_item").agg(F.sum("valor").alias("valor"))
        best = Window.partitionBy("dtref", "tipo").orderBy(F.desc("valor"), F.asc("id_item"), F.asc("label_item"))
        found = added.withColumn("posicao", F.row_number().over(best)).filter(F.col("posicao") <= rules.ranking_size)
    # The listed ids cut the product table down before the outer join, which could only broadcast
    # the product side.
    listed = found.filter(F.col("tipo") == PRODUCT).select(F.col("id_item").alias("id_produto")).distinct()
    details = products.join(listed, "id_produto", "left_semi").select(
        F.lit(PRODUCT).alias("tipo"), F.col("id_produto").alias("id_item"), "refforn", "complemento"
    )
    return found.join(details, ["tipo", "id_item"], "left").select(
        "dtref", "tipo", "posicao", "id_item", "label_item", "valor",
        clean(F.col("refforn")).alias("refforn"), clean(F.col("complemento")).alias("complemento"),
    )


def ranking_totals(listed: DataFrame, keys: Sequence[str] = ("dtref", "tipo")) -> DataFrame:
    """Sum of the listed items per list: by month and kind, and by level, company and seller where lists of several are given."""
    return listed.groupBy(*keys).agg(F.sum("valor").alias("total"))
