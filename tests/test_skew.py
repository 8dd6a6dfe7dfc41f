"""One key with a third of all rows: same results, and the hot join partition is split."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cyclemart.config import SalesRules
from cyclemart.operators.daily import daily_sales
from cyclemart.operators.rankings import rankings
from cyclemart.session import TUNING, tune
from cyclemart.sources.documents import approved_sales, document_lines

RULES = SalesRules()
N = 60_000


@pytest.fixture
def small_skew_limits(spark):
    """AQE thresholds low enough for test data."""
    tune(spark)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", TUNING["spark.sql.adaptive.coalescePartitions.enabled"])


def documents(spark):
    """Items of which a third belong to document 1; every third document to seller 1 and customer 1."""
    ids = spark.range(N, numPartitions=8)
    items = ids.select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 2).alias("nunota"), (F.col("id") % 97 + 1).alias("codprod"),
        F.lit(1).cast("decimal(15,2)").alias("qtdneg"), (F.col("id") % 50 + 1).cast("decimal(15,2)").alias("vlrtot"),
        F.lit(0).cast("decimal(20,4)").alias("vlrdesc"), F.lit(1).cast("decimal(15,2)").alias("vlrcus"))
    headers = spark.range(1, N + 2, numPartitions=8).select(
        F.col("id").alias("nunota"), F.date_add(F.lit(date(2026, 5, 1)), (F.col("id") % 30).cast("int")).alias("data_ref"),
        (F.col("id") % 2 + 1).alias("codemp"), F.when(F.col("id") % 3 == 1, 1).otherwise(F.col("id") % 20 + 2).alias("codvend"),
        F.when(F.col("id") % 3 == 1, 1).otherwise(F.col("id") % 500 + 2).alias("codparc"),
        F.lit(3107).alias("codtipoper"), F.lit("A").alias("statusnfe"))
    return headers, items


def python_lines():
    for i in range(N):
        doc = 1 if i % 3 == 0 else i + 2
        yield (doc, date(2026, 5, 1) + timedelta(days=doc % 30), doc % 2 + 1, 1 if doc % 3 == 1 else doc % 20 + 2,
               1 if doc % 3 == 1 else doc % 500 + 2, i % 97 + 1, i % 50 + 1)


def test_hot_document_is_split_and_counted_right(spark, small_skew_limits):
    headers, items = documents(spark)
    df = daily_sales(approved_sales(document_lines(headers, items), RULES))
    found = {(r.data_ref, r.codemp, r.codvend): (int(r.vlr_nota), r.qtd_transacoes) for r in df.collect()}
    value, docs = {}, {}
    for doc, day, company, seller, _, _, v in python_lines():
        key = (day, company, seller)
        value[key] = value.get(key, 0) + v
        docs.setdefault(key, set()).add(doc)
    assert found == {k: (v, len(docs[k])) for k, v in value.items()}
    assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_and_seller_in_rankings(spark, small_skew_limits):
    headers, items = documents(spark)
    partners = spark.range(1, 600).select(F.col("id").alias("codparc"), F.concat(F.lit("c"), F.col("id")).alias("nomeparc"))
    products = spark.range(1, 98).select(
        F.col("id").alias("codprod"), F.concat(F.lit("p"), F.col("id")).alias("descrprod"),
        F.lit(None).cast("bigint").alias("codmarca"), F.lit(None).cast("string").alias("marca"))
    df = rankings(document_lines(headers, items), partners, products, RULES)
    totals = {}
    for _, _, company, seller, customer, product, v in python_lines():
        for kind, item in (("CLIENTE", customer), ("PRODUTO", product), ("MARCA", 0)):
            for level, emp, vend in ((0, company, seller), (1, company, 0), (2, 0, seller), (3, 0, 0)):
                group = totals.setdefault((kind, level, emp, vend), {})
                group[item] = group.get(item, 0) + v
    expected = {
        (*key, position): (item, value)
        for key, group in totals.items()
        for position, (item, value) in enumerate(sorted(group.items(), key=lambda x: (-x[1], x[0]))[:10], 1)
    }
    found = {(r.tipo, r.nivel, r.id_empresa, r.id_vendedor, r.posicao): (r.id_item, int(r.valor)) for r in df.collect()}
    assert found == expected
