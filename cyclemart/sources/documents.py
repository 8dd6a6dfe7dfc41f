"""Document lines: headers joined to their items, sorted into sales, returns and cancellations.

Line columns: nunota, data_ref, codemp, codvend, codparc, codprod, qtdneg, vlrtot, vlrdesc, vlrcus,
codtipoper, statusnfe; movements add ``tipo_mov`` ('V' sale, 'D' return, 'C' cancellation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.config import SalesRules

SALE, RETURN, CANCEL = "V", "D", "C"


def document_lines(headers: DataFrame, items: DataFrame) -> DataFrame:
    """Headers ⋈ items. Both sides are large: no broadcast is asked for."""
    return items.join(headers, "nunota")


def dated_headers(headers: DataFrame) -> DataFrame:
    """ERP headers with the day of their in/out timestamp. Filter on ``data_ref`` before the join."""
    return headers.withColumn("data_ref", F.to_date("dtentsai")).drop("dtentsai")


def is_sale_operation(rules: SalesRules) -> Column:
    return F.col("codtipoper").isin(*rules.sale_operations)


def approved_sales(documents: DataFrame, rules: SalesRules) -> DataFrame:
    return documents.filter(is_sale_operation(rules) & (F.col("statusnfe") == rules.approved_status))


def customer_returns(documents: DataFrame, rules: SalesRules) -> DataFrame:
    """Returns count whatever their fiscal status."""
    return documents.filter(F.col("codtipoper").isin(*rules.return_operations))


def cancelled_sales(cancel_log: DataFrame, headers: DataFrame, items: DataFrame, rules: SalesRules) -> DataFrame:
    """Cancel log ⋈ excluded headers ⋈ excluded items, dated by the cancel log."""
    dated = cancel_log.select("nunota", F.to_date("dtneg").alias("data_ref"))
    excluded = headers.filter(is_sale_operation(rules)).drop("dtentsai", "data_ref")
    return document_lines(dated.join(excluded, "nunota"), items)


def live_movements(documents: DataFrame, rules: SalesRules) -> DataFrame:
    """Sales and returns in one pass over the live documents."""
    kind = F.when(
        is_sale_operation(rules) & (F.col("statusnfe") == rules.approved_status), F.lit(SALE)
    ).when(F.col("codtipoper").isin(*rules.return_operations), F.lit(RETURN))
    return documents.withColumn("tipo_mov", kind).filter(F.col("tipo_mov").isNotNull())


def movements(
    headers: DataFrame, items: DataFrame, cancel_log: DataFrame, excluded_headers: DataFrame,
    excluded_items: DataFrame, rules: SalesRules,
) -> DataFrame:
    """Every movement of the ERP tables: live documents once, cancelled documents once."""
    wanted = is_sale_operation(rules) | F.col("codtipoper").isin(*rules.return_operations)
    live = live_movements(document_lines(dated_headers(headers).filter(wanted), items), rules)
    cancelled = cancelled_sales(cancel_log, excluded_headers, excluded_items, rules).withColumn(
        "tipo_mov", F.lit(CANCEL)
    )
    return live.unionByName(cancelled.select(*live.columns))
