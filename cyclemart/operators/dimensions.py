"""Dimension rows from the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.config import CORPORATE_COMPANY
from cyclemart.functions.calendar import cycle_label
from cyclemart.functions.text import clean
from cyclemart.operators.rankings import branded_products
from cyclemart.schemas import TABLES


def _shaped(df: DataFrame, table: str) -> DataFrame:
    """All columns of the table; those no source fills stay null."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TABLES[table].schema
    ])


def time_rows(days: DataFrame, column: str = "id_tempo") -> DataFrame:
    """A row per day that occurs. Month and weekday names stay empty."""
    day = F.col("id_tempo")
    return _shaped(days.select(F.col(column).alias("id_tempo")).distinct().withColumns({
        "ano": F.year(day), "mes": F.month(day), "dia": F.dayofmonth(day), "trimestre": F.quarter(day),
    }), "dim_tempo")


def seller_rows(sellers: DataFrame) -> DataFrame:
    return _shaped(sellers.select(
        F.col("codvend").alias("id_vendedor"), F.col("apelido").alias("nome_comercial")
    ), "dim_vendedor")


def corporate_company(companies: DataFrame) -> DataFrame:
    """The sentinel company that carries the goals."""
    code, name = CORPORATE_COMPANY
    return companies.sparkSession.range(1).select(
        F.lit(code).cast("bigint").alias("id_empresa"), F.lit(name).alias("nome")
    )


def company_rows(companies: DataFrame) -> DataFrame:
    """Source companies, and the sentinel unless the source has its id."""
    rows = companies.select(F.col("codemp").cast("bigint").alias("id_empresa"), F.col("razaosocial").alias("nome"))
    return rows.unionByName(corporate_company(companies).join(rows, "id_empresa", "left_anti"))


def partner_rows(partners: DataFrame) -> DataFrame:
    """Customers only."""
    return partners.filter(F.col("cliente") == "S").select(
        F.col("codparc").alias("id_parceiro"), F.col("nomeparc").alias("nome_parceiro")
    )


def brand_rows(products: DataFrame) -> DataFrame:
    """One row per brand id. If the source names a brand twice, the name last in order is kept."""
    return branded_products(products).groupBy(F.col("codmarca").alias("id_marca")).agg(
        F.max("marca").alias("nome_marca")
    )


def product_rows(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("codprod").alias("id_produto"),
        F.col("descrprod").alias("nome_produto"),
        clean(F.col("refforn")).alias("refforn"),
        clean(F.col("compldesc")).alias("complemento"),
    )


def cycle_rows(goal_cycles: DataFrame) -> DataFrame:
    return goal_cycles.select("dtref", "dtinic", "dtfin", cycle_label(F.col("dtref")).alias("label"))
