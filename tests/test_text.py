import pytest
from pyspark.sql import functions as F

from cyclemart.functions import text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("value, expected", [
    (1000.5, "R$ 1.000,50"), (0.0, "R$ 0,00"), (-50.25, "R$ -50,25"), (1234567.89, "R$ 1.234.567,89"), (None, "R$ 0,00"),
    (0.125, "R$ 0,12"),
])
def test_brl(spark, value, expected):
    assert one(spark, text.brl(F.lit(value).cast("double"))) == expected


@pytest.mark.parametrize("value, expected", [
    (1500.0, "R$ 1,5K"), (2500000.0, "R$ 2,50M"), (500.0, "R$ 500,00"), (-1500.0, "R$ -1,5K"), (999.999, "R$ 1.000,00"),
    (999999.0, "R$ 1000,0K"), (None, "R$ 0,00"),
])
def test_brl_compact(spark, value, expected):
    assert one(spark, text.brl_compact(F.lit(value).cast("double"))) == expected


@pytest.mark.parametrize("value, expected", [
    (50.555, "50,6%"), (100.0, "100,0%"), (0.0, "0,0%"), (None, "0,0%"), (12345.67, "12345,7%"),
])
def test_percent(spark, value, expected):
    assert one(spark, text.percent(F.lit(value).cast("double"))) == expected


def test_tickets_and_subtitle(spark):
    assert one(spark, text.ticket_count(F.lit(1234))) == "1.234 transações"
    assert one(spark, text.subtitle(F.lit("A1"), F.lit("azul"))) == "REF: A1 | COMP: azul"
    assert one(spark, text.subtitle(F.lit(""), F.lit("azul"))) == "COMP: azul"
    assert one(spark, text.subtitle(F.lit("A1"), F.lit(None).cast("string"))) == "REF: A1"
    assert one(spark, text.subtitle(F.lit(""), F.lit(""))) == ""
