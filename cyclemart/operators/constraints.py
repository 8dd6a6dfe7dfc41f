"""Rules that document lines must keep before their day is loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cyclemart.operators.daily import net_value


def line_rules() -> dict[str, Column]:
    """Name and condition of each rule; a condition that is null is broken."""
    return {
        "documento informado": F.col("nunota").isNotNull(),
        "dia informado": F.col("data_ref").isNotNull(),
        "empresa e vendedor informados": F.col("codemp").isNotNull() & F.col("codvend").isNotNull(),
        "quantidade positiva": F.col("qtdneg") > 0,
        "valor nao negativo": net_value() >= 0,
    }


def broken(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks."""
    return F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]), lambda x: x.isNotNull())


def watched(lines: DataFrame, rules: dict[str, Column], seen: Observation) -> DataFrame:
    """The lines as they are; whatever job reads them counts, in ``seen``, all of them and those that break a rule."""
    return lines.observe(seen, F.count(F.lit(1)).alias("linhas"), F.count_if(F.size(broken(rules)) > 0).alias("rejeitadas"))


def rejects(lines: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Lines that break rules, ``(id_tempo, nunota, codprod, regras)``."""
    found = lines.select(F.col("data_ref").alias("id_tempo"), "nunota", "codprod", broken(rules).alias("regras"))
    return found.filter(F.size("regras") > 0)
