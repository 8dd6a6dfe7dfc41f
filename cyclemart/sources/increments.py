"""Increments of the daily totals, merged instead of recomputed.

Each increment is stored under its name by month. Written again, after a failure or a replay, it replaces itself, so nothing
counts twice. The fact of the days an increment touches follows from the increments of their months; lines that came
before are not read again. ``fold`` turns many increments into one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.functions.calendar import year_month
from cyclemart.operators.fact import placed_fact
from cyclemart.operators.goals import goal_days, placed_goals
from cyclemart.operators.partials import actuals_of, merge_partials, partial_actuals
from cyclemart.session import materialise
from cyclemart.sources.retail import RetailSource
from cyclemart.sources.warehouse import Warehouse

ROWS = ("data_ref date, codemp bigint, codvend bigint, palavra bigint, vlr_nota decimal(38,4), vlr_desconto decimal(38,4), "
        "vlr_devolucao decimal(38,4), vlr_cancelada decimal(38,4), documentos bigint, ano_mes string, origem string")
#: Beginning of the names of folded increments, which count only once they are noted as done.
FOLD = "dobra-"


class Increments:
    def __init__(self, warehouse: Warehouse):
        self.warehouse, self.spark = warehouse, warehouse.spark
        self.path, self.folds = warehouse.path("_parciais"), warehouse.path("_dobras")

    def _write(self, partials: DataFrame, name: str) -> None:
        types = dict(c.split() for c in ROWS.split(", "))
        rows = partials.withColumns({"ano_mes": year_month(F.col("data_ref")), "origem": F.lit(name)}).select(
            *[F.col(c).cast(t).alias(c) for c, t in types.items()])
        rows.hint("rebalance", F.col("ano_mes")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "ano_mes", "origem").parquet(self.path)

    def _folded(self) -> DataFrame:
        """``(origem, dentro)``: increments that a fold holds, and its name."""
        path = self.warehouse.current_path(self.folds)
        schema = "origem string, dentro string"
        return self.spark.read.schema(schema).parquet(path) if self.warehouse.exists(path) else self.spark.createDataFrame([], schema)

    def names(self) -> list[str]:
        """Increments that count: one name per increment since the last fold."""
        if not self.warehouse.exists(self.path):
            return []
        folded = self._folded().collect()
        hidden, done = {r.origem for r in folded}, {r.dentro for r in folded}
        stored = [r[0] for r in self.spark.read.schema(ROWS).parquet(self.path).select("origem").distinct().collect()]
        return [n for n in stored if n not in hidden and (n in done or not n.startswith(FOLD))]

    def read(self, months: Sequence[str] | None = None, days: DataFrame | None = None, placed: bool = False) -> DataFrame:
        """Merged partials, of all months or some, and of all days or some (``data_ref``)."""
        rows = self.spark.read.schema(ROWS).parquet(self.path).filter(F.col("origem").isin(self.names()))
        if months is not None:
            rows = rows.filter(F.col("ano_mes").isin(list(months)))
        if days is not None:
            rows = rows.join(F.broadcast(days), "data_ref", "left_semi")
        return merge_partials(rows.drop("ano_mes", "origem"), placed=placed)

    def add(self, name: str, movements: DataFrame, source: RetailSource) -> None:
        """Store the movements of an increment and bring the fact of the days they fall on up to date."""
        self._write(partial_actuals(movements), name)
        own = self.spark.read.schema(ROWS).parquet(self.path).filter(F.col("origem") == name)
        days = materialise(own.select(F.col("data_ref").alias("id_tempo")).distinct(), "increment-days")
        first, last, months = days.agg(F.min("id_tempo"), F.max("id_tempo"), F.collect_set(year_month(F.col("id_tempo")))).first()
        if first is None:
            return
        wanted = days.withColumnRenamed("id_tempo", "data_ref")
        near = source.spanning(first, last)
        open_days = goal_days(near.goal_cycles(), source.rules, first, last, wanted)
        goals = placed_goals(near.goal_sellers(), source.sellers(), open_days)
        rows = placed_fact(actuals_of(self.read(months, wanted, placed=True)), goals, open_days)
        # A fact holds each key once.
        self.warehouse.replace_days(rows, days, placed=True)

    def fold(self) -> None:
        """Merge all increments into one. The merged rows are written first, then one switch makes them count in place of the
        others, which are removed last: a run that breaks off leaves either state whole."""
        names = self.names()
        if len(names) < 2:
            return
        name = f"{FOLD}{uuid.uuid4().hex}"
        self._write(self.read(), name)
        inside = self.spark.createDataFrame([(n, name) for n in names], "origem string, dentro string")
        # Earlier notes stay as long as what they hide may still lie there; a fold inside a fold is hidden like any other.
        self.warehouse.switch(self._folded().unionByName(inside).coalesce(1), self.folds)
        months = self.spark.read.schema(ROWS).parquet(self.path).filter(F.col("origem").isin(names)).select("ano_mes", "origem").distinct()
        for month, origin in months.collect():
            self.warehouse.remove(f"{self.path}/ano_mes={month}/origem={origin}")
