"""The warehouse tables on parquet, and the writes that keep them current.

Large tables are partitioned by month, so a load rewrites only the months it touches. Frames read
before a write must be read again after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.functions.calendar import year_month
from cyclemart.schemas import TABLES, Table
from cyclemart.session import materialise, working_path

#: Ending of a table that a switch has set aside.
ASIDE = "-anterior"


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: source rows, and target rows whose key the source lacks."""
    return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(
        source.select(*target.columns)
    )


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows, and source rows whose key the target lacks."""
    new = source.join(target.select(*keys), list(keys), "left_anti").select(*target.columns)
    return target.unionByName(new)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: of several, the one whose other columns come last in order."""
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_rest"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_rest.{c}").alias(c) for c in df.columns])


def shape(df: DataFrame, table: Table) -> DataFrame:
    """Cast to the table's types, in its column order. A null in a key or a required column ends the job that
    writes the rows, before anything of it is published."""
    def column(f):
        value = F.col(f.name).cast(f.dataType)
        if f.name in table.keys or f.name in table.required:
            value = F.coalesce(value, F.raise_error(F.lit(f"{table.name}.{f.name} is null")).cast(f.dataType))
        return value.alias(f.name)

    return df.select(*[column(f) for f in table.schema])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._stages: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self, *names: str) -> Warehouse:
        """Create missing tables, and put back what a switch that broke off has set aside. Columns added to a schema later read as their default from old
        files, so no migration of stored data is needed."""
        for name in names or TABLES:
            table = TABLES[name]
            if self.current_path(self.path(name)) != self.path(name):
                self._rename(self.current_path(self.path(name)), self.path(name))
            writer = self.spark.createDataFrame([], table.schema).write.mode("ignore")
            if table.partition:
                writer = writer.partitionBy(table.partition)
            writer.parquet(self.path(name))
        return self

    def read(self, name: str, defaults: bool = True) -> DataFrame:
        """A table. Without ``defaults`` nulls stay as they are stored."""
        table = TABLES[name]
        path = self.path(name) if table.partition else self.current_path(self.path(name))
        df = self.spark.read.schema(table.schema).parquet(path)
        if defaults and table.defaults:
            types = {f.name: f.dataType for f in table.schema}
            df = df.withColumns({c: F.coalesce(c, F.lit(v).cast(types[c])) for c, v in table.defaults.items()})
        return df

    def fact(self, start=None, end=None) -> DataFrame:
        """The daily fact; a period also prunes month partitions."""
        df = self.read("fato_vendasdiarias")
        if start is not None:
            df = df.filter((F.col("id_tempo") >= F.lit(start)) & (F.col("ano_mes") >= year_month(F.lit(start))))
        if end is not None:
            df = df.filter((F.col("id_tempo") <= F.lit(end)) & (F.col("ano_mes") <= year_month(F.lit(end))))
        return df

    def _stage(self, df: DataFrame, table: Table) -> DataFrame:
        """Write the increment once: the merge reads it several times, and must not recompute it
        from tables that the write is about to change. ``_write`` removes it."""
        rows, path = shape(df, table), working_path(self.spark, f"stage-{table.name}")
        self._stages.append(path)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _increment(self, rows: DataFrame, table: Table, staged: bool) -> DataFrame:
        """Rows to merge, one per key. ``staged`` says that they are already written, in shape and unique."""
        return shape(rows, table) if staged else self._stage(one_per_key(shape(rows, table), table.keys), table)

    def _write(self, df: DataFrame, table: Table, placed: bool = False) -> None:
        """Rebalancing gives each month evenly sized files, splitting the large ones. Rows ``placed`` by month and slice lie
        so already and are not shuffled again."""
        if table.partition is None:
            self.switch(df, self.path(table.name))
            self._unstage()
            return
        months = df if placed else df.hint("rebalance", F.col(table.partition))
        laid_out = months.sortWithinPartitions(table.partition, *table.sort)
        (
            laid_out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(table.partition)
            .parquet(self.path(table.name))
        )
        self._unstage()

    def _unstage(self) -> None:
        """Nothing reads a staged increment once it is merged."""
        while self._stages:
            self.remove(self._stages.pop())

    def _drop_partitions(self, table: Table, values: Sequence) -> None:
        """Remove months that have no rows left; an overwrite only replaces months it writes."""
        for value in values:
            files, folder = self._files(f"{self.path(table.name)}/{table.partition}={value}")
            files.delete(folder, True)

    def _files(self, path: str) -> tuple:
        """File system and path as Hadoop knows them, whatever store holds them."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def remove(self, path: str) -> None:
        files, place = self._files(path)
        files.delete(place, True)

    def exists(self, path: str) -> bool:
        files, place = self._files(path)
        return files.exists(place)

    def _rename(self, old: str, new: str) -> None:
        files, place = self._files(old)
        if not files.rename(place, self._files(new)[1]):
            raise OSError(f"{old} could not be put at {new}")

    def current_path(self, path: str) -> str:
        """Where a switched table lies: at its path or, if a switch broke off between its two renames, still set aside."""
        aside = f"{path}{ASIDE}"
        return aside if not self.exists(path) and self.exists(aside) else path

    def switch(self, df: DataFrame, path: str) -> None:
        """Write a whole table beside the old one, which it may be computed from, set the old one aside, put the new one in
        its place and only then remove the old one. At every moment one of the two is whole; ``current_path`` finds it,
        and the next switch clears up."""
        beside, aside = f"{path}-{uuid.uuid4().hex}", f"{path}{ASIDE}"
        df.write.parquet(beside)
        files, place = self._files(path)
        if self.exists(path):
            files.delete(self._files(aside)[1], True)
            self._rename(path, aside)
        self._rename(beside, path)
        files.delete(self._files(aside)[1], True)

    def _touched(self, table: Table, staged: DataFrame) -> list:
        """Month partitions of the increment: at most one value per month of history."""
        return [r[0] for r in staged.select(table.partition).distinct().collect()]

    def _current(self, table: Table, staged: DataFrame) -> DataFrame:
        current = self.read(table.name)
        if table.partition is None:
            return current
        return current.filter(F.col(table.partition).isin(*self._touched(table, staged)))

    def load(self, name: str, rows: DataFrame, placed: bool = False) -> None:
        """First load of a table, or full replacement of the months in ``rows``. ``placed`` says that rows are partitioned by
        month and slice, as the operators of rankings, profiles and the fact leave them."""
        table = TABLES[name]
        self._write(shape(rows, table), table, placed)

    def upsert(self, name: str, rows: DataFrame, staged: bool = False) -> None:
        """Replace the measures of known keys and add new ones; other rows stay. Running it twice
        changes nothing. A key that ``rows`` holds more than once is stored once."""
        table = TABLES[name]
        staged = self._increment(rows, table, staged)
        self._write(merge_rows(self._current(table, staged), staged, table.keys), table)

    def insert_missing(self, name: str, rows: DataFrame) -> None:
        table = TABLES[name]
        staged = self._increment(rows, table, False)
        self._write(insert_missing(self._current(table, staged), staged, table.keys), table)

    def replace_days(self, rows: DataFrame, days: DataFrame, staged: bool = False, placed: bool = False) -> None:
        """Swap the fact rows of whole days: keys that vanished from a day go away. ``days`` has
        ``id_tempo``, and may name days that have no rows left. ``placed`` says that rows are unique, computed from other
        tables than the fact, and partitioned by month and slice: they go to their files without being written before."""
        table = TABLES["fato_vendasdiarias"]
        staged = shape(rows, table) if placed else self._increment(rows, table, staged)
        touched = materialise(days.select("id_tempo").distinct(), "stage-days").withColumn(
            "ano_mes", year_month(F.col("id_tempo"))
        )
        months = self._touched(table, touched)
        kept = self.read(table.name).filter(F.col("ano_mes").isin(*months)).join(
            F.broadcast(touched.select("id_tempo")), "id_tempo", "left_anti"
        )
        # Most months are often replaced whole: only the others are read again.
        partly = [r[0] for r in kept.select("ano_mes").distinct().collect()]
        result = kept.filter(F.col("ano_mes").isin(*partly)).select(*table.schema.names).unionByName(staged) if partly else staged
        before = self._month_files(table, months)
        self._write(result, table, placed)
        after = self._month_files(table, months)
        self._drop_partitions(table, [m for m in months if before[m] and after[m] == before[m]])

    def _month_files(self, table: Table, months: Sequence) -> dict[object, frozenset[str]]:
        """Names of the files of some months. A month that a write has replaced has others than before, one without rows
        keeps its own."""
        found = {}
        for month in months:
            files, folder = self._files(f"{self.path(table.name)}/{table.partition}={month}")
            found[month] = frozenset(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else frozenset()
        return found

    def replace_months(self, name: str, rows: DataFrame, months: Sequence | None = None) -> None:
        """Swap whole months, so that a shorter list leaves no stale tail. ``months`` names the months
        the rows were computed for; those without rows are emptied."""
        table = TABLES[name]
        staged = self._stage(rows, table)
        left = self._touched(table, staged) if months else []
        self._write(staged, table)
        self._drop_partitions(table, [m for m in months or () if m not in left])


def export(rows: DataFrame, path: str, kind: str = "csv") -> None:
    """Report rows as CSV with a header, or as JSON lines."""
    if kind == "csv":
        rows.write.mode("overwrite").option("header", True).csv(path)
    elif kind == "json":
        rows.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown export format: {kind}")
