"""Readers for source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_parquet(spark: SparkSession, path: str, *columns: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    df = lower_columns(reader.parquet(path))
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    driver: str | None = None,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 64,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table, read in parallel ranges of ``partition_column``. Filters and columns are
    pushed into the database's own query."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if driver:
        reader = reader.option("driver", driver)
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partition column needs its lower and upper bound")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", str(partitions))
        )
    return lower_columns(reader.options(**(properties or {})).load())
