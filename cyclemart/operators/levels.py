"""Roll-up levels shared by rankings and profiles.

A level says which of company and seller are kept; a rolled-up key is written as 0. ``nivel`` tells
a rolled-up 0 from a real id 0: 0 = both kept, 1 = company, 2 = seller, 3 = neither.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DETAIL, COMPANY, SELLER, GLOBAL = 0, 1, 2, 3
ALL_LEVELS = (DETAIL, COMPANY, SELLER, GLOBAL)
_KEPT = {DETAIL: ("codemp", "codvend"), COMPANY: ("codemp",), SELLER: ("codvend",), GLOBAL: ()}


def level_of(company: int, seller: int) -> int:
    """The level a lookup by (company, seller) means; 0 asks for the roll-up."""
    return {(True, True): DETAIL, (True, False): COMPANY, (False, True): SELLER}.get((company != 0, seller != 0), GLOBAL)


def roll_up(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column],
            levels: Sequence[int] = ALL_LEVELS) -> DataFrame:
    """Aggregate ``df`` by ``keys`` at each level. Every row is repeated once per level, which leaves it in its
    partition: rows already partitioned by some of ``keys`` are aggregated without a shuffle."""
    return at_levels(df, levels).groupBy(*keys, "nivel", "codemp", "codvend").agg(*aggregates)


def at_levels(df: DataFrame, levels: Sequence[int] = ALL_LEVELS) -> DataFrame:
    """Every row once per level, its company and seller replaced by 0 where the level rolls them up."""
    def key(level: int, name: str) -> Column:
        return (F.col(name) if name in _KEPT[level] else F.lit(0)).cast("bigint").alias(name)

    rows = [F.struct(F.lit(level).alias("nivel"), key(level, "codemp"), key(level, "codvend")) for level in levels]
    return df.select(*[c for c in df.columns if c not in ("codemp", "codvend")], F.inline(F.array(*rows)))


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def month_slice(spark: SparkSession, key: Column) -> Column:
    """Slice of a month that a key falls into. Rows partitioned by month and slice lie so that every month is written as a few
    files, and that a shuffle partition holds a few slices: no second shuffle brings them into months."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, _shuffle_partitions(spark) // 6))).cast("int")


def place(df: DataFrame, month: str = "dtref") -> DataFrame:
    """Rows partitioned by month and slice. The number of partitions is fixed, because rows multiply by the levels, or goals
    by days, after the shuffle: partitions merged by their size before it would not fit a task's memory."""
    return df.repartition(2 * _shuffle_partitions(df.sparkSession), month, "fatia")
