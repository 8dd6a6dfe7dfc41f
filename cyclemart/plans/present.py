"""Result shape of the registered queries: plain numbers and ISO dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])
