"""The edge between operators and the checked results: plain column types only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, zoned timestamps as wall time, string arrays as comma lists."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        columns.append(c.alias(f.name))
    return df.select(*columns)
