"""Registry of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(
    name: str, sql: str | None = None, longs: tuple[str, ...] = ()
) -> Callable[[Query], Query]:
    """Register a query. ``longs`` names SQL results to widen to 64 bits, as :func:`plain` does."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf: plain(run(spark, sf))
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in longs)
            SQL[name] = f"SELECT * REPLACE ({casts}) FROM ({sql.strip()})" if longs else sql.strip()
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: decimals as double, dates as text, integers as long."""

    def cell(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("date").cast("string")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        return c.alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])
