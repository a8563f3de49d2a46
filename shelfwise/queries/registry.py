"""The table of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and fractions at six decimals, as the SQL has them."""
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, whole):
            column = column.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, 6)
        columns.append(column.alias(f.name))
    return df.select(*columns)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def add(build: Query) -> Query:
        key = name or build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(spark, sf_dir))

        run.__doc__ = build.__doc__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return build

    return add
