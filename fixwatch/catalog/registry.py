"""The two tables behind the driver contract, and the output form both sides share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

DIGITS = 8


def query(name: str, sql: str | None = None, digits: int = DIGITS) -> Callable[[Query], Query]:
    """Register a query; its result is put into the shared output form."""

    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: tidy(function(spark, sf_dir), digits)
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def tidy(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Rounded doubles, long integers, dates and times as text: engines interpolate and add
    in different order, and name integer widths differently."""
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DoubleType | T.FloatType):
            # Adding zero turns -0.0 into 0.0.
            column = F.round(column.cast("double"), digits) + F.lit(0.0)
        elif isinstance(kind, T.ByteType | T.ShortType | T.IntegerType):
            column = column.cast("long")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, T.TimestampType | T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def tidy_sql(
    sql: str,
    *,
    real: Sequence[str] = (),
    whole: Sequence[str] = (),
    date: Sequence[str] = (),
    time: Sequence[str] = (),
    digits: int = DIGITS,
) -> str:
    """The same form in SQL. `sql` may start with its own WITH clause."""
    changes = [f"round({c}, {digits}) + 0.0 AS {c}" for c in real]
    changes += [f"CAST({c} AS BIGINT) AS {c}" for c in whole]
    changes += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in date]
    changes += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in time]
    star = f"* REPLACE ({', '.join(changes)})" if changes else "*"
    return f"SELECT {star} FROM ({sql}) AS shaped"
