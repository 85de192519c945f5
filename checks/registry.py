"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def check(name: str, oracle: str | None = None):
    """Register `build(views) -> DataFrame` under `name`, with the DuckDB SQL that must agree."""

    def decorate(build: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Views.of(spark, sf_dir)))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return build

    return decorate


def plain(df: DataFrame) -> DataFrame:
    """Columns in types both engines hash alike: rounded doubles, flags as 0/1, dates as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType)):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, DIGITS)
        columns.append(column.alias(field.name))
    return df.select(*columns)
