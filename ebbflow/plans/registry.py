"""Registration of named queries: a Spark builder and, where the operator
is SQL-expressible, the equivalent DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 9  # both sides round doubles: summation order differs between engines


def query(name: str, sql: str | None = None, doubles: tuple[str, ...] | list[str] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``doubles`` names the double columns whose value depends on summation
    order (aggregates); both the Spark result and the oracle round them to
    ``DIGITS``.  Row-wise arithmetic is bit-identical in both engines and
    stays unrounded.
    """
    doubles = list(doubles)

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return rounded(df, only=doubles) if doubles else df
        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql_rounded(sql, doubles)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS, only: list[str] | None = None) -> DataFrame:
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (only is None or f.name in only)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def sql_rounded(sql: str, double_cols: list[str], digits: int = DIGITS) -> str:
    """Wrap oracle SQL so the listed double columns are rounded."""
    if not double_cols:
        return sql
    rep = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _q"
