"""Registration of queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if it has any."""

    def add(fn: Query) -> Query:
        name = fn.__name__
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as ``id, text, lang``."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang")


def ids_text(ids: str | Column) -> Column:
    """Array as text, so that both engines print it alike.

    The cast of a whole array is compiled code; a function per element is not.
    """
    return F.array_join((F.col(ids) if isinstance(ids, str) else ids).cast("array<string>"), " ")


def long(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("long")
