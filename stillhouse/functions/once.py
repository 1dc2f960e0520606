"""Computing an expensive column once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` whose expression Spark does not copy.

    A filter on a projected column is pushed below the projection with the column's whole
    expression in it, so parsing would run twice, and chains of such columns grow beyond what the
    optimizer can handle. A one-element ``explode`` gives one row per row and stops the copying.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, for bodies that use it several times.

    Also keeps the generated code small: written out, nested uses multiply.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
