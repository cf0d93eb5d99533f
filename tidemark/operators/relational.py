"""Small SQL pipelines over registered tables, batch or stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def register(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Register a table or stream under a name for SQL, with a field list if given."""
    table = df.toDF(*columns) if columns else df
    table.createOrReplaceTempView(name)
    return table


def project(spark: SparkSession, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SQL projection of an inline table."""
    return spark.sql(f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {{source}}", source=df)


def filtered_union(spark: SparkSession, a: DataFrame, b: DataFrame, column: str, above: int, below: int) -> DataFrame:
    """Rows of ``a`` with ``column`` above one bound and rows of ``b`` below another; duplicates stay."""
    return spark.sql(
        f"SELECT * FROM {{a}} WHERE `{column}` > {int(above)} UNION ALL SELECT * FROM {{b}} WHERE `{column}` < {int(below)}",
        a=a, b=b,
    )


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key, the content of a table after keyed replaces in arrival order."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def top_rows(df: DataFrame, keys: Sequence[str], by: str, order: Sequence[str]) -> DataFrame:
    """Per key the row with the greatest ``by``; the first arrival wins ties.  ``order`` must be numeric."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(F.col(by), *[(-F.col(c)).alias(f"o{i}") for i, c in enumerate(order)])
    best = F.max_by(F.struct(*rest), F.when(F.col(by).isNotNull(), rank)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def squares(df: DataFrame, column: str, name: str = "square") -> DataFrame:
    value: Column = F.col(column).cast("bigint")
    return df.withColumn(name, value * value)


def evens(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) % 2 == 0)
