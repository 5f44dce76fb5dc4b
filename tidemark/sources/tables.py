"""Named tables and relational sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """A catalog table or view, optionally qualified by ``schema``."""
    return spark.table(f"{schema}.{name}" if schema else name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    *,
    split_on: str | None = None,
    bounds: tuple[object, object] | None = None,
    parts: int = 1,
    **properties: str,
) -> DataFrame:
    """A relational table. Filters and column choice are pushed into its query.

    With ``split_on`` and ``bounds`` the table is read by ``parts`` concurrent
    queries; the bounds only shape the split and exclude nothing.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **properties)
    if split_on and bounds:
        low, high = bounds
        reader = reader.options(
            partitionColumn=split_on, lowerBound=low, upperBound=high, numPartitions=parts
        )
    return reader.load()
