"""JDBC dimension scan (S3).

The connection settings come from the caller (nothing is stored in code).
A numeric ``partition_column`` with bounds splits the scan into
``num_partitions`` parallel range queries; without it the table is one task,
which is right for a small dimension such as the city table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(spark: SparkSession, url: str, table: str, *,
                    partition_column: str | None = None, lower_bound: int | None = None,
                    upper_bound: int | None = None, num_partitions: int | None = None,
                    fetch_size: int = 1000, **options) -> DataFrame:
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch_size).options(**options))
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or 8))
    return reader.load()


def city_dimension_from(df: DataFrame) -> DataFrame:
    """(city_id, city_name, area) from the first three columns of ``df``,
    taken by position whatever the source names them."""
    a, b, c = df.columns[:3]
    return df.select(df[a].try_cast("bigint").alias("city_id"), df[b].cast("string").alias("city_name"),
                     df[c].cast("string").alias("area"))


def read_city_dimension(spark: SparkSession, url: str, table: str = "city", **options) -> DataFrame:
    """S3: the city dimension from a JDBC table (columns by position)."""
    return city_dimension_from(read_jdbc_table(spark, url, table, **options))
