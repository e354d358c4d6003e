"""Result sinks.

Results are written as parquet tables in the cluster-shared folder (or any
path/table the caller names). Writes are whole-table overwrites of a fresh
location, so a retried job never sees a half-written result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from visitflow.config import new_subdir


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write ``df`` as parquet at ``path`` (optionally partitioned)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_and_read(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Persist ``df`` under a fresh folder of the shared directory and return
    the table read back (the lineage is cut at the write)."""
    path = new_subdir(df.sparkSession, name)
    write_table(df, path, partition_by=partition_by)
    return df.sparkSession.read.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batch_size: int = 1000, num_partitions: int | None = None, **options) -> None:
    """Batched JDBC write: one connection per partition, ``batch_size`` rows per
    round trip, at most ``num_partitions`` concurrent connections."""
    out = df if num_partitions is None else df.coalesce(num_partitions)
    (out.write.format("jdbc").mode(mode)
     .option("url", url).option("dbtable", table).option("batchsize", batch_size)
     .options(**options).save())
