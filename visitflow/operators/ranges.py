"""One order over a whole table, in ranges of about equal rows.

Some operators read rows in one order and need, at each row, something of the
rows before it. A window would put all rows of a key into one task; here
Spark's range partitioner cuts the order wherever it likes, also inside a key,
so no key can overload a task. What a range needs of the ranges before it
comes back from a small table with one row per range (``carried``).

The cuts come from Spark's own sample and may differ between two runs of a
plan, so a result that joins ranges with their edges has to be stored first
(``visitflow.config.cut_lineage``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sorted_ranges(df: DataFrame, keys: Sequence[str], ranges: int | None = None, part: str = "part") -> DataFrame:
    """The rows sorted by ``keys`` (NULLs first) inside ranges of the same
    order; column ``part`` numbers the ranges upwards. ``ranges`` defaults to
    the session's shuffle partitions."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(part, F.spark_partition_id())


def carried(edges: DataFrame, values: dict[str, Column], part: str = "part") -> DataFrame:
    """(part, one column per entry of ``values``): for each range in ``edges``
    the last value that is not NULL of the ranges before it, over empty ranges
    and ranges that have none. ``edges`` has one row per range, so this window
    over all of them is as long as the number of ranges."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(part, *[F.last(v, ignorenulls=True).over(before).alias(name) for name, v in values.items()])
