"""Join helpers: sides whose size is bounded by construction, sets of kept keys.

Dimensions are never hinted: Spark broadcasts a side whose measured size (the
files' statistics, or under AQE the bytes its stage wrote) is below the
session's threshold, and otherwise shuffles, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.config import cut_lineage


def broadcast_bounded(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (a parameter list,
    a ``limit(n)`` result); the caller guarantees the bound."""
    return F.broadcast(df)


def kept_rows(log: DataFrame, ids: DataFrame, key: str = "session_id") -> DataFrame:
    """Rows of ``log`` whose text ``key`` is in ``ids``.

    The ids are stored first (a job at build time), so their size is measured:
    a small set is broadcast, and beyond that both sides are plain shuffles,
    whose skewed partitions AQE splits. In that case Spark also makes a Bloom
    filter of the ids and applies it where the log is scanned, so rows of other
    keys are dropped before the shuffle. It does so for logs above
    ``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold``
    and only for a side with a comparison; that is what the one below is for,
    every text passes it.
    """
    stored = cut_lineage(ids.select(key), "kept-ids")
    return log.join(stored.where(F.col(key) >= ""), key, "left_semi")
