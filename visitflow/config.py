"""Session settings and the shared working folder.

Library functions never build their own session: the caller passes one in.
``local_session`` exists for tests, the bench and the smoke entry point.
``shared_dir`` returns the folder named by ``spark.checkpoint.dir``; only where
that setting is absent on a local master (a laptop, a unit test) does it make a
scratch folder, so cluster jobs always use the shared folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. They are session-level SQL settings, so a
# caller's cluster session gets them without a restart.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Top-k windows (row_number() <= k) get a map-side WindowGroupLimit up to
    # this k, so a hot partition key ships at most k rows per map task.
    "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "visitflow") -> SparkSession:
    """Local session for tests and benchmarks (UI off, UTC, small shuffles)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("VISITFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    event_log = os.environ.get("VISITFLOW_EVENT_LOG_DIR")
    if event_log:  # task and stage metrics for tools/task_skew.py
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}  # of sessions on this machine alone, by application


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints, sink tables and state.

    Read from ``spark.checkpoint.dir``. Where that is unset and the master is
    local (tests, laptops), a scratch folder is made once per application; on
    a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "local").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(checkpoints, sink tables and stream state are written there)")
        app = spark.conf.get("spark.app.id", "")
        path = _LOCAL_DIRS.get(app) or _LOCAL_DIRS.setdefault(app, tempfile.mkdtemp(prefix="visitflow-"))
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server reads spark.checkpoint.dir itself
        sc = None
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def new_subdir(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` once as a parquet table in the shared folder and
    return the table read back: the lineage is cut, the result survives
    executor loss, and later readers get column pruning and pushdown.

    (``Dataset.checkpoint(eager=True)`` would evaluate the plan twice - once
    to count, once to write - unless the data were also cached.)
    """
    path = new_subdir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no footer reads for inference on the way back
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_settings(input_bytes: float, shuffle_fraction: float = 0.2,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested SQL settings for a cluster run over ``input_bytes`` of log.

    Reducers are sized from the expected shuffle volume - the operators
    shuffle narrow projections, mostly after map-side partial aggregation,
    so ``shuffle_fraction`` of the input - at about ``target_partition_bytes``
    each. AQE coalesces small partitions and splits skewed ones above four times the
    target. Returned, not applied: the caller's session configuration is
    theirs.
    """
    partitions = int(max(200, input_bytes * shuffle_fraction // target_partition_bytes))
    target_mb = f"{target_partition_bytes >> 20}m"
    return {
        **SQL_SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target_mb,
        "spark.sql.files.maxPartitionBytes": target_mb,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{(target_partition_bytes * 4) >> 20}m",
        # kept ids up to this size prune the log's scan by a Bloom filter
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    }
