"""Keyed count table behind ``foreachBatch`` (S6): a log of batches and snapshots.

    <path>/log/kind=<kind>/query_id=<id>/batch_id=<n>/    one folder a micro-batch
    <path>/snapshot/version=<v>/                          folded state
    <path>/manifest/version=<v>/                          per query, the last batch folded

A batch overwrites its own folder, so a replayed batch leaves the table as it
is. ``kind`` says what its rows are: ``total`` rows are running counts of their
query, of which the latest batch's stands; ``delta`` rows are counts of that
batch alone, which add up. Totals of several queries add up too: a query with
a new checkpoint counts from zero.

``fold`` writes the state of all complete batches as a snapshot and then, as
its commit, the manifest with each query's last folded batch. Readers take the
newest manifest, its snapshot and the batches after its marks, so a read costs
the keys and the batches since the last fold, and a folded batch that is
replayed later is passed over. The fold after deletes what no manifest but
older ones needs.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOTAL, DELTA = "total", "delta"
_META = ("kind", "query_id", "batch_id")
_NO_FILES = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, None where no file has been written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if not (e.getCondition() or "").startswith(_NO_FILES):
            raise
        return None


class UpsertSink:
    """Idempotent sink for ``foreachBatch`` (see module notes).

    ``partition_by`` adds partition folders under each batch and snapshot
    (``day`` for the live daily counts): a reader filtering on them prunes to
    the matching files. ``kind`` is what the batches written through this
    object hold; reading understands both.
    """

    def __init__(self, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), kind: str = TOTAL):
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.partition_by = list(partition_by)
        self.kind = kind

    # ---------------------------------------------------------------- writing
    def write_batch(self, batch: DataFrame, batch_id: int, query_id: str | None = None) -> None:
        self._write(batch, f"{self.path}/log/kind={self.kind}/query_id={query_id or self._query_id(batch)}/batch_id={int(batch_id)}")

    def _write(self, rows: DataFrame, path: str) -> None:
        w = rows.write.mode("overwrite")
        (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(path)

    @staticmethod
    def _query_id(batch: DataFrame) -> str:
        """The id kept in the query's checkpoint; batch numbers are its own."""
        return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"

    __call__ = write_batch

    # ---------------------------------------------------------------- reading
    def manifest(self, spark: SparkSession) -> tuple[int | None, dict[tuple[str, str], int]]:
        """(version, {(kind, query id): last batch folded}) of the newest fold."""
        table = _table(spark, f"{self.path}/manifest")
        rows = table.collect() if table is not None else []  # one row per query and kept version
        version = max((r["version"] for r in rows), default=None)
        return version, {(r["kind"], r["query_id"]): r["batch_id"] for r in rows if r["version"] == version}

    def _batches(self, spark: SparkSession, marks: dict[tuple[str, str], int]) -> DataFrame | None:
        """Log rows after the marks: conditions on folders alone."""
        log = _table(spark, f"{self.path}/log")
        if log is None:
            return None
        for (kind, query), mark in marks.items():
            log = log.where((F.col("kind") != kind) | (F.col("query_id") != query) | (F.col("batch_id") > mark))
        return log

    def _rows(self, spark: SparkSession, version: int | None, log: DataFrame | None) -> DataFrame:
        """Snapshot and log rows under one schema."""
        snapshot = None if version is None else _table(spark, f"{self.path}/snapshot/version={version}")
        parts = [x for x in (snapshot, log) if x is not None]
        if not parts:
            raise FileNotFoundError(f"nothing has been written to {self.path}")
        values = [c for c in parts[0].columns if c not in self.keys and c not in _META]
        columns = [F.col("kind"), F.col("query_id").cast("string").alias("query_id"), F.col("batch_id").cast("bigint").alias("batch_id")]
        parts = [x.select(*columns, *self.keys, *values) for x in parts]
        return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])

    def _latest(self, rows: DataFrame) -> DataFrame:
        """Totals: the latest row of each key and query."""
        totals = rows.where(F.col("kind") == TOTAL)
        values = [c for c in rows.columns if c not in self.keys and c not in _META]
        return totals.groupBy("kind", "query_id", *self.keys).agg(
            F.max_by(F.struct("batch_id", *values), "batch_id").alias("v")).select("kind", "query_id", "v.batch_id", *self.keys, *[f"v.{c}" for c in values])

    @staticmethod
    def _added(rows: DataFrame, *by: str) -> DataFrame:
        """Counts added up; other values are the key's own, as a window's end."""
        rest = [(c, t) for c, t in rows.dtypes if c not in by and c not in _META]
        return rows.groupBy(*by).agg(*[(F.sum if t in ("bigint", "int") else F.max)(c).alias(c) for c, t in rest])

    def read(self, spark: SparkSession, where=None) -> DataFrame:
        """Current counts per key. ``where`` (a Column on partition columns,
        e.g. one day) is applied before the aggregate, so it prunes folders."""
        version, marks = self.manifest(spark)
        rows = self._rows(spark, version, self._batches(spark, marks))
        rows = rows if where is None else rows.where(where)
        return self._added(self._latest(rows).unionAll(rows.where(F.col("kind") == DELTA)), *self.keys)

    # ---------------------------------------------------------------- folding
    def fold(self, spark: SparkSession) -> int | None:
        """Fold all complete batches into a new snapshot; its version (None
        where nothing was written since the last). One fold at a time; queries
        may go on writing meanwhile."""
        version, marks = self.manifest(spark)
        log = self._batches(spark, marks)
        newest = [] if log is None else log.groupBy("kind", "query_id").agg(F.max("batch_id").alias("b")).collect()
        if not newest:
            return None
        later = dict(marks)
        for r in newest:  # one row per query; a batch being written right now waits for the next fold
            done = self._exists(spark, f"{self.path}/log/kind={r['kind']}/query_id={r['query_id']}/batch_id={r['b']}/_SUCCESS")
            later[r["kind"], str(r["query_id"])] = r["b"] if done else r["b"] - 1
        for (kind, query), mark in later.items():
            log = log.where((F.col("kind") != kind) | (F.col("query_id") != query) | (F.col("batch_id") <= mark))
        new = self._commit(spark, self.path, self._rows(spark, version, log), later, version)
        self._clean(spark, marks, version)
        return new

    def compact(self, spark: SparkSession, out_path: str) -> str:
        """A new sink folder with the current state as its only snapshot; both
        queries that go on and new ones may write to it."""
        version, marks = self.manifest(spark)
        log = self._batches(spark, marks)
        later = dict(marks)
        if log is not None:
            later.update({(r["kind"], str(r["query_id"])): r["b"] for r in log.groupBy("kind", "query_id").agg(F.max("batch_id").alias("b")).collect()})
        self._commit(spark, out_path.rstrip("/"), self._rows(spark, version, log), later, None)
        return out_path

    def _commit(self, spark: SparkSession, path: str, rows: DataFrame, marks: dict[tuple[str, str], int], before: int | None) -> int:
        new = max((before or 0) + 1, time.time_ns() // 1_000_000)
        meta = [F.lit(DELTA).alias("kind"), F.lit("folded").alias("query_id"), F.lit(new).cast("bigint").alias("batch_id")]
        added = self._added(rows.where(F.col("kind") == DELTA), *self.keys).select(*meta, *rows.columns[len(_META):])
        self._write(self._latest(rows).unionAll(added), f"{path}/snapshot/version={new}")
        table = spark.createDataFrame([(k, q, int(b)) for (k, q), b in marks.items()], "kind string, query_id string, batch_id bigint")
        table.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/version={new}")
        return new

    # ---------------------------------------------------------------- files
    @staticmethod
    def _files(spark: SparkSession, path: str):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where

    def _exists(self, spark: SparkSession, path: str) -> bool:
        fs, where = self._files(spark, path)
        return fs.exists(where)

    def _clean(self, spark: SparkSession, marks: dict[tuple[str, str], int], version: int | None) -> None:
        """Delete batches folded by ``version`` and the versions before it:
        readers of ``version`` itself may still be running."""
        if version is None:
            return
        jobs = [(f"{self.path}/log/kind={kind}/query_id={query}", "batch_id=", mark) for (kind, query), mark in marks.items()]
        jobs += [(f"{self.path}/{table}", "version=", version - 1) for table in ("manifest", "snapshot")]
        for folder, prefix, last in jobs:
            fs, where = self._files(spark, folder)
            for status in fs.listStatus(where) if fs.exists(where) else []:
                name = status.getPath().getName()
                if name.startswith(prefix) and int(name[len(prefix):]) <= last:
                    fs.delete(status.getPath(), True)
