"""Delimited-text quality split (S10), as a Spark job.

Lines are validated in parallel: a line is valid when it splits into exactly
``n_fields`` fields and none is empty. Valid lines are written as CSV
files with one header each; rejects are counted by reason, or kept: ``split``
writes all lines once, each under its verdict, and valid rows and quarantined
lines (with file and reason) are two reads of that table. Nothing is read or
written by a single process.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REASON_FIELD_COUNT = "field_count"
REASON_EMPTY_FIELD = "empty_field"
VALID = "valid"


def _fields(line: Column, sep: str) -> Column:
    # limit -1 keeps trailing empty fields, so 'a,b,' is three fields
    return F.split(line, _escape(sep), -1)


def _escape(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$|?*+()[]{}\\" else ch for ch in sep)


def classify_lines(lines: DataFrame, n_fields: int, sep: str = ",", line_col: str = "value") -> DataFrame:
    """Adds ``fields`` (array) and ``reject_reason`` (NULL when valid)."""
    line = F.col(line_col)
    f = _fields(line, sep)
    if " " in sep:
        # spaces are separators: a blank field is an empty or all-space run between them
        esc = _escape(sep)
        blank = line.rlike(f"(^|{esc}) *({esc}|$)")
    else:
        # a field is blank after trim (which strips spaces) exactly when it is
        # empty once all spaces are removed: no per-element lambda needed
        blank = F.array_contains(_fields(F.translate(line, " ", ""), sep), "")
    reason = (F.when(line.isNull() | (F.size("fields") != n_fields), F.lit(REASON_FIELD_COUNT))
              .when(blank, F.lit(REASON_EMPTY_FIELD)))
    return lines.withColumn("fields", f).withColumn("reject_reason", reason)


def valid_rows(classified: DataFrame, names: Sequence[str]) -> DataFrame:
    """Valid lines as named string columns."""
    return (classified.where(F.col("reject_reason").isNull())
            .select(*[F.col("fields")[i].alias(n) for i, n in enumerate(names)]))


def reject_counts(classified: DataFrame) -> DataFrame:
    """(reject_reason, line_count) over the rejected lines.

    Grouped first and filtered after: a filter before the aggregate would be
    pushed below the classification and evaluate it twice per line.
    """
    return (classified.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("line_count"))
            .where(F.col("reject_reason").isNotNull()))


def split(classified: DataFrame, path: str, line_col: str = "value") -> str:
    """Write every line once, with the file it came from, in folders by verdict
    (``valid`` or the reason it was rejected): one pass over the input, no
    shuffle. A line of a frame that is not read from files has no file."""
    verdict = F.coalesce("reject_reason", F.lit(VALID)).alias("verdict")
    file = F.col("file") if "file" in classified.columns else F.lit(None).cast("string").alias("file")
    classified.select(F.col(line_col).alias("line"), file, verdict).write.mode("overwrite").partitionBy("verdict").parquet(path)
    return path


def _verdicts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("line STRING, file STRING, verdict STRING").parquet(path)


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """(line, file, reject_reason) of the lines that ``split`` put aside; reads
    their folders alone."""
    return _verdicts(spark, path).where(F.col("verdict") != VALID).withColumnRenamed("verdict", "reject_reason")


def accepted(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """The valid lines of ``split`` as named string columns."""
    fields = _fields(F.col("line"), sep)
    return _verdicts(spark, path).where(F.col("verdict") == VALID).select(*[fields[i].alias(n) for i, n in enumerate(names)])


def write_split_csv(rows: DataFrame, path: str, n_files: int | None = None, sep: str = ",") -> str:
    """Valid rows as CSV part files, each with its own header: as many as the
    rows have partitions, or ``n_files`` (one shuffle of all rows) if given."""
    out = rows if n_files is None else rows.repartition(n_files)
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def write_lines_with_header(lines: DataFrame, path: str, header: str, records_per_file: int = 0,
                            line_col: str = "value") -> str:
    """Write text lines as files that each start with ``header``, of at most
    ``records_per_file`` lines (0: one file per partition)."""
    (lines.select(F.col(line_col).alias(header)).write.mode("overwrite").option("maxRecordsPerFile", records_per_file)
     .option("header", True).option("sep", "\u0001").option("quote", "\u0000")
     .option("escape", "\u0000").csv(path))
    return path


def read_lines(spark, path: str, skip_header: bool = True, with_file: bool = False) -> DataFrame:
    """Raw text lines as one ``value`` column (``with_file``: and the name of
    the ``file`` that a line is in).

    Read with the CSV source using a separator that never occurs and quoting
    off, so every line is one value; with ``skip_header`` the source drops
    the first line of every file (per file, in the file's first split only).
    """
    lines = (spark.read.option("header", skip_header).option("sep", "\u0001")
             .option("quote", "\u0000").option("escape", "\u0000")
             .schema("value STRING").csv(path))
    return lines.select("value", F.col("_metadata.file_name").alias("file")) if with_file else lines
