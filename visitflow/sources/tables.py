"""Table scans.

Scans are lazy parquet reads; Catalyst prunes the columns a query touches and
pushes the date predicate into the parquet reader (row-group skipping, and
directory pruning when the log is partitioned by ``visit_date``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One parquet table under ``base_dir`` (``{base_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Named temp views (S11) so SQL text can address the frames."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def _as_date(value):
    if value is None or value == "":
        return None
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def actions_in_range(actions: DataFrame, start_date=None, end_date=None,
                     date_col: str = "visit_date") -> DataFrame:
    """Visit-log rows with start_date <= date <= end_date.

    A missing bound means no limit on that side. Dates are bound as literals so
    the comparison reaches the scan as a pushed filter.
    """
    lo, hi = _as_date(start_date), _as_date(end_date)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(date_col) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(date_col) <= F.lit(hi))
    return actions.where(cond) if (lo or hi) else actions


def normalize_text_log(raw: DataFrame, event_id_col: str = "event_id") -> DataFrame:
    """S1 for text-typed visit logs: the original table layout (``date`` as
    'yyyy-MM-dd', ``action_time`` as unpadded 'yyyy-MM-dd H:m:s', ids as
    numbers or text, id lists as comma text) -> the typed visit-log schema.

    ``event_id_col`` must identify a row (it breaks ties in time order and is
    kept stable across retries, unlike a generated row number). Optional
    columns that are absent become NULL. Bad times become NULL (X1).
    """
    from visitflow.functions.expressions import parse_time

    def col(name, typ):
        return (F.col(name).try_cast(typ) if name in raw.columns else F.lit(None).cast(typ)).alias(name)

    return raw.select(
        F.coalesce(F.col("date").try_cast("date"), F.to_date(parse_time("action_time"))).alias("visit_date"),
        col("user_id", "bigint"),
        F.col("session_id").cast("string").alias("session_id"),
        col("page_id", "bigint"),
        parse_time("action_time").alias("action_time"),
        F.col(event_id_col).cast("bigint").alias("event_id"),
        col("search_keyword", "string"),
        col("click_category_id", "bigint"),
        col("click_product_id", "bigint"),
        col("order_category_ids", "string"),
        col("pay_category_ids", "string"),
        col("city_id", "bigint"),
        col("order_product_ids", "string"),
        col("pay_product_ids", "string"),
    )
