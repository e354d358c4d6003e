"""Maps the supplied test tables onto the visit-log data model.

``events`` becomes the visit log (one session per user and day), ``customer``
joined with ``nation`` the user dimension, and ``nation`` with ``region`` the
city dimension. The same mapping is written as SQL in
``visitflow.plans.oracle.ADAPTER_CTES`` for the DuckDB oracle.

Mapping (fixed values of the test adapter):
  k = the integer inside ``props`` ``{"k": N}``
  view -> SEARCH with keyword 'kw' || k % 4
  click -> CLICK of category k and product (k * 7 + 3) % 100
  purchase -> ORDER of categories 'k,(k+1)%100' ('' when k % 7 = 0)
  signup -> PAY of categories 'k,(k+2)%100' ('' when k % 7 = 0)
  purchase, signup -> also products p = (k * 7 + 3) % 100 and (p + 1 or 2) % 100, '' likewise
  error -> page view without payload
  page_id = k % 10, city_id = event_id % 25
  session_id = user_id || '_' || date(ts)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.sources.tables import read_table


def _k() -> Column:
    return F.regexp_extract("props", r"[0-9]+", 0).try_cast("bigint")


def _id_pair(k: Column, step: int) -> Column:
    return F.when(k % 7 == 0, F.lit("")).otherwise(
        F.concat(k.cast("string"), F.lit(","), ((k + step) % 100).cast("string")))


def _product_pair(k: Column, step: int) -> Column:
    product = (k * 7 + 3) % 100
    return F.when(k % 7 == 0, F.lit("")).otherwise(
        F.concat(product.cast("string"), F.lit(","), ((product + step) % 100).cast("string")))


# Event type of each action kind in the test tables.
EVENT_TYPE = {"search": "view", "click": "click", "order": "purchase", "pay": "signup", "view": "error"}


def events_to_actions(events: DataFrame, start_date=None, end_date=None,
                      kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Visit-log view of ``events``; optional inclusive date range on ``ts``
    and optional action kinds (search, click, order, pay, view).

    Both are applied to stored columns (``ts >= start``, ``ts < end + 1 day``,
    ``event_type IN (...)``) so they reach the parquet scan as pushed filters;
    a predicate on a derived column such as ``click_category_id IS NOT NULL``
    cannot be pushed by the optimizer.
    """
    ev = events
    if kinds:
        ev = ev.where(F.col("event_type").isin([EVENT_TYPE[k] for k in kinds]))
    # NTZ literals: a Python datetime literal would be a zoned TIMESTAMP and
    # shift the bound by the session zone.
    if start_date:
        lo = _dt.date.fromisoformat(str(start_date)).isoformat() + " 00:00:00"
        ev = ev.where(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
    if end_date:
        hi = (_dt.date.fromisoformat(str(end_date)) + _dt.timedelta(days=1)).isoformat() + " 00:00:00"
        ev = ev.where(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
    k = F.col("_k")
    etype = F.col("event_type")
    day = F.to_date("ts")
    return (
        ev.select("event_id", "ts", "user_id", "event_type", _k().alias("_k"))
        .select(
            day.alias("visit_date"),
            F.col("user_id"),
            F.concat(F.col("user_id").cast("string"), F.lit("_"), day.cast("string")).alias("session_id"),
            (k % 10).alias("page_id"),
            F.col("ts").alias("action_time"),
            F.col("event_id"),
            F.when(etype == "view", F.concat(F.lit("kw"), (k % 4).cast("string"))).alias("search_keyword"),
            F.when(etype == "click", k).alias("click_category_id"),
            F.when(etype == "click", (k * 7 + 3) % 100).alias("click_product_id"),
            F.when(etype == "purchase", _id_pair(k, 1)).alias("order_category_ids"),
            F.when(etype == "signup", _id_pair(k, 2)).alias("pay_category_ids"),
            (F.col("event_id") % 25).alias("city_id"),
            F.when(etype == "purchase", _product_pair(k, 1)).alias("order_product_ids"),
            F.when(etype == "signup", _product_pair(k, 2)).alias("pay_product_ids"),
        )
    )


def customers_to_users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """User dimension: age 18 + key % 60, segment as profession, nation as city."""
    nat = nation.select("n_nationkey", "n_name")
    return (
        customer.select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("user_id"),
            (F.lit(18) + F.col("c_custkey") % 60).cast("int").alias("age"),
            F.col("c_mktsegment").alias("professional"),
            F.col("n_name").alias("city"),
            F.when(F.col("c_custkey") % 2 == 0, "man").otherwise("woman").alias("sex"),
        )
    )


def nations_to_cities(nation: DataFrame, region: DataFrame) -> DataFrame:
    """City dimension: nation key and name as city, region name as area."""
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").cast("bigint").alias("city_id"),
                F.col("n_name").alias("city_name"),
                F.col("r_name").alias("area"))
    )


# Read-only input tables, one DataFrame per application, folder and table:
# re-creating it would list the folder and read parquet footers again.
_RAW: dict[tuple[str, str, str], DataFrame] = {}


class SuppliedTables:
    """Lazy accessors for the adapted test tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir

    def raw(self, name: str) -> DataFrame:
        key = (self.spark.conf.get("spark.app.id", ""), self.base_dir.rstrip("/"), name)
        if key not in _RAW:
            _RAW[key] = read_table(self.spark, self.base_dir, name)
        return _RAW[key]

    def actions(self, start_date=None, end_date=None, kinds: tuple[str, ...] | None = None) -> DataFrame:
        return events_to_actions(self.raw("events"), start_date, end_date, kinds)

    def users(self) -> DataFrame:
        return customers_to_users(self.raw("customer"), self.raw("nation"))

    def cities(self) -> DataFrame:
        return nations_to_cities(self.raw("nation"), self.raw("region"))
