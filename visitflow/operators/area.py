"""Product clicks by area.

Clicks are joined to the city dimension (broadcast by Spark from its measured
size), counted per (area, product, city) first, so that the city lists of an
(area, product) are built from its distinct cities and not from its clicks,
tiered by area, and ranked per area with a literal top-k window that Spark
limits on the map side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitflow.functions.expressions import concat_long_string
from visitflow.functions.predicates import DEFAULT_AREA_OTHER, DEFAULT_AREA_TIERS, area_level, has_product


def product_clicks(actions: DataFrame) -> DataFrame:
    """click rows that carry a product id: (event_id, city_id, product_id)."""
    return (actions.where(has_product("click_product_id"))
            .select("event_id", "city_id", F.col("click_product_id").cast("bigint").alias("product_id")))


def clicks_with_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks joined to (city_id, city_name, area) on city_id."""
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id")


def group_concat_distinct(col, sep: str = ",") -> Column:
    """Distinct values joined by ``sep`` in ascending order (an aggregate)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def area_product_clicks(clicks_city: DataFrame, sep: str = ":") -> DataFrame:
    """(area, product_id, click_count, city_infos 'id:name,...').

    Two levels: clicks per city are an ordinary partial sum, so a product with
    a third of all clicks reaches the second level as one row per city."""
    label = concat_long_string("city_id", "city_name", sep)
    per_city = clicks_city.groupBy("area", "product_id", "city_id", "city_name").agg(F.count(F.lit(1)).alias("n"))
    return (per_city.groupBy("area", "product_id")
            .agg(F.sum("n").alias("click_count"),
                 group_concat_distinct(label).alias("city_infos")))


def with_area_level(df: DataFrame, tiers: Mapping[str, Iterable[str]] = DEFAULT_AREA_TIERS,
                    other: str = DEFAULT_AREA_OTHER) -> DataFrame:
    """F8: add ``area_level`` from the tier mapping."""
    return df.withColumn("area_level", area_level("area", tiers, other))


def top_products_per_area(area_clicks: DataFrame, n: int = 3) -> DataFrame:
    """R2: the ``n`` most-clicked products of each area (ties: smaller id first)."""
    w = Window.partitionBy("area").orderBy(F.desc("click_count"), F.asc("product_id"))
    return area_clicks.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def register_sql_functions(spark: SparkSession) -> None:
    """U1 as a SQL function (inlined by the analyzer; no Python worker):
    ``concat_long_string(v BIGINT, s STRING, sep STRING)``."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(v BIGINT, s STRING, sep STRING)
        RETURNS STRING RETURN concat(CAST(v AS STRING), sep, s)""")


def area_product_clicks_sql(clicks_city: DataFrame, view: str = "clk_prod_basic") -> DataFrame:
    """A16 + U1 + U2 in Spark SQL, the form the original area job is written
    in: a temp view, the registered scalar function and the built-in
    distinct, ordered string aggregate. Same rows as ``area_product_clicks``."""
    spark = clicks_city.sparkSession
    register_sql_functions(spark)
    clicks_city.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT area, product_id, count(*) AS click_count,
               listagg(DISTINCT city_info, ',') WITHIN GROUP (ORDER BY city_info) AS city_infos
        FROM (SELECT area, product_id, concat_long_string(city_id, city_name, ':') AS city_info FROM {view})
        GROUP BY area, product_id""")
