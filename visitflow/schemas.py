"""Typed shapes of the visit-log data model.

Ids are BIGINT, dates DATE, times TIMESTAMP_NTZ (wall-clock, no zone), id
lists are comma text on input and become arrays only inside expressions.
"""

from pyspark.sql import types as T

VISIT_ACTION = T.StructType([
    T.StructField("visit_date", T.DateType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("page_id", T.LongType(), True),
    T.StructField("action_time", T.TimestampNTZType(), True),
    T.StructField("event_id", T.LongType(), True),
    T.StructField("search_keyword", T.StringType(), True),
    T.StructField("click_category_id", T.LongType(), True),
    T.StructField("click_product_id", T.LongType(), True),
    T.StructField("order_category_ids", T.StringType(), True),
    T.StructField("pay_category_ids", T.StringType(), True),
    T.StructField("city_id", T.LongType(), True),
    T.StructField("order_product_ids", T.StringType(), True),
    T.StructField("pay_product_ids", T.StringType(), True),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("professional", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("sex", T.StringType(), True),
])

CITY = T.StructType([
    T.StructField("city_id", T.LongType(), False),
    T.StructField("city_name", T.StringType(), True),
    T.StructField("area", T.StringType(), True),
])

AD_CLICK = T.StructType([
    T.StructField("event_time", T.TimestampNTZType(), True),
    T.StructField("day", T.DateType(), True),
    T.StructField("province", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("ad_id", T.LongType(), True),
])

TASK = T.StructType([
    T.StructField("task_id", T.LongType(), False),
    T.StructField("task_param", T.StringType(), True),
])

# Keys a task parameter document may carry; each value is a
# JSON array whose first element is the parameter.
TASK_PARAM_FIELDS = ("startDate", "endDate", "startAge", "endAge", "professionals",
                     "cities", "sex", "keywords", "categoryIds", "targetPageFlow")
