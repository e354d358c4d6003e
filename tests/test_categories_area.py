from pyspark.sql import functions as F

from helpers import action, actions_df
from visitflow.operators import area as A
from visitflow.operators import categories as C


def _counts(df):
    return {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in df.collect()}


def test_empty_id_lists(spark):
    rows = [action(1, orders=""), action(2, orders=","), action(3, orders="1,,2"), action(4, pays=",3,"),
            action(5, pays="x, 3 , ,4")]
    got = _counts(C.category_counts(actions_df(spark, rows)))
    assert got == {1: (0, 1, 0), 2: (0, 1, 0), 3: (0, 0, 2), 4: (0, 0, 1)}


def test_pays_differ_from_orders(spark):
    rows = [action(1, orders="5"), action(2, pays="5"), action(3, pays="5,6"), action(4, click=6)]
    got = _counts(C.category_counts(actions_df(spark, rows)))
    assert got == {5: (0, 1, 2), 6: (1, 0, 1)}
    assert {r.category_id for r in C.touched_categories(actions_df(spark, rows)).collect()} == {5, 6}


def test_rank_ties_by_higher_category_first(spark):
    rows = [action(1, click=3), action(2, click=9), action(3, click=4), action(4, click=4)]
    top = C.top_categories(C.category_counts(actions_df(spark, rows)), 2).orderBy("rank").collect()
    assert [(r.category_id, r.rank) for r in top] == [(4, 1), (9, 2)]


def test_salted_equals_plain(spark):
    rows = [action(i, f"s{i % 3}", click=i % 5 if i % 4 else 0) for i in range(200)]
    df = actions_df(spark, rows)
    plain = {r.category_id: r.click_count for r in C.category_clicks(df).collect()}
    salted = {r.category_id: r.click_count for r in C.category_clicks_salted(df, 7).collect()}
    assert plain == salted


def test_top_sessions_desc_with_session_tiebreak(spark):
    rows = [action(i, f"s{i % 12}", click=1) for i in range(40)]
    top = C.top_sessions_per_category(C.session_category_clicks(actions_df(spark, rows)), 10)
    got = top.orderBy("rank").collect()
    assert len(got) == 10
    counts = [r.click_count for r in got]
    assert counts == sorted(counts, reverse=True)
    # sessions s0..s3 have 4 clicks, s4..s11 have 3; ties broken by session_id desc
    assert [r.session_id for r in got[:4]] == ["s3", "s2", "s1", "s0"]


def test_group_concat_keeps_prefix_lookalikes(spark):
    clicks = spark.createDataFrame([(1, "a", "X", 7), (11, "a", "X", 7), (1, "a", "X", 7)],
                                   "city_id BIGINT, city_name STRING, area STRING, product_id BIGINT")
    row = A.area_product_clicks(clicks).collect()[0]
    assert row.city_infos == "11:a,1:a" or row.city_infos == "1:a,11:a"
    assert set(row.city_infos.split(",")) == {"1:a", "11:a"} and row.click_count == 3


def test_area_levels_default_tiers(spark):
    df = spark.createDataFrame([("华北",), ("华南",), ("西南",), ("东北",)], "area STRING")
    got = [r.area_level for r in A.with_area_level(df).collect()]
    assert got == ["A级", "B级", "C级", "D级"]


def test_product_null_text_rejected(spark):
    from visitflow.functions.predicates import has_product
    df = spark.createDataFrame([("1",), ("NULL",), (" null ",), (None,)], "p STRING")
    assert df.where(has_product("p")).count() == 1


def test_sql_function_registered(spark):
    A.register_sql_functions(spark)
    assert spark.sql("SELECT concat_long_string(1, 'Beijing', ':') AS x").collect()[0].x == "1:Beijing"


def test_top_three_per_area(spark):
    rows = [("X", p, c, "", "A") for p, c in [(1, 5), (2, 9), (3, 9), (4, 1)]]
    df = spark.createDataFrame(rows, "area STRING, product_id BIGINT, click_count BIGINT, city_infos STRING, area_level STRING")
    got = [(r.product_id, r.rank) for r in A.top_products_per_area(df, 3).orderBy("rank").collect()]
    assert got == [(2, 1), (3, 2), (1, 3)]
    assert A.top_products_per_area(df, 3).where(F.col("rank") > 3).count() == 0


def test_area_sql_form_equals_dataframe_form(spark):
    from visitflow.sources.adapter import SuppliedTables
    t = SuppliedTables(spark, "/root/testdata/sf0.001")
    clicks = A.clicks_with_city(A.product_clicks(t.actions(kinds=("click",))), t.cities())
    a = sorted(tuple(r) for r in A.area_product_clicks(clicks).collect())
    b = sorted(tuple(r) for r in A.area_product_clicks_sql(clicks).collect())
    assert a == b and len(a) > 0


def test_city_dimension_by_position(spark):
    from visitflow.sources.jdbc import city_dimension_from
    raw = spark.createDataFrame([(1, "Beijing", "华北", "x"), (2, "Shanghai", "华东", "y")],
                                "cityid INT, cityname STRING, region STRING, extra STRING")
    dim = city_dimension_from(raw)
    assert dim.columns == ["city_id", "city_name", "area"]
    assert [tuple(r) for r in dim.orderBy("city_id").collect()] == [(1, "Beijing", "华北"), (2, "Shanghai", "华东")]
    assert dim.schema["city_id"].dataType.simpleString() == "bigint"
