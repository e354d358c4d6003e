"""Plan-shape checks for the scale properties the operators rely on."""

from visitflow.operators import area as A
from visitflow.operators import categories as C
from visitflow.operators import ordering as O
from visitflow.operators import sessions as S
from visitflow.sources.adapter import SuppliedTables

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_date_range_reaches_the_scan(spark):
    plan = _plan(SuppliedTables(spark, SF).actions("2024-01-10", "2024-01-20"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(C.category_clicks(SuppliedTables(spark, SF).actions()))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "value" not in scan.split("[")[1].split("]")[0]


def test_top_k_is_limited_before_the_shuffle(spark):
    df = C.top_sessions_per_category(C.session_category_clicks(SuppliedTables(spark, SF).actions()), 10)
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_previous_row_reads_its_stored_ranges(spark):
    """What is left after the sorted pass: no shuffle of the rows, and a join
    with the one edge row of each range, which is all that a window sees."""
    actions = SuppliedTables(spark, SF).actions()
    plan = _plan(O.with_previous(actions, ["page_id"])).split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 2  # the edges: to one task for the window, to the rows for the join
    assert "Join" in plan and "rangepartitioning" not in plan


def test_previous_row_plan_has_one_size_for_any_ranges(spark):
    actions = SuppliedTables(spark, SF).actions()
    sizes = [len(_plan(O.with_previous(actions, ["page_id"], ranges=n))) for n in (10, 300)]
    assert abs(sizes[0] - sizes[1]) < 200


def test_category_counts_single_scan(spark):
    plan = _plan(C.category_counts(SuppliedTables(spark, SF).actions()))
    assert plan.count("FileScan parquet") == 1


def test_action_kind_filter_reaches_the_scan(spark):
    plan = _plan(C.category_clicks(SuppliedTables(spark, SF).actions(kinds=("click",))))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan or \
        "In(event_type, [click])" in plan


def test_a_grown_dimension_is_not_broadcast(spark, tmp_path):
    """The size is measured at each run: nothing is remembered or forced."""
    from visitflow.operators import area as A
    clicks = SuppliedTables(spark, SF).actions().selectExpr("event_id", "city_id", "event_id AS product_id")
    path = str(tmp_path / "cities")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    try:
        plans = []
        for n in (5, 5000):
            spark.range(n).selectExpr("id AS city_id", "md5(string(id)) AS city_name", "'a' AS area").write.mode("overwrite").parquet(path)
            df = A.clicks_with_city(clicks, spark.read.parquet(path))
            df.collect()
            plans.append(_plan(df).split("== Initial Plan ==")[0])
        assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
        assert all("SinglePartition" not in p for p in plans)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_hot_session_of_the_detail_join_is_split(spark):
    from pyspark.sql import functions as F
    from visitflow.operators import sessions as S
    log = spark.range(60000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5000)).alias("session_id"),
                                    F.col("id").alias("event_id"), F.md5(F.col("id").cast("string")).alias("search_keyword"))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB"}
    saved = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = S.session_detail(log.repartition(8), log.groupBy("session_id").count())
        assert df.count() == 60000
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "skew=true" in _plan(df).split("== Initial Plan ==")[0]
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_cluster_settings_scale_with_input():
    from visitflow.config import cluster_settings
    s = cluster_settings(100 * 2 ** 40)  # 100 TiB: 20 TiB shuffled / 256 MiB
    assert int(s["spark.sql.shuffle.partitions"]) == 81920
    assert cluster_settings(2 ** 40)["spark.sql.shuffle.partitions"] == "819"
    assert s["spark.sql.adaptive.enabled"] == "true"
    assert cluster_settings(10 * 2 ** 20)["spark.sql.shuffle.partitions"] == "200"


def test_kept_ids_prune_the_log_before_its_shuffle(spark):
    """Beyond a broadcast, a Bloom filter of the ids drops other sessions' rows at the scan."""
    actions = SuppliedTables(spark, SF).actions()
    few = S.aggregate_sessions(actions).where("step_length >= 2")
    want = sorted(r.event_id for r in S.session_detail(actions, few).select("event_id").collect())
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = S.session_detail(actions, few).select("event_id")
        log_side = _optimized(df).split("LeftSemi")[1].split("Relation")[0]
        assert "might_contain" in log_side
        assert sorted(r.event_id for r in df.collect()) == want and 0 < len(want) < actions.count()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_city_lists_are_built_from_distinct_cities(spark):
    """A third of the clicks on one product: its last aggregate reads a row per city."""
    rows = [(e, e % 25, 7 if e % 3 == 0 else e % 500) for e in range(30_000)]
    clicks = spark.createDataFrame(rows, "event_id BIGINT, city_id BIGINT, product_id BIGINT")
    cities = spark.createDataFrame([(i, f"c{i}", f"a{i % 2}") for i in range(25)], "city_id BIGINT, city_name STRING, area STRING")
    counted = A.area_product_clicks(A.clicks_with_city(clicks, cities))
    plan = _optimized(counted)
    inner = plan[plan.index("Aggregate", plan.index("Aggregate") + 1):]
    assert "collect_set" not in inner.split("Project")[0] and "city_id" in inner.split("\n")[0]
    got = {(r.area, r.product_id): r for r in counted.collect()}
    assert got["a0", 7].click_count + got["a1", 7].click_count == sum(p == 7 for _, _, p in rows)
    assert len(got["a0", 7].city_infos.split(",")) == 13
