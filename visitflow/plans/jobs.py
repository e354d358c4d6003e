"""The four applications, end to end, as compositions of the operators.

Each job takes DataFrames (and a task's parameters), returns its named
results as lazy DataFrames and, when ``out_dir`` is given, writes them as
parquet tables there. Nothing is collected to the driver except the one-row
task parameters.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.operators import area as A
from visitflow.operators import categories as C
from visitflow.operators import funnel as FN
from visitflow.operators import sampling as Y
from visitflow.operators import sessions as S
from visitflow.config import cut_lineage
from visitflow.sources.params import TaskParams
from visitflow.sources.sinks import write_table
from visitflow.sources.tables import actions_in_range
from visitflow.streaming import ad_clicks as AD


def _write(results: Mapping[str, DataFrame], out_dir: str | None) -> dict[str, DataFrame]:
    if out_dir:
        for name, df in results.items():
            write_table(df, f"{out_dir.rstrip('/')}/{name}")
    return dict(results)


def _stored(df: DataFrame, out_dir: str | None, name: str) -> DataFrame:
    """``df`` written once - as the result ``name``, or as an intermediate table
    without ``out_dir`` - and read back for the results that depend on it."""
    if not out_dir:
        return cut_lineage(df, name)
    path = f"{out_dir.rstrip('/')}/{name}"
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SESSION_OUTPUTS = ("session_stats", "session_stat_ratios", "session_sample", "session_sample_detail",
                   "top_categories", "top_category_sessions")


def session_analysis(actions: DataFrame, users: DataFrame, params: TaskParams,
                     sample_size: int = 100, seed: int = 42, top_n: int = 10,
                     out_dir: str | None = None, outputs: Collection[str] = SESSION_OUTPUTS) -> dict[str, DataFrame]:
    """Sessionise, profile, filter, bucket statistics, stratified sample with
    detail, top categories and their top sessions; ``outputs`` names those
    wanted.

    Every output depends on the kept sessions, so they are stored once; the
    category outputs share one stored table of the kept sessions' counts per
    category (a single semi join and aggregate of the log); the sample detail
    reads the log with the stored sample. Eager: the stored tables are written
    when this is called.
    """
    wanted = set(outputs)
    if not wanted <= set(SESSION_OUTPUTS):
        raise ValueError(f"unknown outputs: {sorted(wanted - set(SESSION_OUTPUTS))}")
    acts = actions_in_range(actions, params.start_date, params.end_date)
    profile = S.session_profile(S.aggregate_sessions(acts), users)
    kept = cut_lineage(S.filter_sessions(profile, S.SessionFilter.from_params(params)))
    first, dependent = {}, {}
    if wanted & {"session_stats", "session_stat_ratios"}:
        first["session_stats"] = stats = _stored(S.session_stats(kept), out_dir, "session_stats")
        dependent["session_stat_ratios"] = S.stat_ratios(stats)
    if wanted & {"session_sample", "session_sample_detail"}:
        first["session_sample"] = sample = _stored(Y.stratified_sample(
            kept.drop("keywords", "category_ids"), sample_size, seed), out_dir, "session_sample")
        dependent["session_sample_detail"] = Y.sample_detail(acts, sample)
    if wanted & {"top_categories", "top_category_sessions"}:
        counts = cut_lineage(C.session_category_counts(S.kept_touches(acts, kept)), "session-categories")
        first["top_categories"] = top = _stored(
            C.top_categories(C.category_counts_from_sessions(counts), top_n), out_dir, "top_categories")
        dependent["top_category_sessions"] = C.top_sessions_from_counts(counts, top, 10)
    return ({k: v for k, v in first.items() if k in wanted}
            | _write({k: v for k, v in dependent.items() if k in wanted}, out_dir))


def page_conversion(actions: DataFrame, params: TaskParams, task_id: int | None = None,
                    out_dir: str | None = None) -> dict[str, DataFrame]:
    """Single-step conversion rates of the task's page flow, and the report row."""
    acts = actions_in_range(actions, params.start_date, params.end_date)
    flow = params.target_page_flow or FN.DEFAULT_FLOW
    rates = _stored(FN.page_convert_rate(acts, flow), out_dir, "page_convert_rate")
    return {"page_convert_rate": rates} | _write({
                   "page_rate_report": FN.rate_report(rates, task_id if task_id is not None else params.task_id)},
                  out_dir)


def area_top_products(actions: DataFrame, cities: DataFrame, params: TaskParams,
                      tiers=None, n: int = 3, out_dir: str | None = None) -> dict[str, DataFrame]:
    """Clicks per area and product with city lists and tier, and the top n per area."""
    acts = actions_in_range(actions, params.start_date, params.end_date)
    counts = A.area_product_clicks(A.clicks_with_city(A.product_clicks(acts), cities))
    leveled = _stored(A.with_area_level(counts, tiers) if tiers else A.with_area_level(counts), out_dir, "area_product_clicks")
    return {"area_product_clicks": leveled} | _write({"area_top_products": A.top_products_per_area(leveled, n)}, out_dir)


def ad_click_counts(messages: DataFrame, sink_path: str, checkpoint: str, watermark: str | None = None,
                    available_now: bool = False, processing_time: str = "5 seconds", fold_every: int = 1000):
    """The real-time job: parse messages, count every batch's clicks per day,
    user and ad into ``sink_path`` and fold the sink every ``fold_every``
    batches. No state is held and every click counts; with a ``watermark``
    running totals are kept as streaming state instead, and clicks later than
    it are lost. Returns the started query."""
    clicks = AD.parse_ad_messages(messages)
    how = dict(available_now=available_now, processing_time=processing_time)
    if watermark:
        sink = AD.UpsertSink(sink_path, AD.DAY_KEYS, ("day",))
        return AD.run_to_sink(AD.running_daily_counts(clicks, watermark), sink, checkpoint, **how)
    sink = AD.UpsertSink(sink_path, AD.DAY_KEYS, ("day",), kind=AD.DELTA)
    return AD.count_to_sink(clicks, AD.daily_counts, sink, checkpoint, fold_every, **how)


def split_valid_csv(spark, in_path: str, out_path: str, n_fields: int, names=None,
                    n_files: int | None = None, sep: str = ",", quarantine: str | None = None) -> DataFrame:
    """The CSV validation job: read delimited files (one header line per file),
    keep lines with exactly ``n_fields`` non-blank fields, write them as files
    with a header each (``n_files`` of them if given, else as many as the input
    has splits), and return the reject counts. With ``quarantine`` the input is
    read once: all lines go to that table under their verdict, and both the
    files and the counts come from there."""
    from visitflow.sources import quality as Q
    names = list(names) if names else [f"c{i + 1}" for i in range(n_fields)]
    classified = Q.classify_lines(Q.read_lines(spark, in_path, with_file=quarantine is not None), n_fields, sep)
    if quarantine is None:
        Q.write_split_csv(Q.valid_rows(classified, names), out_path, n_files, sep)
        return Q.reject_counts(classified)
    Q.split(classified, quarantine)
    Q.write_split_csv(Q.accepted(spark, quarantine, names, sep), out_path, n_files, sep)
    return Q.quarantined(spark, quarantine).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("line_count"))


def mock_tables(spark, n_actions: int, n_users: int = 100, seed: int = 666) -> dict[str, DataFrame]:
    """Synthetic visit log and user table of the requested sizes (parallel,
    deterministic per id); registered as temp views ``user_visit_action`` and
    ``user_info``."""
    from visitflow.sources import synth
    from visitflow.sources.tables import register_views
    frames = {"user_visit_action": synth.synthetic_visits(spark.range(n_actions), "id", seed),
              "user_info": synth.synthetic_users(spark.range(n_users), "id", seed)}
    register_views(spark, frames)
    return frames
