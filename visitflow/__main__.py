"""Command-line entry point: ``python -m visitflow <job> ...`` (or the same
module through spark-submit). Each job reads parquet inputs, takes its task
parameters from a JSON document (``--task-json``) or a task table
(``--tasks PATH --task-id N``), and writes its results as parquet tables
under ``--out``. The session is the one spark-submit provides (or a local
one when run directly).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _params(spark, args):
    from visitflow.sources.params import TaskParams, load_task_params
    if args.tasks:
        params = load_task_params(spark.read.parquet(args.tasks), args.task_id)
        if params is None:
            raise SystemExit(f"no task {args.task_id} in {args.tasks}")
        return params
    doc = json.loads(args.task_json or "{}")
    tasks = spark.createDataFrame([(args.task_id, json.dumps(doc))], "task_id BIGINT, task_param STRING")
    return load_task_params(tasks, args.task_id) or TaskParams(task_id=args.task_id)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="visitflow")
    sub = ap.add_subparsers(dest="job", required=True)

    def with_task(p):
        p.add_argument("--task-json", help='e.g. {"startAge": ["20"], "targetPageFlow": ["1,2,3"]}')
        p.add_argument("--tasks", help="parquet table (task_id, task_param)")
        p.add_argument("--task-id", type=int, default=1)
        p.add_argument("--out", required=True)
        return p

    p = with_task(sub.add_parser("session-analysis"))
    p.add_argument("--actions", required=True)
    p.add_argument("--users", required=True)
    p.add_argument("--sample-size", type=int, default=100)
    p = with_task(sub.add_parser("page-conversion"))
    p.add_argument("--actions", required=True)
    p = with_task(sub.add_parser("area-top-products"))
    p.add_argument("--actions", required=True)
    p.add_argument("--cities", required=True)
    p = sub.add_parser("ad-clicks")
    p.add_argument("--messages", required=True, help="folder of message text files")
    p.add_argument("--sink", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--watermark", default=None, help="drop state, and lose clicks, older than this")
    p.add_argument("--available-now", action="store_true")
    p = sub.add_parser("csv-split")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--fields", type=int, required=True)
    p.add_argument("--files", type=int, help="number of output files; as many as input splits when not given")
    p = sub.add_parser("mock-tables")
    p.add_argument("--actions-rows", type=int, required=True)
    p.add_argument("--users-rows", type=int, default=100)
    p.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    from visitflow.config import apply_settings
    from visitflow.plans import jobs
    spark = apply_settings(SparkSession.builder.getOrCreate())

    if args.job == "session-analysis":
        jobs.session_analysis(spark.read.parquet(args.actions), spark.read.parquet(args.users),
                              _params(spark, args), sample_size=args.sample_size, out_dir=args.out)
    elif args.job == "page-conversion":
        jobs.page_conversion(spark.read.parquet(args.actions), _params(spark, args), out_dir=args.out)
    elif args.job == "area-top-products":
        jobs.area_top_products(spark.read.parquet(args.actions), spark.read.parquet(args.cities),
                               _params(spark, args), out_dir=args.out)
    elif args.job == "ad-clicks":
        from visitflow.streaming.ad_clicks import file_messages
        q = jobs.ad_click_counts(file_messages(spark, args.messages), args.sink, args.checkpoint,
                                 watermark=args.watermark, available_now=args.available_now)
        q.awaitTermination()
    elif args.job == "csv-split":
        rejects = jobs.split_valid_csv(spark, args.input, args.output, args.fields, n_files=args.files)
        for row in rejects.collect():  # one row per reject reason
            print(f"{row.reject_reason}\t{row.line_count}")
    elif args.job == "mock-tables":
        frames = jobs.mock_tables(spark, args.actions_rows, args.users_rows)
        from visitflow.sources.tables import normalize_text_log
        normalize_text_log(frames["user_visit_action"]).write.mode("overwrite").parquet(f"{args.out}/actions")
        frames["user_info"].write.mode("overwrite").parquet(f"{args.out}/users")
    return 0


if __name__ == "__main__":
    sys.exit(main())
