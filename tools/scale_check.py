"""Timing of the core operators on a larger, optionally skewed visit log.

The sf0.1 visit log is replicated ``--copies`` times (each copy with its own
session and event ids), then the core operators run on it. With ``--skew`` a
third of all rows (event_id % 3 == 0) is moved into one session, the case the
hot-session paths exist for. Prints a markdown table (median of 3 runs, output
forced with the noop writer) and the largest share of rows that any one task
of the session-ordered window receives.

Usage: python tools/scale_check.py [--copies 50] [--skew] [--cores 8]
"""

from __future__ import annotations

import argparse
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--copies", type=int, default=50)
    ap.add_argument("--skew", action="store_true")
    ap.add_argument("--cores", default="8")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    args = ap.parse_args()

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from visitflow.config import local_session, shared_dir
    from visitflow.operators import categories as C
    from visitflow.operators import funnel as FN
    from visitflow.operators import ordering as O
    from visitflow.operators import sampling as Y
    from visitflow.operators import sessions as S
    from visitflow.sources.adapter import SuppliedTables

    spark = local_session(cores=args.cores, shuffle_partitions=32)
    shared_dir(spark)
    t = SuppliedTables(spark, args.sf_dir)
    big = (t.actions().crossJoin(spark.range(args.copies).withColumnRenamed("id", "copy"))
           .withColumn("session_id", F.concat("session_id", F.lit("_"), F.col("copy").cast("string")))
           .withColumn("event_id", F.col("event_id") * args.copies + F.col("copy")).drop("copy"))
    if args.skew:
        big = big.withColumn("session_id", F.when(F.col("event_id") % 3 == 0, F.lit("hot"))
                             .otherwise(F.col("session_id")))
    big = big.repartition(32).cache()
    rows = big.count()

    def timed(make) -> float:
        runs = []
        for i in range(4):
            t0 = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        return statistics.median(runs)

    cases = {
        "aggregate_sessions": lambda: S.aggregate_sessions(big),
        "category_counts": lambda: C.category_counts(big),
        "top_sessions_per_category": lambda: C.top_sessions_per_category(C.session_category_clicks(big), 10),
        "previous_row (auto)": lambda: O.with_previous(big, ["page_id"]),
        "previous_row (plain window)": lambda: big.select(
            "session_id", "event_id", F.lag("page_id").over(
                Window.partitionBy("session_id").orderBy("action_time", "event_id")).alias("prev")),
        "page_convert_rate": lambda: FN.page_convert_rate(big, "1,2,3,4,5,6,7,8,9"),
        "stratified_sample N=2000": lambda: Y.stratified_sample(
            S.aggregate_sessions(big).drop("keywords", "category_ids"), 2000, 42),
    }
    S.aggregate_sessions(big).write.format("noop").mode("overwrite").save()  # JVM warm-up, not timed
    print(f"rows: {rows:,}; copies: {args.copies}; skew: {args.skew}; cores: {args.cores}\n")
    print("| operator | median sec |\n| --- | --- |")
    for name, make in cases.items():
        print(f"| {name} | {timed(make):.2f} |", flush=True)

    def max_share(df, col) -> float:
        counts = [r.n for r in df.groupBy(F.spark_partition_id().alias("_p"))
                  .agg(F.count(F.lit(1)).alias("n"), F.max(col).alias("m")).collect()]
        return max(counts) / sum(counts)

    spark.conf.set("spark.sql.adaptive.enabled", "false")  # measure the raw partitioning
    plain = big.withColumn("prev", F.lag("page_id").over(
        Window.partitionBy("session_id").orderBy("action_time", "event_id")))
    bucketed = O.with_previous(big, ["page_id"])
    print(f"\nlargest task share of the session window: plain {max_share(plain, 'prev'):.3f}, "
          f"ranges {max_share(bucketed, 'prev_page_id'):.3f}")


if __name__ == "__main__":
    main()
