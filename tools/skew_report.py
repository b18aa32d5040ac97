"""Skew check for the per-link deltas: one link is made to hold a third of all snapshots (derived from the
``events`` table), then the plain ``lag() over (partition by link)`` and the chunked operator both run; the Spark event
log (written to a scratch folder) gives the records each shuffle-reading task got. Prints, per variant, the largest
share of a stage's shuffle records that a single task read.

usage: python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from snapmetrics.operators.ordered import chunked_lag  # noqa: E402
from snapmetrics.session import configure  # noqa: E402


def skewed_snapshots(spark: SparkSession, sf_dir: str):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    user = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    return ev.select(
        "event_id", "ts", F.to_date("ts").alias("day"),
        F.concat(F.lit("https://s.example.bg/a/"), user.cast("string")).alias("link"),
        (F.col("value") * 100).cast("bigint").alias("views"),
    )


def stage_skew(log_dir: str) -> dict[int, tuple[int, int]]:
    """stage id -> (max records read by one task, total records read) over shuffle-reading stages."""
    per_stage: dict[int, list[int]] = defaultdict(list)
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if read:
                    per_stage[ev["Stage ID"]].append(read)
    return {s: (max(v), sum(v)) for s, v in per_stage.items()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    results = {}
    for variant in ["plain window", "chunked (link, day)"]:
        log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
        spark = (
            SparkSession.builder.master("local[8]")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", log_dir)
            .config("spark.eventLog.compress", "false")
            .config("spark.eventLog.rolling.enabled", "false")
            .config("spark.sql.shuffle.partitions", "32")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
            .getOrCreate()
        )
        spark.sparkContext.setLogLevel("ERROR")
        configure(spark)
        snaps = skewed_snapshots(spark, sf_dir)
        if variant == "plain window":
            w = Window.partitionBy("link").orderBy("ts", "event_id")
            out = snaps.withColumn("prev_views", F.lag("views").over(w))
        else:
            out = chunked_lag(snaps, ["link"], "day", ["ts", "event_id"], ["views"])
        out.write.format("noop").mode("overwrite").save()
        spark.stop()
        skew = stage_skew(log_dir)
        # the stage that read the most shuffle records is the window stage
        biggest = max(skew.values(), key=lambda t: t[1])
        results[variant] = biggest
    print("| variant | records read by the busiest task | records read by the stage | busiest task share |")
    print("| --- | --- | --- | --- |")
    for k, (mx, tot) in results.items():
        print(f"| {k} | {mx} | {tot} | {mx / tot:.1%} |")


if __name__ == "__main__":
    main()
