"""Measure how much of a hot group any single task handles.

Builds a table where one group holds a third of all rows, runs the skew-sensitive operators
and reads Spark's event log (written to a fresh scratch folder) for the largest number of
records one task read (input + shuffle) relative to the hot group's size. A naive
``row_number() OVER (PARTITION BY g ...)`` is included as the contrast.

Usage: python tools/skew_check.py [rows] [event_log_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window, functions as F  # noqa: E402

from surveyspark.operators import aggregates as A  # noqa: E402
from surveyspark.operators import impute as I  # noqa: E402
from surveyspark.operators import sampling as K  # noqa: E402
from surveyspark.session import get_spark, reliable_checkpoint  # noqa: E402


def task_records(log_dir: str) -> dict[str, int]:
    """Largest per-task records read (input + shuffle) per job group."""
    worst: dict[str, int] = {}
    stage_group: dict[int, str] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, errors="ignore") as fh:
            for line in fh:
                try:
                    e = json.loads(line)
                except ValueError:
                    continue
                if e.get("Event") == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif e.get("Event") == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    recs = (m.get("Input Metrics", {}).get("Records Read", 0)
                            + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
                    g = stage_group.get(e.get("Stage ID"))
                    if g:
                        worst[g] = max(worst.get(g, 0), recs)
    return worst


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 600_000
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    # coalescing off: at test size AQE would merge every shuffle partition into one task,
    # which hides how the rows are actually partitioned
    spark = get_spark("local[8]", 32, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                             "spark.eventLog.compress": "false",
                                             "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    base = spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("g"),
        ((F.col("id") * 7919) % 100003 / 7.0).alias("v"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 11).alias("a"))
    df = reliable_checkpoint(base.repartition(16))
    hot = n // 3 + 1
    runs = {
        "naive window rank": lambda: df.withColumn("r", F.row_number().over(
            Window.partitionBy("g").orderBy("v", "id"))).agg(F.max("r")),
        "hash_rank (K4/K5)": lambda: K.hash_rank(df, "id", 42, ["g"]).agg(F.max("_rank")),
        "group modes + fill (I6)": lambda: I.impute_by_group_mode(df.select("g", "a"), "g").agg(F.count("a")),
        "exact group median": lambda: A.quantile_exact(df, ["g"], "v").agg(F.count("*")),
        "group median fill (I3)": lambda: I.impute_group_median(
            df.select("g", "id", F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("v")).alias("v")),
            "v", ["g"], F.lit(True)).agg(F.count("v")),
        "group modes (A5)": lambda: A.group_mode(df, "g", ["a"]).agg(F.count("*")),
        "stratified split (K4)": lambda: K.stratified_split(df, "id", "g", 0.8, 42, part_col="p").agg(F.sum("p")),
        "exact-size sample (K2)": lambda: K.sample_n(df, "id", 5000, 42).agg(F.count("*")),
    }
    print(f"rows={n} hot group rows={hot}")
    for name, make in runs.items():
        sc.setJobGroup(name, name)
        make().collect()
    spark.stop()
    worst = task_records(log_dir)
    for name in runs:
        w = worst.get(name, 0)
        print(f"{name:28s} largest task read {w:>9,d} records = {w / hot:6.1%} of the hot group")


if __name__ == "__main__":
    main()
