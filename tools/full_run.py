"""The whole flow at the published data size: 2,000,000 incidents.

    python tools/full_run.py [--events FILE] [--copies N]

The events table is repeated under new ids and shifted times until it has the size,
then goes through publish, stream, silver, gold, features and the three experiments.
Prints one JSON line with seconds per step.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from incidentlake.operators.features import feature_table  # noqa: E402
from incidentlake.plans.experiments import (  # noqa: E402
    ExperimentConfig, run_binary, run_density, run_protocol,
)
from incidentlake.plans.findings import eda_summary  # noqa: E402
from incidentlake.plans.layers import refine_to_gold, refine_to_silver, write_marts  # noqa: E402
from incidentlake.registry.binding import incidents  # noqa: E402
from incidentlake.session import get_session  # noqa: E402
from incidentlake.sources import publish_events, read_table, write_table  # noqa: E402
from incidentlake.streaming import ingest  # noqa: E402


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.1")
    parser.add_argument("--copies", type=int, default=20)
    parser.add_argument("--cpus", default=os.environ.get("BENCH_CPUS", "8"))
    args = parser.parse_args()
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = get_session("full-run", **{
        "spark.master": f"local[{args.cpus}]", "spark.sql.shuffle.partitions": "16",
        "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    events = spark.read.parquet(f"{args.sf}/events.parquet")
    n = events.count()
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(args.copies - 1))))
    (
        copies.withColumn("event_id", F.col("event_id") + F.col("copy") * n)
        .withColumn("ts", F.expr("ts + make_interval(0, 0, 0, copy * 15, copy)"))
        .drop("copy").repartition(16).write.parquet(f"{root}/events.parquet")
    )

    steps, details = {}, {}

    def timed(name, work):
        start = time.time()
        details[name] = work()
        steps[name] = round(time.time() - start, 1)
        print(name, steps[name], details[name], flush=True)

    def scored(result):
        rows = {r["model"]: [round(v, 4) for v in list(r)[1:]] for r in result.metrics.collect()}
        return {"best": result.best, **rows, "failures": result.failures}

    paths = {k: f"{root}/{k}" for k in ("topic", "bronze", "checkpoint", "silver", "gold", "a")}
    timed("publish", lambda: publish_events(
        incidents(spark, root), "files", paths["topic"], timestamp="ts"))
    timed("ingest", lambda: ingest(
        spark, paths["bronze"], paths["checkpoint"], path=paths["topic"]) and None)
    timed("silver", lambda: refine_to_silver(spark, paths["bronze"], paths["silver"]))
    timed("gold", lambda: refine_to_gold(spark, paths["silver"], paths["gold"]) and None)
    timed("marts", lambda: len(write_marts(spark, paths["gold"], f"{root}/marts")))
    silver = read_table(spark, paths["silver"])
    timed("features", lambda: write_table(feature_table(silver, "A", keep=["crime_id"]), paths["a"]) and None)
    timed("eda_summary", lambda: eda_summary(silver, "crime_timestamp").count())
    timed("experiment_arrest", lambda: scored(run_binary(
        read_table(spark, paths["a"]), ExperimentConfig("arrest", keys=["crime_id"]))))
    timed("experiment_density", lambda: scored(run_density(silver, ExperimentConfig("density"))))
    timed("experiment_protocol", lambda: scored(run_protocol(
        feature_table(silver, "C"), ExperimentConfig("protocol"))))
    print(json.dumps({"rows": n * args.copies, "cpus": int(args.cpus), "seconds": steps}))
    spark.stop()


if __name__ == "__main__":
    main()
