"""Time queries on the events of ``$BENCH_SF_DIR`` a hundred times over, a third of them in one series.

Copies get shifted user ids and times within the same span. Writes rows per second to BENCH_SCALE.json and prints them.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from rentscope.plans.saved import drop_saved, new_path
from rentscope.registry.queries import queries
from rentscope.session import local_session

NAMES = [
    "price_summary", "price_volatility", "price_stats", "provider_windows", "offer_windows", "price_comparison", "hourly_series",
    "spread_analysis", "forecast_24h", "replay_all_types", "collect_run",
]
COPIES = int(os.environ.get("BENCH_COPIES", "100"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "16g", spark__sql__shuffle__partitions="32")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    copy, seconds = F.col("copy"), F.pmod(F.col("copy") * 7919, F.lit(1800))
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    hot = F.pmod(F.xxhash64("event_id", "copy"), F.lit(3)) == 0
    many = many.select(
        (F.col("event_id") + copy * 10**9).alias("event_id"),
        F.when(hot, F.lit("click")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(hot, F.lit(8)).otherwise(F.col("user_id") + copy * 8000).cast(events.schema["user_id"].dataType).alias("user_id"),
        (F.col("ts") + F.make_dt_interval(secs=seconds)).cast(events.schema["ts"].dataType).alias("ts"),
        (F.col("value") * (1 + F.rand(1) / 1000)).alias("value"),
        *[c for c in events.columns if c not in ("event_id", "event_type", "user_id", "ts", "value")],
    )
    folder = new_path(spark, "scale")
    many.write.parquet(f"{folder}/events.parquet")
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    registered = queries()
    registered["stats_overview"](spark, folder).collect()
    found = {}
    for name in NAMES:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        found[name] = {"sec": round(took, 2), "rows_per_sec": round(rows / took)}
        print(name, found[name], flush=True)
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "BENCH_SCALE.json"), "w", encoding="utf-8") as file:
        json.dump({"events": rows, "in_one_series": "a third", "queries": found}, file, indent=1)
    drop_saved(spark)
    spark.stop()


if __name__ == "__main__":
    main()
