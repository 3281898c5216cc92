"""Scale probe: replicate ``orders`` N times (fresh keys) into a scratch
folder, then time the layered build and the reports on it.

    python tools/scale_probe.py 40        # 40 x sf0.1 orders = 6M matches
    python tools/scale_probe.py 40 skew   # same, one league holds ~half the rows

Writes only under the session's checkpoint folder.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from oddsframe import enrich, get_session, hit_rate, house_dispersion, outcome_share  # noqa: E402
from oddsframe.plans.registry import bronze  # noqa: E402
from oddsframe.session import scratch_dir  # noqa: E402


def main(times: int, skew: bool = False, source: str = "/root/testdata/sf0.1") -> None:
    spark = get_session(master="local[8]", shuffle_partitions=8,
                        extra_conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark, f"scale{times}")
    orders = spark.read.parquet(f"{source}/orders.parquet")
    rep = F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("_rep")
    (orders.select("*", rep)
           .withColumn("o_orderkey", F.col("o_orderkey") * times + F.col("_rep"))
           .withColumn("o_custkey", F.col("o_custkey") + F.col("_rep") * 7)
           .drop("_rep").repartition(times)
           # skew: every third order joins the first priority (-> one league)
           .withColumn("o_orderpriority",
                       F.when(F.lit(skew) & (F.col("o_orderkey") % 3 == 0), F.lit("1-URGENT"))
                       .otherwise(F.col("o_orderpriority")))
           .write.parquet(f"{root}/orders.parquet"))
    out: dict[str, float] = {}
    t0 = time.perf_counter()
    bronze(spark, root).write.parquet(f"{root}/bronze")
    out["write_bronze"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    enrich(spark.read.parquet(f"{root}/bronze")).write.parquet(f"{root}/silver")
    out["build_silver"] = time.perf_counter() - t0
    silver = spark.read.parquet(f"{root}/silver")
    reports = {
        "hit_rate_abs_league": lambda: hit_rate(silver, by="league"),
        "hit_rate_weighted_month": lambda: hit_rate(silver, by="month", weighted=True),
        "house_dispersion": lambda: house_dispersion(silver),
        "outcome_share_half": lambda: outcome_share(silver),
    }
    for name, mk in reports.items():
        runs = []
        for _ in range(4):
            t = time.perf_counter()
            mk().collect()
            runs.append(time.perf_counter() - t)
        out[name] = statistics.median(runs[1:])
    rows = silver.count()
    top = silver.groupBy("League").count().orderBy(F.desc("count")).first()
    print(json.dumps({"times": times, "rows": rows, "skew": skew,
                      "largest_league_share": round(top["count"] / rows, 3),
                      "seconds": {k: round(v, 3) for k, v in out.items()},
                      "build_rows_per_s": round(rows / out["build_silver"])}))
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 10, skew="skew" in sys.argv[2:])
