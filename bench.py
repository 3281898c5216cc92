"""Benchmark the headline reports.

the match table at ``$BENCH_SF_DIR`` is stored as parquet once (untimed
setup; ``build_silver`` times the enrichment write and ``ingest_csv`` the
league-CSV -> bronze load, same median protocol), then
every report runs 3 warm-ups and 5 timed ``collect()`` runs; the median is
reported.

Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from oddsframe.operators.analysis import (  # noqa: E402
    hit_rate,
    hit_rate_levels,
    house_dispersion,
    match_lookup,
    outcome_share,
)
from oddsframe.operators.enrich import enrich  # noqa: E402
from oddsframe.plans.registry import MATCH_ID_TYPE, bronze, export_leagues  # noqa: E402
from oddsframe.sources.leagues import ingest  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARMUP, RUNS = 3, 5


def _session() -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{CPUS}]").appName("oddsframe-bench")
               .config("spark.sql.shuffle.partitions", CPUS)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.codegen.hugeMethodLimit", "8000")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.driver.memory", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _median(fn) -> float:
    for _ in range(WARMUP):
        fn()
    times = []
    for _ in range(RUNS):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    spark = _session()
    from oddsframe.session import scratch_dir

    # A fresh folder under the session's shared checkpoint root (Spark creates
    # it on the first write, whatever the filesystem scheme).
    work = scratch_dir(spark, "bench")
    bronze_path, silver_path = f"{work}/bronze", f"{work}/silver"
    # Setup: a bronze table of several files, as a real table would be.
    bronze(spark, SF_DIR).repartition(int(CPUS)).write.mode("overwrite").parquet(bronze_path)

    queries: dict[str, float] = {}

    def build() -> None:
        enrich(spark.read.parquet(bronze_path)).write.mode("overwrite").parquet(silver_path)

    queries["build_silver"] = _median(build)

    # Ingest: per-league CSV files (one carries an extra column) -> bronze.
    folders = export_leagues(spark, SF_DIR)
    bronze_csv = f"{work}/bronze_from_csv"

    def load() -> None:
        ingest(spark, folders, extra_types=MATCH_ID_TYPE).write.mode("overwrite").parquet(bronze_csv)

    queries["ingest_csv"] = _median(load)

    silver = spark.read.parquet(silver_path)

    reports = {
        "hit_rate_abs": lambda: hit_rate(silver).collect(),
        "hit_rate_weighted": lambda: hit_rate(silver, weighted=True).collect(),
        "hit_rate_abs_league": lambda: hit_rate(silver, by="league").collect(),
        "hit_rate_weighted_league": lambda: hit_rate(silver, by="league", weighted=True).collect(),
        "hit_rate_abs_month": lambda: hit_rate(silver, by="month").collect(),
        "hit_rate_weighted_month": lambda: hit_rate(silver, by="month", weighted=True).collect(),
        "house_dispersion": lambda: house_dispersion(silver).collect(),
        "outcome_share_half": lambda: outcome_share(silver, "HTR").collect(),
        "match_lookup": lambda: match_lookup(silver, "T3", "T10").collect(),
    }
    for name, fn in reports.items():
        queries[name] = _median(fn)
    # Every hit-rate level (overall, league, month; both rates) in one scan,
    # against the six separate reports above.
    queries["hit_rate_all_levels"] = _median(lambda: hit_rate_levels(silver).collect())
    headline = [q for q in reports]
    result = {
        "metric": "headline_reports_median_sum",
        "value": round(sum(queries[q] for q in headline), 4),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in queries.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "rows": silver.count(),
        "cpus": int(CPUS),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
