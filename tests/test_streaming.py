"""Structured Streaming: raw CSV landing -> bronze -> silver -> running reports."""

from __future__ import annotations

import os

from oddsframe.operators.analysis import hit_rate
from oddsframe.operators.enrich import enrich
from oddsframe.session import scratch_dir, unique_name
from oddsframe.sources import leagues
from oddsframe.streaming import live

HEADER = "Div,Date,Time,HomeTeam,AwayTeam,FTR,B365H,B365D,B365A,BWH,BWD,BWA"
DAYS = [
    ["E0,11-08-2023,20:00,Burnley,Man City,A,8.0,5.5,1.33,7.5,5.25,1.36",
     "E0,12-08-2023,15:00,Arsenal,Forest,H,1.2,7.0,13.0,1.22,6.5,12.0"],
    ["I1,19-08-2023,18:30,Empoli,Verona,A,2.2,3.2,3.4,2.25,3.1,3.3",
     "I1,19-08-2023,20:45,Frosinone,Napoli,A,6.0,4.2,1.5,5.75,4.1,1.53"],
    ["E0,18-08-2023,20:00,Forest,Sheffield Utd,H,1.8,3.6,4.5,1.85,3.5,4.4",
     "E0,19-08-2023,12:30,Fulham,Brentford,A,2.6,3.4,2.7,2.6,3.3,2.75"],
]


def test_csv_landing_stream_matches_batch(spark):
    landing = scratch_dir(spark, "csv-landing")
    os.makedirs(landing)
    for i, day in enumerate(DAYS):
        with open(f"{landing}/day{i}.csv", "w", encoding="utf-8") as fh:
            fh.write("\n".join([HEADER, *day]) + "\n")
    schema = leagues.raw_schema(HEADER.split(","))
    streams = live.stream_session(spark, state_partitions=2)
    stream = live.match_stream(streams, landing, schema, fmt="csv", max_files_per_trigger=1)
    silver = live.silver_stream(leagues.normalise(stream))
    view = unique_name("live_rates")
    live.running_view(live.running_hit_rates(silver), view).awaitTermination()
    got = {r.league: (r.matches, r.hit_pct) for r in streams.table(view).collect()}
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"   # caller untouched

    batch = enrich(leagues.ingest(spark, [landing]))
    want = {r.league: r.hit_pct for r in hit_rate(batch, by="league").collect()}
    assert {k: v[1] for k, v in got.items()} == want
    assert got["Inglaterra"][0] == 4 and got["Itália"][0] == 2

    out = scratch_dir(spark, "live-silver")
    live.append_silver(silver, out).awaitTermination()
    assert spark.read.parquet(out).count() == 6
