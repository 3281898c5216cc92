"""Command line: build the layers from league files and print the reports.

    python -m oddsframe --sources /data/leagues/E0 /data/leagues/I1 \\
        --bronze bronze.europa --silver silver.europa [--location /shared/wh]

Every step is a Spark job; only the small report results are shown.
"""

from __future__ import annotations

import argparse

from .operators.analysis import hit_rate, house_dispersion, outcome_share
from .plans.layers import build_bronze, build_silver
from .session import get_session
from .sources.tables import display


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="oddsframe", description=__doc__.splitlines()[0])
    parser.add_argument("--sources", nargs="+", required=True, help="league CSV files or folders")
    parser.add_argument("--bronze", default="bronze.europa")
    parser.add_argument("--silver", default="silver.europa")
    parser.add_argument("--location", default=None, help="shared folder for the two databases")
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)

    spark = get_session(master=args.master)
    where = (lambda db: f"{args.location.rstrip('/')}/{db}.db") if args.location else (lambda db: None)
    build_bronze(spark, args.sources, args.bronze, where(args.bronze.rpartition(".")[0]))
    silver = build_silver(spark, args.bronze, args.silver, where(args.silver.rpartition(".")[0]))

    reports = [
        ("favourite hit rate, absolute", hit_rate(silver, formatted=True)),
        ("favourite hit rate, weighted", hit_rate(silver, weighted=True, formatted=True)),
        ("by league, absolute", hit_rate(silver, by="league", formatted=True)),
        ("by league, weighted", hit_rate(silver, by="league", weighted=True, formatted=True)),
        ("by month, absolute", hit_rate(silver, by="month", formatted=True)),
        ("by month, weighted", hit_rate(silver, by="month", weighted=True, formatted=True)),
        ("bookmaker dispersion around the consensus", house_dispersion(silver)),
        ("half-time outcome shares", outcome_share(silver, "HTR", formatted=True)),
    ]
    for title, df in reports:
        print(f"\n== {title}")
        display(df)


if __name__ == "__main__":
    main()
