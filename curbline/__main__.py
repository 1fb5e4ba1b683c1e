"""Command line: ``python -m curbline`` (or ``spark-submit curbline/__main__.py``).

    python -m curbline --tickets 'violations/*.csv' --segments centerline.csv \
        --out report_dir --preset canonical --format text

Reads the positional CSV sources, builds the segment report under a preset
(optionally overridden), and writes it with one of the sinks.
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from curbline.plans.report import segment_report
from curbline.policy import PRESETS, MatchPolicy, preset
from curbline.session import build_session
from curbline.sources.csv_io import (
    count_sink,
    read_segments_csv,
    read_tickets_csv,
    write_report_csv,
    write_report_parquet,
    write_report_text,
)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="curbline", description=__doc__.splitlines()[0])
    p.add_argument("--tickets", required=True, nargs="+", help="ticket CSV file(s), folder(s) or glob(s)")
    p.add_argument("--segments", required=True, nargs="+", help="segment CSV file(s)")
    p.add_argument("--out", help="output folder (not needed for --format count)")
    p.add_argument("--overwrite", action="store_true", help="replace an existing output folder (otherwise an error)")
    p.add_argument("--preset", default="canonical", choices=sorted(PRESETS))
    p.add_argument("--format", default="csv", choices=("csv", "text", "parquet", "count"))
    p.add_argument("--years", help="comma-separated window, e.g. 2015,2016,2017,2018,2019")
    p.add_argument("--set", action="append", default=[], metavar="FIELD=VALUE",
                   help="override a MatchPolicy field, e.g. --set bin_width=50 --set dedup=id_ticket")
    p.add_argument("--year-from-file-name", action="store_true",
                   help="keep only rows whose year equals the year in their file name")
    p.add_argument("--multiline", action="store_true", help="CSV fields may contain line breaks")
    p.add_argument("--master", default=None, help="Spark master when not started by spark-submit")
    args = p.parse_args(argv)
    if args.format != "count" and not args.out:
        p.error("--out is required unless --format count")
    return args


def policy_overrides(pairs: list[str]) -> dict:
    """``FIELD=VALUE`` strings -> typed MatchPolicy overrides (validated by the policy)."""
    fields = {f.name: f for f in dataclasses.fields(MatchPolicy)}
    out = {}
    for pair in pairs:
        name, sep, raw = pair.partition("=")
        if not sep or name not in fields or name in ("name", "years"):
            raise SystemExit(f"--set expects FIELD=VALUE with a policy field; got {pair!r}")
        default = getattr(MatchPolicy(), name)
        if raw.lower() in ("none", "null") and name == "bin_width":
            out[name] = None
        elif isinstance(default, bool):
            out[name] = raw.lower() in ("1", "true", "yes")
        elif isinstance(default, int) or name == "bin_width":
            out[name] = int(raw)
        else:
            out[name] = raw
    return out


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    overrides = policy_overrides(args.set)
    if args.years:
        overrides["years"] = tuple(int(y) for y in args.years.split(","))
    policy = preset(args.preset, **overrides)  # validates before Spark starts
    spark = build_session(args.master)
    tickets = read_tickets_csv(spark, args.tickets, multiline=args.multiline,
                               year_from_file_name=args.year_from_file_name)
    segments = read_segments_csv(spark, args.segments, multiline=args.multiline)
    report = segment_report(tickets, segments, policy)
    mode = "overwrite" if args.overwrite else "errorifexists"
    if args.format == "count":
        print(count_sink(report))
    elif args.format == "csv":
        write_report_csv(report, args.out, mode=mode)
    elif args.format == "text":
        write_report_text(report, args.out, mode=mode)
    else:
        write_report_parquet(report, args.out, mode=mode)
    return 0


if __name__ == "__main__":
    sys.exit(main())
