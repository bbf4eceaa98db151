"""Command line for the scheduled jobs and the reports.

    spark-submit --py-files adlens.zip adlens/plans/cli.py daily  --traffic P --conversion P --output P [--since YYYY-MM-DD]
    spark-submit --py-files adlens.zip adlens/plans/cli.py report --traffic P --conversion P --results P
                 [--window today|yesterday|last7days] [--as-of YYYY-MM-DD] [--until-as-of]
                 [--history P] [--account NAME] [--run-timestamp T] [--rules P]
    ... campaigns | account | keywords | recommendations  --traffic P --conversion P --results P [--window W] ...
    ... history --history P [--keep N] --results P
    ... arrivals --traffic P --conversion P --arrival-map P --closed-before YYYY-MM-DD

``--format csv|parquet`` says how to read the inputs; ``--format table`` takes
them as catalog names (``db.table``).  ``daily`` writes the daily table
partitioned by date and the anomaly digest; ``report`` writes the report rows,
summary, alerts, alert digest, bid adjustments and rejected rules, each as a
parquet folder under ``--results``, and appends the summary to the history
table; the others write one parquet folder.  From CSV feeds, both count malformed
values per column in the scan they make anyway (``rejected``; ``report`` writes it with the
rest), and ``--quarantine P`` keeps the rows at fault.  ``arrivals`` enters closed arrival days into a
map of the event dates they hold; with ``--arrival-map P`` a command reads only days that matter to it.  The session comes from
``spark-submit``; the library's session defaults are applied and shuffles are
sized to the input.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adlens.functions.dates import window_bounds
from adlens.operators import reports
from adlens.plans import jobs
from adlens.schema import CONVERSION_RAW, TRAFFIC_RAW
from adlens.session import apply_defaults, input_bytes, size_shuffles
from adlens.sources import history, readers
from adlens.sources.arrivals import ArrivalMap


def _first_date(args) -> dt.date | None:
    """The earliest event date the command reads, to prune arrivals by."""
    if args.job == "daily":
        return args.since
    # Without --as-of the day is the session's; a day to spare covers a change of date while we run.
    today = args.as_of or dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    return window_bounds(args.window, today)[0]


def _last_date(args) -> dt.date | None:
    """The latest event date the command reads; None where there is no bound."""
    if args.job == "daily" or args.as_of is None or (args.window == "last7days" and not args.bounded):
        return None
    return window_bounds(args.window, args.as_of)[1]


FEEDS = {"traffic": TRAFFIC_RAW, "conversion": CONVERSION_RAW}


def _inputs(spark: SparkSession, args) -> tuple[tuple[DataFrame, DataFrame], dict[str, Observation]]:
    """The two canonical frames, and what counts the malformed values of CSV feeds while a job reads them."""
    rejects = {feed: Observation(f"rejected-{feed}") for feed in FEEDS} if args.format == "csv" and args.job in ("daily", "report") else {}

    def raw(feed):
        name, held = getattr(args, feed), None
        if args.arrival_map:
            held = ArrivalMap(spark, f"{args.arrival_map.rstrip('/')}/{feed}").holds(_first_date(args), _last_date(args))
        if args.format == "table":
            rows = readers.arrivals_since(readers.table(spark, name), _first_date(args))
            return rows if held is None else rows.filter(held)
        return readers.read_source(spark, name, args.format, FEEDS[feed], rejects.get(feed), _first_date(args), held)

    traffic, conversion = raw("traffic"), raw("conversion")
    size_shuffles(spark, input_bytes(traffic, conversion))
    return (readers.prepare_traffic(traffic), readers.prepare_conversion(conversion, args.attribution)), rejects


def _quarantine(spark: SparkSession, args, rejected: DataFrame) -> None:
    """Write the rows with malformed values; a feed in which the job counted none is not read again."""
    for feed, schema in FEEDS.items():
        if rejected.filter((F.col("feed") == feed) & (F.col("rejected") > 0)).limit(1).count():
            rows = readers.rejected_rows(spark, getattr(args, feed), schema, _first_date(args))
            rows.write.mode("overwrite").parquet(f"{args.quarantine.rstrip('/')}/{feed}")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="adlens")
    sub = parser.add_subparsers(dest="job", required=True)
    for name in ("daily", "report", "campaigns", "account", "keywords", "recommendations"):
        p = sub.add_parser(name)
        p.add_argument("--traffic", required=True)
        p.add_argument("--conversion", required=True)
        p.add_argument("--format", default="csv", choices=["csv", "parquet", "table"])
        p.add_argument("--attribution", default="1d", choices=["1d", "7d", "14d", "30d"])
        p.add_argument("--arrival-map", dest="arrival_map", help="read only arrivals that hold dates of the window, by this map (see: arrivals)")
        if name in ("daily", "report"):
            p.add_argument("--quarantine", help="write rows of CSV feeds that hold malformed values here")
        if name == "daily":
            p.add_argument("--output", required=True)
            p.add_argument("--days", type=int, default=7)
            p.add_argument("--since", type=dt.date.fromisoformat, default=None,
                           help="recompute only dates from this one on (late data), exactly")
            continue
        p.add_argument("--results", required=True)
        p.add_argument("--window", default="last7days" if name == "recommendations" else "today")
        p.add_argument("--as-of", dest="as_of", type=dt.date.fromisoformat, default=None)
        p.add_argument("--until-as-of", dest="bounded", action="store_true", help="end last7days at the --as-of date")
        if name == "report":
            p.add_argument("--history")
            p.add_argument("--account", default=history.DEFAULT_ACCOUNT)
            p.add_argument("--run-timestamp", dest="run_timestamp", default=None,
                           help="the scheduled time, so that a retried run counts once in the history")
        if name in ("report", "recommendations"):
            p.add_argument("--rules")
        if name in ("campaigns", "keywords", "recommendations"):
            p.add_argument("--campaign", default=None)
        if name == "keywords":
            p.add_argument("--keyword", default=None)
            p.add_argument("--limit", type=int, default=10)
            p.add_argument("--mode", default="attributed", choices=["attributed", "as_written"])
    p = sub.add_parser("arrivals")
    for feed in FEEDS:
        p.add_argument(f"--{feed}", required=True)
    p.add_argument("--format", default="csv", choices=["csv", "parquet", "table"])
    p.add_argument("--arrival-map", dest="arrival_map", required=True)
    p.add_argument("--closed-before", dest="closed_before", type=dt.date.fromisoformat, required=True,
                   help="no more files come for arrival days before this one")
    p = sub.add_parser("history")
    p.add_argument("--history", required=True)
    p.add_argument("--keep", type=int, default=history.HISTORY_KEEP)
    p.add_argument("--results", required=True)
    return parser


def run(spark: SparkSession, argv: list[str] | None = None) -> dict[str, DataFrame]:
    args = _parser().parse_args(argv)
    apply_defaults(spark)
    if args.job == "arrivals":
        for feed, schema in FEEDS.items():
            name = getattr(args, feed)
            raw = readers.table(spark, name) if args.format == "table" else readers.read_source(spark, name, args.format, schema)
            ArrivalMap(spark, f"{args.arrival_map.rstrip('/')}/{feed}").update(raw, args.closed_before)
        return {}
    if args.job == "history":
        out = {"history": history.history_read(spark, args.history, args.keep)}
    else:
        frames, rejects = _inputs(spark, args)
        out = _run(spark, args, *frames, rejects)
        if rejects and args.quarantine:
            _quarantine(spark, args, out["rejected"])
    if args.job != "daily":
        root = args.results.rstrip("/")
        for name, df in out.items():
            if name != "run":
                df.write.mode("overwrite").parquet(f"{root}/{name}")
    return out


def _run(spark: SparkSession, args, traffic: DataFrame, conversion: DataFrame, rejects: dict[str, Observation]) -> dict[str, DataFrame]:
    if args.job == "daily":
        if args.since is not None:
            traffic = traffic.filter(traffic.event_date >= args.since)
            conversion = conversion.filter(conversion.event_date >= args.since)
        out = jobs.daily_job(spark, traffic, conversion, args.output, days=args.days, since=args.since, rejects=rejects)
        out["digest"].write.mode("overwrite").json(f"{args.output.rstrip('/')}_anomaly_digest")
        return out
    if args.job == "report":
        return jobs.report_job(spark, traffic, conversion, args.window, args.as_of, history_path=args.history,
                               rules_path=args.rules, account_id=args.account, run_timestamp=args.run_timestamp,
                               bounded=args.bounded, rejects=rejects)
    both = (traffic, conversion, args.window, args.as_of)
    if args.job == "campaigns":
        return {"campaigns": reports.campaign_report(*both, campaign_id=args.campaign, bounded=args.bounded)}
    if args.job == "account":
        return {"account": reports.account_report(*both, bounded=args.bounded)}
    if args.job == "keywords":
        return {"keywords": reports.keyword_report(*both, campaign_id=args.campaign, keyword=args.keyword, limit=args.limit,
                                                   mode=args.mode, bounded=args.bounded)}
    return {"recommendations": jobs.recommendations(traffic, conversion, args.campaign, args.window, args.as_of,
                                                    rules_path=args.rules)}


def main() -> None:
    spark = SparkSession.builder.appName("adlens").getOrCreate()
    run(spark)


if __name__ == "__main__":
    main()
