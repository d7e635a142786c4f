"""Command line: ``python -m encore <command> ...`` or the same with spark-submit.

    create  OUT                     drop the tables and create them empty
    etl     OUT --logs L --songs S  load the files and insert into all tables
    run     OUT --logs L --songs S  both of the above; a rerun gives the same tables
    layout  OUT --buckets N --database D    bucketed and sorted copies of the joined tables, brought up to date
    compact OUT                     the inserts of each table in one
    vacuum  OUT                     delete folders that no table has any more
    check   OUT                     violations of the declared constraints
    top-songs | top-artists  OUT --year Y [--top K] [--database D]
    sql     OUT "SELECT ..." --to PATH      any query on the tables by name

With --to PATH a result is written in full, as Parquet or, with --format json, as JSON lines;
sql always is. Other results are printed, as many rows as --rows says.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from encore.operators.quality import check_all
from encore.plans.pipeline import APPEND, OVERWRITE, run_pipeline, stored_month_counts
from encore.plans.reports import top_artists, top_songs
from encore.schemas import TABLES
from encore.session import DEFAULTS
from encore.sinks.layout import lay_out, read_tables
from encore.sinks.store import TableStore
from encore.sources.loaders import DOCUMENTS, LINES, QUARANTINE, STRICT


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="encore", description="Listening analytics on Spark")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("out", help="root folder of the tables")
        return sub

    for name in ("create", "compact", "vacuum"):
        command(name)
    for name in ("etl", "run"):
        sub = command(name)
        sub.add_argument("--logs", required=True)
        sub.add_argument("--songs", required=True)
        sub.add_argument("--on-bad-record", choices=[STRICT, QUARANTINE], default=STRICT)
        sub.add_argument("--songs-format", choices=[DOCUMENTS, LINES], default=DOCUMENTS)
    sub = command("layout")
    sub.add_argument("--buckets", type=int, required=True)
    sub.add_argument("--database", required=True)

    def result(sub: argparse.ArgumentParser, required: bool = False) -> argparse.ArgumentParser:
        sub.add_argument("--to", required=required, help="folder for the whole result")
        sub.add_argument("--format", choices=["parquet", "json"], default="parquet")
        if not required:
            sub.add_argument("--rows", type=int, help="how many rows to print; needed without --to")
        return sub

    result(command("check"))
    for name in ("top-songs", "top-artists"):
        sub = result(command(name))
        sub.add_argument("--year", type=int, required=True)
        sub.add_argument("--top", type=int, default=5)
        sub.add_argument("--database", help="where layout saved the tables")
    result(command("sql"), required=True).add_argument("query")
    return top


def execute(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Run one command; queries return their rows."""
    store = TableStore(spark, args.out)
    if args.command == "create":
        store.rebuild()
    elif args.command in ("etl", "run"):
        mode = APPEND if args.command == "etl" else OVERWRITE
        run_pipeline(
            spark, args.logs, args.songs, args.out, mode, args.on_bad_record, args.songs_format, told=report_load
        )
    elif args.command == "compact":
        for name in TABLES:
            store.compact(name)
    elif args.command == "vacuum":
        store.vacuum()
    elif args.command == "layout":
        lay_out(store, args.buckets, args.database)
    elif args.command == "check":
        return check_all({name: store.read(name) for name in TABLES})
    elif args.command == "sql":
        store.create_views()
        return spark.sql(args.query)
    else:
        tables = read_tables(store, args.database)
        fact, songs, artists, time = (tables[name] for name in ("songplays", "songs", "artists", "time"))
        counted = stored_month_counts(store)
        if args.command == "top-songs":
            return top_songs(fact, songs, artists, time, args.year, args.top, counted)
        return top_artists(fact, artists, time, args.year, args.top, counted)
    return None


def report_load(counts: dict[str, dict[str, int]]) -> None:
    for name, found in counts.items():
        print(f"{name}: {found['read']} records read, {found['left_out']} left out")


def deliver(found: DataFrame, args: argparse.Namespace) -> None:
    """Write a whole result, or print the rows asked for."""
    if args.to is not None:
        found.write.format(args.format).save(args.to)
    if getattr(args, "rows", None) is not None:
        found.show(args.rows, truncate=False)


def main() -> None:
    args = parser().parse_args()
    if hasattr(args, "rows") and args.to is None and args.rows is None:
        # top-k reports say by --top how many rows there are
        args.rows = getattr(args, "top", None)
        if args.rows is None:
            raise SystemExit("give --to PATH for the whole result or --rows N to print")
    builder = SparkSession.builder.appName("encore")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    found = execute(builder.getOrCreate(), args)
    if found is not None:
        deliver(found, args)


if __name__ == "__main__":
    main()
