"""Command line: loads, exports, reports, source health and the temporal index, over local folders."""

from __future__ import annotations

import argparse
import datetime
import json
import os
from dataclasses import asdict
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.values import week_tag
from .operators import health, mart, reports, temporal, walkforward
from .session import session, tag_query
from .sources import archive, load

#: Commands over a folder of weekly release folders.
_RELEASES = ("release", "stability", "index", "components", "meta-index", "candidates")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quorumrank", description=main.__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in _RELEASES:
        sub = commands.add_parser(name)
        sub.add_argument("root", help="folder of weekly release folders")
        sub.add_argument("--output", help="file to write; a report goes to the screen without it")
        if name == "components":
            sub.add_argument("--snapshot", help="CSV of the components to write, compressed as its name says")
    sub = commands.add_parser("health")
    sub.add_argument("log")
    sub.add_argument("sources", nargs="+")
    sub = commands.add_parser("load")
    sub.add_argument("source", choices=sorted(load.NORMALISED))
    sub.add_argument("--ingests", required=True, help="folder of ingest records")
    sub.add_argument("--tables", required=True, help="folder of raw tables")
    sub.add_argument("--log", required=True)
    sub.add_argument("--date", type=datetime.date.fromisoformat, default=datetime.date.today())
    sub.add_argument("--secret", action="append", default=[], help="environment variable whose value must not be logged")
    sub = commands.add_parser("export")
    sub.add_argument("mart", help="the mart as Parquet")
    sub.add_argument("output", help="folder of weekly release folders")
    sub.add_argument("--log", help="update log, for the sources' statuses")
    sub.add_argument("--tag", help="release tag; by default the week of the snapshot")
    sub.add_argument("--prefix", default=archive.FILE_PREFIX, help="what the archive's file name begins with")
    return parser


def _load(spark: SparkSession, asked: argparse.Namespace) -> int:
    def rows():
        return load.normalised_rows(spark, archive.read_ingest(asked.ingests, asked.source, asked.date.isoformat()))

    state = load.load_source(
        spark, asked.source, rows, f"{asked.tables}/{asked.source}", asked.log, asked.date,
        secrets=[os.environ.get(n, "") for n in asked.secret]
    )
    print(json.dumps(asdict(state)))
    return 0


def _export(spark: SparkSession, asked: argparse.Namespace) -> int:
    rows = mart.public_archive(spark.read.parquet(asked.mart))
    day = rows.agg(F.max("snapshot_date")).first()[0]
    sources = {}
    if asked.log:
        status = health.source_status(spark.read.schema(health.LOG_SCHEMA).parquet(asked.log), F.lit(day))
        sources = {r.source: {"status": r.status, "row_count": r.row_count, "age_days": r.age_days} for r in status.collect()}  # a row for each source
    release = archive.export_archive(
        rows, asked.output, asked.tag or week_tag(day), sources, datetime.datetime.now(datetime.UTC), asked.prefix
    )
    print(release.csv_path)
    return 0


def _index(spark: SparkSession, asked: argparse.Namespace, found: list[archive.Release]) -> int:
    """The index, its lineage beside it, or the report of its components."""
    found = archive.within_window(found, temporal.HISTORY_WINDOW)
    slots = archive.validate_history(found, temporal.HISTORY_WINDOW)
    archive.check_rows(spark, found)
    history, day = temporal.history(archive.history_rows(spark, found, slots), temporal.HISTORY_WINDOW), found[-1].snapshot_date
    parts = temporal.components(history)
    if asked.command == "components":
        if asked.snapshot:
            archive.write_deterministic_csv(parts.orderBy("rank", "registered_domain"), asked.snapshot)
        return _put(reports.component_report(parts, f"Index components of {day}"), asked.output)
    index, path = temporal.temporal_index(history, F.lit(day)), asked.output or f"index_{day}.csv.gz"
    rows = archive.write_deterministic_csv(index, path)
    archive.index_lineage(
        f"{path}.json", path, found, slots, index, rows, temporal.band_summary(parts), datetime.datetime.now(datetime.UTC)
    )
    print(rows, "rows")
    return 0


def _walk(spark: SparkSession, asked: argparse.Namespace, found: list[archive.Release]) -> int:
    """Every candidate over all weeks from the oldest release to the newest."""
    weeks = (found[-1].snapshot_date - found[0].snapshot_date).days // 7 + 1
    slots = archive.week_grid(found[-1].tag, weeks + 1)
    slots = slots[slots.index(found[0].tag) :]
    if len(slots) < temporal.HISTORY_WINDOW:
        raise SystemExit(f"{temporal.HISTORY_WINDOW} weeks are needed, the releases span {len(slots)}")
    history = temporal.history(archive.history_rows(spark, found, slots), len(slots), latest_only=False)
    meta = asked.command == "meta-index"
    values = (walkforward.meta_candidates if meta else walkforward.index_candidates)(history, len(slots))
    rows = walkforward.evaluate(values, temporal.HISTORY_WINDOW - 1, len(slots) - 1, shocks=not meta)
    return _put(
        reports.walkforward_report(rows, f"{'Meta-index' if meta else 'Index candidates'} up to {found[-1].tag}"), asked.output
    )


def _put(text: str, output: str | None) -> int:
    if output:
        Path(output).write_text(text)
    else:
        print(text)
    return 0


def main(args: list[str] | None = None) -> int:
    """``load SOURCE``, ``export MART DIR``, ``health LOG SOURCE...`` and, over a folder of releases, ``release``,
    ``stability``, ``index``, ``components``, ``meta-index`` and ``candidates``; health ends with 2 where two sources are
    unhealthy."""
    parser = _parser()
    asked = parser.parse_args(args)
    spark = session()
    if asked.command in ("load", "export"):
        return (_load if asked.command == "load" else _export)(spark, asked)
    if asked.command == "health":
        rows = health.source_health(spark.read.schema(health.LOG_SCHEMA).parquet(asked.log), asked.sources)
        print(reports.health_summary(rows))
        return health.exit_code(rows)
    found = archive.discover(asked.root)
    if not found:
        parser.error(f"no releases in {asked.root}")
    tag_query(spark, asked.command, found[-1].methodology_version)
    if asked.command in ("index", "components"):
        return _index(spark, asked, found)
    if asked.command in ("meta-index", "candidates"):
        return _walk(spark, asked, found)
    read = [(r.tag, archive.read_tolerant(spark, r.csv_path)) for r in found]
    if asked.command == "release":
        text = reports.release_report(
            read[-1][1], read[-2][1] if len(read) > 1 else None, read[-1][0], archive.published_facts(found[-1:])[2]
        )
    else:
        text = reports.stability_report(read, *archive.published_facts(found))
    return _put(text, asked.output)


if __name__ == "__main__":
    raise SystemExit(main())
