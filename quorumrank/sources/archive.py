"""Release archives: discovery, typed and tolerant scans, deterministic files, lineage and ingest records."""

from __future__ import annotations

import bz2
import contextlib
import csv
import datetime
import gzip
import hashlib
import io
import itertools
import json
import lzma
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import select_history, week_grid, week_of_tag, week_tag
from ..operators.mart import PUBLIC_COLUMNS
from ..operators.releases import parse_bool

SNAPSHOT_TOLERANCE_DAYS = 1
PUBLIC_SCHEMA = T.StructType([
    T.StructField("registered_domain", T.StringType()), T.StructField("consensus_score", T.DoubleType()),
    T.StructField("coverage_tier", T.StringType()),
    T.StructField("sources_count", T.IntegerType()), T.StructField("ranking_sources_present", T.StringType()),
    T.StructField("tld_category", T.StringType()),
    T.StructField("is_spam_prone_tld", T.BooleanType()), T.StructField("security_flags_observed", T.BooleanType()),
    T.StructField("risk_sources_count", T.IntegerType()),
    T.StructField("threat_types", T.StringType()), T.StructField("snapshot_date", T.DateType()),
    T.StructField("methodology_version", T.StringType()),
])
#: Archives of any name that ends in their date are read; this one is written.
FILE_PREFIX = "domains"
_CSV, _META = re.compile(r"[a-z]+(?:_[a-z]+)*_(\d{4}-\d\d-\d\d)\.csv\.gz"), re.compile(r"meta_(\d{4}-\d\d-\d\d)\.json")


@dataclass(frozen=True)
class Release:
    tag: str
    snapshot_date: datetime.date
    methodology_version: str
    csv_path: str
    meta_path: str


def sha256_file(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def _only(folder: Path, pattern: re.Pattern, what: str) -> tuple[Path, datetime.date]:
    found = [(p, m) for p in sorted(folder.iterdir()) if (m := pattern.fullmatch(p.name))]
    if len(found) != 1:
        raise ValueError(f"{folder}: expected one {what}, found {len(found)}")
    return found[0][0], datetime.date.fromisoformat(found[0][1][1])


def discover(root: str) -> list[Release]:
    """The releases under ``root``, one folder per weekly tag, oldest first; names, tags, dates and versions must agree."""
    out = []
    for folder in sorted(p for p in Path(root).iterdir() if p.is_dir() and re.fullmatch(r"data-\d{4}-W\d\d", p.name)):
        data, day = _only(folder, _CSV, "archive")
        meta_path, meta_day = _only(folder, _META, "metadata file")
        meta = json.loads(meta_path.read_text())
        if day != meta_day or meta.get("snapshot_date") != day.isoformat():
            raise ValueError(f"{folder}: dates differ")
        if (meta.get("release") or {}).get("tag", folder.name) != folder.name:
            raise ValueError(f"{folder}: tag differs")
        if not meta.get("methodology_version"):
            raise ValueError(f"{folder}: no methodology version")
        out.append(Release(folder.name, day, meta["methodology_version"], str(data), str(meta_path)))
    return out


def within_window(releases: Sequence[Release], window: int = 8) -> list[Release]:
    """Those of the ``window`` weeks up to the newest release's, oldest first; weeks may be missing."""
    ordered = sorted(releases, key=lambda r: week_of_tag(r.tag))
    kept = set(select_history([r.tag for r in ordered], ordered[-1].tag, window)) if ordered else set()
    return [r for r in ordered if r.tag in kept]


def validate_history(
    releases: Sequence[Release], window: int = 8, needed: int = 6, recent: int = 4, recent_needed: int = 3
) -> list[str]:
    """The tags of the window's slots; raises unless the releases fill them well enough.

    ``needed`` of all weeks and ``recent_needed`` of the last ``recent`` must exist, every snapshot's date must lie in the
    week of its tag, consecutive ones must be as far apart as their weeks (a day's drift allowed), and all must be of one
    methodology.
    """
    if not releases:
        raise ValueError("no releases")
    slots = week_grid(releases[-1].tag, window)
    tags = [r.tag for r in releases]
    if sorted(set(tags)) != tags or not set(tags) <= set(slots):
        raise ValueError("releases repeat or lie outside the window")
    if len(tags) < needed:
        raise ValueError(f"{len(tags)} of {window} releases; {needed} are needed")
    if (found := len(set(tags) & set(slots[-recent:]))) < recent_needed:
        raise ValueError(f"{found} of the last {recent} releases; {recent_needed} are needed")
    if len({r.methodology_version for r in releases}) != 1:
        raise ValueError("methodology versions differ")
    for r in releases:
        if week_tag(r.snapshot_date) != r.tag:
            raise ValueError(f"{r.tag}: snapshot {r.snapshot_date} is of {week_tag(r.snapshot_date)}")
    for before, after in itertools.pairwise(releases):
        drift = (after.snapshot_date - before.snapshot_date) - (week_of_tag(after.tag) - week_of_tag(before.tag))
        if abs(drift.days) > SNAPSHOT_TOLERANCE_DAYS:
            raise ValueError(f"{before.tag} to {after.tag}: {drift.days} days off their weeks")
    return slots


def check_rows(spark: SparkSession, releases: Sequence[Release]) -> None:
    """Raises unless the rows of every archive have a domain of their own, scores of 0 to 100 and its date and version."""
    parts = [
        read_release(spark, r.csv_path, ["registered_domain", "consensus_score", "snapshot_date", "methodology_version"])
        .withColumns(
            {"tag": F.lit(r.tag), "day": F.lit(r.snapshot_date), "version": F.lit(r.methodology_version)}
        ) for r in releases
    ]
    rows, score = reduce(DataFrame.unionByName, parts), F.col("consensus_score")
    keyed = rows.groupBy("tag", "registered_domain").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(score.isNotNull() & ~score.between(0, 100)).alias("scores"),
        F.count_if(~F.col("snapshot_date").eqNullSafe(F.col("day"))).alias("days"),
        F.count_if(~F.col("methodology_version").eqNullSafe(F.col("version"))).alias("versions"),
    )
    counts = keyed.groupBy("tag").agg(
        F.sum(F.when(F.col("registered_domain").isNull(), F.col("n")).otherwise(0)).alias("rows without a domain"),
        F.count_if(F.col("registered_domain").isNotNull() & (F.col("n") > 1)).alias("repeated domains"),
        F.sum("scores").alias("scores out of range"), F.sum("days").alias("rows of another date"),
        F.sum("versions").alias("rows of another version"),
    )
    wrong = [f"{r.tag}: {v} {k}" for r in counts.orderBy("tag").collect() for k, v in r.asDict().items() if k != "tag" and v]  # a row for each release
    if wrong:
        raise ValueError("; ".join(wrong))


def read_release(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed scan of an archive; only ``columns`` are parsed. Scores pass through 32-bit floats, as published ones do."""
    df = spark.read.schema(PUBLIC_SCHEMA).option("header", True).option("enforceSchema", False).csv(path)
    df = df.withColumn("consensus_score", F.col("consensus_score").cast("float").cast("double"))
    return df.select(*columns) if columns else df


def read_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """An archive of any schema version: absent columns get defaults, unreadable numbers are null."""
    raw = spark.read.option("header", True).csv(path)
    def col(name: str) -> F.Column:
        field = PUBLIC_SCHEMA[name].dataType
        if name not in raw.columns:
            default = {T.BooleanType: False, T.IntegerType: 0, T.StringType: ""}.get(type(field))
            return F.lit(default).cast(field)
        value = F.col(f"`{name}`")
        if isinstance(field, T.BooleanType):
            return parse_bool(value)
        if isinstance(field, T.IntegerType):
            return F.coalesce(value.try_cast("double").cast("int"), F.lit(0))
        return value.try_cast(field) if not isinstance(field, T.StringType) else F.coalesce(value, F.lit(""))

    return raw.select(*[col(c).alias(c) for c in PUBLIC_COLUMNS])


def history_rows(spark: SparkSession, releases: Sequence[Release], slots: Sequence[str]) -> DataFrame:
    """(registered_domain, slot, score, sources, mask, risks) of all releases, for the temporal index."""
    from ..operators.temporal import source_mask

    columns = ["registered_domain", "consensus_score", "sources_count", "ranking_sources_present", "risk_sources_count"]
    parts = [read_release(spark, r.csv_path, columns).withColumn("slot", F.lit(list(slots).index(r.tag))) for r in releases]
    return reduce(DataFrame.unionByName, parts).select(
        "registered_domain", "slot", F.col("consensus_score").alias("score"), F.col("sources_count").alias("sources"),
        source_mask("ranking_sources_present").alias("mask"), F.coalesce("risk_sources_count", F.lit(0)).alias("risks"),
    )


def csv_cell(value: object) -> str:
    """Text of a value: nothing for null, lower-case booleans, ISO dates, ``|`` lists."""
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value:.6f}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "|".join(map(csv_cell, value))
    return str(value)


def _packed(path: str, out: io.BufferedWriter):
    """A writer that compresses by the ending of a name: .gz, .bz2, .xz or none."""
    if path.endswith(".gz"):
        return gzip.GzipFile(filename="", mode="wb", fileobj=out, mtime=0)
    if path.endswith(".bz2"):
        return bz2.BZ2File(out, "wb")
    return lzma.LZMAFile(out, "wb") if path.endswith(".xz") else contextlib.nullcontext(out)


def write_deterministic_csv(df: DataFrame, path: str) -> int:
    """A CSV, compressed as its name says, whose bytes depend on the rows and their order alone. Returns the count.

    Rows stream through the driver: a published file is one file.
    """
    n = 0
    with open(path, "wb") as out, _packed(path, out) as packed, io.TextIOWrapper(packed, "utf-8", newline="") as text:
        writer = csv.writer(text, lineterminator="\n")
        writer.writerow(df.columns)
        for row in df.toLocalIterator():
            writer.writerow([csv_cell(v) for v in row])
            n += 1
    return n


def export_archive(
    archive: DataFrame, folder: str, tag: str, sources: dict[str, dict], created_at: datetime.datetime, prefix: str = FILE_PREFIX
) -> Release:
    """Writes a release: the ordered archive and its lineage. Refuses no rows and several dates or versions."""
    facts = archive.agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("snapshot_date").alias("days"),
        F.collect_set("methodology_version").alias("versions")
    ).first()
    if not facts.n or len(facts.days) != 1 or len(facts.versions) != 1:
        raise ValueError(f"not a release: {facts.n} rows, {len(facts.days)} dates, {len(facts.versions)} versions")
    day, version = facts.days[0], facts.versions[0]
    target = Path(folder) / tag
    target.mkdir(parents=True, exist_ok=True)
    data, meta = target / f"{prefix}_{day}.csv.gz", target / f"meta_{day}.json"
    rows = write_deterministic_csv(archive, str(data))
    write_lineage(str(meta), {
        "created_at": created_at.isoformat(), "snapshot_date": day.isoformat(), "methodology_version": version,
        "release": {"tag": tag}, "row_count": rows,
        "public_columns": archive.columns,
        "sort_order": ["consensus_score desc nulls last", "sources_count desc", "registered_domain asc"],
        "inclusion": "consensus_score is not null or sources_count >= 2", "sources": sources, "sha256": sha256_file(str(data)),
    })
    return Release(tag, day, version, str(data), str(meta))


def index_lineage(
    path: str, csv_path: str, releases: Sequence[Release], slots: Sequence[str], index: DataFrame, rows: int, bands: DataFrame,
    created_at: datetime.datetime
) -> None:
    """What a temporal index was made of and what it holds: its inputs with their digests, weeks that are missing, and statistics."""
    from ..operators import temporal as T

    def counts(column: str) -> dict[str, int]:
        return {r[column]: r["count"] for r in index.groupBy(column).count().orderBy(column).collect()}  # a few labels

    newest = releases[-1]
    write_lineage(path, {
        "created_at": created_at.isoformat(), "status": "experimental", "snapshot_date": newest.snapshot_date,
        "index_methodology_version": T.METHODOLOGY,
        "consensus_methodology_version": newest.methodology_version, "row_count": rows, "public_columns": index.columns,
        "release": {"tag": newest.tag, "prerelease": True},
        "sort_order": ["score_candidate desc nulls last", "reputation_score desc nulls last", "registered_domain asc"],
        "methodology": {
            "history_window_weeks": T.HISTORY_WINDOW, "level_window_weeks": T.LEVEL_WINDOW,
            "minimum_history_share": T.MIN_HISTORY_SHARE, "trend_slope_clip": T.SLOPE_CLIP,
            "trend_confirmation_standard_errors": T.KAPPA, "structural_shock_damping": T.SHOCK_DAMPING,
            "rank_band_labels": T.BAND_LABELS, "rank_band_trend_caps": T.BAND_CAPS,
            "snapshot_date_tolerance_days": SNAPSHOT_TOLERANCE_DAYS, "missing_releases_preserve_calendar_slots": True,
        },
        "inputs": [
            {"release_tag": r.tag, "snapshot_date": r.snapshot_date, "methodology_version": r.methodology_version, "csv_asset": Path(r.csv_path).name, "csv_sha256": sha256_file(r.csv_path),
             "metadata_asset": Path(r.meta_path).name, "metadata_sha256": sha256_file(r.meta_path)} for r in releases
        ],
        "history_calendar": {"release_tags": list(slots), "missing_release_tags": sorted(set(slots) - {r.tag for r in releases})},
        "statistics": T.index_statistics(index).first().asDict() | {
            "trend_counts": counts("reputation_trend"), "risk_counts": counts("observed_risk")
        }
        | {"rank_band_noise_scales": {r["rank_band"]: r["noise_scale"] for r in bands.collect()}},
        "files": {"csv": Path(csv_path).name, "csv_sha256": sha256_file(csv_path), "metadata": Path(path).name},
    })


def read_meta(release: Release) -> dict:
    return json.loads(Path(release.meta_path).read_text())


def published_facts(releases: Sequence[Release]) -> tuple[int, list[str], list[tuple[str, str, str | None, int | None]]]:
    """(variants of the published columns, sources that weren't fresh, (tag, source, status, rows) of every source)."""
    metas = [(r.tag, read_meta(r)) for r in releases]
    rows = [
        (tag, name, s.get("status"), s.get("row_count"))
        for tag, m in metas for name, s in sorted((m.get("sources") or {}).items())
    ]
    stale = sorted({f"{name} in {tag}: {status}" for tag, name, status, _ in rows if status not in (None, "", "fresh")})
    return len({tuple(m.get("public_columns") or ()) for _, m in metas}), stale, rows


def json_safe(value: object) -> object:
    if isinstance(value, float) and value != value:
        return None
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, dict):
        return {str(k): json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [json_safe(v) for v in value]
    return value


def write_lineage(path: str, facts: dict) -> None:
    Path(path).write_text(json.dumps(json_safe(facts), indent=2, sort_keys=True) + "\n")


@dataclass
class IngestRecord:
    """What an ingest of a source found; kept as ``_meta.json`` beside its normalised rows."""

    source: str
    status: str
    snapshot_date: str
    file_hash: str | None = None
    row_count: int = 0
    valid_row_count: int = 0
    duplicate_registered_domains: int = 0
    skipped_rows: int = 0
    normalized_path: str | None = None
    error: str | None = None
    downloaded_at: str | None = None

    @staticmethod
    def of(facts: dict) -> IngestRecord:
        """From a record of any version: unknown keys are left out."""
        known = {f.name for f in fields(IngestRecord)}
        return IngestRecord(**{k: v for k, v in facts.items() if k in known})


def write_ingest(folder: str, record: IngestRecord) -> None:
    target = Path(folder) / record.source / record.snapshot_date
    target.mkdir(parents=True, exist_ok=True)
    write_lineage(str(target / "_meta.json"), asdict(record))


def read_ingest(folder: str, source: str, snapshot_date: str) -> IngestRecord:
    return IngestRecord.of(json.loads((Path(folder) / source / snapshot_date / "_meta.json").read_text()))


def cached_ingest(folder: str, source: str, today: datetime.date, max_age_days: int = 14) -> IngestRecord:
    """The last downloaded usable local ingest as ``stale``, else ``missing``; for development only.

    Records that can't be read are passed over. Those without a time of download count from their snapshot's date.
    """
    usable: list[tuple[datetime.datetime, IngestRecord]] = []
    for meta in (Path(folder) / source).glob("*/_meta.json"):
        try:
            record = IngestRecord.of(json.loads(meta.read_text()))
            loaded = datetime.datetime.fromisoformat(record.downloaded_at or record.snapshot_date).replace(tzinfo=None)
        except (ValueError, TypeError, AttributeError):
            continue
        fits = record.status in ("fresh", "stale") and 0 <= (today - loaded.date()).days <= max_age_days
        if fits and record.normalized_path and Path(record.normalized_path).exists():
            usable.append((loaded, record))
    if not usable:
        return IngestRecord(source, "missing", today.isoformat())
    newest = max(usable, key=lambda x: x[0])[1]
    newest.status = "stale"
    return newest


def swap_table(df: DataFrame, path: str, snapshot_date: datetime.date) -> int:
    """Replaces a raw table: written beside it first, then moved into its place.

    The old table is moved aside and deleted last, and moved back if the new one can't take its place; after a crash
    between the two moves it lies under ``__before``, from where the next call takes it back first.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    here, staging, before = make(path), make(f"{path}__staging"), make(f"{path}__before")
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(before) and not fs.exists(here):
        fs.rename(before, here)
    rows = df.withColumns({"snapshot_date": F.lit(snapshot_date), "ingested_at": F.current_timestamp()})
    rows.write.mode("overwrite").parquet(f"{path}__staging")
    n = spark.read.parquet(f"{path}__staging").count()
    fs.delete(before, True)
    if fs.exists(here) and not fs.rename(here, before):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(staging, here):
        fs.rename(before, here)
        raise OSError(f"could not move {path}__staging to {path}")
    fs.delete(before, True)
    return n


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def markdown_table(headers: Sequence[str], rows: Sequence[Sequence[object]]) -> str:
    """A table of a small collected result."""
    lines = ["| " + " | ".join(headers) + " |", "|" + "|".join(" --- " for _ in headers) + "|"]
    return "\n".join([*lines, *["| " + " | ".join(str(c).replace("|", "\\|") for c in r) + " |" for r in rows]])
