"""Loading ingested sources into raw tables, with the fallback to older data and the update log."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import redact
from ..operators import health
from . import archive

_RISK = "threat_type string, first_seen date, last_seen date, threat_count long, observed_hosts_count long"
#: Columns of a source's normalised rows after the domain.
NORMALISED = {
    "tranco": "tranco_rank long", "majestic": "ref_subnets long, subdomains_seen long",
    "cloudflare": "rank_bucket long, buckets_seen long",
    "opr": "openpagerank_decimal double, openpagerank_integer long, openpagerank_rank long", "urlhaus": _RISK, "threatfox": _RISK,
    "phishtank": _RISK,
}


def normalised_rows(spark: SparkSession, record: archive.IngestRecord) -> DataFrame:
    """The rows of a fresh ingest; raises where it isn't fresh."""
    if record.status != "fresh":
        raise RuntimeError(f"the ingest of {record.source} is {record.status}, not fresh")
    schema = T.StructType.fromDDL(f"registered_domain string, {NORMALISED[record.source]}")
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(record.normalized_path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def last_success(spark: SparkSession, log: str, source: str) -> tuple[datetime.datetime, int | None] | None:
    """When a source was last loaded, and its rows then."""
    if not _exists(spark, log):
        return None
    done = spark.read.schema(health.LOG_SCHEMA).parquet(log).where((F.col("source") == source) & (F.col("status") == "success"))
    row = done.agg(F.max_by(F.struct("update_completed_at", "row_count"), "update_completed_at").alias("r")).first()
    return (row.r.update_completed_at, row.r.row_count) if row.r else None


def load_source(
    spark: SparkSession, source: str, rows: Callable[[], DataFrame], table: str, log: str, snapshot_date: datetime.date,
    now: Callable[[], datetime.datetime] = datetime.datetime.now, metadata: str | None = None, secrets: Sequence[str] = (),
) -> health.Fallback:
    """Replaces a source's raw table and logs it; where that fails, its last good load counts as long as it is not too old.

    Whatever goes wrong is logged without the ``secrets``. A source that is missing gets an empty table, so that what reads
    it still works.
    """
    started, error, loaded = now(), None, None
    try:
        loaded = archive.swap_table(rows(), table, snapshot_date)
    except Exception as e:  # noqa: BLE001  every failure has the same answer
        error = redact(str(e), list(secrets))[:4000]
    there = _exists(spark, table)
    state = health.fall_back(source, loaded, None if loaded is not None else last_success(spark, log, source), there, now())
    if state.status == "missing" and not there:
        schema = f"registered_domain string, {NORMALISED[source]}, snapshot_date date, ingested_at timestamp"
        archive.empty_table(spark, T.StructType.fromDDL(schema)).write.parquet(table)
    status = "success" if state.status == "fresh" else state.status
    health.append_update(spark, log, [(source, started, now(), status, state.row_count, state.age_days, metadata, error)])
    return state
