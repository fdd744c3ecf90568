"""Source health: the update log, fallback to stale data, and the contract of the external rank table."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

LOG_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False), T.StructField("update_started_at", T.TimestampType(), False),
    T.StructField("update_completed_at", T.TimestampType()),
    T.StructField("status", T.StringType(), False), T.StructField("row_count", T.LongType()),
    T.StructField("age_days", T.LongType()),
    T.StructField("source_metadata", T.StringType()), T.StructField("error_message", T.StringType()),
])
#: Days for which the last good load of a source may stand in.
STALE_TTL_DAYS = {
    "tranco": 30, "majestic": 30, "cloudflare": 30, "opr": 120, "crux": 75, "urlhaus": 15, "threatfox": 15, "phishtank": 15
}
EXPECTED_BUCKETS = (1_000, 5_000, 10_000, 50_000, 100_000, 500_000, 1_000_000, 5_000_000, 10_000_000, 50_000_000)


def load_status(status: Column) -> Column:
    return F.when(status == "success", "fresh").otherwise(status)


def latest_updates(log: DataFrame, since: datetime.datetime | None = None) -> DataFrame:
    """The last completed update of each source (of equals the last started)."""
    rows = log if since is None else log.where(F.col("update_started_at") >= F.lit(since))
    newest = Window.partitionBy("source").orderBy(F.col("update_completed_at").desc_nulls_last(), F.desc("update_started_at"))
    return rows.withColumn("_k", F.row_number().over(newest)).where("_k = 1").drop("_k").withColumn(
        "status", load_status(F.col("status"))
    )


def source_health(log: DataFrame, sources: list[str], since: datetime.datetime | None = None) -> DataFrame:
    """A row per expected source, ``not_logged`` where the log has none."""
    expected = log.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"))
    latest = latest_updates(log.where(F.col("source").isin(sources)), since)
    rows = expected.join(latest, "source", "left").select(
        "source", F.coalesce("status", F.lit("not_logged")).alias("status"), "row_count", "age_days", "error_message"
    )
    sick = F.col("status").isin("missing", "not_logged") | F.coalesce(F.col("row_count") == 0, F.lit(False))
    return rows.withColumn("unhealthy", sick).orderBy("source")


def exit_code(health: DataFrame, limit: int = 2) -> int:
    """2 where ``limit`` sources or more are unhealthy, else 0."""
    return 2 if health.where("unhealthy").count() >= limit else 0


def source_status(log: DataFrame, snapshot_date: Column) -> DataFrame:
    """Latest status of each logged source with the age of its load at a snapshot, as the lineage records it."""
    rows = latest_updates(log)
    age = F.coalesce("age_days", F.datediff(snapshot_date, F.col("update_completed_at").cast("date")).cast("long"))
    return rows.select("source", "status", "row_count", age.alias("age_days"), "error_message")


@dataclass(frozen=True)
class Fallback:
    """What a source counts as after a load: fresh, stale or missing."""

    source: str
    status: str
    row_count: int
    age_days: int | None


def fall_back(
    source: str, loaded_rows: int | None, last_success: tuple[datetime.datetime, int | None] | None, table_exists: bool,
    now: datetime.datetime
) -> Fallback:
    """``loaded_rows`` is None where the load failed. A last success within its days stands in, else the source is missing."""
    if loaded_rows is not None:
        return Fallback(source, "fresh", loaded_rows, 0)
    if last_success is not None and table_exists:
        age = (now - last_success[0]).days
        if age <= STALE_TTL_DAYS[source]:
            return Fallback(source, "stale", int(last_success[1] or 0), age)
    return Fallback(source, "missing", 0, None)


def fallback_states(log: DataFrame, now: Column) -> DataFrame:
    """The same decision for all sources at once: their latest update, or the last success before it."""
    good = log.where(F.col("status") == "success").groupBy("source").agg(
        F.max_by(F.struct("update_completed_at", "row_count"), "update_completed_at").alias("g")
    )
    rows = latest_updates(log).select(
        "source", F.col("status").alias("latest"), F.col("row_count").alias("latest_rows")
    ).join(good, "source", "left")
    days = F.floor((F.unix_timestamp(now) - F.unix_timestamp("g.update_completed_at")) / 86400)
    limit = F.coalesce(*[F.when(F.col("source") == s, d) for s, d in STALE_TTL_DAYS.items()])
    status = F.when(F.col("latest") == "fresh", "fresh").when(days <= limit, "stale").otherwise("missing")
    return rows.select(
        "source", status.alias("status"),
        F.when(
            F.col("latest") == "fresh", F.col("latest_rows")
        ).when(days <= limit, F.col("g.row_count")).otherwise(0).alias("row_count"),
        F.when(F.col("latest") == "fresh", 0).when(days <= limit, days).alias("age_days"),
    )


def rank_profile(origins: DataFrame, yyyymm: int, domain: Column) -> DataFrame:
    """One row over a month of the external table: rows, domains and its rank buckets."""
    rank = F.col("experimental.popularity.rank")
    rows = origins.where(
        (F.col("yyyymm") == yyyymm) & rank.isNotNull()
    ).select(domain.alias("d"), rank.alias("r")).where("d is not null")
    return rows.agg(
        F.count(F.lit(1)).alias("origin_rows"), F.count_distinct("d").alias("registered_domains"),
        F.array_sort(F.collect_set("r")).alias("buckets")
    )


def has_field(schema: T.StructType, path: tuple[str, ...]) -> bool:
    """Whether a nested field exists."""
    for name in path:
        if not isinstance(schema, T.StructType) or name not in schema.names:
            return False
        schema = schema[name].dataType
    return True


def check_rank_contract(origins: DataFrame, yyyymm: int, domain: Column, fail_on_change: bool = False) -> tuple[dict, list[str]]:
    """(profile, warnings); raises where the field is gone, the month is empty or, if asked, the buckets changed."""
    if not has_field(origins.schema, ("experimental", "popularity", "rank")):
        raise RuntimeError("no field experimental.popularity.rank")
    row = rank_profile(origins, yyyymm, domain).first().asDict()
    if not row["origin_rows"] or not row["registered_domains"]:
        raise RuntimeError(f"no ranked rows for {yyyymm}")
    missing, other = sorted(set(EXPECTED_BUCKETS) - set(row["buckets"])), sorted(set(row["buckets"]) - set(EXPECTED_BUCKETS))
    warnings = ([f"missing buckets: {missing}"] if missing else []) + ([f"unexpected buckets: {other}"] if other else [])
    if warnings and fail_on_change:
        raise RuntimeError("; ".join(warnings))
    return row, warnings


def append_update(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Appends to the update log."""
    spark.createDataFrame(rows, LOG_SCHEMA).write.mode("append").parquet(path)
