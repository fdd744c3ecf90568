"""Staged sources: raw feeds brought to one row per key, and the risk rollup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _dates(raw: DataFrame) -> list:
    """Latest load of a key, where the feed carries load dates."""
    return [F.max(c).alias(c) for c in ("snapshot_date", "ingested_at") if c in raw.columns]


def stage_tranco(raw: DataFrame) -> DataFrame:
    return raw.where(
        "registered_domain is not null and tranco_rank is not null"
    ).groupBy("registered_domain").agg(F.min("tranco_rank").alias("tranco_rank"), *_dates(raw))


def stage_majestic(raw: DataFrame) -> DataFrame:
    return (
        raw.where("registered_domain is not null and ref_subnets is not null").groupBy("registered_domain")
        .agg(
            F.max("ref_subnets").alias("majestic_ref_subnets"), F.sum("subdomains_seen").alias("majestic_subdomains_seen"),
            *_dates(raw)
        )
    )


def stage_radar(raw: DataFrame) -> DataFrame:
    return (
        raw.where("registered_domain is not null and rank_bucket is not null").groupBy("registered_domain")
        .agg(F.min("rank_bucket").alias("radar_rank_bucket"), F.max("buckets_seen").alias("radar_buckets_seen"), *_dates(raw))
    )


def stage_crux(raw: DataFrame, yyyymm: int, domain: str = "registered_domain") -> DataFrame:
    """Origins of one month to domains; the month filter prunes partitions where the table is partitioned by it."""
    rank = F.col("experimental.popularity.rank")
    rows = raw.where((F.col("yyyymm") == yyyymm) & rank.isNotNull()).select(
        F.col(domain).alias("registered_domain"), "origin", "yyyymm", rank.alias("rank")
    )
    return rows.where("registered_domain is not null").groupBy("registered_domain").agg(
        F.min("rank").alias("crux_rank_bucket"), F.count_distinct("origin").alias("crux_origins_seen"),
        F.to_date(F.max("yyyymm").cast("string"), "yyyyMM").alias("crux_snapshot_date"),
    )


def stage_opr(raw: DataFrame) -> DataFrame:
    known = "openpagerank_decimal is not null or openpagerank_integer is not null or openpagerank_rank is not null"
    return raw.where(f"registered_domain is not null and ({known})").groupBy("registered_domain").agg(
        F.max("openpagerank_decimal").alias("openpagerank_decimal"), F.max("openpagerank_integer").alias("openpagerank_integer"),
        F.min("openpagerank_rank").alias("openpagerank_rank"), F.count(F.lit(1)).alias("opr_subdomains_seen"), *_dates(raw),
    )


def stage_risk(raw: DataFrame) -> DataFrame:
    """One row per domain and threat type."""
    return raw.dropna(
        subset=["registered_domain", "threat_type", "first_seen", "last_seen"]
    ).groupBy("registered_domain", "threat_type").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.sum("threat_count").alias("threat_count"), F.max("observed_hosts_count").alias("observed_hosts_count"), *_dates(raw),
    )


def risk_rollup(feeds: dict[str, DataFrame]) -> DataFrame:
    """One row per domain over all staged risk feeds."""
    rows = reduce(DataFrame.unionByName, [df.withColumn("source_name", F.lit(s)) for s, df in feeds.items()])
    return rows.where("registered_domain is not null").groupBy("registered_domain").agg(
        F.count_distinct("source_name").alias("risk_sources_count"),
        F.array_sort(F.collect_set("threat_type")).alias("threat_types"),
        F.min("first_seen").alias("first_threat_seen"), F.max("last_seen").alias("last_threat_seen"),
        F.sum("threat_count").alias("threat_count"), F.sum("observed_hosts_count").alias("observed_hosts_count"),
    )
