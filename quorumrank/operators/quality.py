"""Data-quality tests: each is a table of violations, which must be empty, or a one-row count of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mart import MIN_SOURCES, SIGNALS, SOURCES


def violations(df: DataFrame) -> DataFrame:
    """One row: how many rows a test found."""
    return df.agg(F.count(F.lit(1)).alias("violations"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, violations) of every listed column in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in columns])))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def not_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a value outside the list; null is accepted."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


#: Days after which a source is worth a warning and an error.
FRESHNESS = {"ranking": (8, 14), "crux": (60, 90), "risk": (8, 15)}


def freshness(df: DataFrame, loaded: str, now: Column, warn: int, error: int) -> DataFrame:
    """One row: the latest load, its age in days, and pass, warn or error; no rows are an error."""
    row = df.agg(F.max(loaded).alias("latest")).withColumn("age_days", F.datediff(now, "latest").cast("long"))
    return row.withColumn(
        "status",
        F.when(
            F.col("age_days").isNull() | (F.col("age_days") > error), "error"
        ).when(F.col("age_days") > warn, "warn").otherwise("pass")
    )


def tier_inconsistent(mart: DataFrame, min_sources: int = MIN_SOURCES) -> DataFrame:
    sparse, scored = F.col("coverage_tier") == "sparse", F.col("consensus_score").isNotNull()
    enough = F.col("sources_count") >= min_sources
    return mart.where(
        (sparse & scored) | (~sparse & ~scored) | (~enough & ~sparse) | (enough & sparse)
    ).select("registered_domain", "consensus_score", "coverage_tier", "sources_count")


def silent_sources(mart: DataFrame) -> DataFrame:
    """Sources that no row has."""
    counts = mart.agg(*[F.count(f"p_{s}").alias(s) for s in SOURCES])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(s).alias("source_name"), F.col(s).alias("populated_rows")) for s in SOURCES]))
    ).where("populated_rows = 0")


def wrong_direction(mart: DataFrame) -> DataFrame:
    """Sources whose best raw value doesn't score above their worst; a source of ties counts as wrong."""
    def ends(s: str) -> list[Column]:
        p, raw = F.col(f"p_{s}"), F.when(F.col(f"p_{s}").isNotNull(), F.col(SIGNALS[s].column))
        low, high = F.min_by(p, raw), F.max_by(p, raw)
        best, worst = (low, high) if SIGNALS[s].direction == "asc" else (high, low)
        return [best.alias(f"{s}_best"), worst.alias(f"{s}_worst")]

    row = mart.agg(*reduce(lambda a, b: a + b, map(ends, SOURCES)))
    rows = row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("source_name"), F.col(f"{s}_best").alias("best_score"),
                        F.col(f"{s}_worst").alias("worst_score")
                    )
                    for s in SOURCES
                ]
            )
        )
    )
    return rows.where("best_score <= worst_score")


def score_out_of_range(mart: DataFrame) -> DataFrame:
    return mart.where(~F.col("consensus_score").between(0, 100)).select("registered_domain", "consensus_score")


def flag_without_sources(mart: DataFrame) -> DataFrame:
    return mart.where(
        F.col("security_flags_observed") & (F.col("risk_sources_count") < 2)
    ).select("registered_domain", "security_flags_observed", "risk_sources_count")


def several_snapshots(mart: DataFrame) -> DataFrame:
    return mart.agg(F.count_distinct("snapshot_date").alias("snapshot_dates_count")).where("snapshot_dates_count <> 1")


def unscored_signals(mart: DataFrame) -> DataFrame:
    """Rows that have a source's value but not its percentile."""
    flags = F.array_compact(
        F.array(*[F.when(F.col(SIGNALS[s].column).isNotNull() & F.col(f"p_{s}").isNull(), F.lit(s)) for s in SOURCES])
    )
    return mart.select("registered_domain", F.explode(flags).alias("source_name"))


def miscounted_sources(mart: DataFrame) -> DataFrame:
    count = reduce(lambda a, b: a + b, [F.col(f"p_{s}").isNotNull().cast("int") for s in SOURCES])
    return mart.where(F.col("sources_count") != count).select("registered_domain", "sources_count", count.alias("percentiles"))


def invalid_release(release: DataFrame, snapshot_date: Column, version: str) -> DataFrame:
    """One row of counts: null or repeated domains, scores out of range, other dates, other versions."""
    key = F.col("registered_domain")
    return release.agg(
        F.count_if(key.isNull()).alias("null_domains"), (F.count(key) - F.count_distinct(key)).alias("repeated_domains"),
        F.count_if(~F.col("consensus_score").between(0, 100)).alias("scores_out_of_range"),
        F.count_if(~F.col("snapshot_date").eqNullSafe(snapshot_date)).alias("other_dates"),
        F.count_if(~F.col("methodology_version").eqNullSafe(F.lit(version))).alias("other_versions"),
    )


def invalid_index(index: DataFrame) -> DataFrame:
    """One row of counts over a temporal index: what a publishable one has none of, and its rows."""
    key = F.col("registered_domain")
    return index.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(key.isNull()).alias("null_domains"),
        (F.count(key) - F.count_distinct(key)).alias("repeated_domains"),
        F.count_if(
            ~F.col("reputation_score").between(0, 100) | ~F.col("score_candidate").between(0, 100)
        ).alias("scores_out_of_range"),
        F.count_if(~F.col("reputation_confidence").between(0, 1)).alias("confidence_out_of_range"),
        F.count_if(~F.col("reputation_trend").isin("rising", "falling", "stable", "uncertain")).alias("unknown_trends"),
        F.count_if(~F.col("structural_shock").isin("true", "false")).alias("unknown_shocks"),
    )
