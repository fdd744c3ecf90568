"""The consensus mart: one row per domain that any ranking source knows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import quantile_edges, with_percentile

SOURCES = ("tranco", "majestic", "radar", "crux", "opr")
RISK_SOURCES = ("urlhaus", "threatfox", "phishtank")
MIN_SOURCES = 3
METHODOLOGY_VERSION = "v0.3.0-beta"


@dataclass(frozen=True)
class Signal:
    """How a source ranks: its column, the better direction, and whether the values are a short list of buckets."""

    column: str
    direction: str
    few: bool = False


SIGNALS = {
    "tranco": Signal("tranco_rank", "asc"), "majestic": Signal("majestic_ref_subnets", "desc"),
    "radar": Signal("radar_rank_bucket", "asc", few=True), "crux": Signal("crux_rank_bucket", "asc", few=True),
    "opr": Signal("openpagerank_decimal", "desc"),
}
#: Columns of the mart in order.
COLUMNS = (
    "registered_domain tranco_rank p_tranco majestic_ref_subnets majestic_subdomains_seen p_majestic radar_rank_bucket radar_buckets_seen "
    "p_radar crux_rank_bucket crux_origins_seen p_crux crux_snapshot_date openpagerank_decimal openpagerank_integer openpagerank_rank "
    "opr_subdomains_seen p_opr consensus_score coverage_tier sources_count ranking_sources_present tld_category is_spam_prone_tld "
    "security_flags_observed risk_sources_count threat_types last_threat_seen snapshot_date methodology_version"
).split()


def scored_source(df: DataFrame, source: str, edges: list[float]) -> DataFrame:
    """A staged source with its percentile; rows without the ranking value are gone before ranking."""
    signal = SIGNALS[source]
    return with_percentile(df, signal.column, f"p_{source}", signal.direction, signal.few and bool(edges), edges)


def sources_count(sources: tuple[str, ...] = SOURCES) -> Column:
    return reduce(lambda a, b: a + b, [F.when(F.col(f"p_{s}").isNotNull(), 1).otherwise(0) for s in sources])


def present_sources(sources: tuple[str, ...] = SOURCES, missing: bool = False) -> Column:
    """Comma list of the sources that know the domain, or of those that don't."""
    def known(s: str) -> Column:
        p = F.col(f"p_{s}")
        return p.isNull() if missing else p.isNotNull()

    return F.concat_ws(",", *[F.when(known(s), F.lit(s)) for s in sources])


def consensus_score(count: Column, min_sources: int = MIN_SOURCES, sources: tuple[str, ...] = SOURCES) -> Column:
    """Mean percentile times 100, null below ``min_sources``; summed in the order of ``sources``."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"p_{s}"), F.lit(0.0)) for s in sources])
    return F.when(count >= min_sources, total / count * 100)


def coverage_tier(count: Column) -> Column:
    return F.when(count >= 5, "full").when(count == 4, "high").when(count == 3, "partial").otherwise("sparse")


def consensus_mart(
    staged: dict[str, DataFrame], risk: DataFrame, snapshot_date: Column, distributed: bool | None = None,
    min_sources: int = MIN_SOURCES
) -> DataFrame:
    """Joins the scored sources over all their keys by one union and one aggregate, then adds the risk layer.

    Each source is unique by domain, so ``max`` picks its only value: the spine, its distinct and five joins cost one
    shuffle by domain, which the join with the risk rollup shares. ``distributed`` says whether percentiles are computed
    by value ranges or each in one task; by default the number of rows decides.
    """
    staged = {s: staged[s].drop("snapshot_date", "ingested_at") for s in SOURCES}
    columns = {s: (staged[s], SIGNALS[s].column) for s in SOURCES}
    edges = {} if distributed is False else quantile_edges(columns, one_task_rows=0 if distributed else None)
    scored = {s: scored_source(staged[s], s, edges.get(s, [])) for s in SOURCES}
    columns = {
        c: f.dataType for df in scored.values() for c, f in ((f.name, f) for f in df.schema.fields) if c != "registered_domain"
    }
    aligned = [
        df.select(
            "registered_domain", *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()]
        )
        for df in scored.values()
    ]
    spine = reduce(DataFrame.unionByName, aligned).groupBy("registered_domain").agg(*[F.max(c).alias(c) for c in columns])
    joined = spine.join(
        risk.select("registered_domain", "risk_sources_count", "threat_types", "last_threat_seen"), "registered_domain", "left"
    )
    n = F.col("sources_count")
    flags = F.coalesce("risk_sources_count", F.lit(0).cast("long"))
    out = joined.withColumn("sources_count", sources_count()).withColumns({
        "consensus_score": consensus_score(n, min_sources), "coverage_tier": coverage_tier(n),
        "ranking_sources_present": present_sources(),
        "tld_category": F.lit(None).cast("string"), "is_spam_prone_tld": F.lit(None).cast("boolean"),
        "security_flags_observed": flags >= 2,
        "risk_sources_count": flags, "threat_types": F.coalesce("threat_types", F.array().cast("array<string>")),
        "snapshot_date": snapshot_date, "methodology_version": F.lit(METHODOLOGY_VERSION),
    })
    return out.select(*COLUMNS)


def in_public_archive() -> Column:
    return F.col("consensus_score").isNotNull() | (F.col("sources_count") >= 2)


#: Columns of a published release in order.
PUBLIC_COLUMNS = (
    "registered_domain consensus_score coverage_tier sources_count ranking_sources_present tld_category is_spam_prone_tld "
    "security_flags_observed risk_sources_count threat_types snapshot_date methodology_version"
).split()


def public_archive(mart: DataFrame) -> DataFrame:
    """Rows and columns that a release publishes, in its total order."""
    rows = mart.where(in_public_archive()).withColumn("threat_types", F.array_join("threat_types", "|")).select(*PUBLIC_COLUMNS)
    return rows.orderBy(
        F.col("consensus_score").desc_nulls_last(), F.col("sources_count").desc(), F.col("registered_domain").asc()
    )
