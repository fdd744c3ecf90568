"""Diagnostics over the mart: coverage, overlap, correlation, agreement, influence, and how risk meets ranking."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .mart import RISK_SOURCES, SOURCES, in_public_archive, present_sources

PAIRS = tuple(combinations(SOURCES, 2))


def ratio(a: Column, b: Column, digits: int = 6) -> Column:
    return F.round(F.try_divide(a.cast("double"), b), digits)


def _share(digits: int = 4) -> Column:
    """Percentage of a group's ``domains`` in all groups: the groups are few, so the total is a window over them."""
    return F.round(100 * F.try_divide(F.col("domains").cast("double"), F.sum("domains").over(Window.partitionBy())), digits)


def coverage_distribution(mart: DataFrame) -> DataFrame:
    groups = mart.groupBy("snapshot_date", "coverage_tier", "sources_count", "ranking_sources_present").agg(
        F.count(F.lit(1)).alias("domains"), F.count_if(F.col("consensus_score").isNotNull()).alias("scored_domains")
    )
    return groups.withColumn("domains_pct", _share()).orderBy(F.desc("sources_count"), F.desc("domains"))


def sparse_breakdown(mart: DataFrame) -> DataFrame:
    rows = mart.where(F.col("coverage_tier") == "sparse").withColumn("missing_sources", present_sources(missing=True))
    groups = rows.groupBy("sources_count", "ranking_sources_present", "missing_sources").agg(F.count(F.lit(1)).alias("domains"))
    return groups.withColumn("sparse_domains_pct", _share()).orderBy(F.desc("sources_count"), F.desc("domains"))


def archive_policy() -> Column:
    return (
        F.when(F.col("consensus_score").isNotNull(), "published_scored")
        .when(F.col("sources_count") >= 2, "published_sparse_multi_source").otherwise("excluded_single_source")
    )


def inclusion_impact(mart: DataFrame) -> DataFrame:
    groups = mart.groupBy(archive_policy().alias("archive_policy_bucket"), "ranking_sources_present").agg(
        F.count(F.lit(1)).alias("domains"), F.count_if(F.col("consensus_score").isNotNull()).alias("scored_domains")
    )
    return groups.withColumn("domains_pct", _share()).orderBy("archive_policy_bucket", F.desc("domains"))


def _pairs(mart: DataFrame, *extra: str) -> DataFrame:
    """One scan of the mart to a row per pair of sources."""
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("source_a"), F.lit(b).alias("source_b"), F.col(f"p_{a}").alias("pa"), F.col(f"p_{b}").alias("pb")
            )
            for a, b in PAIRS
        ]
    )
    return mart.select(*extra, F.inline(rows))


def pairwise_overlap(mart: DataFrame) -> DataFrame:
    a, b = F.col("pa").isNotNull(), F.col("pb").isNotNull()
    counts = _pairs(mart).groupBy("source_a", "source_b").agg(
        F.count_if(a).alias("source_a_domains"), F.count_if(b).alias("source_b_domains"),
        F.count_if(a & b).alias("overlap_domains"), F.count_if(a | b).alias("union_domains"),
    )
    both = F.col("overlap_domains")
    return counts.withColumns({
        "jaccard_similarity": ratio(both, F.col("union_domains")),
        "pct_source_a_covered_by_b": ratio(both, F.col("source_a_domains")),
        "pct_source_b_covered_by_a": ratio(both, F.col("source_b_domains")),
    }).orderBy(F.desc("overlap_domains"))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation, null where either side doesn't vary."""
    return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), F.corr(x, y))


def _value_ranks(rows: DataFrame) -> DataFrame:
    """(source_a, source_b, side, value, rank): minimum ranks within a pair and side by counting rows of smaller value.

    Percentiles lie in 0..1, so a thousand equal steps of that spread the values of each pair over many tasks.
    """
    key = ["source_a", "source_b", "side"]
    sides = F.array(*[F.struct(F.lit(c).alias("side"), F.col(c).alias("value")) for c in ("pa", "pb")])
    counts = rows.select("source_a", "source_b", "n", F.inline(sides)).groupBy(*key, "value").agg(F.sum("n").alias("c"))
    counts = counts.withColumn("r", F.floor(F.col("value") * 1000))
    before = Window.partitionBy(*key, "r").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy(*key).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    steps = counts.groupBy(*key, "r").agg(F.sum("c").alias("t")).select(
        *key, "r", F.coalesce(F.sum("t").over(along), F.lit(0)).alias("o")
    )
    placed = counts.withColumn("b", F.coalesce(F.sum("c").over(before), F.lit(0))).join(F.broadcast(steps), [*key, "r"])  # 20,000 steps at most
    return placed.select(*key, "value", (F.col("b") + F.col("o") + 1).cast("double").alias("rank"))


def weighted_corr(x: Column, y: Column, n: Column) -> Column:
    """Pearson correlation of values that occur n times, null where either side doesn't vary."""
    total, sx, sy = F.sum(n), F.sum(n * x), F.sum(n * y)
    cov = F.sum(n * x * y) - sx * sy / total
    var = (F.sum(n * x * x) - sx * sx / total) * (F.sum(n * y * y) - sy * sy / total)
    return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), cov / F.sqrt(var))


def pairwise_correlation(mart: DataFrame) -> DataFrame:
    """Pearson and Spearman (on minimum ranks) of two percentiles over the domains that both sources know.

    Domains with the same two percentiles are one row with a count from the first aggregate on.
    """
    key = ["source_a", "source_b"]
    rows = _pairs(mart).where("pa is not null and pb is not null").groupBy(*key, "pa", "pb").agg(F.count(F.lit(1)).alias("n"))
    ranks = _value_ranks(rows)
    ranked = rows
    for c in ("pa", "pb"):
        ranked = ranked.join(
            ranks.where(F.col("side") == c).select(*key, F.col("value").alias(c), F.col("rank").alias(f"{c}_rank")), [*key, c]
        )
    n = F.col("n").cast("double")
    return ranked.groupBy(*key).agg(
        F.sum("n").alias("overlap_domains"),
        F.round(weighted_corr(F.col("pa"), F.col("pb"), n), 6).alias("pearson_on_percentiles"),
        F.round(weighted_corr(F.col("pa_rank"), F.col("pb_rank"), n), 6).alias("spearman_correlation"),
        F.round(F.sum(F.abs(F.col("pa") - F.col("pb")) * n) / F.sum(n), 6).alias("avg_abs_percentile_gap"),
    ).orderBy(F.desc("overlap_domains"))


def source_scores() -> Column:
    """Array of (source_name, score) of the sources that know the domain."""
    return F.array_compact(F.array(*[
        F.when(
            F.col(f"p_{s}").isNotNull(), F.struct(F.lit(s).alias("source_name"), F.col(f"p_{s}").alias("score"))
        ) for s in SOURCES
    ]))


def _score_range() -> Column:
    scores = F.col("scores.score")
    return F.array_max(scores) - F.array_min(scores)


def _score_stddev() -> Column:
    values = F.col("scores.score")
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / n
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n)


def agreement_bucket(spread: Column) -> Column:
    return (
        F.when(spread < 0.10, "very_high_agreement").when(spread < 0.25, "high_agreement")
        .when(spread < 0.50, "mixed_agreement").otherwise("low_agreement")
    )


def agreement_distribution(mart: DataFrame) -> DataFrame:
    rows = mart.where("sources_count >= 2").withColumn("scores", source_scores()).select(
        "sources_count", "consensus_score", _score_range().alias("spread"), _score_stddev().alias("deviation")
    )
    return rows.groupBy("sources_count", agreement_bucket(F.col("spread")).alias("agreement_bucket")).agg(
        F.count(F.lit(1)).alias("domains"), F.round(F.avg("consensus_score"), 4).alias("avg_consensus_score"),
        F.round(F.avg("spread"), 6).alias("avg_source_score_range"),
        F.round(F.avg("deviation"), 6).alias("avg_source_score_stddev"),
    ).orderBy(F.desc("sources_count"), "avg_source_score_range")


def disagreement_outliers(mart: DataFrame) -> DataFrame:
    """Domains by how far their sources lie apart, with the sources from strongest to weakest."""
    rows = mart.where("sources_count >= 2").withColumn("scores", source_scores())
    falling = F.array_sort(
        F.col("scores"),
        lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).when(
            a["source_name"] < b["source_name"], -1
        ).otherwise(1),
    )
    weakest = F.array_min(
        F.transform("scores", lambda s: F.struct(s["score"].alias("score"), s["source_name"].alias("source_name")))
    )
    rows = rows.select("*", falling.alias("falling"), weakest.alias("weak"), _score_range().alias("spread"))
    said = F.array_join(
        F.transform("falling", lambda s: F.concat(s["source_name"], F.lit(":"), F.format_string("%.4f", s["score"]))), ","
    )
    return rows.select(
        "registered_domain", "sources_count", F.col("falling")[0]["source_name"].alias("strongest_source"),
        F.col("weak.source_name").alias("weakest_source"),
        said.alias("source_score_summary"), F.round("consensus_score", 4).alias("consensus_score"),
        F.round("spread", 6).alias("source_score_range"),
        F.round(F.col("falling")[0]["score"], 6).alias("strongest_source_score"),
        F.round("weak.score", 6).alias("weakest_source_score"),
    ).orderBy(F.desc("source_score_range"), F.col("consensus_score").desc_nulls_last())


def jackknife_influence(mart: DataFrame) -> DataFrame:
    """How far the score moves when a source is left out; exact quantiles."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"p_{s}"), F.lit(0.0)) for s in SOURCES])
    rows = mart.where("consensus_score is not null and sources_count >= 3").select(
        "consensus_score", "sources_count", total.alias("total"), F.inline(source_scores())
    )
    rows = rows.withColumn("without", (F.col("total") - F.col("score")) / (F.col("sources_count") - 1) * 100)
    rows = rows.withColumn("moved", F.abs(F.col("consensus_score") - F.col("without")))
    return rows.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("scored_domains"),
        F.round(safe_corr(F.col("consensus_score"), F.col("without")), 6).alias("full_vs_without_source_correlation"),
        F.round(F.avg("moved"), 6).alias("avg_absolute_influence_points"),
        F.round(F.percentile("moved", 0.5), 6).alias("median_absolute_influence_points"),
        F.round(F.percentile("moved", 0.95), 6).alias("p95_absolute_influence_points"),
        F.round(F.max("moved"), 6).alias("max_absolute_influence_points"),
    ).orderBy(F.desc("avg_absolute_influence_points"))


def risk_source_overlap(feeds: dict[str, DataFrame]) -> DataFrame:
    """Domains by risk source, by number of sources and by pair of sources: one flag row per domain feeds all three."""
    rows = reduce(DataFrame.union, [df.select("registered_domain", F.lit(s).alias("source_name")) for s, df in feeds.items()])
    flags = rows.groupBy("registered_domain").agg(*[F.bool_or(F.col("source_name") == s).alias(s) for s in RISK_SOURCES])
    count = reduce(lambda a, b: a + b, [F.col(s).cast("int") for s in RISK_SOURCES])
    metrics = [
        *[
            F.when(F.col(s), F.struct(F.lit("source").alias("t"), F.lit(s).alias("n"), F.lit(1).alias("d"), F.lit(0).alias("u")))
            for s in RISK_SOURCES
        ],
        F.struct(
            F.lit("risk_sources_count").alias("t"), count.cast("string").alias("n"), F.lit(1).alias("d"), F.lit(0).alias("u")
        ),
        *[
            F.struct(
                F.lit("pair").alias("t"), F.lit(f"{a}_{b}").alias("n"), (F.col(a) & F.col(b)).cast("int").alias("d"),
                (F.col(a) | F.col(b)).cast("int").alias("u")
            )
            for a, b in combinations(RISK_SOURCES, 2)
        ],
    ]
    long = flags.select(F.inline(F.array_compact(F.array(*metrics)))).groupBy(
        F.col("t").alias("metric_type"), F.col("n").alias("metric_name")
    )
    sums = long.agg(F.sum("d").alias("domains"), F.sum("u").alias("u"))
    pair = F.col("metric_type") == "pair"
    return sums.select(
        "metric_type", "metric_name", "domains", F.when(pair, F.col("u")).alias("union_domains"),
        F.when(pair, ratio(F.col("domains"), F.col("u"))).alias("jaccard_similarity"),
    ).orderBy("metric_type", F.desc("domains"))


def risk_mart_coverage(risk: DataFrame, mart: DataFrame) -> DataFrame:
    known = mart.select("registered_domain", "consensus_score", in_public_archive().alias("public"), F.lit(True).alias("ranked"))
    rows = risk.join(known, "registered_domain", "left").withColumns(
        {"ranked": F.coalesce("ranked", F.lit(False)), "public": F.coalesce("public", F.lit(False))}
    )
    several = F.col("risk_sources_count") >= 2
    groups = rows.groupBy("risk_sources_count").agg(
        F.count(F.lit(1)).alias("risk_domains"), F.count_if("ranked").alias("domains_in_ranking_mart"),
        F.count_if("public").alias("domains_in_public_archive"),
        F.count_if(several & F.col("ranked")).alias("mart_domains_with_security_flag"),
        F.count_if(several & F.col("public")).alias("public_rows_with_security_flag"),
        F.round(F.avg("consensus_score"), 4).alias("avg_consensus_score"), F.sum("threat_count").alias("threat_observations"),
        F.sum("observed_hosts_count").alias("observed_hosts"),
    )
    return groups.withColumns({
        "pct_in_ranking_mart": ratio(F.col("domains_in_ranking_mart"), F.col("risk_domains")),
        "pct_in_public_archive": ratio(F.col("domains_in_public_archive"), F.col("risk_domains")),
    }).orderBy(F.desc("risk_sources_count"))


def shared_platform_candidates(
    risk: DataFrame, mart: DataFrame, platforms: list[str], many_hosts: int = 10, many_observations: int = 20
) -> DataFrame:
    """Domains of several risk sources that may be platforms shared by strangers. ``platforms`` is a short list."""
    ranked = mart.select(
        "registered_domain", F.col("sources_count").alias("ranking_sources_count"), "coverage_tier", "consensus_score"
    )
    flags = {
        "in_known_platform_seed": F.col("registered_domain").isin(platforms),
        "has_many_observed_hosts": F.col("observed_hosts_count") >= many_hosts,
        "has_many_observations": F.col("threat_count") >= many_observations,
    }
    reasons = {
        "in_known_platform_seed": "known_platform_seed", "has_many_observed_hosts": "many_observed_hosts",
        "has_many_observations": "many_observations"
    }
    rows = risk.where("risk_sources_count >= 2").withColumns(flags)
    rows = rows.where(reduce(lambda a, b: a | b, [F.col(c) for c in flags])).join(ranked, "registered_domain", "left")
    return rows.select(
        "registered_domain", "risk_sources_count", "threat_types", "first_threat_seen", "last_threat_seen", "threat_count",
        "observed_hosts_count",
        "ranking_sources_count", "coverage_tier", "consensus_score", *flags,
        F.concat_ws(",", *[F.when(F.col(c), F.lit(said)) for c, said in reasons.items()]).alias("candidate_reasons"),
    ).orderBy(F.desc("risk_sources_count"), F.desc("in_known_platform_seed"), F.desc("observed_hosts_count"),
    F.desc("threat_count"), "registered_domain")
