"""Queries over the mart, the staged sources and the risk layer, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import diagnostics, mart as mart_ops, staging
from . import projections as P
from .catalog import ORACLES, query

PLATFORMS = ["d3.example.com", "d17.example.com", "d42.example.com", "d64.example.com", "d99.example.com", "d120.example.com"]


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as text, for comparisons."""
    return df.withColumn("threat_types", F.array_join("threat_types", "|")) if "threat_types" in df.columns else df


_ALL = "select * replace (array_to_string(threat_types, '|') as threat_types) from {}"


@query("consensus_mart", P.with_projections(_ALL.format("mart")))
def consensus_mart(spark: SparkSession, d: str) -> DataFrame:
    return _flat(P.mart(spark, d))


@query("consensus_mart_window", ORACLES["consensus_mart"])
def consensus_mart_window(spark: SparkSession, d: str) -> DataFrame:
    return _flat(P.mart(spark, d, distributed=False))


@query("consensus_mart_distributed", ORACLES["consensus_mart"])
def consensus_mart_distributed(spark: SparkSession, d: str) -> DataFrame:
    return _flat(P.mart(spark, d, distributed=True))


@query("stg_rank_dedup", P.with_projections("""
    select 'tranco' as source, registered_domain, tranco_rank as value, null::bigint as seen from stg_tranco union all
    select 'majestic', registered_domain, majestic_ref_subnets, majestic_subdomains_seen from stg_majestic union all
    select 'radar', registered_domain, radar_rank_bucket, radar_buckets_seen from stg_radar"""))
def stg_rank_dedup(spark: SparkSession, d: str) -> DataFrame:
    s = P.staged_sources(spark, d)
    def part(name: str, value: str, seen: str | None) -> DataFrame:
        return s[name].select(
            F.lit(name).alias("source"), "registered_domain", F.col(value).cast("long").alias("value"),
            (F.col(seen) if seen else F.lit(None)).cast("long").alias("seen")
        )

    return part("tranco", "tranco_rank", None).unionByName(
        part("majestic", "majestic_ref_subnets", "majestic_subdomains_seen")
    ).unionByName(part("radar", "radar_rank_bucket", "radar_buckets_seen"))


@query("stg_opr_dedup", P.with_projections("select * from stg_opr"))
def stg_opr_dedup(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_opr(P.raw_opr(spark, d))


@query("stg_crux_origins", P.with_projections("select * from stg_crux"))
def stg_crux_origins(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_crux(P.raw_crux(spark, d), P.CRUX_MONTH)


@query("stg_risk_dedup", P.with_projections("select * from stg_risk"))
def stg_risk_dedup(spark: SparkSession, d: str) -> DataFrame:
    feeds = [df.withColumn("source_name", F.lit(s)) for s, df in P.staged_risk(spark, d).items()]
    return feeds[0].unionByName(feeds[1]).unionByName(feeds[2])


@query("risk_rollup", P.with_projections(_ALL.format("risk")))
def risk_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _flat(P.risk(spark, d))


@query("public_archive", P.with_projections(f"""
    select {', '.join(c if c != 'threat_types' else "array_to_string(threat_types, '|') as threat_types" for c in mart_ops.PUBLIC_COLUMNS)}
    from mart where consensus_score is not null or sources_count >= 2 order by consensus_score desc nulls last,
    sources_count desc, registered_domain"""))
def public_archive(spark: SparkSession, d: str) -> DataFrame:
    return mart_ops.public_archive(P.mart(spark, d))


@query("coverage_distribution", P.with_projections("""
    select snapshot_date, coverage_tier, sources_count, ranking_sources_present, count(*) as domains,
    count(consensus_score) as scored_domains,
        round(100 * (count(*)::double / (select count(*) from mart)), 4) as domains_pct from mart group by 1, 2, 3, 4"""))
def coverage_distribution(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.coverage_distribution(P.mart(spark, d))


@query("sparse_breakdown", P.with_projections("""
    select sources_count, ranking_sources_present, concat_ws(',', case when p_tranco is null then 'tranco' end,
    case when p_majestic is null then 'majestic' end,
        case when p_radar is null then 'radar' end, case when p_crux is null then 'crux' end,
        case when p_opr is null then 'opr' end) as missing_sources,
        count(*) as domains, round(100 * (count(*)::double / sum(count(*)) over ()), 4) as sparse_domains_pct
    from mart where coverage_tier = 'sparse' group by 1, 2, 3"""))
def sparse_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.sparse_breakdown(P.mart(spark, d))


@query("inclusion_impact", P.with_projections("""
    select case when consensus_score is not null then 'published_scored' when sources_count >= 2 then 'published_sparse_multi_source' else 'excluded_single_source' end as archive_policy_bucket,
        ranking_sources_present, count(*) as domains, round(100 * (count(*)::double / sum(count(*)) over ()), 4) as domains_pct,
        count(consensus_score) as scored_domains
    from mart group by 1, 2"""))
def inclusion_impact(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.inclusion_impact(P.mart(spark, d))


_PAIRS = (
    "pairs",
    " union all ".join(
        f"select '{a}' as source_a, '{b}' as source_b, p_{a} as pa, p_{b} as pb from mart" for a, b in diagnostics.PAIRS
    )
)


@query("pairwise_overlap", P.with_projections("""
    select source_a, source_b, count(pa) as source_a_domains, count(pb) as source_b_domains, count(*) filter (pa is not null
    and pb is not null) as overlap_domains,
        count(*) filter (pa is not null or pb is not null) as union_domains,
        round(count(*) filter (pa is not null and pb is not null)::double / nullif(count(*) filter (pa is not null
        or pb is not null), 0), 6) as jaccard_similarity,
        round(count(*) filter (pa is not null and pb is not null)::double / nullif(count(pa), 0), 6) as pct_source_a_covered_by_b,
        round(count(*) filter (pa is not null and pb is not null)::double / nullif(count(pb), 0), 6) as pct_source_b_covered_by_a
        from pairs group by 1, 2""", _PAIRS))
def pairwise_overlap(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.pairwise_overlap(P.mart(spark, d))


@query("pairwise_correlation", P.with_projections("""
    select source_a, source_b, count(*) as overlap_domains, round(case when min(pa) < max(pa) and min(pb) < max(pb) then corr(pa,
    pb) end, 6) as pearson_on_percentiles,
        round(case when min(ra) < max(ra) and min(rb) < max(rb) then corr(ra, rb) end, 6) as spearman_correlation,
        round(avg(abs(pa - pb)), 6) as avg_abs_percentile_gap
    from (select *, rank() over (partition by source_a, source_b order by pa) as ra, rank() over (partition by source_a, source_b
    order by pb) as rb
        from pairs where pa is not null and pb is not null) group by 1, 2""", _PAIRS))
def pairwise_correlation(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.pairwise_correlation(P.mart(spark, d))


_SCORES = (
    "scores",
    " union all ".join(
        f"select registered_domain, sources_count, consensus_score, '{s}' as source_name, p_{s} as score from mart where p_{s} is not null and sources_count >= 2"
        for s in mart_ops.SOURCES
    )
)


@query("agreement_distribution", P.with_projections("""
    select sources_count, case when r < 0.10 then 'very_high_agreement' when r < 0.25 then 'high_agreement' when r < 0.50 then 'mixed_agreement' else 'low_agreement' end as agreement_bucket,
        count(*) as domains, round(avg(c), 4) as avg_consensus_score, round(avg(r), 6) as avg_source_score_range, round(avg(s),
        6) as avg_source_score_stddev
    from (select registered_domain, sources_count, any_value(consensus_score) as c, max(score) - min(score) as r,
    stddev_pop(score) as s from scores group by 1, 2) group by 1, 2""", _SCORES))
def agreement_distribution(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.agreement_distribution(P.mart(spark, d))


@query("disagreement_outliers", P.with_projections("""
    select registered_domain, sources_count, first(source_name order by score desc, source_name) as strongest_source,
    first(source_name order by score, source_name) as weakest_source,
        string_agg(source_name || ':' || printf('%.4f', score), ',' order by score desc, source_name) as source_score_summary,
        round(any_value(consensus_score), 4) as consensus_score,
        round(max(score) - min(score), 6) as source_score_range, round(max(score), 6) as strongest_source_score, round(min(score),
        6) as weakest_source_score
    from scores group by 1, 2""", _SCORES))
def disagreement_outliers(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.disagreement_outliers(P.mart(spark, d))


@query("jackknife_influence", P.with_projections("""
    select source_name, count(*) as scored_domains, round(case when min(c) < max(c) and min(w) < max(w) then corr(c, w) end,
    6) as full_vs_without_source_correlation,
        round(avg(abs(c - w)), 6) as avg_absolute_influence_points, round(quantile_cont(abs(c - w), 0.5),
        6) as median_absolute_influence_points,
        round(quantile_cont(abs(c - w), 0.95), 6) as p95_absolute_influence_points, round(max(abs(c - w)),
        6) as max_absolute_influence_points
    from (select source_name, s.consensus_score as c, (coalesce(p_tranco, 0) + coalesce(p_majestic, 0) + coalesce(p_radar,
    0) + coalesce(p_crux, 0) + coalesce(p_opr, 0) - score)
        / (s.sources_count - 1) * 100 as w from scores s join mart using (registered_domain) where s.consensus_score is not null
        and s.sources_count >= 3) group by 1""", _SCORES))
def jackknife_influence(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.jackknife_influence(P.mart(spark, d))


@query("risk_source_overlap", P.with_projections("""
    select 'source' as metric_type, source_name as metric_name, count(distinct registered_domain) as domains,
    null::bigint as union_domains, null::double as jaccard_similarity from stg_risk group by 2
    union all select 'risk_sources_count', risk_sources_count::varchar, count(*), null, null from risk group by 2
    union all select 'pair', a || '_' || b, count(*) filter (fa and fb), count(*) filter (fa or fb), round(count(*) filter (fa
    and fb)::double / nullif(count(*) filter (fa or fb), 0), 6)
    from (values ('urlhaus', 'threatfox'), ('urlhaus', 'phishtank'), ('threatfox', 'phishtank')) as p(a, b),
        lateral (select registered_domain, bool_or(source_name = a) as fa, bool_or(source_name = b) as fb from stg_risk
        group by 1) group by a, b"""))
def risk_source_overlap(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.risk_source_overlap(P.staged_risk(spark, d))


@query("risk_mart_coverage", P.with_projections("""
    select risk_sources_count, count(*) as risk_domains, count(*) filter (ranked) as domains_in_ranking_mart,
    count(*) filter (public) as domains_in_public_archive,
        count(*) filter (risk_sources_count >= 2 and ranked) as mart_domains_with_security_flag,
        count(*) filter (risk_sources_count >= 2 and public) as public_rows_with_security_flag,
        round(avg(consensus_score), 4) as avg_consensus_score, sum(threat_count)::bigint as threat_observations,
        sum(observed_hosts_count)::bigint as observed_hosts,
        round(count(*) filter (ranked)::double / count(*), 6) as pct_in_ranking_mart,
        round(count(*) filter (public)::double / count(*), 6) as pct_in_public_archive
    from (select r.*, m.consensus_score, m.registered_domain is not null as ranked, coalesce(m.consensus_score is not null
    or m.sources_count >= 2, false) as public
        from risk r left join mart m using (registered_domain)) group by 1"""))
def risk_mart_coverage(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.risk_mart_coverage(P.risk(spark, d), P.mart(spark, d))


@query("shared_platform_candidates", P.with_projections(f"""
    select registered_domain, risk_sources_count, array_to_string(threat_types, '|') as threat_types, first_threat_seen,
    last_threat_seen, threat_count, observed_hosts_count, n as ranking_sources_count,
        coverage_tier, consensus_score, seed as in_known_platform_seed, observed_hosts_count >= 10 as has_many_observed_hosts,
        threat_count >= 20 as has_many_observations,
        concat_ws(',', case when seed then 'known_platform_seed' end,
        case when observed_hosts_count >= 10 then 'many_observed_hosts' end,
        case when threat_count >= 20 then 'many_observations' end) as candidate_reasons
    from (select r.*, m.sources_count as n, m.coverage_tier, m.consensus_score,
    registered_domain in ({', '.join(map(repr, PLATFORMS))}) as seed
        from risk r left join mart m using (registered_domain) where r.risk_sources_count >= 2) where seed
        or observed_hosts_count >= 10 or threat_count >= 20"""))
def shared_platform_candidates(spark: SparkSession, d: str) -> DataFrame:
    return _flat(diagnostics.shared_platform_candidates(P.risk(spark, d), P.mart(spark, d), PLATFORMS))
