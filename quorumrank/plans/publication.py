"""Queries over published releases: shape, difference and stability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import releases as R
from ..operators.mart import SOURCES
from . import timeline
from .catalog import query

#: The slots that stand for releases, oldest first.
SLOTS = (4, 5, 6, 7)


def release(spark: SparkSession, d: str, slot: int) -> DataFrame:
    """A slot of the history as a release: two, four or five sources, the fewest without a score."""
    rows = timeline.releases(spark, d, "index").where(F.col("slot") == slot)
    n = F.element_at(F.array(F.lit(2), F.lit(4), F.lit(5)), (F.col("sources") - 2).cast("int"))
    k = F.split("registered_domain", r"\.")[0]
    number = F.substring(k, 2, 20).cast("long")
    end = F.element_at(F.array(F.lit(".example.com"), F.lit(".example.net"), F.lit(".example.org")), (number % 3 + 1).cast("int"))
    return rows.withColumn("sources_count", n).select(
        F.concat(k, end).alias("registered_domain"), F.when(n > 2, F.col("score")).alias("consensus_score"),
        F.when(n == 5, "full").when(n == 4, "high").otherwise("sparse").alias("coverage_tier"), "sources_count",
        F.array_join(F.slice(F.array(*[F.lit(s) for s in SOURCES]), 1, n), ",").alias("ranking_sources_present"),
        F.col("risks").alias("risk_sources_count"), (F.col("risks") >= 2).alias("security_flags_observed"),
        F.when(F.col("risks") >= 2, "malware|phishing").when(F.col("risks") == 1, "malware").otherwise("").alias("threat_types"),
    )


def _release_sql(slot: int) -> str:
    names = " ".join(f"when {n} then '{','.join(SOURCES[:n])}'" for n in (2, 4, 5))
    return f"""select k || case number % 3 when 0 then '.example.com' when 1 then '.example.net' else '.example.org' end as registered_domain, case when n > 2 then score end as consensus_score,
        case n when 5 then 'full' when 4 then 'high' else 'sparse' end as coverage_tier, n as sources_count,
        case n {names} end as ranking_sources_present, risks as risk_sources_count,
        risks >= 2 as security_flags_observed,
        case when risks >= 2 then 'malware|phishing' when risks = 1 then 'malware' else '' end as threat_types
        from (select *, case sources when 3 then 2 when 4 then 4 else 5 end as n, split_part(registered_domain, '.', 1) as k,
        substr(split_part(registered_domain, '.', 1), 2)::bigint as number
            from releases where slot = {slot})"""


_CTES = [("releases", timeline._releases_sql("index")), *[(f"r{s}", _release_sql(s)) for s in SLOTS]]
_CTES += [("cur", f"select * from r{SLOTS[-1]}"), ("prev", f"select * from r{SLOTS[-2]}")]
_CTES += [
    (
        "merged",
        f"select c.registered_domain, {
            ', '.join(f'c.{x} as {x}_current, p.{x} as {x}_previous' for x in R._COMPARED)
        } from cur c join prev p using (registered_domain)"
    )
]
_CTES += [
    (
        "moved",
        "select *, consensus_score_current - consensus_score_previous as score_delta from merged where consensus_score_current is not null and consensus_score_previous is not null"
    )
]


def _sql(text: str) -> str:
    return "with " + ",\n".join(f"{n} as ({t})" for n, t in _CTES) + "\n" + text


def _two(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return release(spark, d, SLOTS[-1]), release(spark, d, SLOTS[-2])


def _current(spark: SparkSession, d: str) -> DataFrame:
    return release(spark, d, SLOTS[-1])


_ORDER = "consensus_score desc nulls last, sources_count desc, registered_domain"
_SHAPE = """select {by}, count(*) as domains, count(consensus_score) as scored, round(avg(consensus_score), 6) as mean_score,
        round(median(consensus_score), 6) as median_score,
    round(quantile_cont(consensus_score, 0.95), 6) as p95_score, round(count(*) / sum(count(*)) over (), 6) as share from cur
    group by 1"""

query("release_shape", _sql(_SHAPE.format(by="coverage_tier")))(lambda spark, d: R.coverage_rows(_current(spark, d)))
query("release_shape_by_sources", _sql(_SHAPE.format(by="sources_count")))(
    lambda spark, d: R.coverage_rows(_current(spark, d), "sources_count")
)
query(
    "score_quantiles",
    _sql(
        " union all ".join(
            f"select '{k}' as label, {q}::double as q, round(quantile_cont(consensus_score, {q}), 6) as score from cur"
            for k, q in R.QUANTILES.items()
        )
    )
)(
    lambda spark, d: R.score_quantiles(_current(spark, d)))
query("score_bands", _sql(f"""select band, domains,
        case when band <> 'NULL' then round(domains / sum(domains) filter (band <> 'NULL') over (), 6) end as scored_share,
        round(domains / sum(domains) over (), 6) as share
    from (select b.band, count(c.band) as domains from (values {', '.join(f"('{b}')" for b in (*R.BANDS, 'NULL'))}) as b(band)
        left join (select case when consensus_score is null then 'NULL' else ([{', '.join(f"'{b}'" for b in R.BANDS)}])[least(floor(consensus_score / 10), 9)::int + 1] end as band from cur) c using (band) group by 1)"""))(
    lambda spark, d: R.score_bands(_current(spark, d)))
query("source_presence", _sql("""select kind, name, count(*) filter (hit) as domains,
        count(consensus_score) filter (hit) as scored from (
    select 'source' as kind, a as name, list_contains(string_split(ranking_sources_present, ','), a) as hit, consensus_score
    from cur, (values ('tranco'), ('majestic'), ('radar'), ('crux'), ('opr')) as s(a)
    union all select 'pair', a || '+' || b, list_contains(string_split(ranking_sources_present, ','), a)
    and list_contains(string_split(ranking_sources_present, ','), b), consensus_score
    from cur, (values """ + ", ".join(f"('{a}', '{b}')" for i, a in enumerate(SOURCES) for b in SOURCES[i + 1:]) + """) as p(a, b)
    union all select 'combination', ranking_sources_present, true, consensus_score from cur) group by 1,
    2"""))(lambda spark, d: R.source_presence(_current(spark, d)))
query(
    "threat_type_counts",
    _sql(
        "select threat_type, count(*) as domains from (select unnest(string_split(threat_types, '|')) as threat_type from cur where threat_types <> '') group by 1 order by 2 desc, 1 limit 20"
    )
)(
    lambda spark, d: R.threat_type_counts(_current(spark, d)))
query("risk_distribution", _sql("""select risk_sources_count, count(*) as domains, round(avg(consensus_score), 6) as mean_score,
        count(consensus_score) as scored,
    round(count(*) / sum(count(*)) over (), 6) as share from cur
    group by 1"""))(lambda spark, d: R.risk_distribution(_current(spark, d)))
query("risk_by_tier", _sql("""select coverage_tier, count(*) as domains, count(*) filter (risk_sources_count > 0) as with_risk,
        count(*) filter (security_flags_observed) as flagged,
    round(count(*) filter (risk_sources_count > 0) / count(*), 6) as risk_share,
    round(count(*) filter (security_flags_observed) / count(*), 6) as flagged_share from cur group by 1"""))(
    lambda spark, d: R.risk_by_tier(_current(spark, d)))
query("top_flagged", _sql(f"""select registered_domain, round(consensus_score, 4) as consensus_score, coverage_tier,
        sources_count, risk_sources_count, threat_types from (
    select * from cur where security_flags_observed
    order by {_ORDER} limit 25)"""))(lambda spark, d: R.top_flagged(_current(spark, d)))
query("rightmost_label", _sql("""select string_split(registered_domain, '.')[-1] as label, count(*) as domains,
        count(consensus_score) as scored, count(*) filter (security_flags_observed) as flagged,
    round(count(*) / sum(count(*)) over (), 6) as share from cur group by 1 order by 2 desc,
    1 limit 25"""))(lambda spark, d: R.rightmost_labels(_current(spark, d)))
query("release_count_deltas", _sql(" union all ".join(
    f"select '{k}' as metric, (select {e} from cur) as current, (select {e} from prev) as previous, (select {e} from cur) - (select {e} from prev) as delta"
    for k,
    e in {"public_rows": "count(*)", "scored_rows": "count(consensus_score)", "sparse_rows": "count(*) filter (coverage_tier = 'sparse')",
                 "risk_observed_rows": "count(*) filter (risk_sources_count > 0)",
                 "security_flagged_rows": "count(*) filter (security_flags_observed)"}.items())))(
    lambda spark, d: R.count_deltas(*_two(spark, d)))
query("release_set_diff", _sql("""select (select count(*) from cur semi join prev using (registered_domain)) as retained,
        (select count(*) from cur anti join prev using (registered_domain)) as added,
    (select count(consensus_score) from cur anti join prev using (registered_domain)) as added_scored, (select count(*)
    from prev anti join cur using (registered_domain)) as removed,
    (select count(consensus_score) from prev anti
    join cur using (registered_domain)) as removed_scored"""))(lambda spark, d: R.set_difference(*_two(spark, d)))
_DRIFT = """count(*) as both_scored, round(avg(score_delta), 6) as mean_delta, round(median(score_delta), 6) as median_delta,
        round(avg(abs(score_delta)), 6) as mean_abs_delta,
    round(quantile_cont(abs(score_delta), 0.95), 6) as p95_abs_delta, round(quantile_cont(abs(score_delta), 0.99),
    6) as p99_abs_delta, round(max(abs(score_delta)), 6) as max_abs_delta"""
query("score_drift", _sql(f"select {_DRIFT} from moved"))(lambda spark, d: R.score_drift(R.both(*_two(spark, d))))
_MOVER = "registered_domain, score_delta, consensus_score_current, consensus_score_previous, coverage_tier_current, coverage_tier_previous"
query("score_movers", _sql(f"""select * from (select {_MOVER}, 'up' as direction from moved order by score_delta desc,
        registered_domain limit 20)
    union all select * from (select {_MOVER}, 'down' as direction from moved order by score_delta,
    registered_domain limit 20)"""))(lambda spark, d: R.score_movers(R.both(*_two(spark, d))))
query("tier_transitions", _sql("select previous, " + ", ".join(f"count(*) filter (coverage_tier_current = '{t}') as to_{t}" for t in R.TIERS) +
      " from (values " + ", ".join(f"('{t}')" for t in R.TIERS) + ") as s(previous) left join merged on coverage_tier_previous = previous group by 1"))(
    lambda spark, d: R.transitions(R.both(*_two(spark, d))))
_TOPS = "select *, row_number() over (order by " + _ORDER + ") as k from {} where consensus_score is not null"
query("topn_retention", _sql(f"""select n, count(*) filter (greatest(a.k, b.k) <= n) as retained, count(*) filter (greatest(a.k,
        b.k) <= n) / n as retention
    from (values {', '.join(f'({n}::bigint)' for n in R.TOP_N)}) as t(n), ({_TOPS.format('cur')}) a
    join ({_TOPS.format('prev')}) b using (registered_domain) group by 1"""))(
    lambda spark, d: R.topn_retention(*_two(spark, d)))
query("top_entrants", _sql(f"""select registered_domain, round(consensus_score, 4) as consensus_score, coverage_tier,
        sources_count, ranking_sources_present from (
    select * from ({_TOPS.format('cur')}) where k <= 100 and registered_domain not in (select registered_domain
    from ({_TOPS.format('prev')}) where k <= 100) order by k limit 20)"""))(
    lambda spark, d: R.top_entrants(*_two(spark, d)))
query("release_summary", _sql(f"""select count(*) as rows, count(consensus_score) as scored_rows,
        count(*) filter (risk_sources_count > 0) as risk_observed_rows,
        count(*) filter (security_flags_observed) as security_flagged_rows,
    round(avg(consensus_score), 6) as score_mean, round(median(consensus_score), 6) as score_median,
    round(quantile_cont(consensus_score, 0.95), 6) as score_p95,
    {', '.join(f"count(*) filter (coverage_tier = '{t}') as {t}_rows" for t in R.TIERS)},
    {', '.join(f"count(*) filter (list_contains(string_split(ranking_sources_present, ','), '{s}')) as {s}_public_rows" for s in SOURCES)} from cur"""))(lambda spark, d: R.summary(_current(spark, d)))


def _stability_sql() -> str:
    rows = []
    for a, b in zip(SLOTS[:-1], SLOTS[1:], strict=True):
        tops = ", ".join(
            f"(select count(*) filter (greatest(a.k, b.k) <= {n}) / {n} from ({_TOPS.format(f'r{b}')}) a join ({_TOPS.format(f'r{a}')}) b using (registered_domain)) as top_{n}_retention" for n in (100, 1000)
        )
        rows.append(f"""select 'slot-{a}' as previous_release, 'slot-{b}' as current_release, (select count(*) from r{b} semi
        join r{a} using (registered_domain)) as retained,
            (select count(*) from r{b} anti join r{a} using (registered_domain)) as added, (select count(consensus_score)
            from r{b} anti join r{a} using (registered_domain)) as added_scored,
            (select count(*) from r{a} anti join r{b} using (registered_domain)) as removed, (select count(consensus_score)
            from r{a} anti join r{b} using (registered_domain)) as removed_scored,
            {_DRIFT}, {tops} from (select c.consensus_score - p.consensus_score as score_delta from r{b} c
            join r{a} p using (registered_domain) where c.consensus_score is not null and p.consensus_score is not null)""")
    return " union all ".join(rows)


def _stable(spark: SparkSession, d: str) -> DataFrame:
    return R.stability([(f"slot-{s}", release(spark, d, s)) for s in SLOTS])


query("stability_window", _sql(_stability_sql()))(_stable)
query("stability_readiness", _sql(f"""select a as top_100_min, b as top_1000_min, round(drift, 6) as p95_drift_median,
        case when least(a, b) < 0.90 or drift > 20 then 'red' when least(a, b) < 0.95
        or drift > 10 then 'yellow' else 'green' end as readiness
    from (select min(top_100_retention) as a, min(top_1000_retention) as b, median(p95_abs_delta) as drift
    from ({_stability_sql()}))"""))(lambda spark, d: R.readiness(_stable(spark, d)))
