"""Queries of the quality suite, source health, and host and calendar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import domains, values
from ..operators import health
from ..operators import quality as Q
from ..operators.mart import MIN_SOURCES, SIGNALS, SOURCES
from ..session import table
from . import projections as P
from . import publication, timeline
from .catalog import query


def _mart_test(name: str, test, where: str, table_name: str = "mart") -> None:
    """A test over the mart as a count of violations; ``where`` is the same in SQL."""
    query(
        f"quality_{name}", P.with_projections(f"select count(*) as violations from {table_name} where {where}")
    )(lambda spark, d: Q.violations(test(P.mart(spark, d))))


_mart_test(
    "tier_consistency", Q.tier_inconsistent,
    f"(coverage_tier = 'sparse' and consensus_score is not null) or (coverage_tier <> 'sparse' and consensus_score is null) or (sources_count < {MIN_SOURCES} and coverage_tier <> 'sparse') or (sources_count >= {MIN_SOURCES} and coverage_tier = 'sparse')"
)
_mart_test("score_in_range", Q.score_out_of_range, "not consensus_score between 0 and 100")
_mart_test("flags_need_sources", Q.flag_without_sources, "security_flags_observed and risk_sources_count < 2")
_mart_test("single_snapshot", Q.several_snapshots, "n <> 1", "(select count(distinct snapshot_date) as n from mart)")
_mart_test(
    "percentiles_populated", Q.unscored_signals, "true",
    "(" + " union all ".join(
        f"select registered_domain from mart where {SIGNALS[s].column} is not null and p_{s} is null" for s in SOURCES
    ) + ")"
)
_mart_test("sources_count", Q.miscounted_sources, "sources_count <> " + " + ".join(f"(p_{s} is not null)::int" for s in SOURCES))
_mart_test(
    "silent_sources", Q.silent_sources, "n = 0",
    "(" + " union all ".join(f"select count(p_{s}) as n from mart" for s in SOURCES) + ")"
)
_mart_test("score_direction", Q.wrong_direction, "best <= worst", "(" + " union all ".join(
    f"select {
        'arg_min' if SIGNALS[s].direction == 'asc' else 'arg_max'
    }(p_{s}, {SIGNALS[s].column}) as best, {'arg_max' if SIGNALS[s].direction == 'asc' else 'arg_min'}(p_{s}, {SIGNALS[s].column}) as worst from mart where p_{s} is not null"
    for s in SOURCES) + ")")
_mart_test(
    "unique_domain",
    lambda m: Q.duplicates(m, ["registered_domain"]), "true", "(select registered_domain from mart group by 1 having count(*) > 1)"
)
_mart_test(
    "accepted_tier",
    lambda m: Q.not_accepted(m, "coverage_tier", ["full", "high", "partial"]), "coverage_tier not in ('full', 'high', 'partial')"
)

_RISK = "registered_domain threat_type first_seen last_seen threat_count observed_hosts_count"
#: Columns that must not be null, by table; a risk table stands for its three feeds.
_REQUIRED = {t: c.split() for t, c in {
    "raw_tranco": "registered_domain tranco_rank", "raw_majestic": "registered_domain ref_subnets subdomains_seen",
    "raw_radar": "registered_domain rank_bucket buckets_seen",
    "raw_crux": "yyyymm origin registered_domain",
    "raw_opr": "registered_domain openpagerank_decimal openpagerank_integer openpagerank_rank", "raw_risk": _RISK,
    "stg_tranco": "registered_domain tranco_rank",
    "stg_majestic": "registered_domain majestic_ref_subnets majestic_subdomains_seen",
    "stg_radar": "registered_domain radar_rank_bucket radar_buckets_seen",
    "stg_crux": "registered_domain crux_rank_bucket crux_origins_seen crux_snapshot_date",
    "stg_opr": "registered_domain opr_subdomains_seen", "stg_risk": _RISK,
    "risk": "registered_domain risk_sources_count threat_types first_threat_seen last_threat_seen threat_count observed_hosts_count",
    "mart": "registered_domain coverage_tier sources_count ranking_sources_present security_flags_observed risk_sources_count threat_types snapshot_date methodology_version consensus_score p_tranco last_threat_seen",
}.items()}
_RANKING = ("tranco", "majestic", "radar", "crux", "opr")
_FEEDS = ("urlhaus", "threatfox", "phishtank")


def _suite(spark: SparkSession, d: str) -> dict[str, list[DataFrame]]:
    """Tables of the suite by name, the risk feeds one by one."""
    raw = {"tranco": P.raw_tranco, "majestic": P.raw_majestic, "radar": P.raw_radar, "crux": P.raw_crux, "opr": P.raw_opr}
    staged, risk = P.staged_sources(spark, d), P.staged_risk(spark, d)
    return {
        **{f"raw_{s}": [raw[s](spark, d)] for s in _RANKING}, "raw_risk": [P.raw_risk(spark, d, s) for s in _FEEDS],
        **{f"stg_{s}": [staged[s]] for s in _RANKING},
        "stg_risk": [risk[s] for s in _FEEDS], "risk": [P.risk(spark, d)], "mart": [P.mart(spark, d)],
    }


@query("quality_not_null", P.with_projections(" union all ".join(
    f"select '{t}' as \"table\", '{c}' as \"column\", count(*) filter ({c} is null) as violations from {t}" for t,
    columns in _REQUIRED.items() for c in columns)))
def quality_not_null(spark: SparkSession, d: str) -> DataFrame:
    tables = _suite(spark, d)
    parts = [
        Q.null_counts(reduce(DataFrame.unionByName, tables[t]), c).withColumn("table", F.lit(t)) for t, c in _REQUIRED.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_UNIQUE = ("stg_tranco", "stg_majestic", "stg_radar", "stg_crux", "stg_opr", "risk", "mart", "raw_majestic", "raw_opr")


@query("quality_unique", P.with_projections(" union all ".join(
    f"select '{t}' as \"table\", count(*) as violations from (select registered_domain from {t} group by 1 having count(*) > 1)" for t in _UNIQUE)))
def quality_unique(spark: SparkSession, d: str) -> DataFrame:
    """On two raw feeds too, where domains do repeat."""
    tables = _suite(spark, d)
    return reduce(
        DataFrame.unionByName,
        [Q.violations(Q.duplicates(tables[t][0], ["registered_domain"])).withColumn("table", F.lit(t)) for t in _UNIQUE]
    )


@query("quality_unique_combination", P.with_projections(" union all ".join(
    f"select '{s}' as source, '{t}' as \"table\", count(*) as violations from (select 1 from {t} where source_name = '{s}' group by registered_domain, threat_type having count(*) > 1)"
    for t in ("raw_risk", "stg_risk") for s in _FEEDS)))
def quality_unique_combination(spark: SparkSession, d: str) -> DataFrame:
    """On the raw feeds too, where keys do repeat."""
    tables = _suite(spark, d)
    parts = [
        Q.violations(Q.duplicates(df, ["registered_domain", "threat_type"])).withColumns({"source": F.lit(s), "table": F.lit(t)})
        for t in ("raw_risk", "stg_risk") for s, df in zip(_FEEDS, tables[t], strict=True)
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "quality_unique_risk_key",
    P.with_projections(
        "select count(*) as violations from (select registered_domain, threat_type from raw_risk group by 1, 2 having count(*) > 1)"
    )
)
def quality_unique_risk_key(spark: SparkSession, d: str) -> DataFrame:
    """On the raw feeds together, where keys do repeat."""
    rows = [P.raw_risk(spark, d, s).select("registered_domain", "threat_type") for s in ("urlhaus", "threatfox", "phishtank")]
    return Q.violations(Q.duplicates(reduce(DataFrame.unionByName, rows), ["registered_domain", "threat_type"]))


@query("quality_freshness", """select kind, latest, datediff('day', latest, date '2024-02-08') as age_days,
        case when datediff('day', latest, date '2024-02-08') > error then 'error'
    when datediff('day', latest, date '2024-02-08') > warn then 'warn' else 'pass' end as status
    from (select event_type as kind, max(ts)::date as latest from events group by 1), (values (8, 14)) as t(warn, error)""")
def quality_freshness(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    warn, error = Q.FRESHNESS["ranking"]
    kinds = ["click", "error", "purchase", "signup", "view"]  # the fixed event types of the test data
    now = F.lit("2024-02-08").cast("date")
    parts = [
        Q.freshness(events.where(F.col("event_type") == k), "day", now, warn, error).withColumn("kind", F.lit(k)) for k in kinds
    ]
    return reduce(DataFrame.unionByName, parts)


@query("quality_release_frame", publication._sql("""select count(*) filter (registered_domain is null) as null_domains,
        count(registered_domain) - count(distinct registered_domain) as repeated_domains,
    count(*) filter (not consensus_score between 0 and 100) as scores_out_of_range, 0::bigint as other_dates,
    0::bigint as other_versions from cur"""))
def quality_release_frame(spark: SparkSession, d: str) -> DataFrame:
    day = F.lit("2001-12-31").cast("date")
    release = publication.release(spark, d, publication.SLOTS[-1]).withColumns(
        {"snapshot_date": day, "methodology_version": F.lit("v1")}
    )
    return Q.invalid_release(release, day, "v1")


@query("quality_index_frame", timeline._CHAIN.sql(f"""select count(*) as rows,
        count(*) filter (registered_domain is null) as null_domains,
        count(registered_domain) - count(distinct registered_domain) as repeated_domains,
    count(*) filter (not reputation_score between 0 and 100 or not score_candidate between 0 and 100) as scores_out_of_range,
    count(*) filter (not reputation_confidence between 0 and 1) as confidence_out_of_range,
    count(*) filter (reputation_trend not in ('rising', 'falling', 'stable', 'uncertain')) as unknown_trends,
    count(*) filter (structural_shock not in ('true', 'false')) as unknown_shocks
    from (select {timeline._list(timeline.T.INDEX_COLUMNS)} from {timeline._PARTS})"""))
def quality_index_frame(spark: SparkSession, d: str) -> DataFrame:
    return Q.invalid_index(timeline.T.temporal_index(timeline.history(spark, d), F.lit("2001-12-31").cast("date")))


def update_log(spark: SparkSession, d: str) -> DataFrame:
    """Events as an update log: users are sources, errors are failures."""
    e = table(spark, d, "events")
    status = F.when(F.col("event_type") == "error", "missing").when(F.col("event_type") == "view", "stale").otherwise("success")
    source = F.element_at(F.array(*[F.lit(s) for s in health.STALE_TTL_DAYS]), (F.col("user_id") % 8 + 1).cast("int"))
    ts = F.col("ts").cast("timestamp")
    return e.select(
        source.alias("source"), ts.alias("update_started_at"),
        F.when(F.col("event_id") % 17 != 0, ts + F.expr("interval 60 seconds")).alias("update_completed_at"),
        status.alias("status"),
        F.when(status != "missing", F.col("event_id")).otherwise(0).alias("row_count"),
        F.when(status == "stale", F.col("event_id") % 9).alias("age_days"),
        F.lit(None).cast("string").alias("source_metadata"), F.when(status == "missing", F.lit("failed")).alias("error_message"),
    )


_NAMES = list(health.STALE_TTL_DAYS)
_LOG = f"""log as (select ([{', '.join(map(repr, _NAMES))}])[user_id % 8 + 1] as source, ts as update_started_at,
        case when event_id % 17 <> 0 then ts + interval 60 second end as update_completed_at,
    case event_type when 'error' then 'missing' when 'view' then 'stale' else 'success' end as status,
    case when event_type <> 'error' then event_id else 0 end as row_count,
    case when event_type = 'view' then event_id % 9 end as age_days,
    case when event_type = 'error' then 'failed' end as error_message from events),
    newest as (select * replace (case status when 'success' then 'fresh' else status end as status) from log
        qualify row_number() over (partition by source order by update_completed_at desc nulls last,
        update_started_at desc) = 1)"""
_EXPECTED = [*_NAMES[:5], "unknown_feed", "crux_extra"]


@query("source_health", f"""with {_LOG} select s.source, coalesce(status, 'not_logged') as status, row_count, age_days,
        error_message,
    coalesce(status, 'not_logged') in ('missing', 'not_logged') or coalesce(row_count = 0, false) as unhealthy
    from (values {', '.join(f"('{s}')" for s in _EXPECTED)}) as s(source) left join newest using (source)""")
def source_health(spark: SparkSession, d: str) -> DataFrame:
    return health.source_health(update_log(spark, d), _EXPECTED)


@query(
    "latest_source_status",
    f"""with {_LOG} select source, status, row_count, coalesce(age_days, datediff('day', update_completed_at::date,
        date '2024-03-01')) as age_days, error_message from newest"""
)
def latest_source_status(spark: SparkSession, d: str) -> DataFrame:
    return health.source_status(update_log(spark, d), F.lit("2024-03-01").cast("date"))


_TTL = " ".join(f"when '{s}' then {n}" for s, n in health.STALE_TTL_DAYS.items())


@query("fallback_states", f"""with {_LOG}, good as (select source, max(update_completed_at) as done, arg_max(row_count,
        update_completed_at) as n from log where status = 'success' group by 1)
    select source, case when status = 'fresh' then 'fresh' when days <= ttl then 'stale' else 'missing' end as status,
        case when status = 'fresh' then row_count when days <= ttl then n else 0 end as row_count,
        case when status = 'fresh' then 0 when days <= ttl then days end as age_days
    from (select newest.source, status, row_count, n,
    floor(epoch(timestamp '2024-02-20 00:00:00' - done) / 86400)::bigint as days, case newest.source {_TTL} end as ttl
    from newest left join good using (source))""")
def fallback_states(spark: SparkSession, d: str) -> DataFrame:
    return health.fallback_states(update_log(spark, d), F.lit("2024-02-20").cast("timestamp"))


@query("feed_profile", P.with_projections(f"""select count(*) as origin_rows,
        count(distinct registered_domain) as registered_domains, array_to_string(list_sort(list_distinct(list(rank))),
        ',') as buckets
    from raw_crux where yyyymm = {P.CRUX_MONTH} and rank is not null"""))
def feed_profile(spark: SparkSession, d: str) -> DataFrame:
    row = health.rank_profile(P.raw_crux(spark, d), P.CRUX_MONTH, F.col("registered_domain"))
    return row.withColumn("buckets", F.array_join(F.transform("buckets", lambda x: x.cast("string")), ","))


@query("url_host", "select page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) as host from pages")
def url_host(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", domains.url_host(F.col("url")).alias("host"))


_EXAMPLES = [domains.SuffixRule(f"example.{t}", section="private") for t in ("com", "net", "org")]


@query("registered_domain", """select page_id, regexp_extract(host, '([^.]+\\.[^.]+)$', 1) as icann_domain,
        nullif(regexp_extract(host, '([^.]+\\.example\\.[^.]+)$', 1), '') as private_domain
    from (select page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) as host from pages)""")
def registered_domain(spark: SparkSession, d: str) -> DataFrame:
    hosts = table(spark, d, "pages").select("page_id", domains.url_host(F.col("url")).alias("host"))
    out = domains.with_registered_domain(hosts, "host", "icann_domain")
    rules = [*domains.DEFAULT_RULES, *_EXAMPLES]
    return domains.with_registered_domain(out, "host", "private_domain", rules, private=True).drop("host")


@query("iso_week_grid", """select o_orderdate::date as day, strftime(o_orderdate, 'data-%G-W%V') as tag,
        strftime((o_orderdate::date - ((isodow(o_orderdate) - 1) || ' days')::interval - interval 49 day)::date,
        '%Y-%m-%d') as first_monday
    from (select distinct o_orderdate from orders)""")
def iso_week_grid(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "orders").select("o_orderdate").distinct().select(F.to_date("o_orderdate").alias("day"))
    return days.select(
        "day", values.iso_week_tag(F.col("day")).alias("tag"),
        values.week_grid_column(F.col("day"))[0].cast("string").alias("first_monday")
    )
