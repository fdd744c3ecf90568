"""The driver tables seen as ranking sources, risk feeds, weekly releases and logs; in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import mart as mart_ops
from ..operators import staging
from ..session import table

SNAPSHOT = "1998-08-02"
CRUX_MONTH = 199807
RISK_FLOOR = 224.0


def _domain(key: str) -> F.Column:
    return F.concat(F.lit("d"), F.col(key).cast("string"), F.lit(".example.com"))


def raw_tranco(spark: SparkSession, d: str) -> DataFrame:
    sales = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "l_partkey"))  # of test data: one row per part
    return sales.select(
        F.col("l_partkey").alias("k"), rank.cast("long").alias("tranco_rank")
    ).where("k % 5 <> 0").select(_domain("k").alias("registered_domain"), "tranco_rank")


def raw_majestic(spark: SparkSession, d: str) -> DataFrame:
    """Two rows per domain, as a feed with subdomains would have: dedup sums and takes the greatest."""
    sales = table(spark, d, "lineitem").where("l_partkey % 3 <> 0").groupBy(
        "l_partkey", (F.col("l_linenumber") % 2).alias("half")
    ).agg(
        F.count_distinct("l_suppkey").alias("ref_subnets"), F.count_distinct("l_orderkey").alias("subdomains_seen")
    )
    return sales.select(_domain("l_partkey").alias("registered_domain"), "ref_subnets", "subdomains_seen")


def raw_radar(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    bucket = F.when(size <= 5, 200).when(size <= 10, 1000).when(size <= 20, 10000).when(size <= 35, 100000).otherwise(1000000)
    parts = table(spark, d, "part").where("p_partkey % 4 <> 1")
    return parts.select(
        _domain("p_partkey").alias("registered_domain"), bucket.cast("long").alias("rank_bucket"),
        (size % 3 + 1).cast("long").alias("buckets_seen")
    )


def raw_crux(spark: SparkSession, d: str) -> DataFrame:
    """Two months and up to two origins per domain, with the rank in a nested struct."""
    price = F.col("p_retailprice")
    rank = F.when(price < 910, 1000).when(price < 930, 10000).when(price < 960, 100000).otherwise(1000000).cast("long")
    parts = table(spark, d, "part").where("p_partkey % 7 < 5")
    rows = parts.select(
        F.col("p_partkey").alias("k"), rank.alias("r"),
        F.explode(F.sequence(F.lit(0), (F.col("p_partkey") % 2).cast("int"))).alias("o")
    )
    month = F.when(F.col("k") % 11 == 0, CRUX_MONTH - 1).otherwise(CRUX_MONTH)
    host = F.concat(F.lit("https://"), F.when(F.col("o") == 1, "www.").otherwise(""), _domain("k"))
    return rows.select(
        month.alias("yyyymm"), host.alias("origin"), _domain("k").alias("registered_domain"),
        F.struct(F.struct(F.col("r").alias("rank")).alias("popularity")).alias("experimental")
    )


def raw_opr(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where("l_partkey % 2 = 0").groupBy("l_partkey", "l_returnflag").agg(
        F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n")
    )
    return rows.select(
        _domain("l_partkey").alias("registered_domain"),
        F.when(F.col("l_partkey") % 50 != 0, F.col("q") / F.col("n")).alias("openpagerank_decimal"),
        F.col("n").alias("openpagerank_integer"), F.col("q").cast("long").alias("openpagerank_rank"),
    )


def raw_risk(spark: SparkSession, d: str, source: str) -> DataFrame:
    kind = {"urlhaus": "error", "threatfox": "click", "phishtank": "purchase"}[source]
    events = table(spark, d, "events").where((F.col("event_type") == kind) & (F.col("value") >= RISK_FLOOR - 100))
    day = F.to_date("ts")
    return events.select(
        _domain("user_id").alias("registered_domain"),
        F.concat(F.lit("threat_"), (F.col("event_id") % 3).cast("string")).alias("threat_type"),
        day.alias("first_seen"), F.date_add(day, (F.col("event_id") % 5).cast("int")).alias("last_seen"),
        (F.col("event_id") % 4 + 1).alias("threat_count"), (F.col("event_id") % 7 + 1).alias("observed_hosts_count"),
    )


def staged_sources(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "tranco": staging.stage_tranco(raw_tranco(spark, d)), "majestic": staging.stage_majestic(raw_majestic(spark, d)),
        "radar": staging.stage_radar(raw_radar(spark, d)), "crux": staging.stage_crux(raw_crux(spark, d), CRUX_MONTH),
        "opr": staging.stage_opr(raw_opr(spark, d)),
    }


def staged_risk(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {s: staging.stage_risk(raw_risk(spark, d, s)) for s in mart_ops.RISK_SOURCES}


def risk(spark: SparkSession, d: str) -> DataFrame:
    return staging.risk_rollup(staged_risk(spark, d))


def mart(spark: SparkSession, d: str, distributed: bool | None = None) -> DataFrame:
    return mart_ops.consensus_mart(staged_sources(spark, d), risk(spark, d), F.lit(SNAPSHOT).cast("date"), distributed)


_NAME = "'d' || {} || '.example.com'"
#: The same projections as common table expressions for DuckDB, in order of use.
SQL: dict[str, str] = {
    "raw_tranco": f"""select {_NAME.format('k')} as registered_domain, tranco_rank from (
        select l_partkey as k, row_number() over (order by count(*) desc, l_partkey) as tranco_rank from lineitem
        group by l_partkey) where k % 5 <> 0""",
    "raw_majestic": f"""select {_NAME.format('l_partkey')} as registered_domain, count(distinct l_suppkey) as ref_subnets,
        count(distinct l_orderkey) as subdomains_seen
        from lineitem where l_partkey % 3 <> 0 group by l_partkey, l_linenumber % 2""",
    "raw_radar": f"""select {_NAME.format('p_partkey')} as registered_domain,
        case when p_size <= 5 then 200 when p_size <= 10 then 1000 when p_size <= 20 then 10000
        when p_size <= 35 then 100000 else 1000000 end::bigint as rank_bucket, (p_size % 3 + 1)::bigint as buckets_seen from part
        where p_partkey % 4 <> 1""",
    "raw_crux": f"""select case when p_partkey % 11 = 0 then {CRUX_MONTH - 1} else {CRUX_MONTH} end as yyyymm,
        'https://' || case when o = 1 then 'www.' else '' end || {_NAME.format('p_partkey')} as origin,
        {_NAME.format('p_partkey')} as registered_domain,
        case when p_retailprice < 910 then 1000 when p_retailprice < 930 then 10000 when p_retailprice < 960 then 100000 else 1000000 end::bigint as rank
        from part, (values (0), (1)) as v(o) where p_partkey % 7 < 5 and o <= p_partkey % 2""",
    "raw_opr": f"""select {_NAME.format('l_partkey')} as registered_domain,
        case when l_partkey % 50 <> 0 then sum(l_quantity) / count(*) end as openpagerank_decimal,
        count(*) as openpagerank_integer, sum(l_quantity)::bigint as openpagerank_rank from lineitem where l_partkey % 2 = 0
        group by l_partkey, l_returnflag""",
    "raw_risk": f"""select case event_type when 'error' then 'urlhaus' when 'click' then 'threatfox' else 'phishtank' end as source_name,
        {_NAME.format('user_id')} as registered_domain, 'threat_' || event_id % 3 as threat_type, ts::date as first_seen,
        ts::date + (event_id % 5)::int as last_seen,
        event_id % 4 + 1 as threat_count, event_id % 7 + 1 as observed_hosts_count from events
        where event_type in ('error', 'click', 'purchase') and value >= {RISK_FLOOR - 100}""",
    "stg_tranco": "select registered_domain, min(tranco_rank) as tranco_rank from raw_tranco group by 1",
    "stg_majestic": "select registered_domain, max(ref_subnets) as majestic_ref_subnets, sum(subdomains_seen)::bigint as majestic_subdomains_seen from raw_majestic group by 1",
    "stg_radar": "select registered_domain, min(rank_bucket) as radar_rank_bucket, max(buckets_seen) as radar_buckets_seen from raw_radar group by 1",
    "stg_crux": f"""select registered_domain, min(rank) as crux_rank_bucket, count(distinct origin) as crux_origins_seen,
        strptime(max(yyyymm)::varchar, '%Y%m')::date as crux_snapshot_date from raw_crux where yyyymm = {CRUX_MONTH}
        and rank is not null group by 1""",
    "stg_opr": """select registered_domain, max(openpagerank_decimal) as openpagerank_decimal,
        max(openpagerank_integer) as openpagerank_integer,
        min(openpagerank_rank) as openpagerank_rank, count(*) as opr_subdomains_seen from raw_opr group by 1""",
    "stg_risk": """select source_name, registered_domain, threat_type, min(first_seen) as first_seen, max(last_seen) as last_seen,
        sum(threat_count)::bigint as threat_count,
        max(observed_hosts_count) as observed_hosts_count from raw_risk group by 1, 2, 3""",
    "risk": """select registered_domain, count(distinct source_name) as risk_sources_count,
        list_sort(list_distinct(list(threat_type))) as threat_types,
        min(first_seen) as first_threat_seen, max(last_seen) as last_threat_seen, sum(threat_count)::bigint as threat_count,
        sum(observed_hosts_count)::bigint as observed_hosts_count from stg_risk group by 1""",
    "s_tranco": "select *, 1 - percent_rank() over (order by tranco_rank) as p_tranco from stg_tranco",
    "s_majestic": "select *, 1 - percent_rank() over (order by majestic_ref_subnets desc) as p_majestic from stg_majestic",
    "s_radar": "select *, 1 - percent_rank() over (order by radar_rank_bucket) as p_radar from stg_radar",
    "s_crux": "select *, 1 - percent_rank() over (order by crux_rank_bucket) as p_crux from stg_crux",
    "s_opr": "select *, 1 - percent_rank() over (order by openpagerank_decimal desc) as p_opr from stg_opr where openpagerank_decimal is not null",
    "spine": "select registered_domain from s_tranco union select registered_domain from s_majestic union select registered_domain from s_radar union select registered_domain from s_crux union select registered_domain from s_opr",
    "joined": """select *, (p_tranco is not null)::int + (p_majestic is not null)::int + (p_radar is not null)::int + (p_crux is not null)::int + (p_opr is not null)::int as sources_count
        from spine left join s_tranco using (registered_domain) left join s_majestic using (registered_domain) left
        join s_radar using (registered_domain)
        left join s_crux using (registered_domain) left join s_opr using (registered_domain) left
        join risk using (registered_domain)""",
    "mart": f"""select registered_domain, tranco_rank, p_tranco, majestic_ref_subnets, majestic_subdomains_seen, p_majestic,
        radar_rank_bucket, radar_buckets_seen, p_radar,
        crux_rank_bucket, crux_origins_seen, p_crux, crux_snapshot_date, openpagerank_decimal, openpagerank_integer,
        openpagerank_rank, opr_subdomains_seen, p_opr,
        case when sources_count >= 3 then (coalesce(p_tranco, 0) + coalesce(p_majestic, 0) + coalesce(p_radar,
        0) + coalesce(p_crux, 0) + coalesce(p_opr, 0)) / sources_count * 100 end as consensus_score,
        case when sources_count >= 5 then 'full' when sources_count = 4 then 'high' when sources_count = 3 then 'partial' else 'sparse' end as coverage_tier, sources_count,
        concat_ws(',', case when p_tranco is not null then 'tranco' end, case when p_majestic is not null then 'majestic' end,
        case when p_radar is not null then 'radar' end,
            case when p_crux is not null then 'crux' end, case when p_opr is not null then 'opr' end) as ranking_sources_present,
        null::varchar as tld_category, null::boolean as is_spam_prone_tld, coalesce(risk_sources_count,
        0) >= 2 as security_flags_observed,
        coalesce(risk_sources_count, 0) as risk_sources_count, coalesce(threat_types, []::varchar[]) as threat_types,
        last_threat_seen,
        date '{SNAPSHOT}' as snapshot_date, '{mart_ops.METHODOLOGY_VERSION}' as methodology_version from joined""",
}


def with_projections(query: str, *more: tuple[str, str]) -> str:
    """``query`` after the common table expressions, and after ``more`` of its own."""
    parts = [*SQL.items(), *more]
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in parts) + "\n" + query
