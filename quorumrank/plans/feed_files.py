"""Queries over raw feed files: driver tables written as the feeds are published, read and normalised again."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from ..sources import archive, feeds
from ..session import shared_folder, table
from . import projections as P
from .catalog import query


def _put(df: DataFrame, **options: str) -> str:
    """Writes text columns as CSV into the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/feed-{uuid.uuid4().hex}"
    df.write.options(**options).csv(path)
    return path


def _lines(head: list[str], rows: DataFrame, line: Column) -> str:
    """Writes ``head`` and a line for each row as one text file, as comments stand before the rows."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/feed-{uuid.uuid4().hex}"
    first = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in head])).alias("value"), F.lit(0).alias("o"))
    rows = first.unionByName(rows.select(line.alias("value"), F.lit(1).alias("o")))
    rows.coalesce(1).sortWithinPartitions("o").select("value").write.text(path)  # a feed is a file
    return path


def _site(k: str) -> Column:
    """Host of a row: with and without subdomain, under a two-label suffix, in upper case, or no domain at all."""
    n = (F.col(k) % 50).cast("string")
    return (
        F.when(F.col(k) % 19 == 0, "localhost").when(F.col(k) % 3 == 0, F.concat(F.lit("WWW.D"), n, F.lit(".com")))
        .when(F.col(k) % 3 == 1, F.concat(F.lit("a.b.d"), n, F.lit(".co.uk"))).otherwise(F.concat(F.lit("d"), n, F.lit(".com")))
    )


_SITE = "case when {0} % 19 = 0 then null when {0} % 3 = 0 then 'd' || {0} % 50 || '.com' when {0} % 3 = 1 then 'd' || {0} % 50 || '.co.uk' else 'd' || {0} % 50 || '.com' end"
_RAW = "case when {0} % 3 = 0 then 'www.d' || {0} % 50 || '.com' when {0} % 3 = 1 then 'a.b.d' || {0} % 50 || '.co.uk' else 'd' || {0} % 50 || '.com' end"
_KEY = _SITE.format("p_partkey")


def tranco_file(spark: SparkSession, d: str) -> DataFrame:
    """Headerless rank and domain, with ranks that aren't numbers and blanks around others."""
    rank = F.when(F.col("p_partkey") % 13 == 0, "x").otherwise(
        F.concat(F.lit(" "), (F.col("p_partkey") * 7 % 1000 + 1).cast("string"))
    )
    rows = table(spark, d, "part").select(rank.alias("rank"), _site("p_partkey").alias("domain"))
    return feeds.read_headerless(spark, _put(rows), ["rank", "domain"])


_TRANCO = f"select {_KEY} as registered_domain, case when p_partkey % 13 <> 0 then p_partkey * 7 % 1000 + 1 end as rank from part"


@query(
    "feed_tranco",
    f"select registered_domain, min(rank) as tranco_rank from ({_TRANCO}) where registered_domain is not null and rank is not null group by 1"
)
def feed_tranco(spark: SparkSession, d: str) -> DataFrame:
    return feeds.normalise_tranco(tranco_file(spark, d))


@query("feed_rank_profile", f"""select count(*) as row_count, count(distinct registered_domain) as valid_row_count,
        count(registered_domain) - count(distinct registered_domain) as duplicate_registered_domains
    from ({_TRANCO}) where rank is not null""")
def feed_rank_profile(spark: SparkSession, d: str) -> DataFrame:
    return feeds.rank_profile(tranco_file(spark, d), F.col("domain"), values.lenient_int(F.col("rank")))


@query("feed_majestic", f"""select {_KEY} as registered_domain, max(p_partkey % 97) as ref_subnets,
        count(distinct {_RAW.format('p_partkey')}) as subdomains_seen
    from part where p_partkey % 19 <> 0 group by 1""")
def feed_majestic(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("GlobalRank"), _site("p_partkey").alias("Domain"),
        (F.col("p_partkey") % 97).cast("string").alias("RefSubNets")
    )
    return feeds.normalise_majestic(feeds.read_with_header(spark, _put(rows, header="true")))


@query("feed_radar", f"""select {_KEY} as registered_domain, min(b)::bigint as rank_bucket, count(distinct b) as buckets_seen
    from part, (values (200, 10), (1000, 25), (5000, 50)) as v(b, size) where p_size <= size and p_partkey % 19 <> 0
    group by 1""")
def feed_radar(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part")
    files = {
        b: _put(parts.where(F.col("p_size") <= size).select(_site("p_partkey").alias("domain")), header="true")
        for b, size in ((200, 10), (1000, 25), (5000, 50))
    }
    return feeds.normalise_radar(feeds.read_buckets(spark, files))


@query("feed_openpagerank", f"""select * from (select {_KEY} as registered_domain,
        case when p_partkey % 4 <> 0 then (p_size / 5.0)::double end as openpagerank_decimal,
        null::bigint as openpagerank_integer,
    case when p_partkey % 6 <> 0 then p_partkey end as openpagerank_rank from part) where registered_domain is not null
    and (openpagerank_decimal is not null or openpagerank_rank is not null)""")
def feed_openpagerank(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(
        F.when(F.col("p_partkey") % 6 != 0, F.col("p_partkey").cast("string")).alias("Rank"), _site("p_partkey").alias("Domain"),
        F.when(F.col("p_partkey") % 4 != 0, (F.col("p_size") / 5.0).cast("string")).alias("Open Page Rank"),
    )
    return feeds.normalise_openpagerank(feeds.read_with_header(spark, _put(rows, header="true", quoteAll="true")))


def _events(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, d, "events").select(
        "event_id", "user_id", "event_type", day.alias("day"),
        F.date_format(F.date_add(F.to_date("ts"), 2), "yyyy-MM-dd").alias("later"), _site("user_id").alias("site")
    )


_SEEN = f"""select {_SITE.format('user_id')} as registered_domain, {_RAW.format('user_id')} as host, event_id, event_type,
        ts::date as day from events"""
_GROUPED = """registered_domain, {threat} as threat_type, min(day) as first_seen, max(last) as last_seen,
        count(*) as threat_count, count(distinct host) as observed_hosts_count"""


def urlhaus_file(spark: SparkSession, d: str) -> DataFrame:
    """Quoted rows under comments, of which one is the header; some days can't be read, some rows were never seen again."""
    fields = [
        F.col("event_id").cast("string"),
        F.when(F.col("event_id") % 11 == 0, "bad").otherwise(F.concat("day", F.lit(" 10:00:00"))),
        F.concat(F.lit("http://u:p@"), "site", F.lit(":80/x?y=1,2")), F.initcap("event_type"),
        F.when(F.col("event_id") % 3 == 0, F.col("later")).otherwise(""),
    ]
    line = F.concat_ws(",", *[F.concat(F.lit('"'), x, F.lit('"')) for x in fields])
    return feeds.read_commented(spark, _lines(["# a note", "# id,dateadded,url,threat,last_online"], _events(spark, d), line))


_URLHAUS = f"select *, case when event_id % 3 = 0 then day + 2 else day end as last from ({_SEEN}) where event_id % 11 <> 0 and registered_domain is not null"


@query("feed_urlhaus", f"select {_GROUPED.format(threat='event_type')} from ({_URLHAUS}) group by 1, 2")
def feed_urlhaus(spark: SparkSession, d: str) -> DataFrame:
    return feeds.normalise_risk(urlhaus_file(spark, d), "urlhaus")


@query("feed_risk_profile", f"""select (select count(*) from events) as row_count, count(distinct (registered_domain,
        event_type)) as valid_row_count,
    count(*) - count(distinct (registered_domain, event_type)) as duplicate_registered_domains, (select count(*)
    from events) - count(*) as skipped_rows from ({_URLHAUS})""")
def feed_risk_profile(spark: SparkSession, d: str) -> DataFrame:
    return feeds.risk_profile(urlhaus_file(spark, d), "urlhaus")


@query(
    "feed_threatfox",
    f"""select {
        _GROUPED.format(threat='event_type')
    } from (select *, day as last from ({_SEEN}) where event_id % 4 <> 3 and registered_domain is not null) group by 1, 2"""
)
def feed_threatfox(spark: SparkSession, d: str) -> DataFrame:
    """No header, blanks after commas, hashes among the indicators, and fields beyond the named ones."""
    kind = F.when(F.col("event_id") % 4 == 3, "md5").when(F.col("event_id") % 4 == 2, "url").otherwise("domain")
    fields = [
        F.col("day"), F.col("event_id").cast("string"),
        F.when(kind == "url", F.concat(F.lit("https://"), "site", F.lit("/a"))).otherwise(F.col("site")), kind,
        F.col("event_type")
    ]
    line = F.concat_ws(", ", *[F.concat(F.lit('"'), x, F.lit('"')) for x in [*fields, *[F.lit("")] * 9]], F.lit("surplus"))
    return feeds.normalise_risk(
        feeds.read_threats(spark, _lines(["# a preamble that counts as a row"], _events(spark, d), line)), "threatfox"
    )


@query(
    "feed_phishtank",
    f"""select {
        _GROUPED.format(threat="'phishing'")
    } from (select *, case when event_id % 2 = 0 then day + 2 else day end as last from ({_SEEN}) where registered_domain is not null) group by 1, 2"""
)
def feed_phishtank(spark: SparkSession, d: str) -> DataFrame:
    rows = _events(spark, d).select(
        F.concat(F.lit("http://"), "site", F.lit("/login")).alias("url"),
        F.concat("day", F.lit("T01:02:03+00:00")).alias("submission_time"),
        F.when(F.col("event_id") % 2 == 0, F.col("later")).alias("verification_time"),
    )
    return feeds.normalise_risk(feeds.read_with_header(spark, _put(rows, header="true", compression="gzip")), "phishtank")


_TEXTS = """select event_id, case event_id % 6 when 0 then ' ' || event_id || ' ' when 1 then event_id || '.5' when 2 then 'x' || event_id when 3 then '-' || event_id when 4 then '' else event_id || 'e2' end as number,
    case event_id % 5 when 0 then strftime(ts, '%Y-%m-%d') when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 2 then strftime(ts,
    '%Y%m%d') when 3 then 'None' else '2024-13-45' end as day from events"""


@query("lenient_values", f"""select event_id, case when event_id % 6 in (0, 3) then trim(number)::bigint end as as_int,
        try_cast(trim(number) as double) as as_double,
    case when event_id % 5 < 2 then substr(day, 1, 10)::date when event_id % 5 = 2 then strptime(day,
    '%Y%m%d')::date end as as_date from ({_TEXTS})""")
def lenient_values(spark: SparkSession, d: str) -> DataFrame:
    """Numbers and dates in the ways that feeds write them."""
    e, n = table(spark, d, "events"), F.col("event_id").cast("string")
    number = F.element_at(
        F.array(
            F.concat(F.lit(" "), n, F.lit(" ")), F.concat(n, F.lit(".5")), F.concat(F.lit("x"), n), F.concat(F.lit("-"), n),
            F.lit(""), F.concat(n, F.lit("e2"))
        ),
        (F.col("event_id") % 6 + 1).cast("int")
    )
    day = F.element_at(
        F.array(
            F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format("ts", "yyyyMMdd"),
            F.lit("None"), F.lit("2024-13-45")
        ),
        (F.col("event_id") % 5 + 1).cast("int")
    )
    return e.select(
        "event_id", values.lenient_int(number).alias("as_int"), values.lenient_double(number).alias("as_double"),
        values.lenient_date(day).alias("as_date")
    )


@query("archive_scan", P.with_projections("""select registered_domain, consensus_score::float::double as consensus_score,
        coverage_tier, sources_count, ranking_sources_present, security_flags_observed,
        risk_sources_count::int as risk_sources_count,
    nullif(array_to_string(threat_types, '|'), '') as threat_types, snapshot_date, methodology_version from mart
    where consensus_score is not null or sources_count >= 2"""))
def archive_scan(spark: SparkSession, d: str) -> DataFrame:
    """The public archive as files and back, with types; empty text reads as null."""
    path = _put(_public(spark, d), header="true", compression="gzip")
    return archive.read_release(spark, path).drop("tld_category", "is_spam_prone_tld")


def _public(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import mart

    return mart.public_archive(P.mart(spark, d))


@query("archive_scan_tolerant", P.with_projections("""select registered_domain, round(consensus_score, 6) as consensus_score,
        coverage_tier, sources_count, '' as ranking_sources_present, security_flags_observed,
    case when sources_count = 2 then 0 else risk_sources_count end::int as risk_sources_count, null::date as snapshot_date,
    methodology_version from mart where consensus_score is not null or sources_count >= 2"""))
def archive_scan_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """An archive of another schema: columns are missing, flags are words and some numbers can't be read."""
    rows = _public(spark, d).drop("ranking_sources_present", "snapshot_date", "threat_types")
    rows = rows.withColumns(
        {
            "security_flags_observed": F.when(F.col("security_flags_observed"), "TRUE").otherwise("no"),
            "risk_sources_count": F.when(F.col("sources_count") == 2, "?").otherwise(F.col("risk_sources_count").cast("string"))
        }
    )
    out = archive.read_tolerant(spark, _put(rows, header="true"))
    return out.withColumn("consensus_score", F.round("consensus_score", 6)).drop(
        "tld_category", "is_spam_prone_tld", "threat_types"
    )
