"""Raw feeds as they are downloaded, read and normalised to one row per key.

Zip archives aren't a Spark codec: their first CSV member is unpacked once, on the driver, into a folder that all
executors see. Everything after that is a distributed scan. Each reader gives the rows as text columns; the
normalisers parse them leniently, bring hosts to registered domains and aggregate.
"""

from __future__ import annotations

import gzip
import shutil
import zipfile
from collections.abc import Sequence
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.domains import DEFAULT_RULES, SuffixRule, url_host, with_registered_domain
from ..functions.values import header_key, lenient_date, lenient_double, lenient_int

#: Column names of a threat feed without a header.
THREAT_COLUMNS = (
    "first_seen_utc ioc_id ioc_value ioc_type threat_type malware malware_alias malware_printable last_seen_utc confidence_level reference reporter tags anonymous"
).split()


def unzip_first_csv(zip_path: str, folder: str) -> str:
    """Unpacks the first ``.csv`` member, gzipped, into ``folder`` and gives its path."""
    with zipfile.ZipFile(zip_path) as archive:
        members = [n for n in archive.namelist() if n.endswith(".csv")]
        if not members:
            raise ValueError(f"no CSV in {zip_path}")
        out = Path(folder) / (Path(members[0]).name + ".gz")
        out.parent.mkdir(parents=True, exist_ok=True)
        with archive.open(members[0]) as raw, gzip.open(out, "wb") as packed:
            shutil.copyfileobj(raw, packed)
    return str(out)


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_headerless(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Text columns of a CSV without a header; a byte-order mark goes."""
    df = spark.read.schema(_text_schema(names)).csv(path)
    return df.withColumn(names[0], F.regexp_replace(names[0], "^﻿", ""))


def read_with_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text columns of a CSV or gzipped CSV, named by their headers' letters and digits in lower case."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return df.toDF(*[header_key(c.lstrip("﻿")) or f"column{i}" for i, c in enumerate(df.columns)])


def read_buckets(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """One file per rank bucket, tagged with its bucket."""
    parts = [read_with_header(spark, p).withColumn("rankbucket", F.lit(str(b))) for b, p in paths.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_commented(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with ``#`` lines before it, whose header is one of them: the one that begins with id,dateadded,url."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("line"))
    header = lines.where(F.col("line").rlike(r"^#+\s*id,dateadded,url,")).first()
    if header is None:
        raise ValueError(f"no header in {path}")
    names = [header_key(x) for x in header.line.lstrip("#").strip().split(",")]
    rows = lines.where(~F.col("line").startswith("#") & (F.col("line") != ""))
    return rows.select(
        F.from_csv("line", F.lit(", ".join(f"{n} string" for n in names)), {"quote": '"', "escape": '"'}).alias("r")
    ).select("r.*")


def read_threats(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with or without a header. A leading ``#`` is taken off a line, not the line off: such lines count as rows.

    The header is the first line alone. Fields beyond the named ones are kept in the array ``_extra``.
    """
    line = F.trim(F.regexp_replace(F.regexp_replace("value", "^\ufeff", ""), "^#+", ""))
    lines = spark.read.text(path).select(line.alias("line"), F.monotonically_increasing_id().alias("at")).where("line <> ''")
    fields = F.size(F.split("line", ","))  # quoted commas make it more than there are
    known = lines.agg(F.min_by("line", "at").alias("first"), F.min("at").alias("at"), F.max(fields).alias("fields")).first()
    key = header_key(known.first) if known.first else ""
    named = "ioc" in key and "ioctype" in key
    names = [
        header_key(x.strip().strip('"')) for x in known.first.split(",")
    ] if named else [header_key(c) for c in THREAT_COLUMNS]
    rows = lines.where(F.col("at") > known.at) if named else lines
    more = [f"_more{i}" for i in range(max(0, (known.fields or 0) - len(names)))]
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "mode": "PERMISSIVE"}
    parsed = rows.select(F.from_csv("line", F.lit(", ".join(f"`{n}` string" for n in [*names, *more])), options).alias("r"))
    extra = F.array_compact(F.array(*[F.col(f"r.{n}") for n in more])) if more else F.array().cast("array<string>")
    return parsed.select(*[F.col(f"r.`{n}`").alias(n) for n in names], extra.alias("_extra"))


def first_of(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The first non-blank of the columns that exist, by letters and digits of their names."""
    known = [
        F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`"))
        for k in candidates for c in df.columns if header_key(c) == header_key(k)
    ]
    return F.coalesce(*known) if known else F.lit(None).cast("string")


def _ranked(df: DataFrame, domain: Column, value: Column, rules: Sequence[SuffixRule]) -> DataFrame:
    rows = df.select(domain.alias("_raw"), value.alias("_v")).where("_raw is not null and _v is not null")
    return with_registered_domain(rows, "_raw", "registered_domain", rules)


def normalise_ranks(
    df: DataFrame, domain: Column, value: Column, name: str, best: str = "min", seen: tuple[str, str] | None = None,
    rules: Sequence[SuffixRule] = DEFAULT_RULES
) -> DataFrame:
    """One row per registered domain with its best value; ``seen`` counts distinct raw values or names beside it.

    seen is (column name, "raw" or "value").
    """
    rows = _ranked(df, domain, value, rules).where("registered_domain is not null")
    extra = [F.count_distinct(F.lower(F.trim("_raw")) if seen[1] == "raw" else F.col("_v")).alias(seen[0])] if seen else []
    return rows.groupBy("registered_domain").agg((F.min if best == "min" else F.max)("_v").alias(name), *extra)


def rank_profile(df: DataFrame, domain: Column, value: Column, rules: Sequence[SuffixRule] = DEFAULT_RULES) -> DataFrame:
    """One row: rows that parse, distinct domains, and rows that repeat one."""
    rows = _ranked(df, domain, value, rules)
    one = rows.agg(
        F.count(F.lit(1)).alias("row_count"), F.count("registered_domain").alias("_known"),
        F.count_distinct("registered_domain").alias("valid_row_count")
    )
    return one.select(
        "row_count", "valid_row_count", (F.col("_known") - F.col("valid_row_count")).alias("duplicate_registered_domains")
    )


def normalise_tranco(df: DataFrame, rules: Sequence[SuffixRule] = DEFAULT_RULES) -> DataFrame:
    """Of (rank, domain) text columns."""
    return normalise_ranks(df, F.col("domain"), lenient_int(F.col("rank")), "tranco_rank", rules=rules)


def normalise_majestic(df: DataFrame, rules: Sequence[SuffixRule] = DEFAULT_RULES) -> DataFrame:
    return normalise_ranks(
        df, first_of(df, ["Domain"]), lenient_int(first_of(df, ["RefSubNets", "ref_subnets"])), "ref_subnets", "max",
        ("subdomains_seen", "raw"), rules
    )


def normalise_radar(df: DataFrame, rules: Sequence[SuffixRule] = DEFAULT_RULES) -> DataFrame:
    return normalise_ranks(
        df, first_of(df, ["domain"]), lenient_int(first_of(df, ["rank_bucket"])), "rank_bucket", "min", ("buckets_seen", "value"),
        rules
    )


def normalise_openpagerank(df: DataFrame, rules: Sequence[SuffixRule] = DEFAULT_RULES) -> DataFrame:
    """Every row that has any of the three values; domains may repeat."""
    out = with_registered_domain(
        df.select(
            first_of(df, ["domain"]).alias("_raw"),
            lenient_double(
                first_of(df, ["open page rank", "page rank value", "page_rank_decimal"])
            ).alias("openpagerank_decimal"),
            lenient_int(
                first_of(df, ["open page rank rounded", "page rank value rounded", "page_rank_integer"])
            ).alias("openpagerank_integer"),
            lenient_int(first_of(df, ["rank", "global rank", "openpagerank_rank"])).alias("openpagerank_rank"),
        ), "_raw", "registered_domain", rules,
    )
    known = F.coalesce(
        F.col("openpagerank_decimal"), F.col("openpagerank_integer").cast("double"), F.col("openpagerank_rank").cast("double")
    ).isNotNull()
    return out.where(F.col("registered_domain").isNotNull() & known).select(
        "registered_domain", "openpagerank_decimal", "openpagerank_integer", "openpagerank_rank"
    )


def _observed(df: DataFrame, kind: str) -> DataFrame:
    """(host, threat, first, last) of a risk feed's rows; what can't be used has a null host or first day."""
    if kind == "urlhaus":
        host, threat = url_host(first_of(df, ["url"])), F.coalesce(first_of(df, ["threat", "threat_type"]), F.lit("malware"))
        first, last = first_of(df, ["dateadded", "date_added", "first_seen"]), first_of(df, ["last_online", "last_seen"])
    elif kind == "threatfox":
        ioc, sort = first_of(df, ["ioc", "ioc_value", "indicator", "value"]), F.lower(
            F.trim(first_of(df, ["ioc_type", "indicator_type", "type"]))
        )
        host = F.when(sort == "url", url_host(ioc)).when(sort.isin("domain", "hostname"), F.trim(ioc))
        threat = F.coalesce(first_of(df, ["threat_type", "threat"]), F.lit("malware"))
        first, last = first_of(
            df, ["first_seen", "first_seen_utc", "date_added", "dateadded"]
        ), first_of(df, ["last_seen", "last_seen_utc"])
    elif kind == "phishtank":
        host, threat = url_host(first_of(df, ["url"])), F.lit("phishing")
        first, last = first_of(df, ["submission_time", "first_seen"]), first_of(df, ["verification_time", "last_seen"])
    else:
        raise ValueError(kind)
    rows = df.select(
        host.alias("host"), F.lower(F.trim(threat)).alias("threat_type"), lenient_date(first).alias("first"),
        lenient_date(last).alias("last")
    )
    return rows.withColumn("last", F.coalesce("last", "first"))


def normalise_risk(df: DataFrame, kind: str, rules: Sequence[SuffixRule] = DEFAULT_RULES) -> DataFrame:
    """One row per registered domain and threat type."""
    rows = with_registered_domain(
        _observed(df, kind), "host", "registered_domain", rules
    ).where("registered_domain is not null and first is not null")
    return rows.groupBy("registered_domain", "threat_type").agg(
        F.min("first").alias("first_seen"), F.max("last").alias("last_seen"), F.count(F.lit(1)).alias("threat_count"),
        F.count_distinct(F.lower("host")).alias("observed_hosts_count")
    )


def risk_profile(df: DataFrame, kind: str, rules: Sequence[SuffixRule] = DEFAULT_RULES) -> DataFrame:
    """One row: all rows, distinct keys, repeats of a key and rows left out."""
    rows = with_registered_domain(_observed(df, kind), "host", "registered_domain", rules)
    good = F.col("registered_domain").isNotNull() & F.col("first").isNotNull()
    one = rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(F.when(good, F.struct("registered_domain", "threat_type"))).alias("valid_row_count"),
        F.count_if(good).alias("_good")
    )
    return one.select(
        "row_count", "valid_row_count", (F.col("_good") - F.col("valid_row_count")).alias("duplicate_registered_domains"),
        (F.col("row_count") - F.col("_good")).alias("skipped_rows")
    )
