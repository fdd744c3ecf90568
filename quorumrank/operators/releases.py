"""Published releases: the shape of one, the difference of two, and the stability of many."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .mart import SOURCES

TIERS = ("full", "high", "partial", "sparse")
QUANTILES = {
    "min": 0.0, "p01": 0.01, "p05": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99,
    "max": 1.0
}
BANDS = ("0-10", "10-20", "20-30", "30-40", "40-50", "50-60", "60-70", "70-80", "80-90", "90-100")
TOP_N = (100, 1_000, 10_000, 100_000)


def is_scored() -> Column:
    return F.col("consensus_score").isNotNull()


def _total() -> Column:
    return F.sum("domains").over(Window.partitionBy())  # over a few groups


def parse_bool(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value.cast("string"))) == "true", F.lit(False))


def has_source(source: str, column: str = "ranking_sources_present") -> Column:
    return F.array_contains(F.split(F.coalesce(F.col(column), F.lit("")), ","), source)


def coverage_rows(release: DataFrame, by: str = "coverage_tier") -> DataFrame:
    """By tier (or number of sources): domains, share, scored ones and their mean, median and 95th percentile."""
    s = "consensus_score"
    groups = release.groupBy(by).agg(
        F.count(F.lit(1)).alias("domains"), F.count(s).alias("scored"), F.round(F.avg(s), 6).alias("mean_score"),
        F.round(F.percentile(s, 0.5), 6).alias("median_score"), F.round(F.percentile(s, 0.95), 6).alias("p95_score"),
    )
    return groups.withColumn("share", F.round(F.col("domains") / _total(), 6))


def score_quantiles(release: DataFrame) -> DataFrame:
    """(label, q, score) of the fixed quantiles, interpolated linearly."""
    row = release.agg(F.percentile("consensus_score", F.array(*[F.lit(q) for q in QUANTILES.values()])).alias("v"))
    labels = F.array(*[F.struct(F.lit(k).alias("label"), F.lit(q).alias("q")) for k, q in QUANTILES.items()])
    return row.select(
        F.inline(F.arrays_zip(labels.alias("l"), F.col("v").alias("v")))
    ).select("l.label", "l.q", F.round("v", 6).alias("score"))


def score_bands(release: DataFrame) -> DataFrame:
    """Every ten-point band, open to the right but for the last, and the rows without a score."""
    band = F.when(F.col("consensus_score").isNull(), F.lit("NULL")).otherwise(
        F.element_at(
            F.array(*[F.lit(b) for b in BANDS]), (F.least(F.floor(F.col("consensus_score") / 10), F.lit(9)) + 1).cast("int")
        )
    )
    counts = release.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))
    spine = release.sparkSession.range(1).select(F.explode(F.array(*[F.lit(b) for b in (*BANDS, "NULL")])).alias("band"))
    rows = spine.join(counts, "band", "left").select("band", F.coalesce("n", F.lit(0).cast("long")).alias("domains"))
    scored = F.sum(F.when(F.col("band") != "NULL", F.col("domains"))).over(Window.partitionBy())
    return rows.withColumns({
        "scored_share": F.when(F.col("band") != "NULL", F.round(F.try_divide(F.col("domains").cast("double"), scored), 6)),
        "share": F.round(F.try_divide(F.col("domains").cast("double"), _total()), 6),
    })


def source_presence(release: DataFrame) -> DataFrame:
    """(kind, name, domains, scored): each source, each pair of sources, and the combinations as they stand."""
    pairs = [(a, b) for i, a in enumerate(SOURCES) for b in SOURCES[i + 1 :]]
    one = F.count_if
    counts = release.agg(
        *[one(has_source(s)).alias(f"source:{s}") for s in SOURCES],
        *[one(has_source(s) & is_scored()).alias(f"scored:source:{s}") for s in SOURCES],
        *[one(has_source(a) & has_source(b)).alias(f"pair:{a}+{b}") for a, b in pairs],
        *[one(has_source(a) & has_source(b) & is_scored()).alias(f"scored:pair:{a}+{b}") for a, b in pairs],
    )
    names = [f"source:{s}" for s in SOURCES] + [f"pair:{a}+{b}" for a, b in pairs]
    rows = F.array(*[
        F.struct(
            F.lit(n.split(":")[0]).alias("kind"), F.lit(n.split(":")[1]).alias("name"), F.col(f"`{n}`").alias("domains"),
            F.col(f"`scored:{n}`").alias("scored")
        ) for n in names
    ])
    combos = release.groupBy(F.coalesce("ranking_sources_present", F.lit("")).alias("name")).agg(
        F.count(F.lit(1)).alias("domains"), F.count("consensus_score").alias("scored")
    )
    return counts.select(F.inline(rows)).unionByName(combos.withColumn("kind", F.lit("combination")))


def threat_type_counts(release: DataFrame, top: int = 20) -> DataFrame:
    """The most frequent threat types of a ``|`` list; a top-k report."""
    rows = release.where("threat_types <> ''").select(F.explode(F.split("threat_types", r"\|")).alias("threat_type"))
    return rows.groupBy("threat_type").agg(
        F.count(F.lit(1)).alias("domains")
    ).orderBy(F.desc("domains"), "threat_type").limit(top)


def risk_distribution(release: DataFrame) -> DataFrame:
    groups = release.groupBy("risk_sources_count").agg(
        F.count(F.lit(1)).alias("domains"), F.round(F.avg("consensus_score"), 6).alias("mean_score"),
        F.count("consensus_score").alias("scored")
    )
    return groups.withColumn("share", F.round(F.col("domains") / _total(), 6))


def risk_by_tier(release: DataFrame) -> DataFrame:
    return release.groupBy("coverage_tier").agg(
        F.count(F.lit(1)).alias("domains"), F.count_if(F.col("risk_sources_count") > 0).alias("with_risk"),
        F.count_if("security_flags_observed").alias("flagged")
    ).withColumns({
        "risk_share": F.round(F.col("with_risk") / F.col("domains"), 6),
        "flagged_share": F.round(F.col("flagged") / F.col("domains"), 6)
    })


def _release_order() -> list[Column]:
    return [F.col("consensus_score").desc_nulls_last(), F.col("sources_count").desc(), F.col("registered_domain").asc()]


def top_flagged(release: DataFrame, top: int = 25) -> DataFrame:
    return release.where("security_flags_observed").orderBy(*_release_order()).limit(top).select(
        "registered_domain", F.round("consensus_score", 4).alias("consensus_score"), "coverage_tier", "sources_count",
        "risk_sources_count", "threat_types"
    )


def rightmost_labels(release: DataFrame, top: int = 25) -> DataFrame:
    groups = release.groupBy(F.substring_index("registered_domain", ".", -1).alias("label")).agg(
        F.count(F.lit(1)).alias("domains"), F.count("consensus_score").alias("scored"),
        F.count_if("security_flags_observed").alias("flagged")
    )
    return groups.withColumn("share", F.round(F.col("domains") / _total(), 6)).orderBy(F.desc("domains"), "label").limit(top)


def top_rows(release: DataFrame, n: int) -> DataFrame:
    return release.where(is_scored()).orderBy(*_release_order()).limit(n)


def count_deltas(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(metric, current, previous, delta) of public, scored, sparse, risky and flagged rows."""
    metrics = {
        "public_rows": F.count(F.lit(1)), "scored_rows": F.count("consensus_score"),
        "sparse_rows": F.count_if(F.col("coverage_tier") == "sparse"),
        "risk_observed_rows": F.count_if(F.col("risk_sources_count") > 0),
        "security_flagged_rows": F.count_if("security_flags_observed"),
    }
    def long(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(*[m.alias(k) for k, m in metrics.items()])
        return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias(name)) for k in metrics])))

    return long(current, "current").join(long(previous, "previous"), "metric").withColumn(
        "delta", F.col("current") - F.col("previous")
    )


def set_difference(current: DataFrame, previous: DataFrame) -> DataFrame:
    """One row: retained, new and removed domains, and how many of the last two are scored."""
    key = "registered_domain"
    kept = current.join(previous.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("retained"))
    new = current.join(previous.select(key), key, "left_anti").agg(
        F.count(F.lit(1)).alias("added"), F.count("consensus_score").alias("added_scored")
    )
    gone = previous.join(current.select(key), key, "left_anti").agg(
        F.count(F.lit(1)).alias("removed"), F.count("consensus_score").alias("removed_scored")
    )
    return kept.join(new, F.lit(True)).join(gone, F.lit(True))  # one row each


_COMPARED = ("consensus_score", "coverage_tier", "sources_count", "risk_sources_count")


def both(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Domains of both releases, with the compared columns of each."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("registered_domain", *[F.col(c).alias(f"{c}_{name}") for c in _COMPARED])

    return side(current, "current").join(side(previous, "previous"), "registered_domain")


def _moved(merged: DataFrame) -> DataFrame:
    return merged.where("consensus_score_current is not null and consensus_score_previous is not null").withColumn(
        "score_delta", F.col("consensus_score_current") - F.col("consensus_score_previous")
    )


def score_drift(merged: DataFrame) -> DataFrame:
    """One row over the domains that both releases score."""
    rows = _moved(merged).withColumn("size", F.abs("score_delta"))
    return rows.agg(
        F.count(F.lit(1)).alias("both_scored"), F.round(F.avg("score_delta"), 6).alias("mean_delta"),
        F.round(F.percentile("score_delta", 0.5), 6).alias("median_delta"),
        F.round(F.avg("size"), 6).alias("mean_abs_delta"), F.round(F.percentile("size", 0.95), 6).alias("p95_abs_delta"),
        F.round(F.percentile("size", 0.99), 6).alias("p99_abs_delta"),
        F.round(F.max("size"), 6).alias("max_abs_delta"),
    )


def score_movers(merged: DataFrame, top: int = 20) -> DataFrame:
    """The domains that rose and fell most; ties by domain."""
    rows = _moved(merged).select(
        "registered_domain", "score_delta", "consensus_score_current", "consensus_score_previous", "coverage_tier_current",
        "coverage_tier_previous"
    )
    up = rows.orderBy(F.desc("score_delta"), "registered_domain").limit(top).withColumn("direction", F.lit("up"))
    down = rows.orderBy("score_delta", "registered_domain").limit(top).withColumn("direction", F.lit("down"))
    return up.unionByName(down)


def transitions(merged: DataFrame, column: str = "coverage_tier", values: tuple = TIERS) -> DataFrame:
    """Full matrix of counts from each earlier value to each later one."""
    kind = merged.schema[f"{column}_previous"].dataType
    counts = merged.groupBy(F.col(f"{column}_previous").alias("previous")).pivot(f"{column}_current", list(values)).count()
    spine = merged.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v).cast(kind) for v in values])).alias("previous"))
    return spine.join(counts, "previous", "left").select(
        "previous", *[F.coalesce(f"`{v}`", F.lit(0).cast("long")).alias(f"to_{v}") for v in values]
    )


def topn_retention(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(n, retained, retention) of the top sets: one ranked prefix of each release serves every n."""
    def ranked(df: DataFrame, name: str) -> DataFrame:
        order = Window.orderBy(*_release_order())
        return top_rows(df, max(TOP_N)).withColumn(name, F.row_number().over(order)).select("registered_domain", name)  # TOP_N rows at most

    both_tops = ranked(current, "k").join(ranked(previous, "k0"), "registered_domain").agg(
        *[F.count_if(F.greatest("k", "k0") <= n).alias(str(n)) for n in TOP_N]
    )
    rows = both_tops.select(
        F.inline(F.array(*[F.struct(F.lit(n).cast("long").alias("n"), F.col(f"`{n}`").alias("retained")) for n in TOP_N]))
    )
    return rows.withColumn("retention", F.col("retained") / F.col("n"))


def top_entrants(current: DataFrame, previous: DataFrame, n: int = 100, show: int = 20) -> DataFrame:
    new = top_rows(current, n).join(top_rows(previous, n).select("registered_domain"), "registered_domain", "left_anti")
    return new.orderBy(*_release_order()).limit(show).select(
        "registered_domain", F.round("consensus_score", 4).alias("consensus_score"), "coverage_tier", "sources_count",
        "ranking_sources_present"
    )


def source_combinations(release: DataFrame, show: int = 20) -> DataFrame:
    """The commonest combinations of sources with their scores and flags."""
    s = "consensus_score"
    rows = release.groupBy("ranking_sources_present").agg(
        F.count(F.lit(1)).alias("rows"), F.count(s).alias("scored_rows"), F.round(F.avg(s), 4).alias("score_mean"),
        F.count_if("security_flags_observed").alias("security_flagged_rows")
    )
    return rows.orderBy(F.desc("rows"), "ranking_sources_present").limit(show)


def summary(release: DataFrame) -> DataFrame:
    """One row of counts and scores of a release."""
    s = "consensus_score"
    return release.agg(
        F.count(F.lit(1)).alias("rows"), F.count(s).alias("scored_rows"),
        F.count_if(F.col("risk_sources_count") > 0).alias("risk_observed_rows"),
        F.count_if("security_flags_observed").alias("security_flagged_rows"), F.round(F.avg(s), 6).alias("score_mean"),
        F.round(F.percentile(s, 0.5), 6).alias("score_median"),
        F.round(F.percentile(s, 0.95), 6).alias("score_p95"),
        *[F.count_if(F.col("coverage_tier") == t).alias(f"{t}_rows") for t in TIERS],
        *[F.count_if(has_source(x)).alias(f"{x}_public_rows") for x in SOURCES],
    )


def stability(history: list[tuple[str, DataFrame]]) -> DataFrame:
    """A row per adjacent pair of releases, oldest first: sets, drift and retention of the top 100 and 1,000."""
    rows = []
    for (earlier, previous), (later, current) in zip(history[:-1], history[1:], strict=True):
        tops = topn_retention(current, previous).where(F.col("n") <= 1000).groupBy().pivot("n", [100, 1000]).agg(F.max("retention"))
        tops = tops.select(F.col("100").alias("top_100_retention"), F.col("1000").alias("top_1000_retention"))
        row = set_difference(current, previous).join(score_drift(both(current, previous)), F.lit(True)).join(tops, F.lit(True))
        rows.append(row.select(F.lit(earlier).alias("previous_release"), F.lit(later).alias("current_release"), "*"))
    return reduce(DataFrame.unionByName, rows)


def readiness(pairs: DataFrame, schemas: int = 1, non_fresh: int = 0) -> DataFrame:
    """One row: green, yellow or red."""
    row = pairs.agg(
        F.min("top_100_retention").alias("a"), F.min("top_1000_retention").alias("b"),
        F.percentile("p95_abs_delta", 0.5).alias("drift")
    )
    least = F.least("a", "b")
    state = (
        F.when((least < 0.90) | (F.col("drift") > 20), "red")
        .when((least < 0.95) | (F.col("drift") > 10) | F.lit(schemas > 1) | F.lit(non_fresh > 0), "yellow").otherwise("green")
    )
    return row.select(
        F.col("a").alias("top_100_min"), F.col("b").alias("top_1000_min"), F.round("drift", 6).alias("p95_drift_median"),
        state.alias("readiness")
    )
