"""The temporal index: level, confirmed trend, confidence and shock damping over a grid of weekly slots.

A history has one row per domain and, for each slot i, ``s<i>`` (score), ``c<i>`` (number of sources), ``m<i>``
(bitmask of sources) and ``r<i>`` (risk sources), null where a release doesn't have the domain. All row-wise maths is
built as stages of SQL expressions over these columns, so it stays in generated code; only the medians of the five
rank bands aggregate, and come back by a broadcast of five rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import with_ordinal_rank

HISTORY_WINDOW, LEVEL_WINDOW = 8, 4
MIN_HISTORY_SHARE = 0.75
SLOPE_CLIP, KAPPA, SHOCK_DAMPING, NOISE_FLOOR = 3.0, 1.5, 0.5, 0.05
BAND_LIMITS = (100, 1_000, 10_000, 100_000)
BAND_CAPS = (0.01, 0.03, 0.10, 0.30, 0.75)
BAND_LABELS = ("1-100", "101-1000", "1001-10000", "10001-100000", "100001+")
MAX_SOURCES = 5
SOURCE_BITS = {"tranco": 1, "majestic": 2, "radar": 4, "crux": 8, "opr": 16}
METHODOLOGY = "index-v1"

#: Columns that a stage adds: name to SQL expression over the columns before it.
Stage = dict[str, str]


def source_mask(column: str) -> F.Column:
    """Bitmask of a comma list of sources; unknown names count nothing, repeated ones once, null and empty give 0."""
    names = F.transform(F.split(F.coalesce(F.col(column), F.lit("")), ","), F.trim)
    return sum((F.when(F.array_contains(names, s), bit).otherwise(0) for s, bit in SOURCE_BITS.items()), F.lit(0))


def history(releases: DataFrame, slots: int, latest_only: bool = True) -> DataFrame:
    """Wide history of a long table (registered_domain, slot, score, sources, mask, risks); unknown slots are null.

    ``latest_only`` keeps the domains that have a score in the last slot.
    """
    wide = releases.groupBy("registered_domain").pivot("slot", list(range(slots))).agg(
        F.max("score").alias("s"), F.max("sources").alias("c"), F.max("mask").alias("m"), F.max("risks").alias("r")
    )
    names = [(f"{i}_{k}", f"{k}{i}") for i in range(slots) for k in "scmr"]
    wide = wide.select("registered_domain", *[F.col(f"`{a}`").alias(b) for a, b in names])
    return wide.where(F.col(f"s{slots - 1}").isNotNull()) if latest_only else wide


def _plus(terms: Iterable[str]) -> str:
    return "(" + " + ".join(terms) + ")"


def needed_observations(window: int) -> int:
    return max(3, math.ceil(window * MIN_HISTORY_SHARE))


def half_life(window: int) -> float:
    return 2.0 if window == LEVEL_WINDOW else window / 2


def rolling(prefix: str, last: int, window: int) -> list[Stage]:
    """Least squares line, residual deviation and exponentially weighted level over ``window`` slots up to ``last``."""
    slots = list(range(last - window + 1, last + 1))
    x = {i: float(k) for k, i in enumerate(slots)}
    w = {i: 0.5 ** ((window - 1 - x[i]) / half_life(window)) for i in slots}
    seen = {i: f"(case when s{i} is not null then 1.0E0 else 0.0E0 end)" for i in slots}
    y = {i: f"coalesce(s{i}, 0.0E0)" for i in slots}
    p = prefix
    sums = {
        f"{p}n": _plus(seen.values()), f"{p}sx": _plus(f"{seen[i]} * {x[i]}E0" for i in slots),
        f"{p}sxx": _plus(f"{seen[i]} * {x[i] * x[i]}E0" for i in slots),
        f"{p}sy": _plus(y.values()), f"{p}sxy": _plus(f"{y[i]} * {x[i]}E0" for i in slots),
        f"{p}syy": _plus(f"{y[i]} * {y[i]}" for i in slots),
        f"{p}wy": _plus(f"{y[i]} * {w[i]!r}E0" for i in slots), f"{p}w": _plus(f"{seen[i]} * {w[i]!r}E0" for i in slots),
    }
    det = f"({p}n * {p}sxx - {p}sx * {p}sx)"
    line = {f"{p}slope": f"case when {det} > 0 then ({p}n * {p}sxy - {p}sx * {p}sy) / {det} else 0.0E0 end"}
    base = {f"{p}icept": f"case when {p}n > 0 then ({p}sy - {p}slope * {p}sx) / {p}n else 0.0E0 end"}
    a, b = f"{p}icept", f"{p}slope"
    error = f"({p}syy - 2 * {a} * {p}sy - 2 * {b} * {p}sxy + {a} * {a} * {p}n + 2 * {a} * {b} * {p}sx + {b} * {b} * {p}sxx)"
    spread = {
        f"{p}res": f"case when {p}n > 2 then sqrt(greatest({error}, 0.0E0) / ({p}n - 2)) else 0.0E0 end",
        f"{p}cxx": f"case when {p}n > 0 then {p}sxx - {p}sx * {p}sx / {p}n else 0.0E0 end",
        f"{p}ewma": f"case when {p}w > 0 then {p}wy / {p}w else 0.0E0 end",
        f"{p}mean": f"case when {p}n > 0 then {p}sy / {p}n else 0.0E0 end",
        f"{p}fit": f"{a} + {b} * {window - 1}.0E0", f"{p}ok": f"({p}n >= {needed_observations(window)})",
        f"{p}clip": f"greatest(-{SLOPE_CLIP}E0, least({SLOPE_CLIP}E0, {b}))",
    }
    confirmed = {  # without a spread of x the standard error is infinite and nothing is confirmed
        f"{p}conf": f"case when {p}cxx > 0 then sign({p}clip) * greatest(abs({p}clip) - {KAPPA}E0 * {p}res / sqrt({p}cxx), 0.0E0) else 0.0E0 end"
    }
    return [sums, line, base, spread, confirmed]


def band_of(rank: str) -> str:
    return "case " + " ".join(
        f"when {rank} <= {limit} then {k}" for k, limit in enumerate(BAND_LIMITS)
    ) + f" else {len(BAND_LIMITS)} end"


def cap_of(band: str) -> str:
    return "case " + " ".join(f"when {band} = {k} then {cap}E0" for k, cap in enumerate(BAND_CAPS)) + " end"


def adjusted(prefix: str) -> Stage:
    """Trend adjustment of a window by the scale of its band; 0 where the window isn't eligible."""
    return {f"{prefix}adj": f"case when {prefix}ok then cap * tanh({prefix}conf / {prefix}scale) else 0.0E0 end"}


def quality(last: int, prefix: str = "t_", window: int = HISTORY_WINDOW) -> list[Stage]:
    """History, coverage, composition and noise shares and their geometric mean; whether the last source set differs."""
    slots = list(range(last - window + 1, last + 1))
    seen = [f"(case when s{i} is not null then 1.0E0 else 0.0E0 end)" for i in slots]
    counted = [f"(case when s{i} is not null then coalesce(c{i}, 0) else 0 end)" for i in slots]
    pairs = [f"(s{i} is not null and s{i + 1} is not null)" for i in slots[:-1]]
    steady = [
        f"(case when s{i} is not null and s{i + 1} is not null and coalesce(m{i}, 0) = coalesce(m{i + 1}, 0) then 1.0E0 else 0.0E0 end)"
        for i in slots[:-1]
    ]
    return [
        {
            "q_n": _plus(seen), "q_sources": _plus(counted),
            "q_pairs": _plus(f"(case when {p} then 1.0E0 else 0.0E0 end)" for p in pairs), "q_steady": _plus(steady),
            "noise": f"case when {prefix}ok then 1.0E0 / (1.0E0 + {prefix}res / noise_scale) else 0.0E0 end",
            "shock": f"(s{last - 1} is not null and coalesce(m{last - 1}, 0) <> coalesce(m{last}, 0))",
        },
        {
            "history_share": f"q_n / {window}.0E0",
            "coverage_share": f"case when q_n > 0 then q_sources / (q_n * {MAX_SOURCES}.0E0) else 0.0E0 end",
            "steady_share": "case when q_pairs > 0 then q_steady / q_pairs else 0.0E0 end",
        },
        {"confidence": "power(history_share * coverage_share * steady_share * noise, 0.25E0)"},
    ]


def index_stages(last: int) -> list[Stage]:
    """Trend label, damped score and risk state of the published index."""
    risks = ", ".join(f"coalesce(r{i}, 0)" for i in range(last - HISTORY_WINDOW + 1, last + 1))
    now = f"coalesce(r{last}, 0)"
    return [
        {
            "material": "(abs(t_adj) >= 0.1E0 * cap)",
            "damped": f"case when shock and p_ok and l_ok then p_ewma + {SHOCK_DAMPING}E0 * (l_ewma - p_ewma) else l_ewma end",
            "risk_ever": f"greatest({risks})",
        },
        {
            "trend": "case when t_ok and material and t_conf > 0 then 'rising' when t_ok and material and t_conf < 0 then 'falling' when t_ok and noise >= 0.5E0 then 'stable' else 'uncertain' end",
            "candidate": "greatest(0.0E0, least(100.0E0, damped))",
            "risk_state": f"case when {now} >= 2 then 'multi-source-observed' when {now} = 1 then 'single-source-observed' when risk_ever > 0 then 'recent-history-only' else 'none-observed' end",
        },
    ]


#: Columns of the published index: name to expression.
INDEX_COLUMNS: Stage = {
    "registered_domain": "registered_domain", "reputation_score": "case when l_ok then l_ewma end",
    "reputation_confidence": "case when t_ok then confidence end",
    "reputation_trend": "trend", "trend_strength": "case when t_ok then t_conf end",
    "history_observations": "cast(q_n as bigint)",
    "structural_shock": "case when shock then 'true' else 'false' end", "score_candidate": "case when l_ok then candidate end",
    "observed_risk": "risk_state",
}


def apply(df: DataFrame, stages: list[Stage]) -> DataFrame:
    for stage in stages:
        df = df.withColumns({name: F.expr(text) for name, text in stage.items()})
    return df


def with_bands(df: DataFrame, last: int, groups: Sequence[str] = ()) -> DataFrame:
    """Adds rank by the last slot's score (ties: more sources, then domain) in each group, band and cap."""
    ties = [F.col(f"c{last}").desc_nulls_last(), F.col("registered_domain").asc()]
    ranked = with_ordinal_rank(df, f"s{last}", ties, groups=groups)
    return ranked.withColumn("band", F.expr(band_of("rank"))).withColumn("cap", F.expr(cap_of("band")))


def with_band_scales(df: DataFrame, prefix: str, noise: bool = True, groups: Sequence[str] = ()) -> DataFrame:
    """Adds ``<prefix>scale`` (1.4826 times the median absolute deviation) and, if asked, ``noise_scale``, by band."""
    rows, key = df.where(F.col(f"{prefix}ok")), [*groups, "band"]
    center, spread = F.percentile(f"{prefix}conf", 0.5), F.percentile(f"{prefix}res", 0.5)
    centers = rows.groupBy(*key).agg(center.alias("_center"), F.greatest(spread, F.lit(NOISE_FLOOR)).alias("noise_scale"))
    away = F.percentile(F.abs(F.col(f"{prefix}conf") - F.col("_center")), 0.5)
    around = rows.join(F.broadcast(centers), key).groupBy(*key).agg(
        F.greatest(1.4826 * away, F.lit(NOISE_FLOOR)).alias(f"{prefix}scale"), F.max("noise_scale").alias("noise_scale"),
    )
    return df.join(F.broadcast(around if noise else around.drop("noise_scale")), key, "left")  # a row per band of a group


def components(hist: DataFrame, slots: int = HISTORY_WINDOW) -> DataFrame:
    """Every working column of the index for the last of ``slots`` slots."""
    last = slots - 1
    df = apply(
        with_bands(hist, last),
        [*rolling("l_", last, LEVEL_WINDOW), *rolling("p_", last - 1, LEVEL_WINDOW), *rolling("t_", last, HISTORY_WINDOW)]
    )
    return apply(with_band_scales(df, "t_"), [adjusted("t_"), *quality(last), *index_stages(last)])


def temporal_index(hist: DataFrame, snapshot_date: F.Column, slots: int = HISTORY_WINDOW) -> DataFrame:
    """The published index in its order: candidate, level, domain."""
    out = components(hist, slots).select(*[F.expr(text).alias(name) for name, text in INDEX_COLUMNS.items()])
    out = out.withColumns({"snapshot_date": snapshot_date, "index_methodology_version": F.lit(METHODOLOGY)})
    return out.orderBy(
        F.col("score_candidate").desc_nulls_last(), F.col("reputation_score").desc_nulls_last(), "registered_domain"
    )


def index_statistics(index: DataFrame) -> DataFrame:
    """One row: counts, and quantiles of candidate and confidence."""
    quantiles = [
        F.percentile(c, q).alias(f"{k}_p{int(q * 100):02d}")
        for c,
        k in (("score_candidate", "candidate"), ("reputation_confidence", "confidence")) for q in (0.05, 0.25, 0.5, 0.75, 0.95)
    ]
    return index.agg(
        F.count(F.lit(1)).alias("row_count"), F.count("score_candidate").alias("eligible_score_count"),
        F.count_if(F.col("history_observations") == HISTORY_WINDOW).alias("full_history_count"),
        F.count_if(F.col("structural_shock") == "true").alias("structural_shock_count"), *quantiles,
    )


def band_summary(parts: DataFrame) -> DataFrame:
    """A row per rank band: domains, eligible ones, scales, medians and trend labels."""
    label = F.element_at(F.array(*[F.lit(x) for x in BAND_LABELS]), F.col("band") + 1)
    return parts.groupBy("band").agg(
        F.count(F.lit(1)).alias("domains"), F.count_if("t_ok").alias("eligible"), F.max("noise_scale").alias("noise_scale"),
        F.percentile(F.when(F.col("t_ok"), F.col("confidence")), 0.5).alias("median_confidence"),
        *[F.count_if(F.col("trend") == t).alias(t) for t in ("rising", "falling", "stable", "uncertain")],
        F.count_if("shock").alias("shocks"),
    ).withColumn("rank_band", label)
