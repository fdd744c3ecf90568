"""Walk-forward evaluation of index candidates: each slot's candidates against the past and the next slot's ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import frozen
from . import temporal as T
from .ranking import top_rows

TOP_N = (100, 1_000, 10_000, 100_000)

#: Candidates of one window, with the window's column prefix for ``{p}``.
META_CANDIDATES: dict[str, str] = {
    "sma": "{p}mean", "ewma": "{p}ewma", "trend": "{p}fit", "trend-resid-0.5": "{p}fit - 0.5E0 * {p}res",
    "trend-resid-1.0": "{p}fit - {p}res",
    "trend-momentum-0.5": "{p}fit + 0.5E0 * {p}clip", "trend-resid-0.5-momentum-0.5": "{p}fit - 0.5E0 * {p}res + 0.5E0 * {p}clip",
    "ewma-confirmed-0.1": "{p}ewma + 0.1E0 * {p}conf", "ewma-confirmed-0.25": "{p}ewma + 0.25E0 * {p}conf",
    "ewma-scale-aware": "{p}ewma + {p}adj",
    "ewma-scale-aware-asymmetric": "{p}ewma + case when {p}adj < 0 then 1.5E0 * {p}adj else {p}adj end",
}
_HELD = "case when shock and p_ok then p_ewma else base end"
_GATED = "case when shock then 0.0E0 else confidence * t_adj end"


def _damped(share: float) -> str:
    return f"case when shock and p_ok then p_ewma + {share}E0 * (base - p_ewma) else base end"


#: Candidates of the index itself; ``base`` is the level, or the raw score where the level isn't eligible.
INDEX_CANDIDATES: dict[str, str] = {
    "level": "base", "trend-gated": "base + confidence * t_adj", "shock-gated": f"{_HELD} + {_GATED}",
    "shock-damped-0.25": f"{_damped(0.25)} + {_GATED}",
    "shock-damped-0.5": f"{_damped(0.5)} + {_GATED}", "conservative-0.5": f"{_HELD} + {_GATED} - 0.5E0 * cap * (1 - confidence)",
    "conservative-1.0": f"{_HELD} + {_GATED} - cap * (1 - confidence)",
}


def rolled(hist: DataFrame, slots: int, window: int = T.HISTORY_WINDOW) -> DataFrame:
    """A row for each domain and slot that ends a whole window and has a score, with the window's columns as s0, s1..."""
    ends = [
        F.struct(
            F.lit(last).alias("slot"),
            *[F.col(f"{k}{last - window + 1 + i}").alias(f"{k}{i}") for i in range(window) for k in "scmr"]
        )
        for last in range(window - 1, slots)
    ]
    return hist.select("registered_domain", F.inline(F.array(*ends))).where(f"s{window - 1} is not null")


def _long(df: DataFrame, values: dict[str, str], keep: str = "false") -> DataFrame:
    """(slot, registered_domain, shock, candidate, value) of the rows that have a value."""
    rows = F.array(*[F.struct(F.lit(c).alias("candidate"), F.expr(v).cast("double").alias("value")) for c, v in values.items()])
    return df.select("slot", "registered_domain", F.expr(keep).alias("shock"), F.inline(rows)).where("value is not null")


def meta_candidates(hist: DataFrame, slots: int, windows: tuple[int, ...] = (4, 8)) -> DataFrame:
    """Raw scores and every candidate of every window, from the first slot with a whole window. All slots are one plan."""
    last = max(windows) - 1
    df = T.with_bands(frozen(rolled(hist, slots, last + 1)), last, ["slot"])
    values = {"raw": f"s{last}"}
    for w in windows:
        p = f"w{w}_"
        df = T.apply(T.with_band_scales(T.apply(df, T.rolling(p, last, w)), p, noise=False, groups=["slot"]), [T.adjusted(p)])
        values |= {f"{c}-w{w}": f"case when {p}ok then {v.format(p=p)} end" for c, v in META_CANDIDATES.items()}
    return _long(df, values)


def index_candidates(hist: DataFrame, slots: int) -> DataFrame:
    """Raw scores and the index's candidates, with the slot's structural shocks. All slots are one plan."""
    last = T.HISTORY_WINDOW - 1
    df = T.with_bands(frozen(rolled(hist, slots)), last, ["slot"])
    df = T.apply(df, [*T.rolling("l_", last, 4), *T.rolling("p_", last - 1, 4), *T.rolling("t_", last, 8)])
    level = {"base": f"case when l_ok then l_ewma else s{last} end"}
    df = T.apply(T.with_band_scales(df, "t_", groups=["slot"]), [T.adjusted("t_"), *T.quality(last), level])
    return _long(df, {"raw": f"s{last}"} | INDEX_CANDIDATES, keep="shock")


def evaluate(values: DataFrame, first: int, last: int, shocks: bool = False) -> DataFrame:
    """A row per candidate: medians over the slots of retention, forecast and drift, and the last slot's agreement.

    Top sets are by falling value and then domain. All shares are of N, however few domains there are.
    """
    values = frozen(values)  # read many times below, and its plan is wide
    tops = top_rows(values, "value", [F.col("registered_domain").asc()], max(TOP_N), ["candidate", "slot"])
    tops = frozen(tops.select("candidate", "slot", "registered_domain", "k"))
    before = tops.select("candidate", (F.col("slot") + 1).alias("slot"), "registered_domain", F.col("k").alias("k0"))
    raw = tops.where("candidate = 'raw'").drop("candidate")

    def shares(joined: DataFrame, name: str) -> DataFrame:
        return joined.groupBy("candidate", "slot").agg(
            *[(F.count_if(F.greatest("k", "k0") <= n) / n).alias(f"{name}_{n}") for n in TOP_N]
        )

    grid = values.select("candidate").distinct().select(
        "candidate", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("slot")
    )
    kept = shares(tops.join(before, ["candidate", "slot", "registered_domain"]), "retention")
    ahead = shares(
        tops.join(
            raw.select((F.col("slot") - 1).alias("slot"), "registered_domain", F.col("k").alias("k0")),
            ["slot", "registered_domain"]
        ),
        "forecast"
    )
    same = shares(
        tops.join(raw.select("slot", "registered_domain", F.col("k").alias("k0")), ["slot", "registered_domain"]), "latest"
    ).where(F.col("slot") == last)
    past = values.select("candidate", (F.col("slot") + 1).alias("slot"), "registered_domain", F.col("value").alias("v0"))
    moved = values.join(past, ["candidate", "slot", "registered_domain"]).withColumn("moved", F.abs(F.col("value") - F.col("v0")))
    if shocks:  # a shock is one of the slot, whatever the candidate
        flags = values.where("candidate = 'raw' and shock").select("slot", "registered_domain", F.lit(True).alias("shocked"))
        moved = moved.join(flags, ["slot", "registered_domain"], "left")
    drift = moved.groupBy("candidate", "slot").agg(
        F.percentile("moved", 0.95).alias("drift_p95"),
        *([F.percentile(F.when(F.col("shocked"), F.col("moved")), q).alias(c) for q, c in ((0.5, "shock_median"), (0.95, "shock_p95"))] if shocks else []),
    )
    rows = grid.join(kept, ["candidate", "slot"], "left").join(
        ahead, ["candidate", "slot"], "left"
    ).join(drift, ["candidate", "slot"], "left")
    medians = [
        *[
            F.round(
                F.percentile(F.when(F.col("slot") > first, F.coalesce(f"retention_{n}", F.lit(0.0))), 0.5), 6
            ).alias(f"retention_{n}")
            for n in TOP_N
        ],
        *[
            F.round(
                F.percentile(F.when(F.col("slot") < last, F.coalesce(f"forecast_{n}", F.lit(0.0))), 0.5), 6
            ).alias(f"forecast_{n}")
            for n in TOP_N
        ],
        *[F.round(F.percentile(c, 0.5), 6).alias(c) for c in drift.columns[2:]],
    ]
    eligible = values.where(F.col("slot") == last).groupBy("candidate").agg(F.count(F.lit(1)).alias("latest_eligible"))
    return rows.groupBy("candidate").agg(*medians).join(
        same.drop("slot"), "candidate", "left"
    ).join(eligible, "candidate", "left")
