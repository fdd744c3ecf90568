"""The temporal index against a NumPy statement of its definition, on eight synthetic weeks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumrank.operators import temporal as T

DOMAINS, WEEKS = 120, 8


@pytest.fixture(scope="module")
def world():
    score = np.array([[55 + 0.25 * i + w * 0.2 * (i % 5 - 2) for w in range(WEEKS)] for i in range(DOMAINS)])
    count, mask = np.full((DOMAINS, WEEKS), 5), np.full((DOMAINS, WEEKS), 31)
    risk = np.zeros((DOMAINS, WEEKS), dtype=int)
    count[0, -1], mask[0, -1] = 4, 15  # a structural shock
    risk[1, -1], risk[2, -2] = 2, 1
    score[3, [2, 4]], score[4, :6], score[5, 6] = np.nan, np.nan, np.nan
    score[6:9, 3] += [4.0, -7.0, 2.5]
    return score, count, mask, risk


def rolling(y, window):
    y = y[-window:]
    seen = np.isfinite(y)
    x, v = np.arange(window)[seen], y[seen]
    n = len(v)
    w = 0.5 ** ((window - 1 - x) / (2.0 if window == 4 else window / 2))
    out = {
        "n": n, "ok": n >= max(3, math.ceil(0.75 * window)), "ewma": (w * v).sum() / w.sum() if n else 0.0, "slope": 0.0,
        "res": 0.0, "se": math.inf
    }
    if n >= 2:
        slope, icept = np.polyfit(x, v, 1)
        out["slope"] = slope
        spread = ((x - x.mean()) ** 2).sum()
        out["res"] = math.sqrt(max(((v - icept - slope * x) ** 2).sum(), 0) / (n - 2)) if n > 2 else 0.0
        out["se"] = out["res"] / math.sqrt(spread)
    return out


def expected(world):
    score, count, mask, risk = world
    rank = {
        i: k + 1
        for k, i in enumerate(sorted(range(DOMAINS), key=lambda i: (-score[i, -1], -count[i, -1], f"domain-{i:03d}.example")))
    }
    band = {i: sum(rank[i] > limit for limit in T.BAND_LIMITS) for i in rank}
    trend = {i: rolling(score[i], 8) for i in rank}
    def confirmed(t):
        b = min(3.0, max(-3.0, t["slope"]))
        return math.copysign(max(abs(b) - 1.5 * t["se"], 0), b) if math.isfinite(t["se"]) else 0.0
    conf = {i: confirmed(trend[i]) for i in rank}
    out = {}
    for b in set(band.values()):
        members = [i for i in rank if band[i] == b]
        able = [i for i in members if trend[i]["ok"]]
        c = np.array([conf[i] for i in able])
        scale = max(1.4826 * np.median(np.abs(c - np.median(c))), 0.05)
        noise_scale = max(np.median([trend[i]["res"] for i in able]), 0.05)
        for i in members:
            s, level, before, t = score[i], rolling(score[i], 4), rolling(score[i][:-1], 4), trend[i]
            seen = np.isfinite(s)
            pairs = seen[:-1] & seen[1:]
            steady = (pairs & (mask[i, :-1] == mask[i, 1:])).sum() / pairs.sum() if pairs.any() else 0
            noise = 1 / (1 + t["res"] / noise_scale) if t["ok"] else 0
            sure = (seen.sum() / 8 * (count[i][seen].sum() / (seen.sum() * 5)) * steady * noise) ** 0.25
            shock = bool(seen[-2] and mask[i, -2] != mask[i, -1])
            candidate = before["ewma"] + 0.5 * (level["ewma"] - before["ewma"]) if shock and before["ok"] and level["ok"] else level["ewma"]
            adjustment = T.BAND_CAPS[b] * math.tanh(conf[i] / scale) if t["ok"] else 0
            material = abs(adjustment) >= 0.1 * T.BAND_CAPS[b]
            label = "uncertain"
            if t["ok"]:
                label = "rising" if material and conf[i] > 0 else "falling" if material and conf[i] < 0 else "stable" if noise >= 0.5 else "uncertain"
            now = risk[i, -1]
            state = "multi-source-observed" if now >= 2 else "single-source-observed" if now == 1 else "recent-history-only" if risk[i].max() else "none-observed"
            out[f"domain-{i:03d}.example"] = (
                level["ewma"] if level["ok"] else None, sure if t["ok"] else None, label, conf[i] if t["ok"] else None,
                int(seen.sum()), str(shock).lower(), min(100, max(0, candidate)) if level["ok"] else None, state,
            )
    return out


def frame(spark, world):
    score, count, mask, risk = world
    rows = [
        (
            f"domain-{i:03d}.example", w, None if np.isnan(score[i, w]) else float(score[i, w]), int(count[i, w]),
            int(mask[i, w]), int(risk[i, w])
        ) for i in range(DOMAINS) for w in range(WEEKS)
    ]
    return spark.createDataFrame(rows, "registered_domain string, slot int, score double, sources int, mask int, risks int")


def test_index_equals_definition(spark, world):
    index = T.temporal_index(T.history(frame(spark, world), WEEKS), F.lit("2026-07-20").cast("date"))
    want, got = expected(world), {r.registered_domain: r for r in index.collect()}
    assert set(got) == set(want)
    for name, values in want.items():
        r = got[name]
        found = (
            r.reputation_score, r.reputation_confidence, r.reputation_trend, r.trend_strength, r.history_observations,
            r.structural_shock, r.score_candidate, r.observed_risk
        )
        for a, b in zip(found, values):
            assert a == pytest.approx(b, abs=1e-4) if isinstance(b, float) and a is not None else a == b, (name, found, values)
    order = [(-(x.score_candidate if x.score_candidate is not None else -1), x.registered_domain) for x in index.collect()]
    assert [o[0] for o in order] == sorted(o[0] for o in order)
    assert got["domain-000.example"].structural_shock == "true"


def test_missing_week_and_empty_history(spark, world):
    rows = frame(spark, world).where("slot <> 3")
    assert T.temporal_index(T.history(rows, WEEKS), F.current_date()).where("history_observations = 7").count() > 100
    assert T.temporal_index(T.history(rows.limit(0), WEEKS), F.current_date()).count() == 0


@pytest.mark.parametrize(
    "text, mask", [("tranco,opr", 17), ("majestic,radar,crux", 14), ("", 0), (None, 0), ("not-opr", 0), ("opr, opr", 16)]
)
def test_source_mask(spark, text, mask):
    assert spark.createDataFrame([(text,)], "x string").select(T.source_mask("x").alias("m")).first().m == mask
