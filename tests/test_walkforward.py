"""Walk-forward evaluations against a NumPy statement of their definition."""

import math
from collections import defaultdict

import numpy as np
import pytest

from quorumrank.operators import ranking
from quorumrank.operators import temporal as T
from quorumrank.operators import walkforward as W

DOMAINS, SLOTS, FIRST = 140, 12, 7


@pytest.fixture(scope="module")
def world():
    rng = np.random.default_rng(12)
    score = np.clip(rng.uniform(5, 95, (DOMAINS, 1)) + rng.normal(0, 2.5, (DOMAINS, SLOTS)).cumsum(axis=1), 0, 100).round(3)
    score[rng.random(score.shape) < 0.08] = np.nan
    mask = np.where(rng.random(score.shape) < 0.1, 15, 31)
    return score, np.where(mask == 15, 4, 5), mask


def window(y, size):
    y = y[-size:]
    seen = np.isfinite(y)
    x, v, n = np.arange(size)[seen].astype(float), y[seen], int(seen.sum())
    out = {
        "n": n, "ok": n >= max(3, math.ceil(0.75 * size)), "slope": 0.0, "res": 0.0, "conf": 0.0, "ewma": 0.0, "mean": 0.0,
        "fit": 0.0
    }
    if n:
        weight = 0.5 ** ((size - 1 - x) / (2.0 if size == 4 else size / 2))
        out |= {"ewma": (weight * v).sum() / weight.sum(), "mean": v.mean(), "fit": v.mean()}
    if n > 1:
        slope, base = np.polyfit(x, v, 1)
        res = math.sqrt(max(((v - base - slope * x) ** 2).sum(), 0) / (n - 2)) if n > 2 else 0.0
        clipped = min(3.0, max(-3.0, slope))
        conf = math.copysign(max(abs(clipped) - 1.5 * res / math.sqrt(((x - x.mean()) ** 2).sum()), 0), clipped)
        out |= {"slope": slope, "clip": clipped, "res": res, "conf": conf, "fit": base + slope * (size - 1)}
    return out


def banded(world, last):
    score, count, _ = world
    live = [i for i in range(DOMAINS) if np.isfinite(score[i, last])]
    order = sorted(live, key=lambda i: (-score[i, last], -count[i, last], f"d{i:03d}"))
    return {i: sum(k + 1 > limit for limit in (100, 1_000, 10_000, 100_000)) for k, i in enumerate(order)}


def scaled(parts, band):
    """Of each domain: cap * tanh(conf / scale of its band), and the band's noise scale."""
    out = {}
    for b in set(band.values()):
        able = [parts[i] for i in band if band[i] == b and parts[i]["ok"]]
        conf = np.array([p["conf"] for p in able])
        scale = max(1.4826 * np.median(np.abs(conf - np.median(conf))), 0.05)
        noise = max(np.median([p["res"] for p in able]), 0.05)
        cap = (0.01, 0.03, 0.10, 0.30, 0.75)[b]
        out |= {
            i: (cap * math.tanh(parts[i]["conf"] / scale) if parts[i]["ok"] else 0.0, noise, cap) for i in band if band[i] == b
        }
    return out


def meta(world, last):
    score, out = world[0], defaultdict(dict)
    band = banded(world, last)
    for i in band:
        out["raw"][i] = score[i, last]
    for size in (4, 8):
        parts = {i: window(score[i, : last + 1], size) for i in band}
        adjust = scaled(parts, band)
        for i, p in parts.items():
            if p["ok"]:
                a, e, f, r = adjust[i][0], p["ewma"], p["fit"], p["res"]
                values = {
                    "sma": p["mean"], "ewma": e, "trend": f, "trend-resid-0.5": f - 0.5 * r, "trend-resid-1.0": f - r,
                    "trend-momentum-0.5": f + 0.5 * p["clip"],
                    "trend-resid-0.5-momentum-0.5": f - 0.5 * r + 0.5 * p["clip"], "ewma-confirmed-0.1": e + 0.1 * p["conf"],
                    "ewma-confirmed-0.25": e + 0.25 * p["conf"],
                    "ewma-scale-aware": e + a, "ewma-scale-aware-asymmetric": e + (1.5 * a if a < 0 else a),
                }
                for name, v in values.items():
                    out[f"{name}-w{size}"][i] = v
    return out, {}


def index(world, last):
    score, count, mask = world
    band, out, shocks = banded(world, last), defaultdict(dict), {}
    trend = {i: window(score[i, : last + 1], 8) for i in band}
    adjust = scaled(trend, band)
    for i in band:
        level, before, t = window(score[i, : last + 1], 4), window(score[i, :last], 4), trend[i]
        s, m, c = score[i, last - 7 : last + 1], mask[i, last - 7 : last + 1], count[i, last - 7 : last + 1]
        seen = np.isfinite(s)
        pairs = seen[:-1] & seen[1:]
        steady = (pairs & (m[:-1] == m[1:])).sum() / pairs.sum() if pairs.any() else 0.0
        a, noise_scale, cap = adjust[i]
        noise = 1 / (1 + t["res"] / noise_scale) if t["ok"] else 0.0
        sure = (seen.sum() / 8 * (c[seen].sum() / (seen.sum() * 5)) * steady * noise) ** 0.25
        shocks[i] = shock = bool(seen[-2] and m[-2] != m[-1])
        base = level["ewma"] if level["ok"] else score[i, last]
        held = before["ewma"] if shock and before["ok"] else base
        gated = 0.0 if shock else sure * a

        def damped(share):
            return before["ewma"] + share * (base - before["ewma"]) if shock and before["ok"] else base

        values = {
            "raw": score[i, last], "level": base, "trend-gated": base + sure * a, "shock-gated": held + gated,
            "shock-damped-0.25": damped(0.25) + gated, "shock-damped-0.5": damped(0.5) + gated,
            "conservative-0.5": held + gated - 0.5 * cap * (1 - sure), "conservative-1.0": held + gated - cap * (1 - sure),
        }
        for name, v in values.items():
            out[name][i] = v
    return out, shocks


def evaluated(world, candidates):
    found = {last: candidates(world, last) for last in range(FIRST, SLOTS)}
    top = {
        (name, last): [i for i, _ in sorted(v.items(), key=lambda x: (-x[1], x[0]))]
        for last, (values, _) in found.items() for name, v in values.items()
    }
    out = {}
    for name in {n for n, _ in top}:
        def share(a, b, n):
            return len(set(top.get(a, [])[:n]) & set(top.get(b, [])[:n])) / n

        row = {}
        for n in W.TOP_N:
            row[f"retention_{n}"] = np.median([share((name, t), (name, t - 1), n) for t in range(FIRST + 1, SLOTS)])
            row[f"forecast_{n}"] = np.median([share((name, t), ("raw", t + 1), n) for t in range(FIRST, SLOTS - 1)])
            row[f"latest_{n}"] = share((name, SLOTS - 1), ("raw", SLOTS - 1), n)
        drift = defaultdict(list)
        for t in range(FIRST + 1, SLOTS):
            now, past, shocks = found[t][0][name], found[t - 1][0][name], found[t][1]
            moved = {i: abs(v - past[i]) for i, v in now.items() if i in past}
            drift["drift_p95"].append(np.quantile(list(moved.values()), 0.95))
            if shocks and (shocked := [x for i, x in moved.items() if shocks[i]]):
                drift["shock_median"].append(np.quantile(shocked, 0.5))
                drift["shock_p95"].append(np.quantile(shocked, 0.95))
        row |= {k: np.median(v) for k, v in drift.items()}
        out[name] = row | {"latest_eligible": len(found[SLOTS - 1][0][name])}
    return out


@pytest.mark.parametrize("one_task_rows", [0, 1_000_000])
@pytest.mark.parametrize("kind", ["meta", "index"])
def test_evaluation_equals_definition(spark, world, monkeypatch, kind, one_task_rows):
    monkeypatch.setattr(ranking, "ONE_TASK_ROWS", one_task_rows)
    score, count, mask = world
    rows = [
        (f"d{i:03d}", w, None if np.isnan(score[i, w]) else float(score[i, w]), int(count[i, w]), int(mask[i, w]), 0)
        for i in range(DOMAINS) for w in range(SLOTS)
    ]
    rows = [r for r in rows if r[2] is not None]
    hist = T.history(
        spark.createDataFrame(rows, "registered_domain string, slot int, score double, sources int, mask int, risks int"), SLOTS,
        latest_only=False
    )
    values = (W.meta_candidates if kind == "meta" else W.index_candidates)(hist, SLOTS)
    got = {r["candidate"]: r.asDict() for r in W.evaluate(values, FIRST, SLOTS - 1, shocks=kind == "index").collect()}
    want = evaluated(world, meta if kind == "meta" else index)
    assert set(got) == set(want)
    for name, row in want.items():
        for k, v in row.items():
            assert got[name][k] == pytest.approx(v, abs=2e-6), (name, k)
