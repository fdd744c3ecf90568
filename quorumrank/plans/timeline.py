"""Queries over weekly releases in time: the temporal index and its walk-forward evaluations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import temporal as T
from ..operators import walkforward as W
from ..session import table
from .catalog import query

INDEX_SLOTS, WALK_SLOTS = 8, 16
#: (first year, months of a slot, slots) of the two histories.
_GRIDS = {"index": (1998, 6, INDEX_SLOTS), "walk": (1998, 3, WALK_SLOTS)}


def releases(spark: SparkSession, d: str, grid: str) -> DataFrame:
    """Sales of a part in a stretch of months, as a release's row of a domain."""
    year, months, slots = _GRIDS[grid]
    slot = F.floor(((F.year("l_shipdate") - year) * 12 + F.month("l_shipdate") - 1) / months).cast("int")
    rows = table(spark, d, "lineitem").where(
        F.col("l_shipdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")
    ).withColumn("slot", slot).where(F.col("slot") < slots)
    flag = {f: F.max(F.when(F.col("l_returnflag") == f, b).otherwise(0)) for f, b in (("A", 1), ("N", 2), ("R", 4))}
    return rows.groupBy("l_partkey", "slot").agg(
        ((F.avg("l_quantity") - 1) / 49 * 100).alias("score"), (F.count_distinct("l_returnflag") + 2).alias("sources"),
        (flag["A"] + flag["N"] + flag["R"]).alias("mask"),
        F.least(F.lit(2).cast("long"), F.count_if(F.col("l_discount") >= 0.1)).alias("risks"),
    ).withColumn("registered_domain",
    F.concat(F.lit("d"), F.col("l_partkey").cast("string"), F.lit(".example.com"))).drop("l_partkey")


def _releases_sql(grid: str) -> str:
    year, months, slots = _GRIDS[grid]
    return f"""select 'd' || l_partkey || '.example.com' as registered_domain, slot, (avg(l_quantity) - 1) / 49 * 100 as score,
        count(distinct l_returnflag) + 2 as sources,
        bool_or(l_returnflag = 'A')::int + 2 * bool_or(l_returnflag = 'N')::int + 4 * bool_or(l_returnflag = 'R')::int as mask,
        least(2, count(*) filter (l_discount >= 0.1)) as risks
        from (select *, ((year(l_shipdate) - {year}) * 12 + month(l_shipdate) - 1) // {months} as slot from lineitem
        where l_shipdate >= date '{year}-01-01')
        where slot < {slots} group by l_partkey, slot"""


def _history_sql(slots: int) -> str:
    columns = ", ".join(
        f"max({v}) filter (slot = {i}) as {k}{i}"
        for i in range(slots) for k, v in (("s", "score"), ("c", "sources"), ("m", "mask"), ("r", "risks"))
    )
    return f"select registered_domain, {columns} from releases group by 1"


class _Chain:
    """Common table expressions, each over the one before."""

    def __init__(self, *parts: tuple[str, str]) -> None:
        self.parts = list(parts)

    def add(self, name: str, text: str) -> None:
        self.parts.append((name, text))

    def stages(self, name: str, start: str, stages: list[T.Stage]) -> str:
        for k, stage in enumerate(stages):
            self.add(f"{name}_{k}", f"select *, {', '.join(f'{e} as {c}' for c, e in stage.items())} from {start}")
            start = f"{name}_{k}"
        return start

    def banded(self, name: str, source: str, last: int) -> str:
        self.add(
            f"{name}_r",
            f"select *, row_number() over (order by s{last} desc, c{last} desc nulls last, registered_domain) as rank from {source} where s{last} is not null"
        )
        self.add(f"{name}_b", f"select *, {T.band_of('rank')} as band from {name}_r")
        self.add(f"{name}_c", f"select *, {T.cap_of('band')} as cap from {name}_b")
        return f"{name}_c"

    def scaled(self, name: str, source: str, p: str) -> str:
        self.add(
            f"{name}_m",
            f"select band, median({p}conf) as center, greatest(median({p}res), {T.NOISE_FLOOR}) as noise_scale from {source} where {p}ok group by 1"
        )
        self.add(
            f"{name}_d",
            f"select band, greatest(1.4826 * median(abs({p}conf - center)), {T.NOISE_FLOOR}) as {p}scale, max(noise_scale) as noise_scale from {source} join {name}_m using (band) where {p}ok group by 1"
        )
        self.add(f"{name}_s", f"select * from {source} left join {name}_d using (band)")
        return f"{name}_s"

    def sql(self, query: str) -> str:
        return "with " + ",\n".join(f"{n} as materialized ({t})" for n, t in self.parts) + "\n" + query


def _index_chain() -> tuple[_Chain, str]:
    c = _Chain(("releases", _releases_sql("index")), ("hist", _history_sql(INDEX_SLOTS)))
    last = INDEX_SLOTS - 1
    at = c.stages(
        "a", c.banded("b", "hist", last), [*T.rolling("l_", last, 4), *T.rolling("p_", last - 1, 4), *T.rolling("t_", last, 8)]
    )
    return c, c.stages("z", c.scaled("m", at, "t_"), [T.adjusted("t_"), *T.quality(last), *T.index_stages(last)])


_CHAIN, _PARTS = _index_chain()
_LEVEL = {
    "n": "cast(l_n as bigint)", "ewma": "round(l_ewma, 6)", "mean": "round(l_mean, 6)", "previous": "round(p_ewma, 6)",
    "eligible": "l_ok", "damped": "round(damped, 6)"
}
_TREND = {
    "slope": "round(t_slope, 6)", "residual": "round(t_res, 6)", "confirmed": "round(t_conf, 6)", "adjustment": "round(t_adj, 6)",
    "fitted": "round(t_fit, 6)", "trend": "trend", "rank": "rank", "band": "band"
}
_SHARES = {
    k: f"round({k}, 6)" for k in ("history_share", "coverage_share", "steady_share", "noise", "confidence")
} | {"shock": "shock"}
_INDEX = {
    k: (f"round({e}, 6)" if k in ("reputation_score", "reputation_confidence", "trend_strength", "score_candidate") else e)
    for k, e in T.INDEX_COLUMNS.items()
}


def _list(columns: T.Stage) -> str:
    return ", ".join(f"{e} as {c}" for c, e in columns.items())


def history(spark: SparkSession, d: str) -> DataFrame:
    return T.history(releases(spark, d, "index"), INDEX_SLOTS)


def _selected(spark: SparkSession, d: str, columns: T.Stage) -> DataFrame:
    return T.components(history(spark, d)).select(
        "registered_domain", *[F.expr(e).alias(c) for c, e in columns.items() if c != "registered_domain"]
    )


@query("temporal_level", _CHAIN.sql(f"select registered_domain, {_list(_LEVEL)} from {_PARTS}"))
def temporal_level(spark: SparkSession, d: str) -> DataFrame:
    return _selected(spark, d, _LEVEL)


@query("temporal_trend", _CHAIN.sql(f"select registered_domain, {_list(_TREND)} from {_PARTS}"))
def temporal_trend(spark: SparkSession, d: str) -> DataFrame:
    return _selected(spark, d, _TREND)


@query("temporal_confidence", _CHAIN.sql(f"select registered_domain, {_list(_SHARES)} from {_PARTS}"))
def temporal_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _selected(spark, d, _SHARES)


@query(
    "temporal_index",
    _CHAIN.sql(
        f"select {_list(_INDEX)}, date '2001-12-31' as snapshot_date, '{T.METHODOLOGY}' as index_methodology_version from {_PARTS}"
    )
)
def temporal_index(spark: SparkSession, d: str) -> DataFrame:
    index = T.temporal_index(history(spark, d), F.lit("2001-12-31").cast("date"))
    return index.withColumns(
        {c: F.round(c, 6) for c in ("reputation_score", "reputation_confidence", "trend_strength", "score_candidate")}
    )


_QUANTILES = ", ".join(
    f"round(quantile_cont({c}, {q}), 6) as {k}_p{int(q * 100):02d}" for c,
    k in (("score_candidate", "candidate"), ("reputation_confidence", "confidence")) for q in (0.05, 0.25, 0.5, 0.75, 0.95)
)


@query("temporal_stats", _CHAIN.sql(f"""select count(*) as row_count, count(score_candidate) as eligible_score_count,
        count(*) filter (history_observations = 8) as full_history_count,
    count(*) filter (structural_shock = 'true') as structural_shock_count, {_QUANTILES} from (select {_list(T.INDEX_COLUMNS)}
    from {_PARTS})"""))
def temporal_stats(spark: SparkSession, d: str) -> DataFrame:
    out = T.index_statistics(T.temporal_index(history(spark, d), F.lit("2001-12-31").cast("date")))
    return out.select(*[F.round(c, 6).alias(c) if k == "double" else c for c, k in out.dtypes])


_LABELS = "case band " + " ".join(f"when {k} then '{x}'" for k, x in enumerate(T.BAND_LABELS)) + " end"


@query("rank_band_summary", _CHAIN.sql(f"""select band, count(*) as domains, count(*) filter (t_ok) as eligible,
        round(max(noise_scale), 6) as noise_scale,
    round(median(confidence) filter (t_ok), 6) as median_confidence,
    {', '.join(f"count(*) filter (trend = '{t}') as {t}" for t in ('rising', 'falling', 'stable', 'uncertain'))},
    count(*) filter (shock) as shocks, {_LABELS} as rank_band from {_PARTS} group by band"""))
def rank_band_summary(spark: SparkSession, d: str) -> DataFrame:
    return T.band_summary(T.components(history(spark, d))).withColumns(
        {c: F.round(c, 6) for c in ("noise_scale", "median_confidence")}
    )


def walk_history(spark: SparkSession, d: str) -> DataFrame:
    return T.history(releases(spark, d, "walk"), WALK_SLOTS, latest_only=False)


def _walk_sql(kind: str) -> str:
    c = _Chain(("releases", _releases_sql("walk")), ("hist", _history_sql(WALK_SLOTS)))
    longs = []

    def long(source: str, slot: int, name: str, value: str, keep: str = "false") -> None:
        longs.append(
            f"select '{name}' as candidate, {slot} as slot, registered_domain, ({value})::double as value, {keep} as shock from {source} where ({value}) is not null"
        )

    first, last = T.HISTORY_WINDOW - 1, WALK_SLOTS - 1
    for i in range(first, last + 1):
        base = c.banded(f"b{i}", "hist", i)
        if kind == "meta":
            long("hist", i, "raw", f"s{i}")
            for w in (4, 8):
                p = f"w{w}_"
                at = c.stages(
                    f"y{i}_{w}", c.scaled(f"m{i}_{w}", c.stages(f"a{i}_{w}", base, T.rolling(p, i, w)), p), [T.adjusted(p)]
                )
                for name, v in W.META_CANDIDATES.items():
                    long(at, i, f"{name}-w{w}", f"case when {p}ok then {v.format(p=p)} end")
        else:
            at = c.scaled(
                f"m{i}", c.stages(f"a{i}", base, [*T.rolling("l_", i, 4), *T.rolling("p_", i - 1, 4), *T.rolling("t_", i, 8)]),
                "t_"
            )
            at = c.stages(f"y{i}", at, [T.adjusted("t_"), *T.quality(i), {"base": f"case when l_ok then l_ewma else s{i} end"}])
            for name, v in ({"raw": f"s{i}"} | W.INDEX_CANDIDATES).items():
                long(at, i, name, v, "shock")
    c.add("vals", " union all ".join(longs))
    c.add(
        "tops",
        "select * from (select *, row_number() over (partition by candidate, slot order by value desc, registered_domain) as k from vals) where k <= 100000"
    )
    c.add("grid", f"select candidate, slot from (select distinct candidate from vals), range({first}, {last + 1}) as r(slot)")

    def hits(join: str) -> str:
        return ", ".join(
            f"count(*) filter (greatest(a.k, b.k) <= {n}) / {n}::double as h{n}" for n in W.TOP_N
        ) + f" from tops a join tops b on a.registered_domain = b.registered_domain and {join} group by 1, 2"

    c.add("kept", f"select a.candidate, a.slot, {hits('a.candidate = b.candidate and b.slot = a.slot - 1')}")
    raw = "b.candidate = 'raw' and b.slot = a.slot"
    c.add("ahead", f"select a.candidate, a.slot, {hits(raw + ' + 1')}")
    c.add("same", f"select a.candidate, a.slot, {hits(raw)}")
    shock = ", quantile_cont(abs(v.value - p.value), 0.5) filter (z.shock) as shock_median, quantile_cont(abs(v.value - p.value), 0.95) filter (z.shock) as shock_p95" if kind == "index" else ""
    flags = "left join vals z on z.candidate = 'raw' and z.slot = v.slot and z.registered_domain = v.registered_domain"
    c.add("drift", f"""select v.candidate, v.slot, quantile_cont(abs(v.value - p.value), 0.95) as drift_p95{shock} from vals v
        join vals p on p.candidate = v.candidate
        and p.slot = v.slot - 1 and p.registered_domain = v.registered_domain {flags} group by 1, 2""")
    medians = [f"round(median(coalesce(kept.h{n}, 0)) filter (g.slot > {first}), 6) as retention_{n}" for n in W.TOP_N]
    medians += [f"round(median(coalesce(ahead.h{n}, 0)) filter (g.slot < {last}), 6) as forecast_{n}" for n in W.TOP_N]
    medians += [
        f"round(median({x}), 6) as {x}" for x in ("drift_p95", *(("shock_median", "shock_p95") if kind == "index" else ()))
    ]
    medians += [f"max(same.h{n}) filter (g.slot = {last}) as latest_{n}" for n in W.TOP_N]
    using = " ".join(
        f"left join {t} on {t}.candidate = g.candidate and {t}.slot = g.slot" for t in ("kept", "ahead", "same", "drift")
    )
    return c.sql(
        f"select g.candidate, {', '.join(medians)}, (select count(*) from vals v where v.candidate = g.candidate and v.slot = {last}) as latest_eligible from grid g {using} group by 1"
    )


@query("walkforward_meta_index", _walk_sql("meta"))
def walkforward_meta_index(spark: SparkSession, d: str) -> DataFrame:
    values = W.meta_candidates(walk_history(spark, d), WALK_SLOTS)
    return W.evaluate(values, T.HISTORY_WINDOW - 1, WALK_SLOTS - 1)


@query("walkforward_candidates", _walk_sql("index"))
def walkforward_candidates(spark: SparkSession, d: str) -> DataFrame:
    values = W.index_candidates(walk_history(spark, d), WALK_SLOTS)
    return W.evaluate(values, T.HISTORY_WINDOW - 1, WALK_SLOTS - 1, shocks=True)
