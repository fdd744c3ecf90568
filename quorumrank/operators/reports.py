"""Markdown reports from small collected results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import fmt_float, fmt_int
from ..sources.archive import markdown_table
from . import releases as R
from . import temporal as T
from . import walkforward as W

#: Rows of a table that a report shows; its inputs are aggregates or top-k lists of no more.
SHOWN = 200


def _cell(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return fmt_int(value)
    return fmt_float(value, 4) if isinstance(value, float) else str(value)


def section(title: str, df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """A heading and the rows of a small result."""
    names = list(columns or df.columns)
    rows = [[_cell(v) for v in r] for r in df.select(*names).limit(SHOWN).collect()]
    return f"## {title}\n\n{markdown_table(names, rows)}\n"


def release_report(
    release: DataFrame, previous: DataFrame | None = None, title: str = "Release", sources: Sequence[Sequence[object]] = ()
) -> str:
    """Shape of a release, the sources as its metadata has them and, beside an earlier one, what changed."""
    parts = [
        f"# {title}\n", section("Coverage", R.coverage_rows(release)),
        section("Sources per domain", R.coverage_rows(release, "sources_count")),
        section("Score quantiles", R.score_quantiles(release)), section("Score bands", R.score_bands(release)),
        section("Source presence", R.source_presence(release)),
        section("Risk sources", R.risk_distribution(release)), section("Risk by tier", R.risk_by_tier(release)),
        section("Threat types", R.threat_type_counts(release)),
        section("Flagged domains", R.top_flagged(release)), section("Rightmost labels", R.rightmost_labels(release)),
    ]
    if sources:
        parts += [
            "## Sources\n", markdown_table(["release", "source", "status", "rows"], [[_cell(v) for v in r] for r in sources]), ""
        ]
    if previous is not None:
        merged = R.both(release, previous)
        parts += [
            section("Counts against the previous release", R.count_deltas(release, previous)),
            section("Domains kept, new and gone", R.set_difference(release, previous)),
            section("Score drift", R.score_drift(merged)), section("Tier transitions", R.transitions(merged)),
            section("Top retention", R.topn_retention(release, previous)),
            section("New in the top 100", R.top_entrants(release, previous)), section("Movers", R.score_movers(merged)),
        ]
    return "\n".join(parts)


def stability_report(
    history: list[tuple[str, DataFrame]], schemas: int = 1, stale: Sequence[str] = (), sources: Sequence[Sequence[object]] = ()
) -> str:
    """Readiness and the change between adjacent releases; ``sources`` are (release, source, status, rows) from their metadata."""
    pairs, latest = R.stability(history), history[-1][1]
    return "\n".join([
        "# Stability\n", section("Readiness", R.readiness(pairs, schemas, len(stale))),
        f"Variants of the published columns: {schemas}. Sources that were not fresh: {'; '.join(stale) or 'none'}.\n",
        section("Adjacent releases", pairs), section("Source combinations of the latest release", R.source_combinations(latest)),
        section("Risk sources of the latest release", R.risk_distribution(latest)),
        "## Sources\n", markdown_table(["release", "source", "status", "rows"], [[_cell(v) for v in r] for r in sources]), "",
    ])


def component_report(parts: DataFrame, title: str = "Index components") -> str:
    """Levels, confidence, trend labels, noise scales and risk states of an index, by rank band."""
    known = parts.withColumns(
        {
            "reputation_score": F.expr("case when l_ok then l_ewma end"),
            "reputation_confidence": F.expr("case when t_ok then confidence end")
        }
    )
    whole = known.agg(
        F.count(F.lit(1)).alias("domains"),
        *[
            F.round(F.percentile(c, q), 4).alias(f"{c}_p{int(100 * q)}")
            for c in ("reputation_score", "reputation_confidence") for q in (0.1, 0.5, 0.9)
        ]
    )
    labels = F.element_at(F.array(*[F.lit(x) for x in T.BAND_LABELS]), F.col("band") + 1)
    shares = [
        F.round(F.avg((F.col("trend") == t).cast("double")), 4).alias(t) for t in ("rising", "falling", "stable", "uncertain")
    ]
    bands = known.groupBy("band").agg(
        F.count(F.lit(1)).alias("domains"), F.round(F.percentile("reputation_score", 0.5), 4).alias("median_score"),
        F.round(F.percentile("reputation_confidence", 0.5), 4).alias("median_confidence"),
        *shares, F.round(F.avg((F.col("steady_share") < 1).cast("double")), 4).alias("source_set_changed"),
        F.round(F.max("noise_scale"), 4).alias("noise_scale"),
    ).orderBy("band").select(labels.alias("rank_band"), "*").drop("band")
    risks = known.groupBy("risk_state").agg(F.count(F.lit(1)).alias("domains")).orderBy(F.desc("domains"), "risk_state")
    return "\n".join([
        f"# {title}\n",
        "Confidence is a heuristic between 0 and 1, not a probability; no observed risk does not mean that a domain is safe.\n",
        section("Summary", whole), section("Rank bands", bands), section("Observed risk", risks),
    ])


def walkforward_report(rows: DataFrame, title: str = "Walk-forward evaluation") -> str:
    """The candidates of an evaluation: agreement with the raw ranking, retention, forecast and drift, by size of the top."""
    rows = rows.orderBy("candidate")
    parts = [section(f"Top {n:,}", rows, ["candidate", f"latest_{n}", f"retention_{n}", f"forecast_{n}"]) for n in W.TOP_N]
    drift = [c for c in ("drift_p95", "shock_median", "shock_p95") if c in rows.columns]
    return "\n".join([f"# {title}\n", section("Drift", rows, ["candidate", "latest_eligible", *drift]), *parts])


def health_summary(health: DataFrame) -> str:
    return section("Source health", health)
