"""Global ranks without a single-partition sort.

A window without a partition sorts every row in one task. Here values are cut at quantile edges (a few hundred
numbers on the driver), counted in each range, and ranked within their range by a partitioned window; the rank is that
plus what lies in the ranges before. Equal values fall in one range, so ties never straddle. The edges only spread
the work: ranks are exact whatever they are. Up to ONE_TASK_ROWS rows there are no edges, and one task sorts them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ranges of values at most.
RANGES = 256
#: Rows that a window without ranges may hold.
ONE_TASK_ROWS = 1_000_000
#: A table that the optimiser takes for no larger isn't even counted.
SMALL_BYTES = 32 << 20


def percentile_window(value: str, direction: str = "asc") -> Column:
    """``1 - percent_rank``: the best value scores 1. Plans one partition: for data of a bounded size."""
    order = F.col(value).asc() if direction == "asc" else F.col(value).desc()
    return 1 - F.percent_rank().over(Window.orderBy(order))


def quantile_edges(
    columns: dict[str, tuple[DataFrame, str]], ranges: int = RANGES, one_task_rows: int | None = None
) -> dict[str, list[float]]:
    """Range edges of several columns in one job, none for ``one_task_rows`` values or fewer; columns: name to (table, column)."""
    most = ONE_TASK_ROWS if one_task_rows is None else one_task_rows
    known = {name: x for name, x in columns.items() if not most or _planned_bytes(x[0]) > SMALL_BYTES}
    if not known:
        return {name: [] for name in columns}
    parts = [df.select(F.lit(name).alias("name"), F.col(c).cast("double").alias("v")) for name, (df, c) in known.items()]
    shares = [i / ranges for i in range(1, ranges)]
    found = reduce(DataFrame.unionByName, parts).groupBy("name").agg(
        F.count("v").alias("n"), F.percentile_approx("v", shares, 20 * ranges).alias("e")
    )
    edges = {r.name: sorted(set(r.e or [])) if r.n > most else [] for r in found.collect()}
    return {name: [] for name in columns} | edges


def _planned_bytes(df: DataFrame) -> int:
    """The optimiser's own estimate, without a job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def range_of(value: Column, edges: list[float], descending: bool = False) -> Column:
    """Number of edges below the value (above it, where descending), by binary search."""
    if not edges:
        return F.lit(0)
    if descending:
        value, edges = -value, sorted(-e for e in edges)
    places = F.split(F.lit(",".join(map(repr, edges))), ",").cast("array<double>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, s: F.when((at + s <= len(edges)) & (F.get(places, at + s - 1) < value), at + s).otherwise(at)
    )


def value_ranks(
    df: DataFrame, value: str, direction: str = "asc", few: bool = False, ranges: int = RANGES, edges: list[float] | None = None
) -> DataFrame:
    """(value, below, n): rows with a better value than each distinct one, and all rows; nulls don't take part.

    ``few`` says that the values are a short fixed list (rank buckets), which need no ranges; ``edges`` are computed
    where they aren't given.
    """
    known = df.where(F.col(value).isNotNull()).select(value)
    counts = known.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    descending = direction == "desc"
    if edges is None:
        edges = [] if few else quantile_edges({"v": (known, value)}, ranges)["v"]
    counts = counts.withColumn("_r", range_of(F.col(value).cast("double"), edges, descending))
    order = F.col(value).desc() if descending else F.col(value).asc()
    before = Window.partitionBy("_r").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("_r").agg(F.sum("_c").alias("_t"))  # one row for each range, RANGES at most
    along = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "_r", F.coalesce(F.sum("_t").over(along), F.lit(0)).alias("_o"), F.sum("_t").over(Window.partitionBy()).alias("n")
    )
    placed = counts.withColumn("_b", F.coalesce(F.sum("_c").over(before), F.lit(0))).join(F.broadcast(totals), "_r")
    return placed.select(value, (F.col("_o") + F.col("_b")).alias("below"), "n")


def with_percentile(
    df: DataFrame, value: str, out: str, direction: str = "asc", few: bool = False, edges: list[float] | None = None
) -> DataFrame:
    """``df`` without null values and with ``out`` = 1 - (rank - 1) / (n - 1), ties sharing the best; 1.0 for one row."""
    if edges is None and not few:
        edges = quantile_edges({"v": (df, value)})["v"]
    if not edges and not few:
        return df.where(F.col(value).isNotNull()).withColumn(out, percentile_window(value, direction))
    ranks = value_ranks(df, value, direction, few, edges=edges)
    score = F.when(F.col("n") > 1, 1 - F.col("below") / (F.col("n") - 1)).otherwise(F.lit(1.0))
    return df.join(ranks, value).withColumn(out, score).drop("below", "n").select(*df.columns, out)


def _placed(df: DataFrame, score: str, groups: Sequence[str], edges: list[float]) -> tuple[DataFrame, DataFrame]:
    """(df with its range ``_r``, the best first; (groups, _r, _o): rows in better ranges)."""
    placed = df.withColumn("_r", range_of(F.col(score).cast("double"), edges, descending=True))
    totals = placed.groupBy(*groups, "_r").agg(F.count(F.lit(1)).alias("_t"))
    along = Window.partitionBy(*groups).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    return placed, totals.select(*groups, "_r", F.coalesce(F.sum("_t").over(along), F.lit(0)).alias("_o"))


def with_ordinal_rank(
    df: DataFrame, score: str, ties: list[Column], out: str = "rank", ranges: int = RANGES, groups: Sequence[str] = ()
) -> DataFrame:
    """Adds 1, 2, 3... by falling score and then ``ties``, which must tell all rows apart, in each of a few groups.

    Null scores get none.
    """
    edges = quantile_edges({"v": (df, score)}, ranges)["v"]
    order = [F.col(score).desc_nulls_last(), *ties]
    if not edges:
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order)).cast("long")
        return df.withColumn(out, F.when(F.col(score).isNotNull(), rank))
    placed, before = _placed(df.where(F.col(score).isNotNull()), score, groups, edges)
    ranked = placed.withColumn("_k", F.row_number().over(Window.partitionBy(*groups, "_r").orderBy(*order)))
    ranked = ranked.join(F.broadcast(before), [*groups, "_r"])  # a row for each range of a group
    ranked = ranked.select(*df.columns, (F.col("_o") + F.col("_k")).cast("long").alias(out))
    return ranked.unionByName(df.where(F.col(score).isNull()).withColumn(out, F.lit(None).cast("long")))


def top_rows(df: DataFrame, score: str, ties: list[Column], most: int, groups: Sequence[str], out: str = "k") -> DataFrame:
    """The first ``most`` rows of each group by falling score and then ``ties``, with their rank.

    Ranges that lie beyond them are left out before anything is sorted. Null scores don't take part.
    """
    known = df.where(F.col(score).isNotNull())
    edges = quantile_edges({"v": (known, score)})["v"]
    order = [F.col(score).desc(), *ties]
    if not edges:
        return known.withColumn(out, F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col(out) <= most)
    placed, before = _placed(known, score, groups, edges)
    first = placed.join(F.broadcast(before.where(F.col("_o") < most)), [*groups, "_r"])
    ranked = first.withColumn("_k", F.row_number().over(Window.partitionBy(*groups, "_r").orderBy(*order)))
    return ranked.select(*df.columns, (F.col("_o") + F.col("_k")).alias(out)).where(F.col(out) <= most)
