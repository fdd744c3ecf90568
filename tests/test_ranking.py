import random

import pytest
from pyspark.sql import functions as F

from quorumrank.operators import ranking


@pytest.fixture(params=[0, 1_000_000])
def one_task_rows(request, monkeypatch):
    """By ranges, and in one task."""
    monkeypatch.setattr(ranking, "ONE_TASK_ROWS", request.param)


@pytest.mark.usefixtures("one_task_rows")
@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_distributed_percentile_equals_window(spark, direction):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, float(rng.randrange(40)), rng.random() * 1e6])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v double")
    got = {r.id: r.p for r in ranking.with_percentile(df, "v", "p", direction).collect()}
    known = df.where("v is not null").withColumn("p", ranking.percentile_window("v", direction))
    assert got == {r.id: r.p for r in known.collect()}


@pytest.mark.usefixtures("one_task_rows")
def test_one_row_and_all_ties_score_one(spark):
    assert [
        r.p for r in ranking.with_percentile(spark.createDataFrame([(1, 5.0)], "id long, v double"), "v", "p").collect()
    ] == [1.0]
    ties = spark.createDataFrame([(i, 5.0) for i in range(4)], "id long, v double")
    assert {r.p for r in ranking.with_percentile(ties, "v", "p", few=True).collect()} == {1.0}
    assert ranking.with_percentile(ties.limit(0), "v", "p").count() == 0


@pytest.mark.usefixtures("one_task_rows")
def test_ordinal_rank_is_total(spark):
    rng = random.Random(5)
    rows = [(f"d{i:04d}", None if i % 13 == 0 else float(rng.randrange(60))) for i in range(2000)]
    df = spark.createDataFrame(rows, "name string, s double")
    got = {r.name: r["rank"] for r in ranking.with_ordinal_rank(df, "s", [F.col("name").asc()], ranges=16).collect()}
    order = sorted((x for x in rows if x[1] is not None), key=lambda x: (-x[1], x[0]))
    assert {n: k + 1 for k, (n, _) in enumerate(order)} == {n: k for n, k in got.items() if k is not None}
    assert len(got) == 2000


@pytest.mark.usefixtures("one_task_rows")
def test_ranks_and_tops_of_groups(spark):
    rng = random.Random(6)
    rows = [(f"d{i:04d}", rng.choice("abc"), None if i % 11 == 0 else float(rng.randrange(300))) for i in range(3000)]
    df = spark.createDataFrame(rows, "name string, g string, s double")
    want = {}
    for g in "abc":
        order = sorted((x for x in rows if x[1] == g and x[2] is not None), key=lambda x: (-x[2], x[0]))
        want |= {x[0]: k + 1 for k, x in enumerate(order)}
    got = ranking.with_ordinal_rank(df, "s", [F.col("name").asc()], ranges=16, groups=["g"]).collect()
    assert len(got) == 3000 and {r.name: r["rank"] for r in got if r["rank"] is not None} == want
    top = ranking.top_rows(df, "s", [F.col("name").asc()], 70, ["g"]).collect()
    assert {r.name: r.k for r in top} == {n: k for n, k in want.items() if k <= 70}
