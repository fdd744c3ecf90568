import bz2
import datetime
import json

from quorumrank import cli
from quorumrank.operators import health
from quorumrank.session import ensure_table, run_sql
from quorumrank.sources import archive

from .test_sources import published


def test_reports_and_index(spark, tmp_path, capsys):
    for k in range(8):
        day = datetime.date(2026, 6, 1) + datetime.timedelta(weeks=k)
        sources = {"tranco": {"status": "stale" if k == 2 else "fresh", "row_count": 10 + k}}
        archive.export_archive(
            published(spark, day, 0.1 * k), str(tmp_path / "r"), f"data-2026-W{23 + k}", sources, datetime.datetime(2026, 7, 20)
        )
    root = str(tmp_path / "r")
    assert cli.main(["release", root]) == 0
    said = capsys.readouterr().out
    assert "## Tier transitions" in said and "| data-2026-W30 | tranco | fresh | 17 |" in said
    assert cli.main(["stability", root, "--output", str(tmp_path / "s.md")]) == 0 and "| red |" in (tmp_path / "s.md").read_text()
    assert cli.main(
        ["index", root, "--output", str(tmp_path / "a.gz")]
    ) == 0 and cli.main(["index", root, "--output", str(tmp_path / "b.gz")]) == 0
    assert (tmp_path / "a.gz").read_bytes() == (tmp_path / "b.gz").read_bytes()
    assert "8 rows" in capsys.readouterr().out
    lineage = json.loads((tmp_path / "a.gz.json").read_text())
    assert lineage["history_calendar"]["missing_release_tags"] == [] and len(lineage["inputs"]) == 8 and lineage["row_count"] == 8 and lineage["statistics"]["trend_counts"]
    assert "tranco in data-2026-W25: stale" in (tmp_path / "s.md").read_text() and "| data-2026-W30 | tranco | fresh | 17 |" in (tmp_path / "s.md").read_text()
    assert cli.main(
        ["components", root, "--snapshot", str(tmp_path / "c.csv.bz2")]
    ) == 0 and "## Rank bands" in capsys.readouterr().out
    assert len(bz2.open(tmp_path / "c.csv.bz2", "rt").read().splitlines()) == 9
    for command, name in (("meta-index", "ewma-w8"), ("candidates", "shock-gated")):
        assert cli.main([command, root]) == 0 and f"| {name} |" in capsys.readouterr().out


def test_load_falls_back(spark, tmp_path, capsys, monkeypatch):
    """A good load, a failing one that falls back, a source that never came, and what the log says of them."""
    monkeypatch.setenv("FEED_TOKEN", "s3cret")
    (tmp_path / "t.csv").write_text("registered_domain,tranco_rank\na.com,1\nb.org,2\n")
    (tmp_path / "broken-s3cret.csv").write_text("registered_domain,tranco_rank\na.com,first\n")
    today = datetime.date.today().isoformat()
    base = [
        "--ingests", str(tmp_path / "in"), "--tables", str(tmp_path / "raw"), "--log", str(tmp_path / "log"), "--date", today,
        "--secret", "FEED_TOKEN"
    ]
    states = []
    for source, path in (("tranco", "t.csv"), ("tranco", "broken-s3cret.csv"), ("opr", "none.csv")):
        archive.write_ingest(
            str(tmp_path / "in"),
            archive.IngestRecord(
                source, "fresh" if source == "tranco" else "missing", today, normalized_path=str(tmp_path / path)
            )
        )
        assert cli.main(["load", source, *base]) == 0
        states.append(json.loads(capsys.readouterr().out.splitlines()[-1]))
    assert [
        (s["status"], s["row_count"], s["age_days"]) for s in states
    ] == [("fresh", 2, 0), ("stale", 2, 0), ("missing", 0, None)]
    assert {tuple(r)[:2] for r in spark.read.parquet(str(tmp_path / "raw" / "tranco")).collect()} == {("a.com", 1), ("b.org", 2)}
    assert spark.read.parquet(str(tmp_path / "raw" / "opr")).count() == 0
    log = spark.read.schema(health.LOG_SCHEMA).parquet(str(tmp_path / "log")).orderBy("update_started_at").collect()
    assert [r.status for r in log] == ["success", "stale", "missing"] and "not fresh" in log[2].error_message
    assert log[1].error_message and "s3cret" not in log[1].error_message


def test_export(spark, data, tmp_path, capsys):
    from quorumrank.plans import projections as P

    P.mart(spark, data).write.parquet(str(tmp_path / "mart"))
    now = datetime.datetime(1998, 8, 2)
    health.append_update(spark, str(tmp_path / "log"), [("tranco", now, now, "success", 5, 0, None, None)])
    assert cli.main(
        ["export", str(tmp_path / "mart"), str(tmp_path / "out"), "--log", str(tmp_path / "log"), "--prefix", "ranks"]
    ) == 0
    (release,) = archive.discover(str(tmp_path / "out"))
    assert release.tag == "data-1998-W31" and release.csv_path.endswith("ranks_1998-08-02.csv.gz")
    assert archive.read_meta(release)["sources"] == {"tranco": {"status": "fresh", "row_count": 5, "age_days": 0}}


def test_health_exit_code(spark, tmp_path):
    now = datetime.datetime(2026, 7, 20)
    health.append_update(
        spark, str(tmp_path / "log"),
        [("tranco", now, now, "success", 5, 0, None, None), ("opr", now, now, "missing", 0, None, None, "failed")]
    )
    assert cli.main(["health", str(tmp_path / "log"), "tranco", "opr"]) == 0
    assert cli.main(["health", str(tmp_path / "log"), "tranco", "opr", "crux"]) == 2


def test_catalog_and_parameters(spark):
    assert ensure_table(
        spark, "update_log_test", health.LOG_SCHEMA
    ).count() == 0 == ensure_table(spark, "update_log_test", health.LOG_SCHEMA).count()
    assert run_sql(spark, "select :x || '!' as y", x="it's").first().y == "it's!"
    spark.sql("drop table update_log_test")
