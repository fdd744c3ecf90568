import datetime
import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quorumrank.operators import health, mart, releases
from quorumrank.sources import archive, feeds
from quorumrank.streaming import refresh


def test_ranking_feeds(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("top.csv", "﻿1,www.a.com\n2,a.com\nx,b.com\n3,localhost\n4\n5,b.co.uk\n")
    df = feeds.read_headerless(spark, feeds.unzip_first_csv(str(tmp_path / "t.zip"), str(tmp_path / "out")), ["rank", "domain"])
    assert {(r.registered_domain, r.tranco_rank) for r in feeds.normalise_tranco(df).collect()} == {("a.com", 1), ("b.co.uk", 5)}
    assert tuple(feeds.rank_profile(df, F.col("domain"), feeds.lenient_int(F.col("rank"))).first()) == (4, 2, 1)
    (tmp_path / "m.csv").write_text("GlobalRank,Domain,RefSubNets\n1,a.com,5\n2,WWW.a.com,9\n3,b.org,x\n")
    rows = feeds.normalise_majestic(feeds.read_with_header(spark, str(tmp_path / "m.csv"))).collect()
    assert [tuple(r) for r in rows] == [("a.com", 9, 2)]
    (tmp_path / "r200.csv").write_text("domain\na.com\n")
    (tmp_path / "r500.csv").write_text("domain\na.com\nb.org\n")
    got = feeds.normalise_radar(feeds.read_buckets(spark, {200: str(tmp_path / "r200.csv"), 500: str(tmp_path / "r500.csv")}))
    assert {tuple(r) for r in got.collect()} == {("a.com", 200, 2), ("b.org", 500, 1)}
    (tmp_path / "o.csv").write_text('"Rank","Domain","Open Page Rank"\n1,a.com,9.5\n2,a.com,\n,c.com,\n')
    got = feeds.normalise_openpagerank(feeds.read_with_header(spark, str(tmp_path / "o.csv")))
    assert {tuple(r) for r in got.collect()} == {("a.com", 9.5, None, 1), ("a.com", None, None, 2)}


def test_risk_feeds(spark, tmp_path):
    (tmp_path / "u.csv").write_text(
        '# note\n# id,dateadded,url,threat,last_online\n"1","2024-01-02 10:00:00","http://x.a.com/y","Malware","2024-01-05"\n"2","2024-01-01","http://y.a.com/","malware",""\n"3","bad","http://b.org/","",""\n'
    )
    df = feeds.read_commented(spark, str(tmp_path / "u.csv"))
    assert [tuple(r) for r in feeds.normalise_risk(df, "urlhaus").collect()] == [
        ("a.com", "malware", datetime.date(2024, 1, 1), datetime.date(2024, 1, 5), 2, 2)
    ]
    assert tuple(feeds.risk_profile(df, "urlhaus").first()) == (3, 1, 1, 1)
    (tmp_path / "t.csv").write_text(
        '# preamble\n"2024-01-02", "1", "evil.a.com", "domain", "botnet_cc"\n"2024-01-03", "2", "http://b.org/x", "url", "payload"\n"2024-01-03", "3", "abc", "md5", "x"\n'
    )
    df = feeds.read_threats(spark, str(tmp_path / "t.csv"))
    assert {
        (r.registered_domain, r.threat_type) for r in feeds.normalise_risk(df, "threatfox").collect()
    } == {("a.com", "botnet_cc"), ("b.org", "payload")}
    assert feeds.risk_profile(df, "threatfox").first().row_count == 4
    (tmp_path / "h.csv").write_text(
        'ioc, ioc_type, first_seen\na.com, domain, 2024-01-02, more, "and, more"\nioc, ioc_type, first_seen\nb.org, domain, 2024-01-03\n'
    )
    rows = feeds.read_threats(spark, str(tmp_path / "h.csv")).collect()
    assert [(r.ioc, r._extra) for r in rows] == [("a.com", ["more", "and, more"]), ("ioc", []), ("b.org", [])]
    with gzip.open(tmp_path / "p.csv.gz", "wt") as f:
        f.write("url,submission_time,verification_time\nhttp://c.net/a,2024-02-01T00:00:00+00:00,\n")
    got = feeds.normalise_risk(feeds.read_with_header(spark, str(tmp_path / "p.csv.gz")), "phishtank").collect()
    assert [(r.registered_domain, r.threat_type, r.last_seen) for r in got] == [("c.net", "phishing", datetime.date(2024, 2, 1))]


def published(spark, day, shift=0.0):
    rows = [
        (
            f"d{i}.com", 90.0 - i + shift if i < 8 else None, "full" if i < 8 else "sparse", 5 if i < 8 else 2, "tranco,opr",
            None, None, i == 0, 2 if i == 0 else 0, "a|b" if i == 0 else "", day, "v1"
        )
        for i in range(10)
    ]
    return spark.createDataFrame(rows, archive.PUBLIC_SCHEMA).coalesce(1)


def test_release_round_trip(spark, tmp_path):
    day, now = datetime.date(2026, 7, 20), datetime.datetime(2026, 7, 20, 12)
    a = archive.export_archive(published(spark, day), str(tmp_path / "one"), "data-2026-W30", {}, now)
    b = archive.export_archive(published(spark, day), str(tmp_path / "two"), "data-2026-W30", {}, now)
    assert open(a.csv_path, "rb").read() == open(b.csv_path, "rb").read() and archive.sha256_file(a.csv_path) == json.load(open(a.meta_path))["sha256"]
    assert archive.discover(str(tmp_path / "one")) == [a]
    got = archive.read_release(spark, a.csv_path)
    assert got.count() == 10 and got.where("consensus_score is null").count() == 2
    assert archive.read_tolerant(spark, a.csv_path).where("security_flags_observed").count() == 1
    rows = archive.history_rows(spark, [a], ["data-2026-W30"])
    assert {r.mask for r in rows.collect()} == {17}
    with pytest.raises(ValueError):
        archive.export_archive(published(spark, day).limit(0), str(tmp_path), "data-2026-W30", {}, now)
    meta = json.load(open(a.meta_path)) | {"release": {"tag": "other"}}
    open(a.meta_path, "w").write(json.dumps(meta))
    with pytest.raises(ValueError):
        archive.discover(str(tmp_path / "one"))


def test_rows_of_every_archive_are_checked(spark, tmp_path):
    now = datetime.datetime(2026, 7, 20, 12)
    good = archive.export_archive(
        published(spark, datetime.date(2026, 7, 20)), str(tmp_path), "data-2026-W30", {}, now, prefix="some_name"
    )
    assert archive.discover(str(tmp_path)) == [good] and good.csv_path.endswith("some_name_2026-07-20.csv.gz")
    archive.check_rows(spark, [good])
    other = archive.export_archive(
        published(spark, datetime.date(2026, 7, 13)).unionByName(published(spark, datetime.date(2026, 7, 13)).limit(2)),
        str(tmp_path), "data-2026-W29", {}, now
    )
    wrong = archive.Release(other.tag, datetime.date(2026, 7, 14), "v2", other.csv_path, other.meta_path)
    with pytest.raises(
        ValueError,
        match="data-2026-W29: 2 repeated domains; data-2026-W29: 12 rows of another date; data-2026-W29: 12 rows of another version"
    ):
        archive.check_rows(spark, [wrong, good])


def test_history_validation():
    def rel(week, day, version="v"):
        return archive.Release(f"data-2026-W{week:02d}", day, version, "", "")
    monday = datetime.date(2026, 6, 1)
    good = [rel(23 + k, monday + datetime.timedelta(weeks=k)) for k in range(8)]
    assert len(archive.validate_history(good)) == 8
    archive.validate_history(good[:3] + good[4:])
    archive.validate_history([*good[:3], rel(26, good[3].snapshot_date + datetime.timedelta(days=1)), *good[4:]])
    late = [rel(23 + k, monday + datetime.timedelta(weeks=k)) for k in range(-1, 8)]
    assert archive.within_window([*late[:4], *late[5:]]) == [*good[:3], *good[4:]] and archive.within_window([]) == []
    archive.validate_history(archive.within_window([*late[:4], *late[5:]]))
    drifting = [rel(23 + k, monday + datetime.timedelta(weeks=k, days=min(k, 6))) for k in range(8)]
    assert len(archive.validate_history(drifting)) == 8
    with pytest.raises(ValueError, match="2 of the last 4"):
        archive.validate_history([*good[:4], *good[6:]])
    for bad in (
        good[3:], [*good[:6], rel(29, monday + datetime.timedelta(weeks=5, days=6)), good[7]],
        [*good[:3], rel(26, good[3].snapshot_date + datetime.timedelta(days=2)), *good[4:]],
        [*good[:-1], rel(30, good[-1].snapshot_date, "w")], []
    ):
        with pytest.raises(ValueError):
            archive.validate_history(bad)


def test_ingest_records_and_tables(spark, tmp_path):
    data = tmp_path / "rows.csv"
    data.write_text("x")
    archive.write_ingest(
        str(tmp_path), archive.IngestRecord("tranco", "fresh", "2026-07-10", row_count=3, normalized_path=str(data))
    )
    assert archive.read_ingest(str(tmp_path), "tranco", "2026-07-10").row_count == 3
    assert archive.cached_ingest(str(tmp_path), "tranco", datetime.date(2026, 7, 20)).status == "stale"
    assert archive.cached_ingest(str(tmp_path), "tranco", datetime.date(2026, 8, 20)).status == "missing"
    for day, text in (
        ("2026-07-11", "no json"), ("2026-07-12", "[]"),
        (
            "2026-07-13",
            json.dumps(
                {
                    "source": "tranco", "status": "fresh", "snapshot_date": "2026-07-01", "downloaded_at": "2026-07-19T08:00:00",
                    "row_count": 4, "normalized_path": str(data), "list_id": "x"
                }
            )
        )
    ):
        (tmp_path / "tranco" / day).mkdir()
        (tmp_path / "tranco" / day / "_meta.json").write_text(text)
    assert archive.cached_ingest(str(tmp_path), "tranco", datetime.date(2026, 7, 20)).row_count == 4
    for n in (3, 5):
        assert archive.swap_table(spark.range(n).toDF("x"), str(tmp_path / "raw"), datetime.date(2026, 7, 20)) == n
    (tmp_path / "raw").rename(tmp_path / "raw__before")  # as after a crash between the two moves
    with pytest.raises(Exception, match="broken"):
        archive.swap_table(
            spark.range(1).select(F.raise_error(F.lit("broken")).alias("x")), str(tmp_path / "raw"), datetime.date(2026, 7, 21)
        )
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 5
    assert spark.read.parquet(str(tmp_path / "raw")).columns == ["x", "snapshot_date", "ingested_at"]
    assert archive.empty_table(spark, health.LOG_SCHEMA).count() == 0
    assert archive.markdown_table(["a"], [["x|y"]]).splitlines()[-1] == "| x\\|y |"


def test_fallback_and_contract(spark, data):
    now = datetime.datetime(2026, 7, 20)
    ago = lambda n: (now - datetime.timedelta(days=n), 7)
    assert health.fall_back("tranco", 9, None, False, now).status == "fresh"
    assert health.fall_back("tranco", None, ago(30), True, now) == health.Fallback("tranco", "stale", 7, 30)
    for case in ((ago(31), True), (ago(1), False), (None, True)):
        assert health.fall_back("tranco", None, *case, now).status == "missing"
    from quorumrank.plans import projections as P
    profile, warnings = health.check_rank_contract(P.raw_crux(spark, data), P.CRUX_MONTH, F.col("registered_domain"))
    assert profile["origin_rows"] > 0 and any("missing" in w for w in warnings)
    for broken in (lambda: health.check_rank_contract(spark.range(1), 202601, F.lit("x")), lambda: health.check_rank_contract(P.raw_crux(spark, data), 190001, F.col("registered_domain")),
                   lambda: health.check_rank_contract(P.raw_crux(spark, data), P.CRUX_MONTH, F.col("registered_domain"), True)):
        with pytest.raises(RuntimeError):
            broken()


def test_streamed_log(spark, tmp_path):
    (tmp_path / "in").mkdir()
    def put(k, status):
        (tmp_path / "in" / f"{k}.json").write_text(
            json.dumps(
                {
                    "source": "tranco", "update_started_at": f"2026-07-0{k}T00:00:00Z",
                    "update_completed_at": f"2026-07-0{k}T01:00:00Z", "status": status, "row_count": k
                }
            )
        )
        refresh.follow_updates(spark, str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()
    put(1, "success")
    put(2, "stale")
    rows = refresh.current_status(spark, str(tmp_path / "log")).collect()
    assert [(r.source, r.status, r.row_count) for r in rows] == [("tranco", "stale", 2)]
    checked = health.source_health(spark.read.schema(health.LOG_SCHEMA).parquet(str(tmp_path / "log")), ["tranco", "opr", "crux"])
    assert health.exit_code(checked) == 2


def test_release_reports(spark):
    a, b = published(spark, datetime.date(2026, 7, 13)), published(
        spark, datetime.date(2026, 7, 20), 1.0
    ).where("registered_domain <> 'd9.com'")
    assert releases.set_difference(b, a).first().removed == 1
    assert releases.score_drift(releases.both(b, a)).first().mean_delta == 1.0
    assert releases.transitions(releases.both(b, a)).where("previous = 'full'").first().to_full == 8
    assert mart.PUBLIC_COLUMNS == a.columns
