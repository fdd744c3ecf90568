import datetime

import pytest
from pyspark.sql import functions as F

from quorumrank.functions import domains, values


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("raw, domain", [
    ("www.Example.com", "example.com"), (" a.b.co.uk. ", "b.co.uk"), ("co.uk", None), ("com", None), ("localhost", None),
    ("x.internal", None), ("192.168.0.1", None), ("::1", None), ("", None), (None, None),
    ("a" * 254 + ".com", None), ("bad\x01.com", None), ("foo.github.io", "github.io"), ("a.b.ck", "a.b.ck"), ("b.ck", None),
    ("www.ck", "www.ck"), ("x.www.ck", "www.ck"), ("x.city.kawasaki.jp", "city.kawasaki.jp"),
    ("a.b.kawasaki.jp", "a.b.kawasaki.jp"), ("münchen.de", "xn--mnchen-3ya.de"), ("x.unknowntld", None), ("-a.com", None),
])
def test_registered_domain(spark, raw, domain):
    df = spark.createDataFrame([(raw,)], "h string")
    assert domains.with_registered_domain(df, "h", "d").first().d == domain


def test_private_suffixes(spark):
    df = spark.createDataFrame([("foo.github.io",), ("github.io",)], "h string")
    assert [r.d for r in domains.with_registered_domain(df, "h", "d", private=True).collect()] == ["foo.github.io", None]


@pytest.mark.parametrize("url, host", [
    ("https://www.A.com/x?y#z", "www.a.com"), ("a.com/path", "a.com"), ("http://u:p@a.com:80/", "a.com"), ("  ", None),
    (None, None), ("http://x.onion/a", None), ("//a.com/b", "a.com"), ("http://a b.com/", None),
])
def test_url_host(spark, url, host):
    assert one(spark, domains.url_host, url) == host


@pytest.mark.parametrize("text, day", [
    ("2024-05-06", datetime.date(2024, 5, 6)), ("2024-05-06T10:00:00Z", datetime.date(2024, 5, 6)),
    ("2024-05-06 10:00:00 UTC", datetime.date(2024, 5, 6)), ("None", None), ("", None), ("null", None), ("x", None),
    ("2024-13-01", None),
])
def test_lenient_date(spark, text, day):
    assert one(spark, values.lenient_date, text) == day


@pytest.mark.parametrize("text, n", [(" 7 ", 7), ("1.5", None), ("x", None), (None, None), ("-3", -3)])
def test_lenient_int(spark, text, n):
    assert one(spark, values.lenient_int, text) == n


@pytest.mark.parametrize(
    "text, out", [('{"a":1}', '{"a":1}'), ("[1]", '{"raw":"[1]"}'), ("oops", '{"raw":"oops"}'), ("", None), (None, None)]
)
def test_lenient_json(spark, text, out):
    assert one(spark, values.lenient_json, text) == out


def test_weeks(spark):
    assert values.week_tag(datetime.date(2027, 1, 1)) == "data-2026-W53"
    assert one(spark, values.iso_week_tag, datetime.date(2027, 1, 1), "date") == "data-2026-W53"
    assert values.week_grid("data-2027-W02", 4) == ["data-2026-W52", "data-2026-W53", "data-2027-W01", "data-2027-W02"]
    assert values.select_history(["data-2026-W52", "data-2027-W02"], "data-2027-W02", 4) == ["data-2026-W52", "data-2027-W02"]
    with pytest.raises(ValueError):
        values.select_history([], "data-2027-W02")
    with pytest.raises(ValueError):
        values.week_of_tag("2027-W02")
    assert values.default_month(datetime.date(2026, 1, 13)) == 202511 and values.default_month(datetime.date(2026, 1, 14)) == 202512


def test_formatting():
    assert (
        values.fmt_int(1234567), values.fmt_float(None), values.fmt_pct(1, 4), values.fmt_pct(1, 0)
    ) == ("1,234,567", "", "25.00%", "")
    assert values.redact("key=abc", ["abc", ""]) == "key=<redacted>"
    assert values.header_key(" Open Page-Rank ") == "openpagerank"
