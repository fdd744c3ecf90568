"""Hosts and registered domains, as column expressions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Names that no public registry has.
RESERVED_SUFFIXES = ("internal", "local", "localhost", "test")


@dataclass(frozen=True)
class SuffixRule:
    """A public-suffix rule; kind is normal, wildcard (one more label) or exception (one label less)."""

    suffix: str
    kind: str = "normal"
    section: str = "icann"


# A small set of rules that stands in where no list is given; deployments pass the public list.
DEFAULT_RULES: tuple[SuffixRule, ...] = (
    *[SuffixRule(s) for s in (
        "com", "net", "org", "edu", "gov", "mil", "int", "info", "biz", "io", "dev", "app", "de", "fr", "es", "it", "nl", "be",
        "ch", "at", "pl", "eu", "us", "ca", "ru", "cn", "in", "br", "jp",
        "co.jp", "ne.jp", "or.jp", "ac.jp", "uk", "co.uk", "org.uk", "ac.uk", "gov.uk", "au", "com.au", "net.au", "org.au",
        "com.br", "com.cn", "co.in", "nz", "co.nz", "co.za", "za", "se", "no", "dk", "fi",
    )],
    SuffixRule("ck", "wildcard"), SuffixRule("www.ck", "exception"), SuffixRule("kawasaki.jp", "wildcard"),
    SuffixRule("city.kawasaki.jp", "exception"),
    *[SuffixRule(s, section="private") for s in ("github.io", "blogspot.com", "pages.dev")],
)


def url_host(url: Column) -> Column:
    """Host of a URL, with http:// where it has no scheme; null for blank, broken and .onion ones.

    User, password and port are no part of it; letters come out in lower case.
    """
    text = F.trim(url)
    scheme = F.regexp_replace(text, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//", "")
    authority = F.regexp_extract(scheme, r"^([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    broken = (host == "") | F.lower(host).endswith(".onion") | host.rlike(r"[\s\\<>^`{|}]")
    return F.when(text.isNotNull() & ~broken, F.lower(host))


def _is_ip(domain: Column) -> Column:
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    return domain.rlike(rf"^{octet}(?:\.{octet}){{3}}$") | domain.contains(":")


def _to_ascii(name: Column) -> Column:
    """IDNA (UTS 46) of non-ASCII names; null where they have none."""

    def encode(names: pd.Series) -> pd.Series:
        import idna

        def one(name: str | None) -> str | None:
            try:
                return None if name is None else idna.encode(name, uts46=True).decode("ascii")
            except idna.IDNAError:
                return None

        return names.map(one)

    return F.pandas_udf(encode, StringType())(name)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value named once in the plan, however often it is used."""
    return F.transform(F.array(value), use)[0]


def clean_name(raw: Column) -> Column:
    """Trimmed, undotted, lower-case name, or null for blank, overlong, control characters and IP addresses."""
    name = F.lower(F.regexp_replace(F.regexp_replace(raw, r"^[\s]+|[\s]+$", ""), r"^\.+|\.+$", ""))
    def checked(n: Column) -> Column:
        return F.when((n != "") & (F.char_length(n) <= 253) & ~n.rlike(r"[\x00-\x1f\x7f]") & ~_is_ip(n), n)

    return _let(name, checked)


def ascii_label_ok(name: Column) -> Column:
    """Labels of letters, digits, hyphens and underscores of 63 characters at most; no hyphen at either end."""
    return name.rlike(r"^(?:[a-z0-9_](?:[a-z0-9_\-]{0,61}[a-z0-9_])?\.)*[a-z0-9_](?:[a-z0-9_\-]{0,61}[a-z0-9_])?$")


def suffix_table(spark, rules: Sequence[SuffixRule] = DEFAULT_RULES, private: bool = False) -> DataFrame:
    """(suffix, kind); private-section rules count as suffixes only where asked."""
    rows = [(r.suffix, r.kind) for r in rules if private or r.section == "icann"]
    return spark.createDataFrame(rows, "suffix string, kind string")


def with_registered_domain(
    df: DataFrame, column: str, out: str, rules: Sequence[SuffixRule] = DEFAULT_RULES, private: bool = False, idna: bool = True
) -> DataFrame:
    """Adds the registered domain of a host: its public suffix and one label more; null where it has none.

    The rules become one map constant in the plan (the public list is some ten thousand entries), so each host is
    matched against the suffixes of itself without a join; of those the longest rule holds, an exception above all.
    Only rows whose name has other letters than ASCII leave for Python, and only where ``idna`` is on: they are a branch
    of their own, as a Python function beside others would be given every row.
    """
    if idna:
        plain = F.coalesce(clean_name(F.col(column)).rlike(r"^[\x00-\x7f]*$"), F.lit(True))
        other = df.where(~plain)
        encoded = other.withColumn("_idna", _to_ascii(clean_name(F.col(column))))
        encoded = with_registered_domain(encoded, "_idna", out, rules, private, idna=False).select(*df.columns, out)
        return with_registered_domain(df.where(plain), column, out, rules, private, idna=False).unionByName(encoded)
    table = {r.suffix: r.kind for r in rules if private or r.section == "icann"}
    kinds = F.from_json(F.lit(json.dumps(table)), "map<string,string>")  # folds to one constant
    work = df.withColumn("_n", clean_name(F.col(column)))
    name = F.when(F.col("_n").rlike(r"^[\x00-\x7f]*$"), F.col("_n"))

    def suffix_labels(tail: Column, i: Column) -> Column:
        """How many labels the suffix has by the rule at the last i labels; negative for an exception; null for no rule."""
        return _let(
            kinds[tail], lambda kind: F.when(kind == "normal", i).when(kind == "wildcard", i + 1).when(kind == "exception", 1 - i)
        )

    def of_labels(labels: Column) -> Column:
        n = F.size(labels)
        rules_at = F.transform(
            F.sequence(F.lit(1), n), lambda i: suffix_labels(F.array_join(F.slice(labels, n - i + 1, i), "."), i)
        )
        longest = _let(F.array_compact(rules_at), lambda k: F.when(F.array_min(k) < 0, -F.array_min(k)).otherwise(F.array_max(k)))
        return _let(longest, lambda k: F.when(
            (k >= 1) & (n > k) & ~F.element_at(labels, -1).isin(*RESERVED_SUFFIXES),
            F.array_join(F.slice(labels, n - k, k + 1), ".")
        ))

    work = work.withColumn(out, _let(name, lambda a: F.when(ascii_label_ok(a), _let(F.split(a, r"\."), of_labels))))
    return work.select(*df.columns, out)


def rightmost_label(domain: Column) -> Column:
    return F.substring_index(domain, ".", -1)
