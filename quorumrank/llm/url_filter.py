"""URL verdicts from rules and from a logistic regression on hashed character n-grams, scored by SQL expressions.

The regression is fitted on the driver over a small labelled table of URLs, made by a rule from two lists of ordinary
words (its size is its bound). A weight belongs to a bucket of ``crc32(kind + n-gram)``; the fitted weights enter the plan as one constant array, so scoring is a
projection over the table: no join, no shuffle, no Python on the executors.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import pick

BUCKETS = 16_384
#: (kind, characters of an n-gram): of the host between its end marks, and of the path.
GRAMS = (("h", 3), ("h", 4), ("h", 5), ("p", 4))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words that the labelled hosts are made of.
_BLOCKED = """
casino poker roulette blackjack slots jackpot lottery lotto bets betting gambling bingo sportsbook pills pharmacy meds viagra
steroids adult porn xxx nude erotic escorts camgirls hookups fetish ads adserver adclick banners popups tracker clickbait spam
spambot linkfarm malware phishing scam warez torrents cracks keygen serials pirated replica counterfeit knockoff payday loans
debt-relief get-rich prizes giveaway miracle-cure weight-loss fake-followers doorway cheats
"""
_ALLOWED = """
news library university weather cooking gardening museum history science physics maths literature poetry travel railway cycling
football swimming chess music theatre cinema painting school hospital charity council parliament courts archive documents wiki
forum blog shop books recipes compilers database network astronomy biology chemistry geology medicine nursing farming forestry
rivers mountains birds winter window address northern stationery attention trackside farmhouse dictionary tenth ring thread
therapy weaving thunder theory thought other weather-station tradition station nation motion version letter street winner better
alphabet adulthood casting spillway address-book headset upload billing tablet padlock advice spine farmers-market essex scandinavia
finance insurance bakery coffee garden travelogue photography design fashion kitchen furniture pottery knitting running climbing
sailing fishing camping horses dogs cats zoo aquarium castle village harbour bridge tunnel airport police fire-brigade election
embassy ministry charter treaty economy market bank savings pension tax museum-shop orchestra choir opera dance ballet radio
television newspaper magazine journal press podcast lecture course exam teacher student kindergarten playground toys puzzle
"""
#: They stand beside words of both lists alike, and so say nothing.
_BESIDE = "online best top my club world hub city zone now web star royal live pro plus first big new home".split()
_HOSTS = ("{beside}-{word}", "{word}{beside}", "{word}-{beside}", "{beside}{word}", "{word}")
_SUBDOMAINS, _ENDS = ("", "www.", "m.", "blog."), ("com", "net", "org")
_PATHS = ("/en/{n}", "/de/{n}.html", "/fr/{n}?page=2&ref=x", "/es/{n}/", "/")


def labelled_hosts() -> list[tuple[str, int]]:
    """(host label, 1 to block or 0 to allow): every word alone and in four compounds, in which the words beside it take turns."""
    out = []
    for text, label in ((_BLOCKED, 1), (_ALLOWED, 0)):
        for i, word in enumerate(text.split()):
            out += [
                (form.format(word=word, beside=_BESIDE[(i * 7 + k * 3) % len(_BESIDE)]), label) for k, form in enumerate(_HOSTS)
            ]
    return out


def labelled_urls(hosts: Sequence[tuple[str, int]] | None = None) -> list[tuple[str, int]]:
    """(url, label): each host once, subdomains, endings and paths taking turns; every sixth time an allowed host has a
    blocked word in its path and is to be blocked, or another allowed one and is not."""
    hosts = labelled_hosts() if hosts is None else hosts
    words = (_ALLOWED.split(), _BLOCKED.split())
    out = []
    for i, (host, label) in enumerate(hosts):
        path = _PATHS[i % len(_PATHS)].format(n=i)
        if not label and i % 3 == 0:
            label = i // 3 % 2
            path = f"/{words[label][i % len(words[label])]}{path}"
        out.append((f"{'https' if i % 2 else 'http'}://{_SUBDOMAINS[i // 2 % 4]}{host}.example.{_ENDS[i // 8 % 3]}{path}", label))
    return out


@dataclass(frozen=True)
class Rule:
    """Holds for ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/en/", "block"), Rule("example.com", "/en/7", "allow"), Rule("net", "/de/", "allow"),
    Rule("example.net", "/de/8", "block"), Rule("org", "/es/", "block"),
)


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    bias: float


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) as the expressions of ``host_of`` and ``path_of`` give them."""
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(str.maketrans(_UPPER, _LOWER)), m[2]) if m else ("", "")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def buckets(host: str, path: str) -> list[int]:
    """Buckets of a URL's n-grams, each as often as it occurs."""
    of = {"h": f"^{host}$", "p": path}
    return [zlib.crc32((k + of[k][i : i + n]).encode()) % BUCKETS for k, n in GRAMS for i in range(len(of[k]) - n + 1)]


def fit(labelled: Sequence[tuple[str, int]], steps: int = 1500, rate: float = 20.0, decay: float = 1e-5) -> Model:
    """Logistic regression by gradient descent over the whole labelled table; the bias is learned and not decayed."""
    counts = [np.unique(buckets(*split_url(url)), return_counts=True) for url, _ in labelled]
    at = np.concatenate([b for b, _ in counts]).astype(np.int64)
    value = np.concatenate([n / max(1.0, np.sqrt((n * n).sum())) for _, n in counts])
    row = np.repeat(np.arange(len(counts)), [len(b) for b, _ in counts])
    y = np.array([label for _, label in labelled], dtype=float)
    w, bias = np.zeros(BUCKETS), 0.0
    for _ in range(steps):
        z = np.clip(np.bincount(row, w[at] * value, len(y)) + bias, -30, 30)
        slope = (1 / (1 + np.exp(-z)) - y) / len(y)
        w -= rate * (np.bincount(at, slope[row] * value, BUCKETS) + decay * w)
        bias -= slope.sum()
    return Model(tuple(float(f"{x:.6g}") for x in w), float(f"{bias:.6g}"))


def score_of(model: Model, host: Column, path: Column) -> Column:
    """Probability that the URL is to be blocked: each row's counts have Euclidean length 1, as in ``fit``."""
    weights = F.split(F.lit(",".join(map(repr, model.weights))), ",").cast("array<double>")
    of = {"h": F.concat(F.lit("^"), host, F.lit("$")), "p": path}

    def bucket(kind: str):
        return lambda gram: F.crc32(F.concat(F.lit(kind), gram).cast("binary")) % BUCKETS

    grams = F.concat(
        *[F.transform(F.regexp_extract_all(of[k], F.lit(f"(?s)(?=({'.' * n}))"), F.lit(1)), bucket(k)) for k, n in GRAMS]
    )
    ordered = F.array_sort(grams)
    total = F.aggregate(ordered, F.lit(0.0), lambda a, b: a + F.element_at(weights, (b + 1).cast("int")))
    run = F.struct(F.lit(-1).cast("long").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("squares"))
    squares = F.aggregate(  # sum of squared counts: of a run of equal buckets the k-th adds 2k - 1
        ordered, run,
        lambda a, b: F.struct(
            b.cast("long").alias("last"),
            F.when(b == a["last"], a["run"] + 1.0).otherwise(F.lit(1.0)).alias("run"),
            (a["squares"] + 2.0 * F.when(b == a["last"], a["run"] + 1.0).otherwise(F.lit(1.0)) - 1.0).alias("squares"),
        ),
        lambda a: a["squares"],
    )
    return 1.0 / (1.0 + F.exp(-(total / F.sqrt(F.greatest(squares, F.lit(1.0))) + F.lit(model.bias))))


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(text of the longest rule that fits, its verdict), null where none does. Of equally long rules the first holds."""
    text = verdict = F.lit(None).cast("string")
    for r in reversed(sorted(rules, key=lambda r: -len(r.text))):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, model: Model | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row per input row.

    A null URL or one without ``://`` has an empty host and path and is still judged by the method. Repeated rows and
    null ids are kept; other columns are ignored. ``rules`` is a short list held in the plan.
    """
    model = model or fit(labelled_urls())
    parts = pick(pages, "page_id", "url").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    host, path = F.col("host"), F.col("path")
    scored = parts.withColumn("score", score_of(model, host, path))
    text, verdict = rule_of(rules, host, path)
    method = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "score")
