"""Format-preserving pseudonyms: personal numbers, dates and addresses permuted by a keyed Feistel network.

A value is replaced by another valid value of the same format (card numbers keep their length, separators and a right
Luhn digit, dates stay dates, addresses stay addresses, phone numbers keep their country, e-mail names keep their
character classes), by a permutation that depends on key and kind alone. So equal values stay linked across documents
whatever their spelling, different values never collide, and whoever holds the key can undo it.

Dates are permuted in six groups, by whether day and month have one digit and whether the day exceeds 12, the same for
all spellings. So each spelling can hold the pseudonym, and 02/28/2001, 2001-02-28 and 28 February 2001 stay one date.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import ipaddress
import re
import secrets
import warnings
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import row_chunks, tidy

#: The setting that holds the key.
KEY_SETTING = "spark.quorumrank.pseudonym.key"
#: Stands in for it in local mode; it is public and hides nothing from who reads this file.
DEMO_KEY = b"demonstration key"
ROUNDS = 10
#: Pseudonyms that a Python worker remembers.
CACHE_ROWS = 100_000
_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
# Country codes of one and two digits by E.164 (all others have three), and the months' English names.
_SHORT_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
_MONTHS = "January February March April May June July August September October November December".split()


@functools.cache
def _drawn_key(application: str) -> bytes:
    """A random key, the same for all that one application does. The driver alone holds it; it is never written."""
    warnings.warn(
        f"{KEY_SETTING} isn't set: pseudonyms of {application} get a random key, so other runs neither link with them nor undo them",
        stacklevel=3,
    )
    return secrets.token_bytes(32)


def key_of(spark: SparkSession) -> bytes:
    """The key in the session's configuration. Without one, local mode takes the public key, a cluster one drawn at random."""
    found = spark.conf.get(KEY_SETTING, None)
    if found:
        return found.encode()
    if not spark.sparkContext.master.startswith("local"):
        return _drawn_key(spark.sparkContext.applicationId)
    return DEMO_KEY


class Feistel:
    """A keyed permutation of range(n) for any n: unbalanced Feistel rounds over a * b >= n, walking cycles back into range."""

    def __init__(self, key: bytes, kind: str) -> None:
        self._seed = hashlib.blake2b(kind.encode(), key=hashlib.sha256(key).digest(), digest_size=32).digest()

    def _round(self, i: int, n: int, half: int, modulus: int) -> int:
        size = (modulus.bit_length() + 7) // 8 + 8
        said = f"{i}|{n}|{half}".encode()
        return int.from_bytes(hashlib.shake_256(self._seed + said).digest(size), "big") % modulus

    @staticmethod
    def _halves(n: int) -> tuple[int, int]:
        a = 1 << ((n - 1).bit_length() + 1) // 2
        return a, -(-n // a)

    def _once(self, x: int, n: int, undo: bool) -> int:
        a, b = self._halves(n)
        left, right = divmod(x, b)  # left < a, right < b
        for i in reversed(range(ROUNDS)) if undo else range(ROUNDS):
            sign = -1 if undo else 1
            if i % 2:
                right = (right + sign * self._round(i, n, left, b)) % b
            else:
                left = (left + sign * self._round(i, n, right, a)) % a
        return left * b + right

    def permute(self, x: int, n: int, undo: bool = False) -> int:
        if n < 2:
            return x
        x = self._once(x, n, undo)
        while x >= n:
            x = self._once(x, n, undo)
        return x


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in shape)


def _number(p: Feistel, digits: str, undo: bool) -> str:
    return str(p.permute(int(digits), 10 ** len(digits), undo)).zfill(len(digits)) if digits else digits


def _card(p: Feistel, text: str, undo: bool) -> str | None:
    d = _digits(text)
    if luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = _number(p, d[:-1], undo)
    return _refill(text, body + luhn_digit(body))


def _north_american(p: Feistel, digits: str, undo: bool) -> str:
    """Ten digits; those with an area and an exchange from 200 on, as numbers in use have, change places among themselves."""
    area, exchange, line = int(digits[:3]), int(digits[3:6]), int(digits[6:])
    if area >= 200 and exchange >= 200:
        x = p.permute(((area - 200) * 800 + exchange - 200) * 10_000 + line, 800 * 800 * 10_000, undo)
        x, line = divmod(x, 10_000)
        area, exchange = x // 800 + 200, x % 800 + 200
    else:  # areas below 200 with any exchange, then the others with exchanges below 200
        low = 200 * 1000
        x = (area * 1000 + exchange if area < 200 else low + (area - 200) * 200 + exchange) * 10_000 + line
        x, line = divmod(p.permute(x, (low + 800 * 200) * 10_000, undo), 10_000)
        area, exchange = divmod(x, 1000) if x < low else ((x - low) // 200 + 200, (x - low) % 200)
    return f"{area:03d}{exchange:03d}{line:04d}"


def _phone(p: Feistel, text: str, undo: bool) -> str | None:
    if (at := text.find("(0)")) > 0:  # the digit dialled inside a country isn't part of the number
        new = _phone(p, text[:at] + text[at + 3 :], undo)
        return new and new[:at] + "(0)" + new[at:]
    d = _digits(text)
    if text.startswith("+"):
        code = next((n for n in (1, 2) if d[:n] in _SHORT_CODES), 3)
    else:
        code = len(d) - 10  # with or without the 1 of a long-distance call
    own = d[code:]
    american = code == 0 or d[:code] == "1"
    if not 5 <= len(own) <= 15 - code or american and len(own) != 10:
        return None
    if text.isdigit() and (own[0] < "2" or own[3] < "2"):
        return None  # ten bare digits need an area and an exchange
    return _refill(text, d[:code] + (_north_american(p, own, undo) if american else _number(p, own, undo)))


def _ssn(p: Feistel, text: str, undo: bool) -> str | None:
    a, b, c = (int(x) for x in re.split(r"[- ]", text))
    if a in (0, 666) or a >= 900 or not b or not c:
        return None
    area = a - 1 - (a > 666)
    x = p.permute((area * 99 + b - 1) * 9999 + c - 1, 898 * 99 * 9999, undo)
    area, rest = divmod(x, 99 * 9999)
    b, c = divmod(rest, 9999)
    area += 1
    return f"{area + (area >= 666):03d}{text[3]}{b + 1:02d}{text[6]}{c + 1:04d}"


def _ipv4(p: Feistel, text: str, undo: bool) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    x = p.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, undo)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ipv6(p: Feistel, text: str, undo: bool) -> str | None:
    """Pseudonyms are written in the usual short form."""
    if len(re.findall("[0-9A-Fa-f]", text)) < 5 or not re.search("[0-9]", text):
        return None
    try:
        x = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    new = str(ipaddress.IPv6Address(p.permute(x, 1 << 128, undo)))
    return new.upper() if re.search("[A-F]", text) else new


def _iban_check(bban: str, country: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in bban + country + '00')) % 97:02d}"


def _iban(p: Feistel, text: str, undo: bool) -> str | None:
    flat = text.replace(" ", "")
    if not 15 <= len(flat) <= 34 or _iban_check(flat[4:], flat[:2]) != flat[2:4]:
        return None
    bban = _by_class(p, flat[4:], undo)
    new = iter(flat[:2] + _iban_check(bban, flat[:2]) + bban)
    return "".join(c if c == " " else next(new) for c in text)


def _letters(first: int, last: int, *without: int) -> str:
    return "".join(chr(c) for c in range(first, last + 1) if c not in without)


#: Letters and digits that take each other's place: ASCII, Latin-1, Greek and Cyrillic, in both cases.
_LOWER = (_letters(ord("a"), ord("z")), _letters(0xE0, 0xFE, 0xF7), _letters(0x3B1, 0x3C9, 0x3C2), _letters(0x430, 0x44F))
_CLASSES = ("0123456789", *_LOWER, *map(str.upper, _LOWER), "ßÿ")
_CLASS_OF = {c: (k, i) for k, members in enumerate(_CLASSES) for i, c in enumerate(members)}


def _by_class(p: Feistel, text: str, undo: bool) -> str:
    """Permutes all texts that have the same classes of characters in the same places."""
    n, x = 1, 0
    for c in text:
        if c in _CLASS_OF:
            k, i = _CLASS_OF[c]
            n *= len(_CLASSES[k])
            x = x * len(_CLASSES[k]) + i
    x, out = p.permute(x, n, undo), []
    for c in reversed(text):
        if c in _CLASS_OF:
            members = _CLASSES[_CLASS_OF[c][0]]
            x, i = divmod(x, len(members))
            c = members[i]
        out.append(c)
    return "".join(reversed(out))


def _email(p: Feistel, text: str, undo: bool) -> str | None:
    """Names that differ in case alone stay linked; each place keeps its case."""
    name, _, host = text.rpartition("@")
    upper = [c in _CLASS_OF and c.lower() != c for c in name]
    new = _by_class(p, "".join(c.lower() if u else c for c, u in zip(name, upper, strict=True)), undo)
    return "".join(c.upper() if u else c for c, u in zip(new, upper, strict=True)) + f"@{host}"


@functools.cache
def _date_groups() -> dict[int, tuple[tuple[int, ...], int]]:
    """For each day of the range the days that it changes places with, and its own place among them."""
    groups: dict[tuple[int, bool], list[int]] = {}
    for n in range(_FIRST_DAY.toordinal(), _LAST_DAY.toordinal() + 1):
        day = datetime.date.fromordinal(n)
        groups.setdefault(((day.day > 9) + (day.day > 12), day.month > 9), []).append(n)
    out = {}
    for members in map(tuple, groups.values()):
        out.update({n: (members, i) for i, n in enumerate(members)})
    return out


def _other_day(p: Feistel, year: int, month: int, day: int, undo: bool) -> datetime.date | None:
    try:
        found = _date_groups().get(datetime.date(year, month, day).toordinal())
    except ValueError:
        return None
    if found is None:
        return None
    members, i = found
    return datetime.date.fromordinal(members[p.permute(i, len(members), undo)])


def _date(p: Feistel, text: str, undo: bool) -> str | None:
    """Year first, day first, or month first where only that is a date."""
    parts = re.split(r"[-/.]", text)
    order = "ymd" if len(parts[0]) == 4 else "mdy" if "." not in text and int(parts[1]) > 12 else "dmy"
    at = dict(zip(order, map(int, parts), strict=True))
    new = _other_day(p, at["y"], at["m"], at["d"], undo)
    if new is None:
        return None
    values = {"y": new.year, "m": new.month, "d": new.day}
    written = iter([str(values[k]).zfill(len(part)) for k, part in zip(order, parts, strict=True)])
    return re.sub(r"\d+", lambda _: next(written), text)


def _named_date(p: Feistel, text: str, undo: bool) -> str | None:
    """A day, a month's name (or its first three letters) and a year; of short names May is undone to the whole name."""
    name = re.search(r"[A-Za-z]+", text)[0]
    month = next(i for i, m in enumerate(_MONTHS, 1) if m[:3].lower() == name[:3].lower())
    day, year = (int(x) for x in re.findall(r"\d+", text))
    new = _other_day(p, year, month, day, undo)
    if new is None:
        return None
    said = _MONTHS[new.month - 1]
    said = said[:3] if len(name) == 3 and name.lower() != "may" else said
    said = said.upper() if name.isupper() else said.lower() if name.islower() else said
    written = iter([str(new.day).zfill(len(re.findall(r"\d+", text)[0])), str(new.year)])
    return re.sub(r"[A-Za-z]+|\d+", lambda m: said if m[0].isalpha() else next(written), text)


_NO_MORE = r"(?!\w|-\d)"
#: A digit, a plus or a bracket that no word, number or sign of one goes before.
_START = re.compile(r"(?<![\w+])(?<!\d[.\-/])(?=[0-9+(])", re.ASCII)
#: What numbers consist of; none goes beyond such a stretch.
_RUN = re.compile(r"[0-9+(][0-9 ().+/-]*", re.ASCII)
#: Readings tried at a start, the first valid one is taken. Shapes that leave no doubt go before those that depend on a
#: check digit, and usual groups of a card before longer ones, so that a pseudonym is read as the original was.
_READINGS = [(k, re.compile(p, re.ASCII)) for k, p in (
    ("ipv4", r"\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"),
    ("date", r"(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?:(?=T\d\d:)|(?!\w|[-/.]\d))"),
    ("ssn", rf"\d{{3}}([- ])\d\d\1\d{{4}}{_NO_MORE}"),
    ("phone", rf"(?:\+?1[ .-]?)?(?:\(\d{{3}}\)[ ]?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}{_NO_MORE}"),
    ("phone", rf"\+\d{{7,15}}{_NO_MORE}"),
    *(
        ("phone", rf"\+\d{{1,3}}(?:[ .-]?\(\d{{1,5}}\)|[ .-]\d{{1,9}})(?:[ .-]?\d{{2,9}}){{{n}}}{_NO_MORE}")
        for n in range(6, -1, -1)
    ),
    ("card", rf"\d{{4}}(?:([ -])\d{{4}}\1\d{{4}}\1\d{{4}}|([ -])\d{{6}}\2\d{{5}}){_NO_MORE}"),
    *(("card", rf"\d(?:[ -]?\d){{{n - 1}}}{_NO_MORE}") for n in range(19, 12, -1)),
    ("phone", rf"\d{{10}}{_NO_MORE}"),
)]
#: Times that the values of a stretch are permuted until it reads like the original; beyond, hiding goes before undoing.
_WALKS = 1_000
_EMAIL = re.compile(
    r"(?<![\w.%+-])[\w%+-]+(?:\.[\w%+-]+)*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", re.ASCII)
_IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])", re.ASCII)
_NAME = rf"(?:{'|'.join(f'{m[:3]}(?:{m[3:]})?' for m in _MONTHS)})"
_NAMED_DATE = re.compile(rf"(?<![\w-])(?:\d{{1,2}}\.? {_NAME}|{_NAME} \d{{1,2}}),? \d{{4}}(?!\w|-\d)", re.ASCII | re.IGNORECASE)
_DIGIT = re.compile(r"[0-9]")
_ACTS: dict[str, Callable[[Feistel, str, bool], str | None]] = {
    "ipv4": _ipv4, "ipv6": _ipv6, "date": _date, "named date": _named_date, "ssn": _ssn, "card": _card, "phone": _phone,
    "email": _email, "iban": _iban,
}
KINDS = ("ipv4", "ipv6", "date", "ssn", "card", "phone", "email", "iban")


class Pseudonymiser:
    """Replaces the validated values of a text, or puts the originals back."""

    def __init__(self, key: bytes, undo: bool = False) -> None:
        self._permutations = {k: Feistel(key, k) for k in KINDS}
        self._permutations["named date"] = self._permutations["date"]
        self._undo = undo
        self._known: dict[tuple[str, str], str | None] = {}

    def value(self, kind: str, text: str) -> str | None:
        """The pseudonym, or None where the text isn't a valid value of its kind."""
        at = (kind, text)
        if at not in self._known:
            if len(self._known) >= CACHE_ROWS:
                self._known.clear()
            self._known[at] = _ACTS[kind](self._permutations[kind], text, self._undo)
        return self._known[at]

    def _read(self, text: str, at: int, end: int) -> list[tuple[int, int, str]]:
        """(start, end, kind) of the valid numbers of a stretch; after a start without one the next start is tried."""
        out: list[tuple[int, int, str]] = []
        while (start := _START.search(text, at)) and start.start() < end:
            at = start.start()
            for kind, pattern in _READINGS:
                m = pattern.match(text, at)
                if m and m.end() <= end and self.value(kind, m[0]) is not None:
                    out.append((at, m.end(), kind))
                    at = m.end()
                    break
            else:
                at += 1
        return out

    def _run(self, text: str, start: int, end: int) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym) of the numbers of a stretch.

        Beside other digits a pseudonym may be read in another way than its original; then all values of the stretch are
        permuted again until they are read in the same way, which undoing does too.
        """
        before, after = text[max(0, start - 2) : start], text[end : end + 4]
        spans = self._read(text, start, end)
        if not spans:
            return []
        kinds, values = [k for _, _, k in spans], [text[s:e] for s, e, _ in spans]
        gaps = [text[a:b] for a, b in zip([start, *[e for _, e, _ in spans]], [*[s for s, _, _ in spans], end], strict=True)]
        for _ in range(_WALKS):
            values = [self.value(k, v) or v for k, v in zip(kinds, values, strict=True)]
            new, places = before + gaps[0], []
            for k, v, gap in zip(kinds, values, gaps[1:], strict=True):
                places.append((len(new), len(new) + len(v), k))
                new += v + gap
            if self._read(new + after, len(before), len(new)) == places:
                break
        return [(s, e, k, v) for (s, e, k), v in zip(spans, values, strict=True)]

    def text(self, text: str | None) -> tuple[str | None, dict[str, int]]:
        """(the text with pseudonyms, number of values by kind)."""
        counts: dict[str, int] = {}
        if not text or not _DIGIT.search(text) and "@" not in text:
            return text, counts
        taken: list[tuple[int, int, str]] = []
        found = [("email", m) for m in _EMAIL.finditer(text)] if "@" in text else []
        found += [("ipv6", m) for m in _IPV6.finditer(text)] if ":" in text else []
        found += [(kind, m) for kind, pattern in (("iban", _IBAN), ("named date", _NAMED_DATE)) for m in pattern.finditer(text)]
        end = 0
        for kind, m in sorted(found, key=lambda x: x[1].start()):
            new = self.value(kind, m[0]) if m.start() >= end else None
            if new is not None:
                end = m.end()
                taken.append((m.start(), end, new))
                kind = kind.rpartition(" ")[2]
                counts[kind] = counts.get(kind, 0) + 1
        edges = [0, *[x for s, e, _ in sorted(taken) for x in (s, e)], len(text)]
        for lo, hi in zip(edges[::2], edges[1::2], strict=True):
            for m in _RUN.finditer(text, lo, hi):
                for start, end, kind, new in self._run(text, m.start(), m.end()):
                    taken.append((start, end, new))
                    counts[kind] = counts.get(kind, 0) + 1
        if not taken:
            return text, counts
        out, at = [], 0
        for s, e, new in sorted(taken):
            out += [text[at:s], new]
            at = e
        return "".join([*out, text[at:]]), counts


def pseudonymise(docs: DataFrame, key: bytes | None = None, undo: bool = False, counts: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; with ``counts`` also one long column ``n_<kind>`` for each kind.

    Runs in one pass without a shuffle. Null and empty texts stay as they are, texts are taken whole, rows are
    independent of each other and equal rows come out equal. Other columns pass unchanged, whatever their names;
    count columns replace columns of the same name. Without ``key`` that of the session's configuration is taken.
    """
    key = key or key_of(docs.sparkSession)
    extra = [f"n_{k}" for k in KINDS] if counts else []
    names = [c for c in docs.columns if c not in extra]
    docs = docs.select(*[docs[f"`{c}`"] for c in names])
    at_text = names.index("text")

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pseudonymiser(key, undo)
        for batch, lo, hi in ((b, lo, hi) for b in batches for lo, hi in row_chunks(b.column(at_text))):
            columns = [c.slice(lo, hi - lo) for c in batch.columns]
            done = [p.text(x) for x in columns[at_text].to_pylist()]
            columns[at_text] = pa.array([x for x, _ in done], pa.string())
            columns += [pa.array([c.get(k, 0) for _, c in done], pa.int64()) for k in (KINDS if counts else ())]
            yield pa.RecordBatch.from_arrays(columns, [*names, *extra])

    fields = [*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in extra]]
    return docs.mapInArrow(tidy(act), T.StructType(fields))


def pseudonymised_documents(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """(doc_id, text, n_values, n_<kind>...) of every document."""
    out = pseudonymise(docs.select(docs["doc_id"], docs["text"]), key, counts=True)
    return out.withColumn("n_values", sum((F.col(f"n_{k}") for k in KINDS), F.lit(0).cast("long")))
