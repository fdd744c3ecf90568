"""Operators on single texts against plain Python, round trips and held-out rows."""

import datetime
import hashlib
import ipaddress
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quorumrank.llm import context_tree, fingerprint, packing, piece_codec, pii, toxicity, word_tokens, wordhash

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def test_word_hashes_follow_words():
    texts = ["A b  c", "", None, "a B c\nd", "\x1cx", " lead"]
    hashes, at = wordhash.words(pa.array(texts))
    found = [hashes[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for t in texts]
    assert [len(f) for f in found] == [len(w) for w in words] and found[0] == found[3][:3]
    assert len({h for f in found for h in f}) == len({w for ws in words for w in ws})


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation(n):
    f = pii.Feistel(b"k", "t")
    image = [f.permute(i, n) for i in range(n)]
    assert sorted(image) == list(range(n)) and [f.permute(x, n, undo=True) for x in image] == list(range(n))


@pytest.mark.parametrize("text, kinds", [
    ("call +1 (788) 555-0037 now", {"phone": 1}), ("4111 1111 1111 1111 and 4111111111111111", {"card": 2}),
    ("order 4111111111111112", {}), ("ip 65.95.187.82, v1.2.3.4.5", {"ipv4": 1}), ("999.1.1.1", {}),
    ("born 1980-02-29 or 31/12/1999 or 02/28/2001 or 05.06.1970", {"date": 4}), ("1981-02-29", {}),
    ("123-45-6789 000-12-3456", {"ssn": 1}), ("élan.47@mail4.example.com", {"email": 1}),
    ("DE89 3704 0044 0532 0130 00 end", {"iban": 1}),
    ("DE88 3704 0044 0532 0130 00 end", {}), ("plain words", {}), ("", {}), (None, {}),
])
def test_pseudonyms(text, kinds):
    hide, show = pii.Pseudonymiser(b"k"), pii.Pseudonymiser(b"k", undo=True)
    new, counts = hide.text(text)
    assert counts == kinds and show.text(new)[0] == text and hide.text(text)[0] == new and pii.Pseudonymiser(b"other").text(text)[0] != new or not kinds
    assert text is None or re.sub(r"\w", "x", new).count("x") == re.sub(r"\w", "x", text).count("x") or "ipv4" in kinds
    assert hide.text(new)[1] == kinds  # the pseudonyms are valid values of the same kinds


@pytest.mark.parametrize("text, kinds", [
    ("4111 1111 1111 1111 12/25", {"card": 1}), ("2 4111 1111 1111 1111", {"card": 1}), ("4111 1111 1111 1111 123", {"card": 1}),
    ("555 123 4567 555 123 4567", {"phone": 2}),
    ("3782 822463 10005 4111-1111-1111-1111 7", {"card": 2}),
    ("7 555 123 4567 1980-02-29 12 4111111111111111", {"phone": 1, "date": 1, "card": 1}),
])
def test_pseudonyms_beside_other_numbers(text, kinds):
    for n in range(60):
        hide, show = (pii.Pseudonymiser(b"k%d" % n, undo=undo) for undo in (False, True))
        new, counts = hide.text(text)
        assert counts == kinds and new != text and show.text(new) == (text, kinds)


def test_equal_values_stay_linked():
    a, b = (pii.Pseudonymiser(b"k").text(t)[0] for t in ("x 4111111111111111", "y 4111-1111-1111-1111"))
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)


def spellings(day):
    """A date in every way of writing that is read as that date."""
    y, m, d = day.year, day.month, day.day
    out = [
        f"{y}-{m:02d}-{d:02d}", f"{y}/{m:02d}/{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{d}.{m}.{y}", f"{d:02d}/{m:02d}/{y}",
        f"{d}/{m}/{y}", f"{y}-{m:02d}-{d:02d}T10:00:00Z", f"{d} {day:%B} {y}", f"{day:%B} {d}, {y}"
    ]
    return out + ([f"{m:02d}/{d:02d}/{y}", f"{m}/{d}/{y}"] if d > 12 else [])


def test_every_day_of_a_century_in_all_spellings():
    hide, show, seen = pii.Pseudonymiser(b"k"), pii.Pseudonymiser(b"k", undo=True), {}
    first = datetime.date(1950, 1, 1)
    for n in range(36525):
        day = first + datetime.timedelta(n)
        new = datetime.date.fromisoformat(hide.text(day.isoformat())[0])
        assert seen.setdefault(new, day) == day
        if n % 7 == 0:
            for said, other in zip(spellings(day), spellings(new), strict=True):
                text, counts = hide.text(f"on {said}.")
                assert (text, counts) == (f"on {other}.", {"date": 1}) and show.text(text)[0] == f"on {said}."


@pytest.mark.parametrize("same", [
    ["2125550199", "(212) 555-0199", "212-555-0199", "212.555.0199", "+1 212 555 0199", "+12125550199", "1-212-555-0199"],
    ["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "+44-20-7946-0958"],
    ["+33 1 42 68 53 00", "+33142685300"], ["+49 30 901820", "+4930901820"], ["123-45-6789", "123 45 6789"],
    ["(123) 456-7890", "+1 123 456 7890"],
])
def test_numbers_stay_linked_in_all_spellings(same):
    hide, show, digits = pii.Pseudonymiser(b"k"), pii.Pseudonymiser(b"k", undo=True), set()
    for text in same:
        new, counts = hide.text(f"at {text}, or")
        assert sum(counts.values()) == 1 and show.text(new)[0] == f"at {text}, or" and new != f"at {text}, or"
        assert new[: 6] == f"at {text}"[: 6] if text.startswith("+4") or text.startswith("+3") else True
        said = re.sub(r"\D", "", new.replace("(0)", ""))
        digits.add(said[-10:] if text[0] != "+" or text[1] == "1" else said)
    assert len(digits) == 1


def test_addresses_stay_linked():
    hide, show = pii.Pseudonymiser(b"k"), pii.Pseudonymiser(b"k", undo=True)
    a, b = hide.text("A.Bc@x.com a.bc@x.com")[0].split()
    assert a != b and a.lower() == b and show.text(f"{a} {b}")[0] == "A.Bc@x.com a.bc@x.com"
    a, b = hide.text("2001:db8::1 2001:0db8:0:0::1")[0].split()
    assert a == b and ipaddress.IPv6Address(a) and show.text(a)[0] == "2001:db8::1"
    for text in ("12:30:45", "std::vector", "a::b", "10:20", "1234567890", "0000000000", "May 2021", "31/02/2020", "+123"):
        assert hide.text(text) == (text, {})


def test_two_kinds_of_ten_digits_change_places_among_themselves():
    rng = np.random.default_rng(6)
    p = pii.Feistel(b"k", "phone")
    for x in rng.integers(0, 10**10, 3000).tolist():
        digits = f"{x:010d}"
        new = pii._north_american(p, digits, undo=False)
        assert pii._north_american(p, new, undo=True) == digits and (min(new[0], new[3]) >= "2") == (
            min(digits[0], digits[3]) >= "2"
        )


def test_counts_equal_an_independent_reading(spark, data):
    """Kinds that the documents hold, found by looking at words instead of patterns."""
    docs = spark.read.parquet(f"{data.replace('0.001', '0.01')}/documents.parquet")
    got = {r.doc_id: r for r in pii.pseudonymised_documents(docs).collect()}
    for d in docs.collect():
        words = [re.sub(r"^\W+|\W+$", "", w) for w in (d.text or "").split()]
        emails = [w for w in words if w.count("@") == 1 and "." in w.partition("@")[2]]
        addresses = 0
        for w in words:
            try:
                addresses += isinstance(ipaddress.ip_address(w), ipaddress.IPv4Address)
            except ValueError:
                pass
        cards = [
            w
            for w in (x.replace("-", "") for x in words) if w.isdigit() and 13 <= len(w) <= 19 and sum(
                sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(w))
            ) % 10 == 0
        ]
        r = got[d.doc_id]
        assert (r.n_email, r.n_ipv4) == (len(emails), addresses) and r.n_card >= len(cards)
        assert not any(w in r.text for w in {*emails, *cards} if len(w) > 8)


def test_key_comes_from_the_configuration(spark):
    df = spark.createDataFrame([("x 4111111111111111",)], "text string")
    try:
        spark.conf.set(pii.KEY_SETTING, "a secret")
        assert pii.pseudonymise(df).first().text == pii.Pseudonymiser(b"a secret").text("x 4111111111111111")[0]
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    assert pii.pseudonymise(df).first().text == pii.Pseudonymiser(pii.DEMO_KEY).text("x 4111111111111111")[0]


def test_pseudonyms_of_odd_rows(odd_documents, no_documents):
    out = pii.pseudonymise(odd_documents)
    assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    rows = {r.doc_id: r for r in pii.pseudonymised_documents(odd_documents).collect()}
    assert rows[9].n_values == 3 and rows[9].text.endswith(tuple("0123456789")) and "a.b@c.com" not in rows[9].text and rows[3].text is None and rows[6].n_values == 0
    assert [r.text for r in pii.pseudonymise(out, undo=True).collect()] == [r.text for r in odd_documents.collect()]
    assert pii.pseudonymised_documents(no_documents).count() == 0


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(
        "/root/testdata/sf0.1/documents.parquet"
    ), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = toxicity.toxicity_scores(docs, labels)
    assert out.count() == docs.count()
    rows = out.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    pos, neg = (np.array([r.score for r in rows if r.toxic == y]) for y in (1, 0))
    assert (pos[:, None] > neg[None]).mean() > 0.9 and np.mean([r.predicted == r.toxic for r in rows]) > 0.96
    got = {r.doc_id: (r.held_out, r.predicted == (r.score >= 0.5)) for r in out.collect()}
    assert all(v == (zlib.crc32(str(k).encode()) % 5 == 0, True) for k, v in got.items())


def test_toxicity_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(1, 1, 1, "x"), (1, 0, 0, "x"), (None, 1, 1, "x"), (4, None, None, "x")],
        "doc_id long, quality int, toxic int, text string"
    )
    out = toxicity.toxicity_scores(odd_documents, labels).collect()
    assert len(out) == odd_documents.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.drop_toxic(odd_documents, labels).columns == odd_documents.columns
    assert toxicity.toxicity_scores(no_documents, labels.limit(0)).count() == 0
    assert toxicity.toxicity_scores(odd_documents, labels.limit(0)).where("predicted = 1").count() == 0


def test_non_negative_risk_learns_from_positives_alone():
    rng = np.random.default_rng(0)
    noise = lambda: rng.choice(1000, 30, replace=False).astype(np.int32)
    positive = [np.unique(np.append(noise(), 5000)).astype(np.int32) for _ in range(100)]
    unlabelled = [noise() for _ in range(450)] + [np.unique(np.append(noise(), 5000)).astype(np.int32) for _ in range(50)]
    m = toxicity.fit_nnpu(positive, unlabelled, prior=0.1)
    assert m.bias + m.weights[5000] > 0 > m.bias


def test_pieces_equal_the_library(documents):
    c = piece_codec.Codec(PIECES)
    texts = [r.text for r in documents.limit(60).collect()] + [
        "", " ", "  a  b", "a\n\nb  c▁d", "日本語 x😀", "é́ \t z   ", "▁▁x", "\x00a", "x" * 5000
    ]
    for t in texts:
        ids, spans = c.encode(t)
        found = c.processor.encode(t, return_type="proto").pieces
        assert ids.tolist() == c.processor.encode(t, add_eos=True) and c.decode(ids) == c.processor.decode(ids.tolist())
        assert (np.diff(spans.ravel()) >= 0).all() and (not len(spans) or (spans[0, 0] == 0 and spans[-1, 1] == len(t.encode())))
        assert len(found) == len(spans)


def test_round_trip_digests(odd_documents, no_documents):
    c = piece_codec.Codec(PIECES)
    got = piece_codec.round_trip(odd_documents, PIECES).collect()
    for r, d in zip(got, odd_documents.collect(), strict=True):
        ids = c.processor.encode(d.text or "", add_eos=True)
        assert (r.doc_id, r.n_tokens) == (d.doc_id, len(ids)) and r.ids_sha256 == hashlib.sha256(
            " ".join(map(str, ids)).encode()
        ).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(c.processor.decode(ids).encode()).hexdigest()
    encoded = piece_codec.encode(odd_documents, PIECES)
    assert {
        r.doc_id: r.text for r in piece_codec.decode(encoded, PIECES).collect()
    }[1].strip() == "the quick brown fox jumps over the lazy dog"
    assert piece_codec.round_trip(no_documents, PIECES).count() == 0


def compiled(pairs):
    """A character map in the compiled form: a double array, placed node by node, and the replacements."""
    texts, at = b"", {}
    for key, value in pairs.items():
        at[key], texts = len(texts), texts + value + b"\0"
    units, free = {0: 0}, 1
    tree = {}
    for key in pairs:
        node = tree
        for b in key:
            node = node.setdefault(b, {})
        node[None] = at[key]
    used = {0}

    def place(node, here):
        children = [b for b in node if b is not None]
        offset = 1
        while (here ^ offset) in used or any((here ^ offset ^ b) in used for b in children) or offset >= 1 << 21:
            offset += 1
        used.update([here ^ offset, *[here ^ offset ^ b for b in children]])
        units[here] = units.get(here, 0) | offset << 10 | ((1 << 8) if None in node else 0)
        if None in node:
            units[here ^ offset] = node[None] | 1 << 31
        for b in children:
            units[here ^ offset ^ b] = b
        for b in children:
            place(node[b], here ^ offset ^ b)

    place(tree, 0)
    size = (max(units) | 255) + 1
    array = struct.pack(f"<{size}I", *[units.get(i, 1 << 31) for i in range(size)])
    return struct.pack("<I", len(array)) + array + texts


class Spec:
    def __init__(self, blob, prefix=True, trim=True):
        self.precompiled_charsmap, self.add_dummy_prefix, self.remove_extra_whitespaces, self.escape_whitespaces = blob, prefix, trim, True


def test_character_map_longest_prefix_and_offsets():
    n = piece_codec.Normaliser(
        Spec(compiled({"ﬁ".encode(): b"fi", b"ab": b"X", b"abc": b"YZ", "\u3000".encode(): b" ", b"q": b""}))
    )
    text = "  abcab\u3000 ﬁqé ".encode()
    out, where = n(text)
    assert out.decode() == "▁YZX▁fié"
    assert where.tolist() == [2, 2, 2, 2, 2, 5, 7, 7, 7, 11, 11, 15, 15, 17]
    assert n(b"") == (b"", pytest.approx([0])) and n(b"   ")[0] == b""


@pytest.mark.parametrize(
    "changes",
    [
        {}, {"add_dummy_prefix": False}, {"remove_extra_whitespaces": True},
        {"escape_whitespaces": True, "remove_extra_whitespaces": True, "add_dummy_prefix": False}, {"byte_fallback": False}
    ]
)
def test_compiled_map_equals_the_library(tmp_path, changes):
    """Ids and the original bytes of each piece, with a character map that the library applies itself."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.precompiled_charsmap = compiled(
        {
            "\ufb01".encode(): b"fi", b"ab": b"x", b"abc": b"yz", "\u3000".encode(): b" ", b"Q": b"q",
            "e\u0301".encode(): "\u00e9".encode(), "\u2026".encode(): b"..."
        }
    )
    for k, v in changes.items():
        setattr(proto.trainer_spec if k == "byte_fallback" else proto.normalizer_spec, k, v)
    if not proto.trainer_spec.byte_fallback:
        for p in proto.pieces:
            p.type = 5 if p.type == 6 else p.type  # a byte's piece becomes unused
    path = str(tmp_path / "m.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    c = piece_codec.Codec(path)
    for t in [
        "", " ", "  abcab\u3000 \ufb01Q\u00e9 ", "e\u0301 caf\u00e9 ab abc abcabc", "wait\u2026 no\u2026", "a  b   c",
        "plain words here", "\u65e5\u672c\u8a9e\u3000x \U0001f600\U0001f600", "Qabc " * 50
    ]:
        ids, spans = c.encode(t)
        found = c.processor.encode(t, return_type="proto").pieces
        assert ids[:-1].tolist() == [p.id for p in found] and c.decode(ids) == c.processor.decode(ids.tolist())
        data = t.encode()
        assert [data[a:b] for a, b in spans] == [
            p.surface_as_bytes if hasattr(p, "surface_as_bytes") else p.surface.encode() for p in found
        ]


def test_whole_table_equals_the_library(documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in piece_codec.round_trip(documents, PIECES).collect():
        ids = library.encode(texts[r.doc_id] or "", add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_context_tree_base_and_probability(documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r for r in context_tree.scores(documents).collect()}
    counts = Counter()
    for k, t in docs:
        if zlib.crc32(str(k).encode()) % 7 != 2:
            counts.update((t or "").encode().lower().split())
            counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    for k, t in docs:
        words = [*(t or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        r = got[k]
        assert r.base_score == pytest.approx(base) and (r.n_tokens, r.n_known, r.train_tokens) == (
            len(words), sum(w in counts for w in words), n
        ) and r.score < 0
        assert r.held_out == (zlib.crc32(str(k).encode()) % 7 == 2)


def test_head_and_tail_counts_agree(documents, monkeypatch):
    whole = {r.doc_id: (r.n_known, round(r.base_score, 6)) for r in context_tree.scores(documents).collect()}
    monkeypatch.setattr(context_tree, "HEAD_WORDS", 50)
    assert {r.doc_id: (r.n_known, round(r.base_score, 6)) for r in context_tree.scores(documents).collect()} == whole


@pytest.mark.parametrize("most, shard", [(0, 4_096), (1_000_000, 500), (300, 20)])
def test_scores_do_not_depend_on_what_is_broadcast_or_cut(documents, monkeypatch, most, shard):
    rows = documents.select("doc_id", "text").collect()
    keys, counts = np.unique(
        np.concatenate(
            [context_tree.grams(context_tree.tokens(r.text)) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
        ),
        return_counts=True
    )
    tree = context_tree.build_tree(keys, counts)
    monkeypatch.setattr(context_tree, "MAX_GRAMS", most)
    monkeypatch.setattr(context_tree, "_SHARD_ROWS", 5_000)
    monkeypatch.setattr(context_tree, "SHARD_LEAST", shard)
    monkeypatch.setattr(context_tree, "SHARD_MOST", shard)
    got = {r.doc_id: r.score for r in context_tree.scores(documents).collect()}
    assert got == {
        r.doc_id: pytest.approx(tree.log2(context_tree.grams(context_tree.tokens(r.text))).sum() * math.log10(2), rel=1e-6)
        for r in rows
    }


def test_scores_equal_the_recursive_definition(spark, monkeypatch):
    """Of a whole table, with no string broadcast and contexts cut at every depth."""
    monkeypatch.setattr(context_tree, "MAX_GRAMS", 5)
    monkeypatch.setattr(context_tree, "SHARD_LEAST", 2)
    monkeypatch.setattr(context_tree, "SHARD_MOST", 2)
    texts = {
        i: t
        for i,
        t in enumerate(
            [
                "abracadabra abra cad", "Abra kadabra", "abracadabra", "zz top", "", None, "the abbey \u00e9t\u00e9",
                "abra abra abra"
            ]
        )
    }
    depth, padded = context_tree.DEPTH, {}
    for k, t in texts.items():
        padded[k] = b"\n" * depth + b" ".join((t or "").encode().lower().split()) + b"\n"
    strings = lambda k: [padded[k][i : i + depth + 1] for i in range(len(padded[k]) - depth)]
    trained = [k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    want = reference_bits([s for k in trained for s in strings(k)], depth)
    got = {
        r.doc_id: r.score
        for r in context_tree.scores(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    }
    assert 0 < len(trained) < len(texts) and got == {
        k: pytest.approx(sum(map(want, strings(k))) * math.log10(2), rel=1e-5) for k in texts
    }


def reference_bits(strings, depth):
    """log2 P of each string's last byte by the recursive definition."""
    tables = [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]
    for s in strings:
        for d in range(depth + 1):
            ctx, x = s[len(s) - 1 - d : -1], s[-1]
            for bit in range(8):
                tables[d][ctx, 1 << bit | x >> (8 - bit)][x >> (7 - bit) & 1] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)
    def weighted(d, ctx, node):
        own = kt(*tables[d][ctx, node])
        if d == depth:
            return own, 1.0
        split = sum(weighted(d + 1, bytes([c]) + ctx, node)[0] for c in range(256) if (bytes([c]) + ctx, node) in tables[d + 1])
        total = np.logaddexp(own, split) + math.log(0.5)
        return total, math.exp(own + math.log(0.5) - total)
    def bit_probability(s, bit, want):
        left, settled, x = 1.0, 0.0, s[-1]
        for d in range(depth + 1):
            key = (s[len(s) - 1 - d : -1], 1 << bit | x >> (8 - bit))
            if key not in tables[d]:
                break
            a, b = tables[d][key]
            p, share = (b + 0.5) / (a + b + 1), weighted(d, *key)[1]
            last = settled + left * p
            settled, left = settled + left * share * p, left * (1 - share)
        else:
            d += 1
        one = last if d else 0.5
        return one if want else 1 - one
    return lambda s: sum(math.log2(bit_probability(s, bit, s[-1] >> (7 - bit) & 1)) for bit in range(8))


def test_tree_equals_definition():
    depth = 2
    text = b"\n\nabracadabra abra cad\n"
    strings = [text[i : i + 3] for i in range(len(text) - 2)]
    number = lambda s: int.from_bytes(s, "big")
    keys, counts = np.unique(np.array([number(s) for s in strings], dtype=np.uint64), return_counts=True)
    tree, want = context_tree.build_tree(keys, counts.astype(np.int64), depth), reference_bits(strings, depth)
    asked = [*set(strings), b"abz", b"zza", b"zzz", b"rab"]
    assert tree.log2(np.array([number(s) for s in asked], dtype=np.uint64)) == pytest.approx([want(s) for s in asked], abs=1e-4)
    every = np.array([number(b"br" + bytes([x])) for x in range(256)], dtype=np.uint64)
    assert (2 ** tree.log2(every)).sum() == pytest.approx(1, abs=1e-4)


def test_context_tree_odd_rows(odd_documents, no_documents):
    out = context_tree.scores(odd_documents).collect()
    assert len(out) == odd_documents.count() and {
        r.n_tokens for r in out if r.doc_id in (3, 4, 5)
    } == {1} and all(r.score < 0 for r in out)
    assert context_tree.scores(no_documents).count() == 0


def unpacked(rows):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    return sequences, pieces


def test_packing_keeps_every_id(documents, odd_documents, no_documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    rows = packing.pack_documents(documents, WORDS).collect()
    sequences, pieces = unpacked(rows)
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert (end == 2048 or end & (end - 1) == 0) and len(spans) <= packing.SEQUENCE_SEGMENTS
    for d in documents.collect():
        ids, at = [*t.encode(d.text or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(pieces[d.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(
                np.array(ids[at : at + r.length], "<u4").tobytes()
            )
            at += r.length
        assert at == len(ids)
    odd = packing.pack_documents(odd_documents, WORDS).groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("t"), F.count_if(F.col("start") == 0).alias("k")
    ).collect()
    assert all(r.n == r.t * r.k for r in odd) and {r.doc_id for r in odd if r.t == 1} == {3, 4, 5}
    assert packing.pack_documents(no_documents, WORDS).count() == 0


def test_plain_pieces_go_to_the_model_at_once():
    """With the same ids as the whole tokenizer's, which plain texts need no more; others still go through it."""
    from tokenizers import Tokenizer

    t, w, rng = Tokenizer.from_file(WORDS), word_tokens.WordTokens(WORDS), np.random.default_rng(8)
    plain = [c for c in map(chr, range(256)) if word_tokens._PLAIN.fullmatch(c)]
    texts = ["".join(rng.choice(plain, int(n))) for n in rng.integers(0, 400, 300)]
    texts += ["".join(rng.choice(list("aeélßÄtsr'd. 1"), int(n))) for n in rng.integers(0, 400, 300)]
    ids = lambda x: np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
    odd = ["x\x00y \x1f", "été 日本語 naïve\u0301", "it's <|endoftext|> a", "\xa0a\x85b×2÷3ª", "İstanbul Straße ẞ", "a" * 5000]
    assert w.encode(texts + odd + [None]) == [*map(ids, texts + odd), b""]
    w = word_tokens.WordTokens(WORDS)
    w._tokenizer = None
    assert w.encode(texts) == [*map(ids, texts)]


@pytest.mark.parametrize("shortest, longest", [(1, 1), (3, 3), (5, 5), (10, 10), (15, 15), (1, 40), (1, 4000)])
def test_short_texts_are_packed_without_padding(shortest, longest):
    rng = np.random.default_rng(4)
    lengths = rng.integers(shortest, longest + 1, 6_000)
    if longest == 4000:
        lengths = np.where(rng.random(6_000) < 0.93, 1, lengths)
    packer, used, segments = packing.Packer(), Counter(), Counter()
    placed = [x for i, n in enumerate(lengths) for x in packer.add(packing.Example(i, b"", 0, int(n)))] + list(packer.finish())
    for _, length, sequence, offset in placed:
        assert offset == used[sequence]
        used[sequence] += length
        segments[sequence] += 1
    assert sum(used.values()) == lengths.sum() and max(segments.values()) <= packing.SEQUENCE_SEGMENTS
    assert all(n <= 2048 and n & (n - 1) == 0 for n in used.values())


def test_conversations_are_packed_under_three_limits(spark, data):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{data}/conversations.parquet").collect()]
    rows += [
        (900, 0, "user", None), (900, 1, "assistant", "word " * 5000), (901, None, None, "x y"), (None, 1, "assistant", "x"),
        (901, 3, "assistant", "")
    ]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, length int")
    out = packing.pack_conversations(turns, WORDS).collect()
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *[r.length for r in pieces[:-1]]]).tolist()
        assert sum(r.length for r in pieces) <= 2048 and len(pieces) <= 16 and sum(r.loss_tokens for r in pieces) <= 1024
    want, loss = Counter(), Counter()
    for conversation, _, role, text in rows:
        n = len(t.encode(text or "", add_special_tokens=False).ids) + 1
        want[conversation] += n
        loss[conversation] += n * (role == "assistant")
    got, got_loss = Counter(), Counter()
    for r in out:
        got[r.conv_id] += r.length
        got_loss[r.conv_id] += r.loss_tokens
    assert got == want and +got_loss == +loss and max(loss.values()) > 1024
    assert packing.pack_conversations(turns.limit(0), WORDS).count() == 0


def test_vector_limits_hold_for_instructions():
    rng = np.random.default_rng(3)
    limits = packing.Limits(tokens=100, segments=4, loss=30)
    packer, out = packing.Packer(limits, cut=False, window=32), []
    for i in range(400):
        n = int(rng.integers(1, 60))
        loss = np.arange(n) >= n - min(n, int(rng.integers(0, 20)))
        out += list(packer.add(packing.Example(i, b"", 0, n, loss)))
    out += list(packer.finish())
    assert len(out) == 400
    by = defaultdict(list)
    for e, length, sequence, _ in out:
        by[sequence].append((length, e.loss_in(length)))
    assert all(sum(a for a, _ in v) <= 100 and len(v) <= 4 and sum(b for _, b in v) <= 30 for v in by.values())
    with pytest.raises(ValueError):
        list(packer.add(packing.Example(0, b"", 0, 101)))


def summed(text):
    """The vector of a text by definition: 16 strong lanes, 64 counts of set bits and the number of clauses."""
    strong, signs, n = [0] * 16, [0] * 64, 0
    for line in text.split("\n"):
        digest = hashlib.sha512(line.encode()).digest()
        strong = [(a + int.from_bytes(digest[4 * i : 4 * i + 4], "big")) % 2**32 for i, a in enumerate(strong)]
    for clause in filter(None, re.split(r"[.,;:!?|\n]+ *", text)):
        h, n = xxhash.xxh64_intdigest(clause.encode(), seed=42), n + 1
        signs = [a + (h >> i & 1) for i, a in enumerate(signs)]
    return strong, signs, n


def written(vector):
    strong, signs, n = vector
    return "".join(f"{x:016x}" for x in (*strong, *[signs[i] | signs[i + 32] << 32 for i in range(32)], n))


def alike(a, b):
    if a == b:
        return 1.0
    x, y = (2.0 * np.array(v[1]) - v[2] for v in (a, b))
    norm = float(x @ x + y @ y)
    return min(1.0, max(0.0, 2 * float(x @ y) / norm)) if norm else 0.0


def by_definition(rows):
    """What each row gets; rows are (doc_id, text) in their order."""
    for i, (k, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, following = summed(text), summed(edited), summed(after)
        yield k, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(own), written(other), round(alike(own, other), 9), round(alike(own, following), 9)


def fingerprint_rows(docs):
    return sorted(
        (
            (
                r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
                round(r.near_next, 9)
            )
            for r in fingerprint.fingerprints(docs).collect()
        ),
        key=repr
    )


def test_fingerprints_equal_definition(documents, odd_documents, no_documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    got = fingerprint_rows(documents)
    assert got == sorted(by_definition(rows), key=repr)
    assert len({r[3] for r in got}) == len({t for _, t in rows}) and np.mean([r[5] for r in got]) > np.mean([r[6] for r in got]) + 0.2
    assert fingerprint.fingerprints(odd_documents).count() == odd_documents.count() and fingerprint.fingerprints(no_documents).count() == 0


def test_fingerprints_of_crowded_ids(spark, monkeypatch):
    """One id and null ids with many rows, equal ones among them, in small groups."""
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 8)
    rng = np.random.default_rng(7)
    rows = [(int(i), f"own {i}. two, three {i % 7}\nx") for i in range(-50, 150)]
    rows += [
        (77, f"crowd {int(k)}. a b") for k in rng.integers(0, 60, 300)
    ] + [(None, f"none {int(k)}; c") for k in rng.integers(0, 40, 200)] + [(None, None)] * 30 + [(78, "same")] * 200
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, cell int").repartition(7)
    tie = lambda t: xxhash.xxh64_intdigest((t or "").encode(), seed=42) & (1 << 63) - 1
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, tie(r[1])))
    assert fingerprint_rows(docs) == sorted(by_definition(rows), key=repr)


def test_fingerprint_is_homomorphic(spark):
    df = spark.createDataFrame(
        [("a. b\nccc\nd e", "d e\na. b\nccc", "a. b\nccc", "d e")], "x string, y string, z string, w string"
    )
    fp = {c: fingerprint.fingerprint(F.col(c)) for c in "xyzw"}
    row = df.select(
        (fp["x"] == fp["y"]).alias("order"), (fingerprint.insert(fp["z"], fp["w"]) == fp["x"]).alias("added"),
        (fingerprint.remove(fp["x"], fp["w"]) == fp["z"]).alias("taken"), (fp["z"] == fp["w"]).alias("other")
    ).first()
    assert (row.order, row.added, row.taken, row.other) == (True, True, True, False)
