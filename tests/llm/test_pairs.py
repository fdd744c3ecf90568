"""Joins and near duplicates against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumrank.llm import components, embed_dedup, ngram_join

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").encode().lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def reach(ids, links):
    up = {i: i for i in ids}
    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute(texts):
    sets, by, links = {k: shingles(t) for k, t in texts.items()}, defaultdict(list), []
    for k, s in sets.items():
        shared = Counter(j for x in s for j in by[x])
        links += [(k, j) for j, o in shared.items() if 100 * o >= 80 * (len(s) + len(sets[j]) - o)]
        for x in s:
            by[x].append(k)
    component = reach(sets, links)
    return {k: (len(s), component[k]) for k, s in sets.items()}


def mutants():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    texts, k = {}, 0
    common = " ".join(rng.choice(words) for _ in range(60))
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        for _ in range(rng.randrange(1, 25)):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts[k] = " ".join(t) + (f"\n{common}" if rng.random() < 0.3 else "")
            k += 7
    return texts


@pytest.mark.parametrize("rows, elements", [(4096, 2_000_000), (8, 1_000)])
def test_join_equals_brute_force(spark, monkeypatch, rows, elements):
    """With small tiles too, so that large keys are dealt and cut into pairs of cells, and with links beyond one task."""
    monkeypatch.setattr(components, "ONE_TASK_LINKS", 10_000 if rows == 4096 else 0)
    monkeypatch.setattr(ngram_join, "TILE_ROWS", rows)
    monkeypatch.setattr(ngram_join, "TILE_ELEMENTS", elements)
    texts = mutants()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()} == brute(texts)


def test_join_equals_brute_force_on_documents(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(documents).collect()} == brute(texts)


def linked_rows(rows):
    """(n, component) of each row by links between rows, by definition; rows of one id are one document."""
    sets = [shingles(t) for _, t in rows]
    links, first = [], {}
    for i, (k, _) in enumerate(rows):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 80 * len(sets[i] | sets[j]):
                links.append((i, j))
        if k is not None and sets[i]:
            links.append((i, first.setdefault(k, i)))
    component = reach(range(len(rows)), links)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[component[i]] = min(k, least.get(component[i], k))
    return [(len(sets[i]), least.get(component[i]) if sets[i] else rows[i][0]) for i in range(len(rows))]


def test_join_with_repeated_and_null_ids(spark):
    words = [f"w{i}" for i in range(30)]
    a, b, b2 = " ".join(words), " ".join(f"x{i}" for i in range(40)), " ".join([f"x{i}" for i in range(40)] + ["end"])
    c, c2 = " ".join(f"y{i}" for i in range(50)), " ".join([f"y{i}" for i in range(50)] + ["z"])
    rows = [
        (5, a), (5, b), (9, b), (12, b2), (12, b2), (None, c), (None, c2), (None, c), (20, c + " more"),
        (None, "alone in the world it is"), (None, "alone in the world it is"), (None, None), (30, ""), (30, ""), (31, a + " q")
    ]
    docs = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, n int")
    want = Counter((k, *x) for (k, _), x in zip(rows, linked_rows(rows)))
    assert want[12, 37, 5] == 2 and want[9, 36, 5] == 1 and want[31, 27, 5] == 1
    assert Counter(tuple(r) for r in ngram_join.jaccard_components(docs).collect()) == want
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(5, a), (5, b), (20, c + " more"), (None, "alone in the world it is"), (None, None), (30, "")]
    )


def test_links_between_two_rows_are_never_lost(spark):
    """Pairs near the threshold among many unrelated rows that share their first words."""
    rng, rows = random.Random(8), []
    for k in range(120):
        own = [f"a{k}x{i}" for i in range(rng.randrange(10, 60))]
        other = list(own)
        for _ in range(max(1, len(own) // 40)):
            other[rng.randrange(3)] = "changed"
        rows += [
            (2 * k, " ".join(["one common beginning of every single page", *own])),
            (2 * k + 1, " ".join(["one common beginning of every single page", *other]))
        ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == brute(dict(rows)) and 40 < sum(k != c for k, (_, c) in got.items())


def test_join_odd_rows(odd_documents, no_documents):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(odd_documents).collect())
    assert got[(1, 5, 1)] == 1 and got[(2, 5, 1)] == 2 and got[(3, 0, 3)] == 1 and got[(4, 0, 4)] == 1 and got[(5, 0, 5)] == 1 and got[(None, 1, None)] == 1 and got[(7, 1, 7)] == 1
    assert sum(got.values()) == odd_documents.count()
    assert ngram_join.jaccard_components(no_documents).count() == 0
    kept = ngram_join.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns and sorted(
        r.doc_id for r in kept.collect() if r.doc_id
    ) == [1, 3, 4, 5, 6, 7, 8, 9]


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(2)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 80).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 70))) for _ in range(2))
        bits = [ngram_join.signature(x, 64)[None] for x in (a, b)]
        exact = len(np.intersect1d(a, b))
        assert ngram_join.overlap(a, b) == exact <= ngram_join.overlap_bound(bits[0][0], len(a), bits[1], np.array([len(b)]))[0]


@pytest.mark.parametrize("one_task", [0, 10_000])
def test_components_of_chains_and_stars(spark, monkeypatch, one_task):
    monkeypatch.setattr(components, "ONE_TASK_LINKS", one_task)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3), (7, 6)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("rows, chunk", [(8192, 1024), (12, 5)])
def test_embeddings_equal_brute_force(spark, monkeypatch, rows, chunk):
    """With small cells too, so that labels are cut along the components and dealt by a hash, and with links beyond one task."""
    monkeypatch.setattr(components, "ONE_TASK_LINKS", 10_000 if rows == 8192 else 0)
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", rows)
    monkeypatch.setattr(embed_dedup, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(25, 40))
    x = np.concatenate(
        [base[rng.integers(0, 25, 260)] + rng.normal(scale=0.33, size=(260, 40)), np.repeat(base[:2], 20, axis=0), base[:1] * 2.5]
    ).astype(np.float32)
    label = rng.integers(0, 2, len(x))
    vectors = spark.createDataFrame(
        [(int(i * 3), [float(v) for v in x[i]], int(label[i])) for i in range(len(x))],
        "vec_id long, embedding array<float>, label int"
    )
    y = x.astype(float)
    norm = np.sqrt((y * y).sum(1))
    linked = ((y @ y.T) / np.outer(norm, norm) >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    component = reach(range(len(x)), zip(*np.nonzero(linked)))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(vectors).collect()}
    assert got == {
        3 * i: (int(linked[i].sum()), 3 * component[i], component[i] == i) for i in range(len(x))
    } and linked.sum() > 500


def test_embeddings_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1), (8, [float("nan"), 1.0], 1), (9, [float("inf"), 1.0], 1), (10, [], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 2), (None, [1.0, 0.0], 2), (13, [1e-300, 0.0], 2)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, label int, copies int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert all(
        got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11)
    ) and len(got) == 14 and got[12][1] == 12 and got[13][1] == 12
    assert (got[None], got[12], got[13]) == ((2, 12, False), (2, 12, True), (2, 12, False))
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0
    assert embed_dedup.near_duplicates(
        df.select("vec_id", F.lit(None).cast("array<float>").alias("embedding"), "label")
    ).where("n_links = 0 and kept").count() == 14


def test_embeddings_with_labels_of_text_and_no_ids(spark):
    rows = [
        (1, [1.0, 0.0], "a"), (2, [0.99, 0.02], "a"), (3, [1.0, 0.0], "b"), (None, [0.0, 1.0], "a"), (None, [0.01, 1.0], "a"),
        (7, [1.0, 0.0], "b"), (7, [0.0, 1.0], "b"), (4, [1.0, 0.01], None)
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embed_dedup.near_duplicates(df).collect()))
    assert got == [
        (0, 1, 0, True), (0, 1, 0, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 0, 4, True), (7, 0, 7, True),
        (7, 1, 3, False)
    ]


def test_many_lengths_and_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 10)
    monkeypatch.setattr(embed_dedup, "ROTATED_DIMS", 6)
    rng = np.random.default_rng(9)
    rows = [
        (100 * n + k, [float(v) for v in np.arange(1, n + 1) + rng.normal(scale=0.01, size=n)], 1)
        for n in range(2, 30) for k in range(2)
    ]
    rows += [(10_000 + k, [float(v) for v in rng.normal(size=40) + (5 * np.eye(40)[k % 4])], 1) for k in range(40)]
    got = {
        r.vec_id: (r.n_links, r.component_id)
        for r in embed_dedup.near_duplicates(
            spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        ).collect()
    }
    assert all(got[100 * n + k] == (1, 100 * n) for n in range(2, 30) for k in range(2))
    x = np.array([v for i, v, _ in rows if i >= 10_000])
    linked = (x @ x.T / np.outer(*[np.sqrt((x * x).sum(1))] * 2) >= 0.93).sum(1) - 1
    assert [got[10_000 + k][0] for k in range(40)] == linked.tolist()
