"""Document fingerprints: a homomorphic multiset hash of paragraphs, in SQL expressions only.

A paragraph (a line) hashes to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors,
modulo powers of two lane by lane. So the order of paragraphs doesn't matter, and a paragraph is added to or taken
from a fingerprint without the rest of the text. Two blocks of lanes: EQUAL_LANES lanes modulo 2**32, cut from the
paragraph's SHA-512, tell whether two multisets are equal; SIGN_LANES lanes count, for each paragraph, the clauses in it
whose hash has a given bit set, modulo 2**32, so that with the count of clauses they are sums of +1 and -1 and their
scaled product estimates how much two texts share.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import pick

EQUAL_LANES = 16
SIGN_LANES = 64
_LOW = (1 << 32) - 1
_PAIR = (1 << 32) | 1
#: Documents that one window group of neighbours holds, about; ids are cut into so many quantile cells at most.
BUCKET_ROWS, CELLS = 256, 4096


def _strong_lane(i: int):
    return lambda total, x: total + F.conv(F.substring(x, 8 * i + 1, 8), 16, 10).cast("long")


def _sign_lanes(i: int):
    return lambda total, x: total + F.shiftrightunsigned(x, i).bitwiseAND(F.lit(_PAIR))


def fingerprint(text: Column) -> Column:
    """array<long> of EQUAL_LANES sums, SIGN_LANES / 2 pairs of counts and the count of clauses."""
    text = F.coalesce(text, F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda p: F.sha2(p, 512))
    clauses = F.transform(F.filter(F.split(text, r"[.,;:!?|\n]+ *"), lambda c: c != ""), lambda c: F.xxhash64(c))
    return F.transform(  # the two arrays of hashes are made once for all lanes
        F.array(F.struct(lines.alias("lines"), clauses.alias("clauses"))),
        lambda h: F.array(
            *[
                F.aggregate(h["lines"], F.lit(0).cast("long"), _strong_lane(i)).bitwiseAND(F.lit(_LOW))
                for i in range(EQUAL_LANES)
            ],
            *[F.aggregate(h["clauses"], F.lit(0).cast("long"), _sign_lanes(i)) for i in range(SIGN_LANES // 2)],
            F.size(h["clauses"]).cast("long"),
        ),
    )[0]


def _pairwise(a: Column, b: Column, act) -> Column:
    """Lane by lane, on both halves of the packed pairs."""
    def lane(x: Column, y: Column) -> Column:
        low = act(x.bitwiseAND(F.lit(_LOW)), y.bitwiseAND(F.lit(_LOW))).bitwiseAND(F.lit(_LOW))
        high = act(F.shiftrightunsigned(x, 32), F.shiftrightunsigned(y, 32)).bitwiseAND(F.lit(_LOW))
        return F.shiftleft(high, 32).bitwiseOR(low)

    return F.zip_with(a, b, lane)


def insert(fp: Column, other: Column) -> Column:
    """Fingerprint of both multisets of paragraphs together."""
    return _pairwise(fp, other, lambda x, y: x + y)


def remove(fp: Column, other: Column) -> Column:
    """Fingerprint without the paragraphs of ``other``, which must be among them."""
    return _pairwise(fp, other, lambda x, y: x - y)


def as_text(fp: Column) -> Column:
    """Fixed-width lowercase hex."""
    return F.lower(F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: twice the shared clauses over those of both texts, as the sign lanes estimate it; equal ones give 1."""
    def lanes(fp: Column) -> Column:
        n = F.element_at(fp, -1).cast("double")
        packed = F.slice(fp, EQUAL_LANES + 1, SIGN_LANES // 2)
        return F.concat(
            F.transform(packed, lambda x: 2.0 * x.bitwiseAND(F.lit(_LOW)) - n),
            F.transform(packed, lambda x: 2.0 * F.shiftrightunsigned(x, 32) - n)
        )

    def both(x: Column, y: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("norm"))
        sums = F.aggregate(
            F.zip_with(x, y, lambda p, q: F.struct((p * q).alias("dot"), (p * p + q * q).alias("norm"))), start,
            lambda s, t: F.struct((s["dot"] + t["dot"]).alias("dot"), (s["norm"] + t["norm"]).alias("norm")),
        )
        return F.transform(F.array(sums), lambda s: F.when(s["norm"] > 0, 2.0 * s["dot"] / s["norm"]).otherwise(F.lit(0.0)))[0]

    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), both(lanes(a), lanes(b)))))


def _bucketed(docs: DataFrame) -> tuple[DataFrame, list[int]]:
    """(docs with cell, sub; the cells of one id): consecutive places in groups of about BUCKET_ROWS rows, whatever the ids.

    An id that fills a quantile cell or more, and the rows without an id, are cells of their own, cut by ``tie``, the hash
    of the text that orders their rows.
    """
    stats = docs.agg(
        F.count(F.lit(1)).alias("all"), F.count("doc_id").alias("n"),
        F.percentile_approx("doc_id", [i / 64 for i in range(65)], 10_000).alias("q")
    ).first()
    n, without = stats.n or 0, (stats["all"] or 0) - (stats.n or 0)
    cells = max(64, min(CELLS, n // (8 * BUCKET_ROWS)))
    if cells > 64:
        stats = docs.agg(F.percentile_approx("doc_id", [i / cells for i in range(cells + 1)], 10 * CELLS).alias("q")).first()
    found = Counter(stats.q or [0])
    large = {e: k * n // cells for e, k in found.items() if k > 1 and k * n // cells > BUCKET_ROWS}
    edges = sorted({*found, *[e + 1 for e in large if e < (1 << 63) - 1]})
    subs = max(1, n // (len(edges) * BUCKET_ROWS))
    widths = [max(1, -(-(b - a) // subs)) for a, b in zip(edges, [*edges[1:], edges[-1] + 1], strict=True)]
    parts = [-(-rows // BUCKET_ROWS) for rows in (*[large.get(e, 0) for e in edges], max(1, without))]
    lows, wide, by_tie = (F.split(F.lit(",".join(map(str, x))), ",").cast("array<bigint>") for x in (edges, widths, parts))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])
    cell = F.aggregate(  # binary search of the last edge not above the id; below all of them, the first
        steps, F.lit(0),
        lambda at, s: F.when((at + s <= len(edges)) & (F.get(lows, at + s - 1) <= F.col("doc_id")), at + s).otherwise(at)
    )
    at = F.greatest(cell, F.lit(1)) - 1
    placed = docs.withColumn("cell", F.when(F.col("doc_id").isNull(), F.lit(len(edges))).otherwise(at))
    by_id = F.floor((F.col("doc_id") - F.get(lows, F.col("cell"))) / F.get(wide, F.col("cell")))
    cut = F.get(by_tie, F.col("cell"))
    placed = placed.withColumn("sub", F.when(cut > 0, F.floor(F.col("tie") / F.lit(2.0**63) * cut)).otherwise(by_id))
    return placed, [i for i, e in enumerate(edges) if large.get(e)] + ([len(edges)] if without else [])


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fp, next_text, next_fp): each row beside the one that follows by doc_id; after the last, the first.

    Null texts read as empty. Rows with one doc_id follow each other by a hash of their texts, null ids come last.
    The first row of each group of neighbours is copied into the group before, so no sort is global. Equal rows of an id
    that very many rows have travel as one.
    """
    docs = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    placed, crowded = _bucketed(docs.withColumn("tie", F.xxhash64("text").bitwiseAND(F.lit((1 << 63) - 1))))
    place = ["cell", "sub", "doc_id", "text", "tie"]
    if crowded:
        alike = placed.where(F.col("cell").isin(crowded)).groupBy(*place).agg(F.count(F.lit(1)).alias("copies"))
        placed = placed.where(~F.col("cell").isin(crowded)).select(
            *place, F.lit(1).cast("long").alias("copies")
        ).unionByName(alike)
    else:
        placed = placed.select(*place, F.lit(1).cast("long").alias("copies"))
    order = [F.col("doc_id").asc_nulls_last(), "tie"]
    key = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("tie").alias("c"))
    heads = placed.groupBy("cell", "sub").agg(F.min_by(F.struct("doc_id", "text", "tie"), key).alias("head"))
    groups = placed.groupBy("cell", "sub").agg(F.count(F.lit(1)).alias("n"))
    ends = groups.groupBy("cell").agg(F.max("sub").alias("last"))
    every = Window.partitionBy(F.lit(0)).orderBy("cell")  # one row for each cell, CELLS + 1 at most
    ends = ends.withColumns({
        "before_cell": F.coalesce(F.lag("cell").over(every), F.max("cell").over(Window.partitionBy(F.lit(0)))),
        "before_sub": F.coalesce(
            F.lag("last").over(every),
            F.last("last").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        ),
    })
    inside = Window.partitionBy("cell").orderBy("sub")
    before = groups.select("cell", "sub", F.lag("sub").over(inside).alias("prev")).join(ends, "cell")
    ghosts = heads.join(before, ["cell", "sub"]).select(
        F.when(F.col("prev").isNull(), F.col("before_cell")).otherwise(F.col("cell")).alias("cell"),
        F.coalesce("prev", "before_sub").alias("sub"), "head.doc_id", "head.text", "head.tie",
        F.lit(1).cast("long").alias("copies"), F.lit(1).alias("ghost"),
    )
    rows = placed.withColumn("ghost", F.lit(0)).unionByName(ghosts)
    rows = rows.withColumn("fp", fingerprint(F.col("text")))
    along = Window.partitionBy("cell", "sub").orderBy("ghost", *order)
    out = rows.withColumns({"next_text": F.lead("text").over(along), "next_fp": F.lead("fp").over(along)}).where("ghost = 0")
    if crowded:  # of equal rows all but the last are followed by their like
        out = out.withColumn("left", F.explode(F.sequence(F.col("copies") - 1, F.lit(0).cast("long"))))
        out = out.withColumns(
            {f"next_{c}": F.when(F.col("left") > 0, F.col(c)).otherwise(F.col(f"next_{c}")) for c in ("text", "fp")}
        )
    return out.select("doc_id", "text", "fp", "next_text", "next_fp")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per input row.

    Null texts read as empty. ``near_next`` is the likeness to the next document. The order is that of ``with_next``, the
    only row is its own next one. Other columns are ignored.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = with_next(docs).withColumn("edited", edited)
    rows = rows.withColumn("edited_fp", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
