"""Exact n-gram Jaccard join: size-banded tiles, hashed bitmap signatures, then sorted-array intersection.

Documents become sets of 64-bit hashes of their distinct 5-word shingles. Equal sets form one class, so copies
cost a row and no comparison. A class is indexed by the first ``n - ceil(0.8 n) + 1`` elements of its set in one
total order (shingles found frequent over the whole corpus last): two sets with Jaccard similarity of 0.8 or more
share an indexed element, so no link is lost. A tile holds the classes that share one indexed element, and the
pairs in it are kept to matching size bands. In a tile, ``|A| - popcount(a & ~b)`` on the bitmap signatures bounds
the overlap from above; what the bound leaves is brought together once per candidate group, where the bound is
applied again on wider bitmaps before the exact intersection. Pairs whose ends are already connected are skipped,
so a group of a million near copies isn't expanded into its pairs; components are the same with or without them.

A key with more rows than a tile holds is first dealt by a hash into tiles of bounded size, twice, and what meets there is
connected. Only rows that are still apart are then brought together in pairs of cells; the rows that most of the key has
been connected to meet those others, but not each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .components import connected_components
from .shared import forget, if_small, pick, row_chunks, stored, tidy
from .wordhash import mix, shingle_sets

#: A pair links when NUM * intersection... : 100 * intersection >= 80 * union.
SIM_NUM, SIM_DEN = 80, 100
#: Frequent shingles that the total order puts last; bounds the broadcast, not the result.
HOT_SHINGLES = 65_536
#: Elements of the first, cheap round of tiles.
FIRST_ELEMENTS = 4
#: Rows of a tile of signatures, and elements of a tile of whole sets (ROW_ELEMENTS for a row besides its own).
TILE_ROWS = 4096
TILE_ELEMENTS, ROW_ELEMENTS = 2_000_000, 256
_HOT_BUFFER = 3_000_000

_SET_SCHEMA = "doc_id long, n int, d1 long, d2 long, prefix array<long>, rare int, bits binary"
_EDGE_SCHEMA = "a long, b long"
_ITEMS = "g long, cls long, d1 long, d2 long, n int, items binary"


def needed(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """Smallest overlap with which sets of n and m elements reach the similarity."""
    return -((-SIM_NUM * (n + m)) // (SIM_NUM + SIM_DEN))


def prefix_length(n: int) -> int:
    return n - -((-SIM_NUM * n) // SIM_DEN) + 1


def _width(n: int, factor: int, most: int) -> int:
    return min(most, 1 << max(6, (factor * n - 1).bit_length()))


def signature(elements: np.ndarray, width: int) -> np.ndarray:
    """Bitmap of ``width`` bits as 64-bit words; a set bit of A missing in B is an element of A missing in B."""
    bit = (elements & np.uint64(width - 1)).astype(np.int64)
    out = np.zeros(width // 64, dtype=np.uint64)
    np.bitwise_or.at(out, bit >> 6, np.uint64(1) << (bit & 63).astype(np.uint64))
    return out


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """The signature of the same set at a smaller width (rows of a matrix)."""
    while bits.shape[-1] * 64 > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def overlap_bound(a: np.ndarray, n: int, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of one set (signature a, n elements) with many (rows of b, m elements)."""
    shared = a & b
    both = np.bitwise_count(shared).sum(axis=-1, dtype=np.int64)
    own = int(np.bitwise_count(a).sum())
    other = np.bitwise_count(b).sum(axis=-1, dtype=np.int64)
    return np.minimum(n - (own - both), m - (other - both))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))


def set_digest(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    found = np.frombuffer(hashlib.blake2b(elements.tobytes(), digest_size=16).digest(), dtype=np.int64)
    return int(found[0]), int(found[1])


def _hot_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, c): shingles in three documents or more of a few thousand neighbouring ones."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        every = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
        cut = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, int)
        counts = np.diff(np.append(cut, len(every)))
        often = counts >= 3
        return pa.RecordBatch.from_arrays(
            [pa.array(every[cut][often].view(np.int64)), pa.array(counts[often].astype(np.int64))], ["h", "c"]
        )

    for batch in batches:
        texts = batch.column(0)
        for lo, hi in row_chunks(texts):
            for s in shingle_sets(texts.slice(lo, hi - lo)):
                held.append(s)
                size += len(s)
            if size >= _HOT_BUFFER:
                yield flush()
                held, size = [], 0
    yield flush()


def hot_shingles(docs: DataFrame, keep: int = HOT_SHINGLES) -> np.ndarray:
    """The most frequent shingles of the corpus, rarest first. Only the order of the index depends on them."""
    found = (
        docs.select("text").mapInArrow(tidy(_hot_in), "h long, c long")
        .groupBy("h").agg(F.sum("c").alias("c")).where("c >= 8")
        .orderBy(F.desc("c"), "h").limit(keep).select("h").toArrow()
    )
    return found.column("h").to_numpy()[::-1].astype(np.int64).view(np.uint64)


def shingle_table(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """One row per document: size of its set, digest of the set, indexed elements, how many of these aren't frequent
    (they come first), bitmap signature."""
    rank = np.arange(len(hot))[np.argsort(hot, kind="stable")]
    by_hash = np.sort(hot)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in row_chunks(texts):
                n, d1, d2, prefix, few, bits = [], [], [], [], [], []
                for s in shingle_sets(texts.slice(lo, hi - lo)):
                    n.append(len(s))
                    one, two = set_digest(s)
                    d1.append(one)
                    d2.append(two)
                    if not len(s):
                        prefix.append(np.zeros(0, np.int64))
                        few.append(0)
                        bits.append(b"")
                        continue
                    order, often = s, 0
                    if len(by_hash):
                        at = np.searchsorted(by_hash, s)
                        at[at == len(by_hash)] = 0
                        is_hot = by_hash[at] == s
                        often = int(is_hot.sum())
                        if often:
                            order = np.concatenate([s[~is_hot], s[is_hot][np.argsort(rank[at[is_hot]], kind="stable")]])
                    prefix.append(order[: prefix_length(len(s))].view(np.int64))
                    few.append(min(len(s) - often, len(prefix[-1])))
                    bits.append(signature(mix(s), _width(len(s), 2, 4096)).tobytes())
                ends = np.cumsum([0, *map(len, prefix)])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo), pa.array(n, pa.int32()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefix), pa.int64())),
                        pa.array(few, pa.int32()), pa.array(bits, pa.binary()),
                    ],
                    ["doc_id", "n", "d1", "d2", "prefix", "rare", "bits"],
                )

    return docs.select("doc_id", "text").mapInArrow(tidy(sets), _SET_SCHEMA)


def by_key(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys from a sorted stream, one group at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.zeros(batch.num_rows, dtype=bool)
        cut[0] = True
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        at = [*np.flatnonzero(cut).tolist(), batch.num_rows]
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            last = key
            held.append(table.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held)


def _binary_rows(column: pa.ChunkedArray, dtype: type) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=dtype) for x in column.to_pylist()]


def _edges(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _stars(cls: np.ndarray, first: np.ndarray, roots: np.ndarray) -> tuple[list, list]:
    """Links from a row of every label to one of the smallest label that it has been connected with."""
    root = roots[first]
    joined = np.flatnonzero(root != np.arange(len(root)))
    return cls[first[joined]].tolist(), cls[first[root[joined]]].tolist()


def _bound_tile(cls: np.ndarray, n: np.ndarray, label: np.ndarray, side: np.ndarray, bits: list[np.ndarray]) -> tuple[list, list]:
    """Links of rows whose signatures leave the similarity possible, as stars: one of several paths is enough.

    Rows are in order of size and so of width; a row meets those of its own width, and narrower ones after folding.
    """
    order = np.argsort(n, kind="stable")
    cls, n, side = cls[order], n[order], side[order]
    _, first, roots = np.unique(label[order], return_index=True, return_inverse=True)  # rows of one label are together in any case
    widths = np.array([64 * len(bits[i]) for i in order])
    parts = [(int(w), *(int(x) for x in np.flatnonzero(widths == w)[[0, -1]] + [0, 1])) for w in np.unique(widths)]
    flat = {w: np.stack([bits[i] for i in order[lo:hi]]) for w, lo, hi in parts}
    for i in range(1, len(cls)):
        least = int(np.searchsorted(n, -((-SIM_NUM * int(n[i])) // SIM_DEN)))
        own = bits[order[i]]
        for w, lo, hi in parts:
            lo_j, hi_j = max(lo, least), min(hi, i)
            if lo_j >= hi_j:
                continue
            js = lo_j + np.flatnonzero((roots[lo_j:hi_j] != roots[i]) & ((side[lo_j:hi_j] != side[i]) | (side[i] == 0)))
            if not len(js):
                continue
            for j in js[overlap_bound(fold(own, w), int(n[i]), flat[w][js - lo], n[js]) >= needed(int(n[i]), n[js])].tolist():
                if roots[i] != roots[j]:
                    low, high = sorted((roots[i], roots[j]))
                    roots[roots == high] = low
    return _stars(cls, first, roots)


def _edges_of_tiles(key: str, payload: str, act):
    """Edges of every tile of a sorted stream; ``act`` finds those of one."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for tile in by_key(batches, [key, "block"]):
            if tile.num_rows > 1:
                x, y = act(
                    *(tile.column(k).to_numpy() for k in ("cls", "n", "label", "side")),
                    _binary_rows(tile.column(payload), np.uint64)
                )
                a += x
                b += y
            if len(a) > 50_000:
                yield _edges(a, b)
                a, b = [], []
        yield _edges(a, b)

    return edges


def _exact_tile(cls: np.ndarray, n: np.ndarray, label: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> tuple[list, list]:
    """Links with the similarity, as stars of the tile's components; rows of one label are connected already."""
    order = np.argsort(n, kind="stable")
    cls, n, side = cls[order], n[order], side[order]
    sets = [sets[i] for i in order]
    width = _width(int(np.median(n)), 8, 16384)
    bits = np.stack([signature(mix(s), width) for s in sets])
    _, first, roots = np.unique(label[order], return_index=True, return_inverse=True)
    for i in range(1, len(cls)):
        lo = int(np.searchsorted(n, -((-SIM_NUM * int(n[i])) // SIM_DEN)))
        js = lo + np.flatnonzero((roots[lo:i] != roots[i]) & ((side[lo:i] != side[i]) | (side[i] == 0)))
        if not len(js):
            continue
        bound = overlap_bound(bits[i], int(n[i]), bits[js], n[js])
        least = needed(int(n[i]), n[js])
        likely = js[np.argsort(least - bound, kind="stable")][: int(np.count_nonzero(bound >= least))]
        for j in likely.tolist():
            if roots[i] != roots[j] and overlap(sets[i], sets[j]) >= needed(int(n[i]), int(n[j])):
                low, high = sorted((roots[i], roots[j]))
                roots[roots == high] = low
    return _stars(cls, first, roots)


def _dealt(rows: DataFrame, key: str, large: DataFrame, most: int, *payload: str) -> DataFrame:
    """Adds (block, side): a large key's rows are dealt into tiles by a hash, twice, so that similar rows meet; others stay whole."""
    salt = F.explode(F.when(F.col("total").isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(1), F.lit(2))))
    dealt = rows.join(if_small(large), key, "left").withColumn("salt", salt)
    place = F.pmod(F.xxhash64("cls", "salt"), F.ceil(F.col("total") / most))
    block = F.when(F.col("total").isNull(), F.lit("")).otherwise(F.concat_ws("/", "salt", place))
    return dealt.select(key, "cls", "n", "label", block.alias("block"), F.lit(0).alias("side"), *payload)


def _met(rows: DataFrame, key: str, most: int) -> DataFrame:
    """(key, cls, n, label, block, side) that bring every two rows of a large key together, but for those of equal label
    if it is the key's commonest, and for those whose sizes can't match.

    A cell holds rows of one size band, all or none of them with the commonest label, dealt by a hash; a tile is a pair of
    cells. So a group of near copies, which shares a label by now, isn't compared again, and only travels as often as the
    other rows of its key fill cells. side is 0 where a cell meets itself, else the cell's place in the pair.
    """
    common = rows.groupBy(key, "label").agg(F.sum("w").alias("total")).groupBy(key).agg(
        F.max_by("label", F.struct("total", "label")).alias("common")
    )
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(SIM_DEN / SIM_NUM) + 1e-6)).cast("int")  # sizes that can match lie in one band or two neighbouring ones
    rows = stored(rows, "large-rows").join(stored(common, "common"), key).withColumns(
        {"band": band, "alike": F.col("label") == F.col("common")}
    )
    sizes = stored(rows.groupBy(key, "band", "alike").agg(F.ceil(F.sum("w") / most).alias("blocks")), "cells")
    cells = sizes.select(key, "band", "alike", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("at"))
    own = ("band", "alike", "at")
    near = cells.withColumn("band2", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    other = cells.select(key, *[F.col(c).alias(f"{c}2") for c in own])
    meets = near.join(other, [key, "band2"]).where("not (alike and alike2)")
    meets = meets.where("band < band2 or struct(alike, at) <= struct(alike2, at2)")
    itself = (F.col("band") == F.col("band2")) & (F.col("alike") == F.col("alike2")) & (F.col("at") == F.col("at2"))
    meets = meets.withColumns({"block": F.concat_ws("/", *own, *[f"{c}2" for c in own]), "itself": itself})
    places = meets.select(key, *own, "block", F.when(F.col("itself"), 0).otherwise(1).alias("side")).unionByName(
        meets.where(~F.col("itself")).select(key, *[F.col(f"{c}2").alias(c) for c in own], "block", F.lit(2).alias("side"))
    )
    placed = rows.join(sizes, [key, "band", "alike"]).withColumn("at", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    return placed.join(stored(places, "tiles"), [key, *own]).select(key, "cls", "n", "label", "block", "side")


def _tiled(places: DataFrame, key: str, payload: str, act) -> DataFrame:
    """Edges found in the tiles of rows that carry their payload."""
    return places.repartition(F.col(key), F.col("block")).sortWithinPartitions(key, "block").mapInArrow(
        tidy(_edges_of_tiles(key, payload, act)), _EDGE_SCHEMA
    )


def set_classes(table: DataFrame) -> DataFrame:
    """One row for each set that isn't empty: cls (a number given once), d1, d2, rep (its smallest doc_id), n, prefix, bits."""
    found = table.where("n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "prefix", "rare", "bits")]
    )
    return stored(found.withColumn("cls", F.monotonically_increasing_id()), "classes")


def _candidates(classes: DataFrame) -> DataFrame:
    """(node, component): classes joined by signatures that leave the similarity possible; linked ones are always together."""
    bits = classes.select("cls", "bits")
    few = classes.select("cls", "n", F.col("cls").alias("label"), F.explode(F.slice("prefix", 1, FIRST_ELEMENTS)).alias("h"))
    shared = stored(few.groupBy("h").agg(F.count(F.lit(1)).alias("total")).where("total > 1"), "shared")
    few = stored(few.join(shared.select("h"), "h"), "postings")
    crowded = stored(shared.where(F.col("total") > TILE_ROWS), "crowded")
    first = stored(
        _tiled(_dealt(few, "h", crowded, TILE_ROWS).join(bits, "cls"), "h", "bits", _bound_tile).distinct(), "candidates"
    )
    label = stored(connected_components(first), "labels")
    forget(classes.sparkSession, few)

    # Keys that aren't frequent hold few rows each and are counted in a window: one shuffle. The frequent ones are counted
    # by an aggregate, whose map side leaves a row for each key and task.
    rest = classes.join(label, F.col("cls") == F.col("node"), "left").select(
        "cls", "n", F.coalesce("component", "cls").alias("label"), "prefix", "rare"
    )
    of_key = Window.partitionBy("h")
    rare = rest.select("cls", "n", "label", F.explode(F.slice("prefix", F.lit(1), F.col("rare"))).alias("h"))
    rare = rare.withColumns(
        {"total": F.count(F.lit(1)).over(of_key), "low": F.min("label").over(of_key), "high": F.max("label").over(of_key)}
    ).where("low < high")
    often = rest.select("cls", "n", "label", F.explode(F.slice("prefix", F.col("rare") + 1, F.size("prefix"))).alias("h"))
    still = often.groupBy("h").agg(
        F.count(F.lit(1)).alias("total"), F.min("label").alias("low"), F.max("label").alias("high")
    ).where("low < high")
    often = often.join(stored(still.select("h", "total"), "open"), "h")
    columns = ("h", "cls", "n", "label", "total")
    rest = stored(rare.select(*columns).unionByName(often.select(*columns)), "postings")
    places = rest.where(F.col("total") <= TILE_ROWS).select(
        "h", "cls", "n", "label", F.lit("").alias("block"), F.lit(0).alias("side")
    )
    if not rest.where(F.col("total") > TILE_ROWS).isEmpty():
        large = rest.where(F.col("total") > TILE_ROWS).select("h", "cls", "n", "label", F.lit(1).cast("long").alias("w"))
        places = places.unionByName(_met(large, "h", TILE_ROWS))
    second = _tiled(places.join(bits, "cls"), "h", "bits", _bound_tile).distinct()
    found = stored(connected_components(first.unionByName(second)), "groups")
    for x in (rest, first, label, shared):
        forget(classes.sparkSession, x)
    return found


def _whole_sets(docs: DataFrame, members: DataFrame, repeated: bool) -> DataFrame:
    """``members(g, cls, rep, d1, d2)`` with their sorted sets, from the text of a document that has the set."""
    named = members.where("rep is not null").select(
        F.col("rep").alias("doc_id"), "g", "cls", F.col("d1").alias("c1"), F.col("d2").alias("c2")
    )
    found = docs.join(
        if_small(stored(named, "named-members")), "doc_id"
    ).select("g", "cls", "c1", "c2", "text").mapInArrow(tidy(_items), _ITEMS)
    unnamed = members.where("rep is null").select("g", "cls", "d1", "d2")
    if not unnamed.isEmpty():
        none = [F.lit(None).cast("long").alias(c) for c in ("g", "cls", "c1", "c2")]
        texts = docs.where("doc_id is null").select(*none, "text").mapInArrow(tidy(_items), _ITEMS).drop("g", "cls")
        found = found.unionByName(texts.join(unnamed, ["d1", "d2"]))
        repeated = True
    return found.dropDuplicates(["cls"]) if repeated else found


def _links_in_groups(rows: DataFrame, most: int, payload: str, act) -> DataFrame:
    """(a, b) of rows (g, cls, n, label, w, payload): every two rows of a group that ``act`` links are connected."""
    large = stored(rows.groupBy("g").agg(F.sum("w").alias("total")).where(F.col("total") > most), "large")
    found = stored(_tiled(_dealt(rows, "g", large, most, payload), "g", payload, act).distinct(), "links")
    if large.isEmpty():
        return found
    label = stored(connected_components(found), "labels")
    apart = rows.select("g", "cls", "n", "w").join(if_small(large.select("g")), "g").join(
        label, F.col("cls") == F.col("node"), "left"
    )
    apart = stored(apart.select("g", "cls", "n", F.coalesce("component", "cls").alias("label"), "w"), "apart")
    still = stored(
        apart.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("g"), "open"
    )
    if still.isEmpty():
        return found
    places = _met(apart.join(if_small(still), "g"), "g", most)
    more = _tiled(places.join(rows.select("cls", payload), "cls"), "g", payload, act)
    return stored(found.unionByName(more).distinct(), "links")


def _exact_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, repeated: bool) -> DataFrame:
    """(a, b) of classes with the similarity, as a forest of their components.

    Long sets fill the signatures of the index, so groups are first divided by signatures as wide as the sets are large;
    whole sets are only brought together in what is left.
    """
    spark = docs.sparkSession
    members = groups.select(
        F.col("node").alias("cls"), F.col("component").alias("g")
    ).join(classes.select("cls", "rep", "d1", "d2"), "cls")
    members = stored(members, "members")
    items = stored(_whole_sets(docs, members, repeated).withColumn("label", F.col("cls")), "items")
    wide = stored(items.select("g", "cls", "n", "items").mapInArrow(tidy(_wide), "g long, cls long, n int, bits binary"), "wide")
    wide = wide.withColumns({"label": F.col("cls"), "w": F.octet_length("bits") / 8 + F.lit(ROW_ELEMENTS)})
    nearer = stored(connected_components(_links_in_groups(wide, TILE_ELEMENTS, "bits", _bound_tile)), "groups")
    rows = items.drop("g").join(if_small(nearer.select(F.col("node").alias("cls"), F.col("component").alias("g"))), "cls")
    rows = stored(rows.select("g", "cls", "n", "label", (F.col("n") + F.lit(ROW_ELEMENTS)).alias("w"), "items"), "items")
    found = _links_in_groups(rows, TILE_ELEMENTS, "items", _exact_tile)
    for x in (members, items, wide, nearer, rows):
        forget(spark, x)
    return found


def component_names(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(d1, d2, component_id) of every set that isn't empty: the smallest doc_id reachable, null where none has an id."""
    classes = set_classes(table)
    ids = table.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{k}{c}") for c in ("d1", "d2") for k, f in (("low_", F.min), ("high_", F.max))]
    )
    repeated = stored(
        ids.where("rows > 1").select("doc_id", (F.expr("low_d1 < high_d1 or low_d2 < high_d2")).alias("differ")), "repeated"
    )
    groups = _candidates(classes)
    links = _exact_links(docs, classes, groups, not repeated.isEmpty())
    differ = repeated.where("differ").select("doc_id")
    if not differ.isEmpty():  # classes of one document's texts belong together
        of_ids = stored(
            table.where("n > 0").join(differ, "doc_id").select("doc_id", "d1", "d2").distinct().join(
                classes.select("d1", "d2", "cls"), ["d1", "d2"]
            ).select("doc_id", "cls"),
            "shared-ids"
        )
        lowest = stored(of_ids.groupBy("doc_id").agg(F.min("cls").alias("a")), "lowest")
        links = links.unionByName(of_ids.join(lowest, "doc_id").select("a", F.col("cls").alias("b")))
    component = stored(connected_components(links), "components")
    named = classes.select("cls", "d1", "d2", "rep").join(component, F.col("cls") == F.col("node"), "left")
    smallest = stored(named.where("component is not null").groupBy("component").agg(F.min("rep").alias("smallest")), "names")
    out = stored(
        named.join(smallest, "component", "left").select(
            "d1", "d2", F.coalesce("smallest", "rep").alias("component_id"), "component", "cls"
        ),
        "named"
    )
    for x in (classes, groups, component, smallest):
        forget(docs.sparkSession, x)
    return out


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per input row, component_id the smallest linked doc_id.

    Null and empty texts have no shingles and stay alone. Rows that share a doc_id are one document: what is linked with
    any of its texts is linked with all. Repeated rows come out as often as they went in. Rows with a null doc_id take
    part like all others, but never name a component; where no row of a component has an id, component_id is null.
    Other columns are ignored.
    """
    docs = pick(docs, "doc_id", "text")
    table = stored(shingle_table(docs, hot_shingles(docs)), "shingles")
    found = component_names(docs, table).select("d1", "d2", "component_id")
    out = table.select("doc_id", "n", "d1", "d2").join(found, ["d1", "d2"], "left")
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, cls, d1, d2, n, items): whole sorted sets; of rows that name a class only those that have its very set."""
    for batch in batches:
        *keys, texts = batch.columns
        for lo, hi in row_chunks(texts):
            rows = []
            for g, cls, one, two, s in zip(
                *(c.slice(lo, hi - lo).to_pylist() for c in keys), shingle_sets(texts.slice(lo, hi - lo)), strict=True
            ):
                d1, d2 = set_digest(s)
                if len(s) and (cls is None or (one, two) == (d1, d2)):
                    rows.append((g, cls, d1, d2, len(s), s.tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (*[pa.int64()] * 4, pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["g", "cls", "d1", "d2", "n", "items"]
            )


def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, cls, n, bits): signatures of two bits or more for each element."""
    for batch in batches:
        sets = _binary_rows(batch.column(3), np.uint64)
        bits = pa.array([signature(mix(s), _width(len(s), 2, 1 << 62)).tobytes() for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], bits], ["g", "cls", "n", "bits"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns, and the digest of the text's set, null where that is empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text"))
        for lo, hi in row_chunks(texts):
            found = [set_digest(s) if len(s) else (None, None) for s in shingle_sets(texts.slice(lo, hi - lo))]
            more = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*[c.slice(lo, hi - lo) for c in batch.columns], *more], [*batch.schema.names, "d1", "d2"]
            )


def keep_one(docs: DataFrame) -> DataFrame:
    """Whole rows of ``docs``: of each component the document with the smallest doc_id.

    Of rows with one id and one text one stays. Of a component in which no row has an id one row stays; other rows with
    a null id go, unless their text has no shingle.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # columns of any name pass unchanged
    names[docs.columns.index("doc_id")], names[docs.columns.index("text")] = "doc_id", "text"
    rows = docs.toDF(*names)
    texts = rows.select("doc_id", "text")
    table = stored(shingle_table(texts, hot_shingles(texts)), "shingles")
    named = component_names(texts, table)
    ids = table.where("doc_id is not null").select("doc_id", "n", "d1", "d2").join(
        named.select("d1", "d2", "component_id"), ["d1", "d2"], "left"
    )
    lost = stored(ids.where("n > 0 and doc_id <> component_id").select("doc_id").distinct(), "lost")
    kept = rows.where("doc_id is not null").join(lost, "doc_id", "left_anti")
    repeated = stored(
        table.where("doc_id is not null").groupBy("doc_id").agg(
            F.count(F.lit(1)).alias("rows")
        ).where("rows > 1").select("doc_id"),
        "repeated"
    )
    if not repeated.isEmpty():
        again = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(
            F.first(F.struct(*names)).alias("row")
        ).select("row.*")
        kept = kept.join(repeated, "doc_id", "left_anti").select(*names).unionByName(again.select(*names))
    if not table.where("doc_id is null").isEmpty():
        schema = T.StructType([*rows.schema.fields, T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())])
        without = rows.where("doc_id is null").mapInArrow(tidy(_digests), schema)
        empty = without.where("d1 is null").select(*names)
        alone = named.where("component_id is null").select("d1", "d2", F.coalesce("component", "cls").alias("component"))
        one = without.join(alone, ["d1", "d2"]).groupBy("component").agg(F.first(F.struct(*names)).alias("row")).select("row.*")
        kept = kept.select(*names).unionByName(one.select(*names)).unionByName(empty)
    return kept.select(*names).toDF(*docs.columns)
