"""Toxicity by non-negative positive-unlabelled learning on hashed words, trained with numpy.

Only confirmed toxic documents count as labelled. Everything else is unlabelled text, so its risk as negatives is
corrected by the class prior: ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``, with the logistic loss. Where the
corrected negative risk falls below zero, a step goes up its gradient alone, as the estimator's authors have it, which
keeps it from over-fitting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import pick, row_chunks, tidy
from .wordhash import buffers, mix, non_letters, span_hashes, spans

#: Bounds of the training sample: so many confirmed toxic and so many unlabelled documents, those of smallest hash.
TOXIC_ROWS, UNLABELLED_ROWS = 4_000, 4_000
BUCKET_BITS = 20
MIN_Z = 5.0
PREFIX_BYTES = (4, 5, 6, 7, 8)
FOLDS = 5


@dataclass(frozen=True)
class Model:
    """score = sigmoid(bias + sum of weights of the distinct hashed words)."""

    weights: np.ndarray
    bias: float


def fold_of(column: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS, F.lit(-1))


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of distinct lower-cased words and word beginnings, offsets by text).

    Beginnings of PREFIX_BYTES bytes stand for the stems of compounding and inflecting languages.
    """
    data, starts, ends, at = spans(texts, non_letters())
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(at)) << BUCKET_BITS
    shift = np.uint64(64 - BUCKET_BITS)
    whole, *begun = span_hashes(data, starts, ends, *[np.minimum(starts + k, ends) for k in PREFIX_BYTES])
    keys = [row | (whole >> shift).astype(np.int64)]
    for k, h in zip(PREFIX_BYTES, begun, strict=True):
        longer = ends - starts > k
        keys.append(row[longer] | (mix(h[longer] + np.uint64(k)) >> shift).astype(np.int64))
    keys = np.unique(np.concatenate(keys))
    return (keys & ((1 << BUCKET_BITS) - 1)).astype(np.int32), np.searchsorted(
        keys, np.arange(len(texts) + 1, dtype=np.int64) << BUCKET_BITS
    )


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in row_chunks(batch.column(1)):
            found, at = _features(batch.column(1).slice(lo, hi - lo))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([found[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
                ],
                ["positive", "buckets"],
            )


def fit_nnpu(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 300, rate: float = 2.0,
    decay: float = 1e-3
) -> Model:
    """Minimises the non-negative risk by gradient descent with momentum; deterministic.

    Only words whose document shares differ by MIN_Z standard errors between the two samples get a weight, so long
    texts don't gather noise from thousands of neutral words. Equal word sets count once in a sample.
    """
    positive = [x for _, x in sorted({x.tobytes(): x for x in positive}.items())]
    unlabelled = [x for _, x in sorted({x.tobytes(): x for x in unlabelled}.items())]
    size = 1 << BUCKET_BITS
    if not positive or not unlabelled:
        return Model(np.zeros(size, np.float32), -4.0)
    in_p, in_u = (_document_counts(rows, size) for rows in (positive, unlabelled))
    both = (in_p + in_u + 1) / (len(positive) + len(unlabelled) + 2)
    error = np.sqrt(both * (1 - both) * (1 / len(positive) + 1 / len(unlabelled)))
    used = np.flatnonzero((np.abs(in_p / len(positive) - in_u / len(unlabelled)) >= MIN_Z * error) & (in_p + in_u >= 4))
    place = np.full(size, -1, dtype=np.int64)
    place[used] = np.arange(len(used))
    kept = [k[k >= 0] for k in (place[x] for x in (*positive, *unlabelled))]
    lengths = np.array([len(k) for k in kept])
    flat, row = np.concatenate(kept), np.repeat(np.arange(len(lengths)), lengths)
    is_p = np.arange(len(lengths)) < len(positive)
    n_p, n_u = len(positive), len(unlabelled)
    w, speed, bias, bias_speed = np.zeros(len(used)), np.zeros(len(used)), float(np.log(prior / (1 - prior))), 0.0
    for _ in range(steps):
        z = np.bincount(row, weights=w[flat], minlength=len(lengths)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        as_negative = np.logaddexp(0, z)
        corrected = as_negative[~is_p].mean() - prior * as_negative[is_p].mean()
        up = np.where(is_p, prior * (p - 1) / n_p, 0.0)
        down = np.where(is_p, -prior * p / n_p, p / n_u)
        slope = up + down if corrected >= 0 else -down
        speed = 0.9 * speed - rate * (np.bincount(flat, weights=slope[row], minlength=len(used)) + decay * w)
        bias_speed = 0.9 * bias_speed - 0.2 * slope.sum()
        w, bias = w + speed, bias + bias_speed
    weights = np.zeros(size, np.float32)
    weights[used] = w
    return Model(weights, float(bias))


def _document_counts(rows: list[np.ndarray], size: int) -> np.ndarray:
    """In how many rows each bucket is."""
    out = np.zeros(size, dtype=np.int64)
    for x in rows:
        out[x] += 1  # buckets of a row are distinct
    return out


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> Model:
    """Fits on documents outside fold 0: confirmed toxic ones, and a sample of all as unlabelled text.

    The prior is the share of toxic rows among the labelled ones. Repeated labels count once, toxic if any says so.
    Without a confirmed toxic document the model scores everything near zero.
    """
    docs = pick(docs, "doc_id", "text").where(F.col("doc_id").isNotNull())
    marks = (
        pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").where(fold_of() != 0)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    share = marks.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    prior = min(0.5, max(0.005, share or 0.0))
    toxic = marks.where("toxic = 1").select("doc_id", F.lit(True).alias("positive"))
    toxic = toxic.orderBy(F.xxhash64("doc_id"), "doc_id").limit(toxic_rows)
    others = docs.where(fold_of() != 0).select("doc_id", F.lit(False).alias("positive"))
    others = others.orderBy(F.xxhash64("doc_id"), "doc_id").limit(unlabelled_rows)
    sample = docs.join(F.broadcast(toxic.unionByName(others).distinct()), "doc_id")  # toxic_rows + unlabelled_rows ids at most
    table = sample.select("positive", "text").mapInArrow(tidy(_encode), "positive boolean, buckets binary").toArrow()
    rows: dict[bool, list[np.ndarray]] = {True: [], False: []}
    for batch in table.to_batches():  # views of the table's own memory
        data, at = buffers(batch.column("buckets"))
        for positive, lo, hi in zip(batch.column("positive").to_pylist(), at[:-1], at[1:], strict=True):
            rows[positive].append(data[lo:hi].view(np.int32))
    model = fit_nnpu(rows[True], rows[False], prior)
    del table, rows
    pa.default_memory_pool().release_unused()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``score`` (0 to 1) of the whole text; null and empty texts score the bias alone.

    A column of that name is replaced.
    """
    names = [c for c in docs.columns if c != "score"]
    docs = docs.select(*[docs[f"`{c}`"] for c in names])
    at_text = names.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, parts = batch.column(at_text), []
            for lo, hi in row_chunks(texts):
                found, at = _features(texts.slice(lo, hi - lo))
                sums = np.concatenate([[0.0], np.cumsum(model.weights[found], dtype=np.float64)])
                parts.append(1 / (1 + np.exp(-np.clip(sums[at[1:]] - sums[at[:-1]] + model.bias, -40, 40))))
            values = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*names, "score"])

    return docs.mapInArrow(tidy(scored), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row."""
    model = train(docs, labels)
    return score(pick(docs, "doc_id", "text"), model).select(
        "doc_id", (fold_of() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Whole rows of ``docs`` that score below the threshold."""
    model = train(docs, labels)
    names = [f"c{i}" for i in range(len(docs.columns))]  # columns of any name, "score" included, pass unchanged
    names[docs.columns.index("text")] = "text"
    scored = score(docs.toDF(*names), model).where(F.col("score") < threshold)
    return scored.select(*names).toDF(*docs.columns)
