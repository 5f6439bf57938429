"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

Learning uses a bounded sample of labelled documents (SAMPLE): Spark counts in how many toxic and other documents
each hashed n-gram of code points occurs, the n-grams with significant ratios (SIGNIFICANT) come to the driver, and a
logistic regression with ridge penalty is fitted there on the sample's occurrences of these. The penalty is the one with the least log loss over
three folds of the sample, which has no held-out row. All whole texts are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, held_out, table, texts_of, utf8, written
from .sampling import thinned

THRESHOLD = 0.3
#: Labelled rows that the model learns from, at most: those with the smallest hashes of their ids.
SAMPLE = 8000
#: The model has weights for all n-grams whose log-count ratio is so many standard errors from 0, or more.
SIGNIFICANT = 3.0
SIZES = (3, 4, 5, 6)
#: n-grams are told apart by so many bits of a hash.
BITS = 22
SMOOTHING = 0.5
#: Penalties that the folds choose from; steps of a fit.
RIDGES, STEPS, RATE = (2e-4, 6e-4, 2e-3, 6e-3), 150, 0.1
BLOCK_BYTES = 1 << 20


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the lower-cased texts, white space being spaces, and where each text begins (one more entry)."""
    lowered = [t.lower() for t in texts]
    data = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    data[(data >= 9) & (data <= 13)] = 32
    return data, np.cumsum([0, *map(len, lowered)])


def grams(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: the hashed n-grams at the places where one begins that ends in the same row, and those places."""
    data = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(0x5851F42D4C957F2D)
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(data))  # code points to the row's end
    key = np.zeros(len(data), np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(data) < n:
            return
        key = key[: len(data) - n + 1] * np.uint64(0xD6E8FEB86659FD93) + data[n - 1 :]
        if n in SIZES:
            hashed = ((key ^ key >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int32)
            ok = np.flatnonzero(left[: len(key)] >= n)
            yield hashed[ok], ok


def occurrences(data: np.ndarray, at: np.ndarray, index: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs. index: each hash's feature, or -1; None takes all hashes."""
    rows, pairs = np.repeat(np.arange(len(at) - 1), np.diff(at)), []
    for hashed, places in grams(data, at):
        own = hashed if index is None else index[hashed]
        if index is not None:
            keep = np.flatnonzero(own >= 0)
            own, places = own[keep], places[keep]
        pairs.append(rows[places] * width + own)
    pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return pairs // width, pairs % width


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for i, j in blocks(utf8(batch.column("text"))[1], BLOCK_BYTES):
            rows, hashed = occurrences(*code_points(batch.column("text").slice(i, j - i).to_pylist()), None, 1 << BITS)
            toxic = label[i:j][rows] == 1
            counts[1] += np.bincount(hashed[toxic], minlength=1 << BITS)
            counts[0] += np.bincount(hashed[~toxic], minlength=1 << BITS)
    there = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(counts[0, there]), pa.array(counts[1, there])], names=["gram", "clean", "toxic"])


def table_of(chosen: np.ndarray) -> np.ndarray:
    """Each hash's feature, or -1."""
    index = np.full(1 << BITS, -1, np.int32)
    index[chosen] = np.arange(len(chosen))
    return index


def _rows(chosen: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = table_of(chosen)
        for batch in batches:
            for i, j in blocks(utf8(batch.column("text"))[1], BLOCK_BYTES):
                row, own = occurrences(*code_points(batch.column("text").slice(i, j - i).to_pylist()), index, len(chosen))
                cut = np.searchsorted(row, np.arange(j - i + 1))
                made = pa.array([own[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("label").slice(i, j - i), batch.column("fold").slice(i, j - i), made], names=["label", "fold", "own"])

    return rows


def fit(labels: np.ndarray, row: np.ndarray, feature: np.ndarray, ratio: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Weights of the features (times their ratios) and the intercept: logistic regression by Adam steps over all rows."""
    n, d = len(labels), len(ratio)
    w, b = np.zeros(d), float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    value = ratio[feature]
    for t in range(1, STEPS + 1):
        z = np.bincount(row, value * w[feature], n) + b
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / n
        g = np.append(np.bincount(feature, value * off[row], d) + ridge * w, off.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = RATE / (1 + t / 100) * m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w * ratio, b


def chosen_ridge(labels: np.ndarray, fold: np.ndarray, row: np.ndarray, feature: np.ndarray, ratio: np.ndarray) -> float:
    """The penalty with the least log loss over rows that the fit has not seen, fold by fold."""
    losses = []
    for ridge in RIDGES:
        loss = 0.0
        for k in np.unique(fold):
            seen = fold != k
            if len(np.unique(labels[seen])) < 2:
                continue
            own = seen[row]
            weights, intercept = fit(labels[seen], (np.cumsum(seen) - 1)[row[own]], feature[own], ratio, ridge)
            z = np.clip(np.bincount(row[~own], weights[feature[~own]], len(labels))[~seen] + intercept, -30, 30)
            loss += np.log1p(np.exp(np.where(labels[~seen] > 0, -z, z))).sum()
        losses.append(loss)
    return RIDGES[int(np.argmin(losses))]


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """The hashes of the chosen n-grams, their weights, intercept. The sample's ids, which are broadcast, are at most `sample`."""
    learn = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    learn = thinned(learn, F.col("doc_id"), 4 * sample).orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id", "label").limit(sample)
    learn = learn.withColumn("fold", (F.crc32(F.col("doc_id").cast("string")) % 4).cast("int"))
    seen = written(spark, texts_of(docs).join(F.broadcast(learn), "doc_id").repartition(8, "doc_id"), "labelled")
    nothing = np.zeros(0, np.int64)
    n = {r["label"]: r["count"] for r in seen.groupBy("label").count().collect()}
    if len(n) < 2:
        share = (n.get(1, 0) + 1) / (sum(n.values()) + 2)
        return nothing, np.zeros(0), float(np.log(share / (1 - share)))
    counts = seen.mapInArrow(_counter, "gram int, clean long, toxic long").groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    p, q = (F.col("toxic") + SMOOTHING) / (n[1] + 2 * SMOOTHING), (F.col("clean") + SMOOTHING) / (n[0] + 2 * SMOOTHING)
    ratio = F.log(p / q)
    # How far the ratio is from 0, in standard errors.
    strength = F.abs(ratio) / F.sqrt(1 / (F.col("toxic") + SMOOTHING) + 1 / (F.col("clean") + SMOOTHING))
    best = counts.select("gram", ratio.alias("ratio"), strength.alias("strength")).where(F.col("strength") >= SIGNIFICANT).orderBy("gram").toPandas()
    if best.empty:  # at most as many as there are hashes
        return nothing, np.zeros(0), float(np.log(n[1] / n[0]))
    chosen, ratios = best["gram"].to_numpy(), best["ratio"].to_numpy()
    found = seen.mapInArrow(_rows(chosen), "label int, fold int, own array<int>").toPandas()
    row, feature = np.repeat(np.arange(len(found)), [len(x) for x in found["own"]]), np.concatenate([np.asarray(x, np.int64) for x in found["own"]])
    known, fold = found["label"].to_numpy(float), found["fold"].to_numpy()
    return chosen, *fit(known, row, feature, ratios, chosen_ridge(known, fold, row, feature, ratios))


def _scorer(chosen: np.ndarray, weights: np.ndarray, intercept: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = table_of(chosen)
        for batch in batches:
            for i, j in blocks(utf8(batch.column("text"))[1], BLOCK_BYTES):
                z = np.full(j - i, intercept)
                if len(weights):
                    row, own = occurrences(*code_points(batch.column("text").slice(i, j - i).to_pylist()), index, len(weights))
                    z += np.bincount(row, weights[own], j - i)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))], names=["doc_id", "score"])

    return score


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    A null or empty text has the intercept's score; repeated rows each have a row; without a doc_id held_out is null, as it is of neither part; no rows give none; with no labels
    of a class all get the smoothed share of the other; other columns stay out. A score at the threshold is 1.
    """
    scored = texts_of(docs).mapInArrow(_scorer(*train(spark, docs, labels, label, sample)), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
