"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

The statistics of every text come from one pass over its bytes and words. Class means and covariances come from
sums over all labelled rows outside the held-out quarter (one row for each class and fold reaches the driver); each covariance
is shrunk towards the pooled one and towards its diagonal, by the shares with the least log loss over three folds of those rows. The score is the posterior of the good class by the difference
of Mahalanobis log densities, from Cholesky factors that are made once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, held_out, table, texts_of, utf8, written

THRESHOLD = 0.7
#: Shares of the pooled covariance and of the diagonal in a class's covariance that the folds choose from.
SHRINKAGES = tuple((p, d) for p in (0.1, 0.4, 0.7, 0.9) for d in (0.0, 0.05, 0.1))
#: Added to each variance: measures that never vary have a scale too.
RIDGE = 1e-3
BLOCK_BYTES = 1 << 20

LETTERS, CAPITALS, DIGITS, SPACES, STOPS, SHOUTS, SYMBOLS, REST = range(8)
KIND = np.full(256, REST, np.uint8)
KIND[97:123] = KIND[128:] = LETTERS
KIND[65:91] = CAPITALS
KIND[48:58] = DIGITS
KIND[[9, 10, 11, 12, 13, 32]] = SPACES
KIND[[44, 46, 58, 59, 63]] = STOPS
KIND[33] = SHOUTS
KIND[[35, 36, 37, 38, 42, 60, 62, 64, 92, 94, 95, 123, 124, 125, 126]] = SYMBOLS

FEATURES = ("words", "word_length", "capitals", "digits", "stops", "shouts", "symbols", "other_signs", "distinct_words", "fresh_triples", "repeated_lines", "line_length")


def _of_words(text: str) -> tuple[int, int, float, float, int]:
    """Words, distinct words, share of distinct word triples, share of repeated lines, lines."""
    words = text.split()
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    triples = max(1, len(words) - 2)
    return len(words), len(set(words)), len(set(zip(words, words[1:], words[2:], strict=False))) / triples if len(words) > 2 else 1.0, 1 - len(set(lines)) / max(1, len(lines)), len(lines)


def statistics(texts: list[str], data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text; logarithms of sizes and square roots of shares, which are nearer to normal."""
    n = len(texts)
    kinds = np.bincount(np.repeat(np.arange(n), np.diff(at)) * 8 + KIND[data], minlength=8 * n).reshape(n, 8).astype(float)
    words, distinct, fresh, again, lines = np.array([_of_words(t) for t in texts], float).reshape(n, 5).T
    w, signs = np.maximum(words, 1), np.maximum(kinds.sum(axis=1) - kinds[:, SPACES], 1)
    share = lambda k, of: np.sqrt(np.minimum(kinds[:, k] / of, 4))
    return np.stack(
        (
            np.log1p(words),
            np.log1p(signs / w),
            share(CAPITALS, signs),
            share(DIGITS, signs),
            share(STOPS, w),
            share(SHOUTS, w),
            share(SYMBOLS, signs),
            share(REST, signs),
            np.log1p(distinct) / np.log1p(w),
            np.sqrt(fresh),
            np.sqrt(again),
            np.log1p(signs / np.maximum(lines, 1)),
        ),
        axis=1,
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = utf8(batch.column("text"))
        for i, j in blocks(at, BLOCK_BYTES):
            x = statistics(batch.column("text").slice(i, j - i).to_pylist(), data[at[i] : at[j]], at[i : j + 1] - at[i])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *map(pa.array, x.T)], names=["doc_id", *FEATURES])


def measured(docs: DataFrame) -> DataFrame:
    return texts_of(docs).mapInArrow(_measure, "doc_id long, " + ", ".join(f"{x} double" for x in FEATURES))


def with_statistics(docs: DataFrame, column: str) -> DataFrame:
    """docs with a struct of FEATURES of its text; the other columns stay in the JVM."""

    @F.arrow_udf(", ".join(f"{x} double" for x in FEATURES))
    def of_text(texts: pa.Array) -> pa.Array:
        data, at = utf8(texts)
        made = [statistics(texts.slice(i, j - i).to_pylist(), data[at[i] : at[j]], at[i : j + 1] - at[i]) for i, j in blocks(at, BLOCK_BYTES)]
        return pa.StructArray.from_arrays([pa.array(x) for x in np.concatenate([np.zeros((0, len(FEATURES))), *made]).T], names=list(FEATURES))

    return docs.withColumn(column, of_text(F.coalesce(F.col("text").cast("string"), F.lit(""))))


class Discriminant:
    """Two normal classes. With a class unseen, the score is the smoothed share of the other."""

    def __init__(self, sums: dict[int, tuple[int, np.ndarray, np.ndarray]], pooled: float, diagonal: float):
        """sums: by class 0 and 1 the number of rows, their sum, and the sum of their outer products."""
        n = [sums[k][0] if k in sums else 0 for k in (0, 1)]
        self.share = (n[1] + 1) / (sum(n) + 2)
        self.classes = None
        if min(n):
            means = [sums[k][1] / n[k] for k in (0, 1)]
            covariances = [sums[k][2] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
            both = (n[0] * covariances[0] + n[1] * covariances[1]) / sum(n)
            self.classes = []
            for k in (0, 1):
                own = (1 - pooled - diagonal) * covariances[k] + pooled * both + diagonal * np.diag(np.diag(covariances[k]))
                factor = np.linalg.cholesky(own + RIDGE * np.eye(len(own)))
                self.classes.append((means[k], np.linalg.inv(factor), np.log(np.diag(factor)).sum(), np.log(n[k] / sum(n))))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), self.share)
        bad, good = (prior - half - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1) for mean, inverse, half, prior in self.classes)
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def _losses(models: dict[int, list[Discriminant]]):
    """models by fold: sums over the rows of a fold of the log loss of each model."""

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(SHRINKAGES))
        for batch in batches:
            x = np.stack([batch.column(f).to_numpy() for f in FEATURES], axis=1)
            label, fold = (batch.column(c).to_numpy() for c in ("label", "fold"))
            for k, own in models.items():
                for j, model in enumerate(own):
                    p = np.clip(model.score(x[fold == k]), 1e-9, 1 - 1e-9)
                    total[j] -= np.log(np.where(label[fold == k] == 1, p, 1 - p)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["setting", "loss"])

    return losses


def train(spark: SparkSession, features: DataFrame, labels: DataFrame, label: str) -> Discriminant:
    """From all rows of labels (doc_id, label 0 or 1) outside the held-out quarter."""
    learn = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    labelled = features.join(learn.withColumn("fold", (F.crc32(F.col("doc_id").cast("string")) % 4).cast("int")), "doc_id").select("label", "fold", *FEATURES)
    seen = written(spark, labelled, "labelled")
    d, x = len(FEATURES), [F.col(f) for f in FEATURES]
    sums = [F.count("*").alias("n"), *(F.sum(x[i]).alias(f"s{i}") for i in range(d)), *(F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d))]
    found: dict[tuple[int, int], tuple] = {}
    for r in seen.groupBy("label", "fold").agg(*sums).collect():
        found[r["label"], r["fold"]] = (r["n"], np.array([r[f"s{i}"] for i in range(d)]), np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)]))

    def without(fold: int | None) -> dict[int, tuple]:
        return {k: tuple(sum(y) for y in zip(*own, strict=True)) for k in (0, 1) if (own := [v for (c, f), v in sorted(found.items()) if c == k and f != fold])}

    models = {fold: [Discriminant(without(fold), *s) for s in SHRINKAGES] for fold in sorted({f for _, f in found})}
    losses = {r["setting"]: r["loss"] for r in seen.mapInArrow(_losses(models), "setting long, loss double").groupBy("setting").agg(F.sum("loss").alias("loss")).collect()}
    return Discriminant(without(None), *min(SHRINKAGES, key=lambda s: losses.get(SHRINKAGES.index(s), 0.0)))


def scorer(model: Discriminant):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(f).to_numpy() for f in FEATURES], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return score


def score_of(model: Discriminant, column: str) -> Column:
    """The score of a struct of FEATURES."""

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(model.score(np.stack([x.field(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)))

    return score(F.col(column))


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    A null or empty text is scored by its statistics, which are zeros; repeated rows each have a row; without a doc_id held_out is null, as it is of neither part; no rows give none;
    with no labels of a class all get the share of the other; other columns stay out. A score at the threshold is 1.
    """
    features = written(spark, measured(docs), "statistics")
    scored = features.mapInArrow(scorer(train(spark, features, labels, label)), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
