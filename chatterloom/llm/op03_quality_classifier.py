"""Quality classifier: regularised quadratic discriminant over statistics of whole texts.

Each class gets a mean and a covariance, shrunk towards the pooled covariance and its diagonal; the Cholesky
factor of each is computed once and kept. A score is the logistic of the difference of the two log densities
(Mahalanobis terms by triangular factors) plus that of the log priors, calibrated by a slope learnt on the same
rows.

Defined results: null and empty texts are scored as texts without words; rows with a null doc_id are scored as any
other and not held out; repeated rows each get their row; without labels of both classes every score is 0.5. Long
texts are scored whole. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, lean, text_steps, with_score
from .text_stats import NAMES, features

#: Labelled rows at most that a fit reads.
MAX_TRAIN = 20_000


@dataclass(frozen=True)
class Discriminant:
    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    log_dets: tuple[float, ...]
    log_prior: float
    slope: float
    offset: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        z = standard(x, self.centre, self.scale)
        return logistic(self.slope * self.margin(z) + self.offset)

    def margin(self, z: np.ndarray) -> np.ndarray:
        density = [-0.5 * (forward(low, (z - m).T) ** 2).sum(0) - 0.5 * d for m, low, d in zip(self.means, self.factors, self.log_dets)]
        return density[1] - density[0] + self.log_prior


def forward(low: np.ndarray, b: np.ndarray) -> np.ndarray:
    """y of low y = b for a lower triangle, column by column of b."""
    y = np.empty_like(b)
    for i in range(len(low)):
        y[i] = (b[i] - low[i, :i] @ y[:i]) / low[i, i]
    return y


def standard(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standard scores; those of a text of n words shrink by n / (n + 15), for a few words say little."""
    z = np.clip((x - centre) / scale, -25, 25)
    n = np.expm1(x[:, :1])
    z[:, 1:] *= n / (n + 15)
    return z


def logistic(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, to_pooled: float = 0.1, to_diagonal: float = 0.1) -> Discriminant | None:
    """None without rows of both classes."""
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return None
    order = np.lexsort([*x.T, y])  # the same rows give the same model, however they were dealt
    x, y = x[order], y[order]
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = standard(x, centre, scale)
    groups = [z[y == k] for k in (0, 1)]
    covs = [np.cov(g, rowvar=False, bias=True) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, covs)) / len(z)
    means, factors, dets = [], [], []
    for g, c in zip(groups, covs):
        a = min(0.9, to_pooled + 2 * z.shape[1] / len(g))
        c = (1 - a) * c + a * pooled
        c = (1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c)) + 1e-3 * np.eye(len(c))
        low = np.linalg.cholesky(c)
        means.append(g.mean(0))
        factors.append(low)
        dets.append(2 * np.log(np.diag(low)).sum())
    prior = float(np.log(len(groups[1]) / len(groups[0])))
    raw = Discriminant(centre, scale, tuple(means), tuple(factors), tuple(dets), prior, 1.0, 0.0)
    m = raw.margin(z)
    slope, offset = calibrated(m, y)
    return Discriminant(centre, scale, tuple(means), tuple(factors), tuple(dets), prior, slope, offset)


def calibrated(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic over the margins with the least squared error of the score; the grid keeps them sane where classes part."""
    m = np.clip(m, -200, 200)
    tried = [(((logistic(a * (m - c)) - y) ** 2).mean() + 1e-4 * abs(c) / 20 + 1e-5 * abs(a - 0.5), a, c) for a in (0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 1.0) for c in np.arange(-20, 10.5, 0.5)]
    _, a, c = min(tried)
    return a, -a * float(c)


def text_features(column: pa.Array) -> np.ndarray:
    found = [features(some) for _, _, some in text_steps(column)]
    return np.concatenate(found) if found else np.zeros((0, len(NAMES)))


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, inverse: bool, most: int) -> DataFrame:
    """(doc_id, label, text) of at most `most` labelled rows outside the held-out fold, in an order set by the ids.

    Rows are held out where crc32(doc_id as text) mod folds is `held` (or is not, if inverse)."""
    r = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    out = (r != held) if not inverse else (r == held)
    chosen = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("y")).where(F.col("y").isin(0, 1) & out)
    # documents first: a label whose document has gone is not counted against the bound
    there = docs.select(docs["doc_id"].cast("long").alias("doc_id")).distinct()
    chosen = chosen.groupBy("doc_id").agg(F.max("y").alias("y")).join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return id_text(docs).join(F.broadcast(chosen), "doc_id")  # `most` rows of two numbers


def train(docs: DataFrame, labels: DataFrame, folds: int | None = 5, held: int = 0, max_train: int = MAX_TRAIN) -> Discriminant | None:
    """Fits on at most max_train labelled rows outside the held-out fold."""
    rows = sample(docs, labels, "quality", folds or 1, held if folds else -1, False, max_train)

    @lean
    def told(batches):
        for b in batches:
            f = text_features(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(list(f), pa.list_(pa.float64()))], names=["y", "f"])

    got = rows.select("y", "text").mapInArrow(told, "y int, f array<double>").toArrow()
    if not got.num_rows:
        return None
    y = got["y"].to_numpy()
    return fit(np.array(got["f"].combine_chunks().flatten()).reshape(len(y), -1), y)


def classify(docs: DataFrame, model: Discriminant | None, threshold: float = 0.3, score: str = "score", text: str = "text") -> DataFrame:
    """docs with a column `score`; every other column passes through."""

    def scores(column):
        f = text_features(column)
        return model.score(f) if model else np.full(len(f), 0.5)

    return with_score(docs, scores, score, text)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return classify(id_text(docs), model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
