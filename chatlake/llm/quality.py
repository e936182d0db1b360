"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text gives a short vector of transformed statistics (lengths, shares of character
classes, repetition).  Each class has a Gaussian over that vector; its covariance is shrunk towards
its diagonal, the more the fewer examples there are, plus a small multiple of the identity.  The score is the posterior of label 1, from the
difference of the two log densities; the Mahalanobis terms use inverse Cholesky factors that are
computed once, when the model is made.

Fitting uses all labelled rows outside the held-out fold, without a sample: the counts, sums and
products per class are ordinary aggregates, combined before the shuffle, and one row a class reaches
the driver whatever the number of rows.  Scoring is one pass over the texts without a shuffle.

Defined cases
* null text counts as empty; an empty text gets the score of its all-zero statistics.
* labels that are null, or whose doc_id is null, teach nothing; repeated labels of a document count
  once, with the larger label.  Repeated documents of an id are each an example.
* a class without examples, or an empty table: every score is the prior, 0.5 without any example.
* very long texts are judged whole.  Rows are scored one by one, so repeated rows, other columns and clashing names
  don't matter; two rows of equal text tie.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.session import ship

SHRINK, RIDGE, THRESHOLD = 0.02, 1e-5, 0.3
FEATURES = ("words", "word_length", "upper", "digits", "space", "stops", "marks", "symbols", "bars", "wide", "distinct", "top_word", "lines", "same_next", "mark_ends", "letters")
_STOPS, _MARKS = b".,;:", b"!?\"'()-"
_CLASS = np.full(256, 7)  # the class of each byte, for one count over the whole text
_CLASS[128:] = 6
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[list(_STOPS)] = 4
_CLASS[list(_MARKS)] = 5
_CLASS[ord("|")] = 8


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text, in the order of FEATURES."""
    data = text.encode("utf-8", "replace")
    n = max(1, len(data))
    share = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=9) / n if data else np.zeros(9)
    words = text.split()
    m = max(1, len(words))
    seen = Counter(words)
    same = sum(map(str.__eq__, words[1:], words))
    odd = sum(k for w, k in seen.items() if not w[-1].isalnum() and w[-1] not in ".,;:")
    root = lambda x: float(np.sqrt(x))
    return [
        np.log1p(len(words)),
        np.log1p(n / m),
        root(share[1]),
        root(share[2]),
        share[3],
        root(share[4]),
        root(share[5]),
        root(share[7]),
        root(share[8]),
        root(share[6]),
        np.log1p(len(seen)) - np.log1p(len(words)),
        root(max(seen.values(), default=0) / m),
        np.log1p(m / (1 + text.count("\n"))),
        root(same / m),
        root(odd / m),
        share[0],
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics_of(texts: pa.Array) -> pa.Array:
    rows = [statistics(t or "") for t in texts.to_pylist()]
    flat = np.array(rows, float).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), pa.array(flat))


@dataclass
class Model:
    """Means, inverse Cholesky factors and log constants of the classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        logs = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def model_of(counts: np.ndarray, sums: np.ndarray, products: np.ndarray, shrink: float = SHRINK, ridge: float = RIDGE) -> Model:
    """From each class's count, sums and matrix of products."""
    d = sums.shape[1]
    means, factors, constants = np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2)
    prior = (counts + 1) / (counts.sum() + 2)
    for c in (0, 1):
        if counts.min() < 2:  # nothing to tell the classes apart by
            constants[c] = np.log(prior[c])
            continue
        means[c] = sums[c] / counts[c]
        cov = products[c] / counts[c] - np.outer(means[c], means[c])
        own = np.diag(np.maximum(np.diag(cov), 0))
        part = max(shrink, d / (d + counts[c]))
        cov = (1 - part) * cov + part * own + ridge * np.eye(d)
        factors[c] = np.linalg.inv(np.linalg.cholesky(cov))
        constants[c] = np.log(prior[c]) + np.log(np.abs(np.diag(factors[c]))).sum()
    return Model(means, factors, constants)


def fit(features: DataFrame, label: str = "label", vector: str = "x", shrink: float = SHRINK, ridge: float = RIDGE) -> Model:
    """From a DataFrame with a 0/1 label and a vector of statistics in each row."""
    d = len(FEATURES)
    x = [F.col(vector)[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(v) for v in x] + [F.sum(x[i] * x[j]) for i, j in pairs]
    rows = features.groupBy(F.col(label).cast("int").alias("c")).agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("s")).filter(F.col("c").isin(0, 1)).collect()
    counts, first, second = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for r in rows:
        counts[r["c"]], first[r["c"]] = r["n"], r["s"][:d]
        for (i, j), v in zip(pairs, r["s"][d:], strict=True):
            second[r["c"], i, j] = second[r["c"], j, i] = v
    return model_of(counts, first, second, shrink, ridge)


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text, modulo ``folds``, is ``fold``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x) of each row."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), statistics_of(F.col(text_col)).alias("x"))


def train(vectors: DataFrame, labels: DataFrame, label_col: str, folds: int = 5, held_fold: int = 0) -> Model:
    """A model from the labelled rows of ``features`` outside the held-out fold."""
    ship(vectors.sparkSession)
    taught = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).filter(~in_fold("doc_id", folds, held_fold)).groupBy(F.col("doc_id").alias("l_id")).agg(F.max(label_col).alias("label"))
    return fit(vectors.join(taught, F.col("doc_id") == F.col("l_id")))


def score_vectors(model: Model, vector: str = "x") -> Column:
    """The score of each vector of statistics, 0 to 1."""

    @F.arrow_udf(T.DoubleType())
    def scored(x: pa.Array) -> pa.Array:
        return pa.array(model.score(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)))

    return scored(F.col(vector))


def score_texts(model: Model, text_col: str = "text") -> Column:
    """The score of each text, 0 to 1, in one pass."""

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        rows = [statistics(t or "") for t in texts.to_pylist()]
        return pa.array(model.score(np.array(rows, float).reshape(-1, len(FEATURES))))

    return scored(F.col(text_col))
