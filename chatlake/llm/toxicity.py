"""Toxicity: a factorization machine over hashed terms.

A document's terms are its distinct words and their leading 4 and 5 characters, hashed to 31 bits.
Of the terms in the examples, those take part whose presence depends on the label (chi-square at
least ``MIN_CHI2``), and those of pairs that tell what single terms do not: a machine of the former is
fitted first, and a pair is taken if the documents that hold both its terms are toxic more or less
often than that machine says (score test, at least ``MIN_PAIR_CHI2``, above what chance gives among
all pairs, and ``MIN_EXCESS`` documents).  Of each kind ``MAX_TERMS`` at most, the best, take part.  The machine adds a weight a term and,
for every pair of terms, the inner product of their factors, which a linear model cannot express (a
word that is harmless alone but not beside another).  Both parts are learned together by AdaGrad on
the logistic loss.

Fitting takes the labelled rows outside the held-out fold, one a doc_id, chosen by a hash of it: at most
about ``MAX_EXAMPLES`` with about ``MAX_ENTRIES`` distinct terms in all, whose squares add up to about ``MAX_SQUARES``
(pairs of terms are summed document by document, so long documents cost by their squares).  Beyond these numbers, the
share of documents that teach falls accordingly.  The sample is brought to one task, which the three bounds make
safe (4 bytes a term, some 75 seconds for the pairs); the machine that comes back has at most ``2 * MAX_TERMS`` terms.  Scoring is one pass over all whole texts without
a shuffle.

Defined cases
* null and empty texts have no terms; their score is that of the bias.
* labels that are null, or whose doc_id is null, teach nothing; repeated labels of a document count
  once, with the larger label.  Of several rows of an id, one teaches, that with the smallest text hash.
* very long texts teach and are scored whole.  An empty table gives an empty result.
* without examples, or with one class only, all scores are the prior, 0.5 without any example.
* rows are scored one by one, so repeated rows, other columns and clashing names don't matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.llm.quality import in_fold
from chatlake.session import checkpointed, ship

FACTORS, MAX_EXAMPLES, MAX_ENTRIES, MAX_SQUARES, THRESHOLD = 4, 30_000, 6_000_000, 10_000_000_000, 0.3
MAX_TERMS, MIN_ROWS, MIN_CHI2 = 1 << 16, 3, 16.0
MIN_PAIR_CHI2, MIN_EXCESS, PAIRS_AT_ONCE = 45.0, 4.0, 1 << 22
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 64, 0.1, 1e-4, 7
WORD = re.compile(r"[^\W\d_]+")
CACHE = 300_000


def hashes(word: str) -> set[int]:
    """The 31-bit hashes of a word's terms."""
    forms = {word, word[:4] + "*", word[:5] + "*"} if len(word) > 4 else {word}
    return {zlib.crc32(f.encode("utf-8", "replace")) & 0x7FFFFFFF for f in forms}


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


class Lookup:
    """Terms of texts as sorted places among ``known`` hashes, or as the hashes themselves."""

    def __init__(self, known: np.ndarray | None = None):
        self.places = None if known is None else {int(h): i for i, h in enumerate(known)}
        self.memory: dict[str, tuple[int, ...]] = {}

    def of(self, word: str) -> tuple[int, ...]:
        got = self.memory.get(word)
        if got is None:
            got = tuple(hashes(word)) if self.places is None else tuple(self.places[h] for h in hashes(word) if h in self.places)
            if len(self.memory) >= CACHE:  # only a memory of frequent words
                self.memory.clear()
            self.memory[word] = got
        return got

    def sparse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, the distinct terms of each text one after the other)."""
        rows = []
        for text in texts:
            found: set[int] = set()
            for w in words(text):
                found.update(self.of(w))
            rows.append(sorted(found))
        flat = [x for row in rows for x in row]
        return np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64), np.array(flat, np.int32)


def segment_sums(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


@dataclass
class Machine:
    """Bias, and weight and factors of each known term (sorted hashes)."""

    bias: float
    known: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def score(self, offsets: np.ndarray, flat: np.ndarray) -> np.ndarray:
        v = self.factors[flat]
        s = segment_sums(v, offsets)
        margin = self.bias + segment_sums(self.weights[flat], offsets) + 0.5 * (s**2 - segment_sums(v**2, offsets)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def telling_terms(offsets: np.ndarray, flat: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sorted hashes of the terms whose presence and label are dependent, by their chi-square."""
    n, n1 = len(y), y.sum()
    known, code = np.unique(flat, return_inverse=True)
    rows = np.bincount(code, minlength=len(known)).astype(float)
    hits = np.bincount(code, np.repeat(y, np.diff(offsets)), len(known))
    p = n1 / n
    chi2 = (hits - rows * p) ** 2 / np.maximum(rows * p * (1 - p) * (1 - rows / (n + 1)), 1e-12)
    good = np.flatnonzero((rows >= MIN_ROWS) & (chi2 >= MIN_CHI2))
    good = good[np.lexsort((known[good], -chi2[good]))][:MAX_TERMS]
    return np.sort(known[good])


def telling_pairs(offsets: np.ndarray, flat: np.ndarray, y: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Sorted hashes of the terms of pairs that tell more of the labels than ``told``, the scores so far.

    All pairs of terms in a document are summed, term by term, each with the rarer ones behind it.
    """
    known, code, rows = np.unique(flat, return_inverse=True, return_counts=True)
    size = int((rows > MIN_EXCESS).sum())  # fewer rows cannot hold an excess of so many
    rank = np.empty(len(known), np.int32)
    rank[np.lexsort((known, -rows))] = np.arange(len(known))
    key = np.repeat(np.arange(len(y)) << 32, np.diff(offsets))
    key += rank[code]
    del code
    key = key[key & 0xFFFFFFFF < size]
    key.sort()  # by document, then from the most frequent term
    owner, term = (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)
    del key
    left = (np.cumsum(np.bincount(owner, minlength=len(y)))[owner] - np.arange(len(owner)) - 1).astype(np.int32)  # terms of the document behind this one
    places = np.argsort(term, kind="stable").astype(np.int32)
    firsts = np.searchsorted(term[places], np.arange(size + 1))
    off, spread = y - told, np.maximum(told * (1 - told), 1e-3)
    best = np.zeros(size)
    for a in range(size):
        mine = places[firsts[a] : firsts[a + 1]]
        mine = mine[left[mine] > 0]

        def sums(values: np.ndarray, mine: np.ndarray = mine) -> np.ndarray:
            total, parts = np.zeros(size), np.cumsum(left[mine], dtype=np.int64) // PAIRS_AT_ONCE
            for part in np.split(mine, np.flatnonzero(np.diff(parts)) + 1):
                n = left[part].astype(np.int64)
                own = np.cumsum(n) - n
                total += np.bincount(term[np.repeat(part + 1 - own, n) + np.arange(n.sum())], np.repeat(values[owner[part]], n), size)
            return total

        if max(off[owner[mine]].clip(0).sum(), -off[owner[mine]].clip(None, 0).sum()) < MIN_EXCESS:
            continue  # no pair with this term can reach it
        excess = sums(off)
        found = np.flatnonzero(np.abs(excess) >= MIN_EXCESS)
        if len(found):
            chi2 = excess[found] ** 2 / sums(spread)[found]
            found, chi2 = found[chi2 >= MIN_PAIR_CHI2], chi2[chi2 >= MIN_PAIR_CHI2]
            best[found] = np.maximum(best[found], chi2)
            best[a] = max(best[a], chi2.max(initial=0))
    good = np.flatnonzero(best)
    good = good[np.lexsort((good, -best[good]))][:MAX_TERMS]
    return np.sort(known[np.argsort(rank)[good]])


def among(known: np.ndarray, offsets: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, places among ``known``) of the terms that are known."""
    place = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
    kept = known[place] == flat if len(known) else np.zeros(len(flat), bool)
    lengths = segment_sums(kept.astype(float), offsets).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), place[kept]


def learn(offsets: np.ndarray, flat: np.ndarray, y: np.ndarray) -> Machine:
    """The machine of the telling terms, or of these and those of telling pairs."""
    prior = (y.sum() + 1) / (len(y) + 2)
    if not 0 < y.sum() < len(y):
        return Machine(float(np.log(prior / (1 - prior))), np.empty(0, np.int32), np.empty(0), np.empty((0, FACTORS)))
    known = telling_terms(offsets, flat, y)
    machine = fit(known, offsets, flat, y)
    both = np.union1d(known, telling_pairs(offsets, flat, y, machine.score(*among(known, offsets, flat))))
    return fit(both, offsets, flat, y) if len(both) > len(known) else machine


def fit(known: np.ndarray, offsets: np.ndarray, flat: np.ndarray, y: np.ndarray) -> Machine:
    """AdaGrad on the logistic loss; the same examples in the same order give the same machine."""
    n = len(y)
    rng = np.random.default_rng(SEED)
    prior = (y.sum() + 1) / (n + 2)
    bias = float(np.log(prior / (1 - prior)))
    offsets, flat = among(known, offsets, flat)
    lengths = np.diff(offsets)
    size = len(known)
    weights, factors = np.zeros(size), rng.normal(0, 0.02, (size, FACTORS))
    seen_w, seen_v, seen_b = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3), 1e-3
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at : at + BATCH]
            count = lengths[rows]
            own = np.concatenate([[0], np.cumsum(count)])
            f = flat[np.repeat(offsets[rows] - own[:-1], count) + np.arange(own[-1])]
            v = factors[f]
            s = segment_sums(v, own)
            margin = bias + segment_sums(weights[f], own) + 0.5 * (s**2 - segment_sums(v**2, own)).sum(axis=1)
            g = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[rows]
            each = np.repeat(g, count)
            used, code = np.unique(f, return_inverse=True)
            gw = np.bincount(code, each, len(used)) / len(rows) + DECAY * weights[used]
            pair = each[:, None] * (np.repeat(s, count, axis=0) - v)
            gv = np.stack([np.bincount(code, pair[:, k], len(used)) for k in range(FACTORS)], axis=1) / len(rows) + DECAY * factors[used]
            seen_w[used] += gw**2
            seen_v[used] += gv**2
            seen_b += g.mean() ** 2
            weights[used] -= RATE * gw / np.sqrt(seen_w[used])
            factors[used] -= 0.2 * RATE * gv / np.sqrt(seen_v[used])
            bias -= RATE * g.mean() / np.sqrt(seen_b)
    return Machine(float(bias), known, weights, factors)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def terms_of(texts: pa.Array) -> pa.Array:
    offsets, flat = Lookup().sparse(texts.to_pylist())
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))


def learn_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, labels, ids = [], [], []
    for batch in batches:
        column = batch.column("terms")
        at, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        parts += [values[a:b].copy() for a, b in zip(at[:-1], at[1:], strict=True)]
        labels += batch.column("label").to_pylist()
        ids += batch.column("doc_id").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (zlib.crc32(str(ids[i]).encode()), str(ids[i]), len(parts[i]), parts[i].tobytes()))
    offsets = np.concatenate([[0], np.cumsum([len(parts[i]) for i in order])]).astype(np.int64)
    machine = learn(offsets, np.concatenate([*[parts[i] for i in order], np.empty(0, np.int32)]), np.array([labels[i] for i in order], float))
    lists = [pa.array([x], pa.list_(t)) for x, t in ((machine.known.astype(np.int32), pa.int32()), (machine.weights, pa.float64()), (machine.factors.reshape(-1), pa.float64()))]
    yield pa.RecordBatch.from_arrays([pa.array([machine.bias]), *lists], names=["bias", "known", "weights", "factors"])


def chosen(share: float, seed: int) -> Column:
    """Whether a hash of the doc_id falls into the share."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), F.lit(1_000_000)) < int(share * 1_000_000)


def train(docs: DataFrame, labels: DataFrame, label_col: str, folds: int = 4, held_fold: int = 2, max_examples: int = MAX_EXAMPLES, max_entries: int = MAX_ENTRIES, max_squares: int = MAX_SQUARES) -> Machine:
    """A machine from labelled documents outside the held-out fold, within about the three bounds."""
    ship(docs.sparkSession)
    taught = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).filter(~in_fold("doc_id", folds, held_fold)).groupBy(F.col("doc_id").alias("l_id")).agg(F.max(label_col).alias("label"))
    share = min(1.0, max_examples / max(1, taught.count()))
    read = docs.filter(F.col("doc_id").isNotNull() & ~in_fold("doc_id", folds, held_fold) & chosen(share, SEED))
    rows = read.select("doc_id", F.struct(F.xxhash64("text").alias("hash"), terms_of(F.col("text")).alias("terms")).alias("row")).groupBy("doc_id").agg(F.min("row").alias("row"))
    examples = checkpointed(rows.join(taught, F.col("doc_id") == F.col("l_id")).select("doc_id", "row.terms", F.col("label").cast("int").alias("label")))
    size = F.size("terms").cast("long")
    entries, squares = (x or 0 for x in examples.agg(F.sum(size), F.sum(size * size)).first())
    if entries > max_entries or squares > max_squares:
        examples = examples.filter(chosen(min(max_entries / max(1, entries), max_squares / max(1, squares)), SEED + 1))
    row = examples.repartition(1).mapInArrow(learn_task, "bias double, known array<int>, weights array<double>, factors array<double>").first()
    if row is None:  # no example at all
        return Machine(0.0, np.empty(0, np.int32), np.empty(0), np.empty((0, FACTORS)))
    return Machine(row["bias"], np.array(row["known"], np.int32), np.array(row["weights"], float), np.array(row["factors"], float).reshape(-1, FACTORS))


def score_texts(machine: Machine, docs: DataFrame, text_col: str = "text") -> Column:
    """The score of each whole text, 0 to 1.  The broadcast machine has ``MAX_TERMS`` terms at most."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf(T.DoubleType())
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        lookup = Lookup(known.known)
        for batch in texts:
            yield pa.array(known.score(*lookup.sparse(batch.to_pylist())))

    return scored(F.col(text_col))
