"""Language-model scores from the subword lattice of an existing vocabulary.

A word's lattice has an arc for every vocabulary piece that matches at some place (bytes for
characters without a piece).  The forward recursion, in log space, sums over all segmentations; the
backward one gives expected piece counts.  The vocabulary is given; its ranks are the first scores,
and two rounds of expectation maximisation over all training words turn them into the corpus's piece
probabilities.  ``score`` is the marginal probability of the text: that of its words' lattices and of
its end.

``mixed_score`` is a column for comparison: each word's lattice has one arc more, for the whole word, with
its discounted training frequency; the discounted mass goes to the pieces.

Pieces never cross white space, so a text's probability is the product over its words and its end,
and each distinct word is computed once.  Words are counted in tasks before they are shuffled.
Words that make up at least 1/``HEAVY`` of all tokens are at most ``HEAVY`` many whatever the corpus;
their values are broadcast and summed inside the pass over the texts.  Only the other words of a
document are shuffled, to meet their values in a join, so no frequent word is a hot key.

Defined cases
* null text counts as empty: one token, the end.  A null doc_id is not held out and teaches.
* A-Z only are lower-cased; words are runs without the six ASCII white-space characters.
* repeated rows (same doc_id and text) are each returned.  An empty table gives an empty result;
  without training tokens, counts are zero and the vocabulary's ranks alone give the score.
* very long texts and words teach and are scored whole, long words by the same recursions position by
  position.  Only doc_id and text are read, so other columns, clashing names included, don't matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.quality import in_fold
from chatlake.session import checkpointed, ship

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HEAVY, ROUNDS, DISCOUNT, ALPHA, FLUSH = 150_000, 2, 0.75, 0.1, 100_000
SHORT, SLOTS, SPACE, EMPTY, AT_ONCE = 48, 1 << 20, "▁", -2, 60_000
BASE, MIX = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15)
LN10 = math.log(10)


def read_pieces(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces by rank, without control and byte pieces and those over white space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
    named = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not special(i)]
    return [p for p in named if SPACE not in p[1:]]


@dataclass
class Pieces:
    """Pieces with log probabilities (natural), that of a byte, and that of the end of a text."""

    names: list[str]
    logs: np.ndarray
    byte: float
    end: float


def first_scores(names: list[str]) -> Pieces:
    """Probabilities falling with the rank in the vocabulary."""
    p = 1 / (np.arange(len(names)) + 10.0)
    p *= 0.99 / p.sum()
    return Pieces(names, np.log(p), math.log(1e-6), math.log(0.01))


def codes_of(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)


def log_sum(a: float, b: float) -> float:
    high = max(a, b)
    return high if high == -math.inf else high + math.log1p(math.exp(min(a, b) - high))


class Lattice:
    """Forward and backward recursions over many words of equal length at once.

    A hash table holds every prefix of every piece, so a span is followed only as long as some piece
    starts with it, and only for the words for which one does.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.longest = max(map(len, pieces.names), default=1)
        self.where = {p: i for i, p in enumerate(pieces.names)}
        prefixes = {p[:n]: -1 for p in pieces.names for n in range(1, len(p) + 1)} | self.where
        self.tags, self.ids = np.zeros(SLOTS, np.uint64), np.full(SLOTS, EMPTY, np.int32)
        by_size: dict[int, list[str]] = {}
        for p in prefixes:
            by_size.setdefault(len(p), []).append(p)
        for group in by_size.values():
            h = np.zeros(len(group), np.uint64)
            for column in codes_of(group).T:
                h = self._step(h, column)
            for p, x, slot in zip(group, h, self._slot(h).tolist(), strict=True):
                while self.ids[slot] != EMPTY:
                    slot = (slot + 1) % SLOTS
                self.tags[slot], self.ids[slot] = x, prefixes[p]

    @staticmethod
    def _step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (h * BASE + c.astype(np.uint64) + np.uint64(1)) * MIX

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(44)).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 for a mere prefix, EMPTY if no piece starts so."""
        slot = self._slot(h)
        found = self.ids[slot]
        odd = np.flatnonzero((found != EMPTY) & (self.tags[slot] != h))
        while len(odd):  # taken by another prefix: the next slot
            slot[odd] = (slot[odd] + 1) % SLOTS
            found[odd] = self.ids[slot[odd]]
            odd = odd[(found[odd] != EMPTY) & (self.tags[slot[odd]] != h[odd])]
        return found

    def arcs(self, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(start, stop, rows, their pieces or -1 for bytes, log weights) of all spans, by start."""
        n, length = codes.shape
        for i in range(length):
            rows, h = np.arange(n), np.zeros(n, np.uint64)
            for j in range(i + 1, min(length, i + self.longest) + 1):
                h = self._step(h, codes[rows, j - 1])
                found = self._find(h)
                if j == i + 1 and (found < 0).any():
                    bare = rows[found < 0]
                    c = codes[bare, i]
                    yield i, j, bare, np.full(len(bare), -1), self.pieces.byte * (1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000))
                hit = found >= 0
                if hit.any():
                    yield i, j, rows[hit], found[hit], self.pieces.logs[found[hit]]
                on = found != EMPTY
                rows, h = rows[on], h[on]
                if not len(rows):
                    break

    def forward(self, codes: np.ndarray, arcs) -> np.ndarray:
        alpha = np.full((codes.shape[1] + 1, len(codes)), -np.inf)
        alpha[0] = 0
        for i, j, rows, _, weight in arcs:
            alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + weight)
        return alpha

    def expected(self, codes: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
        """Add each piece's expected count in words that occur ``counts`` times; bytes go last."""
        arcs = list(self.arcs(codes))
        alpha = self.forward(codes, arcs)
        beta = np.full(alpha.shape, -np.inf)
        beta[-1] = 0
        for i, j, rows, found, weight in reversed(arcs):
            rest = weight + beta[j, rows]
            np.add.at(into, found, np.exp(alpha[i, rows] + rest - alpha[-1, rows]) * counts[rows])
            beta[i, rows] = np.logaddexp(beta[i, rows], rest)

    def long_word(self, word: str) -> float:
        """The forward recursion for one long word, in bounded memory."""
        n, logs = len(word), self.pieces.logs
        alpha = np.full(n + 1, -np.inf)
        alpha[0] = 0
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                at = self.where.get(word[i:j])
                if at is not None:
                    alpha[j] = np.logaddexp(alpha[j], alpha[i] + logs[at])
                elif j == i + 1:
                    alpha[j] = np.logaddexp(alpha[j], alpha[i] + self.pieces.byte * len(word[i].encode("utf-8", "replace")))
        return float(alpha[n])

    def expected_long(self, word: str, count: float, into: np.ndarray) -> None:
        """``expected`` for one long word, position by position, in memory that grows with its length alone."""
        n, logs = len(word), self.pieces.logs

        def arcs(i: int) -> Iterator[tuple[int, int, float]]:
            for j in range(i + 1, min(n, i + self.longest) + 1):
                at = self.where.get(word[i:j])
                if at is not None:
                    yield j, at, logs[at]
                elif j == i + 1:
                    yield j, -1, self.pieces.byte * len(word[i].encode("utf-8", "replace"))

        alpha, beta = [-math.inf] * n + [-math.inf], [-math.inf] * n + [0.0]
        alpha[0] = 0.0
        for i in range(n):
            for j, _, weight in arcs(i):
                alpha[j] = log_sum(alpha[j], alpha[i] + weight)
        for i in reversed(range(n)):
            for j, at, weight in arcs(i):
                rest = weight + beta[j]
                into[at] += math.exp(alpha[i] + rest - alpha[n]) * count
                beta[i] = log_sum(beta[i], rest)

    def logs_of(self, words: list[str]) -> np.ndarray:
        """The log of each word's marginal probability."""
        out = np.empty(len(words))
        for rows, codes in by_length(words):
            if codes is None:
                out[rows] = [self.long_word(SPACE + words[r]) for r in rows]
            else:
                out[rows] = self.forward(codes, self.arcs(codes))[-1]
        return out


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Rows of words of each length with their codes; the long ones last, without."""
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths[lengths < SHORT]):
        rows = np.flatnonzero(lengths == n)
        yield rows, codes_of([SPACE + words[r] for r in rows])
    if (lengths >= SHORT).any():
        yield np.flatnonzero(lengths >= SHORT), None


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined to about ``AT_ONCE`` rows, so each length has many words."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, c in training texts, n in all texts), combined within the task in bounded memory."""
    known: list[Counter] = [Counter(), Counter()]

    def flushed() -> pa.RecordBatch:
        held, taught = known
        words = list(held.keys() | taught.keys())
        c, n = [taught[w] for w in words], [taught[w] + held[w] for w in words]
        held.clear()
        taught.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array(n, pa.int64())], names=["w", "c", "n"])

    for batch in batches:
        for text, taught in zip(batch.column("text").to_pylist(), batch.column("taught").to_pylist(), strict=True):
            known[taught].update(split(text))
            if len(known[0]) + len(known[1]) > FLUSH:
                yield flushed()
    yield flushed()


def expect(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces.value)
        total = np.zeros(len(lattice.pieces.names) + 1)
        for batch in gathered(batches):
            words = [w.decode("utf-8", "replace") for w in batch.column("w").to_pylist()]
            counts = batch.column("c").to_numpy()
            for rows, codes in by_length(words):
                if codes is not None:
                    lattice.expected(codes, counts[rows], total)
                    continue
                for r in rows:
                    lattice.expected_long(SPACE + words[r], counts[r], total)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["piece", "x"])

    return run


def learn_pieces(words: DataFrame, n_docs: int, names: list[str], rounds: int = ROUNDS) -> Pieces:
    """Piece probabilities from the training words; one row a piece reaches the driver each round."""
    sc = words.sparkSession.sparkContext
    pieces = first_scores(names)
    for _ in range(rounds):
        got = words.filter("c > 0").select("w", "c").mapInArrow(expect(sc.broadcast(pieces)), "piece int, x double").groupBy("piece").agg(F.sum("x").alias("x")).collect()
        x = np.zeros(len(names) + 1)
        for r in got:
            x[r["piece"]] = r["x"]
        total = x.sum() + n_docs + ALPHA * (len(names) + 257)
        if not got or not n_docs:
            break
        pieces = Pieces(names, np.log((x[:-1] + ALPHA) / total), math.log((x[-1] / 256 + ALPHA) / total), math.log((n_docs + ALPHA) / total))
    return pieces


@dataclass
class Totals:
    """Training tokens, distinct ones (both with the end) and documents."""

    tokens: int
    distinct: int
    docs: int

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.tokens + self.distinct + 1))

    def mixed(self, c: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """Log10 of the whole-word arc plus the lattice's share."""
        if not self.docs or self.distinct < 2:
            return lattice
        whole = np.maximum(c - DISCOUNT, 0) / self.tokens
        rest = math.log10(DISCOUNT * (self.distinct - 1) / self.tokens)
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log10(whole) * LN10, (lattice + rest) * LN10) / LN10


def score_words(pieces, totals: Totals):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces.value)
        for batch in gathered(batches):
            c = batch.column("c").to_numpy()
            logs = lattice.logs_of([w.decode("utf-8", "replace") for w in batch.column("w").to_pylist()]) / LN10
            yield pa.RecordBatch.from_arrays([batch.column("w"), batch.column("c"), batch.column("n"), pa.array(totals.base(c)), pa.array(totals.mixed(c, logs)), pa.array(logs)], names=["w", "c", "n", "base", "mixed", "lattice"])

    return run


PART = pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("mixed", pa.float64()), ("lattice", pa.float64())])


def take_heavy(heavy, end: tuple[int, float, float, float]):
    """Each text's sums over its heavy words and end in one row, and a row for each other word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = heavy.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                owner, words, tf, parts = [], [], [], []
                keys = piece.column("t").to_pylist()
                for i, text in enumerate(piece.column("text").to_pylist()):
                    tokens = split(text)
                    n_known, base, mixed, lattice = end
                    for w, k in Counter(tokens).items():
                        got = known.get(w)
                        if got is None:
                            owner.append(i)
                            words.append(w)
                            tf.append(k)
                            parts.append(None)
                        else:
                            n_known, base, mixed, lattice = n_known + k * got[0], base + k * got[1], mixed + k * got[2], lattice + k * got[3]
                    owner.append(i)
                    words.append(b"\n%d" % keys[i])  # no word holds a newline: meets nothing, and is spread
                    tf.append(0)
                    parts.append({"n_tokens": len(tokens) + 1, "n_known": n_known, "base": base, "mixed": mixed, "lattice": lattice})
                take = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").take(take), piece.column("t").take(take), pa.array(words, pa.binary()), pa.array(tf, pa.int64()), pa.array(parts, PART)], names=["doc_id", "t", "w", "tf", "part"])

    return run


def score(docs: DataFrame, folds: int = 7, held_fold: int = 2, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mixed_score of each row."""
    ship(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    held = in_fold("doc_id", folds, held_fold)
    texts = docs.select("doc_id", "text", (~held).alias("taught"))
    n_docs = texts.filter("taught").count()
    words = checkpointed(texts.select("text", "taught").mapInArrow(count_words, "w binary, c bigint, n bigint").groupBy("w").agg(F.sum("c").alias("c"), F.sum("n").alias("n")))
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    totals = Totals(sums["c"] + n_docs, sums["v"] + (n_docs > 0), n_docs)

    pieces = learn_pieces(words, n_docs, read_pieces(vocabulary))
    scored = checkpointed(words.mapInArrow(score_words(sc.broadcast(pieces), totals), "w binary, c bigint, n bigint, base double, mixed double, lattice double"))
    often = scored.filter(F.col("n") * HEAVY >= max(1, sums["n"])).collect()  # HEAVY rows at most
    heavy = sc.broadcast({bytes(r["w"]): (int(r["c"] > 0), r["base"], r["mixed"], r["lattice"]) for r in often})
    end_mixed = math.log10(n_docs / totals.tokens) if n_docs else pieces.end / LN10
    end = (int(n_docs > 0), float(totals.base(np.array(n_docs))), end_mixed, pieces.end / LN10)

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = texts.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), "text")
    rows = keyed.mapInArrow(take_heavy(heavy, end), f"doc_id {kind}, t bigint, w binary, tf bigint, part struct<n_tokens:bigint,n_known:bigint,base:double,mixed:double,lattice:double>")
    light = scored.filter(F.col("n") * HEAVY < max(1, sums["n"])).select(F.col("w").alias("s_w"), (F.col("c") > 0).cast("long").alias("known"), "base", "mixed", "lattice")
    met = rows.join(light, F.col("w") == F.col("s_w"), "left")
    add = lambda name, other=None: F.sum(F.coalesce(F.col(f"part.{name}"), F.col("tf") * F.col(other or name)))
    each = met.groupBy("doc_id", "t").agg(F.count("part").alias("m"), F.sum("part.n_tokens").alias("n_tokens"), add("n_known", "known").alias("n_known"), add("base").alias("base"), add("mixed").alias("mixed"), add("lattice").alias("lattice"))
    out = each.select("*", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("copy"))
    return out.select(
        "doc_id", in_fold("doc_id", folds, held_fold).alias("held_out"),
        (F.col("n_tokens") / F.col("m")).cast("long").alias("n_tokens"), (F.col("n_known") / F.col("m")).cast("long").alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"), (F.col("base") / F.col("m")).alias("base_score"),
        (F.col("lattice") / F.col("m")).alias("score"), (F.col("mixed") / F.col("m")).alias("mixed_score"),
    )
