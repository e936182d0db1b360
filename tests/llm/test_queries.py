"""The registered queries on the driver's smallest tables: against SQL, brute force or held-out labels."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from chatlake.llm import decontaminate, quality, subword_lm, toxicity
from chatlake.llm import queries as Q
from tests.llm.test_lines_and_passages import brute_passages, passage_rows
from tests.llm.test_pairs import brute_links, reference_tiling

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return duck.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def run(spark, name):
    return Q.queries()[name](spark, DATA).collect()


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = Q.queries()[name](spark, DATA)
    names = sorted(df.columns)
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    got = sorted(tuple(map(show, r)) for r in df.select(*names).collect())
    assert got and got == sorted(tuple(map(show, r)) for r in duck.sql(f"SELECT {', '.join(names)} FROM ({Q.oracle_sql()[name]})").fetchall())


def test_op1(spark, docs):
    got = passage_rows(Q.queries()["op1_passage_dedup"](spark, DATA))
    assert got and got == brute_passages(docs, Q.PASSAGE_WORDS)


def test_op3(spark, docs, duck):
    words = lambda t: re.findall(r"\w+", t.lower())
    grams = lambda w: {tuple(w[i : i + 4]) for i in range(len(w) - 3)}
    items = {i: words(t) for i, t in duck.sql("SELECT item_id, text FROM benchmark").fetchall()}
    want = set()
    for d, t in docs:
        own = words(t)
        seeds = grams(own)
        for i, w in items.items():
            if len(seeds & grams(w)) * 4 >= 0.5 * len(w):  # fewer cannot cover half of it
                share = reference_tiling(w, own, 4) / len(w)
                if share >= decontaminate.COVERAGE:
                    want.add((d, i, share))
    got = {(r["doc_id"], r["item_id"], r["coverage"]) for r in run(spark, "op3_decontaminate")}
    assert got and got == want


def forward_backward(word, p, byte, longest):
    """(log probability, [(piece or None, expected count)]) of one word by plain recursion, in scaled probabilities."""
    n = len(word)
    arcs = [(i, j, word[i:j], p[word[i:j]]) for i in range(n) for j in range(i + 1, min(n, i + longest) + 1) if word[i:j] in p]
    arcs += [(i, i + 1, None, byte ** len(c.encode("utf-8", "replace"))) for i, c in enumerate(word) if c not in p]
    arcs.sort(key=lambda a: a[:2])
    scale = 2e-3  # a factor for each character keeps long words' probabilities in range
    a, b = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    for i, j, _, w in arcs:
        a[j] += a[i] * w * scale ** (i - j)
    for i, j, _, w in reversed(arcs):
        b[i] += b[j] * w * scale ** (i - j)
    return math.log(a[n]) + n * math.log(scale), [(x, a[i] * w * scale ** (i - j) * b[j] / a[n]) for i, j, x, w in arcs]


def lattice_scores(docs, held):
    """Log10 probability of each whole text: two rounds of plain expectation maximisation, then the sum over its words."""
    names = subword_lm.read_pieces()
    longest, n = max(map(len, names)), 0
    total = sum(1 / (k + 10) for k in range(len(names)))
    p, byte, end = {x: 0.99 / (k + 10) / total for k, x in enumerate(names)}, 1e-6, 0.01
    train = Counter()
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 7 != held:
            train.update(t.encode().lower().split())
            n += 1
    for _ in range(2):
        seen = Counter()
        for w, c in train.items():
            for piece, x in forward_backward("▁" + w.decode(), p, byte, longest)[1]:
                seen[piece] += x * c
        mass = sum(seen.values()) + n + 0.1 * (len(names) + 257)
        p, byte, end = {x: (seen[x] + 0.1) / mass for x in names}, (seen[None] / 256 + 0.1) / mass, (n + 0.1) / mass
    words = {w: forward_backward("▁" + w.decode(), p, byte, longest)[0] for w in {w for _, t in docs for w in t.encode().lower().split()}}
    return {i: (math.log(end) + sum(words[w] for w in t.encode().lower().split())) / math.log(10) for i, t in docs}


def test_op6(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op6_subword_lm")}
    train, n = Counter(), 0
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(t.encode().lower().split())
            n += 1
    total, distinct = sum(train.values()) + n, len(train) + 1
    for i, t in docs:
        w = t.encode().lower().split()
        base = sum(math.log10((train[x] + 1) / (total + distinct + 1)) for x in w) + math.log10((n + 1) / (total + distinct + 1))
        assert abs(got[i]["base_score"] - base) < 1e-6 * abs(base) and got[i]["n_tokens"] == len(w) + 1 and got[i]["n_known"] == 1 + sum(x in train for x in w)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2) and got[i]["mixed_score"] < 0
    score = lattice_scores(docs, 2)
    assert all(abs(got[i]["score"] - score[i]) < 1e-6 * abs(score[i]) for i, _ in docs)


@pytest.mark.parametrize(("name", "label", "folds", "fold"), [("op7_quality", "quality", 5, 0), ("op9_toxicity", "toxic", 4, 2)])
def test_classifiers(spark, duck, docs, name, label, folds, fold):
    got = {r["doc_id"]: r for r in run(spark, name)}
    assert set(got) == {i for i, _ in docs}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % folds == fold) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    truth = duck.sql(f"SELECT doc_id, {label} FROM labels").fetchall()
    assert sum(got[i]["predicted"] == y for i, y in truth) >= 0.9 * len(truth)


def plain_statistics(text):
    """The sixteen statistics, one by one over the characters and words."""
    data = text.encode("utf-8", "replace")
    n, words = max(1, len(data)), text.split()
    m, often = max(1, len(words)), Counter(words)
    share = lambda chars: sum(b in chars for b in data) / n
    lower, upper, digit = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
    space, stops, marks = b" \t\n\x0b\x0c\r", b".,;:", b"!?\"'()-"
    wide = sum(b > 127 for b in data) / n
    other = sum(b < 128 and b not in lower + upper + digit + space + stops + marks + b"|" for b in data) / n
    odd = sum(not w[-1].isalnum() and w[-1] not in ".,;:" for w in words)
    return [
        math.log(1 + len(words)), math.log(1 + n / m), share(upper) ** 0.5, share(digit) ** 0.5, share(space), share(stops) ** 0.5, share(marks) ** 0.5, other**0.5, share(b"|") ** 0.5, wide**0.5,
        math.log((1 + len(often)) / (1 + len(words))), (max(often.values(), default=0) / m) ** 0.5, math.log(1 + m / (1 + text.count("\n"))), (sum(a == b for a, b in zip(words, words[1:])) / m) ** 0.5, (odd / m) ** 0.5, share(lower),
    ]


def labels_of(duck, column, folds, held):
    best = {}
    for i, y in duck.sql(f"SELECT doc_id, {column} FROM labels WHERE {column} IS NOT NULL").fetchall():
        best[i] = max(best.get(i, 0), y)
    return {i: y for i, y in best.items() if zlib.crc32(str(i).encode()) % folds != held}


def test_op7_is_the_density_difference(spark, duck, docs):
    x, y = {i: np.array(plain_statistics(t)) for i, t in docs}, labels_of(duck, "quality", 5, 0)
    logs = []
    for c in (0, 1):
        z = np.array([x[i] for i in sorted(y) if y[i] == c and i in x])
        part = max(quality.SHRINK, z.shape[1] / (z.shape[1] + len(z)))
        cov = np.cov(z.T, bias=True)
        cov = (1 - part) * cov + part * np.diag(np.diag(cov)) + quality.RIDGE * np.eye(len(cov))
        away = {i: v - z.mean(axis=0) for i, v in x.items()}
        logs.append({i: math.log((len(z) + 1) / (len(y) + 2)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * v @ np.linalg.solve(cov, v) for i, v in away.items()})
    for r in run(spark, "op7_quality"):
        gap = logs[0][r["doc_id"]] - logs[1][r["doc_id"]]
        assert abs(r["score"] - 1 / (1 + math.exp(min(500, gap)))) < 1e-5


def test_op9_is_the_pair_sum_of_what_the_examples_teach(spark, duck, docs):
    def terms(text):
        forms = {f for w in re.findall(r"[^\W\d_]+", text.lower()) for f in ({w, w[:4] + "*", w[:5] + "*"} if len(w) > 4 else {w})}
        return sorted({zlib.crc32(f.encode()) % (1 << 31) for f in forms})

    y, held = labels_of(duck, "toxic", 4, 2), dict(docs)
    taught = sorted((i for i in y if i in held), key=lambda i: (zlib.crc32(str(i).encode()), str(i)))
    rows = [terms(held[i]) for i in taught]
    machine = toxicity.learn(np.cumsum([0, *map(len, rows)]), np.array([x for r in rows for x in r], np.int32), np.array([y[i] for i in taught], float))
    place = {int(h): k for k, h in enumerate(machine.known)}
    got = {r["doc_id"]: r["score"] for r in run(spark, "op9_toxicity")}
    assert set(got) == set(held)
    for i, text in docs:
        known = [place[t] for t in terms(text) if t in place]
        pairs = sum(float(machine.factors[a] @ machine.factors[b]) for n, a in enumerate(known) for b in known[n + 1 :])
        margin = machine.bias + sum(machine.weights[k] for k in known) + pairs
        assert abs(got[i] - 1 / (1 + math.exp(-max(-500, min(500, margin))))) < 1e-6


def test_op8(spark, docs):
    got = sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in run(spark, "op8_jaccard_join")), key=str)
    assert got == brute_links(docs)


def test_op10(spark, duck):
    larger = "/root/testdata/sf0.01"  # the smallest table holds no secret
    docs = duck.sql(f"SELECT doc_id, text FROM '{larger}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in Q.queries()["op10_secrets"](spark, larger).collect()}
    found = 0
    for i, t in docs:
        spans = [(m.start(), "assign", m.end()) for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(2)) >= 8]
        spans += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 16]
        spans += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 32]
        order = {"assign": 0, "access": 1, "hex": 2}
        shown = ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(spans, key=lambda x: (x[0], order[x[1]])))
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest() and set(filter(None, shown.split(","))) <= set(r["spans"].split(","))
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in spans) for x in order)
        found += len(spans)
    assert found
