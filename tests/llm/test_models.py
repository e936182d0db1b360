import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatlake.llm import quality, secrets, subword_lm, toxicity

LABEL = "doc_id bigint, quality int, toxic int"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def corpus(rng, n=400):
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 60))]
        good, bad = rng.random() < 0.7, rng.random() < 0.3
        if bad:
            words[3] = rng.choice(["scoundrel", "nincompoop"])
            words[9] = rng.choice(["scoundrel", "nincompoop"])
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words[:5] * 6)
        rows.append((i, text))
        labels.append((i, int(good), int(bad and good)))
    return rows, labels


@pytest.fixture(scope="module")
def labelled():
    return corpus(random.Random(11))


def test_quality_held_out(spark, make, labelled):
    rows, labels = labelled
    table = spark.createDataFrame([*labels, (None, 1, 1), (1, None, None), (99999, 0, 0)], LABEL)
    docs = make(rows)
    model = quality.train(quality.features(docs), table, "quality", 5, 0)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", quality.score_texts(model).alias("s")).collect()}
    held = [(got[i], q) for i, q, _ in labels if fold(i, 5) == 0]
    assert len(held) > 40 and np.mean([(s >= 0.3) == q for s, q in held]) > 0.97


def test_quality_is_the_density_difference(spark):
    rng = np.random.default_rng(2)
    d = len(quality.FEATURES)
    x, y = rng.normal(size=(300, d)), rng.integers(0, 2, 300)
    x[y == 1] *= 0.5
    df = spark.createDataFrame([(r.tolist(), int(c)) for r, c in zip(x, y, strict=True)], "x array<double>, label int")
    got = quality.fit(df).score(x[:20])
    logs = []
    for c in (0, 1):
        z = x[y == c]
        part = max(quality.SHRINK, d / (d + len(z)))
        cov = np.cov(z.T, bias=True)
        cov = (1 - part) * cov + part * np.diag(np.diag(cov)) + quality.RIDGE * np.eye(d)
        diff = x[:20] - z.mean(axis=0)
        logs.append(np.log((len(z) + 1) / 302) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff))
    assert np.allclose(got, 1 / (1 + np.exp(logs[0] - logs[1])))


def test_quality_odd_rows(spark, odd, empty, clash, labelled):
    rows, labels = labelled
    table = spark.createDataFrame(labels, LABEL)
    none = quality.train(quality.features(empty), table, "quality")
    scores = [r["s"] for r in clash(odd).select(quality.score_texts(none).alias("s")).collect()]
    assert scores == [0.5] * 12
    model = quality.train(quality.features(odd), table, "quality")
    assert all(0 <= r["s"] <= 1 for r in odd.select(quality.score_texts(model).alias("s")).collect())
    assert empty.select(quality.score_texts(model).alias("s")).collect() == []
    assert all(np.isfinite(quality.statistics(t)).all() for t in ("", " ", "a", "\n\n", "😀", "x" * 100_000))


def test_toxicity_held_out(spark, make, labelled):
    rows, labels = labelled
    docs = make(rows)
    machine = toxicity.train(docs, spark.createDataFrame([*labels, (None, 1, 1)], LABEL), "toxic", 4, 2)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.score_texts(machine, docs).alias("s")).collect()}
    held = [(got[i], t) for i, q, t in labels if fold(i, 4) == 2 and q]
    assert len(held) > 40 and np.mean([(s >= 0.3) == t for s, t in held]) > 0.97


def test_factors_learn_what_weights_cannot():
    rng = np.random.default_rng(5)
    rows, y = [], []
    for _ in range(4000):  # one of the two is harmless, both together aren't; more of each elsewhere
        a, b = rng.random(2) < 0.5
        y.append(float(a == b))
        rows.append([1] * int(a) + [2] * int(b) + [3])
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = np.array([x for r in rows for x in r], np.int32)
    known = np.array([1, 2, 3], np.int32)
    original = toxicity.telling_terms
    toxicity.telling_terms = lambda *_: known
    try:
        machine = toxicity.learn(offsets, flat, np.array(y))
    finally:
        toxicity.telling_terms = original
    score = machine.score(offsets, np.searchsorted(known, flat))
    assert np.mean((score > 0.5) == np.array(y)) > 0.95


@pytest.mark.parametrize("kind", ["same", "both"])
def test_pairs_of_harmless_words_are_learned_with_the_real_selection(kind):
    def drawn(seed, n):
        rng = np.random.default_rng(seed)
        rows, y = [], []
        for _ in range(n):  # single words tell nothing: as many of each in toxic rows as in others
            if kind == "same":
                a, b = rng.random(2) < 0.5
                y.append(float(a == b))
            else:
                a, b = [(True, True), (False, False), (True, False), (False, True)][rng.choice(4, p=[0.05, 0.05, 0.45, 0.45])]
                y.append(float(a and b or not (a or b)))
            rows.append(sorted({*[1] * int(a), *[2] * int(b), *rng.integers(3, 2000, 30).tolist()}))
        return np.concatenate([[0], np.cumsum([len(r) for r in rows])]), np.array([x for r in rows for x in r], np.int32), np.array(y)

    offsets, flat, y = drawn(5, 4000)
    assert not {1, 2} & set(toxicity.telling_terms(offsets, flat, y).tolist())
    machine = toxicity.learn(offsets, flat, y)
    offsets, flat, y = drawn(6, 1000)
    assert np.mean((machine.score(*toxicity.among(machine.known, offsets, flat)) > 0.5) == y) > 0.95
    assert set(machine.known.tolist()) <= {1, 2} | set(toxicity.telling_terms(*drawn(5, 4000)).tolist())


def test_pair_sums_equal_all_pairs(monkeypatch):
    rng = np.random.default_rng(9)
    rows = [sorted(set(rng.integers(0, 30, rng.integers(0, 12)).tolist())) for _ in range(400)]
    y = np.array([float({3, 4} <= set(r) or rng.random() < 0.1) for r in rows])
    told = np.full(len(y), 0.12)
    monkeypatch.setattr(toxicity, "MIN_PAIR_CHI2", 6.0)
    monkeypatch.setattr(toxicity, "PAIRS_AT_ONCE", 16)
    want = set()
    for a in range(30):
        for b in range(a):
            held = np.array([a in r and b in r for r in rows])
            z = (y - told)[held].sum()
            if abs(z) >= toxicity.MIN_EXCESS and z * z / (told * (1 - told))[held].sum() >= 6.0:
                want |= {a, b}
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    got = toxicity.telling_pairs(offsets, np.array([x for r in rows for x in r], np.int32), y, told)
    assert {3, 4} <= want and set(got.tolist()) == want


def test_toxicity_score_is_the_pair_sum():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(0.3, np.arange(5, dtype=np.int32), rng.normal(size=5), rng.normal(size=(5, toxicity.FACTORS)))
    x = [0, 2, 4]
    pairs = sum(m.factors[i] @ m.factors[j] for a, i in enumerate(x) for j in x[a + 1 :])
    assert np.isclose(m.score(np.array([0, 3]), np.array(x))[0], 1 / (1 + np.exp(-(0.3 + m.weights[x].sum() + pairs))))


def test_long_documents_teach_within_the_squares(spark, make, monkeypatch):
    """The share that teaches falls with the squares of the documents' lengths."""
    text = " ".join("".join(x) for x in itertools.islice(itertools.product("abcdefgh", repeat=4), 2000))
    docs = make([(i, text) for i in range(200)])
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(200)], LABEL)
    taught = []
    monkeypatch.setattr(toxicity, "chosen", lambda share, seed: taught.append(share) or F.lit(True))
    toxicity.train(docs.limit(20), labels, "toxic", max_squares=10**6)
    assert len(taught) == 2 and taught[0] == 1.0 and taught[1] < 0.05
    taught.clear()
    toxicity.train(docs.limit(20), labels, "toxic")
    assert taught == [1.0]


def test_toxicity_odd_rows(spark, odd, empty, clash):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(20)], LABEL)
    machine = toxicity.train(odd, labels, "toxic")
    assert all(0 <= r["s"] <= 1 for r in clash(odd).select(toxicity.score_texts(machine, odd).alias("s")).collect())
    none = toxicity.train(empty, labels, "toxic")
    assert {r["s"] for r in odd.select(toxicity.score_texts(none, odd).alias("s")).collect()} == {0.5}
    assert toxicity.train(odd, labels.limit(0), "toxic").known.size == 0


def test_lm_base_and_model(make):
    rng = random.Random(3)
    words = ["the", "of", "unhappiness", "naïve", "東京", "😀", "x" * 60] + ["".join(rng.choices("abcde", k=5)) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(words, weights=[20, 10, *[1] * (len(words) - 2)], k=rng.randrange(0, 30))).upper()) for i in range(120)] + [(7, "the the"), (7, "the the"), (None, "of the"), (300, None)]
    got = subword_lm.score(make(rows)).collect()
    assert len(got) == len(rows)
    train = Counter()
    n = 0
    for i, t in rows:
        if i is None or fold(i, 7) != 2:
            train.update((t or "").encode().lower().split())
            n += 1
    total, distinct = sum(train.values()) + n, len(train) + 1
    expected = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        base = sum(math.log10((train[x] + 1) / (total + distinct + 1)) for x in w) + math.log10((n + 1) / (total + distinct + 1))
        expected.append((i, i is not None and fold(i, 7) == 2, len(w) + 1, 1 + sum(x in train for x in w), total, round(base, 6)))
    assert sorted((((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))) for r in got), key=str) == sorted(expected, key=str)
    assert all(-1e6 < r["score"] < 0 and -1e6 < r["mixed_score"] < 0 for r in got)


def test_lm_light_and_heavy_words_give_the_same(make, monkeypatch):
    rows = [(i, "a b c d e f a a b " * (i % 3)) for i in range(30)]
    show = lambda got: sorted((r["doc_id"], r["n_known"], round(r["base_score"], 8), round(r["score"], 8), round(r["mixed_score"], 8)) for r in got)
    heavy = show(subword_lm.score(make(rows)).collect())
    monkeypatch.setattr(subword_lm, "HEAVY", 2)
    assert show(subword_lm.score(make(rows)).collect()) == heavy


def all_paths(word, logs, byte):
    """The sum over all segmentations by recursion."""
    if not word:
        return 1.0
    out = sum(math.exp(logs[word[:n]]) * all_paths(word[n:], logs, byte) for n in range(1, len(word) + 1) if word[:n] in logs)
    if word[0] not in logs:
        out += math.exp(byte * len(word[0].encode())) * all_paths(word[1:], logs, byte)
    return out


def test_forward_sums_over_all_segmentations():
    pieces = subword_lm.first_scores(["▁", "▁a", "a", "b", "ab", "ba", "bab", "▁ab", "abba"])
    lattice = subword_lm.Lattice(pieces)
    logs = dict(zip(pieces.names, pieces.logs, strict=True))
    words = ["a", "ab", "abba", "babab", "cab", "ébé", "b" * 12]
    want = [math.log(all_paths("▁" + w, logs, pieces.byte)) for w in words]
    assert np.allclose(lattice.logs_of(words), want) and np.allclose([lattice.long_word("▁" + w) for w in words], want)
    into = np.zeros(len(pieces.names) + 1)
    for rows, codes in subword_lm.by_length(words):
        lattice.expected(codes, np.ones(len(rows)), into)
    numeric = np.zeros(len(pieces.names))
    for k in range(len(pieces.names)):  # expected counts are the derivatives of the log probability
        moved = subword_lm.Pieces(pieces.names, pieces.logs + 1e-5 * (np.arange(len(pieces.names)) == k), pieces.byte, pieces.end)
        numeric[k] = (subword_lm.Lattice(moved).logs_of(words) - lattice.logs_of(words)).sum() / 1e-5
    assert np.allclose(into[:-1], numeric, atol=1e-3)


def test_long_words_teach_like_short_ones(spark):
    names = ["▁", "▁a", "a", "b", "ab", "ba", "bab", "▁ab", "abba", "é"]
    lattice = subword_lm.Lattice(subword_lm.first_scores(names))
    words = ["abba", "cab東", "ébé😀", "babab" * 30]
    for word in words:
        one, other = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
        lattice.expected(subword_lm.codes_of(["▁" + word]), np.array([3]), one)
        lattice.expected_long("▁" + word, 3, other)
        assert np.allclose(one, other) and other.sum() > 0
    table = spark.createDataFrame([(("ab" * 40).encode(), 50, 50)], "w binary, c bigint, n bigint")
    pieces = dict(zip(names, subword_lm.learn_pieces(table, 1, names).logs, strict=True))
    assert pieces["ab"] > pieces["bab"] > pieces["abba"]


def test_lm_odd_rows(odd, empty, clash):
    got = subword_lm.score(clash(odd)).collect()
    assert len(got) == 12 and all(math.isfinite(r["score"]) and r["n_tokens"] >= 1 for r in got)
    assert subword_lm.score(empty).collect() == []


KEY = "Zx9kQ2mLw8RtY4uPa7Bd"


def test_secrets_base_and_links(spark, make):
    hexes = "0123456789abcdef" * 2
    rows = [
        (1, 'Token = "abcdefgh12" then secret=short and API_KEY: ABCDEFGHIJ'), (2, f"id AKIAABCDEFGHIJKL and {hexes} end"), (3, f"login: bob and far {KEY}"), (4, f"https://host/x {'.' * 400} {KEY}"),
        (5, "username = alice only"), (6, "see https://example.com/a only"), (7, f"😀 password=hunter2hunter2 at https://db.example.com/x"), (8, "secret=token: abcdefghij"),
    ]
    got = {r["doc_id"]: ([secrets.KINDS[p["kind"]] for p in r["base"]], [(secrets.KINDS[p["kind"]], p["start"], p["end"]) for p in r["parts"]]) for r in secrets.find_secrets(make(rows)).collect()}
    assert got[1][0] == ["assign", "assign"] and got[1][1][0] == ("assign", 0, 19)
    assert got[2][0] == ["access", "hex"]
    assert got[3][0] == [] and [k for k, _, _ in got[3][1]] == ["login", "key"]
    assert got[4][1] == got[5][1] == got[6][1] == []
    assert [k for k, _, _ in got[7][1]] == ["assign", "endpoint"] and got[7][1][0][1] == 2
    assert got[8][0] == []


def test_secrets_links_equal_all_pairs(spark):
    rng = random.Random(4)
    role = {0: "s", 1: "n", 2: "s", 3: "n", 4: "s", 5: "p"}
    need = {3: "s", 4: "np", 5: "s"}
    rows = []
    for d in range(30):
        at = 0
        for _ in range(rng.randrange(1, 12)):
            at += rng.randrange(1, 300)
            end = at + rng.randrange(8, 40)
            rows.append((d, at, rng.randrange(6), end))
            at = end
    df = spark.createDataFrame(rows, "d bigint, start int, kind int, end int")
    got = sorted(map(tuple, secrets.linked_parts(df, ["d"], 200).collect()))
    near = lambda a, b: max(a[1], b[1]) - min(a[3], b[3]) <= 200
    expected = [a for a in rows if a[2] in need and any(b is not a and b[0] == a[0] and role[b[2]] in need[a[2]] and near(a, b) for b in rows)]
    assert got == sorted(expected)


def test_secrets_odd_rows(odd, empty, clash):
    got = secrets.find_secrets(clash(odd)).collect()
    assert len(got) == 12 and all(r["base"] == [] and r["parts"] == [] for r in got)
    assert secrets.find_secrets(empty).collect() == []
