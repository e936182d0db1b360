import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatlake.llm import mixing, vector_search


def brute_top_k(rows, k, asked):
    """Over (id, vector) rows, by the definition: an id's best score over its rows and the query's."""
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    best = {}
    for q, x in usable:
        if asked(q):
            for c, y in usable:
                if c != q and len(x) == len(y):
                    best[q, c] = max(best.get((q, c), -math.inf), float(x @ y))
    ranked = {}
    for (q, c), s in sorted(best.items(), key=lambda e: (e[0][0], -e[1], e[0][1])):
        ranked.setdefault(q, []).append((c, s))
    return sorted((q, r + 1, c, s) for q, found in ranked.items() for r, (c, s) in enumerate(found[:k]))


def odd_vectors():
    """Ties, a hot vector, an id with many vectors, repeated rows, other lengths, nothing to compare."""
    rng = np.random.default_rng(3)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.integers(-9, 9, (300, 6)).astype(float))]
    rows += [(1000 + i, [7.0, 1.0, -3.0, 2.0, 5.0, 6.0]) for i in range(150)] + [(440, x.tolist()) for x in rng.integers(-12, 12, (120, 6)).astype(float)]
    rows += [rows[5]] * 50 + [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, rows[0][1])]
    return rows + [(404, [1.0, 2.0]), (420, [3.0, 1.0]), (460, [1.0, 2.0, 3.0]), (480, []), (481, []), (500, [1e200] * 6), (501, [-1e200, 1e200, 0.0, 0.0, 0.0, 0.0])]


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 7)
    monkeypatch.setattr(vector_search, "READ_SHARE", 5)
    rows = odd_vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({c: F.lit("old") for c in ("score", "id", "v", "h1", "h2", "q1", "qb", "share", "kind", "rank", "upper")})
    with np.errstate(over="ignore", invalid="ignore"):
        expected = brute_top_k([r for r in rows if r[0] not in (500, 501)], 5, lambda q: q % 20 == 0)
    small = df.filter("vec_id < 500 or vec_id >= 1000")
    got = vector_search.exact_top_k(small, small.filter("vec_id % 20 = 0"), 5).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == expected
    assert {(420, 1, 404, 5.0), (480, 1, 481, 0.0)} <= set(expected) and not any(r[0] == 460 for r in expected)
    assert vector_search.exact_top_k(df, df.filter("vec_id = 500"), 2).count() == 2  # beyond the exact range, but no crash
    assert vector_search.exact_top_k(df.limit(0), df.limit(0), 5).collect() == [] and vector_search.exact_top_k(df, df.limit(0), 5).collect() == []


@pytest.mark.parametrize("partitions", [1, 3, 211])
def test_top_k_whatever_the_partitions(spark, monkeypatch, partitions):
    rows = odd_vectors()[:-2]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(13)
    plain = type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, n, *cols: plain(self, partitions, *([n, *cols] if isinstance(n, str) else cols)))
    got = vector_search.exact_top_k(df, df.filter("vec_id % 20 = 0"), 5).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_top_k(rows, 5, lambda q: q % 20 == 0)


def approximation(x):
    """The cells of a matrix, as the arguments of Scan.block."""
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(np.arange(len(x))), pa.array(np.arange(len(x)))], names=["id", "v", "h1", "h2"])
    for row in vector_search.quantise([batch]):
        r = row.to_pylist()[0]
        ints = [np.frombuffer(r[c], np.int64) for c in ("ids", "h1", "h2")]
        yield *ints, np.frombuffer(r["low"]), np.frombuffer(r["step"]), np.frombuffer(r["data"], np.uint8).reshape(r["n"], r["dim"])


def test_cells_bound_scores_and_cut_exact_reads():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 8))
    scan = vector_search.Scan(np.arange(3), np.arange(3), x[:3], 6)
    for block in approximation(x):
        scan.block(*block)
    left = scan.survivors().to_pydict()
    score = x[left["id"]] @ x[:3].T
    assert len(left["id"]) < 3 * 400
    for q, s, lower, upper in zip(left["q1"], score, left["lower"], left["upper"], strict=True):
        assert lower <= s[q] <= upper
    for q in range(3):
        assert set(np.argsort(-(x @ x[q]))[:6]) <= {i for i, of in zip(left["id"], left["q1"], strict=True) if of == q}


def highest_quotients(x, seats):
    won = [0] * len(x)
    for _ in range(seats):
        i = max(range(len(x)), key=lambda i: (x[i] / (2 * won[i] + 1), -i))
        won[i] += 1
    return won


def test_sainte_lague_equals_seat_by_seat(spark):
    rng = random.Random(1)
    rows = [(99, i, x, 2020) for i, x in enumerate([1010.0] + [1.01] * 1000)]  # many small cells: the large one gets ten seats more
    expected = {(99, i): n for i, n in enumerate(highest_quotients([r[2] for r in rows], 2020))}
    for g in range(40):
        x = [float(rng.choice([0, 1, 3, 10, 100, 7.5])) * rng.randrange(1, 20) for _ in range(rng.randrange(1, 12))]
        seats = rng.randrange(0, 60)
        rows += [(g, i, v, seats) for i, v in enumerate(x)]
        expected |= {(g, i): n for i, n in enumerate(highest_quotients(x, seats) if sum(x) else [0] * len(x))}
    df = spark.createDataFrame(rows, "g bigint, i bigint, x double, seats bigint")
    got = mixing.sainte_lague(df, ["g"], F.col("i"), "x", "seats").collect()
    assert {(r["g"], r["i"]): r["quota"] for r in got} == expected


def water(sizes, weights):
    """Targets by raising the level step by step."""
    left, capped = 1.5 * sum(sizes), set()
    while True:
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        rest = left - sum(2 * sizes[i] for i in capped)
        over = {i for i in range(len(sizes)) if i not in capped and rest * weights[i] / w > 2 * sizes[i]} if w else set()
        if not over:
            return [2.0 * sizes[i] if i in capped else rest * weights[i] / w for i in range(len(sizes))]
        capped |= over


def test_mix_meets_targets(make, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_DOCS", 50)
    rng = random.Random(7)
    rows = [(i, "w " * rng.randrange(1, 120), rng.choice(["b", "a", "a", "a", "Z", None, "é"])) for i in range(600)]
    got = mixing.mix(make(rows)).collect()
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len(t.split()) for _, t, s in rows if s == n) for n in names]
    want = dict(zip(names, water(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True))
    for n in names:
        own = [r for r in got if r["source"] == n]
        assert abs(own[0]["target"] - want[n]) < 1e-6 and abs(sum(r["taken"] for r in own) - want[n]) <= 0.02 * want[n] + 200
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got) and len(got) == 600
    again = mixing.mix(make(rows[::-1])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_odd_rows(odd, empty, clash, make):
    got = mixing.mix(odd).collect()
    assert len(got) == 12 and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    out = mixing.mixed_documents(clash(odd))
    assert set(out.columns) == set(clash(odd).columns) and all(0 < r["taken"] <= 2 * r["size"] for r in out.collect())
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
    assert {r["taken"] for r in mixing.mix(make(["", " "])).collect()} == {0}
