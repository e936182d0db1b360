import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chatlake.llm import components, decontaminate, jaccard_join


def sets_of(rows):
    out = {}
    for i, (d, t) in enumerate(rows):
        w = re.sub(r"[ \t\n\x0b\x0c\r]+", " ", (t or "").lower()).strip(" ").split(" ")
        n = min(5, len(w))
        out[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w != [""] else frozenset()
    return out


def brute_links(rows):
    sets = sets_of(rows)
    links, root = Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    root[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i in sets:
        groups[find(i)].append(rows[i][0])
    smallest = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return sorted(((rows[i][0], links[i], smallest[find(i)]) for i in sets), key=str)


def near_copies(rng, n_groups=12, n=9, words=60):
    vocab = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(400)]
    rows = []
    for _ in range(n_groups):
        base = rng.choices(vocab, k=words)
        for _ in range(rng.randrange(1, n)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(words)] = rng.choice(vocab)
            rows.append(" ".join(copy))
    return rows


def test_join_equals_brute_force(make):
    rng = random.Random(4)
    rows = list(enumerate(near_copies(rng)))
    rows += [(500, rows[0][1].upper()), (500, rows[0][1]), (None, rows[1][1]), (601, "a b c"), (602, "A  b c"), (603, "a b c d"), (604, ""), (605, None), (606, " \n")]
    got = jaccard_join.join(make(rows)).collect()
    assert sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in got), key=str) == brute_links(rows)


@pytest.mark.parametrize("block", [7, 2048])
def test_blocks_of_a_hot_group_lose_nothing(make, monkeypatch, block):
    rng = random.Random(6)
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", block)
    rows = list(enumerate(near_copies(rng, 1, 60, 120) * 3))
    rows = [(i, t) for i, t in rows]
    got = jaccard_join.join(make(rows)).collect()
    assert sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in got), key=str) == brute_links(rows)


def test_keep_one_keeps_one_of_each_group(make, odd, empty, clash):
    rng = random.Random(9)
    rows = list(enumerate(near_copies(rng))) + [(900, ""), (901, ""), (None, "only nulls have this text here now"), (None, "only nulls have this text here now")]
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_one(make(rows)).collect()]
    expected = Counter(c for _, _, c in brute_links(rows))
    assert len(kept) == len({c for c in expected if c is not None}) + 1
    assert {d for d, _ in kept} == set(expected) and (900, "") in kept and (901, "") in kept
    out = jaccard_join.keep_one(clash(odd))
    assert out.columns == clash(odd).columns and out.count() == 11  # of the repeated row, one stays
    assert jaccard_join.keep_one(empty).collect() == [] and jaccard_join.join(empty).collect() == []


def test_bands_reach_the_recall():
    bands, rows = jaccard_join.bands_and_rows()
    assert bands * rows <= jaccard_join.MAX_HASHES and 1 - (1 - 0.8**rows) ** bands >= jaccard_join.RECALL
    assert jaccard_join.bands_and_rows(0.5, 0.99)[1] < rows


def test_overlaps_count_in_chunks(monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 5)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, 25).astype(np.uint64)) for _ in range(9)]
    assert (jaccard_join.overlaps(sets, sets) == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]).all()


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(30)]
    got = components.components(spark.createDataFrame(chain + star, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in got} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 131)}}


def reference_tiling(item, text, size):
    """Greedy string tiling by full search, for comparison."""
    a, b, tiles = [False] * len(item), [False] * len(text), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                k = 0
                while p + k < len(item) and t + k < len(text) and item[p + k] == text[t + k] and not a[p + k] and not b[t + k]:
                    k += 1
                if k > best[0]:
                    best = (k, p, t)
        k, p, t = best
        if k < size:
            return sum(a)
        a[p : p + k] = [True] * k
        b[t : t + k] = [True] * k
        tiles.append(best)


def test_tiling_equals_full_search():
    rng = random.Random(2)
    for _ in range(150):
        words = "abcdef"[: rng.randrange(2, 7)]
        item = rng.choices(words, k=rng.randrange(4, 16))
        text = rng.choices(words, k=rng.randrange(4, 30))
        bench = decontaminate.Benchmark([(1, " ".join(item))])
        hits = bench.hits(" ".join(text), 1e-9)
        assert round((hits[0][1] if hits else 0) * len(item)) == reference_tiling(item, text, decontaminate.MIN_MATCH)


@pytest.mark.parametrize("limit", [0, decontaminate.BROADCAST_CHARS])
def test_leaks_in_both_plans(spark, make, odd, empty, clash, limit):
    item = "The quick brown fox jumps over the lazy dog while seven wise owls watch from afar tonight"
    w = item.split()
    swapped = " ".join(w[9:] + ["and", "then"] + w[:9])
    benchmark = spark.createDataFrame([(1, item), (2, "one two"), (3, None), (None, "a null item has these words in it"), (4, item)], "item_id bigint, text string")
    rows = [(1, f"Intro. {item.upper()}! Outro."), (2, swapped), (3, " ".join(w[:6])), (4, "one two"), (None, "it said: a null item has these words in it"), (5, "x " * 30_000 + item), (5, "x " * 30_000 + item), (6, None)]
    got = decontaminate.find_leaks(make(rows), benchmark, limit=limit).collect()
    assert sorted([(r["doc_id"], r["item_id"]) for r in got], key=str) == sorted([(1, 1), (1, 4), (2, 1), (2, 4), (None, None), (5, 1), (5, 4), (5, 1), (5, 4)], key=str)
    assert {r["n_tiles"] for r in got if r["doc_id"] == 2} == {2}
    kept = decontaminate.drop_leaks(clash(make(rows)), benchmark, limit=limit)
    assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [3, 4, 6] and kept.columns == clash(make(rows)).columns
    assert decontaminate.find_leaks(odd, benchmark, limit=limit).collect() == [] and decontaminate.drop_leaks(odd, benchmark, limit=limit).count() == 12
    assert decontaminate.find_leaks(empty, benchmark, limit=limit).collect() == [] and decontaminate.drop_leaks(make(rows), benchmark.limit(0), limit=limit).count() == 8
