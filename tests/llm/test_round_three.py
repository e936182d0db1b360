"""Coordinate join, phrase mining and conversation repair: brute force, odd rows, hot groups."""

import hashlib
import random
import re
from collections import Counter
from decimal import Decimal, getcontext

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatlake.llm import conversation_repair as R
from chatlake.llm import coordinate_join as J
from chatlake.llm import phrase_mining as M
from chatlake.llm import queries as Q
from chatlake.llm.words import ASCII_SPACE, slices, words

WHITE = "[^\x20\x09-\x0d]+"


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(WHITE, ascii_lower(t or ""))
        sets.append({tuple(w[i : i + 2]) for i in range(max(1, len(w) - 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 80 * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (least.get(r) is None or d < least[r]):
            least[r] = d
    return sorted(((d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def components_of(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_words():
    texts = pa.array(["Ab ab\tAB", None, "", "é\x0bx", "x" * 100, "X" * 100])
    (buf, offsets), *rest = list(slices(texts))
    assert not rest
    starts, ends, h, first = words(buf, offsets, ASCII_SPACE)
    assert list(np.diff(first)) == [3, 0, 0, 2, 1, 1]
    assert len(set(h[:3].tolist())) == 1 and h[5] == h[6] and len(set(h.tolist())) == 4
    assert [bytes(buf[a:b]) for a, b in zip(starts[3:5], ends[3:5], strict=True)] == ["é".encode(), b"x"]


def test_matches_bound():
    t = J.least_matches()
    rng = np.random.default_rng(1)
    assert (rng.binomial(J.COORDS, 0.8, 1_000_000) < t).sum() <= 3 and t > J.COORDS // 2


def test_components_brute(spark, make):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(40):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 11, 40, 120]))
        for _ in range(rng.randint(1, 6)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 14))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n", "  "]).join(text).upper() if g % 3 else " ".join(text)))
    assert components_of(J.near_dedup(make(rows))) == brute_components(rows)


def test_components_of_a_hot_group(spark, make):
    """More copies than a chunk holds, linked through one text alone, and a smaller such group beside it."""
    rng = random.Random(9)
    rows = []
    for size in (1400, 60):
        base = [f"{size}x{i}" for i in range(60)]
        rows.append(" ".join(base))
        for c in range(size):
            text = list(base)
            for at in rng.sample(range(0, 60, 2), 3):
                text[at] = f"own{size}x{c}x{at}"
            rows.append(" ".join(text))
    order = list(range(len(rows)))
    rng.shuffle(order)
    got = J.near_dedup(make([(i, rows[k]) for i, k in enumerate(order)])).select("component_id").collect()
    assert sorted(Counter(r[0] for r in got).values()) == [61, 1401]


def test_components_odd(spark, odd, empty, clash):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = J.near_dedup(clash(odd))
    assert components_of(got) == brute_components(rows)
    assert got.filter("doc_id IS NOT NULL AND kept").count() == 9 + 1  # both rows of document 5
    assert J.near_dedup(empty).count() == 0
    kept = J.keep_one(clash(odd))
    assert kept.columns == clash(odd).columns and kept.count() == len(rows)


def test_rows_of_one_id_are_told_apart(spark, make):
    near = " ".join(f"a{i}" for i in range(40))
    kept = J.keep_one(make([(1, near), (7, near + " end"), (7, "something else entirely")])).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == [(1, near), (7, "something else entirely")]


def brute_phrases(rows, least, top):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", ascii_lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            counts.update((lang, tuple(w[i : i + n])) for n in range(1, 6) for i in range(len(w) - n + 1))
    good = {x for x, a in counts.items() if len(x[1]) > 1 and a >= least}
    out = []
    for lang, p in good:
        a = counts[lang, p]
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(x == lang and len(q) > len(p) and inside(q) and counts[x, q] >= a for x, q in good):
            continue
        score, _, l, r = min((1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), l, r, total[lang]))
    done, at = [], Counter()
    for lang, score, a, phrase, l, r, n in sorted(out):
        at[lang] += 1
        if at[lang] <= top:
            done.append((lang, at[lang], phrase.decode(), -a, l, r, n, -score))
    return done


def phrase_docs(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def test_phrases_brute(spark):
    rng = random.Random(3)
    letters = ["a", "B", "é", "ß", "d's", "ff", "g"]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(letters) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ",", "!\r\n"]) for _ in range(rng.randint(0, 300)))) for _ in range(60)]
    rows += [("en", "the very same passage of some length " * 9)] * 5 + [(None, None), ("en", ""), ("fr", "a a a a a a a a a a")]
    for least, top in ((4, 2000), (9, 7)):
        got = [tuple(r) for r in M.collocations(phrase_docs(spark, rows), least, top).orderBy("lang", "rank").collect()]
        assert got and got == brute_phrases(rows, least, top)


def test_phrases_odd(spark, odd, empty, clash):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    got = [tuple(r) for r in M.collocations(clash(odd), 2, 50).orderBy("lang", "rank").collect()]
    assert got and got == brute_phrases(rows, 2, 50)
    assert M.collocations(empty).count() == 0 and M.collocations(odd.filter("doc_id = 4"), 2).count() == 0


def test_parse_counts_copies_once(spark):
    text = " ".join(f"word{i % 977}" for i in range(3000))
    once, many = (M.dictionary(phrase_docs(spark, [("en", text)] * n)).agg(F.count(F.lit(1)), F.sum(F.col("core") * F.col("parses"))).first() for n in (1, 50))
    assert once[0] == many[0] and (once[1], many[1]) == (3000, 150_000)


def test_scores_beyond_64_bits(spark):
    """The score's arithmetic on counts of a large corpus."""
    getcontext().prec = 60
    a, n, l, r = 987_654_321_012, 9_876_543_210_987_654, 1_234_567_890_123, 2_345_678_901_234
    exact = "(CAST(1000 AS DECIMAL(4, 0)) * CAST({} AS DECIMAL(13, 0)) * CAST({} AS DECIMAL(20, 0))) DIV (CAST({} AS DECIMAL(19, 0)) * CAST({} AS DECIMAL(18, 0)))"
    got = spark.range(1).select(F.expr(exact.format(a, n, l, r))).first()[0]
    assert got == int(Decimal(1000) * a * n // (Decimal(l) * r)) and 1000 * a * n > 2**64


def brute_repair(rows):
    """Cheapest edits by dynamic programming over (row, role)."""
    best = {0: (0, "")}
    step = {0: 2, 1: 2, 2: 3, 3: 2}
    keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    def inserted(ways):
        ways = dict(ways)
        for _ in range(3):
            for s, (c, t) in list(ways.items()):
                ways[step[s]] = min(ways.get(step[s], (1 << 60, "")), (c + 5, t + "I"))
        return ways

    for letter, fault in rows:
        new = {}
        for s, (c, t) in inserted(best).items():
            more = 5 if fault == 2 else 0
            options = [(s, c + 2, t + "D")]
            if fault != 1:
                options += [(step[s], c + 1 + more, t + "R")] + ([(keep[letter, s], c + more, t + "K")] if (letter, s) in keep else [])
            for e, cost, text in options:
                new[e] = min(new.get(e, (1 << 60, "")), (cost, text))
        best = new
    ways = inserted(best)
    return min(ways[e] for e in (0, 3) if e in ways)


def test_audits_brute():
    rng = random.Random(3)
    for _ in range(1500):
        rows = [(rng.choice("sua?uaua"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randint(0, 14))]
        assert R.audit(rows) == R.audit(rows, 3, 3) == brute_repair(rows)
    long = [("ua"[i % 2], rng.choice([0] * 16 + [1, 1, 2])) for i in range(1500) if rng.random() > 0.05]
    assert R.audit(long) == brute_repair(long)


TALK = "conv_id bigint, turn bigint, role string, text string"


def brute_talk(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, lines) of one conversation's rows."""
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", hashlib.md5(f"{len(r[2] if r[2] is not None else ' ')}:{r[2] if r[2] is not None else ' '}:{r[3] if r[3] is not None else ' '}".encode()).hexdigest())
    rows = sorted(((c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows), key=key)
    seen, codes, n = set(), [], Counter()
    for i, (_, _, role, text) in enumerate(rows):
        body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        n[fault] += 1
        n["illegal"] += i > 0 and rows[i - 1][2][:1] + role[:1] not in ("su", "ua", "au")
        codes.append((role[:1] if role[:1] in ("s", "u", "a") else "?", {"": 0, "truncated": 2}.get(fault, 1)))
    cost, audit = brute_repair(codes)
    lines, at, state = [], 0, 0
    for e in audit:
        role, text = (rows[at][2], rows[at][3]) if e != "I" else ("", "")
        at += e != "I"
        if e == "D":
            continue
        if e != "K":
            role = "assistant" if state == 2 else "user"
        state = {"s": 1, "u": 2, "a": 3}[role[0]]
        lines.append(f"{role}:{text}")
    turns = {t for _, t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost, audit, lines


def test_repair_odd(spark):
    talks = [
        [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 5, "user", "cut"), (1, 6, "assistant", " \n")], [(2, None, "system", "Rules."), (2, None, None, None), (2, 3, "user", "Same."), (2, 3, "user", "Same."), (2, 4, "user", "Same.")],
        [(None, 0, "assistant", "Ends?\n"), (None, None, "tool", "Out!"), (None, 2, "", "No role.")], [(3, 1, "user", None)], [(4, 7, "user", "x" * 100_000 + "."), (4, 7, "assistant", "Ünï  ")], [(5, 1, "user", "Again.")] * 40,
        [(6, i, "ua"[i % 2] == "u" and "user" or "assistant", f"Turn {i}.") for i in range(700) if i % 19],
    ]
    rows = spark.createDataFrame([r for t in talks for r in t], TALK).withColumns({c: F.lit("old") for c in ("ck", "h", "audit", "place", "at", "copies", "seen", "blank")})
    audits = R.repair(rows)
    got = {r["conv_id"]: r for r in audits.collect()}
    lines = {}
    for r in R.repaired(rows, audits).orderBy("ck", "place").collect():
        lines.setdefault(r["ck"], []).append(f"{r['role']}:{r['text']}")
    digests = {r["ck"]: r["sha256"] for r in R.digests(R.repaired(rows, audits)).collect()}
    for t in talks:
        want, r = brute_talk(t), got.pop(t[0][0])
        assert tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")) == want[:-1]
        assert lines.get(r["ck"], []) == want[-1]
        assert digests.get(r["ck"]) == (hashlib.sha256("\n".join(want[-1]).encode()).hexdigest() if want[-1] else None)
    assert not got and R.repair(spark.createDataFrame([], TALK)).count() == 0


@pytest.mark.parametrize("conv", [0, None])
def test_damage(spark, conv):
    import zlib

    rows = [(conv, t if t < 60 else None, None if t == 7 else "assistant", None if t == 9 else f"One. Two! Three? {t}") for t in range(62)]
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r if r is not None else " ", x if x is not None else " "
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want += [] if kind == 0 else [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    got = Q.damaged(spark.createDataFrame(rows, TALK)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) != 62
