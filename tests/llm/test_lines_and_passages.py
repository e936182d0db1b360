import hashlib
import random
import re

from chatlake.llm import line_dedup, passage_dedup

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_lines(rows):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = line.strip(WHITE).translate(LOWER)
            if len(k) >= 40:
                holders.setdefault(k, set()).add(i)
    lost = {k: max(x for x in v if x is not None) for k, v in holders.items() if len(v) >= 5}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if lost.get(x.strip(WHITE).translate(LOWER), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def test_line_dedup_equals_brute_force(spark, make):
    rng = random.Random(5)
    pool = ["Shared line number %d " % i + "padding " * 5 for i in range(6)] + ["short", "", "  \t", "Ä" * 40, "ß" * 39]
    vary = lambda s: rng.choice([s, s.upper(), "  " + s + "\t", s + "\x0b"])
    rows = [(i, "\n".join(vary(rng.choice(pool)) for _ in range(rng.randrange(1, 8)))) for i in range(60)] + [(7, pool[0]), (None, pool[0] + "\n" + pool[1])]
    got = line_dedup.dedup_lines(make(rows)).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_lines(rows), key=key)
    assert any(r["n_dropped"] for r in got)


def test_line_dedup_odd_rows(odd, empty, clash):
    out = line_dedup.dedup_lines(clash(odd))
    rows = out.collect()
    assert len(rows) == 12 and all(r["n_dropped"] == 0 for r in rows) and out.columns[-2:] == ["n_lines", "n_dropped"]
    assert {r["text"] for r in rows if r["doc_id"] in (1, 2)} == {""} and {r["score"] for r in rows} == {"old score"}
    assert line_dedup.dedup_lines(empty).collect() == []


def test_line_dedup_stays_native(make):
    plan = line_dedup.dedup_lines(make(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(3, 9))) for _ in range(n)).capitalize() + "."


def n_words(part):
    w = part.split()
    return len(w) if sum(map(len, w)) <= 12 * len(w) else sum(max(1, len(x) // 8) for x in w)


def said(part):
    return " ".join(part.lower().split())


def plain_units(text):
    """(start, end, words) by the rule, character by character."""
    out, block, at = [], [], 0

    def close():
        start, n = None, 0
        for a, b in block:
            start, n = a if start is None else start, n + n_words(text[a:b])
            if n >= 20 or n >= 5 and hashlib.blake2b(said(text[a:b]).encode(), digest_size=16).digest()[0] % 2:
                out.append((start, b, n))
                start, n = None, 0
        if n >= 5:
            out.append((start, block[-1][1], n))
        block.clear()

    for line in text.split("\n"):
        end = at + len(line)
        if len(line) < 80 and 0 < n_words(line) < 5:
            block.append((at, end))
        else:
            close()
            start, n, i = at, 0, at
            while len(line.split()) and i < end:
                j = i  # the next sentence: up to a mark, what is no word behind it, and white space
                while j < end:
                    m = re.compile(r"[.!?][^\w\s]*[ \t\r\f\v]+|[。！？]").match(text, j, end)
                    if m:
                        j = m.end()
                        break
                    j += 1
                own = n_words(text[i:j])
                n, i = n + own, j
                if own >= 5 or n >= 20:
                    out.append((start, j, n))
                    start, n = j, 0
        at = end + 1
    close()
    return out


def brute_passages(rows, run_words):
    """(doc_id, start, end, n_units, n_words, kept_doc_id, kept_start) of what is removed.

    For each unit and each earlier place of the same unit, the equal units around both are followed as far
    as they go; the unit is removed if they have enough words.
    """
    docs = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        docs[i] = [(a, b, n, said(text[a:b])) for a, b, n in plain_units(text or "")]
    places, out = {}, set()
    for i, cut in docs.items():
        gone = []
        for p, u in enumerate(cut):
            earlier = places.setdefault(u[3], [])
            for j, q in earlier:
                other, low, high = docs[j], 0, 0
                while min(p, q) + low > 0 and cut[p + low - 1][3] == other[q + low - 1][3]:
                    low -= 1
                while max(p + high + 1 - len(cut), q + high + 1 - len(other)) < 0 and cut[p + high + 1][3] == other[q + high + 1][3]:
                    high += 1
                if sum(x[2] for x in cut[p + low : p + high + 1]) >= run_words:
                    gone.append((p, *earlier[0]))
                    break
            earlier.append((i, p))
        runs = []
        for p, j, q in gone:
            if not (runs and runs[-1][-1][0] == p - 1 and runs[-1][-1][1:] == (j, q - 1)):
                runs.append([])
            runs[-1].append((p, j, q))
        for run in runs:
            (p, j, q), end = run[0], run[-1][0]
            out.add((i, cut[p][0], cut[end][1], len(run), sum(x[2] for x in cut[p : end + 1]), j, docs[j][q][0]))
    return out


def passage_rows(df):
    return {(r["doc_id"], r["start"], r["end"], r["n_units"], r["n_words"], r["kept_doc_id"], r["kept_start"]) for r in df.collect()}


def test_passages_equal_brute_force_and_spans_cut_exactly(spark, make):
    rng = random.Random(8)
    passage = " ".join(sentence(rng, rng.randrange(9, 14)) for _ in range(6))
    texts = [" ".join(sentence(rng, 12) for _ in range(rng.randrange(1, 6))) for _ in range(20)]
    rows = [(i, t if i % 3 else f"{t}\n{passage.upper() if i == 6 else passage}\n{t[::-1]}") for i, t in enumerate(texts)] + [(100, texts[1]), (100, texts[1]), (None, passage)]
    got = passage_dedup.find_repeats(make(rows)).collect()
    assert passage_rows(passage_dedup.find_repeats(make(rows))) == brute_passages(rows, 0)
    assert passage_rows(passage_dedup.find_repeats(make(rows), 20)) == brute_passages(rows, 20)
    assert {r["doc_id"] for r in got} >= {3, 6, 9, None} and 0 not in {r["doc_id"] for r in got}
    assert all(r["kept_doc_id"] == 0 for r in got if r["doc_id"] in (3, 6, 9))
    text = dict(rows)
    for r in passage_dedup.remove_repeats(make(rows)).collect():
        if r["doc_id"] in (3, 6, 9):
            (cut,) = r["removed"]
            whole = text[r["doc_id"]]
            assert whole[: cut["start"]] + whole[cut["end"] :] == r["text"] and passage.lower()[:40] not in r["text"].lower()


def test_passages_odd_rows(odd, empty, clash):
    got = passage_dedup.find_repeats(clash(odd)).collect()
    assert {r["doc_id"] for r in got} <= {6}  # only the text that repeats one word; its unit is one line
    out = passage_dedup.remove_repeats(clash(odd))
    assert out.count() == 12 and out.columns[-1] == "removed"
    assert passage_dedup.find_repeats(empty).collect() == [] and passage_dedup.remove_repeats(empty).collect() == []


def test_rows_of_one_id_lose_their_own_repeats_alone(make):
    fox = "The quick brown fox jumps over the lazy dog by the river."
    rows = [(1, fox), (7, fox + " A tail of its own stands here too."), (7, "An entirely unique text of many words that nothing else repeats anywhere."), (None, fox + " Null one has words of its own."), (None, "Null two is unique in every single one of its words here.")]
    got = {(r["doc_id"], r["text"]) for r in passage_dedup.remove_repeats(make(rows)).collect()}
    assert got == {(1, fox), (7, "A tail of its own stands here too."), (7, rows[2][1]), (None, "Null one has words of its own."), (None, rows[4][1])}


def test_remove_repeats_loses_no_text_that_stands_once(make):
    rng = random.Random(12)
    pool = [sentence(rng, rng.randrange(6, 12)) for _ in range(30)]
    rows = [(rng.choice([1, 2, None, 3]), " ".join(rng.choices(pool, k=rng.randrange(1, 6)))) for _ in range(40)]
    out = passage_dedup.remove_repeats(make(rows)).collect()
    left = " ".join(r["text"] for r in out)
    assert len(out) == len(rows) and all(s.strip() in left for s in pool if any(s in t for _, t in rows))
    assert sum(len(r["text"]) for r in out) < sum(len(t) for _, t in rows)


def test_units_end_with_long_sentences_wherever_they_stand():
    assert list(passage_dedup.units("Too short. A b c.\n\n")) == []
    text = "One two three four five six. Nine ten. Six words are in this one. Tail."
    spans = list(passage_dedup.units(text))
    assert [text[a:b] for a, b, _ in spans] == ["One two three four five six. ", "Nine ten. Six words are in this one. "] and [s[2] for s in spans] == [6, 8]
    moved = "Something else before. " + text
    assert text[spans[1][0] : spans[1][1]] in [moved[a:b] for a, b, _ in passage_dedup.units(moved)]


def test_passages_whose_sentences_stand_elsewhere_too(make):
    rng = random.Random(21)
    s = [sentence(rng, 9) for _ in range(6)]
    fill = lambda: sentence(rng, 12)
    rows = [(1, f"{fill()} {s[1]} {fill()}"), (2, f"{fill()} {s[3]} {fill()}"), (3, f"{fill()} {' '.join(s)} {fill()}"), (4, f"{fill()} {' '.join(s)} {fill()}")]
    got = passage_dedup.find_repeats(make(rows), 20).collect()
    assert {r["doc_id"] for r in got} == {4} and sum(r["n_words"] for r in got) == 54 and {r["kept_doc_id"] for r in got} == {1, 2, 3}
    text = {r["doc_id"]: r["text"] for r in passage_dedup.remove_repeats(make(rows), 20).collect()}
    assert text[3] == rows[2][1] and not any(x in text[4] for x in s) and len(text[4].split()) == 24


def test_passages_equal_all_sequences(make):
    rng = random.Random(22)
    pool = [sentence(rng, rng.randrange(5, 24)) for _ in range(9)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(1, 7)))) for i in range(30)]
    for run_words in (0, 20, 40):
        got = passage_rows(passage_dedup.find_repeats(make(rows), run_words))
        assert got and got == brute_passages(rows, run_words)


def test_short_lines_and_text_without_spaces_are_found(make):
    rng = random.Random(23)
    verse = "\n".join(" ".join(sentence(rng, rng.randrange(1, 4)).split()) for _ in range(30))
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))
    prose = "。".join(han(44) for _ in range(5)) + "。"
    blob = "".join(rng.choices("abcdefABCDEF0123456789+/", k=400))
    rows = [(1, f"Title of it\n{verse}"), (2, f"One\nTwo words\nand three more\n{verse}\n\nEnd"), (3, prose), (4, han(50) + "。" + prose), (5, blob), (6, f"See\n\n{blob}\n")]
    got = passage_rows(passage_dedup.find_repeats(make(rows)))
    assert got == brute_passages(rows, 0) and {r[0] for r in got} == {2, 4, 6}
    text = {r["doc_id"]: r["text"] for r in passage_dedup.remove_repeats(make(rows)).collect()}
    assert len(text[2]) < 0.4 * len(rows[1][1]) and len(text[4]) == 51 and text[6] == "See\n\n\n"
    assert len(brute_passages(rows, 20)) and passage_rows(passage_dedup.find_repeats(make(rows), 20)) == brute_passages(rows, 20)
