import random

import corpus_pipeline as P
from chatlake.llm import decontaminate
from tests.llm.test_models import corpus
from tests.llm.test_pairs import brute_links

LABEL = "doc_id bigint, quality int, toxic int"


def folder(spark, tmp_path, labels, items):
    spark.createDataFrame(labels, LABEL).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_against_brute_force(spark, make, tmp_path):
    rng = random.Random(21)
    rows, labels = corpus(rng, 260)
    shared = "This long footer line stands below many documents of the set."
    item = "seven wise owls watch the quick brown fox from afar tonight again"
    good = [i for i, q, _ in labels if q]
    texts = dict(rows)
    for i in good[:8]:
        texts[i] += "\n" + shared
    for i in good[10:13]:
        texts[i] += " " + item.upper()
    for i, j in zip(good[20:25], good[30:35], strict=True):
        texts[j] = texts[i]
    docs = make([(i, t, "ab"[i % 2]) for i, t in texts.items()])
    d = folder(spark, tmp_path, labels, [(1, item)])
    docs.write.parquet(f"{d}/documents.parquet")
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, d)
        out.write.parquet(f"{d}/out{k}")
        after, before = spark.read.parquet(f"{d}/out{k}"), docs
        got = {r["doc_id"]: r for r in after.collect()}
        was = {r["doc_id"]: r for r in before.collect()}
        if k < 4:
            assert after.columns == before.columns, name
        if k == 0:
            quality = {i: q for i, q, _ in labels}
            assert sum(quality[i] for i in got) >= 0.98 * len(good) and sum(1 - quality[i] for i in got) <= 3
        elif k == 1:
            holders = [i for i, r in was.items() if shared in r["text"]]
            assert len(holders) >= 5 and [i for i, r in got.items() if shared in r["text"]] == [max(holders)]
            assert all(r["n_chars"] == len(r["text"]) for i, r in got.items() if r["text"] != was[i]["text"])
        elif k == 2:
            assert set(got) == {c for _, _, c in brute_links([(i, r["text"]) for i, r in was.items()])}
        elif k == 3:
            bench = decontaminate.Benchmark([(1, item)])
            assert set(got) == {i for i, r in was.items() if not bench.hits(r["text"], decontaminate.COVERAGE)} and len(got) < len(was)
        else:
            total = sum(len(r["text"].split()) for r in was.values())
            assert abs(sum(r["taken"] for r in got.values()) - 1.5 * total) < 0.05 * total and all(0 < r["taken"] <= 2 * r["size"] for r in got.values())
        docs = after
    assert sorted(map(str, P.run(spark, d).collect())) == sorted(map(str, docs.collect()))


def test_stages_take_odd_and_empty_tables(spark, odd, empty, clash, tmp_path):
    d = folder(spark, tmp_path, [(4, 1, 0), (8, 0, 1), (None, 1, None), (4, 1, 1)], [(1, "a b c d e f g h"), (None, None)])
    for name, stage in P.STAGES:
        for docs in (clash(odd), empty, odd):
            out = stage(spark, docs, d)
            assert out.count() <= docs.count()
            if name != P.STAGES[-1][0]:
                assert out.columns == docs.columns, name
