"""Operators called directly, from another folder: workers find the package although only the driver has it on its path."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
CODE = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import functions as F
from chatlake.llm import {{module}}
from chatlake.session import local_session
spark = local_session(2, 2)
docs = spark.createDataFrame([(i, "some words that stand in a short text of ten words %d" % (i % 2), "en", "a", 9) for i in range(6)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(6)], "doc_id bigint, quality int, toxic int")
talks = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], "conv_id bigint, turn bigint, role string, text string")
vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "vec_id bigint, embedding array<double>")
print("rows", ({{call}}).count())
"""
CALLS = {
    "passage_dedup": "passage_dedup.find_repeats(docs)", "decontaminate": "decontaminate.find_leaks(docs, docs.withColumnRenamed('doc_id', 'item_id'))", "vector_search": "vector_search.exact_top_k(vectors, vectors, 2)",
    "subword_lm": "subword_lm.score(docs)", "quality": "quality.features(docs)", "jaccard_join": "jaccard_join.keep_one(docs)", "secrets": "secrets.find_secrets(docs)",
    "coordinate_join": "coordinate_join.near_dedup(docs)", "phrase_mining": "phrase_mining.collocations(docs, 2)", "conversation_repair": "conversation_repair.repair(talks)",
    "toxicity": "docs.select(toxicity.score_texts(toxicity.train(docs, labels, 'toxic'), docs))",
}


def test_operators_called_directly(tmp_path):
    """All at once: each is a process of its own with a fresh session."""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    names = list(CALLS)
    for at in range(0, len(names), 4):
        runs = {}
        for name in names[at : at + 4]:
            code = CODE.format(module=name, call=CALLS[name])
            runs[name] = subprocess.Popen([sys.executable, "-c", code], cwd=tmp_path, env=env, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True)
        for name, run in runs.items():
            said, _ = run.communicate(timeout=240)
            assert "rows" in said, (name, said[-2000:])
