"""The thin queries over the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.llm import conversation_repair, coordinate_join, decontaminate, jaccard_join, line_dedup, mixing, passage_dedup, phrase_mining, quality, secrets, subword_lm, toxicity, vector_search
from chatlake.session import checkpointed, table


#: op1's production parameter.  Lines that many documents share by custom are line dedup's (op2); removing
#: every repeated sentence of five words too (``run_words`` 0) touches nearly every second document.
PASSAGE_WORDS = 20


def op1_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated passages that are removed from each document, with their original offsets."""
    return passage_dedup.find_repeats(table(spark, sf_dir, "documents"), PASSAGE_WORDS).drop("t")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each document after line dedup."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_WHITE_SQL = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

OP2_SQL = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, {_WHITE_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), hot AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN hot USING (k)
GROUP BY doc_id
"""


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document leaks."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best others of each fiftieth vector, in integers."""
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vectors = table(spark, sf_dir, "embeddings").filter(F.col("embedding").isNotNull()).filter(~bad).select("vec_id", whole.alias("embedding"))
    best = vector_search.exact_top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)
    return best.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(list_inner_product(q.v, c.v))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0
  GROUP BY ALL
), ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document by the mix of all sources."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][(((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1)::INTEGER]::BIGINT AS w FROM src
), ordered AS (
  SELECT *, sum(source_size) OVER () AS s_all, sum(w) OVER () AS w_all,
         coalesce(sum(source_size) OVER o, 0) AS s_before, coalesce(sum(w) OVER o, 0) AS w_before
  FROM weighed WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, 4 * source_size * (w_all - w_before) <= w * (3 * s_all - 4 * s_before) AS capped FROM ordered
), aimed AS (
  SELECT source, source_size, n_docs, s_all,
         CASE WHEN capped THEN (2 * source_size)::DOUBLE
              ELSE (w * (3 * s_all - 4 * coalesce(sum(source_size) FILTER (WHERE capped) OVER (), 0)))::DOUBLE
                   / (2 * sum(w) FILTER (WHERE NOT capped) OVER ())::DOUBLE END AS target
  FROM capped
), seats AS (
  SELECT source, target, floor(1.5::DOUBLE * s_all / {mixing.BLOCK_TOKENS} + 0.5)::BIGINT AS n FROM aimed
), quotient AS (
  SELECT source, n, target / (2 * m - 1) AS v
  FROM (SELECT source, target, n, unnest(range(1, n + 1)) AS m FROM seats WHERE target > 0)
), won AS (
  SELECT source, count(*) AS blocks
  FROM (SELECT source, n, row_number() OVER (ORDER BY v DESC, source NULLS LAST) AS r FROM quotient) WHERE r <= n GROUP BY source
), quota AS (
  SELECT a.*, coalesce(won.blocks, 0) AS blocks, ceil(n_docs / {mixing.SHARD_DOCS})::BIGINT AS shards
  FROM aimed a LEFT JOIN won ON a.source IS NOT DISTINCT FROM won.source
), dealt AS (
  SELECT z.*, source_size, target, blocks, ('0x' || substr(h, 1, 8))::BIGINT % shards AS shard
  FROM sized z JOIN quota q ON z.source IS NOT DISTINCT FROM q.source
), sharded AS (
  SELECT source, shard, sum(size)::BIGINT AS shard_size, max(blocks) AS blocks FROM dealt GROUP BY ALL
), shard_won AS (
  SELECT source, shard, count(*) AS quota
  FROM (SELECT source, shard, blocks, row_number() OVER (PARTITION BY source ORDER BY v DESC, shard) AS r
        FROM (SELECT source, shard, blocks, shard_size / (2 * unnest(range(1, blocks + 1)) - 1) AS v FROM sharded WHERE shard_size > 0))
  WHERE r <= blocks GROUP BY ALL
), shard_quota AS (
  SELECT s.source, s.shard, shard_size, coalesce(quota, 0) AS quota
  FROM sharded s LEFT JOIN shard_won w ON s.source IS NOT DISTINCT FROM w.source AND s.shard = w.shard
), placed AS (
  SELECT d.*, shard_size, least(quota * {mixing.BLOCK_TOKENS}, 2 * shard_size) AS tokens,
         coalesce(sum(size) OVER (PARTITION BY d.source, d.shard ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM dealt d JOIN shard_quota q ON d.source IS NOT DISTINCT FROM q.source AND d.shard = q.shard
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN shard_size > 0 THEN tokens // shard_size ELSE 0 END * size
        + greatest(0, least(size, tokens - CASE WHEN shard_size > 0 THEN tokens // shard_size ELSE 0 END * shard_size - start)))::BIGINT AS taken
FROM placed
"""


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of each document's secrets."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.shown(F.col("base")), 256).alias("base_sha256"), secrets.shown(F.col("parts")).alias("spans"))


def op6_subword_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of each document; the fold with remainder 2 teaches nothing."""
    return subword_lm.score(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document; the fold with remainder 0 teaches nothing."""
    vectors = checkpointed(quality.features(table(spark, sf_dir, "documents")))
    model = quality.train(vectors, table(spark, sf_dir, "labels"), "quality", 5, 0)
    scored = vectors.select("doc_id", quality.in_fold("doc_id", 5, 0).alias("held_out"), quality.score_vectors(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of near-duplicate links (5 words, 0.8) of each document."""
    joined = jaccard_join.join(table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "copy_of", "n_links", "class_size")


OP8_SQL = r"""
WITH RECURSIVE n AS (
  SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM documents
), w AS (
  SELECT doc_id, string_split(norm, ' ') AS ws FROM n WHERE norm <> ''
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w)
), c AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN c cx ON cx.doc_id = x JOIN c cy ON cy.doc_id = y WHERE k >= 0.8 * (cx.n + cy.n - k) - 1e-9
), t(x, y) AS (
  SELECT x, y FROM l UNION SELECT t.x, l.y FROM t JOIN l ON t.y = l.x
), r AS (
  SELECT x AS doc_id, min(y) AS first, count(*) FILTER (WHERE y <> x) AS others FROM t GROUP BY x
), links AS (
  SELECT x AS doc_id, count(*) AS n_links FROM l GROUP BY x
)
SELECT n.doc_id, least(n.doc_id, coalesce(r.first, n.doc_id)) AS class_id,
       CASE WHEN norm = '' THEN n.doc_id ELSE min(n.doc_id) OVER (PARTITION BY norm) END AS copy_of,
       coalesce(n_links, 0)::BIGINT AS n_links, (1 + coalesce(others, 0))::BIGINT AS class_size
FROM n LEFT JOIN r USING (doc_id) LEFT JOIN links USING (doc_id)
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document; the fold with remainder 2 teaches nothing."""
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", 4, 2)
    scored = docs.select("doc_id", toxicity.in_fold("doc_id", 4, 2).alias("held_out"), toxicity.score_texts(machine, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates (2 words, 0.8) of each document."""
    return coordinate_join.near_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), c AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN c cx ON cx.doc_id = x JOIN c cy ON cy.doc_id = y WHERE 100 * k >= 80 * (cx.n + cy.n - k)
), t(x, y) AS (
  SELECT x, y FROM l UNION SELECT t.x, l.y FROM t JOIN l ON t.y = l.x
), r AS (
  SELECT x AS doc_id, min(y) AS first FROM t GROUP BY x
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(first, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(first, doc_id)) AS kept
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN r USING (doc_id)
"""


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each lang."""
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), ws AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM ws, range(1, 6) AS r(m) WHERE len(w) >= m)
), f AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), total AS (
  SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang
), cuts AS (
  SELECT lang, m, phrase, f AS a, unnest(range(1, m)) AS k, string_split(phrase, ' ') AS w FROM f WHERE m > 1
), scored AS (
  SELECT c.lang, c.m, c.phrase, a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN total t ON t.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS sub, f
  FROM (SELECT lang, f, w, s, unnest(range(1, m - s + 2)) AS i FROM (SELECT lang, f, m, string_split(phrase, ' ') AS w, unnest(range(2, m)) AS s FROM f WHERE m > 2))
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.sub = b.phrase AND 100 * i.f >= 100 * b.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the damage that op13's contract fixes."""
    words = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, kind = F.coalesce("text", F.lit(" ")), F.crc32(words) % 20
    hurt = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return hurt.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("col")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of each damaged conversation."""
    conversations = table(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    audits = conversation_repair.repair(rows)
    digests = conversation_repair.digests(conversation_repair.repaired(rows, audits))
    done = audits.join(digests.withColumnRenamed("ck", "d_ck"), F.col("ck") == F.col("d_ck"), "left").withColumnRenamed("conv_id", "a_id")
    all_ids = conversations.select("conv_id").distinct()
    met = all_ids.join(done, F.col("conv_id").eqNullSafe(F.col("a_id")) & F.col("ck").isNotNull(), "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    counts = [number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


# CRC-32 by its bits, the cheapest edits by a recursion over the rows of all conversations at once.
OP13_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), crc AS (
  SELECT *, xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: ascii(key[i])::BIGINT),
      lambda c, b: list_reduce(range(8), lambda x, y: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM keyed
), rows_ AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM crc, range(2) AS copy(c) WHERE kind <> 0 AND (c = 0 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(concat_ws(':', length(role), role, text))) AS pos FROM rows_
), judged AS (
  SELECT *, left(role, 1) AS r, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         trim(text, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) AS body,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), faults AS (
  SELECT *, CASE WHEN body = '' THEN 'b' WHEN again THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM judged
), lengths AS (
  SELECT conv_id, max(pos) AS n FROM faults GROUP BY conv_id
), inserts(a, b, letters, lines, cost) AS (
  VALUES (0, 0, '', []::VARCHAR[], 0), (1, 1, '', [], 0), (2, 2, '', [], 0), (3, 3, '', [], 0), (0, 2, 'I', ['user:'], 5), (1, 2, 'I', ['user:'], 5),
         (3, 2, 'I', ['user:'], 5), (2, 3, 'I', ['assistant:'], 5), (0, 3, 'II', ['user:', 'assistant:'], 10), (1, 3, 'II', ['user:', 'assistant:'], 10)
), edits(edit, r, a, b, cost) AS (
  VALUES ('D', '*', 0, 0, 2), ('D', '*', 1, 1, 2), ('D', '*', 2, 2, 2), ('D', '*', 3, 3, 2), ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0),
         ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0), ('R', '*', 0, 2, 1), ('R', '*', 1, 2, 1), ('R', '*', 3, 2, 1), ('R', '*', 2, 3, 1)
), way(conv_id, pos, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} FROM lengths
  UNION ALL
  SELECT w.conv_id, w.pos + 1, e.b,
         min({'cost': w.best.cost + i.cost + e.cost + CASE WHEN f.fault = 't' AND e.edit <> 'D' THEN 5 ELSE 0 END,
              'audit': w.best.audit || i.letters || e.edit,
              'lines': w.best.lines || i.lines || CASE e.edit WHEN 'K' THEN [f.role || ':' || f.text] WHEN 'R' THEN [CASE e.b WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text] ELSE [] END})
  FROM way w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1
  JOIN inserts i ON i.a = w.state
  JOIN edits e ON e.a = i.b AND e.r IN ('*', f.r) AND (e.edit = 'D' OR f.fault NOT IN ('b', 'd'))
  GROUP BY w.conv_id, w.pos, e.b
), ended AS (
  SELECT w.conv_id, min({'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.letters, 'lines': w.best.lines || i.lines}) AS best
  FROM way w JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.pos
  JOIN inserts i ON i.a = w.state AND (i.b = 3 OR (i.b = 0 AND i.letters = ''))
  GROUP BY w.conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
         count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def queries() -> dict:
    return {
        "op1_passage_dedup": op1_passage_dedup,
        "op2_line_dedup": op2_line_dedup,
        "op3_decontaminate": op3_decontaminate,
        "op4_exact_top_k": op4_exact_top_k,
        "op5_mix_sources": op5_mix_sources,
        "op6_subword_lm": op6_subword_lm,
        "op7_quality": op7_quality,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_toxicity": op9_toxicity,
        "op10_secrets": op10_secrets,
        "op11_minhash_near_dedup": op11_minhash_near_dedup,
        "op12_phrase_collocations": op12_phrase_collocations,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op4_exact_top_k": OP4_SQL, "op5_mix_sources": OP5_SQL, "op8_jaccard_join": OP8_SQL, "op11_minhash_near_dedup": OP11_SQL, "op12_phrase_collocations": OP12_SQL, "op13_conversation_repair": OP13_SQL}
