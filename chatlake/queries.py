"""Queries over the driver's tables, one for each operator, with their SQL.

The tables stand in for the archive's: ``events`` is an observation log (its chunk is a hundred
events), ``conversations`` are threads (the first turn is the parent), ``customer``, ``nation`` and
``region`` are dimensions, ``orders`` facts, ``documents`` and ``labels`` search documents, ``pages``
strings to clean.  A checkpoint lies at nine tenths of the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.functions import scalars as S
from chatlake.operators import attachments, canonicalize, lineage, merge, metadata, metrics, newest, proofs, rollout, views
from chatlake.session import table
from chatlake.sources import blocks

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("chunk", F.expr("event_id div 100"))


def _marked(log: DataFrame) -> DataFrame:
    """The log with its high-water mark beside each row: one number, joined as one row."""
    return log.join(F.broadcast(log.agg(F.expr("max(event_id) * 9 div 10").alias("mark"))))


_SQL_LOG = "WITH log AS (SELECT *, event_id // 100 AS chunk FROM events), mark AS (SELECT max(event_id) * 9 // 10 AS m FROM events)"


def _newest_first():
    return [F.col("ts").desc(), F.col("event_id").desc()]


# newest rows, touched keys, snapshots ------------------------------------------------------------


@query("""SELECT event_id, user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def newest_per_key(spark, d):
    return newest.newest_rows(table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value"), ["user_id", "event_type"], _newest_first())


@query(f"""{_SQL_LOG}, touched AS (SELECT DISTINCT user_id, event_type FROM log, mark WHERE event_id > m)
SELECT event_id, user_id, event_type, value FROM (
  SELECT l.*, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
  FROM log l JOIN touched USING (user_id, event_type)) WHERE r = 1""")
def newest_for_touched_keys(spark, d):
    log = _marked(_log(spark, d))
    return newest.newest_for_touched(log, ["user_id", "event_type"], _newest_first(), "event_id", F.col("mark")).select("event_id", "user_id", "event_type", "value")


@query(f"{_SQL_LOG} SELECT DISTINCT user_id, event_type FROM log, mark WHERE event_id > m")
def touched_keys(spark, d):
    return newest.touched_keys(_marked(_log(spark, d)), ["user_id", "event_type"], "event_id", F.col("mark"))


@query(f"""{_SQL_LOG} SELECT DISTINCT user_id, event_type, chunk FROM log JOIN (SELECT user_id, max(chunk) AS chunk FROM log GROUP BY user_id) USING (user_id, chunk)""")
def membership_snapshot(spark, d):
    return newest.membership_snapshot(_log(spark, d), "user_id", "event_type", "chunk")


@query("SELECT count(*) AS duplicate_keys, coalesce(sum(n - 1), 0)::BIGINT AS duplicate_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)")
def duplicate_stats(spark, d):
    return newest.duplicate_stats(table(spark, d, "documents").select(F.sha2("text", 256).alias("digest")), ["digest"])


@query("SELECT doc_id, lang, payload FROM (SELECT doc_id, lang, sha256(text) AS payload, row_number() OVER (PARTITION BY lang, sha256(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def payload_dedupe(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return newest.identical_copies_removed(docs, ["lang"], F.col("text"), [F.col("doc_id")]).select("doc_id", "lang", F.sha2("text", 256).alias("payload"))


@query("SELECT event_id, user_id, ts, chunk FROM (SELECT *, event_id // 100 AS chunk FROM events) ORDER BY chunk DESC, event_id DESC LIMIT 1")
def latest_observation(spark, d):
    return _log(spark, d).select("event_id", "user_id", "ts", "chunk").orderBy(F.desc("chunk"), F.desc("event_id")).limit(1)


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS latest_type, max(ts) AS latest_ts FROM events GROUP BY user_id")
def latest_ts(spark, d):
    return newest.latest_value(table(spark, d, "events"), ["user_id"], "event_type", ["ts", "event_id"])


# classification and merges -----------------------------------------------------------------------

_SQL_STATES = """WITH mark AS (SELECT max(event_id) * 9 // 10 AS m FROM events),
old AS (SELECT user_id, event_type, arg_max(value, event_id) AS value, min(ts) AS first_ts, max(event_id) AS version FROM events, mark WHERE event_id <= m GROUP BY ALL),
new AS (SELECT user_id, event_type, arg_max(value, event_id) AS value, min(ts) AS first_ts, max(event_id) AS version FROM events, mark WHERE event_id > m OR event_type = 'click' GROUP BY ALL)"""


def _states(spark, d) -> tuple[DataFrame, DataFrame]:
    log, at = _marked(table(spark, d, "events")), F.col("mark")
    state = lambda rows: rows.groupBy("user_id", "event_type").agg(F.max_by("value", "event_id").alias("value"), F.min("ts").alias("first_ts"), F.max("event_id").alias("version"))
    return state(log.filter(F.col("event_id") <= at)), state(log.filter((F.col("event_id") > at) | (F.col("event_type") == "click")))


@query(f"""{_SQL_STATES} SELECT n.user_id, n.event_type, n.value,
  CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.value IS DISTINCT FROM o.value THEN 'update' ELSE 'unchanged' END AS change
FROM new n LEFT JOIN old o USING (user_id, event_type)""")
def change_classes(spark, d):
    old, new = _states(spark, d)
    return merge.classify(new, old, ["user_id", "event_type"], "value").select("user_id", "event_type", "value", "change")


@query(f"""{_SQL_STATES}, c AS (SELECT CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.value IS DISTINCT FROM o.value THEN 'update' ELSE 'unchanged' END AS change
FROM new n LEFT JOIN old o USING (user_id, event_type))
SELECT count(*) FILTER (WHERE change = 'insert') AS inserted, count(*) FILTER (WHERE change = 'update') AS updated, count(*) FILTER (WHERE change = 'unchanged') AS unchanged FROM c""")
def change_counts(spark, d):
    old, new = _states(spark, d)
    return merge.change_counts(merge.classify(new, old, ["user_id", "event_type"], "value"))


@query(f"""{_SQL_STATES} SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.event_type, o.event_type) AS event_type,
  CASE WHEN n.user_id IS NOT NULL THEN n.value ELSE o.value END AS value, coalesce(o.first_ts, n.first_ts) AS first_ts, coalesce(n.version, o.version) AS version
FROM old o FULL JOIN new n ON o.user_id = n.user_id AND o.event_type = n.event_type""")
def merged_entities(spark, d):
    old, new = _states(spark, d)
    return merge.merge(old, new, ["user_id", "event_type"], keep_old=["first_ts"])


@query(f"""{_SQL_STATES}, scopes AS (SELECT DISTINCT user_id FROM new)
SELECT user_id, event_type, version, first_ts FROM old WHERE NOT EXISTS (SELECT 1 FROM scopes s WHERE s.user_id = old.user_id)
UNION ALL SELECT n.user_id, n.event_type, n.version, coalesce(o.first_ts, n.first_ts) FROM new n LEFT JOIN old o USING (user_id, event_type)""")
def scoped_replace(spark, d):
    old, new = _states(spark, d)
    keep = ["user_id", "event_type", "version", "first_ts"]
    return merge.scoped_replace(old.select(*keep), new.select(*keep), ["user_id"], ["user_id", "event_type"], keep_old=["first_ts"])


@query("""WITH words AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations),
seen AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE role = 'assistant'),
kids AS (SELECT DISTINCT conv_id, turn, lower(word) AS word FROM words JOIN seen USING (conv_id, turn))
SELECT DISTINCT conv_id, turn, word FROM words WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.conv_id = words.conv_id AND s.turn = words.turn)
UNION ALL SELECT * FROM kids""")
def replaced_children(spark, d):
    conv = table(spark, d, "conversations")
    words = conv.select("conv_id", "turn", F.explode(F.split("text", " ")).alias("word")).distinct()
    seen = conv.filter("role = 'assistant'").select("conv_id", "turn").distinct()
    kids = words.join(seen, ["conv_id", "turn"], "left_semi").select("conv_id", "turn", F.lower("word").alias("word")).distinct()
    return merge.replace_children(words, seen, kids, ["conv_id", "turn"])


@query(f"""{_SQL_STATES} SELECT n.user_id, n.event_type, sha256(n.user_id || chr(31) || n.event_type || chr(31) || n.version) AS event_id,
  CASE WHEN n.event_type = 'error' THEN 'observed_deleted' WHEN o.user_id IS NULL THEN 'created' ELSE 'edited' END AS kind
FROM new n LEFT JOIN old o USING (user_id, event_type) WHERE o.user_id IS NULL OR n.value IS DISTINCT FROM o.value""")
def event_append(spark, d):
    old, new = _states(spark, d)
    seen = merge.classify(new, old, ["user_id", "event_type"], "value")
    kind = merge.event_type(F.col("change"), F.col("event_type") == "error")
    return seen.select("user_id", "event_type", S.stable_key(F.col("user_id").cast("string"), F.col("event_type"), F.col("version").cast("string")).alias("event_id"), kind.alias("kind")).filter("kind IS NOT NULL")


@query("SELECT c_custkey, c_acctbal, CASE WHEN f.total IS NOT NULL AND f.total IS DISTINCT FROM c_acctbal THEN f.total ELSE c_acctbal END AS recorded, f.total IS NOT NULL AND f.total IS DISTINCT FROM c_acctbal AS changed FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, min(o_totalprice) AS total FROM orders GROUP BY 1) f USING (c_custkey)")
def null_safe_update(spark, d):
    cust = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.col("c_acctbal").alias("recorded"))
    found = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("recorded"))
    return merge.record_values(cust, found, ["c_custkey"], "recorded")


# proofs ------------------------------------------------------------------------------------------


@query("SELECT user_id, event_type FROM events EXCEPT SELECT user_id, event_type FROM events WHERE value > (SELECT avg(value) FROM events)")
def vanished_keys(spark, d):
    log = table(spark, d, "events")
    kept = log.join(F.broadcast(log.agg(F.avg("value").alias("mean"))), F.col("value") > F.col("mean"))
    return merge.vanished(log, kept, ["user_id", "event_type"])


_SQL_VERSIONS = """WITH cur AS (SELECT user_id, event_type, max(event_id // 100) AS version, max(value) AS v FROM events GROUP BY ALL),
inc AS (SELECT user_id, event_type, max(CASE WHEN r = 1 THEN event_id // 100 END) AS version, max(value) + user_id % 2 AS v
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id DESC) AS r FROM events) GROUP BY user_id, event_type)"""


def _versions(spark, d):
    log = _log(spark, d)
    cur = log.groupBy("user_id", "event_type").agg(F.max("chunk").alias("version"), F.max("value").alias("v"))
    inc = log.groupBy("user_id", "event_type").agg(F.max(F.struct("value", "event_id", "chunk")).alias("x")).select("user_id", "event_type", F.col("x.chunk").alias("version"), (F.col("x.value") + F.col("user_id") % 2).alias("v"))
    return cur, inc


@query(f"""{_SQL_VERSIONS} SELECT user_id, event_type, c.version AS old_version, i.version AS new_version, CASE WHEN i.version < c.version THEN 'regressed' ELSE 'rewritten' END AS reason
FROM cur c JOIN inc i USING (user_id, event_type) WHERE i.version < c.version OR (i.version = c.version AND i.v IS DISTINCT FROM c.v)""")
def regression_rows(spark, d):
    cur, inc = _versions(spark, d)
    return merge.regressions(cur, inc, ["user_id", "event_type"], "version", "v")


@query(f"""{_SQL_STATES}, met AS (SELECT o.user_id AS a, n.user_id AS b, o.value IS DISTINCT FROM n.value AS v, o.version IS DISTINCT FROM n.version AS w, o.version AS x, n.version AS y FROM old o FULL JOIN new n ON o.user_id = n.user_id AND o.event_type = n.event_type)
SELECT count(a) AS source_natural_key_count, count(b) AS canonical_natural_key_count, count(*) FILTER (WHERE b IS NULL) AS missing_canonical_key_count, count(*) FILTER (WHERE a IS NULL) AS extra_canonical_key_count,
  count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND (v OR w)) AS selected_payload_mismatch_count, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND v) AS raw_json_mismatch_count,
  count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND w) AS source_chunk_mismatch_count, count(*) FILTER (WHERE a IS NULL OR b IS NULL) = 0 AS natural_keys_match, max(x) IS NOT DISTINCT FROM max(y) AS latest_timestamp_matches,
  max(x)::VARCHAR AS source_latest_timestamp, max(y)::VARCHAR AS canonical_latest_timestamp FROM met""")
def validation_report(spark, d):
    side = lambda rows: rows.select("user_id", "event_type", F.col("value").alias("digest"), F.col("version").alias("chunk"), F.col("version").alias("ts_us"), F.col("version").cast("string").alias("ts"))
    old, new = map(side, _states(spark, d))
    return proofs.validation(old, new, ["user_id", "event_type"])


@query(f"""{_SQL_STATES} SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.event_type, n.event_type) AS event_type, o.value AS before, n.value AS after
FROM old o FULL JOIN new n ON o.user_id = n.user_id AND o.event_type = n.event_type WHERE o.value IS DISTINCT FROM n.value""")
def compaction_differences(spark, d):
    old, new = _states(spark, d)
    return proofs.compaction_differences(old, new, ["user_id", "event_type"], "value")


@query("SELECT conv_id, turn FROM conversations c WHERE turn > 0 AND NOT EXISTS (SELECT 1 FROM conversations p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 1 AND p.role = 'user')")
def orphan_replies(spark, d):
    conv = table(spark, d, "conversations")
    messages = conv.select("conv_id", "turn", F.when(F.col("turn") > 0, F.col("turn") - 1).alias("parent"), F.when(F.col("role") == "user", F.col("turn")).alias("own"))
    return views.orphan_replies(messages, ["conv_id"], "parent", "own").select("conv_id", "turn")


@query("SELECT o_custkey, o_orderpriority FROM orders GROUP BY o_custkey, o_orderpriority HAVING max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) = 0")
def incomplete_streams(spark, d):
    return proofs.incomplete_streams(table(spark, d, "orders"), [F.col("o_custkey"), F.col("o_orderpriority")], F.col("o_orderstatus") == "F")


_DIGESTED = {"customer": ["c_acctbal", "c_custkey", "c_mktsegment", "c_name", "c_nationkey"], "documents": ["doc_id", "lang", "n_chars", "source", "text"], "labels": ["doc_id", "quality", "toxic"], "part": ["p_brand", "p_name", "p_partkey", "p_size", "p_type"]}
_SQL_DIGESTS = " UNION ALL ".join(
    f"SELECT '{t}' AS name, h FROM (SELECT sha256(to_json({{{', '.join(f'{c}: {c}' for c in columns)}}})) AS h FROM {t})" for t, columns in _DIGESTED.items()
)


@query(f"""SELECT name, count(*) AS rows, sha256(sum(('0x' || substr(h, 1, 7))::BIGINT)::VARCHAR || ':' || sum(('0x' || substr(h, 8, 7))::BIGINT)::VARCHAR || ':' || bit_xor(('0x' || substr(h, 15, 15))::BIGINT)::VARCHAR) AS digest
FROM ({_SQL_DIGESTS}) GROUP BY ALL""")
def table_digest(spark, d):
    parts = [proofs.table_digest(table(spark, d, t).select(*columns), t) for t, columns in _DIGESTED.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("table", "name")


@query("SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'conversations', count(*) FROM conversations")
def table_counts(spark, d):
    return proofs.row_counts({t: table(spark, d, t) for t in ("customer", "orders", "events", "documents", "conversations")})


@query("SELECT n_nationkey AS workspace_id, n_name FROM nation WHERE EXISTS (SELECT 1 FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey = n_nationkey AND o_orderstatus = 'F')")
def checkpoint_exists(spark, d):
    workspaces = table(spark, d, "nation").select(F.col("n_nationkey").alias("workspace_id"), "n_name")
    checkpoints = table(spark, d, "customer").select(F.col("c_nationkey").alias("workspace_id"), F.col("c_custkey").alias("successful_run_id"))
    runs = table(spark, d, "orders").select(F.col("o_custkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("started").alias("status"))
    return proofs.accepted_checkpoints(workspaces, checkpoints, runs)


@query("SELECT max(event_id) AS event_high_water, max(event_id // 100) AS chunk_high_water, (SELECT max(o_orderkey) FROM orders) < max(event_id) AS regressed FROM events")
def high_waters(spark, d):
    marks = proofs.high_waters(_log(spark, d), {"event_high_water": "event_id", "chunk_high_water": "chunk"})
    other = table(spark, d, "orders").agg(F.max("o_orderkey").alias("v"))
    return marks.join(F.broadcast(other)).select("event_high_water", "chunk_high_water", S.regressed(F.col("v"), F.col("event_high_water")).alias("regressed"))


@query("SELECT source, count(*) AS n, count(*) FILTER (WHERE quality IS NULL) AS backlog, max(n_chars)::DOUBLE / 1000000.0::DOUBLE AS newest FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def backlog(spark, d):
    met = table(spark, d, "documents").select("doc_id", "source", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    return met.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality").isNull()).alias("backlog"), (F.max("n_chars").cast("double") / 1e6).alias("newest"))


# views -------------------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, r_regionkey::BIGINT AS workspace_id, l_suppkey AS channel_id, l_partkey AS user_id, r_name AS workspace_slug, lower(r_name) AS team_name, s_name AS channel_name, p_name AS username, p_brand AS real_name, p_type AS display_name
FROM lineitem JOIN (SELECT * FROM region WHERE r_regionkey > 0) ON r_regionkey = l_suppkey % 5 LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey > 5) ON s_suppkey = l_suppkey
LEFT JOIN (SELECT * FROM part WHERE p_size > 20) ON p_partkey = l_partkey AND p_partkey % 5 = l_suppkey % 5""")
def enriched_view(spark, d):
    messages = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 5).alias("workspace_id"), F.col("l_suppkey").alias("channel_id"), F.col("l_partkey").alias("user_id"))
    workspaces = table(spark, d, "region").filter("r_regionkey > 0").select(F.col("r_regionkey").cast("long").alias("workspace_id"), F.col("r_name").alias("workspace_slug"), F.lower("r_name").alias("team_name"))
    channels = table(spark, d, "supplier").filter("s_nationkey > 5").select((F.col("s_suppkey") % 5).alias("workspace_id"), F.col("s_suppkey").alias("channel_id"), F.col("s_name").alias("name"))
    users = table(spark, d, "part").filter("p_size > 20").select((F.col("p_partkey") % 5).alias("workspace_id"), F.col("p_partkey").alias("user_id"), F.col("p_name").alias("username"), F.col("p_brand").alias("real_name"), F.col("p_type").alias("display_name"))
    return views.enriched(messages, workspaces, channels, users)


@query("SELECT conv_id, turn, role FROM conversations WHERE NOT (role = 'system') AND (NOT (turn > 0) OR role = 'user')")
def timeline(spark, d):
    conv = table(spark, d, "conversations").select("conv_id", "turn", "role", (F.col("role") == "system").alias("deleted"), (F.col("turn") > 0).alias("reply"), (F.col("role") == "user").alias("broadcast"))
    return views.timeline(conv, "deleted", "reply", "broadcast").select("conv_id", "turn", "role")


@query("SELECT conv_id, count(*) AS message_count, min(turn) AS first_ts_us, max(turn) AS last_ts_us, string_agg(k, ',' ORDER BY turn, k) AS message_keys FROM (SELECT conv_id, turn, sha256(conv_id || chr(31) || turn) AS k FROM conversations) GROUP BY conv_id")
def threads(spark, d):
    conv = table(spark, d, "conversations").select("conv_id", "turn", S.stable_key(F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("k"))
    return views.threads(conv, ["conv_id"], "turn", "k").withColumn("message_keys", F.array_join("message_keys", ","))


@query("""SELECT sha256(event_id || chr(31) || user_id) AS document_id, event_type AS document_text, 'message' AS document_kind,
  '{"subtype":' || CASE WHEN event_type = 'click' THEN 'null' ELSE '"' || event_type || '"' END || ',"is_edited":' || (value > 50)::VARCHAR || ',"has_files":' || (props IS NOT NULL)::VARCHAR || '}' AS metadata_json
FROM events WHERE NOT (event_type = 'error')""")
def search_documents(spark, d):
    e = table(spark, d, "events")
    messages = e.select(
        S.stable_key(F.col("event_id").cast("string"), F.col("user_id").cast("string")).alias("message_key"), F.lit("w").alias("workspace_id"), F.lit("c").alias("channel_id"), "user_id", "ts", F.col("event_id").alias("ts_us"), F.lit("").alias("thread_ts"),
        F.nullif("event_type", F.lit("click")).alias("subtype"), (F.col("value") > 50).alias("is_edited"), F.col("props").alias("file_metadata_json"), (F.col("event_type") == "error").alias("is_deleted"), F.col("event_type").alias("search_text"), F.lit("").alias("payload_hash"),
    )
    return views.search_documents(messages).select("document_id", "document_text", "document_kind", "metadata_json")


# scalars -----------------------------------------------------------------------------------------


@query("SELECT doc_id, sha256('w' || chr(31) || source || chr(31) || doc_id) AS message_key, sha256(text) AS payload_hash FROM documents")
def stable_keys(spark, d):
    return table(spark, d, "documents").select("doc_id", S.stable_key(F.lit("w"), F.col("source"), F.col("doc_id").cast("string")).alias("message_key"), F.sha2("text", 256).alias("payload_hash"))


@query("SELECT event_id, epoch_us(ts) AS us, (epoch_us(ts) // 1000000)::VARCHAR || '.' || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0') AS ts_text FROM events")
def micros_to_ts(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", us.alias("us"), S.id_to_ts(us).alias("ts_text"))


@query("SELECT event_id, epoch_us(ts) + event_id % 10 AS us FROM events")
def ts_micros(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 10
    return table(spark, d, "events").select("event_id", S.ts_us(S.id_to_ts(us)).alias("us"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.missing").alias("missing"))


@query("""WITH j AS (SELECT CASE WHEN event_id % 3 = 0 THEN props WHEN event_id % 3 = 1 THEN '[' || props || ']' ELSE event_type END AS j FROM events)
SELECT count(*) AS n, count(*) FILTER (WHERE NOT coalesce(json_valid(j) AND json_type(CASE WHEN json_valid(j) THEN j END) = 'OBJECT', false)) AS invalid FROM j""")
def json_validity(spark, d):
    text = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("event_type"))
    return table(spark, d, "events").agg(F.count(F.lit(1)).alias("n"), F.count_if(~S.is_json_object(text)).alias("invalid"))


@query("SELECT p_partkey, coalesce(nullif(CASE WHEN p_size > 25 THEN '' ELSE p_brand END, ''), p_name) AS label, coalesce(nullif(p_size - 1, 0), p_partkey) AS size FROM part")
def falsy_coalesce(spark, d):
    return table(spark, d, "part").select("p_partkey", S.or_else(F.when(F.col("p_size") > 25, "").otherwise(F.col("p_brand")), F.col("p_name")).alias("label"), S.nonzero((F.col("p_size") - 1).cast("long"), F.col("p_partkey")).alias("size"))


@query("SELECT p_partkey, CASE WHEN regexp_matches(s, '^[0-9]') THEN 'workspace_' || s ELSE s END AS slug FROM (SELECT p_partkey, trim(regexp_replace(lower(p_type || ' ' || p_name), '[^a-z0-9]+', '_', 'g'), '_') AS s FROM part)")
def slugs(spark, d):
    return table(spark, d, "part").select("p_partkey", S.slug(F.concat_ws(" ", "p_type", "p_name")).alias("slug"))


@query(r"""SELECT page_id, CASE WHEN regexp_matches(name, '(?i)^(con|prn|aux|nul|com[1-9]|lpt[1-9])(\.|$)') THEN '_' || name ELSE name END AS name
FROM (SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'Com' || page_id % 10 || '.' || chr(9) || url WHEN 2 THEN url || '. .' ELSE '. ' END, '[<>:"/\\|?*]', '_', 'g'), '[ .]+$', ''), ''), 'unnamed_file') AS name FROM pages)""")
def safe_names(spark, d):
    n = F.col("page_id") % 4
    raw = F.when(n == 0, F.col("url")).when(n == 1, F.concat(F.lit("Com"), (F.col("page_id") % 10).cast("string"), F.lit(".\t"), F.col("url"))).when(n == 2, F.concat("url", F.lit(". ."))).otherwise(". ")
    return table(spark, d, "pages").select("page_id", S.safe_filename(raw).alias("name"))


_TAIL = r"' by xoxb-' || source || '.' || doc_id || '/e_9" + r'"rest XOXP-' + r"' || lang || '\q fooxoxa-1'"
_SQL_TOKEN = r"""\bxox[a-zA-Z]-[^\s''"\\]+"""  # spelled out beside the library's own


@query(f"SELECT doc_id, sha256(regexp_replace(replace(text || {_TAIL}, 'src1', '[REDACTED]'), '{_SQL_TOKEN}', '[REDACTED]', 'g')) AS redacted FROM documents")
def redaction(spark, d):
    tail = F.concat(F.lit(" by xoxb-"), "source", F.lit("."), F.col("doc_id").cast("string"), F.lit('/e_9"rest XOXP-'), "lang", F.lit(r"\q fooxoxa-1"))
    return table(spark, d, "documents").select("doc_id", F.sha2(S.redact(F.concat("text", tail), ("src1",)), 256).alias("redacted"))


# Messages of which two orders' numbers make many: each rule, both at once, and neither.
_FAILURES = (
    "dial tcp: lookup x: no such host", "Context Deadline Exceeded", "status code 503", "502 Bad Gateway", "read: connection reset by peer", "TLS handshake timeout",
    "invalid_cookie", "INVALID_AUTH", "token_revoked: unexpected EOF", "401 unauthorized", "my_invalid_auth", "timed out", "no such channel", "status code 5030",
)
_SQL_FAILURE = f"[{', '.join(repr(x) for x in _FAILURES)}]"


# Spelled out beside the library's own patterns.
_SQL_TRANSIENT = (
    r"dial tcp|lookup .*?(no such host|server misbehaving|temporary failure)|server misbehaving|no such host|temporary failure in name resolution|network (is )?unreachable|connection (refused|reset|timed out)|"
    r"i/o timeout|context deadline exceeded|operation timed out|TLS handshake timeout|unexpected EOF|status code 50[234]\b|\b50[234] (Bad Gateway|Service Unavailable|Gateway Timeout)\b"
)
_SQL_REFUSED = r"\b(invalid_auth|not_authed|account_inactive|token_revoked|invalid_cookie)\b"


@query(rf"""SELECT o_orderkey, CASE WHEN regexp_matches(m, '(?i){_SQL_TRANSIENT}') THEN 'transient' WHEN o_orderpriority LIKE '1%' OR regexp_matches(m, '(?i){_SQL_REFUSED}') THEN 'authentication' ELSE 'other' END AS class
FROM (SELECT o_orderkey, o_orderpriority, {_SQL_FAILURE}[o_orderkey % {len(_FAILURES)} + 1] || ' / ' || {_SQL_FAILURE}[o_custkey % {len(_FAILURES)} + 1] AS m FROM orders)""")
def failure_classes(spark, d):
    said = F.array(*map(F.lit, _FAILURES))
    pick = lambda c: F.get(said, (F.col(c) % len(_FAILURES)).cast("int"))
    m = F.concat(F.lit("\x1b[31m"), pick("o_orderkey"), F.lit(" \x1b[0m/ "), pick("o_custkey"))
    action = F.when(F.col("o_orderpriority").startswith("1"), "authentication")
    return table(spark, d, "orders").select("o_orderkey", S.failure_class(m, action).alias("class"))


@query("SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS protocol, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, regexp_matches(url, '^https://[^/:@?#]+\\.com(/|$)') AS ok FROM pages")
def url_parts(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select("page_id", F.try_parse_url(url, F.lit("PROTOCOL")).alias("protocol"), F.try_parse_url(url, F.lit("HOST")).alias("host"), S.site_url_ok(url, ".com").alias("ok"))


_SQL_EDGES = r"['', ' ', '.', chr(9), chr(8195), '/', '\', chr(127), 'é']"


@query(rf"""SELECT p_partkey, id, length(id) BETWEEN 1 AND 64 AND NOT regexp_matches(id, '[\x00-\x1f\x7f/\\]') AND left(id, 1) NOT IN ('.', ' ', chr(8195)) AND right(id, 1) NOT IN (' ', chr(8195)) AS ok
FROM (SELECT p_partkey, {_SQL_EDGES}[p_partkey % 9 + 1] || repeat(p_brand, p_partkey % 10) || {_SQL_EDGES}[p_size % 9 + 1] AS id FROM part)""")
def workspace_ids(spark, d):
    edges = F.array(*map(F.lit, ("", " ", ".", "\t", " ", "/", "\\", "\x7f", "é")))
    edge = lambda c: F.get(edges, (F.col(c) % 9).cast("int"))
    name = F.concat(edge("p_partkey"), F.repeat(F.col("p_brand"), (F.col("p_partkey") % 10).cast("int")), edge("p_size"))
    return table(spark, d, "part").select("p_partkey", name.alias("id"), S.workspace_id_ok(name).alias("ok"))


@query("SELECT doc_id, sha256(replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')) AS label, translate(base64(encode(source)), '+/', '-_') AS path FROM documents")
def metric_labels(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(S.label_value(F.col("text")), 256).alias("label"), S.path_label(F.col("source")).alias("path"))


@query("SELECT s_suppkey, list_aggregate(list_filter([lower(trim(x)) FOR x IN string_split(s_name || ', ' || s_suppkey || ',,', ',')], lambda x: x <> ''), 'string_agg', '|') AS items FROM supplier")
def parsed_lists(spark, d):
    text = F.concat(F.col("s_name"), F.lit(", "), F.col("s_suppkey").cast("string"), F.lit(",,"))
    return table(spark, d, "supplier").select("s_suppkey", F.array_join(S.parsed_list(text), "|").alias("items"))


# reports -----------------------------------------------------------------------------------------

_SQL_FILES = """WITH wanted AS (SELECT l_orderkey || '-' || l_linenumber AS file_id, l_linestatus AS name, l_quantity::BIGINT AS size, CASE WHEN l_returnflag = 'R' THEN 'snippet' ELSE 'hosted' END AS mode FROM lineitem),
present AS (SELECT l_orderkey || '-' || l_linenumber AS file_id, l_linestatus AS name, (l_quantity + l_orderkey % 3)::BIGINT AS served FROM lineitem WHERE l_linenumber <> 4),
ok AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber AS file_id, (l_quantity + 1)::BIGINT AS accepted FROM lineitem WHERE l_returnflag = 'A'),
met AS (SELECT w.*, served, CASE WHEN served IS NULL THEN 'missing' WHEN size <= 0 OR served = size THEN 'match' WHEN mode = 'snippet' AND abs(served - size) <= 64 THEN 'snippet' WHEN accepted = served THEN 'documented' ELSE 'mismatch' END AS class
FROM wanted w LEFT JOIN present USING (file_id, name) LEFT JOIN ok USING (file_id))"""


def _reconciled(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    file_id = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("file_id")
    wanted = li.select(file_id, F.col("l_linestatus").alias("name"), F.col("l_quantity").cast("long").alias("size"), F.when(F.col("l_returnflag") == "R", "snippet").otherwise("hosted").alias("mode"), F.lit("text/plain").alias("mime"))
    present = li.filter("l_linenumber <> 4").select(file_id, F.col("l_linestatus").alias("name"), (F.col("l_quantity") + F.col("l_orderkey") % 3).cast("long").alias("served"))
    ok = li.filter("l_returnflag = 'A'").select(file_id, (F.col("l_quantity") + 1).cast("long").alias("accepted")).distinct()
    return attachments.reconciled(wanted, present, ok)


@query(f"""{_SQL_FILES} SELECT count(*) AS expected_count, count(served) AS present_count, count(*) FILTER (WHERE class = 'missing') AS missing_count, count(*) FILTER (WHERE class = 'mismatch') AS size_mismatch_count,
 sum(size)::BIGINT AS expected_bytes, sum(served)::BIGINT AS present_bytes, count(*) FILTER (WHERE class = 'snippet') AS snippet_variance_count, coalesce(sum(abs(served - size)) FILTER (WHERE class = 'snippet'), 0)::BIGINT AS snippet_variance_bytes,
 count(*) FILTER (WHERE class = 'documented') AS documented_variance_count, coalesce(sum(abs(served - size)) FILTER (WHERE class = 'documented'), 0)::BIGINT AS documented_variance_bytes FROM met""")
def reconcile_report(spark, d):
    return attachments.report(_reconciled(spark, d), shown=0).drop("skipped_count", "unsafe_count")


@query(f"""{_SQL_FILES} SELECT split_part(file_id, '-', 1)::BIGINT % 97 AS part, count(*) AS files, sum(abs(served - size))::BIGINT AS bytes, string_agg(file_id || '=' || served, ',' ORDER BY file_id || '=' || served) AS listed
FROM met WHERE class = 'documented' GROUP BY ALL""")
def variance_totals(spark, d):
    part = F.split_part("file_id", F.lit("-"), F.lit(1)).cast("long") % 97
    return attachments.variance_totals(_reconciled(spark, d).withColumn("part", part), ["part"])


@query("""WITH apart AS (SELECT DISTINCT upper(source) AS name FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
SELECT source, sum(n_chars)::BIGINT AS bytes, row_number() OVER (ORDER BY sum(n_chars), source)::INTEGER AS place FROM documents
WHERE upper(source) NOT IN (SELECT name FROM apart) OR (SELECT count(*) FROM documents WHERE upper(source) NOT IN (SELECT name FROM apart)) = 0 GROUP BY source""")
def rollout_order(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars")
    apart = docs.join(table(spark, d, "labels").filter("toxic = 1"), "doc_id", "left_semi").select(F.upper("source").alias("name"))
    return rollout.placed(rollout.covered(docs.groupBy("source").agg(F.sum("n_chars").alias("bytes")), apart, "source"), "bytes", "source")


_WORD = "left(regexp_replace(text, '[^A-Za-z]', '', 'g'), 6)"
_SQL_LINES = rf"""WITH lines AS (SELECT conv_id, turn, CASE (turn * 3 + conv_id) % 8
  WHEN 0 THEN '  export WORKSPACE="' || {_WORD} || '\t\"' || turn || '\\n" # opens'
  WHEN 1 THEN 'CHANNEL_URL = https://' || {_WORD} || '.slack.com/#a  # note' WHEN 2 THEN 'SLACK_TOKEN=' || chr(39) || {_WORD} || '\n #x' || chr(39) || ' junk'
  WHEN 3 THEN 'SLACK_COOKIE="' || {_WORD} || '\"' WHEN 4 THEN 'just ' || {_WORD} WHEN 5 THEN 'WORKSPACE=' || {_WORD} || '=' || conv_id || '#1 '
  WHEN 6 THEN 'OTHER=' || {_WORD} ELSE '# ' || {_WORD} END AS line FROM conversations
), read AS (
  SELECT conv_id, turn, regexp_extract(trim(line), '^(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=', 1) AS key, trim(regexp_extract(trim(line), '^[^=]*=(.*)$', 1)) AS rest FROM lines WHERE trim(line) NOT LIKE '#%'
), valued AS (
  SELECT *, CASE left(rest, 1) WHEN '"' THEN regexp_extract(rest, '^"((?:[^"\\]|\\.)*)"', 0) WHEN chr(39) THEN regexp_extract(rest, '^''[^'']*''', 0) END AS closed FROM read
), judged AS (
  SELECT *, CASE WHEN key = '' THEN 'invalid assignment' WHEN closed = '' THEN 'unterminated value' WHEN trim(substr(rest, length(closed) + 1)) <> '' AND trim(substr(rest, length(closed) + 1)) NOT LIKE '#%' THEN 'text after value' END AS p,
    CASE WHEN closed IS NULL THEN trim(regexp_replace(rest, '\s+#.*$', '')) WHEN left(closed, 1) = chr(39) THEN substr(closed, 2, length(closed) - 2)
      ELSE array_to_string(list_transform(regexp_extract_all(substr(closed, 2, length(closed) - 2), '\\.|[^\\]+'), lambda x: CASE x WHEN '\n' THEN chr(10) WHEN '\t' THEN chr(9) WHEN '\r' THEN chr(13) ELSE CASE WHEN left(x, 1) = '\' THEN substr(x, 2) ELSE x END END), '') END AS v
  FROM valued WHERE key IN ('', 'WORKSPACE', 'CHANNEL_URL', 'SLACK_TOKEN', 'SLACK_COOKIE')
), placed AS (
  SELECT *, sum(CASE WHEN key = 'WORKSPACE' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS block FROM judged
)
SELECT conv_id, turn::INTEGER AS line_no, block, nullif(key, '') AS key, CASE WHEN p IS NULL THEN v END AS value,
  coalesce(p, CASE WHEN key <> '' AND block = 0 THEN 'before the first block' WHEN key <> '' AND row_number() OVER (PARTITION BY conv_id, block, key ORDER BY turn) > 1 THEN 'duplicate key' END) AS problem FROM placed"""


@query(_SQL_LINES)
def block_parse(spark, d):
    word = F.left(F.regexp_replace("text", "[^A-Za-z]", ""), F.lit(6))
    shapes = [
        ('  export WORKSPACE="', word, r"\t\"", F.col("turn").cast("string"), r'\\n" # opens'), ("CHANNEL_URL = https://", word, ".slack.com/#a  # note"), ("SLACK_TOKEN='", word, r"\n #x' junk"),
        ('SLACK_COOKIE="', word, r"\""), ("just ", word), ("WORKSPACE=", word, "=", F.col("conv_id").cast("string"), "#1 "), ("OTHER=", word), ("# ", word),
    ]
    each = F.array(*[F.concat(*[F.lit(x) if isinstance(x, str) else x for x in shape]) for shape in shapes])
    line = F.get(each, ((F.col("turn") * 3 + F.col("conv_id")) % 8).cast("int"))
    lines = table(spark, d, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").cast("int").alias("line_no"), line.alias("line"))
    return blocks.parse_lines(lines).withColumnRenamed("file", "conv_id")


@query("""SELECT user_id, greatest(0.0, epoch(max(ts)) - epoch(max(ts) FILTER (WHERE event_type = 'click')))::DOUBLE AS lag FROM events GROUP BY user_id""")
def source_lag(spark, d):
    secs = lambda c: F.unix_micros(c.cast("timestamp")).cast("double") / 1e6
    g = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("a"), F.max(F.when(F.col("event_type") == "click", F.col("ts"))).alias("b"))
    return g.select("user_id", S.lag_seconds(secs(F.col("a")), secs(F.col("b"))).alias("lag"))


_SQL_GAUGES = """WITH g AS (SELECT source, count(*) AS rows_inserted, count(quality) AS canonical_row_count, avg(n_chars)::DOUBLE AS run_duration_seconds, count(quality)::DOUBLE / 10000000.0::DOUBLE AS lock_wait_seconds, 1e13::DOUBLE * count(*)::DOUBLE AS archive_size_bytes FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)
"""
_GAUGES = ("rows_inserted", "canonical_row_count", "run_duration_seconds", "lock_wait_seconds", "archive_size_bytes")


@query(_SQL_GAUGES + " UNION ALL ".join(
    f"""SELECT {i}::INTEGER AS place, 'chatlake_{g}' AS metric, '# TYPE chatlake_{g} gauge' AS type, 'chatlake_{g}' || chr(123) || 'workspace="' || source || '"' || chr(125) || ' ' || format('{{:.15g}}', {g}::DOUBLE) AS line FROM g\n""" for i, g in enumerate(_GAUGES)
))
def metrics_text(spark, d):
    met = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").groupBy("source")
    n, labelled = F.count(F.lit(1)), F.count("quality")
    g = met.agg(n.alias("rows_inserted"), labelled.alias("canonical_row_count"), F.avg("n_chars").alias("run_duration_seconds"), (labelled.cast("double") / 1e7).alias("lock_wait_seconds"), (n.cast("double") * 1e13).alias("archive_size_bytes"))
    return metrics.exposition(g.withColumnRenamed("source", "workspace"), ["workspace"], list(_GAUGES), "chatlake")


@query("SELECT source FROM (SELECT DISTINCT source FROM documents EXCEPT SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)")
def stale_groups(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    active = docs.join(table(spark, d, "labels").filter("toxic = 1"), "doc_id", "left_semi").select("source")
    return merge.vanished(docs, active, ["source"])


# keys and sets -----------------------------------------------------------------------------------


@query("SELECT lower(p_brand || p_type) AS folded, count(DISTINCT p_partkey) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def case_folded_duplicates(spark, d):
    return newest.folded_duplicates(table(spark, d, "part"), F.concat("p_brand", "p_type"), "p_partkey")


@query("SELECT user_id, event_type FROM events WHERE value > 50 INTERSECT SELECT user_id, event_type FROM events WHERE value < 10")
def common_keys(spark, d):
    log = table(spark, d, "events")
    return merge.common_keys(log.filter("value > 50"), log.filter("value < 10"), ["user_id", "event_type"])


@query(f"""{_SQL_STATES} SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.event_type, n.event_type) AS event_type, o.value IS DISTINCT FROM n.value AS value_differs, o.version IS DISTINCT FROM n.version AS version_differs
FROM old o JOIN new n ON o.user_id = n.user_id AND o.event_type = n.event_type WHERE o.value IS DISTINCT FROM n.value OR o.version IS DISTINCT FROM n.version""")
def mismatched_keys(spark, d):
    old, new = _states(spark, d)
    return merge.mismatches(old, new, ["user_id", "event_type"], ["value", "version"])


@query(f"""{_SQL_STATES} SELECT count(*) = 0 AS equal FROM (SELECT * FROM (SELECT user_id, event_type FROM old EXCEPT SELECT user_id, event_type FROM new) UNION ALL SELECT * FROM (SELECT user_id, event_type FROM new EXCEPT SELECT user_id, event_type FROM old))""")
def key_sets_equal(spark, d):
    old, new = _states(spark, d)
    return merge.comparison(old, new, ["user_id", "event_type"], "value").select(((F.col("missing") == 0) & (F.col("extra") == 0)).alias("equal"))


@query("SELECT c_custkey, c_name FROM customer WHERE lower(c_name) = lower('CUSTOMER#000000007')")
def selected_workspace(spark, d):
    return blocks.select_workspace(table(spark, d, "customer").select("c_custkey", "c_name"), F.lit(" CUSTOMER#000000007 "), "c_name")


@query("SELECT s.* EXCLUDE (s_acctbal), n_name AS nation FROM supplier s JOIN nation ON s_nationkey = n_nationkey")
def star_projection(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    sup = table(spark, d, "supplier")
    return sup.join(nation, sup["s_nationkey"] == nation["n_nationkey"]).select(sup["*"], "nation").drop("s_acctbal")


@query("SELECT count(*) AS covered FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')")
def covered_files(spark, d):
    found = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return attachments.covered(table(spark, d, "orders"), found, ["o_orderkey"])


@query("SELECT max(event_id)::DOUBLE / 1000000.0::DOUBLE AS recency, (SELECT count(*) FROM events WHERE value < 1) AS waiting FROM events")
def source_recency(spark, d):
    return table(spark, d, "events").agg((F.max("event_id").cast("double") / 1e6).alias("recency"), F.count_if(F.col("value") < 1).alias("waiting"))


# payloads of every shape, walked element by element --------------------------------------------------

# Odd and even values of a message's members; a row takes one of each list by its turn and conversation.
_ODD = {
    "deleted": ("1", "0", '""', '"no"', "[]", "{}", "true", "false", "null", "0.0", '"0"', "[0]"),
    "edited": ("{}", '{"ts":"7.5"}', '"x"', "null", "[1]", '{"ts":8}', '{"by":"u"}'),
    "reply_count": ('"2"', "0", "3", '""', "null"),
    "files": (
        '[{"id":"F5","name":"x?.txt","mode":"hosted","mimetype":"text/plain","size":7},{"id":"b/d","name":"y"},{"id":"F6","name":"z","mode":"tombstone"},{"id":"F7","is_external":1}]', '[{"id":"F5","name":"x?.txt","size":8}]',
        '["bad",{"id":"F1","size":"12"}]', "null", '{"id":"F2"}', '[{"id":"F3","size":3.0,"name":"a, 1.5"},7,null,{"name":"no id"}]', "[]", '[{"size":"x","id":4}]'),
    "reactions": ('[1,{"name":"ok","users":["a","b","a"],"count":2}]', '"none"', '[{"name":"","users":["c"]},{"name":"up","users":["d"]}]', "[]", '[{"name":"odd","users":"e"},{"users":["f"]},{"name":"up","users":["g"],"count":"5"}]'),
}


def _odd_messages(spark: SparkSession, d: str) -> DataFrame:
    """``conversations`` as archive messages with payloads of every shape; each third one nests its members."""
    at = F.col("conv_id") * 7 + F.col("turn")
    body = F.concat(F.lit('{"text":'), F.to_json(F.struct(F.col("role"))), *[x for n, v in _ODD.items() for x in (F.lit(f',"{n}":'), F.get(F.array(*map(F.lit, v)), (at % len(v)).cast("int")))], F.lit("}"))
    whole = F.when(at % 3 == 0, F.concat(F.lit('{"message":'), body, F.lit("}"))).otherwise(body)
    ts = F.concat((F.col("conv_id") * 1000 + F.col("turn")).cast("string"), F.lit(".000100"))
    null = F.lit(None).cast("string")
    return table(spark, d, "conversations").select(
        F.concat(F.lit("C"), (F.col("conv_id") % 9).cast("string")).alias("CHANNEL_ID"), ts.alias("TS"), F.col("turn").alias("CHUNK_ID"), F.lit(0).alias("IDX"), F.col("conv_id").alias("rowid"), F.col("conv_id").alias("ID"),
        F.when(F.col("turn") % 5 < 4, F.concat((F.col("conv_id") * 1000).cast("string"), F.lit(".000100"))).alias("THREAD_TS"), null.alias("LATEST_REPLY"), F.lit(0).alias("IS_PARENT"), F.col("role").alias("TXT"), F.encode(whole, "UTF-8").alias("DATA"),
    )


def _sql_true(value: str) -> str:
    return f"""coalesce(CASE json_type({value}) WHEN 'NULL' THEN false WHEN 'BOOLEAN' THEN {value}::VARCHAR = 'true' WHEN 'VARCHAR' THEN {value}::VARCHAR <> '""'
      WHEN 'ARRAY' THEN json_array_length({value}) > 0 WHEN 'OBJECT' THEN len(json_keys({value})) > 0 ELSE {value}::VARCHAR::DOUBLE <> 0 END, false)"""


_SQL_PICKS = ", ".join(f"([{', '.join(chr(39) + x + chr(39) for x in v)}])[(conv_id * 7 + turn) % {len(v)} + 1]::JSON AS {n}" for n, v in _ODD.items())
_SQL_ODD = f"WITH m AS (SELECT 'C' || conv_id % 9 AS channel_id, (conv_id * 1000 + turn) || '.000100' AS ts, conv_id, turn, {_SQL_PICKS} FROM conversations)"


@query(f"""{_SQL_ODD}
SELECT channel_id, ts, {_sql_true("deleted")} AS is_deleted, json_type(edited) = 'OBJECT' AND {_sql_true("edited")} AS is_edited,
       CASE WHEN json_type(edited) = 'OBJECT' THEN edited->>'ts' END AS edited_ts, turn = 0 AND {_sql_true("reply_count")} AS is_thread_parent,
       CASE WHEN json_type(files) = 'ARRAY' AND json_array_length(files) > 0 THEN json_array_length(files) ELSE 0 END::INTEGER AS n_files
FROM m""")
def payload_flags(spark, d):
    """Truth of deleted, edited and reply_count, and files of any shape."""
    records = canonicalize.messages(_odd_messages(spark, d), F.lit("T1"))
    return records.select("channel_id", "ts", "is_deleted", "is_edited", "edited_ts", "is_thread_parent", F.coalesce(F.json_array_length("file_metadata_json"), F.lit(0)).alias("n_files"))


@query(f"""{_SQL_ODD}, f AS (
  SELECT channel_id, ts, unnest(from_json(files, '["JSON"]')) AS f FROM m WHERE json_type(files) = 'ARRAY')
SELECT channel_id, ts, f->>'id' AS file_id, try_cast(f->>'size' AS DOUBLE)::BIGINT AS size, f->>'name' AS name FROM f WHERE json_type(f) = 'OBJECT' AND f->>'id' <> ''""")
def payload_files(spark, d):
    """Each embedded file by itself; its odd neighbours drop out alone."""
    records = canonicalize.messages(_odd_messages(spark, d), F.lit("T1"))
    return records.select("channel_id", "ts", F.explode("embedded_files").alias("f")).select("channel_id", "ts", F.col("f.id").alias("file_id"), "f.size", "f.name")


@query(f"""{_SQL_ODD}, r AS (
  SELECT channel_id, ts, unnest(from_json(reactions, '["JSON"]')) AS r FROM m WHERE json_type(reactions) = 'ARRAY'
), u AS (
  SELECT channel_id, ts, r->>'name' AS emoji_name, unnest(from_json(r->'users', '["VARCHAR"]')) AS user_id, (r->>'count')::BIGINT AS reported_count
  FROM r WHERE json_type(r) = 'OBJECT' AND r->>'name' <> '' AND json_type(r->'users') = 'ARRAY')
SELECT DISTINCT channel_id, ts AS message_ts, emoji_name, user_id, reported_count FROM u""")
def payload_reactions(spark, d):
    """Each user's reaction once, whatever stands beside it."""
    return canonicalize.reactions(canonicalize.messages(_odd_messages(spark, d), F.lit("T1")))


# lineage as a tree ----------------------------------------------------------------------------------

_SQL_ROWS = "SELECT event_id // 100 AS chunk, sha256(to_json({chunk: event_id // 100, event_id: event_id, event_type: event_type, user_id: user_id})) AS h FROM events"
_SQL_SUMS = "count(*) AS rows, sha256(sum(('0x' || substr(h, 1, 7))::BIGINT)::VARCHAR || ':' || sum(('0x' || substr(h, 8, 7))::BIGINT)::VARCHAR || ':' || bit_xor(('0x' || substr(h, 15, 15))::BIGINT)::VARCHAR) AS digest"


def _observations(spark: SparkSession, d: str) -> DataFrame:
    return _log(spark, d).select("chunk", "event_id", "event_type", "user_id")


def _node(df: DataFrame) -> DataFrame:
    return df.select("range", "rows", lineage.shown(F.col("a"), F.col("b"), F.col("x")).alias("digest"))


@query(f"SELECT chunk // 4 AS range, {_SQL_SUMS} FROM ({_SQL_ROWS}) GROUP BY 1")
def range_digests(spark, d):
    """Additive digests of ranges of four chunks."""
    return _node(lineage.leaves(_observations(spark, d), "chunk", 4))


@query(" UNION ALL ".join(f"SELECT {k} AS level, chunk // {4 * 2**k} AS range, {_SQL_SUMS} FROM ({_SQL_ROWS}) GROUP BY 1, 2" for k in range(4)))
def lineage_tree(spark, d):
    """The leaves and three levels above, each added up from the one below."""
    nodes, out = lineage.leaves(_observations(spark, d), "chunk", 4), None
    for k in range(4):
        shown = _node(nodes).select(F.lit(k).alias("level"), "range", "rows", "digest")
        out, nodes = shown if out is None else out.unionByName(shown), lineage.above(nodes)
    return out


@query("SELECT DISTINCT event_id // 100 // 4 AS range FROM events WHERE event_id % 997 = 5")
def rewritten_ranges(spark, d):
    """The ranges of a log some of whose old rows were rewritten."""
    log = _observations(spark, d)
    other = log.withColumn("event_type", F.when(F.col("event_id") % 997 == 5, "rewritten").otherwise(F.col("event_type")))
    return lineage.rewritten(lineage.leaves(log, "chunk", 4), lineage.leaves(other, "chunk", 4))


_SQL_LEVELS = "".join(
    f""", n{k + 1} AS (SELECT doc_id, place // 4 AS place, CASE WHEN count(*) = 1 AND place // 4 = 0 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest
  FROM n{k} GROUP BY doc_id, place // 4)""" for k in range(5)
)


@query(f"""WITH n0 AS (SELECT doc_id, i AS place, sha256(substr(text, i * 1000 + 1, 1000)) AS digest
  FROM (SELECT doc_id, text, unnest(range(0, greatest(1, (length(text) + 999) // 1000))) AS i FROM documents)){_SQL_LEVELS}
SELECT doc_id, digest FROM n5""")
def tree_roots(spark, d):
    """The root over the hashes of each text's blocks, four to a node."""
    docs = table(spark, d, "documents")
    count = F.greatest(F.lit(1), F.ceil(F.length("text") / 1000)).cast("int")
    blocks_ = docs.select("doc_id", "text", F.explode(F.sequence(F.lit(0), count - 1)).alias("place"))
    hashed = blocks_.select("doc_id", "place", F.sha2(F.substr("text", F.col("place") * 1000 + 1, F.lit(1000)), 256).alias("digest"))
    return lineage.tree_root(hashed, "doc_id", "place", "digest", 4)


# lists and documents of bounded size -------------------------------------------------------------------


@query("""SELECT conv_id, (r - 1) // 3 AS page, count(*) AS message_count, min(turn) AS first_ts_us, max(turn) AS last_ts_us, string_agg(k, ',' ORDER BY turn, k) AS message_keys
FROM (SELECT conv_id, turn, k, row_number() OVER (PARTITION BY conv_id ORDER BY turn, k) AS r FROM (SELECT conv_id, turn, sha256(conv_id || chr(31) || turn) AS k FROM conversations)) GROUP BY ALL""")
def thread_pages(spark, d):
    """Threads in pages of three messages."""
    conv = table(spark, d, "conversations").select("conv_id", "turn", S.stable_key(F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("k"))
    return views.thread_pages(conv, ["conv_id"], "turn", "k", 3).withColumn("message_keys", F.array_join("message_keys", ","))


@query("""WITH wanted AS (SELECT l_orderkey || '-' || l_linenumber AS file_id, l_linestatus AS name, l_quantity::BIGINT AS size, CASE WHEN l_returnflag = 'R' THEN 'snippet' ELSE 'hosted' END AS mode FROM lineitem),
present AS (SELECT l_orderkey || '-' || l_linenumber AS file_id, l_linestatus AS name, (l_quantity + l_orderkey % 3)::BIGINT AS there, CASE WHEN l_orderkey % 50 = 0 THEN 'link' WHEN l_orderkey % 50 = 1 THEN 'outside' ELSE 'file' END AS kind FROM lineitem WHERE l_linenumber <> 4),
ok AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber AS file_id, (l_quantity + 1)::BIGINT AS accepted FROM lineitem WHERE l_returnflag = 'A'),
met AS (SELECT w.*, CASE WHEN kind = 'file' THEN there END AS served,
  CASE WHEN kind IS NULL THEN 'missing' WHEN kind <> 'file' THEN 'unsafe' WHEN size <= 0 OR there = size THEN 'match' WHEN mode = 'snippet' AND abs(there - size) <= 64 THEN 'snippet' WHEN accepted = there THEN 'documented' ELSE 'mismatch' END AS class
  FROM wanted w LEFT JOIN present USING (file_id, name) LEFT JOIN ok USING (file_id))
SELECT count(*) AS expected_count, count(served) AS present_count, count(*) FILTER (WHERE class = 'missing') AS missing_count, count(*) FILTER (WHERE class = 'mismatch') AS size_mismatch_count,
 sum(size)::BIGINT AS expected_bytes, sum(served)::BIGINT AS present_bytes, count(*) FILTER (WHERE class = 'snippet') AS snippet_variance_count, coalesce(sum(abs(served - size)) FILTER (WHERE class = 'snippet'), 0)::BIGINT AS snippet_variance_bytes,
 count(*) FILTER (WHERE class = 'documented') AS documented_variance_count, coalesce(sum(abs(served - size)) FILTER (WHERE class = 'documented'), 0)::BIGINT AS documented_variance_bytes,
 (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS skipped_count, count(*) FILTER (WHERE class = 'unsafe') + (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS unsafe_count,
 coalesce((SELECT string_agg(t, ',' ORDER BY file_id, t) FROM (SELECT file_id, file_id || '=' || served AS t FROM met WHERE class = 'documented' ORDER BY 1, 2 LIMIT 100)), '') AS documented_variance_files,
 coalesce((SELECT string_agg(t, ',' ORDER BY file_id, t) FROM (SELECT file_id, file_id || '/' || name || ' ' || size || ' ' || served AS t FROM met WHERE class = 'mismatch' ORDER BY 1, 2 LIMIT 100)), '') AS mismatched_files
FROM met""")
def attachment_report(spark, d):
    """The whole reconciliation: skipped and unsafe files too, and the first files that differ."""
    li = table(spark, d, "lineitem")
    file_id = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("file_id")
    wanted = li.select(file_id, F.col("l_linestatus").alias("name"), F.col("l_quantity").cast("long").alias("size"), F.when(F.col("l_returnflag") == "R", "snippet").otherwise("hosted").alias("mode"), F.lit("text/plain").alias("mime"))
    kind = F.when(F.col("l_orderkey") % 50 == 0, "link").when(F.col("l_orderkey") % 50 == 1, "outside").otherwise("file")
    present = li.filter("l_linenumber <> 4").select(file_id, F.col("l_linestatus").alias("name"), (F.col("l_quantity") + F.col("l_orderkey") % 3).cast("long").alias("served"), kind.alias("kind"))
    ok = li.filter("l_returnflag = 'A'").select(file_id, (F.col("l_quantity") + 1).cast("long").alias("accepted")).distinct()
    totals = table(spark, d, "orders").agg(F.count_if(F.col("o_orderstatus") == "O").alias("skipped"), F.count_if(F.col("o_orderstatus") == "P").alias("unsafe"))
    return attachments.report(attachments.reconciled(wanted, present, ok), totals)


def _sql_gauge(name: str, told: str, value: str) -> str:
    head = f"# HELP chatlake_{name} {told}".replace("'", "''")
    return f"""'{head}' || chr(10) || '# TYPE chatlake_{name} gauge' || chr(10) || 'chatlake_{name}{{workspace="' || s_name || '",stage="' || s_nationkey || '"}} ' || {value} || chr(10)"""


@query(f"""SELECT 'job@base64/' || b('chatlake') || '/workspace@base64/' || b(s_name) || '/stage@base64/' || b(s_nationkey::VARCHAR) AS path,
  {_sql_gauge("run_success", "Whether the last run succeeded.", "(s_nationkey % 2)")} || {_sql_gauge("pipeline_completed_timestamp_seconds", "When the pipeline completed.", "s_suppkey")} ||
  {_sql_gauge("pipeline_completion_lag_seconds", "Seconds between completion and observation.", "'5'")} ||
  CASE WHEN s_suppkey % 3 > 0 THEN {_sql_gauge("source_row_count", "Rows in the archive.", "s_suppkey * 2")} ELSE '' END ||
  {_sql_gauge("rows_inserted", "Rows inserted by the run.", "s_nationkey")} AS body FROM supplier""".replace("b('chatlake')", "'Y2hhdGxha2U='").replace("b(s_name)", "translate(to_base64(encode(s_name)), '+/', '-_')").replace("b(s_nationkey::VARCHAR)", "translate(to_base64(encode(s_nationkey::VARCHAR)), '+/', '-_')"))
def metric_documents(spark, d):
    """One exposition document for each workspace and stage."""
    null = F.lit(None).cast("double")
    runs = table(spark, d, "supplier").select(
        F.col("s_name").alias("workspace"), F.col("s_nationkey").cast("string").alias("stage"), (F.col("s_nationkey") % 2 == 1).alias("run_succeeded"), F.col("s_suppkey").cast("double").alias("pipeline_completed_at"), (F.col("s_suppkey") + 5).cast("double").alias("observed_at"),
        F.when(F.col("s_suppkey") % 3 > 0, F.col("s_suppkey") * 2).alias("source_row_count"), F.col("s_nationkey").alias("rows_inserted"),
        *[null.alias(c) for c in ("last_success_at", "source_latest_message_at", "canonical_latest_message_at", "canonical_row_count", "rows_updated", "rows_deleted", "run_duration_seconds", "run_failures", "lock_wait_seconds", "archive_size_bytes", "attachment_backlog", "workspace_discovered", "workspace_materialized")],
    )
    return metrics.documents(runs)


_SQL_EXPECTED = f"""{_SQL_ODD}, f AS (
  SELECT channel_id, conv_id * 1000 + turn AS pos, unnest(from_json(files, '["JSON"]')) AS f FROM m WHERE json_type(files) = 'ARRAY'
), i AS (
  SELECT channel_id, pos, f->>'id' AS file_id, coalesce(f->>'name', '') AS name, coalesce(f->>'mode', '') AS mode, coalesce(f->>'mimetype', '') AS mime,
         coalesce(try_cast(f->>'size' AS DOUBLE)::BIGINT, 0) AS size, json_exists(f, '$.is_external') AS external
  FROM f WHERE json_type(f) = 'OBJECT' AND f->>'id' <> ''
), marked AS (
  SELECT *, mode IN ('hidden_by_limit', 'external', 'tombstone') OR (NOT external AND name = '') AS skip, regexp_full_match(file_id, '[A-Za-z0-9_-]+') AS safe FROM i
), good AS (
  SELECT file_id, pos, channel_id, {{'name': regexp_replace(CASE WHEN name = '' THEN 'unnamed_file' ELSE name END, '[<>:"/\\\\\\\\|?*]', '_', 'g'), 'size': size, 'mode': mode, 'mime': mime}} AS r FROM marked WHERE NOT skip AND safe
), firsts AS (
  SELECT file_id, arg_min(r, {{'pos': pos, 'channel_id': channel_id, 'r': r}}) AS r FROM good GROUP BY file_id)"""


@query(f"{_SQL_EXPECTED} SELECT file_id, r.name AS name, r.size AS size, r.mode AS mode, r.mime AS mime FROM firsts")
def expected_attachments(spark, d):
    """The downloadable files that messages mention, the first record of each."""
    return attachments.expected(canonicalize.messages(_odd_messages(spark, d), F.lit("T1")))[0]


@query(f"""{_SQL_EXPECTED} SELECT (SELECT count(*) FROM marked WHERE skip) AS skipped,
  (SELECT count(*) FROM marked WHERE NOT skip AND NOT safe) + (SELECT count(*) FROM good JOIN firsts USING (file_id) WHERE good.r <> firsts.r) AS unsafe""")
def expected_totals(spark, d):
    """How many mentioned files are skipped, and how many unsafe or in conflict."""
    return attachments.expected(canonicalize.messages(_odd_messages(spark, d), F.lit("T1")))[1]


@query(f"""{_SQL_ODD}, k AS (
  SELECT channel_id, conv_id, turn, sha256('T1' || chr(31) || channel_id || chr(31) || ts) AS k, (conv_id * 1000 + turn) * 1000000 + 100 AS ts_us FROM m WHERE turn % 5 < 4)
SELECT channel_id, (conv_id * 1000) || '.000100' AS thread_ts, count(*) AS message_count, min(ts_us) AS first_ts_us, max(ts_us) AS last_ts_us, string_agg(k, ',' ORDER BY ts_us, k) AS message_keys FROM k GROUP BY ALL""")
def message_threads(spark, d):
    """The thread view over canonical messages; what stands in no thread is left out."""
    records = canonicalize.messages(_odd_messages(spark, d), F.lit("T1")).withColumn("workspace_id", F.lit("T1"))
    return views.message_threads(records).drop("workspace_id").withColumn("message_keys", F.array_join("message_keys", ","))


@query("""WITH s AS (SELECT o_custkey % 50 AS id, max(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END) AS finished FROM orders GROUP BY 1), top AS (SELECT id, finished FROM s ORDER BY id DESC LIMIT 1),
streams AS (SELECT o_orderkey % 3 AS kind, o_orderpriority, o_custkey // 50 % 2 AS apart FROM orders, top WHERE o_custkey % 50 = top.id AND o_orderkey % 3 IN (0, 1) GROUP BY ALL HAVING max(CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END) = 0)
SELECT (SELECT finished = 1 FROM top) AS finished, (SELECT count(*) FROM streams) AS incomplete""")
def session_completeness(spark, d):
    """Whether the latest session is finished, and how many of its streams lack a final chunk."""
    orders = table(spark, d, "orders")
    session = orders.groupBy((F.col("o_custkey") % 50).alias("ID")).agg(F.max(F.when(F.col("o_orderstatus") == "P", 0).otherwise(1)).alias("FINISHED"))
    chunk = orders.select((F.col("o_custkey") % 50).alias("SESSION_ID"), (F.col("o_orderkey") % 3).alias("TYPE_ID"), F.col("o_orderpriority").alias("CHANNEL_ID"), F.lit(None).cast("string").alias("SEARCH_QUERY"), F.expr("o_custkey div 50 % 2").alias("THREAD_ONLY"), (F.col("o_totalprice") > 300000).cast("int").alias("FINAL"))
    return proofs.completeness(session, chunk)


@query("""WITH e AS (SELECT s_suppkey, unnest([{k: 'mode', v: s_name}, {k: 'row_count', v: s_nationkey::VARCHAR}, {k: 'api_token', v: s_name}, {k: 'Workspace_id', v: 'x'}, {k: 'action', v: CASE WHEN s_nationkey % 2 = 0 THEN s_name END}]) AS e FROM supplier)
SELECT s_suppkey, e.k AS key, e.v AS value FROM e WHERE e.k IN ('mode', 'row_count', 'action') AND e.v IS NOT NULL""")
def shown_metadata(spark, d):
    """The keys of a run's result that may be shown."""
    name = F.col("s_name")
    result = F.create_map(*[x for k, v in (("mode", name), ("row_count", F.col("s_nationkey").cast("string")), ("api_token", name), ("Workspace_id", F.lit("x")), ("action", F.when(F.col("s_nationkey") % 2 == 0, name))) for x in (F.lit(k), v)])
    return table(spark, d, "supplier").select("s_suppkey", F.explode(metadata.shown(result)))


_SQL_EDGES = "[chr(160) || s, s || chr(12288), s || chr(28), chr(133) || s || chr(8232), s, s || chr(127), '/r/' || s, '/r/../' || s, '/r//' || s, '/rx/' || s]"


@query(rf"""SELECT page_id, trim(t, chr(9) || chr(10) || chr(28) || chr(32) || chr(133) || chr(160) || chr(8232) || chr(12288)) AS stripped, NOT regexp_matches(t, '[\x09-\x0d\x1c-\x20\x7f\x{{85}}\x{{a0}}\x{{2028}}\x{{3000}}]') AS secret_ok,
  starts_with(t, '/r/') AND t NOT LIKE '/r/../%' AND t NOT LIKE '/r//%' AS inside
FROM (SELECT page_id, ({_SQL_EDGES})[page_id % 10 + 1] AS t FROM (SELECT page_id, regexp_replace(split_part(url, '/', 3) || ' ' || page_id % 7, ' [0-3]$', '') AS s FROM pages))""")
def text_edges(spark, d):
    """White space of every kind at the edges, secrets with and without, paths in and out of a root."""
    s = F.regexp_replace(F.concat(F.split_part("url", F.lit("/"), F.lit(3)), F.lit(" "), (F.col("page_id") % 7).cast("string")), " [0-3]$", "")
    odd = [F.concat(F.lit("\u00a0"), s), F.concat(s, F.lit("\u3000")), F.concat(s, F.lit("\x1c")), F.concat(F.lit("\x85"), s, F.lit("\u2028")), s, F.concat(s, F.lit("\x7f"))] + [F.concat(F.lit(x), s) for x in ("/r/", "/r/../", "/r//", "/rx/")]
    t = F.get(F.array(*odd), (F.col("page_id") % 10).cast("int"))
    return table(spark, d, "pages").select("page_id", S.strip(t).alias("stripped"), S.secret_ok(t).alias("secret_ok"), S.inside(t, "/r").alias("inside"))


@query(f"""{_SQL_ODD}, own AS (
  SELECT 'F' || conv_id % 6 AS file_id, 'C' || conv_id % 9 AS channel_id, conv_id, row_number() OVER (PARTITION BY conv_id % 6 ORDER BY conv_id DESC) AS r FROM conversations WHERE turn = 1
), last AS (
  SELECT conv_id, max((conv_id * 1000 + turn) || '.000100') AS ts FROM conversations GROUP BY conv_id
), e AS (
  SELECT channel_id, ts, conv_id * 1000 + turn AS pos, turn, conv_id, unnest(from_json(files, '["JSON"]')) AS f FROM m WHERE json_type(files) = 'ARRAY'
), firsts AS (
  SELECT f->>'id' AS file_id, arg_min({{'channel_id': channel_id, 'ts': ts, 'thread_ts': CASE WHEN turn % 5 < 4 THEN conv_id * 1000 || '.000100' END, 'f': f, 'turn': turn}}, pos) AS x
  FROM e WHERE json_type(f) = 'OBJECT' AND f->>'id' <> '' GROUP BY 1
)
SELECT file_id, channel_id, coalesce(ts, '0.' || lpad(conv_id::VARCHAR, 6, '0')) AS message_ts, CASE WHEN conv_id % 2 = 0 THEN '0.' || lpad(conv_id::VARCHAR, 6, '0') END AS thread_ts, 'U' || conv_id AS user_id, 'hosted' AS mode, 'n' || conv_id AS filename,
  nullif(conv_id, 0) * 10 AS size_bytes, CASE WHEN conv_id % 3 = 0 THEN 'down' ELSE 'up' END AS source_url, 1::BIGINT AS source_chunk_id
FROM own LEFT JOIN last USING (conv_id) WHERE r = 1
UNION ALL
SELECT file_id, x.channel_id, x.ts, x.thread_ts, NULL, x.f->>'mode', x.f->>'name', try_cast(x.f->>'size' AS DOUBLE)::BIGINT, NULL, x.turn FROM firsts WHERE file_id NOT IN (SELECT file_id FROM own)""")
def file_records(spark, d):
    """File rows with their messages' times, then the files that only messages mention."""
    conv = table(spark, d, "conversations").filter("turn = 1")
    name = lambda x: F.concat(F.lit(x), F.col("conv_id").cast("string"))
    url = F.when(F.col("conv_id") % 3 == 0, "down")
    payload = F.to_json(F.struct(name("U").alias("user"), F.lit("hosted").alias("mode"), name("n").alias("name"), F.nullif(F.col("conv_id"), F.lit(0)).alias("n"), (F.nullif(F.col("conv_id"), F.lit(0)) * 10).alias("size"), url.alias("url_private_download"), F.lit("up").alias("url_private")))
    rows = conv.select(
        F.concat(F.lit("F"), (F.col("conv_id") % 6).cast("string")).alias("ID"), F.lit(1).cast("long").alias("CHUNK_ID"), F.lit(0).alias("IDX"), F.col("conv_id").alias("rowid"), F.concat(F.lit("C"), (F.col("conv_id") % 9).cast("string")).alias("CHANNEL_ID"), F.col("conv_id").alias("MESSAGE_ID"),
        F.when(F.col("conv_id") % 2 == 0, F.col("conv_id")).alias("THREAD_ID"), F.lit("").alias("MODE"), F.lit(None).cast("string").alias("FILENAME"), F.lit("").alias("URL"), F.lit(0).cast("long").alias("SIZE"), F.encode(payload, "UTF-8").alias("DATA"),
    )
    records = canonicalize.messages(_odd_messages(spark, d), F.lit("T1"))
    return canonicalize.files(rows, records).drop("mime_type", "raw_json")


@query("""WITH r AS (SELECT CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END AS workspace, s_nationkey::VARCHAR AS stage, s_suppkey FROM supplier)
SELECT workspace, stage, 'workspace is empty' AS problem FROM r WHERE workspace = '' UNION ALL SELECT workspace, stage, 'source_row_count is missing' FROM r WHERE s_suppkey % 5 = 0
UNION ALL SELECT workspace, stage, 'rows_inserted is negative or not finite' FROM r WHERE s_suppkey % 7 = 0 UNION ALL SELECT workspace, stage, 'observed_at precedes pipeline_completed_at' FROM r WHERE s_suppkey % 3 = 0""")
def metric_problems(spark, d):
    """Run records that must not be shown, and why."""
    key = F.col("s_suppkey")
    fine = ("canonical_row_count", "rows_updated", "rows_deleted", "run_failures", "archive_size_bytes", "attachment_backlog", "run_duration_seconds", "lock_wait_seconds")
    runs = table(spark, d, "supplier").select(
        F.when(key % 4 == 0, "").otherwise(F.col("s_name")).alias("workspace"), F.col("s_nationkey").cast("string").alias("stage"), F.when(key % 5 > 0, key).alias("source_row_count"), F.when(key % 7 == 0, float("-inf")).otherwise(F.lit(1.0)).alias("rows_inserted"),
        (key + 9).alias("pipeline_completed_at"), F.when(key % 3 == 0, key).otherwise(key + 9).alias("observed_at"), *[F.lit(None).cast("double").alias(c) for c in ("last_success_at", "source_latest_message_at", "canonical_latest_message_at")], *[F.lit(0).alias(c) for c in fine],
    )
    return metrics.problems(runs)
