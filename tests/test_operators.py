import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from chatlake.functions import scalars as S
from chatlake.operators import attachments, merge, metadata, metrics, newest, proofs, rollout
from chatlake.sources.blocks import LINE, parse_blocks, parse_lines, problems, select_workspace
from chatlake.sources.uploads import accepted_sizes, present_files
from chatlake.streaming.archive_stream import read_newest, stream_newest


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items())).select(column.alias("x")).first()["x"]


def test_scalars(spark):
    assert one(spark, S.ts_us(F.col("a")), a="17.5") == 17_500_000
    assert one(spark, S.ts_us(F.col("a")), a="17.1234567") == 17_123_456
    with pytest.raises(Exception, match="Invalid message timestamp"):
        one(spark, S.ts_us(F.col("a")), a="x.5")
    assert one(spark, S.id_to_ts(F.col("a")), a=5) == "0.000005"
    assert one(spark, S.id_to_ts(F.col("a")), a=1700000000000001) == "1700000000.000001"
    assert one(spark, S.stable_key(F.col("a"), F.lit("b")), a="ä") == hashlib.sha256("ä\x1fb".encode()).hexdigest()
    assert one(spark, S.stable_key(F.col("a"), F.lit(None).cast("string")), a="ä") is None
    assert one(spark, S.strip(F.col("a")), a=" \x1c  a b  \x85") == "a b"
    assert one(spark, S.slug(F.col("a")), a=" 9 Lives! ") == "workspace_9_lives"
    assert one(spark, S.safe_filename(F.col("a")), a="a?. ") == "a_" and one(spark, S.safe_filename(F.col("a")), a="a\tb\n") == "a\tb\n"
    assert one(spark, S.safe_filename(F.col("a")), a="con.txt") == "_con.txt"
    assert one(spark, S.safe_filename(F.col("a")), a="") == "unnamed_file"
    assert one(spark, S.redact(F.col("a"), ("ab", "abc")), a="abc xoxb-1-2 ab") == "[REDACTED] [REDACTED] [REDACTED]"
    assert one(spark, S.redact(F.col("a")), a="x=xoxb-ab_c.d/e\"rest XOXP-1 foxoxa-1 xoxe-q\\z") == 'x=[REDACTED]"rest XOXP-1 foxoxa-1 [REDACTED]\\z'
    said = {"dial tcp 1.2.3.4: no such host": "transient", "context deadline exceeded": "transient", "invalid_cookie": "authentication", "401 unauthorized": "other", "\x1b[1mINVALID_AUTH\x1b[0m": "authentication", "invalid_auth: unexpected EOF": "transient", "my_invalid_auth_x": "other"}
    assert {m: one(spark, S.failure_class(F.col("a")), a=m) for m in said} == said
    assert one(spark, S.failure_class(F.col("a"), F.lit("authentication")), a="odd") == "authentication"
    for x in (0.0, 1e-7, 12.5, 1 / 3, 1e15, 123456789012345.6, 1234567890123456.0, 1e-4, 0.00012345, -2.5e-9, 1.7e9, 100.0, 1e300):
        assert spark.range(1).select(S.number_text(F.lit(x)).alias("x")).first()["x"] == format(x, ".15g").replace("-0", "-0"), x
    assert [one(spark, S.secret_ok(F.col("a")), a=x) for x in ("abc", "a b", "a\u2003", "a\x7f")] == [True, False, False, False]
    assert [one(spark, S.inside(F.col("a"), "/r"), a=x) for x in ("/r/a/b", "/r/../b", "/rx/a", "/r/a/./b", "/r")] == [True, False, False, False, False]
    assert [one(spark, S.path_label(F.col("a")), a=x) for x in ("", "a?>b", "x" * 80)] == ["=", "YT8-Yg==", base64.urlsafe_b64encode(b"x" * 80).decode()]
    assert [one(spark, S.json_true(F.try_parse_json("a"), "$.x"), a=x) for x in ('{"x": true}', '{"x": 1}', '{"x": "n"}', '{"x": [0]}', '{"x": 0}', '{"x": ""}', '{"x": {}}', '{"x": null}', "{}")] == [True] * 4 + [False] * 5
    assert [one(spark, S.is_json_object(F.col("a")), a=x) for x in ("{}", "[1]", "x", "1")] == [True, False, False, False]
    assert one(spark, F.array_join(S.parsed_list(F.col("a")), "|"), a=" B,a,,b ") == "b|a"
    assert [one(spark, S.site_url_ok(F.col("a")), a=x) for x in ("https://x.slack.com/y", "http://x.slack.com", "https://u@x.slack.com", "https://x.slack.com:8/")] == [True, False, False, False]
    assert [one(spark, S.workspace_id_ok(F.col("a")), a=x) for x in ("ok", "", ".x", "a/b", " a", "a" * 65)] == [True] + [False] * 5


def test_scoped_newest_equals_full_on_random_logs(spark):
    rng = random.Random(3)
    log = [(rng.randrange(9), rng.randrange(4), i // 5, i) for i in range(300)]
    df = spark.createDataFrame(log, "k bigint, g bigint, chunk bigint, id bigint")
    order = [F.desc("chunk"), F.desc("id")]
    full = {(r["k"], r["g"]): r["id"] for r in newest.newest_rows(df, ["k", "g"], order).collect()}
    part = {(r["k"], r["g"]): r["id"] for r in newest.newest_for_touched(df, ["k", "g"], order, "chunk", 50).collect()}
    assert part == {x: full[x] for x in part} and set(part) == {(k, g) for k, g, c, _ in log if c > 50}


def test_merge_is_idempotent_and_keeps_first_values(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], "k bigint, v string, first bigint")
    new = spark.createDataFrame([(2, "c", 20), (3, "d", 20)], "k bigint, v string, first bigint")
    once = merge.merge(old, new, ["k"], keep_old=["first"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 10), (2, "c", 10), (3, "d", 20)]
    assert sorted(map(tuple, merge.merge(once, new, ["k"], keep_old=["first"]).collect())) == sorted(map(tuple, once.collect()))
    assert [r["change"] for r in merge.classify(new, once, ["k"], "v").collect()] == ["unchanged"] * 2


def test_digest_ignores_order_but_not_repeats(spark):
    digest = lambda rows: proofs.table_digest(spark.createDataFrame(rows, "a bigint, b string"), "t").first()["digest"]
    rows = [(1, "x"), (2, None), (2, None)]
    assert digest(rows) == digest(rows[::-1]) != digest(rows[:2])
    assert digest([(1, None)]) != digest([(None, "1")])


def test_attachment_reconciliation(spark, tmp_path):
    item = "id string, user string, mode string, name string, mimetype string, size bigint, url_private_download string, url_private string, is_external boolean"
    rows = [("f1", "a?.txt", "hosted", "text/plain", 4), ("f2", "s", "snippet", "text/plain", 10), ("f3", "i", "hosted", "image/png", 10), ("f4", "d", "hosted", "text/plain", 9), ("f5", "m", "hosted", "", 1), ("bad/id", "x", "hosted", "", 1), ("f7", None, "tombstone", "", 1)]
    files = spark.createDataFrame([(i, "c", [(f, "u", mode, name, mime, size, None, None, False)]) for i, (f, name, mode, mime, size) in enumerate(rows)], f"ts_us bigint, channel_id string, embedded_files array<struct<{', '.join(x.replace(' ', ':') for x in item.split(', '))}>>")
    wanted, totals = attachments.expected(files)
    assert totals.first().asDict() == {"skipped": 1, "unsafe": 1}
    for f, name, size in (("f1", "a_.txt", 4), ("f2", "s", 7), ("f3", "i", 7), ("f4", "d", 6)):
        (tmp_path / f).mkdir()
        (tmp_path / f / name).write_bytes(b"x" * size)
    done = attachments.reconciled(wanted, present_files(spark, str(tmp_path)), accepted_sizes(spark, "f4=6"))
    assert {r["file_id"]: r["class"] for r in done.collect()} == {"f1": "match", "f2": "snippet", "f3": "mismatch", "f4": "documented", "f5": "missing"}
    report = attachments.report(done).first()
    assert (report["expected_count"], report["present_count"], report["snippet_variance_bytes"], report["documented_variance_files"]) == (5, 4, 3, "f4=6")
    with pytest.raises(ValueError):
        accepted_sizes(spark, "f4=x")


def lines(spark, text):
    return spark.createDataFrame([("f", i, x) for i, x in enumerate(text)], LINE)


BLOCK = ["CHANNEL_URL=https://one.slack.com/x", "SLACK_TOKEN=s3cret", "SLACK_COOKIE='c'"]


def test_blocks(spark):
    text = ["IGNORED=1", 'export  WORKSPACE = "a\\"b"  # first', BLOCK[0] + "  # note", "SLACK_TOKEN='s3#cret'", BLOCK[2], "# note", "  ", "WORKSPACE=two#2", BLOCK[0], "SLACK_TOKEN=zzz=1", BLOCK[2]]
    rows = parse_blocks(lines(spark, text)).collect()
    got = {(r["block"], r["key"]): r["value"] for r in rows}
    assert got[1, "WORKSPACE"] == 'a"b' and got[2, "WORKSPACE"] == "two#2" and got[1, "CHANNEL_URL"] == "https://one.slack.com/x" and len(got) == 8
    assert got[1, "SLACK_TOKEN"] == "sha256:" + hashlib.sha256(b"s3#cret").hexdigest()
    escaped = parse_lines(lines(spark, ['WORKSPACE="a\\\\n\\t\\"b"'])).first()
    assert escaped["value"] == 'a\\n\t"b' and escaped["problem"] is None


@pytest.mark.parametrize(
    ("text", "says"),
    [
        (['WORKSPACE="x'], "unterminated value"), (['WORKSPACE="x\\"'], "unterminated value"), (['WORKSPACE="v" junk'], "text after value"), (["WORKSPACE=a", "WORKSPACE"], "invalid assignment"),
        (["SLACK_TOKEN=a", "WORKSPACE=b"], "before the first block"), (["WORKSPACE=a", "SLACK_TOKEN=a", "SLACK_TOKEN=b"], "duplicate key"),
    ],
)
def test_bad_lines_are_refused(spark, text, says):
    with pytest.raises(Exception, match=" of f"):
        parse_blocks(lines(spark, text)).collect()
    assert says in {r["problem"] for r in problems(lines(spark, text)).collect()}


@pytest.mark.parametrize(
    ("block", "bad"),
    [
        (["WORKSPACE=One", *BLOCK], set()), (["WORKSPACE=One", *BLOCK[:2]], {("SLACK_COOKIE", "missing")}), (["WORKSPACE=..", *BLOCK], {("WORKSPACE", "invalid workspace")}), (["WORKSPACE=a/b", *BLOCK], {("WORKSPACE", "invalid workspace")}),
        (["WORKSPACE=One", "CHANNEL_URL=https://evil.example", *BLOCK[1:]], {("CHANNEL_URL", "invalid address")}), (["WORKSPACE=One", BLOCK[0], "SLACK_TOKEN=a value", BLOCK[2]], {("SLACK_TOKEN", "white space in a secret")}),
        (["WORKSPACE=One", *BLOCK, "WORKSPACE=oNE", *BLOCK], {("WORKSPACE", "duplicate workspace")}),
    ],
)
def test_blocks_are_judged(spark, block, bad):
    assert {(r["key"], r["problem"]) for r in problems(lines(spark, block)).collect()} == bad


def test_a_workspace_is_selected_in_any_case(spark):
    known = spark.createDataFrame([("Alpha", 1), ("beta", 2), ("BETA", 3)], "workspace_id string, n int")
    assert [r["n"] for r in select_workspace(known, F.lit(" ALPHA ")).collect()] == [1]
    for wanted, says in (("gamma", "no workspace"), ("Beta", "ambiguous: BETA, beta")):
        with pytest.raises(Exception, match=says):
            select_workspace(known, F.lit(wanted)).collect()


def test_numbers_are_rounded_once(spark):
    ties = [123456789012.3125, 123456789012.4375, 7065238185058165.0, 450.8850169177825]
    values = [40 / 9, 353151.9059282925, *ties, *[-x for x in ties], 999999999999999.5, 9.9999999999999995e-5, -0.0, 5e-324, 2e23, float("nan"), float("inf"), float("-inf")]
    rows = spark.createDataFrame([*enumerate(values), (len(values), None)], "i int, x double")
    assert [r["t"] for r in rows.select("i", S.number_text(F.col("x")).alias("t")).orderBy("i").collect()] == [*(format(x, ".15g") for x in values), None]


def test_metric_lines(spark):
    rows = spark.createDataFrame([('a"b', 1.5, None)], "w string, x double, y double")
    assert [(r["type"], r["line"]) for r in metrics.exposition(rows, ["w"], ["x", "y"], "p").collect()] == [("# TYPE p_x gauge", 'p_x{w="a\\"b"} 1.5')]


def test_all_gauges_of_a_run(spark):
    run = {
        "workspace": "den", "stage": "merge", "run_succeeded": True, "last_success_at": 1650000000.0, "pipeline_completed_at": 1650000000.0, "observed_at": 1650000007.25, "source_latest_message_at": 1649999900.0, "canonical_latest_message_at": 1649999897.0,
        "source_row_count": 31, "canonical_row_count": 30, "rows_inserted": 2, "rows_updated": 1, "rows_deleted": 0, "run_duration_seconds": 4.75, "run_failures": 0, "lock_wait_seconds": 1e-7, "archive_size_bytes": 2048, "attachment_backlog": 6, "workspace_discovered": True, "workspace_materialized": False,
    }
    got = metrics.render(spark.createDataFrame([tuple(run.values())], list(run))).orderBy("place").collect()
    assert [r["metric"] for r in got] == [f"chatlake_{g}" for g in metrics.GAUGES]
    assert [r["line"].split("} ")[1] for r in got] == ["1", "1650000000", "1650000000", "7.25", "1649999900", "1649999897", "3", "31", "30", "2", "1", "0", "4.75", "0", "1e-07", "2048", "6", "1", "0"]


def test_run_records_are_judged(spark):
    names = "workspace string, stage string, " + ", ".join(f"{c} double" for c in ("pipeline_completed_at", "observed_at", "last_success_at", "source_latest_message_at", "canonical_latest_message_at", "source_row_count", "canonical_row_count", "rows_inserted", "rows_updated", "rows_deleted", "run_failures", "archive_size_bytes", "attachment_backlog", "run_duration_seconds", "lock_wait_seconds"))
    good = ["a", "b", 5.0, 6.0, None, None, None, *[0.0] * 10]
    bad = ["a\x00", "", 5.0, 4.0, float("nan"), -1.0, float("inf"), -1.0, None, *[0.0] * 8]
    assert metrics.problems(spark.createDataFrame([tuple(good)], names)).count() == 0
    assert metrics.problems(spark.createDataFrame([tuple(bad)], names)).count() == 8


def test_a_rollout_leaves_some_apart_but_never_all(spark):
    known = spark.createDataFrame([("Night Owls", 9), ("b", None), ("c", 3)], "workspace_id string, bytes int")
    apart = lambda *x: spark.createDataFrame([(i,) for i in x], "name string")
    order = lambda *x: [r["workspace_id"] for r in rollout.placed(rollout.covered(known, apart(*x)), "bytes", "workspace_id").orderBy("place").collect()]
    assert order("night_owls", "typo") == ["c", "b"] and order("NIGHT OWLS", "B", "c") == order() == ["c", "Night Owls", "b"]


def test_only_known_metadata_is_shown(spark):
    got = spark.createDataFrame([({"mode": "x", "row_count": "3", "api_token": "t", "other": "o", "action": None},)], "m map<string,string>").select(metadata.shown(F.col("m")).alias("m")).first()["m"]
    assert got == {"mode": "x", "row_count": "3"}


def test_stream_keeps_the_newest_rows(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    schema = "k bigint, chunk bigint, v string"
    for part in ([(1, 1, "a"), (2, 1, "b")], [(1, 3, "d"), (2, 0, "late")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        rows = spark.readStream.schema(schema).parquet(source)
        stream_newest(spark, rows, ["k"], [F.desc("chunk")], state, str(tmp_path / "ck")).awaitTermination(120)
    assert sorted((r["k"], r["v"]) for r in read_newest(spark, state).collect()) == [(1, "d"), (2, "b")]
    spark.createDataFrame([(3, 4, "e")], schema).coalesce(1).write.mode("append").parquet(source)
    stream_newest(spark, spark.readStream.schema(schema).parquet(source), ["k"], [F.desc("chunk")], state, str(tmp_path / "ck")).awaitTermination(120)
    assert read_newest(spark, state).count() == 3
