"""What a run reads and writes: fingerprints, scoped scans, lineage ranges, the stream, the log, listings and documents."""

import json
import os
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from chatlake.functions import payloads as P
from chatlake.functions import scalars as S
from chatlake.operators import attachments, canonicalize, lineage, metrics, newest, views
from chatlake.plans import files as H
from chatlake.plans import ingest as I
from chatlake.plans import lake as L
from chatlake.sources import metric_groups, sqlite_archive
from chatlake.sources.archive_stream import StreamReader, stream_archive
from chatlake.sources.blocks import LINE, parse_blocks, select_workspace
from chatlake.sources.file_digest import block_digests, file_fingerprint
from chatlake.sources.sqlite_archive import Reader, read_archive
from chatlake.sources.uploads import present_files
from chatlake.streaming import archive_stream
from tests import archive as A


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "a.sqlite"), str(tmp_path / "lake")


def message(db, chunk, ts, channel="C_GARDEN", **payload):
    A.insert(db, "MESSAGE", ID=A.id_of(ts), CHUNK_ID=chunk, CHANNEL_ID=channel, TS=ts, THREAD_TS=None, IS_PARENT=0, IDX=0, NUM_FILES=0, TXT=payload.pop("txt", None), DATA=A.blob(**payload))


def close_session(db, chunk, session):
    A.insert(db, "SESSION", ID=session, FINISHED=1)
    A.insert(db, "CHUNK", ID=chunk, SESSION_ID=session, TYPE_ID=0, FINAL=1, CHANNEL_ID="C_GARDEN")
    db.commit()


# payloads -------------------------------------------------------------------------------------------


def test_odd_elements_lose_themselves_alone(spark, place):
    path, lake = place
    db = A.fixture_a(path)
    message(
        db, 13, "1651000230.000100", text="x", deleted=1, edited={}, reply_count="2", thread_ts="1651000230.000100", user="U_ROSE",
        files=["bad", {"id": "F9", "size": "12", "name": "n", "share": 3.0, "a": [1.5, "q 2.0"]}, 7, None, {"name": "no id"}], reactions=[1, {"name": "up", "users": ["U_ROSE", "U2"], "count": 2}, {"name": ""}],
    )
    message(db, 13, "1651000231.000100", text="y", deleted=0, edited={"ts": "5.1"}, reply_count=0, files={"id": "F8"}, reactions="none", message="not an object")
    message(db, 13, "1651000232.000100", message={"text": "inner", "user": "U2", "files": [{"id": "F7", "size": 4}], "deleted": ""}, subtype="message_changed", deleted_ts=0)
    db.commit()
    I.ingest(spark, path, lake, "alpha")
    got = {r["ts"]: r for r in L.read(spark, lake, "messages").collect()}
    a, b, c = (got[f"165100023{i}.000100"] for i in range(3))
    assert a["is_deleted"] and not a["is_edited"] and a["is_thread_parent"] and a["edited_ts"] is None
    assert a["file_metadata_json"] == '["bad",{"a":[1.5,"q 2.0"],"id":"F9","name":"n","share":3.0,"size":"12"},7,null,{"name":"no id"}]'
    assert not b["is_deleted"] and b["is_edited"] and b["edited_ts"] == "5.1" and b["file_metadata_json"] is None and not b["is_thread_parent"]
    assert c["text"] == "inner" and c["user_id"] == "U2" and c["is_edited"] and not c["is_deleted"]
    files = {r["file_id"]: r for r in L.read(spark, lake, "files").collect()}
    assert set(files) == {"F_PLAN", "F9", "F7"} and files["F9"]["size_bytes"] == 12
    assert files["F9"]["raw_json"] == '{"a":[1.5,"q 2.0"],"id":"F9","name":"n","share":3.0,"size":"12"}'
    reactions = {(r["message_ts"], r["emoji_name"], r["user_id"], r["reported_count"]) for r in L.read(spark, lake, "reactions").collect()}
    assert {x for x in reactions if x[0] == a["ts"]} == {(a["ts"], "up", "U_ROSE", 2), (a["ts"], "up", "U2", 2)} and not any(x[0] == b["ts"] for x in reactions)


def test_sorted_json_equals_the_standard_library(spark):
    values = [{"b": 3.0, "a": {"z": [], "y": None}}, {"s": 'quote " comma, 1.5]', "é": "ü\n\\"}, {"n": [1, -2.25, 0.5, True]}, {}]
    rows = spark.createDataFrame([(json.dumps(v),) for v in values], "j string").select(P.sorted_json(F.col("j"))).collect()
    assert [r[0] for r in rows] == [json.dumps(v, ensure_ascii=False, separators=(",", ":"), sort_keys=True) for v in values]


# fingerprints and lineage -----------------------------------------------------------------------------


def test_file_fingerprint_sees_every_byte(spark, tmp_path):
    path = tmp_path / "f"
    data = bytearray(os.urandom(300_000))
    path.write_bytes(data)
    before, blocks = file_fingerprint(spark, str(path), 1000), {r["block"]: r["digest"] for r in block_digests(spark, str(path), 1000).collect()}
    assert len(blocks) == 300 and file_fingerprint(spark, str(path), 1000) == before
    data[123_456] ^= 1
    path.write_bytes(data)
    after = {r["block"]: r["digest"] for r in block_digests(spark, str(path), 1000).collect()}
    assert file_fingerprint(spark, str(path), 1000) != before and [i for i in blocks if blocks[i] != after[i]] == [123]
    path.write_bytes(b"")
    assert file_fingerprint(spark, str(path), 1000) != before


def test_an_unchanged_archive_starts_no_table_scan(spark, place, monkeypatch):
    path, lake = place
    A.fixture_a(path)
    I.ingest(spark, path, lake, "alpha")
    refuse = lambda *a, **k: pytest.fail("a table was opened")
    monkeypatch.setattr(I, "open_archive", refuse)
    monkeypatch.setattr(I, "read_archive", refuse)
    again = I.ingest(spark, path, lake, "alpha")
    assert again.fast and again.unchanged == 3
    assert L.runs(spark, lake).filter("status = 'succeeded'").agg(F.min("source_message_rows"), F.max("source_message_rows")).first()[:] == (4, 4)


def test_lineage_grows_by_new_rows_and_names_rewritten_chunks(spark, place):
    path, lake = place
    db = A.fixture_a(path)
    for i in range(14, 40):
        message(db, i, f"1651001{i:03d}.000100", text=f"m{i}")
    close_session(db, 39, 2)
    I.ingest(spark, path, lake, "alpha")
    for i in range(40, 60):
        message(db, i, f"1651001{i:03d}.000100", text=f"m{i}")
    close_session(db, 600, 3)  # widens the ranges
    assert I.ingest(spark, path, lake, "alpha").inserted == 20
    point = L.read(spark, lake, "ingestion_checkpoints").first()
    tables, _ = I.open_archive(spark, path)
    assert I.stored_lineage(point) == I.lineage_of(tables, 600) and I.rows_in(I.stored_lineage(point))["MESSAGE"] == 50
    assert I.rewritten_chunks(tables, point) == {}
    I.close(tables)
    db.execute("UPDATE MESSAGE SET TXT = 'changed behind the key' WHERE CHUNK_ID = 21")
    message(db, 601, "1651002000.000100", text="new")
    close_session(db, 601, 4)
    with pytest.raises(I.ContinuityError, match=r"rewrote MESSAGE in chunks 20 to 23"):
        I.ingest(spark, path, lake, "alpha", prove=True)
    assert I.ingest(spark, path, lake, "alpha").inserted == 1  # unproven, as asked


def test_differing_ranges_by_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        a = [(i, rng.randint(1, 3), rng.randint(0, 9), 1, i) for i in sorted(rng.sample(range(40), rng.randint(0, 20)))]
        b = [x if rng.random() < 0.8 else (x[0], x[1] + 1, *x[2:]) for x in a if rng.random() < 0.95]
        x, y = {i[0]: i for i in a}, {i[0]: i for i in b}
        assert lineage.differing(a, b, 4) == [(i * 4, i * 4 + 3) for i in sorted(x.keys() | y.keys()) if x.get(i) != y.get(i)]


def test_rebase_moves_the_marks(spark, place):
    path, lake = place
    db = A.fixture_a(path)
    I.ingest(spark, path, lake, "alpha")
    db.execute("DELETE FROM MESSAGE WHERE CHUNK_ID = 10")
    close_session(db, 99, 7)
    I.rebase(spark, path, lake)
    point = L.read(spark, lake, "ingestion_checkpoints").first()
    assert (point["session_high_water"], point["chunk_high_water"]) == (7, 99)
    assert I.validate(spark, path, lake)["passed"] and I.ingest(spark, path, lake, "alpha").fast


# scoped scans -----------------------------------------------------------------------------------------


def test_key_filter_and_chunks_are_pushed_into_the_scan(spark, place):
    path, _ = place
    db = A.fixture_a(path)
    for i in range(2000):
        message(db, 14, f"165200{i:04d}.000100", text="m" * 50)
    close_session(db, 14, 2)
    keys = spark.createDataFrame([("C_GARDEN", f"165200{i:04d}.000100") for i in range(0, 2000, 400)], "CHANNEL_ID string, TS string")
    assert sorted(r["TS"] for r in read_archive(spark, path, "MESSAGE", keys=keys).collect()) == sorted(r["TS"] for r in keys.collect())
    source = sqlite_archive.SQLiteArchive({"path": path, "table": "MESSAGE"})
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(source.schema())
    reader = Reader(path, "MESSAGE", schema, None, sqlite_archive.wanted(keys), ("CHANNEL_ID", "TS"))
    assert 5 <= sum(1 for p in reader.partitions() for _ in reader.read(p)) <= 15
    from pyspark.sql.datasource import GreaterThan

    reader = Reader(path, "MESSAGE", schema, None)
    assert list(reader.pushFilters([GreaterThan(("CHUNK_ID",), 12)])) == [] and reader.where == [('"CHUNK_ID" > ?', 12)]
    assert sum(1 for p in reader.partitions() for _ in reader.read(p)) == 2001
    assert read_archive(spark, path, "MESSAGE", columns=["TS", "CHUNK_ID"]).columns == ["CHUNK_ID", "TS", "rowid"]


def test_scoped_runs_give_the_full_reads_rows(spark, place, tmp_path):
    rng = random.Random(6)
    path, lake = place
    db, chunk = A.fixture_a(path), 14
    for run in range(3):
        for _ in range(25):
            channel, i = f"C{rng.randint(1, 4)}", rng.randint(0, 30)
            message(db, chunk, f"16530000{i:02d}.000100", channel, text=f"v{rng.randint(0, 3)}", deleted=rng.choice([0, 1]), files=[{"id": f"F{rng.randint(0, 9)}"}, 3], reactions=[{"name": rng.choice("ab"), "users": ["u"]}, None])
            chunk += 1
        close_session(db, chunk, run + 2)
        chunk += 1
        I.ingest(spark, path, lake, "alpha")
    whole = str(tmp_path / "whole")
    I.ingest(spark, path, whole, "alpha")
    for table in ("messages", "reactions", "channels", "users", "channel_members"):
        columns = [c for c in L.read(spark, lake, table).columns if c not in ("latest_run_id", "first_observed_at", "last_changed_at", "last_observed_at", "first_observed_run_id", "last_observed_run_id")]
        a, b = (sorted(map(str, L.read(spark, x, table).select(columns).collect())) for x in (lake, whole))
        assert a and a == b


# the stream ---------------------------------------------------------------------------------------------


def test_stream_restarts_and_replays_to_the_batch_result(spark, place, tmp_path):
    path, _ = place
    db, order = A.fixture_a(path), canonicalize.newest_order()
    state, ck = str(tmp_path / "state"), str(tmp_path / "ck")
    seen: list[tuple[int, int]] = []

    def run():
        rows = stream_archive(spark, path, "MESSAGE", 2)
        archive_stream.stream_newest(spark, rows, ["CHANNEL_ID", "TS"], order, state, ck, on_batch=lambda b, n: seen.append((n, b.count()))).awaitTermination(120)

    def whole():
        return sorted(map(str, newest.newest_rows(read_archive(spark, path, "MESSAGE"), ["CHANNEL_ID", "TS"], order).collect()))

    run()
    assert sorted(map(str, archive_stream.read_newest(spark, state).collect())) == whole() and seen == [(0, 4)]
    message(db, 20, A.PARENT, text="edited again")
    message(db, 21, A.LATER, text="new")
    close_session(db, 21, 2)
    run()
    assert seen[1:] == [(1, 2)] and sorted(map(str, archive_stream.read_newest(spark, state).collect())) == whole()
    before = sorted(os.listdir(state))
    batch = read_archive(spark, path, "MESSAGE").filter("CHUNK_ID > 13")
    assert not archive_stream.merge_batch(batch, 1, ["CHANNEL_ID", "TS"], order, state, batch.schema, archive_stream.BUCKETS)
    assert sorted(os.listdir(state)) == before and sorted(map(str, archive_stream.read_newest(spark, state).collect())) == whole()
    reader = StreamReader(path, "MESSAGE", batch.schema, 1)
    assert reader.initialOffset() == {"chunk": -1} and reader.latestOffset() == {"chunk": 21}
    replay = [len(list(reader.read(p))) for p in reader.partitions({"chunk": 13}, {"chunk": 21})]
    assert replay == [1, 1] and sum(len(list(reader.read(p))) for p in reader.partitions({"chunk": 21}, {"chunk": 21})) == 0


def test_a_batch_writes_its_buckets_alone(spark, tmp_path):
    state = str(tmp_path / "s")
    rows = spark.range(2000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    apply = lambda df, n: archive_stream.merge_batch(df, n, ["k"], [F.desc("v")], state, rows.schema, 16)
    folders = lambda: archive_stream.entry(spark, list(archive_stream.applied(spark, state).values())[-1])[0]
    assert apply(rows, 0)
    first = folders()
    assert apply(rows.limit(1).select("k", F.lit(1).alias("v")), 1)
    second = folders()
    assert len(first) == 16 and sum(first[b] != second[b] for b in first) == 1
    assert apply(rows.limit(0), 2) and folders() == second  # nothing arrived
    assert apply(rows.limit(1).select("k", F.lit(2).alias("v")), 3)
    got = archive_stream.read_newest(spark, state)
    assert got.count() == 2000 and got.agg(F.sum("v")).first()[0] == 2
    size = lambda n: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{state}/batch={n}") for f in fs)
    assert size(3) < size(0) / 4
    changed = next(b for b in first if first[b] != second[b])
    assert os.path.exists(f"{state}/{second[changed]}")  # for readers of the state before
    assert apply(rows.limit(0), 4) and not os.path.exists(f"{state}/{second[changed]}") and os.path.exists(f"{state}/batch=3")


# the log ------------------------------------------------------------------------------------------------


def test_reads_stay_bounded_and_vacuum_breaks_no_reader(spark, tmp_path, monkeypatch):
    from chatlake import schemas

    lake = str(tmp_path / "lake")
    monkeypatch.setattr(L, "SNAPSHOT_EVERY", 8)
    monkeypatch.setattr(L, "TIER", 4)
    schema = schemas.struct(schemas.LAKE_DDL["ingestion_runs"])
    spaces = schemas.struct(schemas.LAKE_DDL["workspaces"])
    for n in range(43):
        run = spark.createDataFrame([tuple(f"r{n}" if f.name == "run_id" else None for f in schema.fields)], schema)
        space = spark.createDataFrame([tuple(f"w{n}" if f.name == "team_name" else None for f in spaces.fields)], spaces)
        L.publish(spark, lake, "T1", f"run{n}", {"workspaces": space}, {"ingestion_runs": run})
        if n == 40:
            reader = L.read(spark, lake, "workspaces")
    opened: list[str] = []
    real = H.read_text
    monkeypatch.setattr(L, "read_text", lambda s, p: opened.append(p) or real(s, p))
    held = L.state(spark, lake, "T1")
    assert held["seq"] == 43 and len(opened) <= 1 + 8 and len(held["appended"]["ingestion_runs"]) <= 4 + 8 + 4
    assert sorted(r[0] for r in L.read(spark, lake, "ingestion_runs").select("run_id").collect()) == sorted(f"r{n}" for n in range(43))
    assert L.vacuum(spark, lake) == []  # all within the retention
    commits = L.numbered(spark, lake, "_commits", "T1")
    gone = L.vacuum(spark, lake, 0, commits[42].modified + 0.0005)
    assert "workspaces/T1/run3/done" in gone and "workspaces/T1/run42/done" not in gone
    assert L.read(spark, lake, "workspaces").first()["team_name"] == "w42" and L.read(spark, lake, "ingestion_runs").count() == 43
    assert min(L.numbered(spark, lake, "_commits", "T1")) > 30 and L.publish(spark, lake, "T1", "next", {}, {}) == 44
    late = L.vacuum(spark, lake, 0, commits[41].modified + 0.0005)
    assert not [g for g in late if "run40" in g] and reader.schema == spaces


# listings, blocks and documents -----------------------------------------------------------------------------


def test_listing_tells_links_and_what_leads_outside(spark, tmp_path):
    root = tmp_path / "archive" / "uploads"
    for f in ("f1", "f2", "f3"):
        (root / f).mkdir(parents=True)
        (root / f / "a.txt").write_bytes(b"12345")
    (tmp_path / "far").mkdir()
    (tmp_path / "far" / "a.txt").write_bytes(b"1")
    (root / "f2" / "b.txt").symlink_to(root / "f1" / "a.txt")
    (root / "f4").symlink_to(tmp_path / "far", target_is_directory=True)
    (root / "f3" / "deep").mkdir()
    rows = {(r["file_id"], r["name"]): r for r in present_files(spark, str(root)).collect()}
    assert {k: r["kind"] for k, r in rows.items()} == {("f1", "a.txt"): "file", ("f2", "a.txt"): "file", ("f2", "b.txt"): "link", ("f3", "a.txt"): "file", ("f3", "deep"): "other", ("f4", "a.txt"): "link"}
    assert rows["f1", "a.txt"]["served"] == 5
    assert {r["kind"] for r in present_files(spark, str(root), str(tmp_path / "far")).filter("file_id = 'f1'").collect()} == {"outside"}
    wanted = spark.createDataFrame([("f1", "a.txt", 5, "hosted", ""), ("f2", "b.txt", 5, "hosted", ""), ("f3", "a.txt", 9, "hosted", ""), ("f4", "a.txt", 1, "hosted", ""), ("f5", "a.txt", 1, "hosted", "")], "file_id string, name string, size bigint, mode string, mime string")
    totals = spark.createDataFrame([(3, 1)], "skipped bigint, unsafe bigint")
    report = attachments.report(attachments.reconciled(wanted, present_files(spark, str(root)), spark.createDataFrame([], "file_id string, accepted bigint")), totals).first()
    assert (report["present_count"], report["missing_count"], report["size_mismatch_count"], report["skipped_count"], report["unsafe_count"], report["mismatched_files"]) == (2, 1, 1, 3, 3, "f3/a.txt 9 5")
    assert present_files(spark, str(tmp_path / "nowhere")).count() == 0


GOOD = ["WORKSPACE=one", "CHANNEL_URL=https://one.slack.com/x", "SLACK_TOKEN=s3cret", "SLACK_COOKIE='c'"]


@pytest.mark.parametrize(
    ("text", "says"),
    [
        ([""], "no workspace block"), (["OTHER=1"], "no workspace block"), ([*GOOD[:1], "CHANNEL_URL=http://evil.com", *GOOD[2:]], "invalid address"), (GOOD[:3], "missing"),
        ([*GOOD, "WORKSPACE=ONE", *GOOD[1:]], "duplicate workspace"), ([*GOOD, "no assignment"], "invalid assignment"),
    ],
)
def test_block_files_are_refused_whole(spark, text, says):
    rows = spark.createDataFrame([("f", i, x) for i, x in enumerate(text)] + [("g", i, x) for i, x in enumerate(GOOD)], LINE)
    with pytest.raises(Exception, match=says):
        parse_blocks(rows).collect()
    assert parse_blocks(rows.filter("file = 'g'")).count() == 4


def test_case_is_folded_as_unicode_does(spark):
    rows = spark.createDataFrame([("Straße", 1), ("STRASSE", 2), ("strasse", 2), ("other", 3)], "name string, own bigint")
    assert [(r["folded"], r["n"]) for r in newest.folded_duplicates(rows, F.col("name"), "own").collect()] == [("strasse", 2)]
    assert select_workspace(rows.withColumnRenamed("name", "workspace_id").filter("own <> 2"), F.lit(" STRASSE ")).first()["own"] == 1
    with pytest.raises(Exception, match="no letter or digit"):
        spark.range(1).select(S.slug(F.lit("!!!"))).collect()


def test_pages_spread_a_hot_thread(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.4 else f"t{rng.randint(0, 50)}", rng.randint(0, 500), f"k{i}") for i in range(5000)]
    pages = views.thread_pages(spark.createDataFrame(rows, "t string, ts_us bigint, message_key string"), ["t"], page=100).collect()
    assert max(len(r["message_keys"]) for r in pages) == 100
    lists: dict = {}
    for r in sorted(pages, key=lambda r: (r["t"], r["page"])):
        assert r["page"] == len(lists.get(r["t"], [])) / 100 and r["message_count"] == len(r["message_keys"])
        lists[r["t"]] = lists.get(r["t"], []) + r["message_keys"]
    want: dict = {}
    for t, ts, k in sorted(rows):
        want.setdefault(t, []).append(k)
    assert lists == want


def test_metric_documents_are_put_in_place_together(spark, tmp_path):
    folder = str(tmp_path / "groups")
    docs = spark.createDataFrame([(f"job@base64/eA==/workspace@base64/{i}", f"v{i}\n") for i in range(6)], "path string, body string")
    metric_groups.write_groups(docs, folder)
    read = lambda: {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f)).read() for d, _, fs in os.walk(folder) for f in fs}
    first = read()
    assert first == {f"job@base64/eA==/workspace@base64/{i}/metrics.prom": f"v{i}\n" for i in range(6)}
    broken = docs.withColumn("body", F.when(F.col("path").endswith("5"), F.raise_error(F.lit("no body")).cast("string")).otherwise("half"))
    with pytest.raises(Exception, match="no body"):
        metric_groups.write_groups(broken.repartition(3), folder)
    assert read() == first
    metric_groups.write_groups(docs.limit(1).withColumn("body", F.lit("new\n")), folder)
    assert sorted(read().values()) == sorted(["new\n", *[f"v{i}\n" for i in range(1, 6)]])
    with pytest.raises(Exception, match="out of the folder"):
        metric_groups.write_groups(spark.createDataFrame([("../x", "y")], "path string, body string"), folder)
    assert metric_groups.remove_groups(metrics.stale(docs, docs.limit(4)), folder) == 2 and len(read()) == 4
