import json

import pytest

from pyspark.sql import functions as F

from chatlake.operators import views
from chatlake.plans import ingest as I
from chatlake.plans import lake as L
from chatlake.sources.sqlite_archive import check_structure, migration_version, read_archive, snapshot
from tests import archive as A


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "a.sqlite"), str(tmp_path / "lake")


def test_two_workspaces_share_a_lake(spark, place, tmp_path):
    path, lake = place
    other = str(tmp_path / "b.sqlite")
    A.fixture_a(path, "T1", "alpha")
    A.fixture_a(other, "T2", "beta")
    for p, slug in ((path, "alpha"), (other, "beta")):
        r = I.ingest(spark, p, lake, slug)
        assert (r.inserted, r.updated, r.unchanged) == (3, 0, 0)
    messages = L.read(spark, lake, "messages")
    assert messages.count() == 6 and messages.filter("is_deleted").count() == 2
    parent = messages.filter(f"workspace_id = 'T1' AND ts = '{A.PARENT}'").first()
    assert parent["text"] == "new alpha" and parent["source_chunk_id"] == 11 and parent["is_edited"] and parent["is_thread_parent"]
    assert messages.filter(f"ts = '{A.REPLY}'").first()["parent_ts"] == A.PARENT
    assert L.read(spark, lake, "reactions").count() == 2
    files = L.read(spark, lake, "files").collect()
    assert len(files) == 2 and all(f["local_object_path"] is None and f["size_bytes"] == 12 for f in files)
    assert views.search_documents(messages).count() == 4
    rich = views.enriched(messages, L.read(spark, lake, "workspaces"), L.read(spark, lake, "channels"), L.read(spark, lake, "users"))
    assert rich.count() == 6 and {r["channel_name"] for r in rich.collect()} == {"general"}
    assert views.timeline(messages).count() == 2
    assert {r["message_count"] for r in views.message_threads(messages).collect()} == {2}
    L.register_views(spark, lake)
    assert spark.sql("SELECT count(*) FROM threads JOIN messages_enriched USING (workspace_id, channel_id)").first()[0] == 6
    report = I.validate(spark, path, lake)
    assert report == {
        "workspace_id": "T1", "passed": True, "source_message_rows": 4, "source_natural_key_count": 3, "canonical_message_rows": 3, "canonical_natural_key_count": 3, "natural_keys_match": True,
        "missing_canonical_key_count": 0, "extra_canonical_key_count": 0, "selected_payload_mismatch_count": 0, "raw_json_mismatch_count": 0, "source_chunk_mismatch_count": 0,
        "latest_timestamp_matches": True, "source_latest_timestamp": A.GONE, "canonical_latest_timestamp": A.GONE, "source_invalid_json_count": 0, "canonical_invalid_json_count": 0,
        "source_duplicate_key_count": 1, "source_duplicate_row_count": 1, "canonical_duplicate_key_count": 0, "canonical_duplicate_row_count": 0,
        "checkpoint_exists": True, "checkpoint_matches_source": True, "checkpoint_run_succeeded": True, "checkpoint_valid": True, "orphan_reply_count": 0,
    }
    raw = json.loads(files[0]["raw_json"])
    assert raw["title"] == "Plan é" and raw["shares"] == {"public": [1, None]}
    assert json.loads(messages.filter(f"workspace_id = 'T1' AND ts = '{A.PARENT}'").first()["file_metadata_json"])[0]["shares"] == raw["shares"]


def test_same_archive_again_takes_the_fast_path_and_records_paths(spark, place):
    path, lake = place
    A.fixture_a(path)
    I.ingest(spark, path, lake, "alpha")
    uploads = spark.createDataFrame([("F_PLAN", "/u/F_PLAN/b.txt"), ("F_PLAN", "/u/F_PLAN/a.txt")], "file_id string, path string")
    again = I.ingest(spark, path, lake, "alpha", uploads=uploads)
    assert again.fast and (again.inserted, again.updated, again.unchanged) == (0, 0, 3)
    assert L.read(spark, lake, "files").first()["local_object_path"] == "/u/F_PLAN/a.txt"
    assert L.read(spark, lake, "source_archives").first()["ingest_count"] == 1
    assert [r["status"] for r in L.runs(spark, lake).collect()] == ["succeeded"] * 2 and L.read(spark, lake, "ingestion_runs").filter("status = 'started'").count() == 2


def test_append_inserts_one_and_keeps_first_observation(spark, place):
    path, lake = place
    db = A.fixture_a(path)
    I.ingest(spark, path, lake, "alpha")
    before = {r["ts"]: r for r in L.read(spark, lake, "messages").collect()}
    A.append(db)
    r = I.ingest(spark, path, lake, "alpha")
    assert (r.inserted, r.updated) == (1, 0)
    after = {r["ts"]: r for r in L.read(spark, lake, "messages").collect()}
    assert len(after) == 4 and all(after[t]["first_observed_at"] == before[t]["first_observed_at"] for t in before)
    point = L.read(spark, lake, "ingestion_checkpoints").first()
    assert (point["session_high_water"], point["chunk_high_water"]) == (2, 20) and point["lineage_signature"]
    kinds = [x["event_type"] for x in L.read(spark, lake, "message_events").collect()]
    assert sorted(kinds) == ["created", "created", "created", "observed_deleted"]


def test_membership_is_replaced_in_observed_channels_only(spark, place):
    path, lake = place
    db = A.fixture_a(path)
    A.insert(db, "CHANNEL_USER", CHANNEL_ID="C_GARDEN", USER_ID="STALE", CHUNK_ID=4, IDX=1)
    A.insert(db, "CHANNEL_USER", CHANNEL_ID="OTHER", USER_ID="KEPT", CHUNK_ID=4, IDX=0)
    db.commit()
    first = I.ingest(spark, path, lake, "alpha")
    A.append(db)
    A.insert(db, "CHANNEL_USER", CHANNEL_ID="C_GARDEN", USER_ID="U_ROSE", CHUNK_ID=20, IDX=0)
    db.commit()
    I.ingest(spark, path, lake, "alpha")
    rows = {(r["channel_id"], r["user_id"]): r for r in L.read(spark, lake, "channel_members").collect()}
    assert set(rows) == {("C_GARDEN", "U_ROSE"), ("OTHER", "KEPT")}
    assert rows["C_GARDEN", "U_ROSE"]["first_observed_run_id"] == first.run_id


@pytest.mark.parametrize(
    ("sql", "says"),
    [
        (f"DELETE FROM MESSAGE WHERE TS = '{A.GONE}'", "no longer contains"),
        ("UPDATE MESSAGE SET DATA = CAST('{\"text\":\"other\"}' AS BLOB) WHERE CHUNK_ID = 12", "rewrote"),
        ("DELETE FROM S_USER", "no longer contains"),
    ],
)
def test_lost_or_rewritten_sources_are_refused(spark, place, sql, says):
    path, lake = place
    db = A.fixture_a(path)
    I.ingest(spark, path, lake, "alpha")
    before = sorted(map(str, L.read(spark, lake, "messages").collect()))
    db.execute(sql)
    db.commit()
    with pytest.raises(I.ContinuityError, match=says):
        I.ingest(spark, path, lake, "alpha")
    assert sorted(map(str, L.read(spark, lake, "messages").collect())) == before
    assert sorted(r["status"] for r in L.runs(spark, lake).collect()) == ["failed", "succeeded"]


def test_pruned_copies_are_accepted_by_a_full_read(spark, place):
    path, lake = place
    db = A.fixture_a(path)
    I.ingest(spark, path, lake, "alpha")
    db.execute("DELETE FROM MESSAGE WHERE CHUNK_ID = 10")
    db.commit()
    r = I.ingest(spark, path, lake, "alpha")
    assert not r.fast and (r.inserted, r.updated, r.unchanged) == (0, 0, 3)


@pytest.mark.parametrize(("sql", "says"), [("UPDATE SESSION SET FINISHED = 0", "unfinished"), ("UPDATE CHUNK SET FINAL = 0", "incomplete"), ("UPDATE WORKSPACE SET TEAM_ID = ''", "one workspace")])
def test_incomplete_archives_are_refused(spark, place, sql, says):
    path, lake = place
    db = A.fixture_a(path)
    db.execute(sql)
    db.commit()
    with pytest.raises(ValueError, match=says):
        I.ingest(spark, path, lake, "alpha")


def test_a_non_final_page_is_fine_if_a_final_one_exists(spark, place):
    path, lake = place
    db = A.fixture_a(path)
    db.execute("UPDATE CHUNK SET FINAL = 0")
    A.insert(db, "CHUNK", ID=14, SESSION_ID=1, TYPE_ID=0, FINAL=1, CHANNEL_ID="C_GARDEN")
    db.commit()
    assert I.ingest(spark, path, lake, "alpha").inserted == 3


def test_structure_snapshot_and_compaction(spark, place, tmp_path):
    path, _ = place
    db = A.fixture_a(path)
    copy = snapshot(path, str(tmp_path / "copy.sqlite"))
    check_structure(copy, pages=True)
    assert migration_version(copy) is None
    db.execute("CREATE TABLE goose_db_version (id INTEGER, version_id INTEGER, is_applied INTEGER)")
    db.execute("INSERT INTO goose_db_version VALUES (1, 4, 1), (2, 7, 1), (3, 9, 0)")
    db.commit()
    assert migration_version(path) == 7
    assert read_archive(spark, copy, "MESSAGE", partitions=3).rdd.getNumPartitions() == 2 and read_archive(spark, copy, "MESSAGE").filter("CHUNK_ID > 11").count() == 2
    counts = I.compact(spark, path, str(tmp_path / "compact"))
    assert counts["MESSAGE"] == 3 and counts["CHANNEL"] == 1
    with pytest.raises(Exception, match="(?i)exist"):
        I.compact(spark, path, str(tmp_path / "compact"))
    db.execute("DROP TABLE FILE")
    db.commit()
    with pytest.raises(ValueError, match="no table FILE"):
        check_structure(path)


def corrupt(spark, lake, change, run="corruption"):
    """Rewrite the messages of a lake as ``change`` gives them."""
    messages = L.read(spark, lake, "messages", "T1")
    L.publish(spark, lake, "T1", run, {"messages": change(messages)}, {})


def test_corruption_is_counted(spark, place):
    path, lake = place
    db = A.fixture_a(path)
    I.ingest(spark, path, lake, "alpha")
    bad = F.col("ts") == A.REPLY
    corrupt(spark, lake, lambda m: m.filter(F.col("ts") != A.PARENT).withColumns({"raw_json": F.when(bad, "{bad").otherwise(F.col("raw_json")), "source_chunk_id": F.col("source_chunk_id") + bad.cast("int")}))
    report = I.validate(spark, path, lake)
    assert not report["passed"] and not report["natural_keys_match"] and report["latest_timestamp_matches"] and report["checkpoint_valid"]
    for name in ("missing_canonical_key_count", "selected_payload_mismatch_count", "raw_json_mismatch_count", "source_chunk_mismatch_count", "canonical_invalid_json_count", "orphan_reply_count"):
        assert report[name] == 1, name
    corrupt(spark, lake, lambda m: m.unionByName(m.filter(bad)), "doubling")
    db.execute("UPDATE MESSAGE SET DATA = x'7b2261223a22ff227d' WHERE CHUNK_ID = 13")  # JSON with a byte that is no UTF-8
    db.execute("UPDATE MESSAGE SET DATA = CAST('[1]' AS BLOB) WHERE CHUNK_ID = 12")
    A.insert(db, "CHUNK", ID=30, SESSION_ID=1, TYPE_ID=0, FINAL=1)
    db.commit()
    report = I.validate(spark, path, lake)
    assert report["source_invalid_json_count"] == 1 and report["canonical_duplicate_key_count"] == report["canonical_duplicate_row_count"] == 1
    assert report["raw_json_mismatch_count"] == 2 and report["checkpoint_exists"] and not report["checkpoint_matches_source"] and not report["checkpoint_valid"]


def test_an_append_writes_only_what_it_touches_and_commits_are_guarded(spark, place, monkeypatch):
    path, lake = place
    db = A.fixture_a(path)
    for i in range(6):
        ts = f"1651000{400 + i}.000001"
        A.insert(db, "MESSAGE", ID=A.id_of(ts), CHUNK_ID=13, CHANNEL_ID=f"C_{i}", TS=ts, IS_PARENT=0, IDX=0, NUM_FILES=0, TXT="x", DATA=A.blob(text="x"))
    db.commit()
    I.ingest(spark, path, lake, "alpha")
    before = L.current(spark, lake)["T1"][1]["messages"]
    A.append(db)
    assert I.ingest(spark, path, lake, "alpha").inserted == 1
    seq, folders = L.current(spark, lake)["T1"]
    own = {str(b) for b in L.touched(spark.createDataFrame([("C_GARDEN",)], "channel_id string"), "messages")}
    assert len(before) > 2 and {b for b in before if folders["messages"][b] != before[b]} == own
    assert L.read(spark, lake, "messages").count() == 10 and seq == 4
    ledger = L.read(spark, lake, "ingestion_runs")
    with pytest.raises(L.CommitConflict, match="no longer"):
        L.publish(spark, lake, "T1", "late", {}, {"ingestion_runs": ledger}, since=1)
    monkeypatch.setattr(L, "current", lambda *_: {"T1": (1, {})})  # two runs that looked at the same commit
    with pytest.raises(L.CommitConflict, match="taken"):
        L.publish(spark, lake, "T1", "both", {}, {"ingestion_runs": ledger})


def test_a_scoped_manifest_sees_new_rows_only(spark, place):
    path, _ = place
    db = A.fixture_a(path)
    whole, part = (lambda: I.manifest(I.open_archive(spark, path)[0])), (lambda: I.scoped_manifest(I.open_archive(spark, path)[0], 13))
    before, scoped = whole(), part()
    rows = {t: n for t, n, _ in scoped["tables"]}
    assert rows["MESSAGE"] == 0 and rows["CHUNK"] == rows["SESSION"] == 1 and scoped["scope"] == {"min_chunk_id": 13}
    db.execute("UPDATE MESSAGE SET TXT = 'x' WHERE CHUNK_ID = 12")
    db.commit()
    assert part() == scoped and whole() != before


def test_compaction_is_proven_against_the_lake(spark, place, tmp_path):
    path, lake = place
    db = A.fixture_a(path)
    I.ingest(spark, path, lake, "alpha")
    assert I.compact(spark, path, str(tmp_path / "good"), lake)["MESSAGE"] == 3
    db.execute(f"DELETE FROM MESSAGE WHERE TS = '{A.GONE}'")
    db.commit()
    with pytest.raises(RuntimeError, match="lost keys"):
        I.compact(spark, path, str(tmp_path / "bad"), lake)


def test_rebase_after_pruning_restores_the_fast_path(spark, place):
    path, lake = place
    db = A.fixture_a(path)
    first = I.ingest(spark, path, lake, "alpha")
    db.execute("DELETE FROM MESSAGE WHERE CHUNK_ID = 10")
    db.commit()
    I.rebase(spark, path, lake)
    assert L.read(spark, lake, "ingestion_checkpoints").first()["successful_run_id"] == first.run_id
    assert I.ingest(spark, path, lake, "alpha").fast
    db.execute("DELETE FROM MESSAGE WHERE CHUNK_ID = 12")
    db.commit()
    with pytest.raises(I.ContinuityError):
        I.rebase(spark, path, lake)
