"""Ingest of one archive into the lake: scope, proofs, merges, one commit.

An archive whose file hash is the checkpoint's is done before any of its tables is read.  Otherwise a run reads, of the
large tables, the rows after the checkpoint's chunk (the source filters them), the keys of all rows without their
payloads, and the rows of the touched keys (a Bloom filter inside the source); the checkpoint's lineage grows by the
new rows' digests.  ``prove=True`` also digests the old rows and names the chunks that were rewritten.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake import schemas
from chatlake.functions import scalars as S
from chatlake.operators import canonicalize, lineage, merge, newest, proofs
from chatlake.operators.views import orphan_replies
from chatlake.plans import lake as L
from chatlake.sources.file_digest import file_fingerprint
from chatlake.sources.sqlite_archive import check_structure, read_archive

MODES = ("incremental", "backfill", "development")
SMALL = ("WORKSPACE", "SESSION", "CHUNK")  # tables of an archive that are persisted
WIDE = ("workspaces", "channels", "users", "messages", "reactions", "files", "channel_members", "ingestion_checkpoints", "source_archives")


class ContinuityError(RuntimeError):
    """The archive no longer covers what the lake has accepted."""


@dataclass(frozen=True)
class Result:
    run_id: str
    workspace_id: str
    inserted: int
    updated: int
    unchanged: int
    fast: bool = False


def manifest(tables: dict[str, DataFrame]) -> list[list]:
    """[table, rows, digest] of every archive table, from one small union."""
    union = None
    for name in sorted(tables):
        one = proofs.table_digest(tables[name], name)
        union = one if union is None else union.unionByName(one)
    return sorted([r["table"], r["rows"], r["digest"]] for r in union.collect())


def scoped_manifest(tables: dict[str, DataFrame], since: int) -> dict:
    """The manifest of the rows after a chunk; sessions and chunks are always digested whole."""
    part = {t: df if t in ("SESSION", "CHUNK") else df.filter(F.col("CHUNK_ID") > since) for t, df in tables.items()}
    return {"version": 3, "scope": {"min_chunk_id": since}, "tables": manifest(part)}


def signature(entries) -> str:
    return hashlib.sha256(json.dumps(entries, separators=(",", ":"), sort_keys=True).encode()).hexdigest()


def chunk_of(table: str) -> str:
    return "ID" if table in ("SESSION", "CHUNK") else "CHUNK_ID"


def lineage_of(tables: dict[str, DataFrame], high_water: int | None, since: int | None = None, before: dict | None = None) -> dict:
    """The lineage manifest: of each table the additive digests of ranges of chunks.

    With ``since`` and the manifest ``before``, only rows after that chunk are digested and added to its ranges; the
    sessions, which change in place, are always digested whole.
    """
    out = {}
    for name, df in sorted(tables.items()):
        chunk = chunk_of(name)
        old = before["tables"][name] if before and since is not None and name != "SESSION" else None
        width = max(lineage.width_for(high_water), old["width"] if old else 1)
        new = lineage.collected(df if old is None else df.filter(F.col(chunk) > since), chunk, width)
        if old:
            new = lineage.merged([*lineage.merged([tuple(x) for x in old["ranges"]], width // old["width"]), *new])
        out[name] = {"width": width, "ranges": [list(x) for x in new]}
    return {"version": 4, "tables": out}


def rows_in(manifest_: dict) -> dict[str, int]:
    return {t: sum(x[1] for x in m["ranges"]) for t, m in manifest_["tables"].items()}


def stored_lineage(checkpoint) -> dict | None:
    """The checkpoint's lineage, if it holds one with ranges."""
    try:
        held = json.loads(checkpoint["lineage_manifest_json"])
    except (TypeError, ValueError):
        return None
    return held if isinstance(held, dict) and held.get("version") == 4 else None


def rewritten_chunks(tables: dict[str, DataFrame], checkpoint) -> dict[str, list[tuple[int, int]]]:
    """table to the (first, last) chunks of ranges whose rows up to the checkpoint differ from its lineage."""
    held, out = stored_lineage(checkpoint), {}
    for name, m in held["tables"].items() if held else ():
        if name == "SESSION":
            continue
        chunk = chunk_of(name)
        now = lineage.collected(tables[name].filter(F.col(chunk) <= checkpoint["chunk_high_water"]), chunk, m["width"])
        if found := lineage.differing([tuple(x) for x in m["ranges"]], now, m["width"]):
            out[name] = found
    return out


def open_archive(spark: SparkSession, path: str, complete: bool = True, persist: tuple[str, ...] = tuple(schemas.ARCHIVE_DDL)) -> tuple[dict[str, DataFrame], str]:
    """The archive's tables and its workspace id; refuses what isn't whole.

    Those named are persisted (spilling to disk), as a whole read needs each several times; callers ``close`` them.
    """
    check_structure(path)
    tables = {t: read_archive(spark, path, t) for t in schemas.ARCHIVE_DDL}
    tables |= {t: tables[t].persist() for t in persist}
    try:
        return tables, _checked(tables, complete)
    except Exception:
        close(tables)
        raise


def close(tables: dict[str, DataFrame]) -> None:
    for df in tables.values():
        df.unpersist()


def _checked(tables: dict[str, DataFrame], complete: bool) -> str:
    ids = [r[0] for r in tables["WORKSPACE"].filter("TEAM_ID <> ''").select("TEAM_ID").distinct().limit(2).collect()]
    if len(ids) != 1:
        raise ValueError(f"expected one workspace in the archive, found {len(ids) or 'none'}")
    if complete:
        state = proofs.completeness(tables["SESSION"], tables["CHUNK"]).first()
        if not state["finished"]:
            raise ValueError("the archive's latest session is unfinished")
        if state["incomplete"]:
            raise ValueError(f"the archive's latest session has {state['incomplete']} incomplete stream(s)")
    return ids[0]


def check_continuity(tables: dict[str, DataFrame], records: dict[str, DataFrame], held: dict[str, DataFrame], checkpoint, marks: dict[str, int | None], bootstrap: bool) -> None:
    """Every accepted key is still there, nothing regressed or was rewritten in its own chunk.

    Of ``tables`` only keys are read.
    """
    if checkpoint is None:
        return
    if not checkpoint["lineage_signature"] or not checkpoint["lineage_manifest_json"]:
        if bootstrap:
            return
        raise ContinuityError("the checkpoint has no lineage evidence")
    if signature(json.loads(checkpoint["lineage_manifest_json"])) != checkpoint["lineage_signature"]:
        raise ContinuityError("the checkpoint's lineage signature is wrong")
    source_keys = {
        "messages": tables["MESSAGE"].select(F.col("CHANNEL_ID").alias("channel_id"), F.col("TS").alias("ts")),
        "channels": tables["CHANNEL"].select(F.col("ID").alias("channel_id")),
        "users": tables["S_USER"].select(F.col("ID").alias("user_id")),
    }
    for name, source in source_keys.items():
        gone = merge.vanished(held[name], source, source.columns)
        sample = gone.orderBy(*gone.columns).limit(5).collect()
        if sample:
            raise ContinuityError(f"the archive no longer contains {gone.count()} of the lake's {name}, e.g. {'; '.join('/'.join(r) for r in sample)}")
    bad = merge.regressions(held["messages"], records["messages"], ["channel_id", "ts"], "source_chunk_id", "payload_hash")
    for r in bad.orderBy("channel_id", "ts").limit(1).collect():
        raise ContinuityError(f"the archive {'regressed' if r['reason'] == 'regressed' else 'rewrote'} message {r['channel_id']}/{r['ts']}")
    for mark in ("session_high_water", "chunk_high_water"):
        before, now = checkpoint[mark], marks[mark]
        if before is not None and (now is None or now < before):
            raise ContinuityError(f"the archive's {mark} regressed")


def records_of(tables: dict[str, DataFrame], workspace_id: str, since: int | None, scan) -> dict[str, DataFrame]:
    """Canonical records, of all keys or of those touched after the checkpoint.

    Scoped reads give the global newest row of each touched key: ``scan(table, columns, keys)`` reads the keys of new
    rows, then the rows of these keys; FILE is always read whole.
    """

    def scoped(name: str, keys: list[str]) -> DataFrame:
        if since is None:
            return tables[name]
        touched = newest.touched_keys(scan(name, columns=[*keys, "CHUNK_ID"]), keys, "CHUNK_ID", since)
        return scan(name, keys=touched)

    messages = canonicalize.messages(scoped("MESSAGE", ["CHANNEL_ID", "TS"]), F.lit(workspace_id)).persist()
    return {
        "workspaces": canonicalize.workspace(tables["WORKSPACE"]),
        "channels": canonicalize.channels(scoped("CHANNEL", ["ID"])),
        "users": canonicalize.users(scoped("S_USER", ["ID"])),
        "channel_members": canonicalize.members(scoped("CHANNEL_USER", ["CHANNEL_ID"])),
        "messages": messages,
        "reactions": canonicalize.reactions(messages),
        "files": canonicalize.files(tables["FILE"], messages),
    }


def ingest(spark: SparkSession, archive: str, lake: str, slug: str, mode: str = "incremental", uploads: DataFrame | None = None, bootstrap: bool = False, prove: bool = False) -> Result:
    """One run; raises, with the run recorded as failed, if a proof fails.  ``prove`` digests the old rows too."""
    if mode not in MODES or not slug.strip():
        raise ValueError("mode or workspace slug is not valid")
    run_id, now = uuid.uuid4().hex, datetime.now(UTC).replace(tzinfo=None)
    check_structure(archive)
    print_of = file_fingerprint(spark, archive)
    same = L.read(spark, lake, "ingestion_checkpoints").filter(F.col("source_fingerprint") == print_of).first()
    tables, workspace_id = ({}, same["workspace_id"]) if same else open_archive(spark, archive, persist=SMALL)
    seq = L.current(spark, lake).get(workspace_id, (0, {}))[0]  # before the tables, so what they miss is noticed
    held = L.read_many(spark, lake, WIDE, workspace_id)
    run = {"run_id": run_id, "workspace_id": workspace_id, "mode": mode, "started_at": now, "source_path": archive}
    schema = schemas.struct(schemas.LAKE_DDL["ingestion_runs"])
    ledger = lambda **x: spark.createDataFrame([tuple((run | x).get(f.name) for f in schema.fields)], schema)
    seq = L.publish(spark, lake, workspace_id, run_id, {}, {"ingestion_runs": ledger(status="started")}, since=seq, part="started")
    kept: list[DataFrame] = []
    try:
        if same:
            return _unchanged(spark, lake, run_id, now, workspace_id, held, print_of, uploads, ledger, seq)
        return _run(spark, lake, slug, run_id, now, tables, workspace_id, held, print_of, archive, uploads, bootstrap, prove, ledger, seq, kept)
    except L.CommitConflict:
        raise
    except Exception as e:
        L.publish(spark, lake, workspace_id, run_id, {}, {"ingestion_runs": ledger(status="failed", completed_at=now, source_fingerprint=print_of, error_class=type(e).__name__, error_message=str(e)[:2000])})
        raise
    finally:
        close(tables)
        for df in kept:
            df.unpersist()


def _unchanged(spark, lake, run_id, now, workspace_id, held, print_of, uploads, ledger, seq) -> Result:
    """The file is the checkpoint's: no table of the archive is read."""
    known = held["messages"].count()
    rows = held["source_archives"].filter(F.col("source_fingerprint") == print_of).agg(F.max("source_message_rows")).first()[0]
    done = {"ingestion_runs": ledger(status="succeeded", completed_at=now, source_fingerprint=print_of, source_message_rows=rows, canonical_message_rows=known, inserted_messages=0, updated_messages=0, unchanged_messages=known)}
    again = {"ingestion_checkpoints": held["ingestion_checkpoints"].withColumns({"successful_run_id": F.lit(run_id), "checkpointed_at": F.lit(now)})}
    if uploads is not None:
        again["files"] = with_paths(held["files"], uploads)
    L.publish(spark, lake, workspace_id, run_id, again, done, since=seq)
    return Result(run_id, workspace_id, 0, 0, known, True)


def _run(spark, lake, slug, run_id, now, tables, workspace_id, held, print_of, archive, uploads, bootstrap, prove, ledger, seq, kept) -> Result:
    checkpoint = held["ingestion_checkpoints"].first()
    known = held["messages"].count()
    marks = high_waters(tables)
    before = checkpoint["chunk_high_water"] if checkpoint else None
    since = before if before is not None and marks["chunk_high_water"] is not None and marks["chunk_high_water"] > before else None
    if prove and checkpoint is not None:
        for name, ranges in rewritten_chunks(tables, checkpoint).items():
            raise ContinuityError(f"the archive rewrote {name} in chunks {', '.join(f'{a} to {b}' for a, b in ranges[:5])}")

    def scan(name: str, columns: list[str] | None = None, keys: DataFrame | None = None) -> DataFrame:
        if keys is not None:  # read for the filter and for the join
            kept.append(keys := keys.persist())
        return read_archive(spark, archive, name, columns, keys=keys)

    records = records_of(tables, workspace_id, since, scan)
    kept.append(records["messages"])
    pruned = {t: scan(t, columns=c) for t, c in (("MESSAGE", ["CHANNEL_ID", "TS"]), ("CHANNEL", ["ID"]), ("S_USER", ["ID"]))}
    check_continuity(pruned, records, held, checkpoint, marks, bootstrap)
    lineage_now = lineage_of(tables, marks["chunk_high_water"], since, stored_lineage(checkpoint) if checkpoint else None)
    counts = rows_in(lineage_now)
    folders = L.current(spark, lake).get(workspace_id, (0, {}))[1]
    buckets = None
    if since is not None:  # the folders of other buckets stay
        buckets = {"messages": L.touched(records["messages"], "messages")}
        buckets["reactions"] = buckets["messages"]
        if isinstance(folders.get("channel_members", {}), dict):
            buckets["channel_members"] = L.touched(records["channel_members"], "channel_members")
    held |= L.read_many(spark, lake, tuple(L.BUCKETED), workspace_id, buckets)

    seen = {"workspace_id": F.lit(workspace_id), "latest_run_id": F.lit(run_id), "first_observed_at": F.lit(now), "last_observed_at": F.lit(now)}
    stamped = {t: records[t].withColumns(seen) for t in ("workspaces", "channels", "users", "messages", "files")}
    stamped["workspaces"] = stamped["workspaces"].withColumn("workspace_slug", F.lit(slug))
    keys = {"workspaces": ["workspace_id"], "channels": ["workspace_id", "channel_id"], "users": ["workspace_id", "user_id"], "messages": ["workspace_id", "channel_id", "ts"], "files": ["workspace_id", "file_id"]}
    out = {t: merge.merge(held[t], stamped[t], k, keep_old=["first_observed_at", "message_key", "ts_us"]) for t, k in keys.items() if t != "messages"}

    marked = merge.classify(stamped["messages"], held["messages"], keys["messages"], "payload_hash").persist()
    kept.append(marked)
    changed = marked.withColumn("last_changed_at", F.when(F.col("change") != "unchanged", F.lit(now)))
    out["messages"] = merge.merge(held["messages"], changed, keys["messages"], keep_old=["first_observed_at", "message_key", "ts_us"], keep_if_null=["last_changed_at"])
    members = records["channel_members"].select(F.lit(workspace_id).alias("workspace_id"), "channel_id", "user_id", "source_chunk_id", F.lit(run_id).alias("first_observed_run_id"), F.lit(run_id).alias("last_observed_run_id"))
    out["channel_members"] = merge.scoped_replace(held["channel_members"], members, ["workspace_id", "channel_id"], ["workspace_id", "channel_id", "user_id"], keep_old=["first_observed_run_id"])
    reactions = records["reactions"].withColumns({"workspace_id": F.lit(workspace_id), "latest_run_id": F.lit(run_id)})
    parents = records["messages"].select(F.lit(workspace_id).alias("workspace_id"), "channel_id", F.col("ts").alias("message_ts"))
    out["reactions"] = merge.replace_children(held["reactions"], parents, reactions, ["workspace_id", "channel_id", "message_ts"])
    kind = merge.event_type(F.col("change"), F.col("is_deleted"))
    events = marked.withColumn("event_type", kind).filter("event_type IS NOT NULL").select(
        F.sha2(F.concat_ws("\x1f", "message_key", F.lit(run_id)), 256).alias("event_id"), "workspace_id", "channel_id", F.col("ts").alias("message_ts"), "message_key", "event_type", "payload_hash", "raw_json", F.lit(run_id).alias("run_id"), F.lit(now).alias("observed_at"),
    )
    if uploads is not None:
        out["files"] = with_paths(out["files"], uploads)
    old = held["source_archives"].filter(F.col("source_fingerprint") == print_of)
    new = spark.createDataFrame([(workspace_id, print_of, archive, marks["session_high_water"], marks["chunk_high_water"], counts["MESSAGE"], json.dumps(counts), run_id, run_id, now, now, 1)], schemas.struct(schemas.LAKE_DDL["source_archives"]))
    count = (old.agg(F.max("ingest_count")).first()[0] or 0) + 1
    out["source_archives"] = merge.merge(held["source_archives"], new.withColumn("ingest_count", F.lit(count).cast("long")), ["workspace_id", "source_fingerprint"], keep_old=["first_run_id", "first_ingested_at"])
    out["ingestion_checkpoints"] = spark.createDataFrame([(workspace_id, print_of, marks["session_high_water"], marks["chunk_high_water"], signature(lineage_now), json.dumps(lineage_now), run_id, now)], schemas.struct(schemas.LAKE_DDL["ingestion_checkpoints"]))
    n = merge.change_counts(marked).first()
    total = known + n["inserted"]
    done = ledger(status="succeeded", completed_at=now, source_fingerprint=print_of, source_message_rows=counts["MESSAGE"], canonical_message_rows=total, inserted_messages=n["inserted"], updated_messages=n["updated"], unchanged_messages=n["unchanged"])
    L.publish(spark, lake, workspace_id, run_id, out, {"message_events": events, "ingestion_runs": done}, buckets, seq)
    return Result(run_id, workspace_id, n["inserted"], n["updated"], n["unchanged"])


def with_paths(files: DataFrame, uploads: DataFrame) -> DataFrame:
    """Files with the path of an upload (file_id, path); the smallest, if there are several."""
    found = uploads.select("file_id", F.col("path").alias("local_object_path"))
    return merge.record_values(files, found, ["file_id"], "local_object_path").drop("changed")


def validate(spark: SparkSession, archive: str, lake: str) -> dict:
    """The content-free report of the newest source rows against the lake: counts, flags and the checkpoint.

    Corrupt bytes and bad JSON are counted, not refused.
    """
    tables, workspace_id = open_archive(spark, archive, complete=False)
    try:
        held = L.read_many(spark, lake, ("messages", "ingestion_checkpoints", "ingestion_runs"), workspace_id)
        raw = F.make_valid_utf8(F.col("DATA").cast("string"))
        rows = newest.newest_rows(tables["MESSAGE"], ["CHANNEL_ID", "TS"], canonicalize.newest_order())
        source = rows.select(F.col("CHANNEL_ID").alias("channel_id"), F.col("TS").alias("ts"), F.col("CHUNK_ID").alias("chunk"), F.sha2(raw, 256).alias("digest"), S.ts_us(F.col("TS")).alias("ts_us"))
        kept = held["messages"].select("channel_id", "ts", F.col("source_chunk_id").alias("chunk"), F.sha2("raw_json", 256).alias("digest"), S.ts_us(F.col("ts")).alias("ts_us"))
        report = proofs.validation(source, kept, ["channel_id", "ts"]).first().asDict()
        bad = lambda text, name: F.count_if(~S.is_json_object(text)).alias(name)
        report |= tables["MESSAGE"].agg(F.count(F.lit(1)).alias("source_message_rows"), bad(raw, "source_invalid_json_count")).first().asDict()
        report |= held["messages"].agg(F.count(F.lit(1)).alias("canonical_message_rows"), bad(F.col("raw_json"), "canonical_invalid_json_count")).first().asDict()
        report["source_duplicate_key_count"], report["source_duplicate_row_count"] = newest.duplicate_stats(tables["MESSAGE"], ["CHANNEL_ID", "TS"]).first()
        report["canonical_duplicate_key_count"], report["canonical_duplicate_row_count"] = newest.duplicate_stats(held["messages"], ["channel_id", "ts"]).first()
        report["orphan_reply_count"] = orphan_replies(held["messages"].filter("is_thread_reply"), ["channel_id"], "parent_ts", "ts", held["messages"]).count()
        report |= checkpoint_state(tables, held["ingestion_checkpoints"].first(), held["ingestion_runs"])
    finally:
        close(tables)
    report["passed"] = bool(
        report["natural_keys_match"] and report["latest_timestamp_matches"] and report["checkpoint_valid"]
        and not any(report[x] for x in ("raw_json_mismatch_count", "source_chunk_mismatch_count", "source_invalid_json_count", "canonical_invalid_json_count", "canonical_duplicate_key_count"))
    )
    return report | {"workspace_id": workspace_id}


def checkpoint_state(tables: dict[str, DataFrame], checkpoint, runs: DataFrame) -> dict[str, bool]:
    """Whether there is a checkpoint, its evidence and marks fit the archive, and its run has succeeded."""
    matches = succeeded = False
    if checkpoint is not None:
        marks = high_waters(tables)
        try:
            sealed = signature(json.loads(checkpoint["lineage_manifest_json"])) == checkpoint["lineage_signature"]
        except (TypeError, ValueError):
            sealed = False
        matches = sealed and all(checkpoint[m] == v for m, v in marks.items())
        succeeded = not runs.filter((F.col("run_id") == checkpoint["successful_run_id"]) & (F.col("status") == "succeeded")).isEmpty()
    return {"checkpoint_exists": checkpoint is not None, "checkpoint_matches_source": matches, "checkpoint_run_succeeded": succeeded, "checkpoint_valid": matches and succeeded}


def high_waters(tables: dict[str, DataFrame]) -> dict[str, int | None]:
    """The archive's largest session and chunk."""
    return {f"{t.lower()}_high_water": tables[t].agg(F.max("ID")).first()[0] for t in ("SESSION", "CHUNK")}


def compact(spark: SparkSession, archive: str, to: str, lake: str | None = None) -> dict[str, int]:
    """The archive's newest rows as Parquet tables under ``to``, proven and counted.

    The proof: the copy's newest rows are the archive's, its largest session and chunk too, and it still
    covers every row that ``lake`` (if given) has accepted of the workspace.
    """
    tables, workspace_id = open_archive(spark, archive)
    try:
        order = canonicalize.newest_order()
        counts, copies = {}, {}
        for name, df in tables.items():
            if name in schemas.NATURAL_KEYS:
                kept = newest.newest_rows(df, schemas.NATURAL_KEYS[name], order)
            elif name == "WORKSPACE":
                kept = df.orderBy(F.desc("CHUNK_ID"), F.desc("ID")).limit(1)
            elif name == "CHANNEL_USER":
                latest = df.groupBy("CHANNEL_ID").agg(F.max("CHUNK_ID").alias("CHUNK_ID"))
                kept = newest.newest_rows(df.join(latest, ["CHANNEL_ID", "CHUNK_ID"]).select(df.columns), ["CHANNEL_ID", "USER_ID"], [F.desc("CHUNK_ID"), F.desc("rowid")])
            else:
                kept = df
            kept.write.mode("errorifexists").parquet(f"{to}/{name}")
            copies[name] = spark.read.parquet(f"{to}/{name}")
            counts[name] = copies[name].count()
        verify_compaction(spark, tables, copies, lake, workspace_id)
    finally:
        close(tables)
    return counts


def verify_compaction(spark: SparkSession, tables: dict[str, DataFrame], copies: dict[str, DataFrame], lake: str | None, workspace_id: str) -> None:
    """Raises where a copy of the archive's tables differs in newest rows, high-water marks or the lake's keys."""
    digest = lambda df, keys: newest.newest_rows(df, keys, canonicalize.newest_order()).select(*keys, F.struct("CHUNK_ID", F.sha2("DATA", 256)).alias("digest"))
    held = {"MESSAGE": "messages", "CHANNEL": "channels", "S_USER": "users"}
    for name, keys in schemas.NATURAL_KEYS.items():
        lost = proofs.compaction_differences(digest(tables[name], keys), digest(copies[name], keys), keys, "digest")
        if not lost.isEmpty():
            raise RuntimeError(f"the compacted copy of {name} differs from the archive's newest rows")
        if lake is not None and name in held:
            known = L.read(spark, lake, held[name], workspace_id)
            columns = ["channel_id", "ts"] if name == "MESSAGE" else [known.columns[1]]
            gone = merge.vanished(known.select(*[F.col(c).alias(k) for c, k in zip(columns, keys, strict=True)]), copies[name], keys)
            if not gone.isEmpty():
                raise RuntimeError(f"the compacted copy of {name} lost keys that the lake holds")
    before, after = high_waters(tables), high_waters(copies)
    if before != after:
        raise RuntimeError(f"high-water marks changed from {before} to {after}")


def rebase(spark: SparkSession, archive: str, lake: str) -> str:
    """Point the workspace's checkpoint at ``archive``, a copy of the same newest rows; returns its
    signature.  The copy is proven against the lake first; ``successful_run_id`` stays."""
    report = validate(spark, archive, lake)
    differs = ("natural_keys_match", "latest_timestamp_matches", "checkpoint_run_succeeded")
    counted = ("raw_json_mismatch_count", "source_chunk_mismatch_count", "source_invalid_json_count", "canonical_invalid_json_count", "canonical_duplicate_key_count")
    if not all(report[x] for x in differs) or any(report[x] for x in counted):
        raise ContinuityError("the copy differs from the lake; the checkpoint stays")
    tables, workspace_id = open_archive(spark, archive)
    try:
        seq = L.current(spark, lake)[workspace_id][0]
        marks = high_waters(tables)
        held = lineage_of(tables, marks["chunk_high_water"])
    finally:
        close(tables)
    mark = signature(held)
    now = datetime.now(UTC).replace(tzinfo=None)
    new = {"source_fingerprint": file_fingerprint(spark, archive), "lineage_signature": mark, "lineage_manifest_json": json.dumps(held), "checkpointed_at": now, **marks}
    kinds = {f.name: f.dataType for f in schemas.struct(schemas.LAKE_DDL["ingestion_checkpoints"]).fields}
    point = L.read(spark, lake, "ingestion_checkpoints", workspace_id).withColumns({c: F.lit(v).cast(kinds[c]) for c, v in new.items()})
    L.publish(spark, lake, workspace_id, uuid.uuid4().hex, {"ingestion_checkpoints": point}, {}, since=seq)
    return mark
