"""Archive rows to the lake's records: JSON payloads into typed columns, by expressions only.

A payload is walked as a variant, an array element by element: a file or reaction of an odd shape loses itself, not
its message's others, and each value counts by its own truth (``deleted: 1`` is deleted, ``edited: {}`` isn't edited).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions import payloads as P
from chatlake.functions import scalars as S
from chatlake.operators.newest import membership_snapshot, newest_rows


def newest_order() -> list[Column]:
    return [F.col(c).desc() for c in ("CHUNK_ID", "IDX", "rowid")]


def payload(df: DataFrame, context: Column) -> DataFrame:
    """``df`` with raw_json (strict UTF-8) and v, the payload as a variant; refuses what isn't an object."""
    raw = F.decode("DATA", "UTF-8")
    bad = F.raise_error(F.concat(F.lit("Expected a JSON object in "), context)).cast("string")
    checked = df.withColumn("raw_json", F.when(S.is_json_object(raw), raw).otherwise(bad))
    return checked.withColumn("v", F.try_parse_json("raw_json"))


def workspace(df: DataFrame) -> DataFrame:
    """The newest workspace row."""
    top = df.orderBy(F.col("CHUNK_ID").desc(), F.col("ID").desc()).limit(1)
    return top.select(
        F.col("TEAM_ID").alias("workspace_id"), F.col("TEAM").alias("team_name"), F.col("URL").alias("workspace_url"), F.col("ENTERPRISE_ID").alias("enterprise_id"),
        F.decode("DATA", "UTF-8").alias("raw_json"), F.col("CHUNK_ID").alias("source_chunk_id"),
    )


def channels(df: DataFrame) -> DataFrame:
    rows, v = payload(newest_rows(df, ["ID"], newest_order()), F.concat(F.lit("CHANNEL "), "ID")), F.col("v")
    return rows.select(
        F.col("ID").alias("channel_id"), S.or_else(F.col("NAME"), P.text(v, "name")).alias("name"), P.true(v, "is_private").alias("is_private"), P.true(v, "is_archived").alias("is_archived"),
        P.text(v, "topic", "value").alias("topic"), P.text(v, "purpose", "value").alias("purpose"), "raw_json", F.col("CHUNK_ID").alias("source_chunk_id"),
    )


def users(df: DataFrame) -> DataFrame:
    rows, v = payload(newest_rows(df, ["ID"], newest_order()), F.concat(F.lit("S_USER "), "ID")), F.col("v")
    profile = F.when(P.is_object(P.member(v, "profile")), P.sorted_json(F.get_json_object("raw_json", "$.profile"))).otherwise("{}")
    return rows.select(
        F.col("ID").alias("user_id"), S.or_else(F.col("USERNAME"), P.text(v, "name")).alias("username"), P.first_true(P.member(v, "real_name"), P.member(v, "profile", "real_name")).alias("real_name"),
        P.text(v, "profile", "display_name").alias("display_name"), P.true(v, "is_bot").alias("is_bot"), P.true(v, "deleted").alias("is_deleted"), P.true(v, "is_restricted").alias("is_restricted"),
        profile.alias("profile_json"), "raw_json", F.col("CHUNK_ID").alias("source_chunk_id"),
    )


def embedded_file(e: Column, raw: Column) -> Column:
    """What is kept of a file inside a message; its raw text too."""
    named = [P.text(e, c).alias(c) for c in ("id", "user", "mode", "name", "mimetype", "url_private_download", "url_private")]
    return F.struct(*named, P.number(e, "size").alias("size"), P.true(e, "is_external").alias("is_external"), raw.alias("raw"))


def embedded_reaction(e: Column) -> Column:
    users = F.transform(P.elements(e, "users"), lambda u: P.text(u))
    return F.struct(P.text(e, "name").alias("name"), users.alias("users"), P.number(e, "count").alias("count"))


def messages(df: DataFrame, workspace_id: Column) -> DataFrame:
    """Newest messages as records, with the embedded files and the reactions still nested."""
    rows, v = payload(newest_rows(df, ["CHANNEL_ID", "TS"], newest_order()), F.concat_ws(" ", F.lit("MESSAGE"), "CHANNEL_ID", "TS")), F.col("v")
    inner = P.is_object(P.member(v, "message"))
    listed = F.when(inner, F.get_json_object("raw_json", "$.message.files")).otherwise(F.get_json_object("raw_json", "$.files"))
    rows = rows.withColumn("e", F.when(inner, P.member(v, "message")).otherwise(v)).withColumn("listed", P.sorted_json(listed))
    e = F.col("e")
    text = F.coalesce("TXT", P.text(e, "text"), F.lit(""))
    thread = F.nullif(S.or_else(F.col("THREAD_TS"), P.text(e, "thread_ts")), F.lit(""))
    subtype = P.first_true(P.member(v, "subtype"), P.member(e, "subtype"))
    is_reply = F.coalesce(thread != F.col("TS"), F.lit(False))
    yes = lambda c: F.coalesce(c, F.lit(False))
    deleted = yes(subtype.isin("message_deleted", "tombstone")) | P.true(v, "deleted_ts") | P.true(e, "deleted")
    parent = yes(F.col("IS_PARENT") != 0) | (yes(thread == F.col("TS")) & P.true(e, "reply_count"))
    edited = P.is_object(P.member(e, "edited"))
    whole = P.elements(F.try_parse_json("listed"))
    raws = F.from_json("listed", "array<string>")  # each element's own text
    files = F.filter(F.transform(whole, lambda f, i: F.when(P.is_object(f) & P.true(f, "id"), embedded_file(f, F.get(raws, i)))), lambda f: f.isNotNull())
    reacted = F.filter(F.transform(P.elements(e, "reactions"), lambda r: F.when(P.is_object(r) & P.true(r, "name"), embedded_reaction(r))), lambda r: r.isNotNull())
    return rows.select(
        S.stable_key(workspace_id, F.col("CHANNEL_ID"), F.col("TS")).alias("message_key"), F.col("CHANNEL_ID").alias("channel_id"), F.col("TS").alias("ts"), S.ts_us(F.col("TS")).alias("ts_us"),
        F.col("ID").alias("source_message_id"), F.col("CHUNK_ID").alias("source_chunk_id"), P.first_true(P.member(e, "user"), P.member(v, "user")).alias("user_id"), subtype.alias("subtype"),
        text.alias("text"), F.when(deleted, "").otherwise(S.strip(text)).alias("search_text"), thread.alias("thread_ts"), F.when(is_reply, thread).alias("parent_ts"),
        S.or_else(F.col("LATEST_REPLY"), P.text(e, "latest_reply")).alias("latest_reply_ts"), parent.alias("is_thread_parent"), is_reply.alias("is_thread_reply"),
        yes(subtype == "thread_broadcast").alias("is_thread_broadcast"), ((edited & P.true(e, "edited")) | yes(subtype == "message_changed")).alias("is_edited"), F.when(edited, P.text(e, "edited", "ts")).alias("edited_ts"),
        deleted.alias("is_deleted"), P.first_true(P.member(v, "deleted_ts"), P.member(e, "deleted_ts")).alias("deleted_ts"), F.when(F.size(whole) > 0, F.col("listed")).alias("file_metadata_json"), "raw_json",
        F.sha2("raw_json", 256).alias("payload_hash"), files.alias("embedded_files"), reacted.alias("embedded_reactions"),
    )


def reactions(records: DataFrame) -> DataFrame:
    """One row for each message, emoji and user; repeats count once."""
    each = records.select("channel_id", F.col("ts").alias("message_ts"), F.explode("embedded_reactions").alias("r"))
    return each.select("channel_id", "message_ts", F.col("r.name").alias("emoji_name"), F.explode("r.users").alias("user_id"), F.col("r.count").alias("reported_count")).dropDuplicates(["channel_id", "message_ts", "emoji_name", "user_id"])


def files(df: DataFrame, records: DataFrame) -> DataFrame:
    """File rows, then the files that only messages mention; the table wins."""
    rows, v = payload(newest_rows(df, ["ID"], newest_order()), F.concat(F.lit("FILE "), "ID")), F.col("v")
    by_id = records.groupBy(F.col("source_message_id").alias("m_id")).agg(F.max("ts").alias("m_ts"))
    own = rows.join(by_id, rows["MESSAGE_ID"] == by_id["m_id"], "left").select(
        F.col("ID").alias("file_id"), F.col("CHANNEL_ID").alias("channel_id"), F.coalesce("m_ts", S.id_to_ts(F.col("MESSAGE_ID"))).alias("message_ts"), S.id_to_ts(F.col("THREAD_ID")).alias("thread_ts"),
        P.text(v, "user").alias("user_id"), S.or_else(F.col("MODE"), P.text(v, "mode")).alias("mode"), S.or_else(F.col("FILENAME"), P.text(v, "name")).alias("filename"), P.text(v, "mimetype").alias("mime_type"),
        S.nonzero(F.col("SIZE"), P.number(v, "size")).alias("size_bytes"), S.or_else(F.col("URL"), P.first_true(P.member(v, "url_private_download"), P.member(v, "url_private"))).alias("source_url"), "raw_json", F.col("CHUNK_ID").alias("source_chunk_id"),
    )
    embedded = records.select("channel_id", "ts", "ts_us", "thread_ts", "source_chunk_id", F.explode("embedded_files").alias("f"))
    firsts = newest_rows(embedded.withColumn("file_id", F.col("f.id")), ["file_id"], [F.col("ts_us"), F.col("channel_id")])
    mentioned = firsts.select(
        "file_id", "channel_id", F.col("ts").alias("message_ts"), "thread_ts", F.col("f.user").alias("user_id"), F.col("f.mode").alias("mode"), F.col("f.name").alias("filename"), F.col("f.mimetype").alias("mime_type"),
        F.col("f.size").alias("size_bytes"), S.or_else(F.col("f.url_private_download"), F.col("f.url_private")).alias("source_url"), F.col("f.raw").alias("raw_json"), "source_chunk_id",
    )
    return own.unionByName(mentioned.join(own.select("file_id"), "file_id", "left_anti"))


def members(df: DataFrame) -> DataFrame:
    latest = membership_snapshot(df, "CHANNEL_ID", "USER_ID", "CHUNK_ID")
    return latest.select(F.col("CHANNEL_ID").alias("channel_id"), F.col("USER_ID").alias("user_id"), F.col("CHUNK_ID").alias("source_chunk_id"))
