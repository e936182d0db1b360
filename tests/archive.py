"""Small archives made by hand."""

import json
import sqlite3

from chatlake import schemas

SQL_TYPES = {"bigint": "INTEGER", "string": "TEXT", "binary": "BLOB"}


def blob(**x) -> bytes:
    return json.dumps(x, ensure_ascii=False).encode()


def create(path) -> sqlite3.Connection:
    db = sqlite3.connect(path)
    for name, ddl in schemas.ARCHIVE_DDL.items():
        cols = ", ".join(f"{c} {SQL_TYPES[t]}" for c, t in (x.split() for x in ddl.split(", ")))
        db.execute(f'CREATE TABLE "{name}" ({cols})')
    return db


def insert(db, table, **values):
    names = ", ".join(values)
    db.execute(f'INSERT INTO "{table}" ({names}) VALUES ({", ".join("?" * len(values))})', list(values.values()))


PARENT, REPLY, GONE, LATER = "1651000100.000100", "1651000160.000250", "1651000220.000300", "1651000300.000400"


def id_of(ts):
    return int(ts.replace(".", ""))


def fixture_a(path, workspace="T1", label="alpha"):
    """Four observations of three messages: an edited parent with a file, a reply, a deleted one."""
    db = create(path)
    insert(db, "WORKSPACE", ID=1, CHUNK_ID=1, TEAM=label, TEAM_ID=workspace, URL="https://x.slack.com", ENTERPRISE_ID=None, DATA=blob(team=label))
    insert(db, "CHANNEL", ID="C_GARDEN", CHUNK_ID=2, NAME="", IDX=0, DATA=blob(name="general", is_private=False, topic={"value": "t"}))
    insert(db, "S_USER", ID="U_ROSE", CHUNK_ID=3, USERNAME="ann", IDX=0, DATA=blob(name="ann", profile={"real_name": "Ann", "display_name": "A"}, is_bot=False))
    insert(db, "CHANNEL_USER", CHANNEL_ID="C_GARDEN", USER_ID="U_ROSE", CHUNK_ID=4, IDX=0)
    old = blob(type="message", user="U_ROSE", text=f"old {label}", ts=PARENT, thread_ts=PARENT, reply_count=1)
    new = blob(
        type="message", user="U_ROSE", text=f"new {label}", ts=PARENT, thread_ts=PARENT, reply_count=1, edited={"ts": "1651000101.5"}, reactions=[{"name": "wave", "users": ["U_ROSE"], "count": 1}],
        files=[{"id": "F_PLAN", "name": f"{label}.txt", "size": 12, "mode": "hosted", "mimetype": "text/plain", "title": "Plan é", "shares": {"public": [1, None]}}],
    )
    msg = {"CHANNEL_ID": "C_GARDEN", "IDX": 0, "NUM_FILES": 0}
    insert(db, "MESSAGE", ID=id_of(PARENT), CHUNK_ID=10, TS=PARENT, THREAD_TS=PARENT, IS_PARENT=1, TXT=f"old {label}", DATA=old, **msg)
    insert(db, "MESSAGE", ID=id_of(PARENT), CHUNK_ID=11, TS=PARENT, THREAD_TS=PARENT, IS_PARENT=1, TXT=f"new {label}", DATA=new, **msg)
    insert(db, "MESSAGE", ID=id_of(REPLY), CHUNK_ID=12, TS=REPLY, THREAD_TS=PARENT, IS_PARENT=0, TXT="a reply", DATA=blob(user="U_ROSE", text="a reply", thread_ts=PARENT), **msg)
    insert(db, "MESSAGE", ID=id_of(GONE), CHUNK_ID=13, TS=GONE, THREAD_TS=None, IS_PARENT=0, TXT="", DATA=blob(subtype="message_deleted", deleted_ts=GONE), **msg)
    insert(db, "SESSION", ID=1, FINISHED=1)
    insert(db, "CHUNK", ID=13, SESSION_ID=1, TYPE_ID=0, FINAL=1, CHANNEL_ID="C_GARDEN")
    db.commit()
    return db


def append(db, chunk=20, session=2, ts=LATER, text="later"):
    insert(db, "SESSION", ID=session, FINISHED=1)
    insert(db, "CHUNK", ID=chunk, SESSION_ID=session, TYPE_ID=0, FINAL=1, CHANNEL_ID="C_GARDEN")
    insert(db, "MESSAGE", ID=id_of(ts), CHUNK_ID=chunk, CHANNEL_ID="C_GARDEN", TS=ts, THREAD_TS=None, IS_PARENT=0, IDX=0, NUM_FILES=0, TXT=text, DATA=blob(user="U_ROSE", text=text))
    db.commit()
