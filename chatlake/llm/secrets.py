"""Secret scan with multipart credential linking.

A per-text scan finds the parts of credentials with their code-point spans: strong ones (assignments
to a secret's name, access identifiers, long hex runs), and weak candidates (login names, key-like
values, endpoints) which alone mean nothing.  The weak candidates of all documents are then
interval-joined with the parts that complement them: two parts are linked if at most ``scope`` code
points lie between them, in the same document.  A weak candidate is reported only if linked:

    login name    with a secret
    key-like      with an access identifier, a login name or an endpoint
    endpoint      with a secret

where a secret is an assignment, a hex run or a key-like value.  The join is a sort-merge one on the
documents' parts: over the parts in order of start, the running end of the earlier parts of a role
and the running start of the later ones give the nearest neighbour, so no pairs are listed and the
work is linear in the parts.  Only documents with a weak candidate and another part are shuffled.

Defined cases
* null text counts as empty; texts without parts give zero counts and an empty span list.
* the strong spans never depend on the linking; a weak candidate that overlaps one is not a part.
* rows with the same doc_id and text have the same spans and are each returned; a null doc_id is an
  id like any other.  Equal starts are ordered by kind as listed in ``KINDS``.
* very long texts are scanned whole.  Only the two named columns are read, so other columns, clashing names
  included, don't matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.session import checkpointed, ship

KINDS = ("assign", "access", "hex", "login", "key", "endpoint")
SCOPE = 200
PARTS = T.ArrayType(T.StructType([T.StructField(x, T.IntegerType()) for x in ("start", "kind", "end")]))

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the same as runs of 32 and more: a run is tried from its first character
LOGIN = re.compile(r"""(?<![A-Za-z0-9_])(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", re.I | re.A)
KEY = re.compile(r"""(?<![A-Za-z0-9_])(?:key|pwd|pass|auth|private_?key|credential)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}""", re.I | re.A)
BARE_KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[A-Z0-9+/_=-]*[a-z])(?=[a-z0-9+/_=-]*[A-Z])[A-Za-z0-9+/_=-]{20,}")
ENDPOINT = re.compile(r"""(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp|ssh)://[^\s"'<>]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?(?![0-9.])""", re.A)
NAMES = ("passw", "secret", "token", "api")


def parts_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of a text's parts, in order."""
    strong = []
    named = ":" in text or "=" in text
    if named:
        low = text.lower()
        if any(x in low for x in NAMES):
            strong += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        strong += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    strong += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    weak = []
    if named:
        weak += [(m.start(), 3, m.end()) for m in LOGIN.finditer(text)] + [(m.start(), 4, m.end()) for m in KEY.finditer(text)]
    weak += [(m.start(), 4, m.end()) for m in BARE_KEY.finditer(text)]
    if "://" in text or text.count(".") > 2:
        weak += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    out, end = sorted(strong), -1
    taken = sorted((s, e) for s, _, e in strong)
    at = 0
    for start, kind, stop in sorted(weak):  # those that overlap no strong part and no earlier weak one
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if start >= end and not (at < len(taken) and taken[at][0] < stop):
            out.append((start, kind, stop))
            end = stop
    return sorted(out)


@F.arrow_udf(PARTS)
def scan(texts: pa.Array) -> pa.Array:
    found = [parts_of(t or "") for t in texts.to_pylist()]
    flat = np.array([x for parts in found for x in parts], np.int32).reshape(-1, 3)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "kind", "end"]))


def shown(parts: Column) -> Column:
    """kind:start:end of each part, joined with commas."""
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    return F.array_join(F.transform(parts, lambda x: F.concat_ws(":", name(x), x["start"], x["end"])), ",")


def linked_parts(parts: DataFrame, keys: list[str], scope: int = SCOPE) -> DataFrame:
    """Of ``parts`` (keys, start, kind, end), the weak ones with a complement within ``scope``."""
    secret, name, place = F.col("kind").isin(0, 2, 4), F.col("kind").isin(1, 3), F.col("kind") == 5
    order = Window.partitionBy(*keys).orderBy("start", "kind", "end")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)

    def near(role: Column) -> Column:
        gap = F.least(F.col("start") - F.max(F.when(role, F.col("end"))).over(before), F.min(F.when(role, F.col("start"))).over(after) - F.col("end"))
        return F.coalesce(gap <= scope, F.lit(False))

    seen = parts.withColumns({"by_secret": near(secret), "by_name": near(name), "by_place": near(place)})
    return seen.filter(F.col("kind").isin(3, 5) & F.col("by_secret") | (F.col("kind") == 4) & (F.col("by_name") | F.col("by_place"))).select(*keys, "start", "kind", "end")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id, base (the strong parts) and parts (those and the linked weak candidates) of each row."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    scanned = checkpointed(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(17), text).alias("t2"), scan(text).alias("found")))
    base = F.filter("found", lambda x: x["kind"] < 3)
    keys = ["doc_id", "t1", "t2"]
    pieces = scanned.filter((F.size("found") > 1) & F.exists("found", lambda x: x["kind"] > 2)).select(*keys, F.inline("found")).distinct()
    linked = linked_parts(pieces, keys, scope).groupBy(*keys).agg(F.collect_list(F.struct("start", "kind", "end")).alias("weak"))
    linked = linked.select(F.col("doc_id").alias("l_id"), F.col("t1").alias("l1"), F.col("t2").alias("l2"), "weak")
    met = scanned.join(linked, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("t1") == F.col("l1")) & (F.col("t2") == F.col("l2")), "left")
    every = F.when(F.col("weak").isNull(), base).otherwise(F.array_sort(F.concat(base, F.col("weak"))))
    return met.select("doc_id", base.alias("base"), every.alias("parts"))
