"""Column functions; all but ``number_text`` stay inside the JVM."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What Python's str.strip() removes besides Unicode spaces.
EDGE = r"[\s\u001c-\u001f\u0085   -     　]+"


def or_else(*columns: Column) -> Column:
    """First string that is neither null nor empty, else the last one."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns[:-1]], columns[-1])


def nonzero(column: Column, other: Column) -> Column:
    """The number unless it is null or 0, else the other."""
    return F.coalesce(F.nullif(column, F.lit(0)), other)


def stable_key(*parts: Column) -> Column:
    """SHA-256 over the parts joined with U+001F; null if a part is null."""
    whole = F.sha2(F.concat_ws("\x1f", *parts), 256)
    any_null = parts[0].isNull()
    for p in parts[1:]:
        any_null = any_null | p.isNull()
    return F.when(~any_null, whole)


def ts_us(ts: Column) -> Column:
    """Microseconds of ``seconds[.fraction]``; raises on anything else."""
    good = ts.rlike(r"^[0-9]+(\.[0-9]+)?$")
    whole = F.split_part(ts, F.lit("."), F.lit(1)).cast("long") * 1_000_000
    part = F.rpad(F.split_part(ts, F.lit("."), F.lit(2)), 6, "0").cast("long")
    return F.when(ts.isNull(), None).when(good, whole + part).otherwise(F.raise_error(F.concat(F.lit("Invalid message timestamp: "), ts)).cast("long"))


def id_to_ts(value: Column) -> Column:
    """An integer of microseconds as ``seconds.6digits``."""
    digits = F.lpad(value.cast("string"), F.greatest(F.length(value.cast("string")), F.lit(7)), F.lit("0"))
    return F.concat(F.substring_index(F.regexp_replace(digits, r"([0-9]{6})$", ".$1"), ".", 1), F.lit("."), F.right(digits, F.lit(6)))


def strip(text: Column) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.regexp_replace(text, f"^{EDGE}|{EDGE}$", "")


def is_json_object(text: Column) -> Column:
    """Whether the text parses as a JSON object; false for null."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def folded(text: Column) -> Column:
    """The text without case, letters that grow included: ``Straße`` is ``STRASSE``.

    Spark's collations that ignore case keep these apart, those that don't lose accents too; the empty text between the
    two keeps them from being read as one.
    """
    return F.lower(F.concat(F.upper(text), F.lit("")))


def slug(text: Column) -> Column:
    """Lower case with runs of other characters as one underscore; a leading digit gets a prefix.  Raises if nothing is left."""
    plain = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))
    empty = F.raise_error(F.concat(F.lit("no letter or digit in "), text)).cast("string")
    return F.when(plain == "", empty).when(plain.rlike("^[0-9]"), F.concat(F.lit("workspace_"), plain)).otherwise(plain)


def safe_filename(name: Column) -> Column:
    """A file name without unsafe characters, reserved names or a trailing dot or space."""
    safe = F.regexp_replace(F.regexp_replace(name, r'[<>:"/\\|?*]', "_"), r"[ .]+\z", "")
    safe = F.coalesce(F.nullif(safe, F.lit("")), F.lit("unnamed_file"))
    return F.when(safe.rlike(r"(?i)^(con|prn|aux|nul|com[1-9]|lpt[1-9])(\.|$)"), F.concat(F.lit("_"), safe)).otherwise(safe)


#: A token, up to the next white space, quote or backslash.
TOKEN = r"""\bxox[a-zA-Z]-[^\s'"\\]+"""


def redact(text: Column, secrets: tuple[str, ...] = ()) -> Column:
    """Literal secrets, the longest first, and whole tokens replaced."""
    out = text
    for s in sorted(filter(None, secrets), key=len, reverse=True):
        out = F.replace(out, F.lit(s), F.lit("[REDACTED]"))
    return F.regexp_replace(out, TOKEN, "[REDACTED]")


def strip_ansi(text: Column) -> Column:
    """Without terminal control sequences."""
    return F.regexp_replace(text, r"\x1b\[[0-?]*[ -/]*[@-~]", "")


# The messages of failures that pass, and of refused credentials.
TRANSIENT = (
    "dial tcp", "lookup .*?(?:no such host|server misbehaving|temporary failure)", "server misbehaving", "no such host", "temporary failure in name resolution",
    "network (?:is )?unreachable", "connection (?:refused|reset|timed out)", "i/o timeout", "context deadline exceeded", "operation timed out",
    "TLS handshake timeout", "unexpected EOF", r"status code (?:502|503|504)\b", r"\b(?:502|503|504) (?:Bad Gateway|Service Unavailable|Gateway Timeout)\b",
)
REFUSED = ("invalid_auth", "not_authed", "account_inactive", "token_revoked", "invalid_cookie")


def failure_class(text: Column, action: Column | None = None) -> Column:
    """transient before authentication; an authentication action implies the latter.  Control sequences are ignored."""
    plain = strip_ansi(text)
    auth = plain.rlike(rf"(?i)\b(?:{'|'.join(REFUSED)})\b")
    if action is not None:
        auth = auth | F.coalesce(action == "authentication", F.lit(False))
    return F.when(plain.rlike(f"(?i){'|'.join(TRANSIENT)}"), "transient").when(auth, "authentication").otherwise("other")


def variance_class(mode: Column, mime: Column, expected: Column, served: Column, accepted: Column, tolerance: int = 64) -> Column:
    """match, snippet, documented or mismatch for an attachment on disk; missing without size."""
    delta = F.abs(served - expected)
    snippet = (mode == "snippet") & mime.startswith("text/") & (delta <= tolerance)
    return (
        F.when(served.isNull(), "missing")
        .when((F.coalesce(expected, F.lit(0)) <= 0) | (delta == 0), "match")
        .when(F.coalesce(snippet, F.lit(False)), "snippet")
        .when(F.coalesce(accepted == served, F.lit(False)), "documented")
        .otherwise("mismatch")
    )


def lag_seconds(later: Column, earlier: Column) -> Column:
    """The non-negative difference, null if either is missing."""
    return F.when(later.isNotNull() & earlier.isNotNull(), F.greatest(F.lit(0.0), later - earlier))


def regressed(value: Column, checkpoint: Column) -> Column:
    """Whether a high-water mark fell behind its checkpoint; a missing one did."""
    return F.when(checkpoint.isNull(), False).otherwise(F.coalesce(value < checkpoint, F.lit(True)))


def label_value(text: Column) -> Column:
    """A metric label with backslash, quote and newline escaped."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), '"', r'\\"'), "\n", r"\\n")


def path_label(text: Column) -> Column:
    """URL-safe base64 of a grouping label; a lone = for an empty one."""
    return F.coalesce(F.nullif(F.translate(F.base64(F.encode(text, "UTF-8")), "+/\r\n", "-_"), F.lit("")), F.lit("="))


@F.arrow_udf(T.StringType())
def _fifteen_digits(values: pa.Array) -> pa.Array:
    return pa.array([None if x is None else format(x, ".15g") for x in values.to_pylist()], pa.string())


def number_text(value: Column) -> Column:
    """A number with 15 significant digits at most, as the exposition format shows it.

    Python rounds the double's exact value. Java's formats round the shortest decimal that stands for it, a second
    rounding: 40/9 is 4.444444444444445 there and then ends in 5.
    """
    return _fifteen_digits(value.cast("double"))


def parsed_list(text: Column) -> Column:
    """Comma list: trimmed, without case, without empties, distinct in order."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ","), lambda x: folded(F.trim(x))), lambda x: x != ""))


def workspace_id_ok(text: Column) -> Column:
    """Non-empty, at most 64, no control characters, separators, leading dot or white space at an edge."""
    return F.coalesce(text.rlike(r"^[^\x00-\x1f\x7f/\\]{1,64}\z") & ~text.startswith(".") & (strip(text) == text), F.lit(False))


def secret_ok(text: Column) -> Column:
    """Neither white space, Unicode's included, nor delete characters."""
    return F.coalesce(~text.rlike(f"{EDGE}|\\x7f"), F.lit(False))


def url_text_ok(text: Column) -> Column:
    """No control characters."""
    return F.coalesce(~text.rlike(r"[\x00-\x1f\x7f]"), F.lit(False))


def inside(path: Column, root: str) -> Column:
    """Whether a normal path lies under the root: no step up, no empty or dot step behind it."""
    rest = F.substring(path, len(root.rstrip("/")) + 2, 1 << 20)
    return F.coalesce(path.startswith(root.rstrip("/") + "/") & ~F.concat(F.lit("/"), rest, F.lit("/")).rlike(r"/\.{0,2}/"), F.lit(False))


def json_true(value: Column, path: str) -> Column:
    """Whether the JSON value at the path is true in the sense of not being null, false, 0 or empty."""
    shown = F.to_json(F.try_variant_get(value, path, "variant"))
    return F.coalesce(~shown.isin("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}"), F.lit(False))


def site_url_ok(url: Column, domain: str = ".slack.com") -> Column:
    """https, a host under the domain, and neither user, password nor port."""
    host = F.try_parse_url(url, F.lit("HOST"))
    plain = (F.try_parse_url(url, F.lit("PROTOCOL")) == "https") & host.endswith(domain) & (F.try_parse_url(url, F.lit("AUTHORITY")) == host)
    return F.coalesce(plain, F.lit(False))
