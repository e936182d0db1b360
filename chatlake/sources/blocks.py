"""Workspace blocks of settings text, as a relational parse.

Each line becomes an assignment with a value or a problem; a running count of the opening key numbers the
blocks.  Secret values are reduced to their digest before they leave the parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatlake.functions import scalars as S

# A block's keys, the first opens it; the settings that may stand anywhere; the secret ones.
FIELDS = ("WORKSPACE", "CHANNEL_URL", "SLACK_TOKEN", "SLACK_COOKIE")
SECRET = ("SLACK_TOKEN", "SLACK_COOKIE")
LINE = "file string, line_no int, line string"


def unescaped(body: Column) -> Column:
    """What stands between double quotes, read once from left to right."""
    named = F.create_map(*map(F.lit, ("\\n", "\n", "\\r", "\r", "\\t", "\t")))
    piece = lambda x: F.when(x.startswith("\\"), F.coalesce(F.try_element_at(named, x), F.substring(x, 2, 1))).otherwise(x)
    return F.array_join(F.transform(F.regexp_extract_all(body, F.lit(r"(?s)\\.|[^\\]+"), F.lit(0)), piece), "")


def assigned(line: Column) -> Column:
    """(key, value, problem) of a line that is neither blank nor a comment."""
    text = S.strip(line)
    key = F.regexp_replace(S.strip(F.split_part(text, F.lit("="), F.lit(1))), r"^export\s+", "")
    rest = S.strip(F.substr(text, F.instr(text, "=") + 1))
    mark = F.left(rest, F.lit(1))
    double = F.regexp_extract(rest, r'(?s)^"((?:[^"\\]|\\.)*)"', 1)
    closed = F.when(mark == '"', F.regexp_extract(rest, r'(?s)^"(?:[^"\\]|\\.)*"', 0)).otherwise(F.regexp_extract(rest, r"(?s)^'[^']*'", 0))
    behind = S.strip(F.substr(rest, F.length(closed) + 1))
    quoted = mark.isin('"', "'")
    value = F.when(mark == '"', unescaped(double)).when(mark == "'", F.substr(closed, F.lit(2), F.length(closed) - 2)).otherwise(F.rtrim(F.regexp_replace(rest, r"(?s)\s+#.*$", "")))
    problem = (
        F.when(~(text.contains("=") & key.rlike(r"^[A-Za-z_]\w*\z")), "invalid assignment")
        .when(quoted & (closed == ""), "unterminated value")
        .when(quoted & (behind != "") & ~behind.startswith("#"), "text after value")
    )
    return F.struct(F.when(problem.isNull() | (problem != "invalid assignment"), key).alias("key"), F.when(problem.isNull(), value).alias("value"), problem.alias("problem"))


def parse_lines(lines: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(file, line_no, block, key, value, problem) of (file, line_no, line): every assignment to one of ``fields``,
    and every line that is no assignment.  ``fields[0]`` opens a block."""
    text = S.strip(F.col("line"))
    read = lines.filter((text != "") & ~text.startswith("#")).select("file", "line_no", assigned(F.col("line")).alias("a")).select("file", "line_no", "a.*")
    known = read.filter(F.col("key").isNull() | F.col("key").isin(*fields))
    order = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    placed = known.withColumn("block", F.sum(F.when(F.col("key") == fields[0], 1).otherwise(0)).over(order))
    again = F.row_number().over(Window.partitionBy("file", "block", "key").orderBy("line_no")) > 1
    problem = F.coalesce("problem", F.when(F.col("key").isNotNull() & (F.col("block") == 0), "before the first block"), F.when(F.col("key").isNotNull() & again, "duplicate key"))
    return placed.select("file", "line_no", "block", "key", "value", problem.alias("problem"))


def problems(lines: DataFrame, fields: tuple[str, ...] = FIELDS, domain: str = ".slack.com") -> DataFrame:
    """(file, block, line_no, key, problem): the lines' own, missing or invalid values, repeated workspaces."""
    parsed = parse_lines(lines, fields)
    own = parsed.filter(F.col("problem").isNotNull()).select("file", "block", "line_no", "key", "problem")
    good = parsed.filter(F.col("problem").isNull() & (F.col("block") > 0))
    held = good.groupBy("file", "block").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("v"), F.min("line_no").alias("line_no"))
    each = held.select("file", "block", "line_no", F.explode(F.array(*map(F.lit, fields))).alias("key"), "v").withColumn("value", F.try_element_at("v", F.col("key")))
    place = {f: F.col("key") == f for f in fields}
    invalid = (
        F.when(F.coalesce("value", F.lit("")) == "", "missing")
        .when(place[fields[0]] & ~S.workspace_id_ok(S.strip(F.col("value"))), "invalid workspace")
        .when(place[fields[1]] & ~(S.url_text_ok(S.strip(F.col("value"))) & S.site_url_ok(S.strip(F.col("value")), domain)), "invalid address")
        .when((place[fields[2]] | place[fields[3]]) & ~S.secret_ok(F.col("value")), "white space in a secret")
    )
    bad = each.select("file", "block", "line_no", "key", invalid.alias("problem")).filter(F.col("problem").isNotNull())
    twice = F.row_number().over(Window.partitionBy("file", S.folded(S.strip(F.col("value")))).orderBy("block")) > 1
    repeated = good.filter(F.col("key") == fields[0]).select("file", "block", "line_no", "key", F.when(twice, "duplicate workspace").alias("problem")).filter(F.col("problem").isNotNull())
    return own.unionByName(bad).unionByName(repeated)


def parse_blocks(lines: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(file, block, key, value) with secrets as digests.

    A file is taken or refused whole: any line's own problem, a missing or invalid value, a repeated workspace or no
    block at all raises, with the first place.
    """
    place = F.concat(F.col("problem"), F.coalesce(F.concat(F.lit(" ("), "key", F.lit(")")), F.lit("")), F.lit(" at line "), F.col("line_no").cast("string"))
    first = problems(lines, fields).groupBy("file").agg(F.min_by(place, F.struct("line_no", "problem")).alias("why"))
    held = lines.select("file").distinct().join(first, "file", "left").join(parse_lines(lines, fields), "file", "left")
    why = F.coalesce("why", F.when(F.col("block").isNull(), "no workspace block"))
    shown = F.when(F.col("key").isin(*SECRET), F.concat(F.lit("sha256:"), F.sha2("value", 256))).otherwise(F.col("value"))
    value = F.when(why.isNotNull(), F.raise_error(F.concat(why, F.lit(" of "), "file")).cast("string")).otherwise(shown)
    return held.select("file", "block", "key", value.alias("value"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``parse_blocks`` of files; a file is one small text."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    return parse_blocks(whole)


def select_workspace(workspaces: DataFrame, selector: Column, id_col: str = "workspace_id") -> DataFrame:
    """The rows whose id equals the selector in any case (``Straße`` is ``STRASSE``); raises if none or several ids do.

    The check is one row beside the rows, so it stays part of the plan.
    """
    marked = workspaces.withColumn("__hit", S.folded(F.col(id_col)) == S.folded(S.strip(selector)))
    seen = marked.agg(F.count_distinct(F.when(F.col("__hit"), F.col(id_col))).alias("__n"), F.array_join(F.slice(F.array_sort(F.collect_set(F.when(F.col("__hit"), F.col(id_col)))), 1, 5), ", ").alias("__ids"))
    message = F.when(F.col("__n") == 0, "no workspace has the selected id").otherwise(F.concat(F.lit("the selector is ambiguous: "), "__ids"))
    checked = seen.select(F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")).alias("__one"))
    return checked.join(marked.filter("__hit"), F.col("__one") == F.col("__hit"), "left").filter("__one").select(*workspaces.columns)
