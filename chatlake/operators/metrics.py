"""Run metrics as text exposition lines, one row a line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.functions import scalars as S
from chatlake.session import ship

# The gauges of a run, in the order in which they are shown.
GAUGES = (
    "run_success", "last_success_timestamp_seconds", "pipeline_completed_timestamp_seconds", "pipeline_completion_lag_seconds", "source_latest_message_timestamp_seconds",
    "canonical_latest_message_timestamp_seconds", "source_canonical_latest_message_lag_seconds", "source_row_count", "canonical_row_count", "rows_inserted", "rows_updated",
    "rows_deleted", "run_duration_seconds", "run_failures", "lock_wait_seconds", "archive_size_bytes", "attachment_backlog", "workspace_discovered", "workspace_materialized",
)


# What each gauge tells, in the same order.
HELP = (
    "Whether the last run succeeded.", "When a run last succeeded.", "When the pipeline completed.", "Seconds between completion and observation.", "Time of the archive's latest message.",
    "Time of the lake's latest message.", "Seconds by which the lake's latest message trails the archive's.", "Rows in the archive.", "Rows in the lake.", "Rows inserted by the run.", "Rows updated by the run.",
    "Rows deleted by the run.", "Duration of the run.", "Failures of the run.", "Seconds spent waiting for a lock.", "Size of the archive.", "Attachments still to be fetched.", "Whether the workspace was discovered.", "Whether the workspace was materialized.",
)


def exposition(rows: DataFrame, labels: list[str], gauges: list[str], prefix: str, keep: list[str] | None = None) -> DataFrame:
    """(place, metric, type, line, and columns to keep) for every gauge of every row that isn't null; labels escaped.

    ``place`` is the gauge's in the list; ``type`` is the line that stands once above a metric's lines.
    """
    ship(rows.sparkSession)
    shown = F.concat_ws(",", *[F.concat(F.lit(f'{c}="'), S.label_value(F.col(c).cast("string")), F.lit('"')) for c in labels])
    value = lambda i, g: F.struct(F.lit(i).alias("place"), F.lit(f"{prefix}_{g}").alias("metric"), F.col(g).cast("double").alias("value"))
    each = rows.select(*(keep or []), shown.alias("labels"), F.explode(F.array(*[value(i, g) for i, g in enumerate(gauges)])).alias("m")).filter(F.col("m.value").isNotNull())
    line = F.concat(F.col("m.metric"), F.lit("{"), "labels", F.lit("} "), S.number_text(F.col("m.value")))
    return each.select(*(keep or []), "m.place", "m.metric", F.concat(F.lit("# TYPE "), F.col("m.metric"), F.lit(" gauge")).alias("type"), line.alias("line"))


def problems(runs: DataFrame) -> DataFrame:
    """(workspace, stage, problem): run records that must not be shown.

    Labels are not empty and hold no NUL; times, counts and durations are finite and not negative (only times may be
    missing); a run is not observed before it is complete.
    """
    label = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) == "", f"{c} is empty").when(F.col(c).contains("\x00"), f"{c} holds a NUL")
    number = lambda c: F.col(c).cast("double")
    amiss = lambda c: F.when(F.isnan(number(c)) | (F.abs(number(c)) == float("inf")) | (number(c) < 0), f"{c} is negative or not finite")
    counted = ("source_row_count", "canonical_row_count", "rows_inserted", "rows_updated", "rows_deleted", "run_failures", "archive_size_bytes", "attachment_backlog", "run_duration_seconds", "lock_wait_seconds")
    times = ("pipeline_completed_at", "observed_at", "last_success_at", "source_latest_message_at", "canonical_latest_message_at")
    checks = [label("workspace"), label("stage"), *map(amiss, times + counted), *[F.when(F.col(c).isNull(), f"{c} is missing") for c in counted], F.when(F.col("observed_at") < F.col("pipeline_completed_at"), "observed_at precedes pipeline_completed_at")]
    return runs.select("workspace", "stage", F.explode(F.array_compact(F.array(*checks))).alias("problem"))


def run_gauges(runs: DataFrame) -> DataFrame:
    """``runs`` with the two derived gauges and the 19 names of ``GAUGES``.

    It has workspace, stage, run_succeeded, last_success_at, pipeline_completed_at, observed_at, source_latest_message_at,
    canonical_latest_message_at (seconds) and the other gauges by their names.
    """
    return runs.withColumns(
        {
            "run_success": F.col("run_succeeded").cast("int"), "last_success_timestamp_seconds": F.col("last_success_at"), "pipeline_completed_timestamp_seconds": F.col("pipeline_completed_at"),
            "pipeline_completion_lag_seconds": S.lag_seconds(F.col("observed_at"), F.col("pipeline_completed_at")), "source_latest_message_timestamp_seconds": F.col("source_latest_message_at"),
            "canonical_latest_message_timestamp_seconds": F.col("canonical_latest_message_at"),
            "source_canonical_latest_message_lag_seconds": S.lag_seconds(F.col("source_latest_message_at"), F.col("canonical_latest_message_at")),
            "workspace_discovered": F.col("workspace_discovered").cast("int"), "workspace_materialized": F.col("workspace_materialized").cast("int"),
        }
    )


def render(runs: DataFrame, prefix: str = "chatlake") -> DataFrame:
    """``exposition`` of runs with all their gauges."""
    return exposition(run_gauges(runs), ["workspace", "stage"], list(GAUGES), prefix)


def documents(runs: DataFrame, prefix: str = "chatlake", job: str = "chatlake") -> DataFrame:
    """(path, body): one exposition document for each workspace and stage, HELP and TYPE once above each gauge's line."""
    helped = F.create_map(*[x for g, h in zip(GAUGES, HELP, strict=True) for x in (F.lit(f"{prefix}_{g}"), F.lit(h))])
    part = lambda name, value: F.concat(F.lit(f"/{name}@base64/"), S.path_label(value))
    at = F.concat(F.lit("job@base64/"), S.path_label(F.lit(job)), part("workspace", F.col("workspace")), part("stage", F.col("stage")))
    gauges = run_gauges(runs).select(at.alias("path"), "workspace", "stage", *GAUGES)
    lines = exposition(gauges, ["workspace", "stage"], list(GAUGES), prefix, ["path"])
    text = F.concat(F.lit("# HELP "), "metric", F.lit(" "), F.try_element_at(helped, F.col("metric")), F.lit("\n"), "type", F.lit("\n"), "line", F.lit("\n"))
    listed = F.array_sort(F.collect_list(F.struct("place", text.alias("text"))))  # a line for each gauge at most
    return lines.groupBy("path").agg(F.array_join(F.transform(listed, lambda x: x["text"]), "").alias("body"))


def stale(known: DataFrame, active: DataFrame) -> DataFrame:
    """The documents (path) of workspaces that aren't active any more."""
    return known.select("path").distinct().join(active.select("path"), "path", "left_anti")
