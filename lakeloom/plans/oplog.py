"""Analytics on operational logs: usage, deletions, schedules, job addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import cron_text
from lakeloom.operators.filters import rows_in
from lakeloom.operators.rows import newest

# Words of the usage and audit logs.
SERVING_SKU, SERVING_TYPE = "inference", "FOUNDATION_MODEL"
JOB_SERVICE, DELETE_ACTION, EDIT_ACTIONS = "jobs", "deleteRun", ("create", "update")


def serving_usage(usage: DataFrame) -> DataFrame:
    """Usage rows of served foundation models."""
    return usage.filter(
        F.lower("sku_name").contains(SERVING_SKU)
        & (F.col("product_features.serving_type") == SERVING_TYPE)
    )


def deleted_runs(audit: DataFrame, timeline: DataFrame, job_id: object) -> DataFrame:
    """Who deleted runs of one job, newest first, with all columns of the audit rows."""
    runs = timeline.filter(F.col("job_id") == F.lit(job_id)).select("run_id").distinct()
    deletions = audit.filter(
        (F.lower("service_name") == JOB_SERVICE) & (F.col("action_name") == DELETE_ACTION)
    ).select(
        F.col("user_identity.email").alias("deleter"), F.col("request_params.run_id").alias("run_id"), "*"
    )
    return rows_in(deletions, runs, "run_id").orderBy(F.col("event_time").desc(), "run_id")


def latest_schedules(audit: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """The schedule in the newest settings of each job, with readable text; jobs without one are left out.

    The newest row is chosen first: a newer row without a schedule hides an older schedule.
    """
    edits = audit.filter(
        (F.col("service_name") == JOB_SERVICE) & F.col("action_name").isin(*EDIT_ACTIONS)
    ).select(
        F.col("request_params.job_id").alias("job_id"),
        "workspace_id",
        "event_time",
        F.col("user_identity.email").alias("email"),
        F.col("request_params.new_settings").alias("_settings"),
        *ties,
    )
    order = [F.col(c).desc() for c in ("event_time", *ties)]
    setting = lambda path, name: F.get_json_object("_settings", path).alias(name)
    schedules = newest(edits, ["job_id", "workspace_id"], order).select(
        "job_id",
        "workspace_id",
        "event_time",
        "email",
        setting("$.schedule", "cron_schedule"),
        setting("$.schedule.quartz_cron_expression", "quartz_cron_expression"),
        setting("$.schedule.timezone_id", "timezone_id"),
        setting("$.schedule.pause_status", "pause_status"),
        setting("$.name", "job_name"),
    )
    return schedules.filter(F.col("cron_schedule").isNotNull()).withColumn(
        "human_readable", cron_text(F.col("quartz_cron_expression"))
    )


def job_addresses(jobs: DataFrame, workspaces: DataFrame, pattern: str) -> DataFrame:
    """Address of every job in the listed workspaces; ``pattern`` finds the workspace id in an address."""
    known = workspaces.select(
        "workspace_url", F.regexp_extract("workspace_url", pattern, 1).alias("workspace_id")
    )
    return jobs.join(known, "workspace_id").withColumn(
        "job_url", F.concat("workspace_url", F.lit("jobs/"), F.col("job_id").cast("string"))
    )
