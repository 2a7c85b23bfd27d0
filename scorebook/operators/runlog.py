"""Run accounting over append-only logs: latest states, statuses, counts, inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scorebook.operators.upsert import latest_by_key

SLOW_SECONDS = 600
NOT_RECORDED = "NOT_RECORDED"


# ------------------------------------------------------------ latest states


def latest_task_rows(audit: DataFrame, run_id: str | None = None) -> DataFrame:
    """Last audit row of each task (of one run, or per run)."""
    rows = audit if run_id is None else audit.where(F.col("run_id") == run_id)
    return latest_by_key(rows, ["run_id", "task_name"], [F.col("recorded_at").desc_nulls_last(), F.col("status").asc()])


def latest_progress(progress: DataFrame) -> DataFrame:
    """Last progress row of each item of each run and task."""
    order = [F.col("updated_at").desc_nulls_last(), F.col("processed_count").desc()]
    return latest_by_key(progress, ["run_id", "task_name", "current_item"], order)


def run_history(run_log: DataFrame) -> DataFrame:
    """Current state of each run from its open and close entries."""
    return latest_by_key(run_log, ["run_id"], [F.col("recorded_at").desc_nulls_last(), F.col("completed_at").desc_nulls_last()])


def diff_sources(manifest: DataFrame, observed: DataFrame) -> DataFrame:
    """Compare each observed source with its latest manifest row by etag and modification mark."""
    newest = latest_by_key(manifest, ["source_name"], [F.col("updated_at").desc_nulls_last(), F.col("etag").desc()])
    before = newest.select(
        "source_name",
        F.col("etag").alias("_etag"),
        F.col("last_modified").alias("_modified"),
        F.col("sha256").alias("_sha256"),
        F.lit(True).alias("_seen"),
    )
    same = F.col("etag").eqNullSafe(F.col("_etag")) & F.col("last_modified").eqNullSafe(F.col("_modified"))
    marked = F.col("etag").isNotNull() | F.col("last_modified").isNotNull()
    state = (
        F.when(F.col("_seen").isNull(), "new")
        .when(same & marked & F.col("_sha256").isNotNull(), "unchanged")
        .otherwise("changed")
    )
    return observed.join(before, "source_name", "left").withColumn("change", state).drop("_etag", "_modified", "_sha256", "_seen")


# ----------------------------------------------------------- loads, progress


def observe_load(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Count rows while they are written; the result is there once the write has finished."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("output_count"), *[c.alias(n) for n, c in counters.items()]), watch


def percent_complete(done: Column, total: Column, status: Column) -> Column:
    share = F.when(total == 0, F.lit(0.0)).otherwise(F.least(F.lit(100.0), F.try_divide(done * 100.0, total)))
    return F.when((total <= 0) & status.isin("SUCCEEDED", "SKIPPED"), F.lit(100.0)).otherwise(share)


def archive_progress(members: DataFrame, keys: Sequence[str] = ("zip_sha256", "zip_path")) -> DataFrame:
    """Members read and failed per archive, with the share done."""
    counted = members.groupBy(*keys).agg(
        F.count_if(F.col("extraction_status") == "extracted").alias("processed_count"),
        F.count("*").alias("total_count"),
        F.count_if(F.col("extraction_status") == "failed").alias("failed_count"),
    )
    status = F.when(F.col("failed_count") > 0, "FAILED").when(F.col("processed_count") < F.col("total_count"), "RUNNING").otherwise("SUCCEEDED")
    done = percent_complete(F.col("processed_count"), F.col("total_count"), F.col("status"))
    return counted.withColumn("status", status).withColumn("percent_complete", done)


# ------------------------------------------------------------------- status


def task_status(expected: DataFrame, audit: DataFrame, run_id: str | None = None) -> DataFrame:
    """Every expected task with its last audit row; tasks without one are NOT_RECORDED."""
    keys = ["task_name"] if run_id is not None else [c for c in ("run_id", "task_name") if c in expected.columns]
    last = latest_task_rows(audit, run_id)
    if "run_id" not in keys:
        last = last.drop("run_id")
    counts = ("input_count", "output_count", "inserted_count", "updated_count")
    zero = {name: 0 for name in (*counts, "duration_seconds") if name in last.columns}
    return expected.join(last, keys, "left").fillna({"status": NOT_RECORDED, **zero})


def run_status(tasks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """FAILED if any task failed, INCOMPLETE if any is missing, else SUCCEEDED."""
    any_task = lambda value: F.coalesce(F.bool_or(F.col("status") == value), F.lit(False))
    verdict = F.when(any_task("FAILED"), "FAILED").when(any_task(NOT_RECORDED), "INCOMPLETE").otherwise("SUCCEEDED")
    return tasks.groupBy(*by).agg(verdict.alias("run_status"))


def slow_tasks(tasks: DataFrame, limit_seconds: float = SLOW_SECONDS) -> DataFrame:
    return tasks.where(F.col("duration_seconds") > limit_seconds)


def fetch_report(manifest: DataFrame, run_id: str) -> DataFrame:
    """Duration, size and status of each source fetched in a run."""
    seconds = F.col("download_completed_at").cast("double") - F.col("download_started_at").cast("double")
    return manifest.where(F.col("ingestion_run_id") == run_id).select(
        "source_name",
        "source_type",
        F.upper("download_status").alias("download_status"),
        F.coalesce("content_length", F.lit(0)).alias("content_length"),
        F.round(F.greatest(F.coalesce(seconds, F.lit(0.0)), F.lit(0.0)), 3).alias("duration_seconds"),
        "error_message",
    ).orderBy("source_type", "source_name")


# -------------------------------------------------------------------- counts


def file_inventory(archives: DataFrame, files: DataFrame, run_id: str) -> DataFrame:
    """Distinct archives, documents and register files: in this run against all."""
    mine = F.col("run_id") == run_id
    distinct_when = lambda column, test: F.count_distinct(F.when(test, F.col(column)))
    zips = archives.agg(
        F.lit("ZIP").alias("file_type"),
        distinct_when("zip_sha256", mine & (F.col("status") == "extracted")).alias("new_this_run"),
        distinct_when("zip_sha256", F.col("status").isin("extracted", "skipped_already_processed")).alias("total_available"),
    )
    kind = F.lower("file_extension")
    extracted = files.where((F.col("extraction_status") == "extracted") & kind.isin(".json", ".csv"))
    counted = extracted.groupBy(F.upper(F.substring(kind, 2, 8)).alias("file_type")).agg(
        distinct_when("extracted_path", mine).alias("new_this_run"),
        F.count_distinct("extracted_path").alias("total_available"),
    )
    kinds = files.sparkSession.createDataFrame([("JSON",), ("CSV",)], "file_type string")
    return zips.unionByName(kinds.join(counted, "file_type", "left").fillna(0))


def prior_totals(count_log: DataFrame, run_id: str) -> DataFrame:
    """Most recent total of each table from any other run."""
    earlier = count_log.where(F.col("run_id") != run_id)
    return earlier.groupBy("table_name").agg(F.max_by("total_count", F.struct("recorded_at", "run_id")).alias("prior_total"))


def table_counts(tables: Mapping[str, DataFrame], count_log: DataFrame, run_id: str) -> DataFrame:
    """New, old and total rows per table.

    A table with run ids counts this run's rows. One without is compared with its previous total, and
    with no previous total all its rows are old.
    """
    parts = []
    for name, df in tables.items():
        by_run = "pipeline_run_id" in df.columns
        mine = F.count_if(F.col("pipeline_run_id") == run_id) if by_run else F.lit(None).cast("bigint")
        parts.append(df.agg(F.lit(name).alias("table_name"), F.count("*").alias("total_count"), mine.alias("run_count")))
    totals = parts[0]
    for part in parts[1:]:
        totals = totals.unionByName(part)
    return new_and_old(totals.join(prior_totals(count_log, run_id), "table_name", "left"), run_id)


def new_and_old(totals: DataFrame, run_id: str) -> DataFrame:
    """Split ``total_count`` into new and old from ``run_count`` and ``prior_total``, floored at 0."""
    total, mine, prior = F.col("total_count"), F.col("run_count"), F.col("prior_total")
    # ``greatest`` skips NULL, so an unknown count has to stay NULL explicitly.
    floor = lambda value: F.when(value.isNotNull(), F.greatest(value, F.lit(0)))
    return totals.select(
        F.lit(run_id).alias("run_id"),
        "table_name",
        F.coalesce(mine, floor(total - prior), F.lit(0)).cast("bigint").alias("new_count"),
        F.coalesce(floor(total - mine), prior, total).cast("bigint").alias("old_count"),
        "total_count",
    )


def run_summary(archives: DataFrame, files: DataFrame, audit: DataFrame, tasks: DataFrame, run_id: str, ingest_task: str) -> DataFrame:
    """One row for a run: archives, documents, inserted matches, files and slow tasks."""
    mine = F.col("run_id") == run_id
    opened = mine & (F.col("status") == "extracted")
    zips = archives.agg(
        F.count_if(opened).alias("zip_files_extracted"),
        F.coalesce(F.sum(F.when(opened, F.col("json_file_count"))), F.lit(0)).alias("json_files_extracted"),
    )
    documents = files.where((F.lower("file_extension") == ".json") & (F.col("extraction_status") == "extracted")).agg(
        F.count_distinct("extracted_path").alias("total_json_files"),
        F.count_distinct(F.when(mine, F.col("extracted_path"))).alias("new_json_files"),
    )
    ingest = audit.where(mine & (F.col("task_name") == ingest_task)).agg(
        F.coalesce(F.max("inserted_count"), F.lit(0)).alias("bronze_inserted_matches")
    )
    state = tasks.agg(F.count_if(F.col("duration_seconds") > SLOW_SECONDS).alias("slow_task_count"))
    facts = run_status(tasks).select(F.col("run_status").alias("status"))
    for fact in (zips, documents, ingest, state):
        facts = facts.unionByName(fact, allowMissingColumns=True)
    return facts.agg(*[F.max(name).alias(name) for name in facts.columns]).select(F.lit(run_id).alias("run_id"), "*")
