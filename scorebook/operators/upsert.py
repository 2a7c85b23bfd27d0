"""Keyed upserts over plain tables, expressed as joins.

Every function returns the rows that should stand after the change; writing them is the caller's step.
Callers pass ``current`` already restricted to the partitions the batch touches, so the cost follows
the batch and not the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.functions.rules import classify_revision
from scorebook.session import materialise


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    The ``= 1`` test lets Spark keep one row per key and task before the exchange, so a key that holds
    a large share of the rows does not end up in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")


def latest_where_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``latest_by_key`` for wide rows of which few repeat a key: only the rows of repeated keys are moved.

    The repeated keys are written first, so the planner sees their size and broadcasts them if they are few. Rows with a NULL in
    their key are moved as well. If there are neither, the rows are read once and as they are.
    """
    absent = reduce(or_, [F.col(name).isNull() for name in keys])
    repeated = materialise(df.groupBy(*keys).count().where((F.col("count") > 1) | absent).select(*keys), "repeated_keys")
    if repeated.isEmpty():
        return df
    moved = df.join(repeated, list(keys), "left_semi").unionByName(df.where(absent))
    return df.where(~absent).join(repeated, list(keys), "left_anti").unionByName(latest_by_key(moved, keys, order)).select(*df.columns)


def top_by_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group, with the same early per-task cut."""
    ranked = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def replace_by_key(current: DataFrame, batch: DataFrame, keys: Sequence[str], batch_keys: DataFrame | None = None) -> DataFrame:
    """Rows of other keys, plus the batch. ``batch_keys`` also clears keys for which no row arrives."""
    gone = (batch if batch_keys is None else batch_keys).select(*keys).distinct()
    return current.join(gone, list(keys), "left_anti").unionByName(batch, allowMissingColumns=True)


def classify_batch(current: DataFrame, batch: DataFrame, key: str, digest: str, revision: str) -> DataFrame:
    """Newest row per key of the batch with its ``change`` against the current row of that key."""
    newest = [F.col(revision).desc_nulls_last(), F.col("ingestion_timestamp").desc_nulls_last(), F.col(digest).desc()]
    arrived = latest_by_key(batch, [key], newest)
    standing = current.select(key, F.col(digest).alias("_digest"), F.col(revision).alias("_revision"))
    change = classify_revision(F.col("_revision"), F.col("_digest"), F.col(revision), F.col(digest))
    return arrived.join(standing, key, "left").withColumn("change", change).drop("_digest", "_revision")


@dataclass(frozen=True)
class Merge:
    latest: DataFrame
    new_versions: DataFrame
    counts: DataFrame


def apply_merge(current: DataFrame, classified: DataFrame, key: str) -> DataFrame:
    """Latest rows after the batch: only new and revised rows are taken over."""
    taken = classified.where(F.col("change").isin("new", "revised")).drop("change")
    return replace_by_key(current, taken, [key])


def new_versions(versions: DataFrame, batch: DataFrame, key: str, digest: str) -> DataFrame:
    """Distinct ``(key, digest)`` rows of the batch that the history does not hold yet."""
    once = latest_by_key(batch, [key, digest], [F.col("ingestion_timestamp").desc_nulls_last(), F.col("source_path").asc()])
    return once.join(versions.select(key, digest), [key, digest], "left_anti")


def change_counts(classified: DataFrame) -> DataFrame:
    """One row: candidates and how many were inserted, updated or skipped."""
    of = lambda *kinds: F.count_if(F.col("change").isin(*kinds))
    return classified.agg(
        F.count("*").alias("candidate_count"),
        of("new").alias("inserted_count"),
        of("revised").alias("updated_count"),
        of("unchanged").alias("unchanged_count"),
        of("older").alias("older_count"),
    )


def merge_by_key(
    current: DataFrame, versions: DataFrame, batch: DataFrame, key: str, digest: str, revision: str
) -> Merge:
    """Revision-aware upsert: latest rows, additions to the history, and counts."""
    classified = classify_batch(current, batch, key, digest, revision)
    return Merge(
        latest=apply_merge(current, classified, key),
        new_versions=new_versions(versions, batch, key, digest),
        counts=change_counts(classified),
    )


def affected_partitions(current: DataFrame, batch: DataFrame, keys: Sequence[str], partition: Sequence[str]) -> DataFrame:
    """Distinct partitions holding a batch row now or a row of a batch key before."""
    before = current.select(*keys, *partition).join(batch.select(*keys).distinct(), list(keys), "left_semi")
    return before.select(*partition).unionByName(batch.select(*partition)).distinct()
