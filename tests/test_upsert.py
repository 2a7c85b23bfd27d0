from __future__ import annotations

import datetime
import random

from helpers import dicts
from pyspark.sql import functions as F

from scorebook.operators import upsert

SCHEMA = "match_id string, source_file_sha256 string, source_revision int, ingestion_timestamp timestamp, source_path string"
KEY = ("match_id", "source_file_sha256", "source_revision")
T0 = datetime.datetime(2024, 1, 1)


def table(spark, *rows):
    full = [(m, h, r, T0 + datetime.timedelta(hours=t), f"p{i}") for i, (m, h, r, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def state(df):
    return sorted((r["match_id"], r["source_file_sha256"], r["source_revision"]) for r in df.collect())


def test_merge_takes_new_and_revised_rows_only(spark):
    current = table(spark, ("1", "a", 1, 0), ("2", "b", 2, 0), ("3", "c", 1, 0), ("9", "z", 1, 0))
    batch = table(spark, ("1", "a2", 2, 1), ("2", "b0", 1, 1), ("3", "c", 1, 1), ("4", "d", 1, 1))
    merge = upsert.merge_by_key(current, current, batch, *KEY)
    assert state(merge.latest) == [("1", "a2", 2), ("2", "b", 2), ("3", "c", 1), ("4", "d", 1), ("9", "z", 1)]
    assert state(merge.new_versions) == [("1", "a2", 2), ("2", "b0", 1), ("4", "d", 1)]
    counts = merge.counts.first().asDict()
    assert counts == {"candidate_count": 4, "inserted_count": 1, "updated_count": 1, "unchanged_count": 1, "older_count": 1}


def test_repeating_a_batch_changes_nothing(spark):
    current = table(spark, ("1", "a", 1, 0))
    batch = table(spark, ("1", "b", 2, 1), ("2", "c", 1, 1))
    once = upsert.merge_by_key(current, current, batch, *KEY)
    history = current.unionByName(once.new_versions)
    again = upsert.merge_by_key(once.latest, history, batch, *KEY)
    assert state(again.latest) == state(once.latest)
    assert again.new_versions.count() == 0
    assert again.counts.first()["unchanged_count"] == 2


def test_order_of_batches_does_not_matter_when_revisions_differ(spark):
    pick = random.Random(3)
    rows = [(str(m), f"{m}-{r}", r, r) for m in range(5) for r in range(1, 4)]
    results = set()
    for _ in range(3):
        pick.shuffle(rows)
        latest = table(spark, rows[0]).where("false")
        for start in range(0, len(rows), 5):
            batch = table(spark, *rows[start : start + 5])
            latest = upsert.merge_by_key(latest, latest, batch, *KEY).latest
        results.add(tuple(state(latest)))
    assert results == {tuple((str(m), f"{m}-3", 3) for m in range(5))}


def test_two_files_of_one_match_in_a_batch(spark):
    nothing = table(spark, ("x", "x", 1, 0)).where("false")
    batch = table(spark, ("1", "a", 1, 0), ("1", "b", 2, 0), ("1", "b", 2, 1))
    merge = upsert.merge_by_key(nothing, nothing, batch, *KEY)
    assert state(merge.latest) == [("1", "b", 2)]
    assert state(merge.new_versions) == [("1", "a", 1), ("1", "b", 2)]


def test_replace_clears_keys_without_rows(spark):
    current = spark.createDataFrame([("1", 1), ("1", 2), ("2", 3)], "k string, v int")
    batch = spark.createDataFrame([("1", 9)], "k string, v int")
    assert sorted(map(tuple, upsert.replace_by_key(current, batch, ["k"]).collect())) == [("1", 9), ("2", 3)]
    gone = spark.createDataFrame([("1",), ("2",)], "k string")
    assert sorted(map(tuple, upsert.replace_by_key(current, batch, ["k"], gone).collect())) == [("1", 9)]


def test_affected_partitions_cover_old_and_new(spark):
    current = spark.createDataFrame([("1", "2020"), ("2", "2021"), ("3", None)], "k string, season string")
    batch = spark.createDataFrame([("1", "2022"), ("4", "2023"), ("3", "2022")], "k string, season string")
    got = {r["season"] for r in upsert.affected_partitions(current, batch, ["k"], ["season"]).collect()}
    assert got == {"2020", "2022", "2023", None}


def test_latest_and_top_cut_before_the_exchange(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    for df in (upsert.latest_by_key(rows, ["k"], [F.col("id").desc()]), upsert.top_by_group(rows, ["k"], [F.col("id").desc()], 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        before = plan[plan.index("Exchange hashpartitioning"):]
        assert "WindowGroupLimit" in before and "Partial" in before
    assert sorted(r["id"] for r in upsert.latest_by_key(rows, ["k"], [F.col("id").desc()]).collect()) == [997, 998, 999]


def test_latest_where_repeated_moves_only_rows_of_repeated_keys(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(30)]), rng.randrange(5), n) for n in range(60)] + [(100 + n, 0, n) for n in range(40)]
    df = spark.createDataFrame(rows, "k int, v int, n int")
    order = [F.col("v").desc(), F.col("n").asc()]
    expected = sorted(map(str, upsert.latest_by_key(df, ["k"], order).collect()))
    assert sorted(map(str, upsert.latest_where_repeated(df, ["k"], order).collect())) == expected
    once = df.where("k >= 100")
    made = upsert.latest_where_repeated(once, ["k"], order)
    assert sorted(map(str, made.collect())) == sorted(map(str, once.collect()))
    wide = made._jdf.queryExecution().optimizedPlan().children().head().toString()
    assert "Window" not in wide and "Join" not in wide
