from __future__ import annotations

import datetime

import pytest
from helpers import ball, dicts, innings, match, parsed
from pyspark.sql import functions as F

from scorebook.operators import documents as docs
from scorebook.operators import gold, quality, runlog
from scorebook.sources.tables import ensure_columns

T0 = datetime.datetime(2024, 1, 1)


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


def outcome(check):
    row = check.first()
    return row["status"], row["failed_record_count"], row["sample_failure_json"]


def test_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert outcome(quality.check_unique(df, ["k", "v"], "n", "t")) == ("FAIL", 1, '{"k":1,"v":"a","count":2}')
    assert outcome(quality.check_unique(df.where("k = 2"), ["k"], "n", "t")) == ("PASS", 0, "{}")


def test_nonnegative_and_reference(spark):
    df = spark.createDataFrame([(1, 2), (-1, 5), (None, -2)], "a int, b int")
    assert outcome(quality.check_nonnegative(df, ["a", "b"], "n", "t"))[:2] == ("FAIL", 2)
    known = spark.createDataFrame([(1,), (None,)], "a int")
    assert outcome(quality.check_reference(df, known, ["a"], "n", "t")) == ("FAIL", 1, '{"a":-1}')


def test_reconcile_treats_null_keys_as_equal_and_absent_as_zero(spark):
    left = spark.createDataFrame([("x", 1), ("x", 2), (None, 4), ("y", 1)], "k string, n int")
    right = spark.createDataFrame([("x", 3), (None, 4), ("z", 2), ("w", 0)], "k string, n int")
    status, failed, _ = outcome(quality.check_reconcile(left, right, ["k"], "n", "n", "t"))
    assert (status, failed) == ("FAIL", 2)


def test_layer_checks_and_gate(spark):
    rows = parsed(spark, ("1.json", match(innings("A", [ball(runs=2), ball(wickets=[{"kind": "lbw"}])]))))
    matches, balls = docs.build_matches(rows), docs.build_deliveries(rows).persist()
    wickets = docs.build_wickets(balls)
    results = quality.run_checks(quality.silver_checks(matches, balls, wickets), "r").persist()
    assert {r["status"] for r in results.collect()} == {"PASS"}
    quality.gate(results, "silver")
    stats = gold.batting_stats(balls), gold.bowling_stats(balls), gold.team_match_summary(balls)
    assert {r["status"] for r in quality.run_checks(quality.gold_checks(balls, *stats), "r").collect()} == {"PASS"}
    twice = quality.run_checks(quality.silver_checks(matches, balls.unionByName(balls), wickets), "r").persist()
    got = {r["check_name"]: r["status"] for r in twice.collect()}
    assert got["silver_delivery_key_unique"] == "FAIL" and got["silver_wicket_totals_agree"] == "FAIL"
    with pytest.raises(quality.CheckFailed, match="1 critical silver"):
        quality.gate(twice, "silver")


def test_checks_in_one_pass_equal_single_ones(spark, tmp_path):
    games = [match(innings("A", [ball(runs=i), ball(wickets=[{"kind": "lbw"}]), ball("A2", runs=1)]), season=s) for i, s in enumerate(["2024", "2024", "2023", None])]
    rows = parsed(spark, *[(f"{i}.json", g) for i, g in enumerate([*games, match()])])
    matches, balls = docs.build_matches(rows), docs.build_deliveries(rows)
    wickets = docs.build_wickets(balls)
    registry = docs.build_person_registry(rows)
    people = spark.createDataFrame([("id-a1",), (None,)], "identifier string")
    some = lambda df, *ids: df.where(F.col("match_id").isin(*ids))
    bad_balls = balls.unionByName(some(balls, "1").withColumn("total_runs", F.lit(-3))).unionByName(some(balls, "2").withColumn("match_id", F.lit(None).cast("string")))
    bad_matches = some(matches, "0", "1", "3").unionByName(some(matches, "0"))
    for number, (m, d, w, p) in enumerate([(matches, balls, wickets, people), (bad_matches, bad_balls, some(wickets, "0", "2"), people), (matches.limit(0), balls.limit(0), wickets.limit(0), people.limit(0))]):
        tables = {"m": m, "d": d, "w": w, "b": gold.batting_stats(balls), "o": gold.bowling_stats(balls.where("season = '2024'")), "t": gold.team_match_summary(balls), "r": registry, "p": p}
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{number}{name}")
        m, d, w, b, o, t, r, p = (spark.read.schema(df.schema).parquet(f"{tmp_path}/{number}{name}") for name, df in tables.items())
        facts = docs.match_facts(m)
        single = [
            *quality.silver_checks(m, d, w), quality.check_reference(r, p.withColumnRenamed("identifier", "person_id"), ["person_id"], "silver_register_ids_known", "silver_player_registry"),
            *quality.gold_checks(d, b, o, t), quality.check_split(facts, [facts.where("season = '2024'")], "serving_split_complete", "gold_ai_match_facts"),
        ]
        entries = [quality.delivery_entries(d, gold=True), *quality.silver_entries(m, w), *quality.register_entries(r, p), *quality.gold_entries(b, o, t)]
        checks = (*quality.SILVER, *quality.REGISTER, *quality.GOLD, *quality.SPLIT)
        fused = quality.fused_results([*entries, *quality.split_entries(facts, [facts.where("season = '2024'")])], checks)
        got, want = dicts(fused), dicts(quality.run_checks(single, "r").drop("run_id", "checked_at"))
        assert got == want
        if number == 1:
            assert sum(x["status"] == "FAIL" for x in got) == len(checks)
            assert quality.verdict(fused).first()["critical_failed"] == 4
        alone = quality.fused_results([quality.season_entries(d), *quality.gold_entries(b, o, t)], quality.GOLD)
        assert dicts(alone) == [x for x in want if x["check_name"].startswith("gold_")]
    plan = quality.fused_results(entries, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert all(plan.count(f"{tmp_path}/2{name}") <= 1 for name in tables) and plan.count("Relation [") == 8


AUDIT = "run_id string, task_name string, status string, recorded_at timestamp, duration_seconds double, input_count bigint, output_count bigint, inserted_count bigint, updated_count bigint"


def audit_of(spark, *rows):
    return spark.createDataFrame([(run, task, status, at(t), seconds, 1, 1, n, 0) for run, task, status, t, seconds, n in rows], AUDIT)


def test_tasks(spark):
    audit = audit_of(
        spark, ("r", "a", "FAILED", 0, 1.0, 0), ("r", "a", "SUCCEEDED", 5, 3900.0, 7), ("r", "b", "SUCCEEDED", 1, 600.0, 0), ("q", "c", "FAILED", 9, 1.0, 0)
    )
    expected = spark.createDataFrame([("L", "a"), ("L", "b"), ("L", "c")], "layer string, task_name string")
    tasks = runlog.task_status(expected, audit, "r").persist()
    assert [(r["task_name"], r["status"], r["duration_seconds"]) for r in dicts(tasks, "task_name")] == [
        ("a", "SUCCEEDED", 3900.0), ("b", "SUCCEEDED", 600.0), ("c", "NOT_RECORDED", 0.0),
    ]
    assert [r["task_name"] for r in dicts(runlog.slow_tasks(tasks))] == ["a"]
    assert runlog.run_status(tasks).first()[0] == "INCOMPLETE"
    assert runlog.run_status(tasks.where("task_name <> 'c'")).first()[0] == "SUCCEEDED"
    failed = runlog.task_status(expected, audit_of(spark, ("r", "a", "FAILED", 0, 1.0, 0)), "r")
    assert runlog.run_status(failed).first()[0] == "FAILED"
    empty = runlog.task_status(expected, audit.where("false"), "r")
    assert runlog.run_status(empty).first()[0] == "INCOMPLETE"


def test_table_counts(spark):
    log = spark.createDataFrame(
        [("old", "plain", 3, at(1)), ("older", "plain", 9, at(0)), ("now", "plain", 99, at(2)), ("old", "shrunk", 50, at(0))],
        "run_id string, table_name string, total_count bigint, recorded_at timestamp",
    )
    ids = spark.createDataFrame([("now",), ("old",), (None,)], "pipeline_run_id string")
    plain = spark.range(5)
    got = dicts(runlog.table_counts({"ids": ids, "plain": plain, "first": plain, "shrunk": plain}, log, "now"), "table_name")
    assert [(r["table_name"], r["new_count"], r["old_count"], r["total_count"]) for r in got] == [
        ("first", 0, 5, 5), ("ids", 1, 2, 3), ("plain", 2, 3, 5), ("shrunk", 0, 50, 5),
    ]


def test_inventory_and_summary(spark):
    archives = spark.createDataFrame(
        [("r", "z1", "extracted", 4), ("q", "z1", "skipped_already_processed", 0), ("q", "z2", "failed", 1), ("q", "z3", "extracted", 2)],
        "run_id string, zip_sha256 string, status string, json_file_count bigint",
    )
    files = spark.createDataFrame(
        [("r", "a.json", ".json", "extracted"), ("q", "a.json", ".JSON", "extracted"), ("q", "b.json", ".json", "failed"), ("q", "c.json", ".json", "extracted")],
        "run_id string, extracted_path string, file_extension string, extraction_status string",
    )
    got = {r["file_type"]: (r["new_this_run"], r["total_available"]) for r in dicts(runlog.file_inventory(archives, files, "r"))}
    assert got == {"ZIP": (1, 2), "JSON": (1, 2), "CSV": (0, 0)}
    audit = audit_of(spark, ("r", "ingest", "SUCCEEDED", 0, 700.0, 4), ("r", "ingest", "SUCCEEDED", 1, 1.0, 2))
    tasks = runlog.task_status(spark.createDataFrame([("ingest",)], "task_name string"), audit, "r")
    row = runlog.run_summary(archives, files, audit, tasks, "r", "ingest").first().asDict()
    assert row == {
        "run_id": "r", "status": "SUCCEEDED", "zip_files_extracted": 1, "json_files_extracted": 4, "total_json_files": 2,
        "new_json_files": 1, "bronze_inserted_matches": 4, "slow_task_count": 0,
    }


def test_sources(spark):
    manifest = spark.createDataFrame(
        [("a", "e1", "m1", "h", at(0)), ("a", "e2", "m1", "h", at(1)), ("b", "e1", "m1", "h", at(0)), ("d", None, None, "h", at(0)), ("e", "e", "m", None, at(0))],
        "source_name string, etag string, last_modified string, sha256 string, updated_at timestamp",
    )
    observed = spark.createDataFrame([("a", "e2", "m1"), ("b", "e1", "m2"), ("c", "e", "m"), ("d", None, None), ("e", "e", "m")], "source_name string, etag string, last_modified string")
    got = {r["source_name"]: r["change"] for r in dicts(runlog.diff_sources(manifest, observed))}
    assert got == {"a": "unchanged", "b": "changed", "c": "new", "d": "changed", "e": "changed"}


def test_progress(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(5, 10, "RUNNING"), (20, 10, "RUNNING"), (0, 0, "SKIPPED"), (0, 0, "RUNNING")], "d bigint, t bigint, s string")
    share = runlog.percent_complete(F.col("d"), F.col("t"), F.col("s"))
    assert [r[0] for r in rows.select(share).collect()] == [50.0, 100.0, 100.0, 0.0]
    log = spark.createDataFrame([("r", "t", "z", 1, at(0)), ("r", "t", "z", 5, at(3)), ("r", "t", "y", 2, at(1))], "run_id string, task_name string, current_item string, processed_count bigint, updated_at timestamp")
    assert [(r["current_item"], r["processed_count"]) for r in dicts(runlog.latest_progress(log), "current_item")] == [("y", 2), ("z", 5)]


def test_fetch_report(spark):
    rows = [("r", "b", "zip", "downloaded", None, at(0), at(2), None), ("r", "a", "csv", "failed", 7, at(3), None, "x"), ("q", "c", "csv", "downloaded", 7, at(3), at(4), None)]
    manifest = spark.createDataFrame(rows, "ingestion_run_id string, source_name string, source_type string, download_status string, content_length bigint, download_started_at timestamp, download_completed_at timestamp, error_message string")
    got = [(r["source_name"], r["download_status"], r["content_length"], r["duration_seconds"]) for r in runlog.fetch_report(manifest, "r").collect()]
    assert got == [("a", "FAILED", 7, 0.0), ("b", "DOWNLOADED", 0, 120.0)]


def test_ensure_columns_ignores_case(spark):
    df = ensure_columns(spark.range(1), {"ID": "string", "more": "timestamp"})
    assert df.dtypes == [("id", "bigint"), ("more", "timestamp")]
