from __future__ import annotations

import datetime
import json
import random
from collections import Counter

import pytest
from helpers import dicts
from pyspark.sql import functions as F

from scorebook.operators import gold
from scorebook.operators.numbering import positions
from scorebook.plans import queries_gold, queries_runs, workload  # noqa: F401  (the refresh needs the SQL of the cards)
from scorebook.plans import queries_sources as sources
from scorebook.sources.tables import Lake


@pytest.fixture
def folder(spark, tmp_path):
    """Order tables in which one order holds most items, many of them exact copies."""
    day = datetime.datetime(1998, 1, 2)
    tables = {
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "c", 0, 1.0, "BUILDING")], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": (
            [(key, 1, "O", 1.0, day, "1-URGENT") for key in (1, 2, 3)],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "lineitem": (
            [(1, 7, 3, 1, 4.0, 1.0, 0.1, 0.0, "N", "F", day)] * 60 + [(1, 9, 2, 1 + n % 2, 2.0, 1.0, 0.0, 0.0, "N", "O", day) for n in range(20)] + [(2, n, n, 1 + n % 3, 1.0, 1.0, 0.0, 0.0, "A", "O", day) for n in range(5)],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def silver(spark, folder, name):
    """Silver tables of the folder's documents, as rows without what tells of the texts themselves."""
    lake = Lake(spark, f"file:{folder}/{name}")
    workload.build_raw(lake, folder)
    workload.build_silver(lake)
    told = {"source_file", "ingestion_timestamp", "match_record_hash"}
    return lake, {
        table: Counter(json.dumps({k: v for k, v in row.items() if k not in told}, default=str, sort_keys=True) for row in dicts(lake.load(table)))
        for table in (workload.MATCHES, workload.DELIVERIES, workload.WICKETS)
    }


@pytest.mark.parametrize("part", [1, 7, 24])
def test_every_cut_gives_the_same_silver_tables(spark, folder, monkeypatch, part):
    """One order holds most items: cut into parts of any size, its innings, overs and balls keep their numbers."""
    _, whole = silver(spark, folder, "whole")
    monkeypatch.setattr(workload, "PART", part)
    lake, cut = silver(spark, folder, "cut")
    assert cut == whole
    sizes = {(r["key"], r["part"]) for r in dicts(lake.load("document_parts"))}
    assert {p for k, p in sizes if k == 1} == set(range(-(-80 // part))) and (3, 0) in sizes
    balls = lake.load(workload.DELIVERIES)
    per_match = gold.real_balls(balls).groupBy("match_id").agg(F.count("*").alias("n"), F.max("delivery_sequence").alias("last"))
    assert {r["match_id"]: (r["n"], r["last"]) for r in dicts(per_match)} == {"1": (80, 60), "2": (5, 2)}
    summary = {(r["match_id"], r["team"]): (r["team_runs"], r["wickets_lost"]) for r in dicts(gold.team_match_summary(balls).withColumnRenamed("batting_team", "team"))}
    assert summary["1", "N A"] == (240, 60)
    assert lake.load(workload.MATCHES).count() == 3 and lake.load(workload.RAW).count() == 3


@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_positions_equal_a_plain_count(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice([None, 1, 1, 1, 1, 2, 3]), rng.choice(["a", "b", None]), rng.randrange(3), i) for i in range(400)] + [(1, "b", 1, 1000 + i) for i in range(300)]
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = positions(spark.createDataFrame(rows, "g int, h string, v int, n int"), {"in_g": ["g"], "in_gh": ["g", "h"], "all": []}, ["g", "h", "v"])
        got = dicts(made)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(got) == len(rows)
    rank = lambda x: (x is not None, x if x is not None else 0)
    for name, columns in (("in_g", ("g",)), ("in_gh", ("g", "h")), ("all", ())):
        groups = {}
        for row in got:
            groups.setdefault(tuple(row[c] for c in columns), []).append((row[name], (rank(row["g"]), (row["h"] is not None, row["h"] or ""), row["v"])))
        for held in groups.values():
            held.sort()
            assert [n for n, _ in held] == list(range(len(held))) and [o for _, o in held] == sorted(o for _, o in held)
    with pytest.raises(ValueError, match="leading part"):
        positions(made, {"n": ["h"]}, ["g", "h"])


def test_texts_stand_once_and_items_move_once(spark, folder, tmp_path):
    """Matches of one part are nested from one exchange of narrow items: no ranges, no numbering, no second copy of a text."""
    lake = Lake(spark, f"file:{folder}/once")
    workload.build_raw(lake, folder)
    assert not lake.exists("documents") and "raw_json" not in lake.load(workload.RAW).columns
    plan = workload.documents(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    moved = [line for line in plan.splitlines() if "Repartition" in line]
    assert len(moved) == 1 and "Window" not in plan and "actual_delivery" not in plan[plan.index("Repartition") :]
    workload.build_silver(lake)
    assert "raw_json" not in workload.second_delivery(lake).columns


def test_standing_rows_are_told_without_moving_any(spark):
    for name in (workload.MATCHES, workload.DELIVERIES):
        plan = queries_runs._standing(spark, "/root/testdata/sf0.001", name)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan


def test_pages_stream_in_files_of_many(spark, monkeypatch):
    """The driver lists a file for many pages, not one for each."""
    landed = []
    stream = queries_runs.stream_documents

    def watched(session, folder, *args, **options):
        landed.append(session.read.parquet(folder).inputFiles() if options.get("form") == "parquet" else None)
        return stream(session, folder, *args, **options)

    monkeypatch.setattr(queries_runs, "stream_documents", watched)
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet").count()
    assert queries_runs.stream_pages(spark, folder).count() == pages
    assert landed[0] is not None and len(landed[0]) <= max(8, pages // 100)


def test_matches_stream_from_files_that_follow_the_data(spark, monkeypatch):
    """Two batches whatever the number of files: a fixed number of files would be a fixed number of tasks."""
    seen = []

    def stop(lake, folder, checkpoint, max_files, **options):
        seen.append((len(lake.spark.read.parquet(folder).inputFiles()), max_files))
        raise StopIteration

    monkeypatch.setattr(sources, "ingest_stream", stop)
    monkeypatch.setattr(sources, "FILE_ROWS", 10)
    with pytest.raises(StopIteration):
        sources.stream_matches(spark, "/root/testdata/sf0.001")
    files, most = seen[0]
    assert files > 4 and most == -(-files // 2)


def test_a_query_makes_only_the_tables_it_reads(spark, folder):
    """Nothing but the documents for what they say of their match; balls straight from the texts."""
    lake = workload.Workload(spark, f"file:{folder}/lazy", sf_dir=folder)
    assert workload.parsed(lake, fields=["meta", "info"]).count() == 3 and lake.tables() == [workload.PARTS]
    assert gold.real_balls(lake.load(workload.DELIVERIES)).count() == 85
    assert lake.tables() == sorted([workload.PARTS, workload.DELIVERIES])
    lake.load(workload.RAW)
    written = lake.load(workload.RAW).select("match_id", "info.teams").collect()
    assert Counter(map(str, written)) == Counter(map(str, workload._shaped(workload.texts(lake), "x", ["meta", "info"]).select("match_id", "info.teams").collect()))


def test_a_scoped_rebuild_takes_all_parts_of_a_match(spark, folder, monkeypatch):
    monkeypatch.setattr(workload, "PART", 7)
    monkeypatch.setattr(workload, "_LAKES", {})
    monkeypatch.setattr(queries_gold.docs, "in_leagues", lambda rows, leagues: rows)
    assert queries_gold.scoped_rebuild(spark, folder).agg(F.sum("runs")).first()[0] == gold.batting_stats(workload.demo_lake(spark, folder).load(workload.DELIVERIES)).agg(F.sum("runs")).first()[0]


def test_the_gate_makes_the_gold_tables_once(spark, monkeypatch):
    made = []
    real = queries_runs.materialise
    monkeypatch.setattr(queries_runs, "materialise", lambda df, label: made.append(label) or real(df, label))
    queries_runs.dq_gate(spark, "/root/testdata/sf0.001")
    assert sorted(made) == ["batting", "bowling", "summary"]


def test_the_refresh_does_not_write_the_balls_anew(spark, monkeypatch):
    written = []
    real = Lake._write
    monkeypatch.setattr(Lake, "_write", lambda self, name, *rest: written.append(name) or real(self, name, *rest))
    workload.demo_lake(spark, "/root/testdata/sf0.001").load(workload.DELIVERIES)
    written.clear()
    sources.gold_refresh(spark, "/root/testdata/sf0.001")
    assert workload.DELIVERIES not in written and written.count("gold_ai_team_season_cards") == 2


def test_only_documents_with_warnings_are_kept(spark, monkeypatch):
    """What is written for the warnings are the marked documents, not all of them."""
    from scorebook.plans import queries_facts

    kept = []
    real = queries_facts.materialise
    monkeypatch.setattr(queries_facts, "materialise", lambda df, label: kept.append(real(df, label)) or kept[-1])
    folder = "/root/testdata/sf0.001"
    warned = {r["path"]: r["matches"] for r in dicts(queries_facts.field_warnings(spark, folder))}
    assert len(warned) == 3 and max(warned.values()) < kept[0].count() <= sum(warned.values())


def test_checks_of_one_reading_write_no_gold_table(spark, monkeypatch):
    made = []
    monkeypatch.setattr(queries_runs, "materialise", lambda df, label: made.append(label) or df)
    plan = queries_runs.dq_results(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert made == [] and "distinct" not in plan


def test_the_second_delivery_is_compared_without_its_balls(spark, folder, monkeypatch):
    """Neither the raw rows nor the second delivery are parsed whole or written for what a document says of its match."""
    monkeypatch.setattr(workload, "_LAKES", {})
    lake = workload.demo_lake(spark, folder)
    assert {(r["match_id"], r["change"]) for r in dicts(queries_runs.classify_revision(spark, folder))} == {(key, "revised") for key in "123"}
    assert lake.tables() == [workload.PARTS]
    assert {r["season"] for r in dicts(queries_runs.affected_seasons(spark, folder))} == {"1998", "1990"}
    assert lake.tables() == sorted([workload.MATCHES, workload.PARTS])
    assert dicts(queries_runs.merge_counts(spark, folder))[0]["updated_count"] == 3 and {r["source_revision"] for r in dicts(queries_runs.merge_latest(spark, folder))} == {2}
    assert workload.RAW not in lake.tables() and workload.SECOND not in lake.tables()


def test_the_second_delivery_has_all_parts_of_a_match(spark, folder, monkeypatch):
    """Balls of texts that continue a match are in it as those of its document."""
    monkeypatch.setattr(workload, "PART", 7)
    monkeypatch.setattr(workload, "_LAKES", {})
    whole = gold.batting_stats(workload.demo_lake(spark, folder).load(workload.DELIVERIES)).agg(F.sum("runs")).first()[0]
    assert [(r["season"], r["pipeline_run_id"], r["balls"], r["runs"]) for r in dicts(queries_runs.replace_by_key(spark, folder))][0][:3] == ("1990", "load-2", 85)
    assert queries_runs.incremental_gold(spark, folder).agg(F.sum("runs")).first()[0] == whole


def test_warnings_count_the_balls_of_all_parts(spark, folder, tmp_path, monkeypatch):
    """All orders have every kind of warning: one of each head, however many texts repeat it, and one of each ball."""
    from scorebook.plans import queries_facts

    monkeypatch.setattr(workload, "PART", 7)
    monkeypatch.setattr(workload, "_LAKES", {})
    times = lambda name, key: spark.read.parquet(f"{folder}/{name}.parquet").withColumn(key, F.col(key) * 385).write.parquet(f"{tmp_path}/times/{name}.parquet")
    times("orders", "o_orderkey"), times("lineitem", "l_orderkey"), times("nation", "n_nationkey"), times("region", "r_regionkey")
    spark.read.parquet(f"{folder}/customer.parquet").write.parquet(f"{tmp_path}/times/customer.parquet")
    found = {r["path"]: (r["warnings"], r["matches"], r["balls"]) for r in dicts(queries_facts.field_warnings(spark, f"{tmp_path}/times"))}
    assert found == {"innings.overs.deliveries.runs.total": (85, 2, 85), "meta.revision": (3, 3, 85), "info.teams": (3, 3, 85)}


def test_the_stream_takes_all_parts_of_a_match(spark, folder, monkeypatch):
    """A match of twelve texts comes in over both batches, whichever of its texts is first."""
    monkeypatch.setattr(workload, "PART", 7)
    monkeypatch.setattr(workload, "_LAKES", {})
    runs = {r["match_id"]: r["runs"] for r in dicts(workload.demo_lake(spark, folder).load(workload.DELIVERIES).groupBy("match_id").agg(F.coalesce(F.sum("total_runs"), F.lit(0)).alias("runs")))}
    got = {r["match_id"]: (r["revision"], r["balls"], r["runs"]) for r in dicts(sources.stream_matches(spark, folder))}
    assert got == {"1": (1, 80, runs["1"]), "2": (1, 5, runs["2"]), "3": (1, 0, 0)}


def test_the_gate_parses_no_text_for_the_people_of_both_checks(spark):
    plan = queries_runs.dq_gate(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_json" not in plan and "person_id" in plan
