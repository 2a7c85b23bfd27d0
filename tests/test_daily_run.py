from __future__ import annotations

import json
import os
import zipfile

import pytest
from helpers import ball, dicts, documents, innings, match
from test_documents import G1

from scorebook.operators import gold, quality, runlog
from scorebook.plans import daily_run as dr
from scorebook.sources.tables import Lake
from scorebook.streaming.ingest import ingest_stream, stream_batch, stream_documents

FIRST = [
    ("101.json", G1),
    ("102.json", match(innings("B", [ball("B1", "A1", 6), ball("B1", "A1", 1)]), event="County Cup", season="2007/08")),
    ("103.json", match(innings("A", [ball("A1", "B1", 1)]), event=None, season="2023")),
    ("104.json", match()),
    ("105.json", "{ broken"),
]
REVISED = match(innings("A", [ball("A1", "B1", 3)]), revision=2, season="2025")
SECOND = [
    ("101.json", REVISED),
    ("102.json", match(innings("B", [ball("B1", "A1", 2)]), event="County Cup", season="2007/08", revision=0)),
    ("103.json", FIRST[2][1]),
    ("106.json", match(innings("A", [ball("A1", "B1", 5)]), season="2023")),
]


def run(lake, run_id, files, **options):
    return dr.run_lake(lake, dr.Run(run_id=run_id, buckets=4, **options), documents(lake.spark, *files)).first()


def rows(lake, name, *columns):
    return sorted(map(str, lake.load(name).select(*columns).collect()))


def gold_state(lake):
    names = (dr.BATTING, dr.BOWLING, dr.SUMMARY, dr.LEAGUES, dr.PLAYER_CARDS, dr.TEAM_CARDS, dr.FACTS)
    return {name: rows(lake, name, *sorted(lake.load(name).columns)) for name in names}


def test_full_and_incremental_runs_agree(spark, tmp_path):
    step = Lake(spark, f"file:{tmp_path}/step")
    first = run(step, "r1", FIRST, focus="County Cup")
    assert (first["status"], first["bronze_inserted_matches"]) == ("SUCCEEDED", 4)
    counts = runlog.latest_task_rows(step.load("task_log"), "r1").where("task_name = 'ingest_raw'").first()
    assert (counts["input_count"], counts["inserted_count"], counts["quarantine_count"]) == (5, 4, 1)
    assert {r["season"] for r in dicts(step.load(dr.BATTING))} == {"2024", "2007/08", "2023"}

    assert rows(step, f"{dr.FACTS}_focus_leagues", "match_id") == ["Row(match_id='102')"]
    assert step.load(f"{dr.FACTS}_other_leagues").count() == 3
    assert {(r["team_name"], r["matches"]) for r in dicts(step.load("dim_team"))} == {("A", 4), ("B", 4)}
    assert step.load(dr.REGISTRY).count() == 8

    run(step, "r2", SECOND, focus="County Cup")
    counts = runlog.latest_task_rows(step.load("task_log"), "r2").where("task_name = 'ingest_raw'").first()
    assert (counts["inserted_count"], counts["updated_count"], counts["skipped_count"]) == (1, 1, 2)
    # The revision lost all wickets and moved to another season: nothing of the old one is left.
    assert step.load(dr.WICKETS).count() == 0
    assert {r["season"] for r in dicts(step.load(dr.BATTING))} == {"2025", "2007/08", "2023"}
    assert step.load(dr.VERSIONS).count() == 8
    by_id = {r["match_id"]: r["source_revision"] for r in dicts(step.load(dr.RAW))}
    assert by_id == {"101": 2, "102": 1, "103": 1, "104": 1, "106": 1}

    whole = Lake(spark, f"file:{tmp_path}/whole")
    final = [SECOND[0], FIRST[1], FIRST[2], FIRST[3], SECOND[3]]
    run(whole, "w1", final, focus="County Cup")
    assert gold_state(step) == gold_state(whole)
    names = [f"{name}_{part}" for name in dr.CARDS for part in ("focus_leagues", "other_leagues")]
    for name in names:
        columns = sorted(step.load(name).columns)
        assert rows(step, name, *columns) == rows(whole, name, *columns)

    # The same batch again, with all facts rebuilt from the raw tables, changes nothing but the logs.
    before = gold_state(step)
    again = run(step, "r3", SECOND, focus="County Cup", mode="bootstrap")
    assert again["bronze_inserted_matches"] == 0 and gold_state(step) == before
    assert step.load(dr.VERSIONS).count() == 8
    history = {r["run_id"]: r["status"] for r in dicts(runlog.run_history(step.load("run_log")))}
    assert history == {name: "SUCCEEDED" for name in ("r1", "r2", "r3")}
    counts = {(r["run_id"], r["table_name"]): (r["new_count"], r["old_count"]) for r in dicts(step.load("table_count_log"))}
    assert counts["r2", dr.MATCHES] == (2, 3)
    assert {r["status"] for r in dicts(step.load("quality_log"))} == {"PASS"}


def test_failed_run_is_completed_by_the_next(spark, lake, monkeypatch):
    run(lake, "r1", FIRST[:2])
    with monkeypatch.context() as patch:
        patch.setattr(gold, "batting_stats", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run(lake, "r2", SECOND[:1])
    assert {r["run_id"]: r["status"] for r in dicts(runlog.run_history(lake.load("run_log")))}["r2"] == "FAILED"
    run(lake, "r3", SECOND[3:])
    assert {(r["season"], r["runs"]) for r in dicts(lake.load(dr.BATTING))} == {("2025", 3), ("2007/08", 7), ("2023", 5)}


def test_gate_stops_before_gold(spark, lake):
    bad = match(innings("A", [{"batter": "A1", "bowler": "B1", "runs": {"batter": -1, "extras": 0, "total": -1}}]))
    with pytest.raises(quality.CheckFailed):
        run(lake, "r1", [("1.json", bad)])
    assert not lake.exists(dr.BATTING)
    assert dicts(lake.load("quality_log").where("status = 'FAIL'"))[0]["check_name"] == "silver_delivery_runs_nonnegative"


def test_archives_to_facts(spark, lake, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    with zipfile.ZipFile(folder / "a.zip", "w") as z:
        z.writestr("101.json", json.dumps(G1))
        z.writestr("../x.json", "{}")
    (folder / "broken.zip").write_bytes(b"nothing")
    first = dr.Run("r1", buckets=4)
    summary = dr.run_lake(lake, first, dr.ingest_archives(lake, first, str(folder))).first()
    assert (summary["zip_files_extracted"], summary["json_files_extracted"], summary["new_json_files"]) == (1, 1, 1)
    # The archive opened before is not opened again.
    assert dr.ingest_archives(lake, dr.Run("r2", buckets=4), str(folder)).count() == 0
    status = {(r["run_id"], r["zip_name"]): r["status"] for r in dicts(lake.load("archive_log"))}
    assert status == {
        ("r1", "a.zip"): "extracted", ("r1", "broken.zip"): "failed", ("r2", "a.zip"): "skipped_already_processed", ("r2", "broken.zip"): "failed",
    }


def test_a_run_takes_matches_and_registers_from_archives(spark, lake, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    people = 'identifier,name,unique_name,key_x\r\nid-a1,"Ann ""A"", B",Ann,7\r\nid-zz,Zed,,\r\n'
    with zipfile.ZipFile(folder / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("101.json", json.dumps(G1))
        z.writestr("register/people.csv", people)
        z.writestr("register/names.csv", "identifier,name\nid-a1,A. B.\nid-a1,A. B.\nid-a1,Annie\n")
    more = documents(spark, FIRST[1])
    summary = dr.run_lake(lake, dr.Run("r1", buckets=4), more, archives=str(folder)).first()
    assert (summary["status"], summary["json_files_extracted"], summary["bronze_inserted_matches"]) == ("SUCCEEDED", 1, 2)
    assert rows(lake, dr.RAW, "match_id") == ["Row(match_id='101')", "Row(match_id='102')"]
    assert {(r["identifier"], r["name"], r["unique_name"]) for r in dicts(lake.load("dim_people"))} == {("id-a1", 'Ann "A", B', "Ann"), ("id-zz", "Zed", None)}
    assert [(r["person_id"], r["external_source"], r["external_id"]) for r in dicts(lake.load("bridge_person_external_ids"))] == [("id-a1", "x", "7")]
    assert {(r["identifier"], r["name"]) for r in dicts(lake.load("dim_person_names"))} == {("id-a1", "A. B."), ("id-a1", "Annie")}
    assert "id-a1" not in str(dicts(lake.load("unresolved_people")))
    task = runlog.latest_task_rows(lake.load("task_log"), "r1").where("task_name = 'extract_archives'").first()
    assert (task["status"], task["input_count"], task["output_count"], task["skipped_count"]) == ("SUCCEEDED", 1, 3, 0)

    # The same archives again are skipped, which the progress says; the people stay.
    again = dr.run_lake(lake, dr.Run("r2", buckets=4), archives=str(folder)).first()
    assert again["status"] == "SUCCEEDED" and lake.load("dim_people").count() == 2
    progress = dicts(lake.load("progress_log").where("run_id = 'r2'"))
    assert [(r["task_name"], r["status"], r["percent_complete"], r["total_count"]) for r in progress] == [("extract_archives", "SKIPPED", 100.0, 0)]
    assert dicts(lake.load("task_log").where("run_id = 'r2' AND task_name = 'extract_archives'"))[0]["skipped_count"] == 1

    # A newer archive has the newer register.
    with zipfile.ZipFile(folder / "b.zip", "w") as z:
        z.writestr("people.csv", "identifier,name,unique_name\nid-b1,Bob,Bob\n")
    os.utime(folder / "b.zip", (2_000_000_000, 2_000_000_000))
    dr.run_lake(lake, dr.Run("r3", buckets=4), archives=str(folder))
    assert {r["identifier"] for r in dicts(lake.load("dim_people"))} == {"id-b1"}
    with pytest.raises(ValueError, match="neither"):
        dr.run_lake(lake, dr.Run("r4", buckets=4))


def test_a_run_leaves_tidy_tables(spark, lake):
    for i in range(3):
        run(lake, f"r{i}", FIRST[: i + 1], folders=2, keep_days=-1)
    assert len(lake.snapshots("task_log")) == 1 and len(lake.snapshot("task_log").parts) <= 2
    assert len(lake.snapshots(dr.RAW)) == 1 and lake.load(dr.RAW).count() == 3
    assert lake.load("task_log").where("task_name = 'ingest_raw'").count() == 3


def test_stream_runs_the_refresh(spark, lake, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for name, body in (("101.json", G1), FIRST[1]):
        (folder / name).write_text(json.dumps(body))
    for _ in range(2):
        ingest_stream(lake, str(folder), f"{tmp_path}/checkpoint", leagues=("County Cup",), buckets=4).awaitTermination()
    assert sorted(r["match_id"] for r in dicts(lake.load(dr.RAW))) == ["101", "102"]
    assert rows(lake, dr.MATCHES, "match_id") == ["Row(match_id='102')"]
    ingest = runlog.latest_task_rows(lake.load("task_log")).where("task_name = 'ingest_raw'")
    assert [(r["run_id"], r["input_count"]) for r in dicts(ingest, "run_id")] == [("stream-0", 2)]


def test_a_replayed_batch_is_skipped_and_a_broken_one_completed(spark, lake, tmp_path, monkeypatch):
    checkpoint = f"{tmp_path}/checkpoint"
    handle = stream_batch(lake, checkpoint, "s", {"buckets": 4})
    with monkeypatch.context() as patch:
        patch.setattr(dr, "build_facts", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            handle(documents(spark, *FIRST[:2]), 0)
    assert not lake.exists("stream_log")
    handle(documents(spark, *FIRST[:2]), 0)
    assert rows(lake, dr.MATCHES, "match_id") == ["Row(match_id='101')", "Row(match_id='102')"]
    handle(documents(spark, FIRST[2]), 0)  # the ledger has the batch: what is handed over now is not looked at
    assert lake.load(dr.RAW).count() == 2
    assert [(r["stream"], r["batch_id"], r["run_id"]) for r in dicts(lake.load("stream_log"))] == [("s", 0, "s-0")]
    stream_batch(lake, f"{tmp_path}/other", "s", {"buckets": 4})(documents(spark, FIRST[2]), 0)
    assert lake.load(dr.RAW).count() == 3


def test_stream_takes_new_files_only(spark, tmp_path):
    folder, seen = tmp_path / "landing", []
    folder.mkdir()
    for name in ("1.json", "2.json"):
        (folder / name).write_text("{}")
        take = lambda batch, _: seen.append(sorted(r["source_path"][-6:] for r in batch.collect()))
        stream_documents(spark, str(folder), f"{tmp_path}/checkpoint", take).awaitTermination()
    assert seen == [["1.json"], ["2.json"]]


def test_archives_of_a_failed_run_are_read_again(spark, lake, tmp_path, monkeypatch):
    folder = tmp_path / "zips"
    folder.mkdir()
    with zipfile.ZipFile(folder / "a.zip", "w") as z:
        z.writestr("101.json", json.dumps(G1))
    first = dr.Run("r1", buckets=4)
    with monkeypatch.context() as patch:
        patch.setattr(dr.upsert, "classify_batch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            dr.run_lake(lake, first, dr.ingest_archives(lake, first, str(folder)))
    again = dr.Run("r2", buckets=4)
    dr.run_lake(lake, again, dr.ingest_archives(lake, again, str(folder)))
    assert rows(lake, dr.RAW, "match_id") == ["Row(match_id='101')"]
    assert dr.ingest_archives(lake, dr.Run("r3", buckets=4), str(folder)).count() == 0


def test_completed_runs_are_closed(spark, lake, monkeypatch):
    run(lake, "r1", FIRST[:2])
    with monkeypatch.context() as patch:
        patch.setattr(gold, "batting_stats", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run(lake, "r2", SECOND[:1])
    assert dr._pending(lake) == ["r2"]
    run(lake, "r3", SECOND[3:])
    assert dr._pending(lake) == []
    run(lake, "r4", FIRST[2:3])
    counts = runlog.latest_task_rows(lake.load("task_log"), "r4").where("task_name = 'build_facts'").first()
    assert counts["updated_count"] == 1


def test_changed_settings(spark, lake):
    run(lake, "r1", FIRST[:2], focus="County Cup")
    assert rows(lake, f"{dr.FACTS}_focus_leagues", "match_id") == ["Row(match_id='102')"]
    run(lake, "r2", FIRST[2:3], focus="Indian Premier League")
    assert rows(lake, f"{dr.FACTS}_focus_leagues", "match_id") == ["Row(match_id='101')"]
    assert rows(lake, f"{dr.FACTS}_other_leagues", "match_id") == ["Row(match_id='102')", "Row(match_id='103')"]
    run(lake, "r3", FIRST[2:3], focus="County Cup")  # nothing new but the list
    assert rows(lake, f"{dr.FACTS}_focus_leagues", "match_id") == ["Row(match_id='102')"]
    with pytest.raises(ValueError, match="buckets"):
        dr.run_lake(lake, dr.Run("r4", buckets=8), documents(spark, *SECOND))
    assert lake.load(dr.RAW).count() == 3


def test_unknown_revision_and_empty_season(spark, lake):
    plain = match(innings("A", [ball("A1", "B1", 1)]), season="2023")
    later = match(innings("A", [ball("A1", "B1", 4)]), season="")
    del later["meta"]["revision"]
    run(lake, "r1", [("7.json", plain)])
    run(lake, "r2", [("7.json", later)])
    assert [(r["season"], r["runs"]) for r in dicts(lake.load(dr.BATTING))] == [(None, 4)]
    assert rows(lake, dr.RAW, "source_revision") == ["Row(source_revision=0)"]


def test_register_without_a_changed_match(spark, lake):
    run(lake, "r1", FIRST[:1])
    register = spark.createDataFrame([("id-a1", "A1", "A1 (A)", "k1", "people.csv")], "identifier string, name string, unique_name string, key_x string, source_file string")
    also = spark.createDataFrame([("id-a1", "Al", "names.csv")] * 2, "identifier string, name string, source_file string")
    dr.run_lake(lake, dr.Run("r2", buckets=4), documents(spark, *FIRST[:1]), register, names=also)
    assert rows(lake, "dim_person_names", "name") == ["Row(name='Al')"]
    assert rows(lake, "unresolved_people", "person_name", "run_id") == ["Row(person_name='B1', run_id='r2')"]


def test_a_repeated_delivery_parses_and_rewrites_nothing(spark, lake, monkeypatch):
    run(lake, "r1", FIRST)
    files = {name: sorted(lake.load(name).inputFiles()) for name in (dr.RAW, dr.VERSIONS, dr.DELIVERIES)}
    seen = []
    parse = dr.docs.parse_documents
    monkeypatch.setattr(dr.docs, "parse_documents", lambda df: (seen.append(sorted(r["source_path"] for r in df.collect())), parse(df))[1])
    run(lake, "r2", FIRST)
    assert seen[0] == ["file:/in/105.json"]  # not a document, so there is no standing version
    assert {name: sorted(lake.load(name).inputFiles()) for name in files} == files
    counts = runlog.latest_task_rows(lake.load("task_log"), "r2").where("task_name = 'ingest_raw'").first()
    assert (counts["input_count"], counts["inserted_count"], counts["skipped_count"], counts["quarantine_count"]) == (5, 0, 4, 1)
