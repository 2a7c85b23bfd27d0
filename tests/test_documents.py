from __future__ import annotations

import datetime

from helpers import ball, dicts, documents, innings, match, parsed
from pyspark.sql import functions as F

from scorebook.operators import documents as docs
from scorebook.operators import gold
from scorebook.operators.nested import unpivot_prefix
from scorebook.sources.files import only_listed, read_documents, read_register, select_inputs

G1 = match(
    innings(
        "A",
        [ball("A1", "B1", 4), ball("A1", "B1", 6), ball("A2", "B1", 0, {"wides": 1}), ball("A2", "B1", 0)],
        [
            ball("A2", "B2", 1, {"noballs": 1}),
            ball("A1", "B2", 0, {"byes": 2}),
            ball("A1", "B2", 0, None, [{"kind": "caught", "player_out": "A1", "fielders": [{"name": "B3"}]}]),
            ball("A2", "B2", 0, None, [{"kind": "run out", "player_out": "A2"}, {"kind": "bowled", "player_out": "A3"}]),
        ],
    ),
    innings("B", [ball("B1", "A1", 2), ball("B1", "A1", 0, {"legbyes": 1})]),
)


def test_matches(spark):
    row = dicts(docs.build_matches(parsed(spark, ("101.json", G1))))[0]
    assert row["match_id"] == "101" and row["match_date"] == datetime.date(2024, 4, 1)
    assert (row["league_group"], row["team_1"], row["team_2"], row["win_by_runs"], row["win_by_wickets"]) == ("IPL", "A", "B", 3, None)
    assert row["event_match_number"] == "1" and row["players_of_match"] == ["A1"] and row["source_revision"] == 1
    assert len(row["match_record_hash"]) == 64


def test_short_arrays_and_bad_dates_give_null(spark):
    odd = match(teams=("A",), date="sometime", season=2024)
    row = dicts(docs.build_matches(parsed(spark, ("5.json", odd))))[0]
    assert (row["team_1"], row["team_2"], row["match_date"], row["source_created_date"], row["season"]) == ("A", None, None, None, "2024")


def test_duplicate_ids_keep_the_highest_revision(spark):
    rows = parsed(spark, ("a/7.json", match(revision=1)), ("b/7.json", match(revision=3)), ("c/7.json", match(revision=2)))
    assert [(r["match_id"], r["source_revision"]) for r in dicts(docs.build_matches(rows))] == [("7", 3)]


def test_deliveries_and_wickets(spark):
    balls = docs.build_deliveries(parsed(spark, ("101.json", G1)))
    rows = dicts(balls, "innings_number", "over_number", "delivery_sequence")
    assert [(r["innings_number"], r["over_number"], r["delivery_sequence"], r["total_runs"]) for r in rows] == [
        (1, 0, 1, 4), (1, 0, 2, 6), (1, 0, 3, 1), (1, 0, 4, 0), (1, 1, 1, 2), (1, 1, 2, 2), (1, 1, 3, 0), (1, 1, 4, 0), (2, 0, 1, 2), (2, 0, 2, 1),
    ]
    assert rows[0]["innings_index"] == 0 and rows[0]["competition_name"] == "Indian Premier League"
    fallen = dicts(docs.build_wickets(balls), "over_number", "delivery_sequence", "wicket_index")
    assert [(w["delivery_sequence"], w["wicket_index"], w["wicket_kind"], w["player_out"]) for w in fallen] == [
        (3, 0, "caught", "A1"), (4, 0, "run out", "A2"), (4, 1, "bowled", "A3"),
    ]
    assert fallen[0]["fielders"] == [{"name": "B3"}]


def test_empty_levels_stay_visible_but_do_not_count(spark):
    empty = [match(), match({"team": "A"}), match({"team": "A", "overs": [{"over": 0}]}), match({"team": "A", "overs": [{"over": 3, "deliveries": []}]})]
    balls = docs.build_deliveries(parsed(spark, *[(f"{i}.json", m) for i, m in enumerate(empty)]))
    rows = dicts(balls, "match_id")
    assert [(r["batting_team"], r["over_number"], r["delivery_index"]) for r in rows] == [(None, None, None), ("A", None, None), ("A", 0, None), ("A", 3, None)]
    assert gold.real_balls(balls).count() == 0


def test_malformed_text_is_marked(spark):
    rows = dicts(parsed(spark, ("1.json", "{\"info\": "), ("2.json", match()), ("3.json", "plain words")), "match_id")
    assert [(r["match_id"], r["record_status"], r["parse_error"] is None) for r in rows] == [
        ("1", "malformed", False), ("2", "valid", True), ("3", "malformed", False),
    ]


def test_fields_of_another_type_are_null_and_named(spark):
    """The rest of such a document stays in the facts; text that is no object does not."""
    one = match(innings("A", [ball("A1", "B1", 1), ball("A1", "B1", 2)], [ball("A1", "B1", 4)]))
    one["innings"][0]["overs"][0]["deliveries"][1]["runs"]["batter"] = 1.5
    two = match(innings("A", [ball("A1", "B1", 1)]))
    two["info"]["teams"], two["meta"]["revision"], two["info"]["outcome"]["by"]["runs"] = "X", "7", 3_000_000_000
    three = match(innings("A", [ball("A1", "B1", 1)]))
    three["innings"][0]["overs"], three["info"]["registry"]["people"], three["info"]["venue"] = {"a": 1}, [1], 12
    rows = parsed(spark, ("1.json", one), ("2.json", two), ("3.json", three), ("4.json", "[1]"), ("5.json", "3"), ("6.json", ""), ("7.json", "{}"))
    status = {r["match_id"]: (r["record_status"], r["parse_error"]) for r in dicts(rows)}
    assert {k: v[0] for k, v in status.items()} == {"1": "valid", "2": "valid", "3": "valid", "4": "malformed", "5": "malformed", "6": "malformed", "7": "valid"}
    assert {k for k, v in status.items() if v[1] == docs.UNFIT} == {"1", "2", "3"} and status["7"][1] is None
    valid = rows.where("record_status = 'valid'")
    balls = dicts(docs.build_deliveries(valid).where("match_id = '1'"), "over_number", "delivery_index")
    assert [(r["batter_runs"], r["total_runs"]) for r in balls] == [(1, 1), (None, 2), (4, 4)]
    facts = {r["match_id"]: r for r in dicts(docs.build_matches(valid))}
    assert facts["2"]["teams"] is None and facts["2"]["win_by_runs"] is None and facts["2"]["season"] == "2024" and facts["3"]["venue"] == "12"
    assert sorted((r["match_id"], r["path"], r["expected"], r["value"]) for r in dicts(docs.field_warnings(rows))) == [
        ("1", "innings.overs.deliveries.runs.batter", "int", "1.5"),
        ("2", "info.outcome.by.runs", "int", "3000000000"), ("2", "info.teams", "list", '"X"'), ("2", "meta.revision", "int", '"7"'),
        ("3", "info.registry.people", "object", "[1]"), ("3", "innings.overs", "list", '{"a": 1}'),
    ]


def test_league_filter_and_change_feed(spark):
    rows = parsed(spark, ("1.json", match(event="Cup")), ("2.json", match()), ("3.json", match(event=None)))
    assert [r["match_id"] for r in dicts(docs.in_leagues(rows, ["Cup"]))] == ["1"]
    assert docs.in_leagues(rows, []).count() == 3
    assert docs.changed_in_run(rows, ["r1"]).count() == 3 and docs.changed_in_run(rows, ["r2"]).count() == 0


def test_dimensions_have_one_row_per_key(spark):
    rows = parsed(spark, ("1.json", match()), ("2.json", match(season="2023")), ("3.json", match(event=None, venue=None)))
    teams = docs.match_teams(rows)
    assert dicts(docs.dim_team(teams), "team_name") == [
        {"team_name": "A", "first_season": "2023", "last_season": "2024", "matches": 3},
        {"team_name": "B", "first_season": "2023", "last_season": "2024", "matches": 3},
    ]
    assert [(r["venue"], r["matches"]) for r in dicts(docs.dim_venue(teams))] == [("Ground", 2)]
    assert [(r["league_name"], r["matches"]) for r in dicts(docs.dim_competition(teams))] == [("Indian Premier League", 2)]


def test_register_and_unresolved_people(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text('identifier,name,unique_name,key_x,key_y\nid-a1,"Al ""Ace"" One",Al One,11,\nid-zz,Zed,Zed,  ,22\n')
    register = read_register(spark, str(path), "people.csv")
    people = docs.people_dim(register)
    assert [r["name"] for r in dicts(people, "identifier")] == ['Al "Ace" One', "Zed"]
    assert '"key_y":"22"' in dicts(people, "identifier")[1]["raw_json"]
    long = dicts(unpivot_prefix(register, "key_", ["identifier"], "source", "id"), "source")
    assert long == [{"identifier": "id-a1", "source": "x", "id": "11"}, {"identifier": "id-zz", "source": "y", "id": "22"}]
    assert unpivot_prefix(register.drop("key_x", "key_y"), "key_", ["identifier"], "source", "id").count() == 0
    registry = docs.build_person_registry(parsed(spark, ("1.json", match())))
    assert [(r["person_name"], r["source_role"]) for r in dicts(docs.unresolved_people(registry, people))] == [("B1", "registry")]


def test_file_scan_and_selection(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"a":\n 1}\n')
    (tmp_path / "2.json").write_text("{}")
    scanned = read_documents(spark, f"{tmp_path}/*.json")
    assert sorted(r["raw_json"] for r in dicts(scanned)) == ['{"a":\n 1}\n', "{}"]
    manifest = spark.createDataFrame(
        [(f"{tmp_path}/1.json", ".json", "1.json", "extracted", "r1"), (f"{tmp_path}/1.json", ".json", "1.json", "extracted", "r1"),
         (f"{tmp_path}/2.json", ".json", "2.json", "failed", "r1"), (f"{tmp_path}/3.csv", ".csv", "3.csv", "extracted", "r2")],
        "extracted_path string, file_extension string, source_filename string, extraction_status string, run_id string",
    )
    inputs = select_inputs(manifest, "r1")
    assert [r["extracted_path"] for r in dicts(inputs)] == [f"{tmp_path}/1.json"]
    assert only_listed(scanned, inputs).count() == 1
    assert select_inputs(manifest, "r2").count() == 0 and select_inputs(manifest, "r2", ".csv").count() == 1


def test_lineage(spark):
    manifest = spark.createDataFrame(
        [("/in/1.json", "z.zip", "zz", "hh", "1.json"), ("/in/1.json", "z.zip", "zz", "hh", "1.json")],
        "extracted_path string, zip_path string, zip_sha256 string, file_sha256 string, match_id_candidate string",
    )
    joined = docs.attach_lineage(documents(spark, ("1.json", match()), ("x.json", match())), manifest)
    rows = dicts(docs.shape_raw(docs.parse_documents(joined), "r").select("source_file", "zip_path", "source_file_sha256", F.length("source_file_sha256").alias("n")), "source_file")
    assert [(r["source_file"], r["zip_path"], r["n"]) for r in rows] == [("1.json", "z.zip", 2), ("x.json", None, 64)]
