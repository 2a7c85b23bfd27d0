from __future__ import annotations

import random

import pytest
from helpers import ball, dicts, innings, match, parsed
from pyspark.sql import functions as F
from test_documents import G1

from scorebook.functions import names
from scorebook.functions.names import DEFAULT_FOCUS
from scorebook.operators import documents as docs
from scorebook.operators import gold, segments


def balls_of(spark, *files):
    return docs.build_deliveries(parsed(spark, *files)).persist()


def test_batting(spark):
    rows = {r["player"]: r for r in dicts(gold.batting_stats(balls_of(spark, ("1.json", G1))))}
    a1, a2 = rows["A1"], rows["A2"]
    assert (a1["matches"], a1["runs"], a1["balls_faced"], a1["fours"], a1["sixes"], a1["strike_rate"]) == (1, 10, 4, 1, 1, 250.0)
    assert (a2["runs"], a2["balls_faced"], a2["strike_rate"]) == (1, 2, 50.0)


def test_bowling_counts_wickets_in_both_ways(spark):
    balls = balls_of(spark, ("1.json", G1), ("2.json", match(innings("A", [ball(wickets=[{"kind": "Run Out"}, {"kind": None}, {"kind": "lbw"}])]))))
    figures = gold.bowling_stats(balls)
    rows = {r["bowler"]: r for r in dicts(figures)}
    b2 = rows["B2"]
    assert (b2["legal_balls"], b2["runs_conceded"], b2["runs_charged"], b2["dot_balls"], b2["wickets"]) == (3, 4, 2, 2, 2)
    assert (b2["overs"], b2["economy"]) == (0.5, 8.0)
    assert rows["B1"]["wickets"] == 1
    joined = gold.with_wickets(figures, gold.credited_wickets(docs.build_wickets(balls)))
    assert figures.exceptAll(joined.select(figures.columns)).count() == 0


def test_explicit_zero_extras_are_legal(spark):
    rows = dicts(gold.batting_stats(balls_of(spark, ("1.json", match(innings("A", [ball(runs=1, extras={"wides": 0, "noballs": 0})]))))))
    assert rows[0]["balls_faced"] == 1


def test_only_wides_give_no_rate(spark):
    balls = balls_of(spark, ("1.json", match(innings("A", [ball(extras={"wides": 5})]))))
    assert dicts(gold.batting_stats(balls))[0]["strike_rate"] is None
    assert dicts(gold.bowling_stats(balls))[0]["economy"] is None
    assert dicts(gold.team_match_summary(balls))[0]["run_rate"] is None
    assert dicts(gold.team_season_cards(gold.team_match_summary(balls)))[0]["avg_run_rate"] is None


def test_two_innings_of_one_team_merge_unless_asked(spark):
    balls = balls_of(spark, ("1.json", match(innings("A", [ball(runs=4)]), innings("B", [ball(runs=1)]), innings("A", [ball(runs=2)]))))
    merged = {r["batting_team"]: r["team_runs"] for r in dicts(gold.team_match_summary(balls))}
    assert merged == {"A": 6, "B": 1}
    apart = dicts(gold.team_match_summary(balls, by_innings=True), "innings_number")
    assert [(r["innings_number"], r["team_runs"]) for r in apart] == [(1, 4), (2, 1), (3, 2)]
    cards = {r["team"]: r for r in dicts(gold.team_season_cards(gold.team_match_summary(balls)))}
    assert (cards["A"]["innings"], cards["A"]["avg_score"], cards["A"]["highest_score"]) == (1, 6.0, 6)


def test_summary_counts_wickets(spark):
    rows = {r["batting_team"]: r for r in dicts(gold.team_match_summary(balls_of(spark, ("1.json", G1))))}
    assert (rows["A"]["team_runs"], rows["A"]["wickets_lost"], rows["A"]["legal_balls"], rows["A"]["run_rate"]) == (15, 3, 6, 15.0)
    assert (rows["B"]["team_runs"], rows["B"]["wickets_lost"]) == (3, 0)


def test_league_summary(spark):
    files = [("1.json", G1), ("2.json", match(outcome={"result": "tie"}, venue="Other")), ("3.json", match(innings("A", [ball(runs=1)]), event=None))]
    rows = parsed(spark, *files)
    summary = gold.team_match_summary(docs.build_deliveries(rows))
    got = {r["league_name"]: r for r in dicts(gold.league_season_summary(docs.build_matches(rows), summary))}
    ipl = got["Indian Premier League"]
    assert (ipl["matches"], ipl["venues"], ipl["winning_teams"], ipl["avg_team_score"]) == (2, 2, 1, 9.0)
    assert got[None]["avg_team_score"] is None


@pytest.mark.parametrize("null_safe, cards, wickets", [(False, 2, 0), (True, 1, 1)])
def test_cards_of_matches_without_event(spark, null_safe, cards, wickets):
    lonely = match(innings("A", [ball("X", "X", 2, None, [{"kind": "bowled"}])]), event=None)
    balls = balls_of(spark, ("1.json", lonely))
    got = dicts(gold.player_cards(gold.batting_stats(balls), gold.bowling_stats(balls, null_safe), null_safe))
    assert len(got) == cards
    assert sum(r["bowling_wickets"] or 0 for r in got) == wickets
    assert sum(r["batting_runs"] or 0 for r in got) == 2


def test_cards_hold_all_three_kinds_of_player(spark):
    balls = balls_of(spark, ("1.json", G1))
    got = {r["player"]: r for r in dicts(gold.player_cards(gold.batting_stats(balls), gold.bowling_stats(balls)))}
    assert got["A1"]["batting_runs"] == 10 and got["A1"]["runs_conceded"] == 3
    assert got["A2"]["bowling_matches"] is None and got["B2"]["batting_matches"] is None


def test_sums_agree(spark):
    pick = random.Random(7)
    made = [
        (f"{n}.json", match(*[innings(t, [ball(f"P{pick.randrange(5)}", f"Q{pick.randrange(4)}", pick.randrange(7)) for _ in range(9)]) for t in "AB"], season=str(2020 + n % 3)))
        for n in range(12)
    ]
    balls = balls_of(spark, *made)
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    runs = total(balls, "total_runs")
    assert runs == total(gold.batting_stats(balls), "runs") == total(gold.bowling_stats(balls), "runs_conceded")
    assert runs == total(gold.team_match_summary(balls), "team_runs")


def test_leaderboards_break_ties_by_player(spark):
    cards = spark.createDataFrame(
        [("b", "2024", 9, 5.0, 10), ("a", "2024", 9, None, 10), ("c", "2023", 1, 7.0, 2), ("d", "2023", None, 8.0, 30)],
        "player string, season string, batting_runs int, batting_strike_rate double, balls_faced int",
    )
    assert [r["player"] for r in dicts(gold.leaderboard(cards, "batting_runs", 2))] == ["a", "b"]
    by = dicts(gold.leaderboard(cards, "batting_runs", 1, ["season"]), "season")
    assert [(r["season"], r["player"], r["rank"]) for r in by] == [("2023", "c", 1), ("2024", "a", 1)]
    assert [r["player"] for r in dicts(gold.leaderboard(cards, "batting_strike_rate", 9, ascending=True))] == ["b", "c", "d"]


def test_workload_questions(spark):
    rows = parsed(spark, ("1.json", G1), ("2.json", match(venue="Other")))
    matches, balls = docs.build_matches(rows), docs.build_deliveries(rows)
    assert [r["match_id"] for r in dicts(gold.team_matches_at(matches, "B", "Other"))] == ["2"]
    fallen = gold.innings_wickets(docs.build_wickets(balls), "1", 1)
    assert [r["player_out"] for r in fallen.collect()] == ["A1", "A2", "A3"]
    assert dicts(gold.average_scores(gold.team_match_summary(balls)))[0]["avg_team_score"] == 9.0


@pytest.mark.parametrize("as_table", [False, True])
def test_segments_are_a_partition_of_the_input(spark, as_table):
    facts = spark.createDataFrame([("SA20",), ("Cup",), (None,), ("SA20",), ("",)], "league_name string")
    config = spark.createDataFrame([("SA20", True), ("Cup", False), ("SA20", True)], "league_name string, enabled boolean")
    focus = segments.focus_leagues(config) if as_table else DEFAULT_FOCUS
    parts = segments.split_segments(facts, focus)
    assert {name: df.count() for name, df in parts.items()} == {"focus_leagues": 2, "other_leagues": 3}
    union = parts["focus_leagues"].unionByName(parts["other_leagues"]).drop("league_segment")
    assert facts.exceptAll(union).count() == union.exceptAll(facts).count() == 0


def test_focus_order_of_sources(spark):
    config = spark.createDataFrame([("X", True), ("Y", False)], "league_name string, enabled boolean")
    listed = lambda df: sorted(r["league_name"] for r in df.collect())
    assert listed(segments.focus_leagues(config, "a, b")) == ["a", "b"]
    assert listed(segments.focus_leagues(config)) == ["X"]
    assert listed(segments.focus_leagues(config.where("false"))) == sorted(DEFAULT_FOCUS)


def test_normalised_segments(spark):
    facts = spark.createDataFrame([("The Hundred Men's Competition",), ("",), ("Ligue Écossaise",)], "league_name string")
    got = dicts(segments.with_segment(facts, DEFAULT_FOCUS, match="normalised"))
    assert [r["league_segment"] for r in got] == ["focus_leagues", "other_leagues", "other_leagues"]
    exact = dicts(segments.with_segment(facts, DEFAULT_FOCUS))
    assert {r["league_segment"] for r in exact} == {"other_leagues"}


def test_default_dimensions(spark):
    bare = spark.createDataFrame([("Big Bash League",)], "league_name string")
    assert dicts(segments.ensure_dimensions(bare)) == [{"league_name": "Big Bash League", "league_group": "Big Bash", "gender": "unknown"}]
    full = bare.withColumns({"league_group": F.lit("g"), "gender": F.lit("f")})
    assert dicts(segments.ensure_dimensions(full))[0]["league_group"] == "g"


def test_names_by_table_equal_names_by_list(spark):
    """The same answer as the list compared one by one, in both directions, with ties, odd names and priority."""
    rng = random.Random(5)
    parts = ["cup", "League", "of", "the", "Big-Bash", "T20", "a", "x", "Ünion", "2024"]
    name = lambda: " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))
    config = list(dict.fromkeys(name() for _ in range(60))) + ["cup!", "CUP", "??"]
    events = [name() for _ in range(120)] + ["", None, "!!", "a", "cu", "cup", "qqq"]
    order = {shown: i for i, shown in enumerate(config)}
    listed = [shown for shown in config if shown != "??"]  # a name without letters or digits matches nothing in the table form
    df = spark.createDataFrame([(i, e, "k") for i, e in enumerate(events)], "id int, league_name string, wanted string")
    table = spark.createDataFrame([(n, order[n]) for n in config], "league_name string, priority int")
    by_list = df.select("id", names.competition_bucket(F.col("league_name"), listed).alias("f")).select("id", "f.bucket", "f.is_focus")
    by_table = segments.bucket_by_table(df, table)
    assert by_table.columns == ["id", "league_name", "wanted", "bucket", "is_focus"]
    got = {r["id"]: (r["bucket"], r["is_focus"]) for r in dicts(by_table)}
    assert got == {r["id"]: (r["bucket"], r["is_focus"]) for r in dicts(by_list)} and sum(f for _, f in got.values()) > 50
    labelled = {r["id"]: r["league_segment"] == segments.FOCUS for r in dicts(segments.with_segment(df, table, match="normalised"))}
    assert labelled == {i: f for i, (_, f) in got.items()}
    assert dicts(segments.bucket_by_table(df, table.limit(0)).where("is_focus")) == [] and segments.bucket_by_table(df.limit(0), table).count() == 0


def test_many_configured_names(spark):
    config = spark.range(10_000).select(F.concat(F.lit("the common league "), F.col("id")).alias("league_name"))
    df = spark.createDataFrame([(1, "The Common League 777 (men)"), (2, "league 99999"), (3, "common"), (4, "league 999")], "id int, league_name string")
    got = {r["id"]: (r["bucket"], r["is_focus"]) for r in dicts(segments.bucket_by_table(df, config))}
    assert got == {1: ("the common league 7", True), 2: ("league 99999", False), 3: ("the common league 0", True), 4: ("the common league 999", True)}
