"""Queries over statistics, cards, leaderboards and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.functions.names import DEFAULT_FOCUS
from scorebook.operators import documents as docs
from scorebook.operators import gold, segments
from scorebook.operators.upsert import latest_by_key
from scorebook.plans import oracle as sql
from scorebook.plans.daily_run import DELIVERIES, MATCHES, WICKETS
from scorebook.plans.queries_facts import big
from scorebook.plans.registry import query
from scorebook.plans.workload import all_parts, demo_lake, table
from scorebook.session import materialise

_CARDS = sql.with_(sql.BALLS, sql.BATTING, sql.bowling(False), sql.cards(False))
_SAFE_CARDS = sql.with_(sql.BALLS, sql.BATTING, sql.bowling(True), sql.cards(True))
_TEAM = sql.with_(sql.BALLS, sql.SUMMARY)


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return demo_lake(spark, sf_dir).load(name)


def _cards(spark: SparkSession, sf_dir: str, null_safe: bool = False) -> DataFrame:
    balls = _load(spark, sf_dir, DELIVERIES)
    return gold.player_cards(gold.batting_stats(balls), gold.bowling_stats(balls, null_safe), null_safe)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.team_match_summary(_load(spark, sf_dir, DELIVERIES))


@query(f"{sql.with_(sql.BALLS, sql.BATTING)} SELECT * FROM bat")
def batting_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.batting_stats(_load(spark, sf_dir, DELIVERIES))


@query(f"""
{sql.with_(sql.BALLS)}
SELECT {sql.DIMS}, bowler, {sql.big('count(*)', 'wickets')} FROM d WHERE fallen = 1 AND wicket_kind = 'caught' GROUP BY {sql.DIMS}, bowler
""")
def credited_wickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.credited_wickets(_load(spark, sf_dir, WICKETS))


@query(f"{sql.with_(sql.BALLS, sql.bowling(False))} SELECT * FROM bowl")
def bowling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.bowling_stats(_load(spark, sf_dir, DELIVERIES))


@query(f"{sql.with_(sql.BALLS, sql.bowling(True))} SELECT * FROM bowl")
def bowling_stats_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.bowling_stats(_load(spark, sf_dir, DELIVERIES), null_safe=True)


@query(f"{sql.with_(sql.BALLS, sql.bowling(False))} SELECT * FROM bowl")
def bowling_wickets_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures with wickets counted from the wicket table and joined."""
    totals = gold.bowling_stats(_load(spark, sf_dir, DELIVERIES))
    return gold.with_wickets(totals, gold.credited_wickets(_load(spark, sf_dir, WICKETS)))


@query(f"{_TEAM} SELECT * FROM tm")
def team_match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir)


@query(f"""
{sql.with_(sql.BALLS)}
SELECT match_id, {sql.DIMS}, match_date, batting_team, {sql.big('innings_number', 'innings_number')}, {sql.big('sum(total_runs)', 'team_runs')},
  {sql.big('sum(fallen)', 'wickets_lost')}, {sql.big('sum(legal)', 'legal_balls')}, {sql.half_up('sum(total_runs) * 6', 'sum(legal)')} AS run_rate
FROM d GROUP BY match_id, {sql.DIMS}, match_date, batting_team, innings_number
""")
def team_innings_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return big(gold.team_match_summary(_load(spark, sf_dir, DELIVERIES), by_innings=True), "innings_number")


@query(f"""
{_TEAM},
a AS (SELECT {sql.DIMS}, {sql.half_up('sum(team_runs)', 'count(*)')} AS avg_team_score FROM tm GROUP BY {sql.DIMS}),
s AS (
  SELECT {sql.DIMS}, match_type, {sql.big('count(DISTINCT match_id)', 'matches')}, {sql.big('count(DISTINCT venue)', 'venues')},
    {sql.big('count(DISTINCT winner)', 'winning_teams')} FROM m GROUP BY {sql.DIMS}, match_type
)
SELECT s.*, a.avg_team_score FROM s LEFT JOIN a USING ({sql.DIMS})
""")
def league_season_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.league_season_summary(_load(spark, sf_dir, MATCHES), _summary(spark, sf_dir))


@query(f"{_CARDS} SELECT * FROM cards")
def player_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cards(spark, sf_dir)


@query(f"{_SAFE_CARDS} SELECT * FROM cards")
def player_cards_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cards(spark, sf_dir, null_safe=True)


@query(f"""
{_TEAM}
SELECT {sql.DIMS}, batting_team AS team, {sql.big('count(DISTINCT match_id)', 'innings')},
  {sql.half_up('sum(team_runs)', 'count(*)')} AS avg_score, max(team_runs) AS highest_score,
  CASE WHEN count(run_rate) > 0 THEN CAST((2 * CAST(sum(CAST(round(run_rate * 100) AS BIGINT)) AS BIGINT) + count(run_rate))
    // (2 * count(run_rate)) AS DOUBLE) / 100 END AS avg_run_rate
FROM tm GROUP BY {sql.DIMS}, batting_team
""")
def team_season_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.team_season_cards(_summary(spark, sf_dir))


def _ranked(metric: str, direction: str, groups: str, ties: str, k: int, where: str = "true") -> str:
    return f"""
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY {groups} ORDER BY {metric} {direction}, {ties}) AS BIGINT) AS rank
  FROM cards WHERE {metric} IS NOT NULL AND {where}
)
SELECT {{columns}} FROM r WHERE rank <= {k}"""


_BOARD = "league_name, gender, season, player, rank"


@query(
    f"{_CARDS}, "
    + _ranked("batting_runs", "DESC", "season", "player ASC NULLS LAST, league_name ASC NULLS LAST, gender", 10).format(
        columns=f"{_BOARD}, batting_runs, batting_strike_rate"
    )
)
def leaderboard_runs_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most runs by season."""
    best = gold.leaderboard(_cards(spark, sf_dir), "batting_runs", 10, ["season"], ties=("player", "league_name", "gender"))
    columns = [c.strip() for c in _BOARD.split(",")]
    return big(best.select(*columns, "batting_runs", "batting_strike_rate"), "rank")


@query(f"""
{_CARDS}
SELECT player, league_name, gender, season, batting_runs, batting_strike_rate FROM cards
WHERE league_name = 'Indian Premier League' AND batting_runs IS NOT NULL ORDER BY batting_runs DESC, player, gender, season LIMIT 10
""")
def leaderboard_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most runs in one competition."""
    league = F.col("league_name") == "Indian Premier League"
    best = gold.leaderboard(_cards(spark, sf_dir).where(league), "batting_runs", 10, ties=("player", "gender", "season"))
    return best.select("player", "league_name", "gender", "season", "batting_runs", "batting_strike_rate")


@query(f"""
{_CARDS}
SELECT player, {sql.DIMS}, batting_strike_rate, balls_faced FROM cards
WHERE league_name = 'Indian Premier League' AND balls_faced >= 10 AND batting_strike_rate IS NOT NULL
ORDER BY batting_strike_rate DESC, player, league_group, league_name, gender, season LIMIT 20
""")
def best_strike_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    league = F.col("league_name") == "Indian Premier League"
    best = gold.best_strike_rates(_cards(spark, sf_dir).where(league), 20, min_balls=10)
    return best.select("player", *docs.DIMS, "batting_strike_rate", "balls_faced")


@query(
    f"{_CARDS}, "
    + _ranked(
        "bowling_economy", "ASC", "league_name, season",
        "player, league_group NULLS LAST, league_name NULLS LAST, gender, season", 5, "bowling_legal_balls >= 6",
    ).format(columns=f"{_BOARD}, bowling_economy, bowling_legal_balls")
)
def best_economy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best economy by league and season."""
    best = gold.best_economies(_cards(spark, sf_dir), 5, min_balls=6, by=["league_name", "season"])
    columns = [c.strip() for c in _BOARD.split(",")]
    return big(best.select(*columns, "bowling_economy", "bowling_legal_balls"), "rank")


@query(f"""
{_TEAM}
SELECT league_name, {sql.big('count(*)', 'team_scores')}, {sql.half_up('sum(team_runs)', 'count(*)')} AS avg_team_score FROM tm GROUP BY league_name
""")
def avg_score_by_competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.average_scores(_summary(spark, sf_dir))


@query(f"""
{sql.with_(sql.MATCHES)}
SELECT match_id, match_date, team_1, team_2, venue, winner FROM m
WHERE (team_1 = 'NATION_3 A' OR team_2 = 'NATION_3 A') AND venue = 'NATION_3'
""")
def team_matches_at_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    played = gold.team_matches_at(_load(spark, sf_dir, MATCHES), "NATION_3 A", "NATION_3")
    return played.select("match_id", "match_date", "team_1", "team_2", "venue", "winner")


# -------------------------------------------------------------------- segments

_FOCUS_SQL = "league_name IN ('Indian Premier League', 'Women''s Big Bash League')"


@query(f"{_CARDS} SELECT *, 'focus_leagues' AS league_segment FROM cards WHERE {_FOCUS_SQL}")
def segment_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.split_segments(_cards(spark, sf_dir), DEFAULT_FOCUS)[segments.FOCUS]


@query(f"{_CARDS} SELECT *, 'other_leagues' AS league_segment FROM cards WHERE NOT coalesce({_FOCUS_SQL}, false)")
def segment_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.split_segments(_cards(spark, sf_dir), DEFAULT_FOCUS)[segments.OTHER]


def _league_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration rows from the matches: competitions won by a first team somewhere are enabled."""
    matches = _load(spark, sf_dir, MATCHES)
    firsts = F.count_if(F.col("winner") == F.col("team_1")) * 2 >= F.count("winner")
    return matches.groupBy("league_name").agg(firsts.alias("enabled"))


@query(f"""
{_TEAM},
f AS (SELECT league_name FROM m GROUP BY 1 HAVING count(*) FILTER (winner = team_1) * 2 >= count(winner) AND league_name IS NOT NULL),
pick AS (SELECT league_name FROM f UNION ALL SELECT unnest([{', '.join("'" + n.replace("'", "''") + "'" for n in DEFAULT_FOCUS)}]) WHERE NOT EXISTS (SELECT 1 FROM f))
SELECT league_name, CASE WHEN league_name IN (SELECT league_name FROM pick) THEN 'focus_leagues' ELSE 'other_leagues' END AS league_segment,
  {sql.big('count(*)', 'team_scores')}
FROM tm GROUP BY 1
""")
def segment_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split by a configuration table instead of a list."""
    focus = materialise(segments.focus_leagues(_league_config(spark, sf_dir)), "focus")
    labelled = segments.with_segment(_summary(spark, sf_dir).select("league_name"), focus)
    return labelled.groupBy("league_name", "league_segment").agg(F.count("*").alias("team_scores"))


@query(f"""
{sql.with_(sql.MATCHES)}
SELECT match_id, CASE WHEN league_name <> 'County Cup' THEN 'focus_leagues' ELSE 'other_leagues' END AS league_segment FROM m
""")
def segment_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _load(spark, sf_dir, MATCHES).select("match_id", "league_name")
    return segments.with_segment(facts, DEFAULT_FOCUS, match="normalised").select("match_id", "league_segment")


@query(f"""
{sql.with_(sql.BALLS)}
SELECT CASE WHEN league_name LIKE '%Premier League%' THEN 'IPL' WHEN league_name LIKE '%Big Bash%' THEN 'Big Bash'
  WHEN league_name LIKE 'The Hundred%' THEN 'The Hundred' ELSE league_name END AS league_group, 'unknown' AS gender, {sql.big('count(*)', 'balls')}
FROM d GROUP BY 1
""")
def default_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and gender filled in on a table that lacks both."""
    bare = gold.real_balls(_load(spark, sf_dir, DELIVERIES)).drop("league_group", "gender")
    return segments.ensure_dimensions(bare).groupBy("league_group", "gender").agg(F.count("*").alias("balls"))


@query(f"""
{sql.with_(sql.BALLS, sql.BATTING)}
SELECT * FROM bat WHERE league_name = 'Women''s Big Bash League'
""")
def scoped_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batting figures rebuilt from the raw documents of listed competitions only."""
    listed = docs.in_leagues(all_parts(demo_lake(spark, sf_dir)), ["Women's Big Bash League"])
    return gold.batting_stats(docs.build_deliveries(listed))


@query("""
SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role) AS rn FROM conversations) WHERE rn = 1
""")
def latest_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last row per key on the conversation table."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("n"))
    return latest_by_key(turns, ["conv_id"], [F.col("turn").desc(), F.col("role").asc()])


_NORMAL = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""
WITH c AS (SELECT p_name || ' #' || p_partkey % 40 AS shown, min(p_size) AS priority FROM part GROUP BY 1),
e AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) || ' ' || p_partkey % 400 || ' Cup' WHEN p_partkey % 5 > 0 THEN split_part(p_name, ' ', 2) || '-' || p_partkey % 40 END AS event FROM part),
n AS (SELECT DISTINCT event, {_NORMAL.format('event')} AS x FROM e WHERE event IS NOT NULL),
h AS (SELECT n.event, arg_min(c.shown, (c.priority, c.shown)) AS hit FROM n JOIN c
  ON contains(n.x, {_NORMAL.format('c.shown')}) OR contains({_NORMAL.format('c.shown')}, n.x) GROUP BY n.event)
SELECT p_partkey, coalesce(h.hit, e.event, 'Unknown') AS bucket, h.hit IS NOT NULL AS is_focus FROM e LEFT JOIN h ON h.event = e.event
""")
def bucket_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names against a table of configured names that contain them or are contained, the first by priority."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    config = part.groupBy(F.concat("p_name", F.lit(" #"), key % 40).alias("league_name")).agg(F.min("p_size").alias("priority"))
    full = F.concat(F.upper("p_name"), F.lit(" "), key % 400, F.lit(" Cup"))
    short = F.when(key % 5 > 0, F.concat(F.element_at(F.split("p_name", " "), 2), F.lit("-"), key % 40))
    named = part.select("p_partkey", F.when(key % 2 == 0, full).otherwise(short).alias("league_name"))
    return segments.bucket_by_table(named, config).drop("league_name")
