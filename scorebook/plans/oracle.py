"""SQL building blocks of the oracles: matches and balls straight from the flat tables."""

from __future__ import annotations

from scorebook.plans.workload import COMPETITIONS

_LEAGUE = "CASE c_mktsegment " + " ".join(
    "WHEN '{}' THEN '{}'".format(segment, title.replace("'", "''")) for segment, title in COMPETITIONS.items()
) + " END"

MATCHES = f"""
m0 AS (
  SELECT o_orderkey AS k, o_custkey AS buyer, CAST(o_orderkey AS VARCHAR) AS match_id,
         strftime(o_orderdate, '%Y') AS season, CAST(o_orderdate AS DATE) AS match_date,
         {_LEAGUE} AS league_name, o_orderstatus AS gender, o_orderpriority AS match_type,
         n_name AS venue, r_name AS city, n_name || ' A' AS team_1, n_name || ' B' AS team_2
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
m AS (
  SELECT *,
    CASE WHEN league_name LIKE '%Premier League%' THEN 'IPL' WHEN league_name LIKE '%Big Bash%' THEN 'Big Bash'
         WHEN league_name LIKE 'The Hundred%' THEN 'The Hundred' ELSE league_name END AS league_group,
    CASE WHEN k % 2 = 0 THEN team_1 ELSE team_2 END AS toss_winner,
    CASE WHEN k % 3 = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
    CASE WHEN buyer % 10 = 0 THEN NULL WHEN buyer % 2 = 0 THEN team_1 ELSE team_2 END AS winner,
    CASE WHEN buyer % 10 <> 0 AND k % 2 = 0 THEN buyer % 50 + 1 END AS win_by_runs,
    CASE WHEN buyer % 10 <> 0 AND k % 2 = 1 THEN buyer % 10 END AS win_by_wickets,
    CASE WHEN buyer % 10 = 0 THEN CASE WHEN k % 2 = 0 THEN 'tie' ELSE 'no result' END END AS result,
    'P' || (buyer % 40) AS players_of_match
  FROM m0
)"""

BALLS = MATCHES + """,
b0 AS (
  SELECT *, CAST(l_quantity AS INT) % 7 AS batter_runs,
    CASE WHEN l_returnflag = 'R' AND l_partkey % 10 = 0 THEN 1 END AS wides,
    CASE WHEN l_returnflag = 'N' AND l_partkey % 25 = 0 THEN 1 END AS noballs,
    CASE WHEN l_returnflag = 'A' AND l_partkey % 10 = 3 THEN 1 END AS legbyes,
    dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_linestatus) AS innings_number,
    l_linenumber - 1 AS over_number,
    row_number() OVER (PARTITION BY l_orderkey, l_linestatus, l_linenumber
                       ORDER BY l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag) AS delivery_sequence
  FROM lineitem
),
d AS (
  SELECT m.*, innings_number, over_number, delivery_sequence, batter_runs, wides, noballs, legbyes,
    coalesce(wides, 0) + coalesce(noballs, 0) + coalesce(legbyes, 0) AS extras_runs,
    batter_runs + coalesce(wides, 0) + coalesce(noballs, 0) + coalesce(legbyes, 0) AS total_runs,
    CASE WHEN wides IS NULL AND noballs IS NULL THEN 1 ELSE 0 END AS legal,
    (l_linenumber - 1) || '.' || (l_partkey % 6 + 1) AS actual_delivery,
    'P' || ((l_suppkey * 7 + l_linenumber) % 40) AS batter,
    'P' || (20 + l_partkey % 60) AS bowler,
    'P' || ((l_suppkey * 7 + l_linenumber + 1) % 40) AS non_striker,
    CASE WHEN l_linestatus = 'F' THEN team_1 ELSE team_2 END AS batting_team,
    CASE WHEN l_discount = 0.1 THEN 1 ELSE 0 END AS fallen,
    CASE WHEN l_suppkey % 4 = 0 THEN 'run out' ELSE 'caught' END AS wicket_kind,
    'P' || (l_suppkey % 40) AS fielder
  FROM b0 JOIN m ON m.k = b0.l_orderkey
)"""

DIMS = "league_group, league_name, gender, season"


def half_up(numerator: str, denominator: str) -> str:
    """``numerator / denominator`` to two decimals, halves up, in whole numbers."""
    n, d = f"CAST({numerator} AS BIGINT)", f"CAST({denominator} AS BIGINT)"
    return f"CASE WHEN {d} > 0 THEN CAST(({n} * 200 + {d}) // (2 * {d}) AS DOUBLE) / 100 END"


def big(expression: str, alias: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {alias}"


BATTING = f"""
bat AS (
  SELECT {DIMS}, batter AS player, {big('count(DISTINCT match_id)', 'matches')}, {big('sum(batter_runs)', 'runs')},
    {big('sum(legal)', 'balls_faced')}, {big('count(*) FILTER (batter_runs = 4)', 'fours')},
    {big('count(*) FILTER (batter_runs = 6)', 'sixes')},
    {half_up('sum(batter_runs) * 100', 'sum(legal)')} AS strike_rate
  FROM d GROUP BY {DIMS}, batter
)"""


def bowling(null_safe: bool) -> str:
    credited = "sum(CASE WHEN fallen = 1 AND wicket_kind = 'caught' THEN 1 ELSE 0 END)"
    counted = credited if null_safe else f"CASE WHEN league_name IS NULL THEN 0 ELSE {credited} END"
    return f"""
bowl AS (
  SELECT {DIMS}, bowler, {big('count(DISTINCT match_id)', 'matches')}, {big('sum(legal)', 'legal_balls')},
    {big('sum(total_runs)', 'runs_conceded')}, {big('sum(total_runs - coalesce(legbyes, 0))', 'runs_charged')},
    {big('count(*) FILTER (total_runs = 0)', 'dot_balls')}, {big(counted, 'wickets')},
    {half_up('sum(legal)', '6')} AS overs, {half_up('sum(total_runs) * 6', 'sum(legal)')} AS economy
  FROM d GROUP BY {DIMS}, bowler
)"""


SUMMARY = f"""
tm AS (
  SELECT match_id, {DIMS}, match_date, batting_team, {big('sum(total_runs)', 'team_runs')},
    {big('sum(fallen)', 'wickets_lost')}, {big('sum(legal)', 'legal_balls')},
    {half_up('sum(total_runs) * 6', 'sum(legal)')} AS run_rate
  FROM d GROUP BY match_id, {DIMS}, match_date, batting_team
)"""


def cards(null_safe: bool) -> str:
    same = "IS NOT DISTINCT FROM" if null_safe else "="
    on = " AND ".join(f"bat.{c} {same} bowl.{c}" for c in DIMS.split(", "))
    keys = ", ".join(f"coalesce(bat.{c}, bowl.{c}) AS {c}" for c in DIMS.split(", "))
    return f"""
cards AS (
  SELECT {keys}, coalesce(bat.player, bowl.bowler) AS player, bat.matches AS batting_matches, bat.runs AS batting_runs,
    balls_faced, strike_rate AS batting_strike_rate, fours, sixes, bowl.matches AS bowling_matches,
    legal_balls AS bowling_legal_balls, runs_conceded, wickets AS bowling_wickets, economy AS bowling_economy
  FROM bat FULL JOIN bowl ON {on} AND bat.player {same} bowl.bowler
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)
