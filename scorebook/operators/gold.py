"""Statistics and serving cards from deliveries and matches.

Every aggregate combines on the map side. Distinct match counts put ``match_id`` into the first exchange
key, so a player, team or league with a large share of all balls is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.functions.rules import count_when, credits_bowler, is_legal_ball, rate, runs_charged
from scorebook.operators.documents import DIMS
from scorebook.operators.upsert import top_by_group


def real_balls(deliveries: DataFrame) -> DataFrame:
    """Without the placeholder rows of matches, innings or overs that have no balls."""
    return deliveries.where(F.col("delivery_index").isNotNull())


def _legal_balls() -> Column:
    return count_when(is_legal_ball(F.col("extras")))


def batting_stats(deliveries: DataFrame) -> DataFrame:
    hit = F.col("batter_runs")
    totals = real_balls(deliveries).groupBy(*DIMS, F.col("batter").alias("player")).agg(
        F.count_distinct("match_id").alias("matches"),
        F.sum(hit).alias("runs"),
        _legal_balls().alias("balls_faced"),
        count_when(hit == 4).alias("fours"),
        count_when(hit == 6).alias("sixes"),
    )
    return totals.withColumn("strike_rate", rate(F.col("runs"), 100, F.col("balls_faced")))


def credited_wickets(wickets: DataFrame) -> DataFrame:
    """Dismissals credited to each bowler."""
    counted = wickets.where(credits_bowler(F.col("wicket_kind")))
    return counted.groupBy(*DIMS, "bowler").agg(F.count("*").alias("wickets"))


def _ball_credits() -> Column:
    """Credited dismissals on one ball, straight from its nested array."""
    credited = F.filter("wickets", lambda w: credits_bowler(w["kind"]))
    return F.coalesce(F.size(credited), F.lit(0))


def bowling_stats(deliveries: DataFrame, null_safe: bool = False) -> DataFrame:
    """Bowling figures with credited wickets in one aggregation over the deliveries.

    Wickets are counted from the nested array of each ball, which saves the second scan and the join
    with the wicket table. Unless ``null_safe``, a NULL in the key gives 0 wickets: an equality join of
    the two aggregates would not match there.
    """
    conceded = F.col("total_runs")
    totals = real_balls(deliveries).groupBy(*DIMS, "bowler").agg(
        F.count_distinct("match_id").alias("matches"),
        _legal_balls().alias("legal_balls"),
        F.sum(conceded).alias("runs_conceded"),
        F.sum(runs_charged(conceded, F.col("extras"))).alias("runs_charged"),
        count_when(conceded == 0).alias("dot_balls"),
        F.sum(_ball_credits()).cast("bigint").alias("wickets"),
    )
    if not null_safe:
        complete = F.lit(True)
        for name in (*DIMS, "bowler"):
            complete = complete & F.col(name).isNotNull()
        totals = totals.withColumn("wickets", F.when(complete, F.col("wickets")).otherwise(F.lit(0)))
    return _bowling_rates(totals)


def _bowling_rates(totals: DataFrame) -> DataFrame:
    balls = F.col("legal_balls")
    return totals.withColumns({
        "overs": F.round(balls / 6, 2),
        "economy": rate(F.col("runs_conceded"), 6, balls),
    })


def with_wickets(bowling: DataFrame, credited: DataFrame) -> DataFrame:
    """Bowling totals joined with separately counted wickets; 0 where none are recorded."""
    return bowling.drop("wickets").join(credited, [*DIMS, "bowler"], "left").fillna({"wickets": 0})


def team_match_summary(deliveries: DataFrame, by_innings: bool = False) -> DataFrame:
    """Score of each batting team in each match; ``by_innings`` keeps its innings apart."""
    grain = ["match_id", *DIMS, "match_date", "batting_team", *(["innings_number"] if by_innings else [])]
    totals = real_balls(deliveries).groupBy(*grain).agg(
        F.sum("total_runs").alias("team_runs"),
        F.sum(F.coalesce(F.size("wickets"), F.lit(0))).alias("wickets_lost"),
        _legal_balls().alias("legal_balls"),
    )
    return totals.withColumn("run_rate", rate(F.col("team_runs"), 6, F.col("legal_balls")))


def league_season_summary(matches: DataFrame, summary: DataFrame) -> DataFrame:
    distinct = {"matches": "match_id", "venues": "venue", "winning_teams": "winner"}
    seasons = matches.groupBy(*DIMS, "match_type").agg(
        *[F.count_distinct(source).alias(name) for name, source in distinct.items()]
    )
    scores = summary.groupBy(*DIMS).agg(F.round(F.avg("team_runs"), 2).alias("avg_team_score"))
    return seasons.join(scores, DIMS, "left")


_BATTING_CARD = {
    "batting_matches": "matches",
    "batting_runs": "runs",
    "balls_faced": "balls_faced",
    "batting_strike_rate": "strike_rate",
    "fours": "fours",
    "sixes": "sixes",
}
_BOWLING_CARD = {
    "bowling_matches": "matches",
    "bowling_legal_balls": "legal_balls",
    "runs_conceded": "runs_conceded",
    "bowling_wickets": "wickets",
    "bowling_economy": "economy",
}


def player_cards(batting: DataFrame, bowling: DataFrame, null_safe: bool = False) -> DataFrame:
    """Full outer join of batting and bowling figures per player and season.

    With plain equality a row with a NULL dimension never meets its partner and gives two half-empty
    cards; ``null_safe`` treats NULL as a value and gives one.
    """
    keys = [*DIMS, "player"]
    left = batting.select(*keys, *[F.col(source).alias(name) for name, source in _BATTING_CARD.items()])
    right = bowling.withColumnRenamed("bowler", "player").select(
        *keys, *[F.col(source).alias(name) for name, source in _BOWLING_CARD.items()]
    )
    if not null_safe:
        return left.join(right, keys, "full")
    other = right.select(*[F.col(name).alias(f"_{name}") for name in keys], *_BOWLING_CARD)
    matched = F.lit(True)
    for name in keys:
        matched = matched & F.col(name).eqNullSafe(F.col(f"_{name}"))
    shared = [F.coalesce(name, f"_{name}").alias(name) for name in keys]
    return left.join(other, matched, "full").select(*shared, *_BATTING_CARD, *_BOWLING_CARD)


def team_season_cards(summary: DataFrame) -> DataFrame:
    """Season figures of each team. Rates are averaged as whole hundredths, so the result does not
    depend on the order in which partial sums meet."""
    hundredths = F.round(F.col("run_rate") * 100).cast("bigint")
    return summary.groupBy(*DIMS, F.col("batting_team").alias("team")).agg(
        F.count_distinct("match_id").alias("innings"),
        F.round(F.avg("team_runs"), 2).alias("avg_score"),
        F.max("team_runs").alias("highest_score"),
        F.round(F.try_divide(F.sum(hundredths), F.count(hundredths)) / 100, 2).alias("avg_run_rate"),
    )


def leaderboard(
    cards: DataFrame,
    metric: str,
    k: int,
    by: Sequence[str] = (),
    ascending: bool = False,
    ties: Sequence[str] = ("player",),
) -> DataFrame:
    """Best ``k`` rows overall or per group; equal values are ordered by ``ties``."""
    known = cards.where(F.col(metric).isNotNull())
    best = F.col(metric).asc() if ascending else F.col(metric).desc()
    order = [best, *[F.col(name).asc_nulls_last() for name in ties]]
    if by:
        return top_by_group(known, by, order, k)
    return known.orderBy(*order).limit(k)


def best_strike_rates(cards: DataFrame, k: int, min_balls: int = 0, by: Sequence[str] = ()) -> DataFrame:
    enough = cards.where(F.col("balls_faced") >= min_balls)
    return leaderboard(enough, "batting_strike_rate", k, by, ties=("player", *DIMS))


def best_economies(cards: DataFrame, k: int, min_balls: int = 0, by: Sequence[str] = ()) -> DataFrame:
    enough = cards.where(F.col("bowling_legal_balls") >= min_balls)
    return leaderboard(enough, "bowling_economy", k, by, ascending=True, ties=("player", *DIMS))


def average_scores(summary: DataFrame, by: Sequence[str] = ("league_name",)) -> DataFrame:
    return summary.groupBy(*by).agg(
        F.count("*").alias("team_scores"),
        F.round(F.avg("team_runs"), 2).alias("avg_team_score"),
    )


def team_matches_at(matches: DataFrame, team: str, venue: str) -> DataFrame:
    """Matches of a team at a venue, oldest first."""
    played = (F.col("team_1") == team) | (F.col("team_2") == team)
    return matches.where(played & (F.col("venue") == venue)).orderBy("match_date", "match_id")


def innings_wickets(wickets: DataFrame, match_id: str, innings_number: int) -> DataFrame:
    """Dismissals of one innings in playing order."""
    chosen = wickets.where((F.col("match_id") == match_id) & (F.col("innings_number") == innings_number))
    return chosen.orderBy("over_number", "delivery_sequence", "wicket_index")
