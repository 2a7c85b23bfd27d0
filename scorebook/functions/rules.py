"""Scoring, revision and rate rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dismissals that are not credited to the bowler.
UNCREDITED_KINDS = ("run out", "retired hurt", "retired out", "obstructing the field")


def _count(struct: Column, field: str) -> Column:
    return F.coalesce(struct[field], F.lit(0))


def is_legal_ball(extras: Column) -> Column:
    """True unless the ball carries a wide or a no-ball; an explicit 0 counts as none."""
    return (_count(extras, "wides") == 0) & (_count(extras, "noballs") == 0)


def runs_charged(total: Column, extras: Column) -> Column:
    """Runs charged to the bowler: total without byes, leg byes and penalty runs."""
    return F.coalesce(total, F.lit(0)) - _count(extras, "byes") - _count(extras, "legbyes") - _count(extras, "penalty")


def credits_bowler(kind: Column) -> Column:
    """True when the dismissal counts for the bowler; an unknown kind does not."""
    return F.coalesce(~F.lower(kind).isin(*UNCREDITED_KINDS), F.lit(False))


def classify_revision(current_revision: Column, current_hash: Column, new_revision: Column, new_hash: Column) -> Column:
    """``new``, ``unchanged``, ``older`` or ``revised`` for an arriving version of a known key."""
    return (
        F.when(current_hash.isNull() | (current_hash == ""), "new")
        .when(current_hash == new_hash, "unchanged")
        .when(new_revision < current_revision, "older")
        .otherwise("revised")
    )


def rate(amount: Column, per: int, balls: Column) -> Column:
    """``amount * per / balls`` to two decimals; NULL when no ball was bowled."""
    return F.round(F.try_divide(amount * per, balls), 2)


def count_when(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))
