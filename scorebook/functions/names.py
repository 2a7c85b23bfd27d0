"""Naming rules: competitions, groups, normalised names, configured lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Competitions served as "focus" when nothing is configured.
DEFAULT_FOCUS = (
    "Indian Premier League",
    "Big Bash League",
    "Women's Big Bash League",
    "The Hundred",
    "Women's Premier League",
    "Pakistan Super League",
    "Caribbean Premier League",
    "Major League Cricket",
    "International League T20",
    "SA20",
)

# Text contained in a competition name -> group label, first hit wins.
LEAGUE_GROUPS = (
    ("indian premier league", "IPL"),
    ("big bash", "Big Bash"),
    ("the hundred", "The Hundred"),
)

def config_list(value: Column) -> Column:
    """Names in a comma-separated setting, trimmed, without empty ones; an absent setting has none."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), ","), lambda part: F.trim(part)), lambda part: part != "")


def bucket_by_rules(name: Column, rules: Sequence[tuple[str, str]] = LEAGUE_GROUPS) -> Column:
    """Label of the first rule whose text the name contains (any case), else the name itself."""
    lowered = F.lower(name)
    hits = [F.when(lowered.contains(text), F.lit(label)) for text, label in rules]
    return F.coalesce(*hits, name)


def normalise_name(name: Column) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", " "))


def competition_bucket(name: Column, focus: Sequence[str]) -> Column:
    """Struct ``(bucket, is_focus)``: first configured name that contains, or is contained in, the event.

    The event is normalised once and compared with the constant list inside one expression, however long: no
    join, no row pairs. An empty event name is never focus.
    """
    listed = F.array(*[F.struct(F.lit(one).alias("shown"), normalise_name(F.lit(one)).alias("wanted")) for one in focus])
    matches = lambda event: F.filter(
        listed, lambda one: (event != "") & (event.contains(one["wanted"]) | one["wanted"].contains(event))
    )
    hit = F.get(F.transform(F.array(normalise_name(name)), lambda event: F.get(matches(event), F.lit(0))["shown"]), F.lit(0)) if focus else F.lit(None).cast("string")
    shown = F.coalesce(F.when(name != "", name), F.lit("Unknown"))
    return F.struct(F.coalesce(hit, shown).alias("bucket"), hit.isNotNull().alias("is_focus"))
