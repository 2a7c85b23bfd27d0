"""URL lists with a history: every capture is judged by the entries that were active when it was fetched.

Dated entries become validity intervals, and an as-of join gives each URL and time the intervals active then. Both work
in two levels, days of an entry and moments of a day, so that an entry with a third of all captures is split by days.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.llm.common import fresh, let

DAY = 86_400

#: Actions of list entries by what wins when one entry has several at the same moment.
ACTIONS = ("remove", "allow", "block")


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(F.lower(found), r"\.+$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path without query and fragment, without slashes at its ends."""
    return F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)", 1), "^/+|/+$", "")


def entries_for(url: Column) -> Column:
    """All entries that cover a URL, the most specific first: host/path prefixes, the host, its parent domains."""
    labels, parts = F.split(host_of(url), r"\."), F.array_remove(F.split(path_of(url), "/+"), "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    longer = F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host_of(url).isNull(), F.array().cast("array<string>")).otherwise(F.concat(longer, domains))


def intervals(log: DataFrame) -> DataFrame:
    """``entry``, ``action``, ``valid_from``, ``valid_to`` (exclusive, null: still open) from rows ``entry``, ``action``, ``at``.

    Times are whole seconds. An entry is valid until its next row; a ``remove`` row only ends what was valid. Of several rows of one
    entry at one moment, the last of ``ACTIONS`` wins. Rows with a null entry or time or another action are ignored.
    """
    rank = F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col("action"))
    moments = log.filter(F.col("entry").isNotNull() & F.col("at").isNotNull() & (rank > 0)).groupBy("entry", "at").agg(F.max(rank).alias("rank"))
    daily = moments.withColumn("day", F.floor(F.col("at") / DAY))
    days = daily.groupBy("entry", "day").agg(F.min("at").alias("first"))
    later = days.select("entry", "day", F.lead("first").over(Window.partitionBy("entry").orderBy("day")).alias("later"))
    inside = daily.withColumn("next", F.lead("at").over(Window.partitionBy("entry", "day").orderBy("at")))
    action = F.element_at(F.array(*[F.lit(a) for a in ACTIONS]), F.col("rank").cast("int"))
    return (
        inside.join(later, ["entry", "day"])
        .select("entry", action.alias("action"), F.col("at").alias("valid_from"), F.coalesce("next", "later").alias("valid_to"))
        .filter("action != 'remove'")
    )


def active(asked: DataFrame, valid: DataFrame) -> DataFrame:
    """``entry``, ``at``, ``action``, ``valid_from`` of distinct pairs ``entry``, ``at`` with an interval active at that time."""
    when = asked.select("entry", "at").filter("entry is not null and at is not null").distinct().join(valid.select("entry").distinct(), "entry", "left_semi")
    none = F.lit(None).cast("struct<valid_from:bigint,valid_to:bigint,action:string>")
    held = valid.select("entry", F.col("valid_from").alias("at"), F.struct("valid_from", "valid_to", "action").alias("one"), F.lit(0).alias("asks"))
    moments = held.unionByName(when.select("entry", "at", none.alias("one"), F.lit(1).alias("asks"))).withColumn("day", F.floor(F.col("at") / DAY))
    # What each day of an entry starts with: the last interval that began on an earlier day.
    days = moments.groupBy("entry", "day").agg(F.max("one").alias("last"))
    before = Window.partitionBy("entry").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("entry", "day", F.last("last", ignorenulls=True).over(before).alias("carried"))
    upto = Window.partitionBy("entry", "day").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = moments.withColumn("now", F.last("one", ignorenulls=True).over(upto)).filter("asks = 1")
    found = latest.join(carried, ["entry", "day"]).select("entry", "at", F.coalesce("now", "carried").alias("one"))
    return found.filter(F.col("one").isNotNull() & (F.col("one.valid_to").isNull() | (F.col("at") < F.col("one.valid_to")))).select(
        "entry", "at", "one.action", "one.valid_from"
    )


def judge(captures: DataFrame, log: DataFrame, url_col: str = "url", at_col: str = "fetched_at") -> DataFrame:
    """``captures`` with ``host``, ``entry``, ``action``, ``listed_at`` and ``blocked`` at the end.

    ``log`` has ``entry`` (a domain, or host/path prefix), ``action`` (see ``ACTIONS``) and ``at``; times are epoch seconds. The most
    specific active entry decides; without one these are null and the capture is not blocked. So it is for a null or
    unreadable URL and a null time. Equal pairs of URL and time are judged once. A new column whose name ``captures`` has
    already gets underscores in front.
    """
    names = {name: fresh(captures, name) for name in ("host", "entry", "action", "listed_at", "blocked", "judged")}
    url, at = F.col(f"`{url_col}`"), F.col(f"`{at_col}`").cast("long")
    pairs = captures.select(url.alias("url"), at.alias("at")).filter("url is not null and at is not null").distinct()
    keys = pairs.select("url", "at", F.posexplode(entries_for(F.col("url"))).alias("place", "entry"))
    found = keys.join(active(keys, intervals(log)), ["entry", "at"])
    best = found.groupBy("url", "at").agg(F.min(F.struct("place", "entry", "action", "valid_from")).alias("best"))
    judged = best.select(F.struct("url", "at", "best").alias(names["judged"]))
    of = lambda name: F.col(f"{names['judged']}.{name}")
    joined = captures.join(judged, (url == of("url")) & (at == of("at")), "left")
    return joined.select(
        *[F.col(f"`{name}`") for name in captures.columns],
        host_of(url).alias(names["host"]), of("best.entry").alias(names["entry"]), of("best.action").alias(names["action"]),
        of("best.valid_from").alias(names["listed_at"]), F.coalesce(of("best.action") == "block", F.lit(False)).alias(names["blocked"]),
    )
