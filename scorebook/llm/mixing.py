"""Mix sources to target weights by systematic sampling, in DataFrame operations only.

Within a source every document is expected ``target / source size`` times. Expected copies are summed along the
documents, largest first, one random offset is added, and a document is emitted once for each integer passed. As
neighbours in that order have about equal sizes, the words of a source miss its target by less than its largest
document. The running position of a document comes from three bounded levels (sizes of a source, 4,096 buckets of a
size, one bucket), so that a source with a third of all rows is no single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.llm.common import Scratch, digest, fresh, whole, words

WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MOST_COPIES = 2


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = BUDGET_PERCENT, most: int = MOST_COPIES) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources in code point order, null last, take ``weights`` in turn and share ``percent`` of all sizes; no target is
    above ``most`` times its size, and the excess is shared by weight among the others. That is the level at which
    min(cap, level * weight) adds up: sources are capped in the order of cap / weight. One row per source passes
    through one window.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn("w", F.get(F.array(*[F.lit(w).cast("long") for w in weights]), turn)).withColumn("cap", F.lit(most) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy(F.lit(1))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(percent) / F.lit(100)
    # The level if this source and all later ones are below their caps.
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest)
    levels = weighted.withColumn("level", level).withColumn("fits", F.col("level") * F.col("w") <= F.col("cap"))
    chosen = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"), F.col("level")))).over(everything)["level"]
    reached = levels.withColumn("chosen", chosen)
    capped = F.col("chosen").isNull() | (F.col("chosen") * F.col("w") >= F.col("cap"))
    return reached.select("source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(F.col("chosen") * F.col("w")).alias("target"))


def offset(source: Column, seed: int) -> Column:
    """Pseudo-random number in [0, 1) for a source: the same in each run with this seed."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS, percent: int = BUDGET_PERCENT, most: int = MOST_COPIES, seed: int = 7) -> DataFrame:
    """How often each document is emitted: ``key``, ``doc_id``, ``source``, ``size``, ``times``, ``source_size``, ``target``, ``copies``.

    ``size`` counts words (null and empty texts: 0). Rows equal in id, source and text are one row here with ``times``
    above 1: each of them is emitted ``copies`` times. A null source is a source of its own, null ids are kept. A source
    without any word has target 0 and emits nothing. ``key`` is a digest of the three columns.
    """
    name = F.col(source_col).cast("string")
    counted = docs.select(
        digest(id_col, source_col, text_col).alias("key"), F.col(id_col).alias("doc_id"), name.alias("source"),
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("src"), F.size(words(whole(text_col))).cast("long").alias("size"),
    )
    kept = ("doc_id", "source", "src", "size")
    items = counted.groupBy("key").agg(*[F.first(c).alias(c) for c in kept], F.count(F.lit(1)).alias("times"))
    # Written once: texts are read and their words counted a single time, for the counts and for the ranks.
    placed = Scratch(docs.sparkSession, "mix").keep(items.withColumn("load", F.col("size") * F.col("times")).withColumn("sub", F.substring("key", 1, 3)), "items")
    counts = placed.groupBy("src", "load", "sub").agg(F.count(F.lit(1)).alias("n"))
    by_load = counts.groupBy("src", "load").agg(F.sum("n").alias("n"))
    goal = targets(
        by_load.groupBy("src").agg(F.sum(F.col("load") * F.col("n")).alias("source_size")).select(F.when(F.col("src") != "", F.substring("src", 2, 2147483647)).alias("source"), "source_size"),
        weights, percent, most,
    ).select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("src"), "source_size", "target")
    earlier = lambda window: F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    loads = by_load.select("src", "load", earlier(Window.partitionBy("src").orderBy(F.desc("load"))).alias("before")).join(goal, "src")
    subs = counts.select("src", "load", "sub", earlier(Window.partitionBy("src", "load").orderBy("sub")).alias("within"))
    starts = subs.join(loads, ["src", "load"])
    ranked = placed.withColumn("nth", F.row_number().over(Window.partitionBy("src", "load", "sub").orderBy("key"))).join(starts, ["src", "load", "sub"])
    rank = F.col("before") + F.col("within") + F.col("nth")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    passed = lambda upto: F.floor(expected * upto + offset(F.col("source"), seed))
    return ranked.select("key", "doc_id", "source", "size", "times", "source_size", "target", (passed(rank) - passed(rank - 1)).cast("long").alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS, percent: int = BUDGET_PERCENT, most: int = MOST_COPIES, seed: int = 7) -> DataFrame:
    """Rows of ``docs``, each as often as ``copies`` says, with all columns as they are."""
    key, many = fresh(docs, "__key"), fresh(docs, "__copies")
    taken = copies(docs, id_col, text_col, source_col, weights, percent, most, seed).filter("copies > 0")
    narrow = taken.select(F.col("key").alias(key), F.col("copies").cast("int").alias(many)).hint("shuffle_hash")
    rows = docs.withColumn(key, digest(id_col, source_col, text_col)).join(narrow, key)
    return rows.withColumn(many, F.explode(F.sequence(F.lit(1), F.col(many)))).select(*[F.col(f"`{name}`") for name in docs.columns])
