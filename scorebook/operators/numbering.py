"""Positions of rows within groups of any size, without gathering a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorebook.session import materialise

_RANGE, _TIE = "numbering_range", "numbering_tie"


def positions(df: DataFrame, numbers: Mapping[str, Sequence[str]], order: Sequence[str]) -> DataFrame:
    """Add a column per entry of ``numbers``: the 0-based position of a row among those equal in the named columns.

    The named columns are a leading part of ``order``, by which positions go; rows equal in all of it are numbered in any
    order. Rows are dealt over sorted ranges, also the copies of one row, and written. A range numbers its own rows; the
    group a range begins with may have begun before, so its count in earlier ranges is added. Of those counts there
    are two for each range, whatever the number or the size of the groups.
    """
    for columns in numbers.values():
        if list(order[: len(columns)]) != list(columns):
            raise ValueError(f"{list(columns)} is not a leading part of {list(order)}")
    by = [*order, _TIE]
    dealt = df.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(*by)
    ranged = materialise(dealt.withColumn(_RANGE, F.spark_partition_id()), "ranged")
    out = ranged
    for name, columns in numbers.items():
        own = F.row_number().over(Window.partitionBy(_RANGE, *columns).orderBy(*by)) - 1
        out = out.withColumn(name, own.cast("long"))
    for name, columns in numbers.items():
        held = ranged.groupBy(_RANGE, *columns).agg(F.count(F.lit(1)).alias("n"))
        ends = held.groupBy(_RANGE).agg(*[f(F.struct(*columns, "n")).alias(end) for f, end in ((F.min, "head"), (F.max, "tail"))])
        pieces = ends.select(_RANGE, F.inline(F.array_distinct(F.array("head", "tail"))))
        before = Window.partitionBy(*columns).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
        begun = pieces.withColumn("before", F.sum("n").over(before)).where(F.col("before") > 0)
        # At most one row for each range.
        begun = begun.select(F.col(_RANGE).alias("_range"), F.struct(*columns).alias("_group"), "before")
        same = (F.col(_RANGE) == F.col("_range")) & F.struct(*columns).eqNullSafe(F.col("_group"))
        out = out.join(F.broadcast(begun), same, "left").withColumn(name, F.col(name) + F.coalesce("before", F.lit(0))).drop("_range", "_group", "before")
    return out.drop(_RANGE, _TIE)
