"""Nested values to rows: positional explode paths, map entries, column unpivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Level:
    """One step down: explode ``path`` as ``item``, then lift ``carry`` fields out of the item."""

    path: str
    item: str
    carry: Mapping[str, str] = field(default_factory=dict)


def explode_path(df: DataFrame, levels: Sequence[Level], outer: bool = True) -> DataFrame:
    """Chain of positional explodes; each level adds ``<item>_index`` (0-based) and its carried fields.

    All steps are row-local generators, so the chain needs no shuffle whatever the nesting depth. The
    parent value is dropped at each level to keep the rows narrow.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    for level in levels:
        parent = level.path.split(".")[0]
        kept = [name for name in df.columns if name != parent]
        df = df.select(*kept, explode(level.path).alias(f"{level.item}_index", level.item))
        df = df.withColumns({name: F.col(f"{level.item}.{source}") for name, source in level.carry.items()})
    return df


def explode_map(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """One row per map entry."""
    kept = [name for name in df.columns if name != column.split(".")[0]]
    return df.select(*kept, F.explode(column).alias(key, value))


def unpivot_prefix(df: DataFrame, prefix: str, keep: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns starting with ``prefix`` become ``(name, value)`` rows; blank values are dropped."""
    wide = [column for column in df.columns if column.startswith(prefix)]
    if not wide:
        empty = [F.lit(None).cast("string").alias(column) for column in (name, value)]
        return df.select(*keep, *empty).where(F.lit(False))
    texts = df.select(*keep, *[F.col(f"`{column}`").cast("string").alias(column) for column in wide])
    long = texts.unpivot(list(keep), wide, name, value)
    return long.where(F.trim(value) != "").withColumn(name, F.substring(name, len(prefix) + 1, 2**31 - 1))
