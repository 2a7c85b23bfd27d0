"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces of equal length are interchangeable, so the packing is planned on the histogram of lengths, which has at most as
many rows as the longest permitted sequence has tokens: the longest piece left opens the bin size that costs least per
token once filled with the best-fitting pieces, the same filling is repeated while the counts last, and each bin finally
shrinks to the shortest permitted length that holds its contents. Documents then take the planned slots by their rank
among pieces of their length; ranks come from two bounded levels of counts. Texts never move.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.llm.common import Scratch, whole, words

#: Permitted sequence lengths and what a bin costs besides its tokens.
CAPACITIES = (512, 1024, 2048, 4096)
BIN_COST = 16

_PLACED = "doc_id long, piece int, start long, length int, bin_id long, bin_start int, bin_size int, bin_used int"


@dataclass
class Filling:
    """``bins`` bins of equal contents: lengths from the longest to the shortest, in a bin of ``size``."""

    lengths: list[int]
    bins: int
    size: int


def plan(histogram: dict[int, int], capacities: Sequence[int] = CAPACITIES, bin_cost: int = BIN_COST) -> list[Filling]:
    """Fillings that use every piece of ``histogram`` (length: pieces) exactly once.

    Each round opens a bin for the longest piece left in the size with the least cost per token, and adds the largest
    piece that still fits until none does. Ties go to the smaller bin.
    """
    left = {length: n for length, n in histogram.items() if length > 0 and n > 0}
    present = sorted(left)
    sizes = sorted(capacities)
    if present and present[-1] > sizes[-1]:
        raise ValueError(f"a piece of {present[-1]} is longer than the longest sequence of {sizes[-1]}")
    out = []
    while present:
        best = None
        for size in sizes[next(i for i, s in enumerate(sizes) if s >= present[-1]) :]:
            gap, used, upto = size, {}, len(present)
            while gap and (upto := bisect_right(present, gap, 0, upto)):
                length = present[upto - 1]
                n = min(left[length], gap // length)
                used[length] = n
                gap -= n * length
                upto -= 1
            cost = (next(s for s in sizes if s >= size - gap) + bin_cost) / (size - gap)
            if best is None or cost < best[0]:
                best = cost, used, size - gap
        _, used, total = best
        bins = min(left[length] // n for length, n in used.items())
        out.append(Filling([length for length, n in used.items() for _ in range(n)], bins, next(s for s in sizes if s >= total)))
        for length, n in used.items():
            left[length] -= n * bins
            if not left[length]:
                del left[length]
                present.pop(bisect_right(present, length) - 1)
    return out


def _slots(fillings: list[Filling]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank of each run of equal bins, its pieces per bin, first bin, size, used and offset of the first piece."""
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, ...]]] = {}
    first_bin = 0
    for filling in fillings:
        used, at, i = sum(filling.lengths), 0, 0
        while i < len(filling.lengths):
            length = filling.lengths[i]
            n = filling.lengths.count(length)
            rank = taken.get(length, 0)
            rows.setdefault(length, []).append((rank, n, first_bin, filling.size, used, at))
            taken[length] = rank + n * filling.bins
            at += n * length
            i += n
        first_bin += filling.bins
    return {length: tuple(np.array(column, np.int64) for column in zip(*found, strict=True)) for length, found in rows.items()}


def _assign(slots: dict[int, tuple[np.ndarray, ...]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            out = np.zeros((4, len(lengths)), np.int64)
            by = np.argsort(lengths, kind="stable")
            values, starts = np.unique(lengths[by], return_index=True)
            for value, at in zip(values.tolist(), np.split(by, starts[1:]), strict=True):
                first, per_bin, first_bin, size, used, begin = slots[value]
                run_of = np.searchsorted(first, ranks[at], "right") - 1
                inside = ranks[at] - first[run_of]
                out[0, at] = first_bin[run_of] + inside // per_bin[run_of]
                out[1, at] = begin[run_of] + inside % per_bin[run_of] * value
                out[2, at], out[3, at] = size[run_of], used[run_of]
            small = [pa.array(column, pa.int32()) for column in out[1:]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("doc_id", "piece", "start", "length")), pa.array(out[0]), *small],
                names=["doc_id", "piece", "start", "length", "bin_id", "bin_start", "bin_size", "bin_used"],
            )

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None, text_col: str = "text", capacities: Sequence[int] = CAPACITIES, bin_cost: int = BIN_COST) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``bin_id``, ``bin_start``, ``bin_size``, ``bin_used``.

    ``length`` is the number of tokens of a row, by default the words of ``text_col``. Longer documents are cut into
    pieces of the longest permitted length and a rest, in order, so nothing is dropped. A document without tokens (null
    or empty) is one piece of length 0 with null bin columns. Repeated rows are packed as often as they occur; null
    ids are kept. Bins hold whole pieces without gaps from position 0; ``bin_size`` is the shortest permitted length
    that holds ``bin_used``.
    """
    longest = max(capacities)
    tokens = F.size(words(whole(text_col))) if length is None else F.coalesce(length, F.lit(0))
    counted = docs.select(F.col(id_col).cast("long").alias("doc_id"), tokens.cast("long").alias("tokens"))
    pieces = counted.select(
        "doc_id", "tokens", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("tokens") / longest) - 1, F.lit(0)).cast("int"))).alias("piece")
    ).select(
        "doc_id", "piece", (F.col("piece").cast("long") * longest).alias("start"),
        F.least(F.col("tokens") - F.col("piece").cast("long") * longest, F.lit(longest)).cast("int").alias("length"),
    )
    # Written once: the lengths serve the histogram, the ranks and the rest.
    pieces = Scratch(docs.sparkSession, "pack").keep(pieces, "pieces")
    full = pieces.filter("length > 0").withColumn("sub", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(1024)).cast("int"))
    counts = full.groupBy("length", "sub").agg(F.count(F.lit(1)).alias("n"))
    # At most one row per token of the longest sequence.
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(plan(histogram, capacities, bin_cost))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("length", "sub", before.alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "sub").orderBy("doc_id", "piece")) - 1
    ranked = full.withColumn("nth", nth).join(starts, ["length", "sub"]).withColumn("rank", F.col("before") + F.col("nth"))
    placed = ranked.select("doc_id", "piece", "start", "length", "rank").mapInArrow(_assign(slots), _PLACED)
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("bin_id", "long"), ("bin_start", "int"), ("bin_size", "int"), ("bin_used", "int"))]
    return placed.unionByName(pieces.filter("length = 0").select("doc_id", "piece", "start", "length", *none))


def bins(placed: DataFrame) -> DataFrame:
    """One row per bin with its pieces in order; at most as many pieces as the bin has tokens.

    Columns: ``bin_id``, ``bin_size``, ``bin_used``, and the lists ``doc_ids``, ``starts``, ``lengths``.
    """
    part = F.struct("bin_start", "doc_id", "start", "length")
    grouped = placed.filter("bin_id is not null").groupBy("bin_id").agg(F.first("bin_size").alias("bin_size"), F.first("bin_used").alias("bin_used"), F.sort_array(F.collect_list(part)).alias("parts"))
    return grouped.select("bin_id", "bin_size", "bin_used", F.col("parts.doc_id").alias("doc_ids"), F.col("parts.start").alias("starts"), F.col("parts.length").alias("lengths"))
