"""Hard negatives by a secondary sort.

Rows and anchors meet in tiles of bounded size, where all inner products are one matrix product. A first pass keeps each
anchor's best rows of its own label, a second one the rows of other labels that a window of these positives takes in; of
both, a tile keeps no more than the result can need, so this is a combine before the shuffle and loses nothing. The pairs
that are left are packed into keys (anchor, descending score, id), dealt and sorted by `repartitionAndSortWithinPartitions`,
and a streaming iterator opens a window at each positive and emits the negatives that follow it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorebook.llm.common import Scratch

#: Rows of a tile on either side; anchors are fewer if vectors are long, see ``_tile_anchors``.
TILE_ANCHORS, TILE_ROWS = 1024, 1024
#: Numbers of anchor vectors that a task holds.
_HELD = 4_000_000
_SIGN = np.uint64(1 << 63)
_LONG = np.iinfo(np.int64)


def quantised(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``vec_id``, ``label``, ``q`` of the rows that take part; components are ``floor(scale * x)``, within a long."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    own = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), vector.alias("v"))
    own = own.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", sound))
    return own.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("q"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all of ``b``, as integers; beyond a long the nearest long."""
    top = (int(np.abs(a.astype(np.float64)).max(initial=0)) + 1) * (int(np.abs(b.astype(np.float64)).max(initial=0)) + 1) * max(1, a.shape[1])
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < 1 << 62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, int(_LONG.min), int(_LONG.max)).astype(np.int64)


def _matrix(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    sizes = np.asarray(column.value_lengths())
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _first(scores: np.ndarray, wanted: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Mask of the ``k`` highest wanted scores of each row; of equal ones those of the lowest ``rank``."""
    out = np.zeros(scores.shape, bool)
    held = np.where(wanted, scores, _LONG.min)
    width = scores.shape[1]
    least = np.partition(held, width - k, axis=1)[:, width - k, None] if width > k else _LONG.min
    row, col = np.nonzero(wanted & (held >= least))
    by = np.lexsort((rank[col], -scores[row, col].astype(np.float64), row)) if not len(row) or abs(scores[row, col]).max() < 1 << 53 else np.array(
        sorted(range(len(row)), key=lambda i: (row[i], -int(scores[row[i], col[i]]), rank[col[i]])), int
    )
    row, col = row[by], col[by]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    out[row[place < k], col[place < k]] = True
    return out


def bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and greatest integer s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _sortable(x: np.ndarray) -> np.ndarray:
    """Longs as unsigned numbers of the same order."""
    return x.astype(np.int64).view(np.uint64) ^ _SIGN


def packed(anchor_id: np.ndarray, anchor_row: np.ndarray, score: np.ndarray, negative: int, ids: np.ndarray, null: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys whose bytes sort by anchor, descending score, positives before negatives, id (null last) and row."""
    parts = np.empty(len(score), np.dtype([("a", ">u8"), ("ar", ">u8"), ("s", ">u8"), ("f", "u1"), ("z", "u1"), ("i", ">u8"), ("r", ">u8")]))
    parts["a"], parts["ar"], parts["s"], parts["f"] = _sortable(anchor_id), anchor_row.astype(np.uint64), ~_sortable(score), negative
    parts["z"], parts["i"], parts["r"] = null, _sortable(np.where(null, 0, ids)), row.astype(np.uint64)
    return parts


#: Where the fields of a key begin, and its length.
_AT = {"anchor": 0, "score": 16, "negative": 24, "null": 25, "id": 26, "end": 42}


def _as_binary(keys: np.ndarray) -> pa.Array:
    offsets = np.arange(len(keys) + 1, dtype=np.int32) * _AT["end"]
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(keys.tobytes())])


def _tiles(positives: int, negatives: int, low: int, high: int, second: bool) -> Callable:
    """Rows (tile, role, row, vec_id, label, q, scores), sorted by tile and role: anchors (0), then the rows they meet (1).

    Emits keys: in the first pass each anchor's best rows of its label, in the second those of other labels in the windows
    of ``scores``, its positives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        for batch in batches:
            tiles, roles = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(roles) != 0)) + 1
            for begin, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if begin == end:
                    continue
                if tiles[begin] != tile:
                    tile, held = tiles[begin], []
                part = batch.slice(begin, end - begin)
                if roles[begin] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                anchors = pa.Table.from_batches(held).combine_chunks()
                for start in range(0, part.num_rows, TILE_ROWS):
                    keys = meet(anchors, part.slice(start, TILE_ROWS))
                    if len(keys[0]):
                        yield pa.RecordBatch.from_arrays([_as_binary(keys[0]), *map(pa.array, keys[1:])], names=["key", "anchor", "score"])

    def meet(anchors: pa.Table, rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, and for them the anchor's row and the score."""
        whole = lambda t, name: t.column(name).combine_chunks() if isinstance(t, pa.Table) else t.column(t.schema.get_field_index(name))
        own, other = whole(anchors, "q"), whole(rows, "q")
        width = max(int(np.asarray(x.value_lengths()).max(initial=0)) for x in (own, other))
        scores = products(_matrix(own, width), _matrix(other, width))
        a_row, a_id, a_label = (whole(anchors, x).to_numpy() for x in ("row", "vec_id", "label"))
        row, label = (whole(rows, x).to_numpy() for x in ("row", "label"))
        null = np.asarray(whole(rows, "vec_id").is_null())
        ids = whole(rows, "vec_id").fill_null(0).to_numpy()
        rank = np.empty(len(row), np.int64)
        rank[np.lexsort((row, ids, null))] = np.arange(len(row))
        same = a_label[:, None] == label
        if second:
            chosen = np.zeros(scores.shape, bool)
            edges = [[bounds(s, low, high) for s in x] for x in whole(anchors, "scores").to_pylist()]
            for i in range(max(map(len, edges), default=0)):
                least, most = (np.array([x[i][j] if i < len(x) else 1 - j for x in edges], np.int64)[:, None] for j in (0, 1))
                chosen |= _first(scores, ~same & (scores >= least) & (scores <= most), rank, negatives)
        else:
            chosen = _first(scores, same & (a_row[:, None] != row), rank, positives)
        i, j = np.nonzero(chosen)
        return packed(a_id[i], a_row[i], scores[i, j], int(second), ids[j], null[j], row[j]), a_row[i], scores[i, j]

    return run


def _met(vectors: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, per_tile: int, run: Callable) -> DataFrame:
    """Keys from all tiles of ``anchors`` (with ``scores``) and ``vectors``."""
    blocks, cells = max(1, -(-n_anchors // per_tile)), max(1, -(-n_rows // TILE_ROWS))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    mine = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(n))
    columns = ("row", "vec_id", "label", "q", "scores")
    left = anchors.select(*columns, mine(1, blocks).alias("block"), each(cells).alias("cell"), F.lit(0).alias("role"))
    right = vectors.withColumn("scores", F.array().cast("array<long>")).select(*columns, each(blocks).alias("block"), mine(2, cells).alias("cell"), F.lit(1).alias("role"))
    both = left.unionByName(right).select((F.col("block") * cells + F.col("cell")).alias("tile"), "role", *columns)
    return both.repartition("tile").sortWithinPartitions("tile", "role").mapInArrow(run, "key binary, anchor long, score long")


def _number(key: bytes, field: str) -> int:
    at = _AT[field]
    return int.from_bytes(key[at : at + 8], "big")


def windows(keys: Iterator[bytes], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Stream sorted keys: a positive opens a window, a negative goes to every open window whose bounds hold it.

    Only the open windows of one anchor are held. A window's negatives follow its positive, as their scores are lower, or
    equal at zero, where positives come first.
    """
    anchor, open_windows = None, []
    for key in keys:
        if key[:16] != anchor:
            anchor, open_windows = key[:16], []
            anchor_id = _number(key, "anchor") - (1 << 63)
        score = (1 << 63) - 1 - _number(key, "score")
        own = None if key[_AT["null"]] else _number(key, "id") - (1 << 63)
        if not key[_AT["negative"]]:
            open_windows.append([own, score, *bounds(score, low, high), 0])
            continue
        for window in open_windows:
            positive, positive_score, least, most, taken = window
            if taken < negatives and least <= score <= most:
                window[4] += 1
                yield anchor_id, positive, taken + 1, own, positive_score, score


def hard_negatives(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows whose id is divisible by ``every``; their positives the first ``positives`` other rows of the same
    label by descending inner product, ties by smaller id; a positive's negatives the first ``negatives`` rows of another
    label with ``low`` * its score <= 100 * theirs <= ``high`` * its score.

    Rows without label or vector, or with a null or non-finite component, take no part. Rows with a null id take part,
    after all others in a tie, and are no anchors. Rows that repeat an id are separate rows: each may be an anchor, and
    one is a positive of the other if their labels agree. Missing components of a shorter vector count as zero. A score
    beyond a long counts as the nearest long. An anchor without positives or negatives has no rows.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "negatives")
    numbered = quantised(rows, id_col, vector_col, label_col, scale).withColumn("row", F.monotonically_increasing_id())
    vectors = scratch.keep(numbered, "vectors")  # written, so that the numbers stay
    anchors = vectors.filter(F.col("vec_id") % every == 0).withColumn("scores", F.array().cast("array<long>"))
    size = vectors.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("anchors"), F.max(F.size("q")).alias("width")).first()
    per_tile = max(1, min(TILE_ANCHORS, _HELD // max(1, size["width"] or 1)))
    counts = (size["rows"], size["anchors"], per_tile)

    best = _met(vectors, anchors, *counts, _tiles(positives, negatives, low, high, False))
    ranked = best.withColumn("nth", F.row_number().over(Window.partitionBy("anchor").orderBy("key"))).filter(F.col("nth") <= positives)
    opened = scratch.keep(ranked.select("key", "anchor", "score"), "positives")
    found = opened.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list("score")).alias("scores"))
    asking = anchors.drop("scores").join(found, "row")
    met = _met(vectors, asking, *counts, _tiles(positives, negatives, low, high, True))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = opened.select("key").unionByName(met.select("key")).rdd.map(lambda r: (bytes(r[0]), None))
    ordered = pairs.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:16]))
    emitted = ordered.mapPartitions(lambda part: windows((key for key, _ in part), negatives, low, high))
    return spark.createDataFrame(emitted, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long", verifySchema=False)
