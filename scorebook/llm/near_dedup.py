"""Near duplicates by SuperMinHash signatures, bands, verification on full sets and union-find groups.

Signature: each shingle walks one pseudo-random permutation of the registers and offers rank + fraction to the
register at every step, so the ranks of one shingle are correlated and the variance is below that of independent hashes.
Steps stop as soon as no register can still fall. Equal shingle sets are one class from the start, so exact copies
cost nothing further. Classes that share a band are candidates:

1. every class against one pivot of each of its buckets, confirmed on full sets; links are grouped;
2. in buckets that still hold several groups, the classes outside the largest group against all others, in blocks.

After that every pair of classes in a bucket is either in one group or was compared, and no pair was written out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.common import Scratch, small_batches, whole
from scorebook.llm.graph import components

#: Registers of a signature, and the largest probability that two sets just similar enough share no band of theirs.
REGISTERS, MISS = 120, 1e-4
#: Shingles in one block of a bucket.
BLOCK = 400_000

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_WORDS_KEPT = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit generator: a bijection with well-spread bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Digest of a word, remembered for frequent words; emptied when large."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_digest(word)
        return value


def shingles(text: bytes, known: WordHashes, width: int) -> np.ndarray:
    """Sorted distinct hashes of word shingles; a shorter text is one shingle, an empty one has none."""
    tokens = text.lower().split()  # on bytes: A-Z only, and white space of the contract
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.frombuffer(b"".join(map(known.__getitem__, tokens)), dtype="<u8")
    size = min(width, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * _STEP + h[i : len(h) - size + 1 + i])
    return np.unique(out)


def superminhash(sets: list[np.ndarray], registers: int) -> np.ndarray:
    """Signatures (sets x registers) as integers rank * 2^53 + fraction."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    elements, owner = np.concatenate(sets) if n else np.empty(0, np.uint64), np.repeat(np.arange(n), sizes)
    best = np.full(n * registers, np.iinfo(np.uint64).max, np.uint64)
    order, small = None, np.uint8 if registers <= 256 else np.uint16
    for step in range(registers):
        if not len(elements):
            break
        draw, other = (mix(elements + np.uint64(i * int(_STEP) & (1 << 64) - 1)) for i in (2 * step + 1, 2 * step + 2))
        pick = (step + (other >> np.uint64(11)) % np.uint64(registers - step)).astype(np.int64)
        if step == 0:
            place = pick
        else:
            if order is None:  # the permutations after the first step
                order = np.tile(np.arange(registers, dtype=small), (len(elements), 1))
                rows = np.arange(len(elements))
                order[rows, first], order[:, 0] = 0, first.astype(small)
            rows = np.arange(len(elements))
            place = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, step]
            order[:, step] = place.astype(small)
        value = (np.uint64(step) << np.uint64(53)) | (draw >> np.uint64(11))
        np.minimum.at(best, owner * registers + place, value)
        # A later offer is at least step + 1: sets whose registers are all below that are done.
        open_sets = best.reshape(n, registers).max(axis=1) >= (np.uint64(step + 1) << np.uint64(53))
        live = open_sets[owner]
        if not live.all():
            elements, owner = elements[live], owner[live]
            if order is not None:
                order = order[live]
            pick = pick[live]
        first = pick
    return best.reshape(n, registers)


def cut_bands(percent: int, registers: int = REGISTERS, miss: float = MISS) -> tuple[int, int]:
    """Bands and rows for a similarity of ``percent``: the longest bands that miss a pair with at most ``miss``.

    Longer bands let fewer sets meet by chance. Registers are added where even bands of one row would miss more.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is above 0 and at most 100")
    missed = lambda bands, rows: (1 - (percent / 100) ** rows) ** bands
    for rows in range(5, 0, -1):
        if missed(registers // rows, rows) <= miss:
            return registers // rows, rows
    return math.ceil(math.log(miss) / math.log(1 - percent / 100)), 1


def _bands(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(signatures), 1))
    for i in range(rows):
        out = mix(out * _STEP + parts[:, :, i])
    return out.view(np.int64)


def _profile(width: int, percent: int) -> Callable:
    n_bands, n_rows = cut_bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingles(text.as_py(), known, width) for text in batch.column(2)]
            bands = np.zeros((len(sets), n_bands), np.int64)
            start = 0
            while start < len(sets):  # as many sets at once as have about 100,000 shingles
                end, total = start, 0
                while end < len(sets) and (end == start or total + len(sets[end]) <= 100_000):
                    total += len(sets[end])
                    end += 1
                bands[start:end] = _bands(superminhash(sets[start:end], n_bands * n_rows), n_bands, n_rows)
                start = end
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * n_bands, pa.int32()), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()), listed],
                names=["doc_id", "mark", "n_shingles", "node", "bands"],
            )

    return run


def _confirm(width: int, percent: int) -> Callable:
    """Rows (key, role, node, grp, text), sorted by key and role: texts of role 1 against all of role 0 with that key.

    Emits one link for a text and each other group among those it matches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        key, block, index, links = None, [], None, []
        for batch in batches:
            keys, roles, nodes, groups, texts = (batch.column(i) for i in range(5))
            for row_key, role, node, group, text in zip(keys.to_pylist(), roles.to_pylist(), nodes.to_pylist(), groups.to_pylist(), texts, strict=True):
                if row_key != key:
                    key, block, index = row_key, [], None
                own = shingles(text.as_py(), known, width)
                if role == 0:
                    block.append((node, group, own))
                    continue
                if not block:
                    continue
                if index is None:
                    sizes = np.array([len(x[2]) for x in block])
                    members = np.concatenate([x[2] for x in block])
                    by = np.argsort(members, kind="stable")
                    index = members[by], np.repeat(np.arange(len(block)), sizes)[by], sizes
                members, holder, sizes = index
                low, high = np.searchsorted(members, own, "left"), np.searchsorted(members, own, "right")
                runs = high - low
                at = np.repeat(high - np.cumsum(runs), runs) + np.arange(runs.sum())
                common = np.bincount(holder[at], minlength=len(block))
                near = np.flatnonzero(100 * common >= percent * (sizes + len(own) - common))
                done = {group}
                for i in near.tolist():
                    other, other_group, _ = block[i]
                    if other_group not in done and other != node:
                        done.add(other_group)
                        links.append((node, other))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.binary()), pa.array([x[1] for x in links], pa.binary())], names=["a", "b"])
                links = []

    return run


def _check(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links among ``pairs`` (key, role, node, grp), with the texts brought to them."""
    rows = pairs.join(texts, "node").select("key", "role", "node", "grp", "text")
    return rows.repartition("key").sortWithinPartitions("key", "role").mapInArrow(_confirm(width, percent), "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``mark``, ``component`` for every row of ``docs``.

    Texts are linked if 100 * intersection >= ``percent`` * union of their sets of ``width``-word shingles, A-Z
    lower-cased; a shorter text is one shingle. ``component_id`` is the smallest id reachable over links, ``kept`` says
    that it is the row's own. Null, empty and blank texts have no shingles and are linked with nothing. Rows that repeat
    an id are separate texts with the same id. A row with a null id takes part; its component is the smallest id
    that is not null, and it is kept only if there is none. ``mark`` is a hash of the text, ``component``
    names the group also where no member has an id; null without shingles. Other columns are dropped.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    small_batches(docs)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(whole(text_col)).alias("mark"), whole(text_col).cast("binary").alias("text"))
    profiles = scratch.keep(keyed.mapInArrow(_profile(width, percent), "doc_id long, mark long, n_shingles long, node binary, bands array<long>"), "profiles")
    classes = scratch.keep(
        profiles.filter("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("low"), F.min_by(F.struct("doc_id", "mark"), "mark").alias("of"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")),
        "classes",
    )
    banded = classes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    pivots = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("node", "n_shingles"), F.xxhash64("node")).alias("pivot")).filter("n > 1")
    members = scratch.keep(banded.join(pivots, "bucket").select("bucket", "node", "n_shingles", F.col("pivot.node").alias("pivot"), F.col("pivot.n_shingles").alias("pivot_n")), "members")

    # Texts of classes that share a bucket, one row of each class; the only time that texts move as a whole. Rows that
    # repeat the id and text of a class meet in the join by its keys, and one of them stays, without another exchange.
    key = lambda of: [F.xxhash64(F.lit(i), F.col(f"{of}doc_id").isNull(), f"{of}doc_id", f"{of}mark").alias(f"k{i}") for i in (1, 2)]
    wanted = members.select("node").distinct().join(classes.select("node", *key("of.")), "node").hint("shuffle_hash")
    met = keyed.select(*key(""), "text").join(wanted, ["k1", "k2"])
    texts = scratch.keep(met.groupBy("k1", "k2").agg(F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text"), "texts")

    # A pair can only pass if the smaller set has percent of the larger one.
    fits = F.lit(100) * F.least("n_shingles", "pivot_n") >= F.lit(percent) * F.greatest("n_shingles", "pivot_n")
    pairs = members.filter((F.col("node") != F.col("pivot")) & fits).select("node", "n_shingles", "pivot", "pivot_n").distinct()
    load = pairs.groupBy("pivot").agg(F.sum("n_shingles").alias("load"), F.first("pivot_n").alias("pivot_n"))
    salts = load.select("pivot", "pivot_n", F.ceil(F.col("load") / BLOCK).cast("long").alias("salts"))
    salted = pairs.join(salts.select("pivot", "salts"), "pivot").select(
        F.concat_ws(":", F.hex("pivot"), F.pmod(F.xxhash64("node"), F.col("salts")).cast("string")).alias("key"), F.lit(1).alias("role"), "node", F.col("node").alias("grp")
    )
    heads = salts.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("s"), "pivot").select(
        F.concat_ws(":", F.hex("pivot"), F.col("s").cast("string")).alias("key"), F.lit(0).alias("role"), F.col("pivot").alias("node"), F.col("pivot").alias("grp")
    )
    first = scratch.keep(_check(salted.unionByName(heads), texts, width, percent), "links")
    grouped = scratch.keep(components(first, scratch), "groups")

    # What the pivots left apart: classes outside the largest group of their bucket, against the others, in blocks.
    labelled = scratch.keep(
        members.select("bucket", "node", "n_shingles").join(grouped, "node", "left").select("bucket", "node", "n_shingles", F.coalesce("root", "node").alias("grp")), "labelled"
    )
    parts = labelled.groupBy("bucket", "grp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("load"))
    mixed = (
        parts.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("grps"), F.max(F.struct("n", "grp"))["grp"].alias("main"), F.sum("load").alias("load"), F.max(F.struct("n", "load"))["load"].alias("main_load"))
        .filter("grps > 1")
        .select("bucket", "main", F.ceil(F.col("load") / BLOCK).cast("long").alias("nt"), F.ceil((F.col("load") - F.col("main_load")) / BLOCK).cast("long").alias("nq"))
    )
    rest = labelled.join(mixed, "bucket")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    mine = lambda n: F.pmod(F.xxhash64("node"), n)
    block = lambda q, t, role: (F.concat_ws(":", *[F.col(x).cast("string") for x in ("bucket", q, t)]).alias("key"), F.lit(role).alias("role"), "node", "grp")
    asks = rest.filter("grp != main").select("*", mine(F.col("nq")).alias("q"), every(F.col("nt")).alias("t")).select(*block("q", "t", 0))
    meets = rest.select("*", mine(F.col("nt")).alias("t"), every(F.col("nq")).alias("q")).select(*block("q", "t", 1))
    second = scratch.keep(_check(asks.unionByName(meets), texts, width, percent), "rest")
    scratch.drop(labelled, members, texts)
    roots = components(first.union(second), scratch)

    nodes = classes.select("node", "low").join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lows = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    final = nodes.select("node", "root").join(lows, "root").select("node", "component_id", F.lower(F.hex("root")).alias("component"))
    out = profiles.select("doc_id", "n_shingles", "node", "mark").join(final, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "mark", "component")
