"""Lines repeated across documents, found by sorting their hashes over ranges.

Hashes of normalised lines are range-partitioned and sorted within each range by document and position, so that one
pass over a range meets the holder that keeps a line first and all others after it. A line common to a third of all
documents spreads over many ranges: the range key holds the document too, and what a range cannot decide alone is
decided from two summary rows per range. The result is one compressed keep bitmap per document that loses lines; the
texts stay where they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from scorebook.llm.common import Scratch, fresh, small_batches, whole

_WHITE = b" \t\n\x0b\x0c\r"
_LINE = "hi long, lo long, has int, doc long, mark long, lines int, pos int"
_FOUND = "kind int, hi long, lo long, has int, doc long, mark long, lines int, pos int, docs long"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Key of one line: white space stripped, A-Z lower-cased; None below ``min_chars`` code points."""
    key = line.strip(_WHITE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def _explode(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has, doc, mark, texts = (batch.column(i) for i in range(4))
            digests, at, pos, lines = [], [], [], []
            for row, text in enumerate(texts):
                parts = text.as_py().split(b"\n")
                for i, part in enumerate(parts):
                    key = line_key(part, min_chars)
                    if key is not None:
                        digests.append(xxhash.xxh3_128_digest(key))
                        at.append(row)
                        pos.append(i)
                        lines.append(len(parts))
            hashed = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashed[:, 0]), pa.array(hashed[:, 1]), has.take(take), doc.take(take), mark.take(take), pa.array(lines, pa.int32()), pa.array(pos, pa.int32())],
                names=["hi", "lo", "has", "doc", "mark", "lines", "pos"],
            )

    return run


def _stream(min_docs: int):
    """Over one sorted range: rows to drop (kind 0), rows that depend on other ranges (1), summaries (2).

    Holders of a line come largest document first. Only the rows of its second document wait until a third is seen;
    the first line of the range may have begun in an earlier one, the last may go on in a later one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"key": None, "first": True, "docs": 0, "top": None, "last": None, "wait": []}
        names = ["kind", "hi", "lo", "has", "doc", "mark", "lines", "pos", "docs"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        out: list[tuple] = []

        def close(edge: bool) -> None:
            """End the current line; ``edge``: it touches the border of the range."""
            if state["key"] is None:
                return
            if edge:
                out.extend((1, *row, 0) for row in state["wait"])
                out.append((2, *state["key"], *state["top"], 0, 0, 0, state["docs"]))
            state.update(first=False, wait=[])

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[] for _ in names]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
            out.clear()
            return batch

        for batch in batches:
            hi, lo, has, doc = (np.asarray(batch.column(i)) for i in range(4))
            n = len(hi)
            if not n:
                continue
            same = (hi[1:] == hi[:-1]) & (lo[1:] == lo[:-1])
            starts = np.flatnonzero(np.concatenate(([True], ~same)))
            ends = np.append(starts[1:], n)
            rows = None
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                key = (int(hi[a]), int(lo[a]))
                if key != state["key"]:
                    close(state["first"])
                    if b - a == 1 and b < n and state["key"] is not None:
                        state["key"], state["docs"] = key, -1  # alone and not at a border: nothing to say
                        continue
                    state.update(key=key, docs=0, top=None, last=None, wait=[])
                if rows is None:
                    rows = list(zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True))
                for row in rows[a:b]:
                    holder = row[2:4]
                    if holder != state["last"]:
                        state["docs"] += 1
                        state["last"] = holder
                        state["top"] = state["top"] or holder
                        if not state["first"] and state["docs"] == min_docs:
                            out.extend((0, *x, 0) for x in state["wait"])
                            state["wait"] = []
                    if state["first"] or (holder != state["top"] and state["docs"] < min_docs):
                        state["wait"].append(row)
                    elif holder != state["top"]:
                        out.append((0, *row, 0))
                if state["first"]:  # held by every range that has it at its start: hand rows on at once
                    out.extend((1, *x, 0) for x in state["wait"])
                    state["wait"] = []
            if out:
                yield flush()
        if state["docs"] > 0:
            close(True)
        yield flush()

    return run


@F.pandas_udf(BinaryType())
def _bitmap(positions: pd.Series, lines: pd.Series) -> pd.Series:
    def pack(dropped, n):
        keep = np.ones(n, dtype=bool)
        keep[np.asarray(dropped, dtype=np.int64)] = False
        return zlib.compress(np.packbits(keep).tobytes(), 6)

    return pd.Series([pack(p, n) for p, n in zip(positions, lines, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def _kept(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
    def cut(text, packed):
        if packed is None:
            return None
        parts = text.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8), count=len(parts))
        return "\n".join([part for part, stays in zip(parts, keep.tolist(), strict=True) if stays])

    return pd.Series([cut(t, b) for t, b in zip(texts, bitmaps, strict=True)], dtype=object)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id``, ``mark``, ``n_lines``, ``n_dropped``, ``keep_bitmap`` of the documents that lose lines.

    A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of at least ``min_chars``
    code points found in at least ``min_docs`` documents lose their lines except in the largest id holding them.
    Documents are told apart by id: rows that repeat an id are one document and keep or lose a key together; a null id
    is one document, smaller than all others. ``mark`` (a hash of the text) separates rows of one id with different
    texts. A null or empty text is one empty line and never loses it. The bitmap is zlib-packed, one bit a line.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    small_batches(docs)
    doc = F.col(id_col).cast("long")
    source = docs.select(
        doc.isNotNull().cast("int").alias("has"), F.coalesce(doc, F.lit(0)).alias("doc"),
        F.xxhash64(whole(text_col)).alias("mark"), whole(text_col).cast("binary").alias("text"),
    )
    lines = source.mapInArrow(_explode(min_chars), _LINE)
    ranged = lines.repartitionByRange("hi", "lo", F.desc("has"), F.desc("doc")).sortWithinPartitions("hi", "lo", F.desc("has"), F.desc("doc"), "mark", "pos")
    found = scratch.keep(ranged.mapInArrow(_stream(min_docs), _FOUND), "found")
    # Two rows per range at most, so the planner may well send them to every task.
    edges = found.filter("kind = 2").groupBy("hi", "lo").agg(F.sum("docs").alias("total"), F.max(F.struct("has", "doc")).alias("top"))
    late = (
        found.filter("kind = 1")
        .join(F.broadcast(edges), ["hi", "lo"])
        .filter((F.col("total") >= min_docs) & (F.struct("has", "doc") != F.col("top")))
    )
    columns = ["has", "doc", "mark", "lines", "pos"]
    dropped = found.filter("kind = 0").select(columns).unionByName(late.select(columns))
    grouped = dropped.groupBy("has", "doc", "mark").agg(F.collect_set("pos").alias("at"), F.first("lines").alias("n"))
    return grouped.select(
        F.when(F.col("has") == 1, F.col("doc")).alias("doc_id"), "mark", F.col("n").cast("long").alias("n_lines"),
        F.size("at").cast("long").alias("n_dropped"), _bitmap("at", "n").alias("keep_bitmap"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns at the end: the kept text and the number of dropped lines.

    They are named ``kept_text`` and ``n_dropped``, with underscores in front if ``docs`` has such columns. The
    bitmaps are the built side of the join, so the texts move once and are not sorted.
    """
    kept, lost = fresh(docs, "kept_text"), fresh(docs, "n_dropped")
    packed = fresh(docs, "packed")
    # One column of a fresh name, so that no column of the table can be mistaken for one of the bitmaps.
    right = bitmaps.select(F.struct(F.col("doc_id").alias("doc"), "mark", F.col("n_dropped").alias("lost"), F.col("keep_bitmap").alias("bits")).alias(packed)).hint("shuffle_hash")
    text, found = whole(F.col(f"`{text_col}`")), lambda name: F.col(f"{packed}.{name}")
    joined = docs.join(right, F.col(f"`{id_col}`").cast("long").eqNullSafe(found("doc")) & (F.xxhash64(text) == found("mark")), "left")
    cut = _kept(F.when(found("bits").isNotNull(), text), found("bits"))
    small_batches(docs)
    return joined.select(
        *[F.col(f"`{name}`") for name in docs.columns], F.coalesce(cut, text).alias(kept), F.coalesce(found("lost"), F.lit(0)).cast("long").alias(lost)
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with repeated lines cut from the text column; other columns and all rows stay.

    A text that loses every line becomes empty; a null text stays null.
    """
    marked = apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars, min_docs), id_col, text_col)
    kept, names = marked.columns[-2], docs.columns
    text = F.when(F.col(f"`{text_col}`").isNotNull(), F.col(f"`{kept}`")).alias(text_col)
    return marked.select(*[text if name == text_col else F.col(f"`{name}`") for name in names])
