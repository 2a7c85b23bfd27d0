"""Fill-in-the-middle texts by displacement of bytes.

A batch of texts is one array of bytes. Each text is cut after whole lines into prefix, middle and suffix, and the three
parts change places around their markers. A part moves as a whole, so the displacement of all bytes is a step function:
its steps stand in a difference array, the cumulative sum is the shift of every byte, and one scatter writes all outputs
of the batch. Restoring finds the markers, derives the steps the other way round and gathers.

Markers begin with a character that occurs nowhere else in them. A text that holds a marker is left plain, so the markers
of an output are its own: an occurrence that overlapped one would hold that character inside.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.llm.common import small_batches, whole

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes displaced at once; the shifts of so many are held, eight bytes each.
CHUNK = 1 << 20
_FORMS = np.array(["plain", "psm", "spm"])
_COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the digest of seed and id; a null id counts as the word null."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def displaced(starts: np.ndarray, shifts: np.ndarray, total: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(begin, end, positions plus shift) for chunks of 0..total; ``shifts`` hold from ``starts`` (ascending) on.

    Of parts that start together the last holds: the others are empty.
    """
    steps, carried = np.diff(shifts, prepend=0), 0
    for begin in range(0, total, CHUNK):
        end = min(total, begin + CHUNK)
        first, last = np.searchsorted(starts, [begin, end])
        difference = np.zeros(end - begin, np.int64)
        np.add.at(difference, starts[first:last] - begin, steps[first:last])
        difference[0] += carried
        shift = np.cumsum(difference)
        carried = int(shift[-1])
        yield begin, end, np.arange(begin, end) + shift


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and the edges of its values in them."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[edges[0] : edges[-1]], edges - edges[0]


def _strings(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    big = pa.Array.from_buffers(pa.large_string(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)])
    return big.cast(pa.string())


def _occurrences(data: np.ndarray, edges: np.ndarray, marker: bytes) -> np.ndarray:
    """Where ``marker`` begins within one value."""
    if len(data) < len(marker):
        return np.empty(0, np.int64)
    at = np.flatnonzero(data[: len(data) - len(marker) + 1] == marker[0])
    for i, byte in enumerate(marker[1:], 1):
        at = at[data[at + i] == byte]
    return at[edges[np.searchsorted(edges, at, "right")] >= at + len(marker)]


def _within(at: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many of the positions lie in each value."""
    return np.searchsorted(at, edges[1:]) - np.searchsorted(at, edges[:-1])


def _scatter(marks: tuple[bytes, bytes, bytes], rate: int, spm_rate: int) -> Callable:
    p, s, m = (len(x) for x in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, edges = _bytes(batch.column(1))
            h1, h2, h3, h4 = (batch.column(i).to_numpy() for i in range(2, 6))
            start, end = edges[:-1], edges[1:]
            # Scan cuts: line ends, and the ends of prefix and middle among them.
            breaks = np.flatnonzero(data == 10)
            first, count = np.searchsorted(breaks, start), _within(breaks, edges)
            open_end = np.zeros(len(start), bool)
            some = end > start
            open_end[some] = data[end[some] - 1] != 10
            n = count + open_end
            a, b = h1 % (n + 1), h2 % (n + 1)

            def after(units: np.ndarray) -> np.ndarray:
                at = np.where(units > count, end, start)
                inner = (units > 0) & (units <= count)
                at[inner] = breaks[(first + units - 1)[inner]] + 1
                return at

            marked = sum(_within(_occurrences(data, edges, x), edges) for x in marks)
            form = np.where((n == 0) | (marked > 0) | (h3 % 100 >= rate), 0, np.where(h4 % 100 < spm_rate, 2, 1))
            plain = form == 0
            low, high = (np.where(plain, end, after(f(a, b))) for f in (np.minimum, np.maximum))
            # Displacement of the three parts of each text.
            size = end - start + np.where(plain, 0, p + s + m)
            out_edges = np.concatenate([[0], np.cumsum(size)])
            out = out_edges[:-1]
            head, tail = low - start, end - high
            p_at = np.where(form == 2, out + s + tail, out)
            s_at = np.where(form == 2, out, out + p + head)
            m_at = out + p + head + s + tail
            moved = [np.where(plain, out - start, p_at + p - start), m_at + m - low, s_at + s - high]
            starts = np.stack([start, low, high], 1).ravel()
            made = np.empty(out_edges[-1], np.uint8)
            for begin, stop, to in displaced(starts, np.stack(moved, 1).ravel(), len(data)):
                made[to] = data[begin:stop]
            for at, mark in zip((p_at, s_at, m_at), marks, strict=True):
                made[at[~plain, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
            # Code points of the parts: the parts that hold bytes lie edge to edge.
            sizes, chars = np.diff(starts, append=len(data)), np.zeros(len(starts), np.int64)
            if len(data):
                chars[sizes > 0] = np.add.reduceat((data & 0xC0) != 0x80, starts[sizes > 0], dtype=np.int64)
            chars = chars.reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(_FORMS[form].tolist(), pa.string()),
                 *[pa.array(chars[:, i], pa.int64(), mask=plain) for i in (0, 1)], _strings(made, out_edges)],
                names=[x.split()[0] for x in _COLUMNS.split(", ")],
            )

    return run


def _gather(marks: tuple[bytes, bytes, bytes]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, edges = _bytes(batch.column(5))
            start, end = edges[:-1], edges[1:]
            form = np.select([np.array(batch.column(2).to_pylist()) == x for x in ("psm", "spm")], [1, 2], 0)
            moved = form > 0
            at = []
            for mark in marks:
                found = _occurrences(data, edges, mark)
                if (_within(found, edges)[moved] != 1).any():
                    raise ValueError("an output without its three markers")
                position = start.copy()
                position[moved] = found[np.searchsorted(found, start[moved])]
                at.append(position)
            (p_at, s_at, m_at), (p, s, m) = at, (len(x) for x in marks)
            # Where prefix, middle and suffix begin and end in the output; a plain text is all prefix.
            parts = [
                (np.where(moved, p_at + p, start), np.select([form == 1, form == 2], [s_at, m_at], end)),
                (np.where(moved, m_at + m, end), end),
                (np.where(moved, s_at + s, end), np.select([form == 1, form == 2], [m_at, p_at], end)),
            ]
            sizes = np.stack([b - a for a, b in parts], 1)
            back = np.concatenate([[0], np.cumsum(sizes.ravel())])
            sources = np.stack([a for a, _ in parts], 1).ravel()
            made = np.empty(back[-1], np.uint8)
            for begin, stop, origin in displaced(back[:-1], sources - back[:-1], len(made)):
                made[begin:stop] = data[origin]
            yield pa.RecordBatch.from_arrays([*batch.columns, _strings(made, back[::3])], names=[*batch.schema.names, "restored"])

    return run


def _marks(markers: tuple[str, str, str]) -> tuple[bytes, bytes, bytes]:
    marks = tuple(x.encode() for x in markers)
    if len(set(marks)) < 3 or not all(marks) or any(x[0] != marks[0][0] or x.count(x[:1]) > 1 for x in marks) or any(a != b and b.startswith(a) for a in marks for b in marks):
        raise ValueError("markers differ, none begins another, and all begin with one character that they hold once")
    return marks


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50,
    markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """``doc_id``, ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` for every row of ``docs``.

    ``rate`` of 100 texts are rearranged, of these ``spm_rate`` of 100 with the suffix first. A line ends with its line
    feed, the last one may lack it. Null and empty texts, and texts that hold a marker, stay plain (both counts null). Draws
    depend on the id alone, so rows that repeat an id and text give equal outputs; a null id has draws of its own. Texts
    of any length are displaced in chunks of ``CHUNK`` bytes. Other columns of ``docs`` are dropped.
    """
    small_batches(docs)
    doc = F.col(id_col).cast("long")
    rows = docs.select(doc.alias("doc_id"), whole(text_col).cast("binary").alias("text"), *[h.alias(f"h{i}") for i, h in enumerate(draws(doc, seed), 1)])
    return rows.mapInArrow(_scatter(_marks(markers), rate, spm_rate), _COLUMNS)


def restore(outputs: DataFrame, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """The rows of ``fill_in_middle`` with ``restored``, the original text, from ``output`` and ``form`` alone."""
    small_batches(outputs)
    rows = outputs.select(*[F.col(x.split()[0]) for x in _COLUMNS.split(", ")])
    return rows.mapInArrow(_gather(_marks(markers)), f"{_COLUMNS}, restored string")
