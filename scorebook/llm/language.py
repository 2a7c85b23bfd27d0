"""Language identification by compression.

For each language a raw-content dictionary of the compressor is filled from a bounded sample of labelled texts. A text is
encoded once with every dictionary; the language with the smallest encoding is its language. A narrow margin between the
two smallest is reported as a rejection.

Texts are folded first: lower case, and one space for every run of characters that are not letters, so that digits,
symbols and markup count for nothing. They are encoded in blocks, so that the text itself never outgrows the dictionary as
a source of matches; the whole text is encoded, and the sizes of its blocks add up.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.llm.common import small_batches

#: The bounded sample: so many languages (those with most rows), texts of each, characters of a text, and bytes of a dictionary.
LANGUAGES, TEXTS, EXCERPT, DICTIONARY = 200, 128, 2048, 65_536
#: Bytes of folded text in one block, and the compressor's level.
BLOCK, LEVEL = 2048, 9
#: A margin below this share of the smallest encoding is narrow.
MARGIN = 0.01
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
#: Characters folded at once.
_SLICE = 1 << 16


def held_out(doc_id: Column | str) -> Column:
    """Whether the checksum of the id leaves 1 when divided by 3; a null id is not held out."""
    value = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(value.cast("string")) % 3 == 1, F.lit(False))


def folded(text: str) -> bytes:
    return f" {_OTHER.sub(' ', text.lower()).strip()} ".encode()


def blocks(text: str) -> Iterator[bytes]:
    for start in range(0, len(text), _SLICE):
        part = folded(text[start : start + _SLICE])
        for i in range(0, len(part), BLOCK):
            yield part[i : i + BLOCK]


def filled(excerpts: list[str], size: int) -> bytes:
    """A dictionary of ``size`` bytes at most with an equal share of each text, shares of short texts going to the others."""
    parts = list(dict.fromkeys(x for x in map(folded, excerpts) if x.strip()))
    share, left = 0, size
    for done, length in enumerate(sorted(map(len, parts))):
        share = left // (len(parts) - done)
        if length > share:
            break
        left -= length
        share = length
    return b"".join(x[:share] for x in reversed(parts))  # near matches cost least, and the end is nearest


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    languages: int = LANGUAGES, texts: int = TEXTS, excerpt: int = EXCERPT, size: int = DICTIONARY,
) -> dict[str, bytes]:
    """Dictionaries by language, from rows with id, text and label.

    The sample is bounded by the parameters whatever the size of ``docs``: of each of the ``languages`` with most rows, the
    ``texts`` rows with the smallest hash of their id, and of each an excerpt of ``excerpt`` characters at a place the hash
    chooses. A language whose excerpts hold no letter is not learned.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("id IS NOT NULL AND lang IS NOT NULL")
    common = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    if not common:
        return {}
    # Four times as many rows as wanted pass on their hash alone, so that few are ranked.
    pick = F.xxhash64(F.lit(11), F.col("id").cast("string"))
    spread = F.create_map(*[x for row in common for x in (F.lit(row["lang"]), F.lit(min(1.0, (4 * texts + 64) / row["n"])))])
    few = rows.filter(F.shiftrightunsigned(pick, 11) / float(1 << 53) < F.get(F.array(spread), F.lit(0))[F.col("lang")]).filter("text IS NOT NULL")
    place = F.pmod(F.xxhash64(F.lit(13), F.col("id").cast("string")), F.greatest(F.lit(1), F.length("text") - excerpt + 1)) + 1
    cut = few.select("lang", pick.alias("pick"), F.substr("text", place.cast("int"), F.lit(excerpt)).alias("part"))
    ranked = cut.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("pick", "part"))).filter(F.col("nth") <= texts)
    chosen: dict[str, list] = {}
    for row in ranked.collect():
        chosen.setdefault(row["lang"], []).append((row["nth"], row["part"]))
    made = {lang: filled([part for _, part in sorted(parts)], size) for lang, parts in sorted(chosen.items())}
    return {lang: content for lang, content in made.items() if content}


def compressors(dictionaries: dict[str, bytes], level: int = LEVEL) -> dict[str, zstandard.ZstdCompressor]:
    out = {}
    for lang, content in dictionaries.items():
        how = zstandard.ZstdCompressionParameters.from_level(
            level, dict_size=len(content), source_size=BLOCK, min_match=3, write_content_size=False, write_dict_id=False, write_checksum=False
        )
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=how)
        out[lang] = zstandard.ZstdCompressor(dict_data=raw, compression_params=how)
    return out


def _classify(dictionaries: dict[str, bytes], margin: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = list(compressors(dictionaries).items())
        for batch in batches:
            named, scores, gaps, narrow = [], [], [], []
            for text, lettered in zip(batch.column(2), batch.column(3), strict=True):
                if not tools or not lettered.as_py():
                    named.append(UNKNOWN), scores.append(0.0), gaps.append(0.0), narrow.append(True)
                    continue
                sizes = [0] * len(tools)
                for block in blocks(text.as_py()):
                    for i, (_, tool) in enumerate(tools):
                        sizes[i] += len(tool.compress(block))
                best = min(sizes)
                second = sorted(sizes)[1] if len(sizes) > 1 else 2 * best
                gap = min(1.0, (second - best) / best)
                named.append(tools[sizes.index(best)][0])
                scores.append(1 / sum(2.0 ** max(best - x, -1000) for x in sizes))
                gaps.append(gap)
                narrow.append(gap < margin)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(named, pa.string()), pa.array(scores, pa.float64()), pa.array(gaps, pa.float64()), pa.array(narrow, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "margin", "rejected"],
            )

    return run


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``margin``, ``rejected`` for every row of ``docs``; reads id and text only.

    ``lang_pred`` has the smallest encoding, of equal ones the first by name. ``score`` is the language's share if each byte
    more halves a language's weight; ``margin`` what the second smallest is longer, as a share. ``rejected`` says that the
    margin is below ``margin``: a caller who wants no doubtful labels drops these rows. A text that is null or has no
    letter is ``und``, with 0 and rejected, and so is every text if no language was learned. Repeated rows give equal rows.
    """
    small_batches(docs)
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"), lettered.alias("lettered"))
    return rows.mapInArrow(_classify(dictionaries, margin), "doc_id long, held_out boolean, lang_pred string, score double, margin double, rejected boolean")
