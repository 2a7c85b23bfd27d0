"""SimHash fingerprints of 128 bits, in DataFrame operations only.

Terms are pairs of adjacent words (a single word if there is no other), weighted by how often they occur. Each occurrence
votes on every bit of the fingerprint by the bits of its hash; a bit is set if more than half of the votes are for it.
Votes are counted 2 bits to a long, 64 sums in one aggregation, which combines a document's terms in the task that
splits its text. Fingerprints within a Hamming radius are found over block tables: the bits are cut into blocks,
and each query is looked up in every table under all values a few bits away, so that no pair within the radius is missed.
How many blocks there are follows the number of fingerprints and queries.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.llm.common import Scratch, let, whole, words

#: A text with 1% of its words replaced differs in 2% of its pairs, which is 8 of 128 bits on average; 94 to 97% of such
#: copies are within 12 bits, 2 to 5% within 3 (measured, see README).
RADIUS = 12
#: Values one query may be looked up under, over all block tables; they stand in the plan.
PROBES = 1200
_HALF = 32
_LANES = (1 << _HALF) | 1


def terms(text: Column) -> Column:
    """Hashes of the pairs of adjacent words; a text of one word has that word as its term, an empty text none."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    pairs = lambda h: F.when(F.size(h) < 2, h).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(h) - 2), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1)))
    )
    return let(hashed, pairs)


def simhash(rows: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys``, ``f1``, ``f2``: the two halves of the fingerprint of each distinct key.

    Rows that repeat a key must repeat its text; their votes scale alike and leave the majority as it is. A text without
    terms has the fingerprint zero.
    """
    voted = rows.select(*keys, F.explode_outer(terms(F.col(text_col))).alias("t")).withColumn("t2", F.when(F.col("t").isNotNull(), F.xxhash64("t")))
    sums = [F.sum(F.shiftright(t, i).bitwiseAND(F.lit(_LANES))).alias(f"{t}_{i}") for t in ("t", "t2") for i in range(_HALF)]
    counted = voted.groupBy(*keys).agg(F.count("t").alias("n"), *sums)

    def bits(t: str) -> Column:
        def majority(count: Column, bit: int) -> Column:
            return F.when(2 * count > F.col("n"), F.lit(1 << bit if bit < 63 else -(1 << 63))).otherwise(F.lit(0))

        low = [majority(F.col(f"{t}_{i}").bitwiseAND(F.lit((1 << _HALF) - 1)), i) for i in range(_HALF)]
        high = [majority(F.shiftrightunsigned(f"{t}_{i}", _HALF), i + _HALF) for i in range(_HALF)]
        return reduce(lambda a, b: a.bitwiseOR(b), low + high).cast("long")

    return counted.select(*keys, bits("t").alias("f1"), bits("t2").alias("f2"))


def as_text(f1: Column | str, f2: Column | str) -> Column:
    """A fingerprint as 32 lower-case hex digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(f), 16, "0") for f in (f1, f2)]))


def distance(a: tuple[str, str], b: tuple[str, str]) -> Column:
    return reduce(lambda x, y: x + y, (F.bit_count(F.col(p).bitwiseXOR(F.col(q))) for p, q in zip(a, b, strict=True)))


def likeness(apart: Column) -> Column:
    """Cosine of the term vectors as estimated from differing bits, 1 for equal fingerprints, 0 from half of the bits on."""
    return F.when(apart == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.cos(apart * F.lit(3.141592653589793 / 128))))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and the 128-bit key ``h1``, ``h2`` of both; a null text is empty, a null id a value of its own."""
    doc = F.col(id_col).cast("long")
    row = docs.select(doc.alias("doc_id"), whole(text_col).alias("text"))
    return row.select("doc_id", "text", *[F.xxhash64(F.lit(i), F.col("doc_id").isNull(), "doc_id", "text").alias(f"h{i}") for i in (1, 2)])


def successors(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id``, ``h1``, ``h2``, ``times`` and the key ``n1``, ``n2`` of the next document by ascending id.

    One row per distinct document; null ids come first, equal ids follow the key, the last is followed by the first. Ids
    are dealt over ranges and sorted there; only the first id of each range is looked up across ranges.
    """
    order = [F.asc_nulls_first("doc_id"), F.col("h1"), F.col("h2")]
    distinct = rows.groupBy("doc_id", "h1", "h2").agg(F.count(F.lit(1)).alias("times"))
    ranged = scratch.keep(distinct.repartitionByRange(*order).select("*", F.spark_partition_id().alias("part")), "ranged")
    heads = ranged.groupBy("part").agg(F.min(F.struct("doc_id", "h1", "h2")).alias("head"))
    # One row per range.
    after = heads.select(
        "part", F.coalesce(F.lead("head").over(Window.orderBy("part")), F.first("head").over(Window.orderBy("part"))).alias("head")
    )
    following = F.lead(F.struct("h1", "h2")).over(Window.partitionBy("part").orderBy(*order))
    joined = ranged.withColumn("next", following).join(F.broadcast(after), "part")
    out = joined.select("doc_id", "h1", "h2", "times", *[F.coalesce(F.col(f"next.h{i}"), F.col(f"head.h{i}")).alias(f"n{i}") for i in (1, 2)])
    followed = scratch.keep(out, "next")
    scratch.drop(ranged)
    return followed


def edited(rows: DataFrame, following: DataFrame) -> DataFrame:
    """``h1``, ``h2``, ``n_chars``, ``text``: the last half of each text replaced by the start of the next document.

    Whole texts are dealt once by their key and serve both sides; what moves a second time is the half that stays.
    """
    nexts = following.select("h1", "h2", "n1", "n2").hint("shuffle_hash")
    half = F.floor(F.length("text") / 2).cast("int")
    kept = (
        rows.select("h1", "h2", "text")
        .join(nexts, ["h1", "h2"])
        .select(
            F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("n1").alias("h1"), F.col("n2").alias("h2"),
            F.length("text").alias("n_chars"), half.alias("cut"), F.substr("text", F.lit(1), F.length("text") - half).alias("start"),
        )
    )
    joined = rows.select("h1", "h2", "text").join(kept.hint("shuffle_hash"), ["h1", "h2"])
    return joined.select(
        F.col("o1").alias("h1"), F.col("o2").alias("h2"), F.col("n_chars").cast("long").alias("n_chars"),
        F.concat("start", F.substr("text", F.lit(1), F.col("cut"))).alias("text"),
    )


def cut_blocks(radius: int, blocks: int) -> list[tuple[int, int, int]]:
    """(first bit, end bit, bits that may differ) of each block.

    If two fingerprints differ in more bits than allowed in every block, they differ in more than ``radius``: the numbers
    allowed, plus one each, add up to ``radius`` + 1. A block that allows -1 is not looked up.
    """
    edges = [128 * i // blocks for i in range(blocks + 1)]
    each, more = divmod(radius + 1, blocks)
    return [(a, b, each - (i >= more)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]


def reach(radius: int, prints: int, queries: int) -> list[tuple[int, int, int]]:
    """The blocks that make the fewest rows for so many fingerprints and queries; every choice finds all pairs.

    Few long blocks are selective but have to be probed under many values; many short ones hold each fingerprint in more
    tables and let more of them meet by chance. Counted are the rows dealt out and the chance meetings.
    """

    prints, queries = max(1, prints), max(1, queries)

    def tables(cut: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
        """Width of each block that is looked up, and the values it is probed under."""
        return [(b - a, sum(comb(b - a, k) for k in range(t + 1))) for a, b, t in cut if t >= 0]

    def rows(cut: list[tuple[int, int, int]]) -> float:
        return sum(prints + queries * values * (1 + prints / 2.0**width) for width, values in tables(cut))

    cuts = [cut_blocks(radius, n) for n in range(2, max(2, radius + 1) + 1)]
    return min((cut for cut in cuts if cut is cuts[-1] or sum(values for _, values in tables(cut)) <= PROBES), key=rows)


def near_pairs(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``q1``, ``q2``, ``apart`` and all columns of ``prints``: every row of it within ``radius`` bits of a distinct query.

    ``queries`` has ``q1``, ``q2``; ``prints`` has ``f1``, ``f2``, one row each; both are counted first. A pair that meets in
    several tables comes from the first. Both sides are dealt out by block value: neither is ever broadcast, as the probes
    grow with the queries by a factor that size estimates do not see.
    """
    asked = queries.select("q1", "q2").distinct()
    cut = reach(radius, prints.count(), asked.count())

    def block(f1: str, f2: str, i: int) -> Column:
        """Bits of block i, which may reach over both halves."""
        start, end, _ = cut[i]
        parts = []
        for name, base in ((f1, 0), (f2, 64)):
            low, high = max(start, base) - base, min(end, base + 64) - base
            if low < high:
                bits = F.shiftrightunsigned(name, low).bitwiseAND(F.lit((1 << (high - low)) - 1 if high - low < 64 else -1))
                parts.append(F.shiftleft(bits, base + low - start))
        return reduce(lambda x, y: x.bitwiseOR(y), parts).cast("long")

    def masks(i: int) -> Column:
        """All ways to change as many bits of block i as may differ."""
        start, end, allowed = cut[i]
        flips = [sum(1 << x for x in c) for k in range(allowed + 1) for c in combinations(range(end - start), k)]
        return F.split(F.lit(",".join(str(x - (1 << 64) if x >> 63 else x) for x in flips)), ",").cast("array<long>")

    def entry(i: int, value: Column, b: str, v: str) -> Column:
        return F.struct(F.lit(i).cast("byte").alias(b), value.alias(v))

    def probes(i: int) -> Column:
        return F.transform(masks(i), lambda m: entry(i, block("q1", "q2", i).bitwiseXOR(m), "b", "v"))

    used = [i for i, (_, _, allowed) in enumerate(cut) if allowed >= 0]
    probed = asked.select("*", F.inline(F.concat(*[probes(i) for i in used])))
    held = prints.select("*", F.inline(F.array(*[entry(i, block("f1", "f2", i), "pb", "pv") for i in used])))
    agree = [F.when(F.bit_count(block("q1", "q2", i).bitwiseXOR(block("f1", "f2", i))) <= cut[i][2], F.lit(i)) for i in used]
    close = distance(("q1", "q2"), ("f1", "f2")) <= radius
    met = probed.hint("merge").join(held, (F.col("b") == F.col("pb")) & (F.col("v") == F.col("pv")) & close & (F.coalesce(*agree) == F.col("b")))
    return met.select("q1", "q2", distance(("q1", "q2"), ("f1", "f2")).alias("apart"), *prints.columns)


def near(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``q1``, ``q2``, ``n_near``: documents within ``radius`` bits of each distinct query fingerprint.

    ``queries`` has ``q1``, ``q2``; ``prints`` has ``f1``, ``f2``, ``times`` (documents with it), one row each.
    """
    return near_pairs(queries, prints, radius).groupBy("q1", "q2").agg(F.sum("times").alias("n_near"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, every: int = 100) -> DataFrame:
    """The partners behind ``n_near``, as pairs of fingerprints: ``fingerprint``, ``near_fingerprint``, ``apart``, ``n_near``.

    One row for the fingerprint of documents with ids divisible by ``every`` and each fingerprint within ``radius`` bits
    that other documents have; ``n_near`` counts these documents as ``fingerprint_edits`` does, and its rows tell which they
    are. A fingerprint is its own partner if several documents have it. Copies are not multiplied into pairs.
    """
    scratch = Scratch(docs.sparkSession, "copies")
    keys = ["doc_id", "h1", "h2"]
    rows = keyed(docs, id_col, text_col)
    times = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    members = scratch.keep(times.join(simhash(rows, keys).select("h1", "h2", "f1", "f2"), ["h1", "h2"]), "members")
    prints = scratch.keep(members.groupBy("f1", "f2").agg(F.sum("times").alias("times")), "prints")
    asked = members.filter(F.col("doc_id") % every == 0).select(F.col("f1").alias("q1"), F.col("f2").alias("q2"))
    others = F.col("times") - F.when(F.col("apart") == 0, 1).otherwise(0)
    found = near_pairs(asked, prints, radius).withColumn("n_near", others).filter("n_near > 0")
    return found.select(as_text("q1", "q2").alias("fingerprint"), as_text("f1", "f2").alias("near_fingerprint"), "apart", "n_near")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, every: int = 100) -> DataFrame:
    """Per row of ``docs``: its fingerprint, that of its edited text, and their likeness, also to the next document.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next`` and, for ids divisible by ``every``, ``n_near``: other documents within ``radius`` bits (else null). Null
    texts are empty; rows equal in id and text are one document and give equal rows.
    """
    scratch = Scratch(docs.sparkSession, "prints")
    rows = keyed(docs, id_col, text_col)
    following = successors(rows, scratch)
    keys = ["h1", "h2"]
    own = scratch.keep(simhash(rows, keys), "own")
    changed = edited(rows, following)
    digests = changed.select(*keys, "n_chars", F.sha2("text", 256).alias("edited_sha256"), "text")
    marked = [*keys, "n_chars", "edited_sha256"]
    new = simhash(digests, marked).select(*marked, F.col("f1").alias("e1"), F.col("f2").alias("e2"))
    nexts = own.select(F.col("h1").alias("n1"), F.col("h2").alias("n2"), F.col("f1").alias("g1"), F.col("f2").alias("g2"))
    joined = scratch.keep(following.join(own, keys).join(new, keys).join(nexts, ["n1", "n2"]), "joined")
    scratch.drop(following, own)
    prints = scratch.keep(joined.groupBy("f1", "f2").agg(F.sum("times").alias("times")), "prints")
    asked = joined.filter(F.col("doc_id") % every == 0)
    found = near(asked.select(F.col("f1").alias("q1"), F.col("f2").alias("q2")), prints, radius)
    counted = joined.join(found.select(F.col("q1").alias("f1"), F.col("q2").alias("f2"), "n_near"), ["f1", "f2"], "left")
    return counted.select(
        "doc_id", "n_chars", "edited_sha256", as_text("f1", "f2").alias("fingerprint"), as_text("e1", "e2").alias("edited_fingerprint"),
        likeness(distance(("f1", "f2"), ("e1", "e2"))).alias("near_edited"), likeness(distance(("f1", "f2"), ("g1", "g2"))).alias("near_next"),
        F.when(F.col("doc_id") % every == 0, F.col("n_near") - 1).alias("n_near"),
        F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("nth"),
    ).drop("nth")
