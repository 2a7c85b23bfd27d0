"""Quality ledger, line dedup, mixing, packing: brute force and awkward inputs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorebook.llm import line_dedup, mixing, packing, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, len(t or "")) for i, t, s in rows], SCHEMA)


def awkward():
    """Nulls everywhere, empty and blank texts, repeated rows, equal texts, one very long text."""
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta\n", "epsilon"]) + str(rng.randrange(50)) for _ in range(30_000))
    return [
        (None, None, None), (None, "same words in a line that is long\nx", "b"), (0, "", "a"), (1, " \t\n\x0b", "a"), (2, long, "a"), (3, "one", None),
        (4, "same words in a line that is long\ny", "b"), (5, "Same Words in a line that is long \nz\n", "b"), (5, "Same Words in a line that is long \nz\n", "b"),
        (6, "same words in a line that is long\nsame words in a line that is long", "c"), (7, "été È # * $ !!", "c"), (8, "a b c a b c a b c", "é"),
    ]


def words(text):
    return (text or "").encode().split()


def brute_quality(text):
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    return len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_equal_brute_force(spark):
    rows = awkward() + [(20 + i, "x y " * i + "z", "a") for i in range(6)] + [(40, " ".join(f"w{i % 40} v{i % 37}" for i in range(400)), "a")]
    got = quality.ledger(docs(spark, rows)).collect()
    mine = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert mine == Counter((i, *brute_quality(t)) for i, t, _ in rows)


def test_quality_policies_and_ablations(spark):
    good = " ".join(f"Word{i} follows" for i in range(60))
    rows = [(1, good, "a"), (2, "short", "a"), (3, good + " #" * 40, "a"), (4, "LOUD" + good.upper() + "!" * 50, "a")]
    stored = quality.ledger(docs(spark, rows))
    assert [r.doc_id for r in quality.apply_policy(stored).filter("kept").collect()] == [1]
    assert sorted(r.doc_id for r in quality.apply_policy(stored, "base").filter("kept").collect()) == [1, 3, 4]
    table = {(r.policy, r.rule): r for r in quality.ablations(stored).collect()}
    assert table["v2", "symbols"].alone == 1 and table["v2", "symbols"].kept_without == 2
    assert table["base", "few_words"].failing == 1 and table["base", "few_words"].kept == 3
    with pytest.raises(KeyError):
        quality.apply_policy(stored, "v0")


def test_quality_keeps_rows_as_they_are(spark):
    good = " ".join(f"Word{i} follows" for i in range(60))
    rows = docs(spark, [(1, good, "a"), (None, good, None), (1, good, "a"), (2, "short", "a")]).withColumn("failed", F.lit("x")).withColumn("row", F.lit(1))
    kept = quality.keep_good(rows)
    assert kept.columns == rows.columns and kept.count() == 3
    empty = docs(spark, [])
    assert quality.keep_good(empty).count() == 0
    assert {r.kept for r in quality.ablations(quality.ledger(empty)).collect()} == {0}


def brute_lines(rows, min_docs=3):
    def key(line):
        stripped = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in stripped) if len(stripped) >= 20 else None

    rank = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            if key(line):
                holders[key(line)].add(rank(i))
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if not (key(x) and len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != rank(i))]
        out.append((i, len(lines) - len(keep), "\n".join(keep)))
    return Counter(out)


@pytest.mark.parametrize("parts", ["2", "7"])
def test_lines_equal_brute_force(spark, parts):
    rng = random.Random(1)
    pool = [f"a common line of the corpus {i}" for i in range(12)] + ["short", "", "ÜÜ lines with É letters in it"]
    rows = awkward() + [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(9))), "s") for i in range(60)]
    rows += [(200 + i, f"the one very common line\nown line number {i} of its own", "s") for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        table = docs(spark, rows).withColumn("kept_text", F.lit("mine"))
        cut = line_dedup.apply_bitmaps(table, line_dedup.keep_bitmaps(table))
        assert cut.columns == [*table.columns, "_kept_text", "n_dropped"]
        assert Counter((r.doc_id, r.n_dropped, r._kept_text) for r in cut.collect()) == brute_lines(rows)
        clean = line_dedup.dedup_lines(table)
        assert clean.columns == table.columns and clean.filter("text is null").count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bitmaps_are_packed_and_empty_tables_work(spark):
    line = "this line stands in three documents"
    rows = [(i, f"own {i}\n{line}\nend", "a") for i in range(3)]
    found = {r.doc_id: r for r in line_dedup.keep_bitmaps(docs(spark, rows)).collect()}
    assert set(found) == {0, 1} and found[0].n_lines == 3 and found[0].n_dropped == 1
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bytes(found[1].keep_bitmap)), np.uint8), count=3)
    assert bits.tolist() == [1, 0, 1]
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def brute_targets(sizes, weights=(3, 1, 2), percent=150, most=2):
    """Share by weight, cap, and share the excess again, step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, open_ = dict.fromkeys(names, 0.0), set(names)
    left = sum(sizes.values()) * percent / 100
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            goal[s] += share[s]
            if goal[s] >= most * sizes[s]:
                left += goal[s] - most * sizes[s]
                goal[s] = most * sizes[s]
                open_.discard(s)
    return goal


def test_mix_hits_targets(spark):
    rng = random.Random(9)
    rows = awkward() + [(1000 + i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["a", "b", "c", "d", None, "z"])) for i in range(900)]
    got = mixing.copies(docs(spark, rows)).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    goal = brute_targets(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert 0 <= r.copies <= 2 and r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6
        taken[r.source] += r.copies * r.size * r.times
        largest[r.source] = max(largest[r.source], r.size * r.times)
    assert sum(r.times for r in got) == len(rows)
    assert all(abs(taken[s] - goal[s]) <= largest[s] + 1e-6 for s in goal)
    again = mixing.copies(docs(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    table = docs(spark, rows).withColumn("__copies", F.lit("kept")).withColumn("size", F.lit(None).cast("int"))
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns and mixed.count() == sum(r.copies * r.times for r in got)
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, "", "a"), (2, None, None)])).count() == 0


def test_packing_is_complete_and_tight(spark):
    rng = random.Random(4)
    rows = awkward() + [(100 + i, " ".join(["w"] * rng.choice([1, 5, 5, 90, 130, 511, 700])), "s") for i in range(400)]
    placed = packing.pack(docs(spark, rows)).collect()
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for p in placed:
        by_doc[p.doc_id].append(p)
        if p.bin_id is not None:
            by_bin[p.bin_id].append(p)
    wanted = Counter()
    for i, text, _ in rows:
        wanted[i] += len(words(text))
    assert {i: sum(p.length for p in ps) for i, ps in by_doc.items()} == dict(wanted)
    for ps in by_bin.values():
        ps.sort(key=lambda p: p.bin_start)
        at = 0
        for p in ps:
            assert p.bin_start == at and p.bin_size == ps[0].bin_size and p.bin_used == ps[0].bin_used
            at += p.length
        assert at == ps[0].bin_used
        assert ps[0].bin_size == min(c for c in packing.CAPACITIES if c >= at)
    total = sum(wanted.values())
    assert total / sum(ps[0].bin_size for ps in by_bin.values()) > 0.97
    again = packing.pack(docs(spark, rows[::-1]).repartition(3)).collect()
    assert Counter(map(str, again)) == Counter(map(str, placed))
    listed = packing.bins(packing.pack(docs(spark, rows))).collect()
    assert len(listed) == len(by_bin) and all(sum(b.lengths) == b.bin_used for b in listed)
    assert packing.bins(packing.pack(docs(spark, []))).count() == 0


def test_plan_against_a_plain_best_fit():
    rng = random.Random(2)
    for _ in range(60):
        pieces = [rng.randrange(1, 65) for _ in range(rng.randrange(1, 80))]
        sizes = rng.choice([(64,), (16, 64), (8, 32, 64)])
        fillings = packing.plan(dict(Counter(pieces)), sizes, bin_cost=1)
        used = Counter(x for f in fillings for x in f.lengths for _ in range(f.bins))
        assert used == Counter(pieces)
        assert all(sum(f.lengths) <= f.size and f.size == min(s for s in sizes if s >= sum(f.lengths)) for f in fillings)
        if len(sizes) == 1:  # one size: bins at most as many as first-fit needs at worst
            assert sum(f.bins for f in fillings) <= 1.7 * -(-sum(pieces) // 64) + 1
    with pytest.raises(ValueError):
        packing.plan({65: 1}, (64,))


def test_line_key_matches_contract():
    assert line_dedup.line_key("\x0b  ABCDEFGHIJKLMNOPQRST\r".encode(), 20) == b"abcdefghijklmnopqrst"
    assert line_dedup.line_key("ÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀ".encode(), 20) is None
    assert line_dedup.line_key("ÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀÀ".encode(), 20) is not None
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_lines_of_a_table_with_clashing_names(spark):
    rows = [(i, f"a line that many documents share\nown {i}", "s") for i in range(5)]
    table = docs(spark, rows).withColumns({name: F.lit(1) for name in ("__doc", "__mark", "__lost", "__bits", "packed", "bits", "doc", "kept_text", "N_Dropped", "mark", "pos", "lo")})
    out = line_dedup.apply_bitmaps(table, line_dedup.keep_bitmaps(table))
    assert out.columns == [*table.columns, "_kept_text", "_n_dropped"]
    assert {r["doc_id"]: (r["_kept_text"], r["_n_dropped"]) for r in out.collect()} == {i: (t if i == 4 else f"own {i}", int(i != 4)) for i, t, _ in rows}
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(table).collect()} == {i: t if i == 4 else f"own {i}" for i, t, _ in rows}
