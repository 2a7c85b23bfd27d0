"""Near duplicates and components against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from scorebook.llm import graph, near_dedup
from scorebook.llm.common import Scratch
from test_llm_filters import SCHEMA, awkward, docs  # noqa: F401


def shingles(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    size = min(width, len(w))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute(rows, width, percent):
    sets = [shingles(text, width) for _, text, _ in rows]
    forest = graph.UnionFind()
    for i, a in enumerate(sets):
        forest.find(i)
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                forest.union(i, j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[forest.find(i)].append(rows[i][0])
    out = Counter()
    for i, (doc, _, _) in enumerate(rows):
        ids = [x for x in groups[forest.find(i)] if x is not None] if sets[i] else [doc]
        low = min(ids) if ids and ids != [None] else None
        out[doc, len(sets[i]), low, doc == low] += 1
    return out


def family(rng, start, size, most):
    """Copies of one text with up to ``most`` words replaced: links among them are many and not transitive."""
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    rows = []
    for i in range(size):
        own = list(base)
        for _ in range(rng.randrange(most + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((start + i, " ".join(own), "s"))
    return rows


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80), (3, 50)])
def test_near_duplicates_equal_brute_force(spark, width, percent):
    rng = random.Random(width)
    rows = awkward() + family(rng, 100, 60, 9) + family(rng, 300, 40, 3) + [(500 + i, "the same text again and again", "s") for i in range(30)]
    rows += [(600 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)), "s") for i in range(40)]
    rng.shuffle(rows)
    got = near_dedup.near_duplicates(docs(spark, rows), width=width, percent=percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, width, percent)


def test_repeated_rows_bring_one_text(spark, monkeypatch):
    rows = family(random.Random(4), 100, 6, 2)
    rows += [rows[0]] * 40 + [(None, rows[1][1], "s")] * 9
    counts, check = [], near_dedup._check

    def counted(pairs, texts, width, percent):
        counts.append((texts.count(), texts.select("node").distinct().count()))
        return check(pairs, texts, width, percent)

    monkeypatch.setattr(near_dedup, "_check", counted)
    got = near_dedup.near_duplicates(docs(spark, rows), width=3, percent=70).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 3, 70)
    assert len(counts) == 2 and all(n == nodes > 1 for n, nodes in counts)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0
    only = near_dedup.near_duplicates(docs(spark, [(3, None, "s"), (4, " ", "s")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in only) == [(3, 0, 3, True), (4, 0, 4, True)]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85):
        found = []
        for _ in range(60):
            common, n = rng.integers(0, 2**63, int(400 * share), dtype=np.uint64), 400 - int(400 * share)
            a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, n // 2, dtype=np.uint64)])) for _ in range(2))
            one, two = near_dedup.superminhash([a, b], 120)
            found.append((one == two).mean())
        assert abs(np.mean(found) - share) < 0.02


def test_signatures_do_not_depend_on_the_batch_and_small_sets_fill_all_registers():
    sets = [np.array(x, np.uint64) for x in ([7], [7, 9], list(range(50)), list(range(5000)))]
    together = near_dedup.superminhash(sets, 120)
    assert (together != np.iinfo(np.uint64).max).all()
    for row, one in zip(together, sets, strict=True):
        assert (near_dedup.superminhash([one], 120)[0] == row).all()
        ranks = np.sort((row >> np.uint64(53)).astype(int))
        assert ranks[-1] < 120
    assert sorted((together[0] >> np.uint64(53)).tolist()) == list(range(120))  # one element gives a permutation


def test_components_of_long_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (7, 6), (None, 3)]
    name = lambda x: None if x is None else x.to_bytes(4, "big")
    edges = spark.createDataFrame([(name(a), name(b)) for a, b in pairs], "a binary, b binary").repartition(7)
    found = {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in graph.components(edges, Scratch(spark, "test")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


@pytest.mark.parametrize("percent", [2, 20, 50, 70, 80, 85, 100])
def test_bands_miss_no_more_than_stated(percent):
    bands, rows = near_dedup.cut_bands(percent)
    assert (1 - (percent / 100) ** rows) ** bands <= near_dedup.MISS
    sets = [near_dedup.mix(np.arange(n, dtype=np.uint64) + np.uint64(77 * n)) for n in (1, 5, 40)]
    signatures = near_dedup.superminhash(sets, bands * rows)
    assert signatures.shape == (3, bands * rows) and (signatures == near_dedup.superminhash(sets[:2], bands * rows)[:1]).all(axis=1)[0]


def test_bands_refuse_no_similarity():
    for percent in (0, 101):
        with pytest.raises(ValueError):
            near_dedup.cut_bands(percent)
