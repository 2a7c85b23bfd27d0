"""The stages in order against a plain version, and registered queries against SQL."""

from __future__ import annotations

from collections import Counter

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from scorebook.llm import mixing, packing, quality, queries
from test_llm_filters import awkward, brute_lines, docs
from test_llm_near import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(FOLDER), queries.QUERIES[name], queries.ORACLES[name], FOLDER) is None


def test_all_operators_are_registered():
    names = contract.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}


def test_stages_equal_a_plain_version(spark):
    docs_in = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs_in.collect()]

    judged = {r.doc_id: r.kept for r in quality.apply_policy(quality.ledger(docs_in)).collect()}
    good = corpus_pipeline.quality_rules(spark, docs_in, FOLDER)
    plain = [r for r in rows if judged[r[0]]]
    assert Counter(r.doc_id for r in good.collect()) == Counter(r[0] for r in plain) and good.columns == docs_in.columns

    cut = corpus_pipeline.line_deduplication(spark, good, FOLDER)
    texts = {i: text for i, _, text in brute_lines(plain)}
    assert {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == {i: (t, len(t)) for i, t in texts.items()}
    assert cut.columns == docs_in.columns

    plain = [(i, texts[i], s) for i, _, s in plain]
    near = corpus_pipeline.near_deduplication(spark, cut, FOLDER)
    kept = {i for i, _, low, own in brute(plain, 5, 80) if own}
    assert {r.doc_id for r in near.collect()} == kept and near.columns == docs_in.columns

    mixed = corpus_pipeline.source_mix(spark, near, FOLDER)
    times = {r.doc_id: r.copies for r in mixing.copies(near).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in times.items() if n})

    packed = corpus_pipeline.sequence_packing(spark, mixed, FOLDER).collect()
    words = Counter()
    for b in packed:
        assert sum(b.lengths) == b.bin_used <= b.bin_size and b.bin_size in packing.CAPACITIES
        for i, n in zip(b.doc_ids, b.lengths, strict=True):
            words[i] += n
    assert words == Counter({i: len(texts[i].encode().split()) * n for i, n in times.items() if n and texts[i].split()})

    assert sum(len(b.lengths) for b in corpus_pipeline.run(spark, FOLDER).collect()) == sum(len(b.lengths) for b in packed)


def test_stages_on_awkward_and_empty_rows(spark):
    for rows in (awkward(), []):
        table = docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            out = stage(spark, table, FOLDER)
            assert out.columns == table.columns
            out.collect()
        corpus_pipeline.quality_rules(spark, table, FOLDER).collect()
        corpus_pipeline.sequence_packing(spark, table, FOLDER).collect()


def test_one_row_of_each_group_stays(spark):
    """Groups of null ids only, near-equal texts under one id, rows repeated whole, and texts without words."""
    base = [f"w{i}" for i in range(60)]
    near = lambda i: " ".join([*base, f"x{i}"])
    other = " ".join(f"v{i}" for i in range(40))
    rows = [
        (None, other, "a"), (None, other + " z", "a"), (None, other, "b"),
        (7, near(1), "a"), (7, near(2), "a"), (7, near(1), "c"), (9, near(3), "a"), (None, near(4), "a"),
        (11, "alone in the world", "a"), (12, "", "a"), (12, "", "a"), (12, None, "b"), (None, " \n", "c"),
    ]
    for extra in (None, "__kept", "mark", "component"):
        table = docs(spark, rows) if extra is None else docs(spark, rows).withColumn(extra, F.lit(1))
        out = [(r.doc_id, r.text, r.source) for r in corpus_pipeline.near_deduplication(spark, table, FOLDER).collect()]
        kept = Counter((i, (t or "").split()[:1] and t.split()[0]) for i, t, _ in out if (t or "").strip())
        assert kept == Counter({(None, "v0"): 1, (7, "w0"): 1, (11, "alone"): 1})
        assert Counter(r for r in out if not (r[1] or "").strip()) == Counter({(12, "", "a"): 2, (12, None, "b"): 1, (None, " \n", "c"): 1})
