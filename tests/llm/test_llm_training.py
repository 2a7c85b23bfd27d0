"""Language identification, fill-in-the-middle, hard negatives: brute force, round trips, held-out accuracy, awkward inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from scorebook.llm import fill_middle, language, negatives
from test_llm_filters import SCHEMA, awkward, docs

SF = "/root/testdata/sf0.01"


# --- fill in the middle


def plain_middle(doc, text, rate=100, spm_rate=50, marks=("<P>", "<S>", "<M>")):
    """(n, form, prefix, middle, output) by slicing."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'null' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    p, s, m = marks
    if not text or any(x in text for x in marks) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return n, "spm", len(pre), len(mid), s + suf + p + pre + m + mid
    return n, "psm", len(pre), len(mid), p + pre + s + suf + m + mid


def lined(seed, count):
    rng = random.Random(seed)
    pieces = ["a line\n", "\n", "été €\n", "𝄞 music\n", "no end", "< P >\n", "<", "\r\n", "\x0b x\n", "<S\n", ">\n"]
    rows = [(100 + i, "".join(rng.choice(pieces) for _ in range(rng.randrange(12))), "s") for i in range(count)]
    return rows + [(90, "has <P> inside\nand more\n", "s"), (91, "x\n<S>", "s"), (92, "<M>", "s"), (93, "ends with <\nS>\n<", "s"), (-5, "one\ntwo\nthree", None)]


@pytest.mark.parametrize(("rate", "spm_rate"), [(100, 50), (60, 30), (0, 50)])
def test_middles_equal_slicing_and_come_back(spark, rate, spm_rate):
    rows = awkward() + lined(5, 60)
    frame = docs(spark, rows).withColumn("form", F.lit("x")).withColumn("output", F.lit(1)).withColumn("h1", F.lit(2))
    got = fill_middle.restore(fill_middle.fill_in_middle(frame, rate=rate, spm_rate=spm_rate)).collect()
    mine = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got)
    assert mine == Counter((d, *plain_middle(d, t, rate, spm_rate), t or "") for d, t, _ in rows)
    forms = {r.form for r in got}
    assert forms == ({"plain"} if rate == 0 else {"plain", "psm", "spm"})


def test_middles_in_chunks_and_in_one(monkeypatch):
    """Batches of texts cut into chunks of any size give the same bytes; empty texts between and at the ends."""
    rows = [(0, ""), *[(d, t) for d, t, _ in lined(8, 200)], (1, ""), (2, "")]
    wanted = [plain_middle(d, t) for d, t in rows]
    h = [[int(hashlib.sha256(f"7:{d}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for d, _ in rows] for i in range(4)]
    columns = [pa.array([d for d, _ in rows]), pa.array([t.encode() for _, t in rows]), *map(pa.array, h)]
    batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "h1", "h2", "h3", "h4"])
    marks = fill_middle._marks(("<P>", "<S>", "<M>"))
    for chunk in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(fill_middle, "CHUNK", chunk)
        made = list(fill_middle._scatter(marks, 100, 50)(iter([batch])))
        assert made[0].column(5).to_pylist() == [w[4] for w in wanted]
        back = list(fill_middle._gather(marks)(iter([x.slice(3) for x in made])))
        assert back[0].column(6).to_pylist() == [t for _, t in rows][3:]


def test_middle_markers(spark):
    own = ("[prefix>", "[suffix>", "[middle>")
    rows = lined(9, 30)
    got = fill_middle.restore(fill_middle.fill_in_middle(docs(spark, rows), markers=own), markers=own).collect()
    assert Counter((r.output, r.restored) for r in got) == Counter((plain_middle(d, t, marks=own)[4], t) for d, t, _ in rows)
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "<P>>", "<M>"), ("aba", "ac", "ad"), ("<P>", "{S}", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(docs(spark, rows), markers=bad)
    assert fill_middle.restore(fill_middle.fill_in_middle(docs(spark, []))).count() == 0


# --- language


def labelled(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, 0) for i, t, lang in rows], SCHEMA)


def test_language_of_held_out_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    learned = language.learn(table.filter(~language.held_out("doc_id")))
    got = {r.doc_id: r for r in language.identify(table, learned).collect()}
    truth = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r.held_out} == set(out)
    assert sum(got[i].lang_pred == truth[i] for i in out) >= 0.98 * len(out)
    sure = [i for i in out if not got[i].rejected]
    assert len(sure) >= 0.95 * len(out) and sum(got[i].lang_pred == truth[i] for i in sure) >= 0.985 * len(sure)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_equals_a_plain_encoding(spark):
    rng = random.Random(2)
    words = {lang: ["".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 8))) for _ in range(60)] for lang, alphabet in (("aa", "abcdeé"), ("bb", "abfgh"), ("cc", "xyzö"))}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n)) + rng.choice([".", "!! 123 $$", "\n"])
    rows = [(i, text(lang, rng.randrange(1, 600)), lang) for i, lang in enumerate(rng.choice(sorted(words)) for _ in range(60))]
    rows += [(70, None, "aa"), (71, "", "bb"), (72, "12 34 !!", "cc"), (None, "abc abc", "zz"), (73, "²", "aa"), (74, "É", "aa"), (5, "abc", None), (5, "abc", None), (75, text("cc", 60_000), "cc")]
    frame = labelled(spark, rows).withColumn("score", F.lit("x")).withColumn("lettered", F.lit(1))
    learned = language.learn(frame.filter(~language.held_out("doc_id")), texts=5, excerpt=300, size=2000)
    assert set(learned) == {"aa", "bb", "cc"} and all(0 < len(x) <= 2000 for x in learned.values())
    assert learned == language.learn(frame.filter(~language.held_out("doc_id")).repartition(5), texts=5, excerpt=300, size=2000)
    tools = {}
    for lang, content in learned.items():
        how = zstandard.ZstdCompressionParameters.from_level(9, dict_size=len(content), source_size=2048, min_match=3, write_content_size=False, write_dict_id=False)
        tools[lang] = (zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), how)
    wanted = Counter()
    for doc, t, _ in rows:
        out = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 1
        if not any(c.isalpha() for c in t or ""):
            wanted[doc, out, "und", 0.0] += 1
            continue
        sizes = {}
        for lang, (raw, how) in tools.items():
            pieces = [" ".join(["", *re.findall(r"[^\W\d_]+", t[i : i + 65536].lower()), ""]).encode() for i in range(0, len(t), 65536)]
            cut = [x[i : i + 2048] for x in pieces for i in range(0, len(x), 2048)]
            sizes[lang] = sum(len(zstandard.ZstdCompressor(dict_data=raw, compression_params=how).compress(x)) for x in cut)
        best = min(sizes, key=lambda x: (sizes[x], x))
        wanted[doc, out, best, round(1 / sum(2.0 ** (sizes[best] - x) for x in sizes.values()), 9)] += 1
    got = language.identify(frame, learned).collect()
    assert Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in got) == wanted
    # A tie of all languages is a rejection.
    tied = [r for r in got if r.margin == 0]
    assert tied and all(r.rejected for r in tied)


def test_language_reads_no_label_and_learns_nothing_from_nothing(spark):
    rows = [(i, f"abc def {i} ghi", "aa" if i % 2 else "bb") for i in range(20)]
    learned = language.learn(labelled(spark, rows))
    changed = [(i, t, "zz") for i, t, _ in rows]
    assert language.identify(labelled(spark, rows), learned).collect() == language.identify(labelled(spark, changed), learned).collect()
    assert language.learn(labelled(spark, [])) == {}
    assert language.learn(labelled(spark, [(1, "123", "aa"), (2, None, "bb"), (None, "abc", "cc"), (3, "abc", None)])) == {}
    assert {r.lang_pred for r in language.identify(labelled(spark, rows), {}).collect()} == {"und"}
    assert language.identify(labelled(spark, []), learned).count() == 0
    only = language.identify(labelled(spark, rows), {"aa": b" abc def "}).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in only} == {("aa", 1.0, False)}
    assert len(language.learn(labelled(spark, rows), languages=1)) == 1


def test_dictionary_shares():
    assert language.filled(["aaaa", "bbbbbbbbbbbbbbbbbbbb", "cccccccccccccccccccc", "1 2", "aaaa"], 26) == b" ccccccccc bbbbbbbbb aaaa "
    assert language.filled(["ab"], 100) == b" ab " and language.filled([], 10) == b"" and len(language.filled(["x" * 50] * 3, 10)) == 10


# --- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, score string, row int, tile int"


def brute_negatives(rows, every=100, positives=5, negatives=10, low=30, high=90):
    own = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab, n) for n, (i, v, lab) in enumerate(rows) if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for anchor, a, lab, at in own:
        if anchor is None or anchor % every:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a, b)), i, other, n) for i, b, other, n in own if n != at), key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[3]))
        for ps, positive, _, _ in [x for x in scored if x[2] == lab][:positives]:
            near = [x for x in scored if x[2] != lab and low * ps <= 100 * x[0] <= high * ps][:negatives]
            for rank, (ns, negative, _, _) in enumerate(near, 1):
                out[anchor, positive, rank, negative, ps, ns] += 1
    return out


def vectors(seed, count, width, labels):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(0.1, 0.2, width).astype(np.float32)], int(rng.integers(labels))) for i in range(count)]


def odd_vectors():
    nan, inf = float("nan"), float("inf")
    zero, same = [0.0] * 8, [0.25, 0.25] + [0.0] * 6
    rows = [(1000, None, 1), (1100, [1.0, None], 1), (1200, [nan], 1), (1300, [inf, 1.0], 1), (1400, [1.0] * 8, None), (None, same, 1), (None, same, 2)]
    rows += [(1500, zero, 1), (1501, zero, 1), (1499, zero, 2), (1502, zero, 2), (1600, [], 1), (1700, [0.5] * 3, 1)]
    rows += [(-100, same, 1), (-100, same, 1), (-100, [0.5] * 8, 2), *[(2000 + i, same, i % 2) for i in range(40)]]
    return rows


@pytest.mark.parametrize("tile", [7, 1024])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, tile):
    rows = vectors(1, 260, 8, 4) + odd_vectors()
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame([(i, v, lab, "x", 1, 2) for i, v, lab in rows], VECTORS)
    monkeypatch.setattr(negatives, "TILE_ROWS", 10 * tile)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", tile)
    got = negatives.hard_negatives(frame, every=20)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert Counter(tuple(r) for r in got.collect()) == brute_negatives(rows, every=20)


def test_hard_negatives_without_rows(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(frame).count() == 0
    alone = spark.createDataFrame([(100, [1.0], 1, "", 0, 0), (200, [1.0], 2, "", 0, 0)], VECTORS)
    assert negatives.hard_negatives(alone).count() == 0


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for size in (100, 2**27, 2**40):
        a, b = rng.integers(-size, size, (5, 6)), rng.integers(-size, size, (4, 6))
        exact = np.clip(a.astype(object) @ b.astype(object).T, -(2**63), 2**63 - 1)
        assert (negatives.products(a, b) == exact).all()
    assert negatives.bounds(7, 30, 90) == (3, 6) and negatives.bounds(0, 30, 90) == (0, 0)
    least, most = negatives.bounds(-10, 30, 90)
    assert least > most


def test_keys_sort_by_anchor_score_and_id():
    rows = [(a, a + 1000, s, f, i) for a in (-5, 0, 7) for s in (2**62, 3, 0, -1, -(2**63)) for f in (0, 1) for i in (-2, 0, 9, None)]
    columns = [np.array([r[k] for r in rows]) for k in range(4)]
    null = np.array([r[4] is None for r in rows])
    ids = np.array([r[4] or 0 for r in rows])
    keys = [bytes(x) for x in negatives.packed(*columns[:3], 0, ids, null, np.arange(len(rows)))]
    flagged = [k[:24] + bytes([r[3]]) + k[25:] for k, r in zip(keys, rows, strict=True)]
    order = sorted(range(len(rows)), key=lambda n: flagged[n])
    assert order == sorted(range(len(rows)), key=lambda n: (rows[n][0], -rows[n][2], rows[n][3], rows[n][4] is None, rows[n][4] or 0))
    assert [negatives._number(k, "anchor") - 2**63 for k in keys] == [r[0] for r in rows]
    assert [2**63 - 1 - negatives._number(k, "score") for k in keys] == [r[2] for r in rows]
