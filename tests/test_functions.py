from __future__ import annotations

import hashlib
import json
import re

from helpers import dicts, match
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorebook.functions import identity, names, rules


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def values(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}").orderBy("i").select(column).collect()]


def extras_of(**fields):
    every = ("wides", "noballs", "byes", "legbyes", "penalty")
    return F.struct(*[F.lit(fields.get(name)).cast("int").alias(name) for name in every])


def test_legal_ball(spark):
    cases = [extras_of(wides=0, noballs=0), extras_of(wides=1, noballs=0), extras_of(wides=0, noballs=1), extras_of(byes=2), F.lit(None).cast("struct<wides:int,noballs:int>")]
    assert list(one(spark, *[rules.is_legal_ball(case) for case in cases])) == [True, False, False, True, True]


def test_runs_charged(spark):
    assert one(spark, rules.runs_charged(F.lit(5), extras_of(byes=1)))[0] == 4
    assert one(spark, rules.runs_charged(F.lit(9), extras_of(wides=1, legbyes=2, penalty=5)))[0] == 2


def test_wicket_credit(spark):
    kinds = [("caught",), ("run out",), ("Run Out",), ("retired hurt",), ("retired out",), ("obstructing the field",), (None,), ("bowled",)]
    got = values(spark, kinds, "kind string", rules.credits_bowler(F.col("kind")))
    assert got == [True, False, False, False, False, False, False, True]


def test_revision_classes(spark):
    rows = [(4, "aa", 7, "bb"), (5, "cc", 5, "cc"), (None, None, 3, "dd"), (3, "", 3, "dd"), (9, "aa", 8, "bb"), (8, "aa", 8, "bb"), (None, "aa", 6, "bb"), (6, "aa", None, "bb"), (7, "cc", 5, "cc")]
    column = rules.classify_revision(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    got = values(spark, rows, "a int, b string, c int, d string", column)
    assert got == ["revised", "unchanged", "new", "new", "older", "revised", "revised", "revised", "unchanged"]


def test_rate_without_balls_is_null(spark):
    got = values(spark, [(7, 3), (7, 0), (1, 8)], "n bigint, d bigint", rules.rate(F.col("n"), 100, F.col("d")))
    assert got == [233.33, None, 12.5]


def test_league_groups(spark):
    rows = [("Indian Premier League",), ("Women's BIG BASH League",), ("The Hundred Men's Competition",), ("County",), (None,)]
    assert values(spark, rows, "n string", names.bucket_by_rules(F.col("n"))) == ["IPL", "Big Bash", "The Hundred", "County", None]


def test_competition_bucket(spark):
    focus = ["Indian Premier League", "The Hundred", "Premier"]
    rows = [("Indian Premier League 2025",), ("the hundred, men's",), ("Premier",), ("",), (None,), ("Cup",), ("Hundred",)]
    got = values(spark, rows, "n string", names.competition_bucket(F.col("n"), focus))
    assert [tuple(value) for value in got] == [
        ("Indian Premier League", True), ("The Hundred", True), ("Indian Premier League", True), ("Unknown", False),
        ("Unknown", False), ("Cup", False), ("The Hundred", True),
    ]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=20))
def test_normalise_name(spark, texts):
    got = values(spark, [(text,) for text in texts], "n string", names.normalise_name(F.col("n")))
    assert got == [re.sub(r"[^a-z0-9]+", " ", text.lower()).strip() for text in texts]


def test_config_list(spark):
    rows = [(" a, ,b,",), (",",), (None,), ("one name",)]
    assert values(spark, rows, "n string", names.config_list(F.col("n"))) == [["a", "b"], [], [], ["one name"]]


def test_stable_id(spark):
    document = match(teams=("Zed", "Alpha"))
    event = {"name": "Indian Premier League", "match_number": 1, "group": None, "extra": {"b": 1, "a": [2, "x"]}}
    document["info"]["event"] = event
    attributes = {
        "dates": ["2024-04-01"], "event": event, "teams": ["Alpha", "Zed"], "venue": "Ground", "city": "Town", "data_version": "1.1.0",
    }
    text = json.dumps(attributes, sort_keys=True, separators=(",", ":"))
    wanted = "fallback_" + hashlib.sha256(text.encode()).hexdigest()[:32]
    bare = json.dumps({"info": {"teams": ["A", "B"]}})
    blank = json.dumps({"city": None, "data_version": None, "dates": None, "event": None, "teams": ["A", "B"], "venue": None}, sort_keys=True, separators=(",", ":"))
    rows = [("/x/829765.json", json.dumps(document)), ("/x/final.json", json.dumps(document)), (None, bare), ("/x/12a.json", "{"), ("/x/12a.json", "not json")]
    got = values(spark, rows, "p string, j string", identity.stable_id(F.col("j"), F.col("p")))
    assert tuple(got[0]) == ("829765", "filename_stem")
    assert tuple(got[1]) == (wanted, "canonical_sha256")
    assert tuple(got[2]) == ("fallback_" + hashlib.sha256(blank.encode()).hexdigest()[:32], "canonical_sha256")
    assert all(value["match_id"].startswith("fallback_") for value in got[3:])


def test_paths(spark):
    rows = [("file:/a/b.json",), ("file:///a/b.JSON",), ("hdfs://host:1/a/b.tar.gz",), ("/a/b",)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, p string")
    path = F.col("p")
    got = dicts(df.select("i", identity.strip_scheme(path).alias("s"), identity.file_stem(path).alias("t"), identity.file_extension(path).alias("e")), "i")
    assert [(row["s"], row["t"], row["e"]) for row in got] == [
        ("/a/b.json", "b", ".json"), ("/a/b.JSON", "b", ".json"), ("/a/b.tar.gz", "b.tar", ".gz"), ("/a/b", "b", ""),
    ]


def test_member_safety(spark):
    import posixpath

    members = ["a.json", "x/../b.csv", "../evil.json", "/abs.json", "x/../../evil.json", "n.txt", "A.JSON", "d\\e\\f.json", "./g.json", "..", "", "../../a/../b.json", "x//y.json", "..json"]
    got = values(spark, [(m,) for m in members], "m string", F.struct(identity.member_is_safe(F.col("m")).alias("ok"), identity.clean_member(F.col("m")).alias("p")))
    for member, (ok, path) in zip(members, got, strict=True):
        clean = posixpath.normpath(member.replace("\\", "/"))
        safe = not (clean in ("", ".", "..") or clean.startswith(("/", "../"))) and clean.lower().endswith((".json", ".csv"))
        assert ok == safe, member
        if safe:
            assert path == clean
