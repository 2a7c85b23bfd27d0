from __future__ import annotations

import hashlib
import json
import zipfile

import pyarrow as pa
import pytest
from helpers import dicts, match
from pyspark.sql import functions as F

from scorebook.operators import documents as docs
from scorebook.operators import runlog
from scorebook.sources import archives
from scorebook.sources.tables import in_partitions, partition_folder


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "zips" / "deep"
    folder.mkdir(parents=True)
    with zipfile.ZipFile(folder / "a.zip", "w") as z:
        z.writestr("data/101.json", json.dumps(match()))
        z.writestr("people.csv", "identifier\n1\n")
        z.writestr("../evil.json", "{}")
        z.writestr("/abs.json", "{}")
        z.writestr("notes.txt", "skip")
        z.writestr("other/101.json", json.dumps(match(revision=2)))
        z.mkdir("empty")
    with zipfile.ZipFile(folder / "b.ZIP", "w") as z:
        for n in range(50):
            z.writestr(f"{n}.json", json.dumps({"n": n}))
    (folder / "broken.zip").write_bytes(b"not an archive")
    (folder / "copy.zip").write_bytes((folder / "a.zip").read_bytes())
    return tmp_path / "zips"


def test_archive_members(spark, landing):
    found = archives.hash_archives(archives.list_archives(spark, str(landing))).persist()
    rows = {r["zip_path"].rsplit("/", 1)[1]: r for r in dicts(found)}
    assert set(rows) == {"a.zip", "b.ZIP", "broken.zip", "copy.zip"}
    assert rows["a.zip"]["zip_sha256"] == hashlib.sha256((landing / "deep/a.zip").read_bytes()).hexdigest()
    known = spark.createDataFrame([("extracted", rows["b.ZIP"]["zip_sha256"])], "status string, zip_sha256 string")
    status = {r["zip_path"].rsplit("/", 1)[1]: r["status"] for r in dicts(archives.skip_processed(found, known))}
    assert status == {"a.zip": "pending", "b.ZIP": "skipped_already_processed", "broken.zip": "pending", "copy.zip": "skipped_already_processed"}

    # A tiny task size spreads one archive over many tasks.
    members = archives.explode_archives(found.where("zip_path not like '%copy.zip'"), task_bytes=64).persist()
    got = {(r["zip_path"].rsplit("/", 1)[1], r["member"]): r for r in dicts(members)}
    good = got["a.zip", "data/101.json"]
    assert good["extraction_status"] == "extracted" and json.loads(good["content"]) == match()
    assert good["file_sha256"] == hashlib.sha256(json.dumps(match()).encode()).hexdigest()
    assert (good["source_filename"], good["file_extension"], good["relative_member_path"]) == ("101.json", ".json", "data/101.json")
    assert got["a.zip", "../evil.json"]["extraction_status"] == got["a.zip", "/abs.json"]["extraction_status"] == "invalid"
    assert got["broken.zip", None]["error_class"] == "BadZipFile"
    assert ("a.zip", "notes.txt") not in got
    assert sum(name == "b.ZIP" and r["extraction_status"] == "extracted" for (name, _), r in got.items()) == 50

    named = {r["member"]: r["final_name"] for r in dicts(archives.name_versions(members.where("zip_path like '%a.zip'")))}
    later = archives.name_versions(members.where("member = 'other/101.json'"), spark.createDataFrame([("101.json", "0" * 64)], "source_filename string, file_sha256 string"))
    assert named["data/101.json"] == "101.json" and named["other/101.json"].startswith("101__")
    assert dicts(later)[0]["final_name"] == named["other/101.json"]
    shaped = docs.shape_raw(docs.parse_documents(archives.member_documents(members)), "r")
    assert sorted(r["source_revision"] for r in dicts(shaped.where("match_id = '101'"))) == [1, 2]
    progress = {r["zip_path"].rsplit("/", 1)[1]: (r["processed_count"], r["total_count"], r["status"]) for r in dicts(runlog.archive_progress(members.where("extraction_status <> 'invalid'")))}
    assert progress == {"a.zip": (3, 3, "SUCCEEDED"), "b.ZIP": (50, 50, "SUCCEEDED"), "broken.zip": (0, 1, "FAILED")}


def test_damaged_member(spark, tmp_path):
    path = tmp_path / "bad.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("1.json", "A" * 100)
        z.writestr("2.json", "B" * 100)
    data = path.read_bytes().replace(b"A" * 100, b"A" * 99 + b"C")
    path.write_bytes(data)
    members = archives.explode_archives(archives.hash_archives(archives.list_archives(spark, str(tmp_path))))
    got = {r["member"]: (r["extraction_status"], r["error_class"]) for r in dicts(members)}
    assert got == {"1.json": ("failed", "BadZipFile"), "2.json": ("extracted", None)}


@pytest.mark.parametrize("compression", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_members_are_read_from_where_they_are_stored(tmp_path, monkeypatch, compression):
    """The directory is opened once, by the listing; data before the archive shifts all places."""
    path = tmp_path / "a.zip"
    bodies = {f"dir/{i}.json": ("é" * i + "x" * (1000 * i)).encode() for i in range(6)}
    with zipfile.ZipFile(path, "w", compression) as z:
        for name, body in bodies.items():
            z.writestr(name, body)
    path.write_bytes(b"some data before" + path.read_bytes())
    opened = []

    class Counted(zipfile.ZipFile):
        def __init__(self, *args, **kwargs):
            opened.append(args)
            super().__init__(*args, **kwargs)

    monkeypatch.setattr(archives.zipfile, "ZipFile", Counted)
    batch = pa.RecordBatch.from_pylist([{"zip_path": str(path), "zip_sha256": "h"}])
    listed = list(archives._list_members(iter([batch])))
    assert len(opened) == 1
    read = [row for part in archives._read_members(iter([listed[0].slice(3), listed[0].slice(0, 3)])) for row in part.to_pylist()]
    assert len(opened) == 1 and {r["member"]: r["content"] for r in read} == bodies and not any(r["error_class"] for r in read)
    faults = [{**row, **change} for row, change in zip(listed[0].to_pylist(), ({"flags": 1}, {"stored_at": 5}, {"stored_at": 10**9}, {"file_crc": 1}, {"file_size_bytes": 10**6}), strict=False)]
    broken = [row for part in archives._read_members(iter([pa.RecordBatch.from_pylist(faults[:3] + faults[3:5], schema=archives._LISTED)])) for row in part.to_pylist()]
    assert [r["error_class"] for r in broken] == ["RuntimeError", "BadZipFile", "BadZipFile", "BadZipFile", "BadZipFile"] and not any(r["content"] for r in broken)


def test_partition_folders():
    assert partition_folder({"season": "2007/08", "b": "0001"}) == "season=2007%2F08/b=0001"
    assert partition_folder({"season": None}) == "season=__HIVE_DEFAULT_PARTITION__"


def test_replace_partitions(spark, lake):
    rows = [("2024", "a", 1), ("2007/08", "a", 2), (None, "a", 3), ("2024", "b", 4)]
    lake.replace("t", spark.createDataFrame(rows, "season string, bucket string, v int"), ["season", "bucket"])
    table = lake.load("t")
    assert dict(table.dtypes)["season"] == "string"
    touched = [{"season": "2007/08", "bucket": "a"}, {"season": None, "bucket": "a"}, {"season": "2024", "bucket": "a"}]
    part = in_partitions(table, touched)
    assert sorted(r["v"] for r in part.collect()) == [1, 2, 3]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "season" in plan.split("PartitionFilters: [")[1].split("]")[0]
    lake.replace_partitions("t", part.where("v = 1").selectExpr("season", "bucket", "v * 10 as v"), ["season", "bucket"], touched)
    assert sorted((r["season"], r["bucket"], r["v"]) for r in lake.load("t").collect()) == [("2024", "a", 10), ("2024", "b", 4)]
    with pytest.raises(ValueError, match="outside the touched"):
        lake.replace_partitions("t", lake.load("t"), ["season", "bucket"], touched)
    assert in_partitions(table, []).count() == 0


def test_append_takes_new_columns(spark, lake):
    lake.append("log", spark.range(2))
    lake.append("log", spark.range(2, 3).selectExpr("id", "'x' as note"))
    assert [(r["id"], r["note"]) for r in dicts(lake.load("log"), "id")] == [(0, None), (1, None), (2, "x")]
    assert [(r["id"], r["note"]) for r in dicts(lake.load("log", "id bigint, note string"), "id")] == [(0, None), (1, None), (2, "x")]
    lake.replace("empty", spark.range(0).selectExpr("id", "'x' as season"), ["season"])
    assert lake.load("empty").count() == 0
    assert not lake.exists("nothing") and lake.load_or_empty("nothing", "a int").count() == 0


def test_prefix_keeps_table_sets_apart(spark, lake):
    from scorebook.sources.tables import Lake

    smoke = Lake(spark, lake.root, prefix="smoke_")
    smoke.replace("t", spark.range(1))
    assert smoke.path("t").endswith("/smoke_t") and smoke.exists("t") and not lake.exists("t")


@pytest.mark.parametrize("change", ["replace", "append", "replace_partitions", "compact"])
@pytest.mark.parametrize("broken", ["_writer", "_switch"])
def test_a_broken_change_leaves_the_table(spark, lake, monkeypatch, change, broken):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "part string, v int")
    lake.replace("t", rows, ["part"])
    lake.append("t", rows.where("v = 1"), ["part"])
    read = lambda: sorted((r["part"] or "", r["v"]) for r in lake.load("t").collect())
    before, numbers = read(), lake.snapshots("t")
    touched = [{"part": "a"}, {"part": "b"}, {"part": None}]
    after = lake.load("t").where("part in ('a', 'b')").selectExpr("'a' as part", "v * 10 as v")
    calls = {
        "replace": lambda: lake.replace("t", after, ["part"]),
        "append": lambda: lake.append("t", after.withColumn("more", F.lit(1)), ["part"]),
        "replace_partitions": lambda: lake.replace_partitions("t", after, ["part"], touched),
        "compact": lambda: lake.compact("t", 1),
    }
    with monkeypatch.context() as patch:
        patch.setattr(type(lake), broken, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            calls[change]()
    assert read() == before and lake.snapshots("t") == numbers and lake.load("t").columns == ["part", "v"]
    calls[change]()
    wanted = {
        "replace": [("a", 10), ("a", 10), ("a", 20)], "append": sorted([*before, ("a", 10), ("a", 10), ("a", 20)]),
        "replace_partitions": [("a", 10), ("a", 10), ("a", 20), ("c", 4)], "compact": before,
    }
    assert read() == wanted[change]
    lake.expire("t", -1)
    assert read() == wanted[change] and len(lake.snapshots("t")) == 1


def test_earlier_snapshots_stay_readable_until_they_expire(spark, lake, tmp_path):
    values = lambda **at: sorted(r["v"] for r in lake.load("t", **at).collect())
    lake.replace("t", spark.createDataFrame([("a", 1), ("b", 2)], "part string, v int"), ["part"])
    held = lake.load("t")
    lake.replace_partitions("t", spark.createDataFrame([("b", 3)], "part string, v int"), ["part"], [{"part": "b"}])
    lake.append("t", spark.createDataFrame([("b", 4, "x")], "part string, v int, note string"), ["part"])
    lake.replace_partitions("t", lake.load("t").where("false"), ["part"], [{"part": "a"}])
    assert lake.snapshots("t") == [1, 2, 3, 4] and sorted(r["v"] for r in held.collect()) == [1, 2]
    assert [values(number=n) for n in lake.snapshots("t")] == [[1, 2], [1, 3], [1, 3, 4], [3, 4]]
    assert lake.load("t", number=2).columns == ["part", "v"] and lake.load("t").columns == ["part", "v", "note"]
    assert lake.expire("t", 3600) == 0 and len(lake.snapshots("t")) == 4
    assert lake.expire("t", -1) == 3 and lake.snapshots("t") == [4] and values() == [3, 4]
    with pytest.raises(ValueError, match="no snapshot 1"):
        lake.load("t", number=1)
    # Only the folders that the last snapshot lists are left.
    assert len([f for f in (tmp_path / "lake" / "t").iterdir() if f.is_dir()]) == 2
    assert lake.tables() == ["t"]


def test_two_changes_of_one_snapshot_do_not_both_win(spark, lake, monkeypatch):
    from scorebook.sources.tables import Lake

    lake.replace("t", spark.range(1))
    write, other = Lake._write, Lake(spark, lake.root)

    def late(self, name, df, by):
        parts = write(self, name, df, by)
        if self is lake:
            other.append("t", spark.range(1, 2))
        return parts

    monkeypatch.setattr(Lake, "_write", late)
    with pytest.raises(OSError, match="another run"):
        lake.append("t", spark.range(5, 6))
    assert sorted(r["id"] for r in other.load("t").collect()) == [0, 1]


def test_compaction_after_appends(spark, lake):
    for i in range(5):
        lake.append("log", spark.range(i, i + 1))
        lake.append("t", spark.createDataFrame([("a", i), *([("b/c", i)] if i < 2 else [])], "part string, v int"), ["part"])
    assert len(lake.snapshot("log").parts) == 5 and len(lake.snapshot("t").parts) == 7
    assert lake.compact("log", 5) == 0 and lake.compact("log", 4) == 1 and lake.compact("t", 2) == 1
    assert len(lake.snapshot("log").parts) == 1 and len(lake.snapshot("t").parts) == 3
    assert sorted(r["id"] for r in lake.load("log").collect()) == list(range(5))
    assert sorted((r["part"], r["v"]) for r in lake.load("t").collect()) == [*[("a", i) for i in range(5)], ("b/c", 0), ("b/c", 1)]
    assert lake.compact("absent") == 0
