"""Zip archives as Spark jobs: list, hash, list members, read members.

No task ever holds a whole archive. Hashing streams it, listing reads its directory, once, and notes where each member
is stored. The members of one archive are spread over many tasks by their size, so one archive may hold any share of
all data; a task goes straight to its members and never sees the directory.
"""

from __future__ import annotations

import csv
import hashlib
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.functions import identity
from scorebook.session import materialise

CHUNK = 1 << 20
BATCH_BYTES = 32 << 20
TASK_BYTES = 128 << 20

_HASHED = pa.schema([
    ("zip_path", pa.string()),
    ("zip_size_bytes", pa.int64()),
    ("zip_modified_at", pa.timestamp("us", tz="UTC")),
    ("zip_sha256", pa.string()),
    ("error_class", pa.string()),
    ("error_message", pa.string()),
])
_HASHED_DDL = "zip_path string, zip_size_bytes bigint, zip_modified_at timestamp, zip_sha256 string, error_class string, error_message string"
_LISTED = pa.schema([
    ("zip_path", pa.string()),
    ("zip_sha256", pa.string()),
    ("member_index", pa.int64()),
    ("member", pa.string()),
    ("file_size_bytes", pa.int64()),
    ("file_crc", pa.int64()),
    ("bytes_before", pa.int64()),
    ("stored_at", pa.int64()),
    ("stored_bytes", pa.int64()),
    ("compression", pa.int32()),
    ("flags", pa.int32()),
    ("error_class", pa.string()),
    ("error_message", pa.string()),
])
_LISTED_DDL = (
    "zip_path string, zip_sha256 string, member_index bigint, member string, file_size_bytes bigint, "
    "file_crc bigint, bytes_before bigint, stored_at bigint, stored_bytes bigint, compression int, flags int, error_class string, error_message string"
)
_READ_DDL = _LISTED_DDL + ", content binary"
_READ = _LISTED.append(pa.field("content", pa.binary()))

_STORED = ("bytes_before", "stored_at", "stored_bytes", "compression", "flags")

_FAULTS = (OSError, RuntimeError, ValueError, EOFError, NotImplementedError, zipfile.BadZipFile, zlib.error)

# Fixed values of the archive format: signature and length of the header before a member, and the flag of an encrypted one.
_SIGNATURE, _HEADER, _ENCRYPTED = b"PK\x03\x04", 30, 1


def _open(path: str):
    """Random-access reader for a local path or any file system Arrow knows."""
    if path.startswith(("file:", "/")):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return filesystem.open_input_file(inner)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size and time of every zip below ``folder``; contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{zip,ZIP}")
        .load(folder)
    )
    return found.select(
        F.col("path").alias("zip_path"),
        F.col("length").alias("zip_size_bytes"),
        F.col("modificationTime").alias("zip_modified_at"),
    )


def _hash_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            digest, fault = hashlib.sha256(), None
            try:
                with _open(row["zip_path"]) as handle:
                    while chunk := handle.read(CHUNK):
                        digest.update(chunk)
            except _FAULTS as error:
                fault = error
            row["zip_sha256"] = None if fault else digest.hexdigest()
            row["error_class"] = type(fault).__name__ if fault else None
            row["error_message"] = str(fault) if fault else None
            yield pa.RecordBatch.from_pylist([row], schema=_HASHED)


def hash_archives(archives: DataFrame) -> DataFrame:
    """Add the SHA-256 of each archive, read as a stream of 1 MiB pieces.

    The file scan already packs archives into tasks by their size; an exchange here would only see tiny
    listing rows and could merge them into one task.
    """
    return archives.mapInArrow(_hash_files, _HASHED_DDL)


def skip_processed(archives: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add ``status``: skip content extracted before, and second copies of content in this batch."""
    known = manifest.where(F.col("status") == "extracted").select("zip_sha256").distinct()
    first = archives.groupBy("zip_sha256").agg(F.min("zip_path").alias("_first"))
    marked = (
        archives.join(known.withColumn("_known", F.lit(True)), "zip_sha256", "left")
        .join(first, "zip_sha256", "left")
    )
    repeated = F.col("_known").isNotNull() | (F.col("zip_path") != F.col("_first"))
    status = (
        F.when(F.col("zip_sha256").isNull(), "failed")
        .when(repeated, "skipped_already_processed")
        .otherwise("pending")
    )
    return marked.withColumn("status", status).drop("_known", "_first")


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            blank = {"zip_path": row["zip_path"], "zip_sha256": row["zip_sha256"], "error_class": None, "error_message": None}
            try:
                with _open(row["zip_path"]) as handle, zipfile.ZipFile(handle) as archive:
                    rows, before = [], 0
                    for index, info in enumerate(archive.infolist()):
                        if info.is_dir():
                            continue
                        rows.append({
                            **blank,
                            "member_index": index,
                            "member": info.filename,
                            "file_size_bytes": info.file_size,
                            "file_crc": info.CRC,
                            "bytes_before": before,
                            "stored_at": info.header_offset,
                            "stored_bytes": info.compress_size,
                            "compression": info.compress_type,
                            "flags": info.flag_bits,
                        })
                        before += info.file_size
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_LISTED)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_LISTED)
            except _FAULTS as error:
                fault = {**blank, "error_class": type(error).__name__, "error_message": str(error)}
                yield pa.RecordBatch.from_pylist([fault], schema=_LISTED)


def list_members(archives: DataFrame) -> DataFrame:
    """One row per archive entry with its size, CRC and the bytes stored before it."""
    spread = archives.select("zip_path", "zip_sha256").repartition(_width(archives.sparkSession), "zip_path")
    return spread.mapInArrow(_list_members, _LISTED_DDL)


def _width(spark: SparkSession, total_bytes: int = 0, task_bytes: int = TASK_BYTES) -> int:
    """Task count for work that is large although its input rows are small.

    A stated count also keeps adaptive execution from merging such rows into few tasks.
    """
    return max(spark.sparkContext.defaultParallelism, -(-total_bytes // task_bytes))


def _read_member(handle, row: dict) -> bytes:
    """Content of one member from where it is stored; reading to the end checks its CRC."""
    if row["flags"] & _ENCRYPTED:
        raise RuntimeError(f"{row['member']} is encrypted")
    handle.seek(row["stored_at"])
    header = handle.read(_HEADER)
    if len(header) < _HEADER or not header.startswith(_SIGNATURE):
        raise zipfile.BadZipFile(f"no member at byte {row['stored_at']}")
    handle.seek(row["stored_at"] + _HEADER + sum(struct.unpack("<HH", header[26:30])))
    info = zipfile.ZipInfo(row["member"])
    info.compress_type, info.compress_size, info.file_size, info.CRC = (row[c] for c in ("compression", "stored_bytes", "file_size_bytes", "file_crc"))
    with zipfile.ZipExtFile(handle, "r", info) as member:
        content = member.read()
    if len(content) != row["file_size_bytes"]:
        raise zipfile.BadZipFile(f"{row['member']} ends early")
    return content


def _read_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    handle = opened = None
    rows: list = []
    held = 0
    try:
        for batch in batches:
            for row in batch.to_pylist():
                row["content"] = None
                try:
                    if row["zip_path"] != opened:
                        if handle is not None:
                            handle.close()
                        handle = opened = None
                        handle = _open(row["zip_path"])
                        opened = row["zip_path"]
                    row["content"] = _read_member(handle, row)
                except _FAULTS as error:
                    row["error_class"], row["error_message"] = type(error).__name__, str(error)
                rows.append(row)
                held += len(row["content"] or b"")
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_READ)
    finally:
        if handle is not None:
            handle.close()


def read_members(members: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Add ``content``. Runs of about ``task_bytes`` of one archive form one unit of work."""
    columns = [field.name for field in _LISTED]
    total = members.agg(F.sum("file_size_bytes")).first()[0] or 0
    width = _width(members.sparkSession, total, task_bytes)
    piece = F.floor(F.col("bytes_before") / task_bytes)
    spread = members.select(*columns, piece.alias("_piece")).repartition(width, "zip_path", "_piece")
    ordered = spread.sortWithinPartitions("zip_path", "member_index").select(*columns)
    return ordered.mapInArrow(_read_members, _READ_DDL)


def explode_archives(archives: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Wanted members of the given archives with content and status.

    Members whose path would leave the archive are kept as ``invalid`` rows without being read, broken
    members and unreadable archives as ``failed`` rows.
    """
    wanted = F.col("error_class").isNotNull() | identity.is_wanted_member(F.col("member"))
    listed = materialise(list_members(archives).where(wanted), "listing")
    readable = F.col("error_class").isNull() & identity.member_is_safe(F.col("member"))
    read = read_members(listed.where(readable), task_bytes)
    refused = listed.where(~F.coalesce(readable, F.lit(False))).withColumn("content", F.lit(None).cast("binary"))
    status = (
        F.when(F.col("error_class").isNotNull(), "failed")
        .when(F.col("content").isNull(), "invalid")
        .otherwise("extracted")
    )
    cleaned = identity.clean_member(F.col("member"))
    return (
        read.unionByName(refused)
        .withColumns({
            "extraction_status": status,
            "relative_member_path": F.when(status == "extracted", cleaned),
            "source_filename": identity.file_name(cleaned),
            "file_extension": identity.file_extension(cleaned),
            "file_sha256": F.sha2("content", 256),
        })
        .drop(*_STORED)
    )


def name_versions(members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Add ``final_name``: other content under a name already taken gets a hash suffix.

    ``known`` holds ``(source_filename, file_sha256)`` of earlier runs; its content keeps the plain name.
    The first content per name is one aggregate value, so a name shared by many members is no hot group.
    """
    rows = members.where(F.col("file_sha256").isNotNull()).select(
        "source_filename", F.struct(F.lit(1).alias("age"), "zip_path", "member_index", "file_sha256").alias("seen")
    )
    if known is not None:
        older = known.select(
            "source_filename",
            F.struct(
                F.lit(0).alias("age"), F.lit("").alias("zip_path"), F.lit(0).cast("bigint").alias("member_index"), "file_sha256"
            ).alias("seen"),
        )
        rows = rows.unionByName(older)
    first = rows.groupBy("source_filename").agg(F.min("seen")["file_sha256"].alias("_first"))
    name = identity.versioned_name(F.col("source_filename"), F.col("file_sha256"), F.col("_first"))
    return members.join(first, "source_filename", "left").withColumn("final_name", name).drop("_first")


def member_documents(members: DataFrame) -> DataFrame:
    """Match documents among the extracted members, in the form ``shape_raw`` takes."""
    wanted = members.where((F.col("extraction_status") == "extracted") & (F.col("file_extension") == ".json"))
    return wanted.select(
        F.concat_ws("/", "zip_path", "relative_member_path").alias("source_path"),
        F.col("content").cast("string").alias("raw_json"),
        "zip_path",
        "zip_sha256",
        "file_sha256",
        F.col("source_filename").alias("match_id_candidate"),
    )


_ROWS = pa.schema([("source_path", pa.string()), ("zip_path", pa.string()), ("entries", pa.map_(pa.string(), pa.string()))])
_ROWS_DDL = "source_path string, zip_path string, entries map<string,string>"


def _register_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, archive, content in zip(*(batch.column(i) for i in range(3)), strict=True):
            lines = io.TextIOWrapper(io.BytesIO(content.as_py()), "utf-8-sig", "replace", newline="")
            header, rows = None, []
            for values in csv.reader(lines, quoting=csv.QUOTE_NOTNULL):
                if not values:
                    continue
                if header is None:
                    header = [name or "" for name in values]
                    continue
                entries = dict(zip(header, values, strict=False))
                rows.append({"source_path": path.as_py(), "zip_path": archive.as_py(), "entries": list(entries.items())})
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)


def register_rows(members: DataFrame, name: str) -> DataFrame:
    """Rows of the extracted register files called ``name``: ``source_path``, ``zip_path`` and ``entries`` by column name.

    Every file has a header of its own. Quotes are doubled inside quoted values, which may hold line breaks; an empty
    value without quotes is NULL, and a short row lacks its last columns.
    """
    wanted = members.where((F.col("extraction_status") == "extracted") & (F.col("source_filename") == name))
    return wanted.select(F.concat_ws("/", "zip_path", "relative_member_path").alias("source_path"), "zip_path", "content").mapInArrow(_register_rows, _ROWS_DDL)


def register_table(rows: DataFrame, name: str) -> DataFrame:
    """Register rows with a column for each name that any header has, and ``source_file``; all columns are text.

    The rows are written first, as their headers decide the columns. Only these names go to the driver.
    """
    held = materialise(rows, "register")
    columns = sorted(row[0] for row in held.select(F.explode(F.map_keys("entries"))).distinct().collect())
    return held.select(*[F.try_element_at("entries", F.lit(c)).alias(c) for c in columns], F.lit(name).alias("source_file"))


def newest_register(members: DataFrame, archives: DataFrame, name: str) -> DataFrame | None:
    """The register file called ``name`` of the archive written last (``zip_path``, ``zip_modified_at``), if any has one."""
    files = members.where((F.col("extraction_status") == "extracted") & (F.col("source_filename") == name))
    found = files.join(archives.select("zip_path", "zip_modified_at"), "zip_path").select(
        F.max(F.struct("zip_modified_at", "zip_path", "relative_member_path")).alias("last")
    )
    last = found.first()["last"]
    if last is None:
        return None
    chosen = members.where((F.col("zip_path") == last["zip_path"]) & (F.col("relative_member_path") == last["relative_member_path"]))
    return register_table(register_rows(chosen, name), name)
