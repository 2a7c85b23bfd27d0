"""Parquet tables in one folder, as snapshots: load, replace, append, replace partitions, compact, expire."""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters Spark writes as %XX in partition folder names.
_ESCAPED = frozenset("\"#%'*/:=?\\{[]^") | {chr(code) for code in range(32)} | {"\x7f"}
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

#: Outermost folder of a change; Spark reads it as one more partition column, which is left out again.
CHANGE = "lake_change"


def partition_folder(values: Mapping[str, object]) -> str:
    """Relative folder of one partition."""
    def shown(value: object) -> str:
        text = _NULL_PARTITION if value is None or value == "" else str(value)
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)

    return "/".join(f"{name}={shown(value)}" for name, value in values.items())


def ensure_columns(df: DataFrame, wanted: Mapping[str, str | Column]) -> DataFrame:
    """Add absent columns, comparing names without case: a type gives NULL, an expression its value."""
    present = {name.lower() for name in df.columns}
    absent = {
        name: F.lit(None).cast(kind) if isinstance(kind, str) else kind
        for name, kind in wanted.items()
        if name.lower() not in present
    }
    return df.withColumns(absent) if absent else df


def empty_table(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """No rows of the given shape, planned without any Python process."""
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in shape])


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: its shape, and the folders below the table's own that hold its rows.

    A folder is one partition as one change wrote it, and is never written again.
    """

    number: int
    schema: T.StructType
    by: tuple[str, ...]
    parts: tuple[str, ...]
    made_at: float

    def to_json(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "by": self.by, "parts": self.parts, "made_at": self.made_at})

    @staticmethod
    def from_json(number: int, text: str) -> Snapshot:
        known = json.loads(text)
        return Snapshot(number, T.StructType.fromJson(known["schema"]), tuple(known["by"]), tuple(known["parts"]), known["made_at"])


def _partition(part: str) -> str:
    """The partition a folder belongs to: its path without the change that wrote it."""
    return part.partition("/")[2]


@dataclass
class Lake:
    """Named parquet tables below ``root``; ``prefix`` separates variants of the same table set.

    A change writes folders of its own and then one small file, the next snapshot, which lists the folders of the whole
    table. That file appears by a rename, so readers see the table before or after a change and never in between, and
    a change that breaks off leaves the table as it was. Earlier snapshots stay readable until ``expire`` removes them.
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    # ------------------------------------------------------------ reading

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix}{name}"

    def exists(self, name: str) -> bool:
        return bool(self._numbers(name))

    def snapshot(self, name: str, number: int | None = None) -> Snapshot | None:
        """The newest snapshot, or the one with this number."""
        found = self._numbers(name)
        if not found or (number is not None and number not in found):
            return None
        wanted = found[-1] if number is None else number
        return Snapshot.from_json(wanted, self._read(self._file(name, wanted)))

    def snapshots(self, name: str) -> list[int]:
        """Numbers of the snapshots that can be read, oldest first."""
        return self._numbers(name)

    def load(self, name: str, schema: str | T.StructType | None = None, number: int | None = None) -> DataFrame:
        """Read a table, or an earlier snapshot of it, with its declared or stored schema.

        No footer is read to infer anything, columns absent in older files come back as NULL, an empty
        table is readable, and text partition values such as '2024' stay text. What was loaded stays as it was when
        the table changes.
        """
        found = self.snapshot(name, number)
        if found is None:
            raise ValueError(f"no table {name} in {self.root}" if number is None else f"no snapshot {number} of {name}")
        return self._rows(name, found, found.parts, schema)

    def load_or_empty(self, name: str, schema: str | T.StructType) -> DataFrame:
        if self.exists(name):
            return self.load(name, schema)
        return empty_table(self.spark, schema)

    def _rows(self, name: str, at: Snapshot, parts: Sequence[str], schema: str | T.StructType | None = None) -> DataFrame:
        shape = at.schema if schema is None else T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if not parts:
            return empty_table(self.spark, shape)
        base = self.path(name)
        rows = self.spark.read.schema(shape).option("basePath", base).parquet(*[f"{base}/{part}" for part in parts])
        return rows.select(*[F.col(f"`{field}`") for field in shape.fieldNames()])

    # ------------------------------------------------------------ changing

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Write the whole table anew."""
        before = self.snapshot(name)
        self._switch(name, before, df.schema, partition_by, self._write(name, df, partition_by))

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Add rows; new columns become part of the table."""
        before = self.snapshot(name)
        parts = self._write(name, df, partition_by)
        self._switch(name, before, _widened(before, df.schema), partition_by, [*(before.parts if before else ()), *parts])

    def replace_partitions(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str],
        touched: Sequence[Mapping[str, object]],
        reads_itself: bool = True,
    ) -> None:
        """Replace exactly the ``touched`` partitions by the rows of ``df``, in one step.

        ``df`` may read this table. A touched partition for which no row is left is empty afterwards. Rows outside the
        touched partitions are an error, and nothing changes; with ``reads_itself=False`` they are left out.
        """
        before = self.snapshot(name)
        parts = self._write(name, df if reads_itself else in_partitions(df, touched), partition_by)
        named = {partition_folder({c: values[c] for c in partition_by}) for values in touched}
        others = sorted({_partition(part) for part in parts} - named)
        if others:
            raise ValueError(f"rows outside the touched partitions of {name}: {others[:5]}")
        kept = [part for part in (before.parts if before else ()) if _partition(part) not in named]
        self._switch(name, before, _widened(before, df.schema), partition_by, [*kept, *parts])

    def compact(self, name: str, most: int = 32) -> int:
        """Rewrite partitions that lie in more than ``most`` folders as one each; returns how many there were.

        Appends leave a folder per partition and change; readers see the same rows before and after.
        """
        at = self.snapshot(name)
        held = Counter(map(_partition, at.parts)) if at else {}
        crowded = {partition for partition, n in held.items() if n > most}
        if crowded:
            parts = self._write(name, self._rows(name, at, [p for p in at.parts if _partition(p) in crowded]), at.by)
            self._switch(name, at, at.schema, at.by, [*[p for p in at.parts if _partition(p) not in crowded], *parts])
        return len(crowded)

    def expire(self, name: str, older_than: float) -> int:
        """Remove snapshots that were replaced more than ``older_than`` seconds ago, and folders that no snapshot lists.

        A folder of a change under way or broken off is in no snapshot; it goes once it is as old. Returns the
        number of snapshots removed.
        """
        numbers = self._numbers(name)
        if not numbers:
            return 0
        bar = time.time() - older_than
        known = {n: self.snapshot(name, n) for n in numbers}
        # A snapshot was replaced when the next one was made.
        gone = [n for n, after in zip(numbers, numbers[1:], strict=False) if known[after].made_at < bar]
        listed = {part.split("/")[0] for n in numbers if n not in gone for part in known[n].parts}
        files = self._files()
        for n in gone:
            files.delete(self._file(name, n), False)
        base = self._path(self.path(name))
        for status in files.listStatus(base) if files.exists(base) else ():
            if status.getPath().getName() not in listed and status.getModificationTime() / 1000 < bar:
                files.delete(status.getPath(), True)
        return len(gone)

    def tables(self) -> list[str]:
        """Names of the tables of this lake's prefix."""
        folder, files = self._path(f"{self.root.rstrip('/')}/_tables"), self._files()
        names = [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(n.removeprefix(self.prefix) for n in names if n.startswith(self.prefix))

    def _write(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> list[str]:
        """Write rows to a new folder of the table; returns the folder of each partition in it."""
        change = f"{CHANGE}={uuid.uuid4().hex}"
        self._writer(df, partition_by).mode("errorifexists").option("compression", "zstd").parquet(f"{self.path(name)}/{change}")
        if not partition_by:
            return [change]
        files, found = self._files(), [change]
        for _ in partition_by:
            below = [(part, files.listStatus(self._path(self.path(name) + "/" + part))) for part in found]
            found = [f"{part}/{s.getPath().getName()}" for part, listed in below for s in listed if s.isDirectory()]
        return sorted(found)

    def _switch(self, name: str, before: Snapshot | None, schema: T.StructType, by: Sequence[str], parts: Sequence[str]) -> None:
        """Make the next snapshot; fails if another change has made it meanwhile."""
        if before is not None and before.parts and tuple(by) != before.by and any(p in before.parts for p in parts):
            raise ValueError(f"{name} is partitioned by {before.by}, not by {tuple(by)}")
        after = Snapshot((before.number if before else 0) + 1, schema, tuple(by), tuple(parts), time.time())
        files, target = self._files(), self._file(name, after.number)
        fresh = self._path(f"{self.root.rstrip('/')}/_written/{uuid.uuid4().hex}")
        stream = files.create(fresh, False)
        try:
            stream.write(bytearray(after.to_json().encode()))
        finally:
            stream.close()
        files.mkdirs(target.getParent())
        if files.exists(target) or not files.rename(fresh, target):
            files.delete(fresh, False)
            raise OSError(f"{name} was changed by another run")

    # ------------------------------------------------------------ files

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, name: str, number: int):
        return self._path(f"{self.root.rstrip('/')}/_tables/{self.prefix}{name}/{number:012d}.json")

    def _numbers(self, name: str) -> list[int]:
        files, folder = self._files(), self._file(name, 0).getParent()
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def _read(self, path) -> str:
        stream = self._files().open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _writer(self, df: DataFrame, partition_by: Sequence[str]):
        """Rebalanced by partition: no task-by-partition file explosion, and a large one is split."""
        if not partition_by:
            return df.write
        return df.hint("rebalance", *[F.col(c) for c in partition_by]).write.partitionBy(*partition_by)


def _widened(before: Snapshot | None, schema: T.StructType) -> T.StructType:
    """The table's columns, followed by those it does not have yet; names are compared without case."""
    known = list(before.schema.fields) if before else []
    have = {field.name.lower() for field in known}
    return T.StructType(known + [field for field in schema.fields if field.name.lower() not in have])


def listed_partitions(partitions: DataFrame) -> list[dict[str, object]]:
    """Partition values for the driver, which lists the folders of a table to plan its scan anyway."""
    return [row.asDict() for row in partitions.collect()]


def in_partitions(df: DataFrame, touched: Sequence[Mapping[str, object]]) -> DataFrame:
    """Restrict a table to listed partitions with literals, so that the scan prunes folders."""
    return df.where(_listed(touched))


def outside_partitions(df: DataFrame, touched: Sequence[Mapping[str, object]]) -> DataFrame:
    """The other rows; a NULL partition value counts as a value."""
    return df.where(~F.coalesce(_listed(touched), F.lit(False)))


def _listed(touched: Sequence[Mapping[str, object]]) -> Column:
    if not touched:
        return F.lit(False)
    *outer, last = list(touched[0])
    grouped: dict[tuple, set] = {}
    for values in touched:
        grouped.setdefault(tuple(values[name] for name in outer), set()).add(values[last])
    test = F.lit(False)
    for fixed, lasts in grouped.items():
        inner = _one_of(last, lasts)
        for name, value in zip(outer, fixed, strict=True):
            inner = _one_of(name, {value}) & inner
        test = test | inner
    return test


def _one_of(name: str, values: set) -> Column:
    known = sorted(v for v in values if v is not None)
    test = F.col(name).isin(*known) if known else F.lit(False)
    return (test | F.col(name).isNull()) if None in values else test
