"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.session import shared_dir

#: White space of the contracts: space and the control characters tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"

#: A Python task receives whole texts up to this size at once, or a single longer one.
TEXT_BYTES = "8m"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once even if ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole(text: Column | str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def digest(*parts: Column | str) -> Column:
    """Hex key of 128 bits over columns; null and empty differ, and no two lists of values share an input."""
    pieces = []
    for part in parts:
        value = (F.col(part) if isinstance(part, str) else part).cast("string")
        pieces.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.md5(F.concat_ws(",", *pieces))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any case of letters."""
    taken = {name.lower() for name in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the bytes a Python worker receives at once, as texts may be very long; a session setting."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", TEXT_BYTES)
    return df


class Scratch:
    """Written hand-overs of one job in the shared folder; they survive the loss of any executor."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/scorebook/{label}-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and go on from the written table."""
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{label}"
        df.write.mode("errorifexists").parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        read._scratch_path = path
        return read

    def drop(self, *tables: DataFrame) -> None:
        """Remove hand-overs that nothing reads any more."""
        jvm = self.spark._jvm
        for kept in tables:
            path = jvm.org.apache.hadoop.fs.Path(kept._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
