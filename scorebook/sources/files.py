"""File scans: whole documents, register files, manifest-driven selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.functions.identity import strip_scheme


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file: ``source_path`` and the complete text as ``raw_json``."""
    files = spark.read.format("text").option("wholetext", True).load(paths if isinstance(paths, str) else list(paths))
    return files.select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("raw_json"))


def read_register(spark: SparkSession, paths: str | Sequence[str], source_file: str) -> DataFrame:
    """Register CSV with a header; all columns are text, quotes are doubled inside quoted values."""
    table = spark.read.csv(paths if isinstance(paths, str) else list(paths), header=True, escape='"', multiLine=True)
    return table.withColumn("source_file", F.lit(source_file))


def select_inputs(manifest: DataFrame, run_id: str | None = None, extension: str = ".json") -> DataFrame:
    """Distinct paths of extracted files of one kind, of one run or of all."""
    kind = (F.col("file_extension") == extension) | F.col("source_filename").endswith(extension)
    chosen = manifest.where(kind & (F.col("extraction_status") == "extracted") & F.col("extracted_path").isNotNull())
    if run_id is not None:
        chosen = chosen.where(F.col("run_id") == run_id)
    return chosen.select("extracted_path").distinct()


def only_listed(documents: DataFrame, inputs: DataFrame) -> DataFrame:
    """Scanned documents whose path is listed; the list never leaves the executors."""
    listed = inputs.select(F.col("extracted_path").alias("_path"))
    keyed = documents.withColumn("_path", strip_scheme(F.col("source_path")))
    return keyed.join(listed, "_path", "left_semi").drop("_path")
