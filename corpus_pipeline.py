"""From raw documents to packed training sequences: five stages, each one operator over all the previous one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm import line_dedup, mixing, near_dedup, packing, quality
from scorebook.llm.common import WORD, Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the current policy, as they are; columns other than those of documents are dropped."""
    return quality.keep_good(docs.select(*COLUMNS))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents stay in the largest id only; ``n_chars`` follows the text, no document goes, other columns do."""
    cut = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): the smallest id, then the smallest hash of a text.

    Exactly one row of a group stays, also if rows repeat an id, or id and text, or have no id; of rows equal in both, the one
    with the smallest other columns. Texts without words are in no group, and all their rows stay. Columns other than those
    of documents are dropped.
    """
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    keys = lambda: [F.xxhash64(F.lit(i), F.col("doc_id").isNull(), "doc_id", "mark").alias(f"k{i}") for i in (1, 2)]
    found = near_dedup.near_duplicates(docs.select(*COLUMNS)).filter("component IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("kept")
    chosen = found.groupBy("component").agg(first).select("kept.doc_id", "kept.mark").select(*keys())
    # Equal rows meet before they are dealt out, so that one repeated row is no hot key.
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    own = docs.select(*COLUMNS).filter(worded).withColumn("mark", mark).select(*keys(), F.struct(*COLUMNS).alias("row"))
    one_each = own.groupBy("k1", "k2").agg(F.min("row").alias("row"))
    grouped = one_each.join(chosen.hint("shuffle_hash"), ["k1", "k2"], "left_semi").select("row.*")
    return grouped.unionByName(docs.select(*COLUMNS).filter(~worded))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their weights, with the columns of documents."""
    return mixing.mix(docs.select(*COLUMNS))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per bin with the documents in it."""
    return packing.bins(packing.pack(docs.select(*COLUMNS)))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("mix_sources", source_mix),
    ("best_fit_packing", sequence_packing),
]

#: Greedy packing and the search for near duplicates have no SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        done = scratch.keep(stage(spark, docs, sf_dir), name)
        if hasattr(docs, "_scratch_path"):
            scratch.drop(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
