"""File-source stream of arriving documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scorebook.plans.daily_run import Run, run_lake
from scorebook.sources.tables import Lake


#: Shape of the rows in files of documents; the last two are for texts that continue a match and may be absent.
ROWS = "source_path string, raw_json string, match_id_candidate string, part bigint"
LEDGER = "stream_log"
_LEDGER = "stream string, checkpoint string, batch_id bigint, run_id string, committed_at timestamp"


def stream_documents(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    max_files: int | None = None,
    form: str = "text",
) -> StreamingQuery:
    """Hand every file not seen before to ``handle(batch, batch_id)`` and stop when none is left.

    ``form`` ``text``: a file is a document. ``parquet``: a file holds many (``source_path``, ``raw_json``). A batch has at
    most ``max_files`` files. The checkpoint remembers the files. A batch may be handed over twice after a failure.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if form == "parquet":
        files = reader.schema(ROWS).parquet(folder)
    else:
        texts = reader.format("text").option("wholetext", True).load(folder)
        files = texts.select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("raw_json"))
    return (
        files.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_batch(lake: Lake, checkpoint: str, name: str, options: dict[str, object]) -> Callable[[DataFrame, int], None]:
    """What is done with a batch: the whole refresh, and then a row in the ledger.

    A batch that the ledger has for this checkpoint is done already and skipped. One whose run broke off before that row is
    run again under the same run id, which completes it.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        done = lake.load_or_empty(LEDGER, _LEDGER).where((F.col("stream") == name) & (F.col("checkpoint") == checkpoint) & (F.col("batch_id") == batch_id))
        if not done.isEmpty():
            return
        run_id = f"{name}-{batch_id}"
        run_lake(lake, Run(run_id=run_id, **options), batch)
        values = [F.lit(name).alias("stream"), F.lit(checkpoint).alias("checkpoint"), F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(run_id).alias("run_id")]
        lake.append(LEDGER, lake.spark.range(0, 1, 1, 1).select(*values, F.current_timestamp().alias("committed_at")))

    return handle


def ingest_stream(
    lake: Lake, folder: str, checkpoint: str, name: str = "stream", max_files: int | None = None, form: str = "text", **options: object
) -> StreamingQuery:
    """Run the whole refresh for each batch of new files; ``options`` are those of ``Run``."""
    return stream_documents(lake.spark, folder, checkpoint, stream_batch(lake, checkpoint, name, options), max_files, form)
