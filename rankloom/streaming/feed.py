"""Feed micro-batches to a sink and score streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.sources.tfrecord import qualified, register


def read_events(
    spark: SparkSession,
    directory: str,
    schema,
    name_glob: str | None = None,
    max_files: int | None = None,
    max_bytes: int | str | None = None,
) -> DataFrame:
    """Parquet files as a stream; a micro-batch takes at most ``max_files``, or ``max_bytes`` (one file at least).

    With ``available_now`` a backlog is worked off in batches of that size.
    """
    if max_files and max_bytes:
        raise ValueError("a batch is bounded by files or by bytes, not by both")
    bounds = {"pathGlobFilter": name_glob, "maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    return spark.readStream.schema(schema).options(**{k: v for k, v in bounds.items() if v}).parquet(directory)


def read_record_stream(
    spark: SparkSession, directory: str, state: str, schema, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """TFRecord files as a stream; ``state`` is a shared folder where the files of every batch are written down.

    A batch takes at most ``max_files`` new files, and files up to ``max_bytes``
    together (one at least).  Use it with a time trigger: ``available_now``
    ends after one batch.
    """
    register(spark)
    bounds = {"max_files": max_files, "max_bytes": max_bytes}
    reader = spark.readStream.format("tfrecord").schema(schema).option("state", qualified(spark, state))
    return reader.options(**{k: v for k, v in bounds.items() if v}).load(qualified(spark, directory))


def feed_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
):
    """Write every micro-batch to ``path/batch_id=N``.

    A replayed batch overwrites its own folder, so a restart after a lost
    driver or executor leaves each row exactly once.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        (
            rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stateless scoring of a stream: the batch scorer applied to streaming rows."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return score(stream)
