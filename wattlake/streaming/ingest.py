"""Structured Streaming forms of ingestion: replay-safe micro-batches into snapshot tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wattlake.operators.staging import keep_first, upsert_snapshot


def upsert_sink(folder: str, name: str, key: str, update: Sequence[str], order: Sequence[Column | str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that upserts each batch by key into the snapshot; a batch seen twice changes nothing."""

    def sink(batch: DataFrame, epoch: int) -> None:
        upsert_snapshot(keep_first(batch, [key], order), folder, name, key, update)

    return sink


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what has landed, batch by batch, and stop."""
    q = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def landed(spark: SparkSession, folder: str, schema, files: int = 100) -> DataFrame:
    """A stream of landed parquet files, at most ``files`` a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def first_of_key(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Each key once within the watermark; state is dropped behind it, so it stays bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, time: str, keys: Sequence[str], window: str, delay: str) -> DataFrame:
    """Row counts by event-time window and keys, final once the watermark has passed."""
    from pyspark.sql import functions as F

    return stream.withWatermark(time, delay).groupBy(F.window(time, window), *keys).count()


def run_every(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, every: str = "6 hours") -> StreamingQuery:
    """Start a stream that looks for landed files at an interval; the caller stops it."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def capped(sink: Callable[[DataFrame, int], None], group: str, order: Sequence[Column], most: int) -> Callable[[DataFrame, int], None]:
    """A sink that takes at most ``most`` rows a group of each batch, a limit that is the feature."""
    from wattlake.operators.staging import top_n

    return lambda batch, epoch: sink(top_n(batch, [group], list(order), most).drop("rank"), epoch)
