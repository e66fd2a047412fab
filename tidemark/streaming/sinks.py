"""Stream outputs that can be replayed: every micro-batch overwrites its own folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shared_path
from tidemark.streaming.windows import top_per_window


def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    name: str,
    mode: str = "append",
    interval: str | None = None,
    checkpoint: str | None = None,
    timeout: int | None = None,
):
    """Feed `write(batch, batch_id)`; without an interval all available data is taken, then the query ends.

    With an interval the query runs for `timeout` seconds and is then stopped; without a timeout
    it is returned running, for the caller to stop.
    """
    writer = stream.writeStream.outputMode(mode).option(
        "checkpointLocation", checkpoint or shared_path(stream.sparkSession, f"{name}-progress")
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    query = writer.foreachBatch(write).start()
    if timeout is not None:
        if not query.awaitTermination(timeout):
            query.stop()
    elif not interval:
        query.awaitTermination()
    return query


def append_batches(stream: DataFrame, path: str, name: str, mode: str = "append", by: Sequence[str] = (), **run):
    """Write each micro-batch below `path` under its batch number, optionally split by columns.

    Re-running a batch replaces exactly the folder it wrote before, so a restart after a
    lost driver or executor neither loses nor doubles rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        if by:
            writer = writer.partitionBy(*by)
        writer.parquet(f"{path}/batch_id={batch_id}")

    return run_batches(stream, write, name, mode, **run)


def read_batches(spark, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all micro-batches written so far, with their batch number."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).option(
        "basePath", path
    ).parquet(path)


def latest_versions(versions: DataFrame, keys: Sequence[str], value: str = "n") -> DataFrame:
    """Current value per key from the changes an `update` stream wrote."""
    return versions.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))


def append_closed_top(counts: DataFrame, path: str, name: str, key: str, k: int = 10, **run):
    """Rank each window's keys once the window has closed, and append its top list.

    `counts` is a stream of window counts. In append mode a window's counts come when the watermark has passed its end,
    all in one batch and never again, so a batch can be ranked by itself; re-running one replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        top_per_window(batch, key, k).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return run_batches(counts, write, name, "append", **run)
