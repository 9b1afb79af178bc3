"""Incremental runs: the same batch plan over newly arrived items."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forumflow.schemas import POST_ITEM
from forumflow.sources.keyed import KeyedStore


def read_item_stream(
    spark: SparkSession, path: str, fmt: str = "json", files_per_batch: int = 1000, **options: str
) -> DataFrame:
    """Items as files arrive in a folder, at most ``files_per_batch`` of them at a time."""
    reader = spark.readStream.schema(POST_ITEM).format(fmt).options(**options)
    return reader.option("maxFilesPerTrigger", files_per_batch).load(path)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def stream_upsert(
    items: DataFrame,
    store: KeyedStore,
    checkpoint: str,
    name: str,
    every: str | None = None,
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Apply a stream of items to a store, one micro-batch at a time, with its batch id.

    Without ``every`` it takes what is there and stops, to be started by a schedule; with it
    (such as "3 hours") it runs on. A micro-batch that Spark repeats after a failure is applied
    again; the store's merges make that leave the state as one application does.
    """

    def apply(rows: DataFrame, batch_id: int) -> None:
        store.apply(rows, clock(), batch_id)

    writer = items.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.foreachBatch(apply).start()


def stream_to_files(
    rows: DataFrame, path: str, checkpoint: str, name: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to Parquet files, each record exactly once."""
    writer = rows.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.format("parquet").option("path", path).start()


def running_counters(posts: DataFrame) -> DataFrame:
    """First author and latest counters per title, kept as streaming state.

    For typed post rows without prior state; use update or complete output mode.
    """
    order = F.struct("captured_at", "seq")
    return posts.groupBy("title").agg(
        F.min_by(F.struct("author", "datetime"), order).alias("first"),
        F.max_by(F.struct("upvotes", "community"), order).alias("last"),
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Streaming state on local disk of the executors rather than in their heap, unless the
    cluster has chosen a provider already. Takes effect for queries started afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if not current or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB)


def stream_fold(
    rows: DataFrame, fold: Callable[[DataFrame], DataFrame], updates: str, checkpoint: str, name: str
) -> StreamingQuery:
    """Keep ``fold(rows)`` as streaming state and append each epoch's changed groups.

    The aggregate lives in Spark's state store, so each epoch reads only its new files. In update
    mode an epoch emits the whole current value of every group it changed; ``latest`` reads them
    back as one row per group.
    """

    def append(changed: DataFrame, epoch: int) -> None:
        # Written as one folder per epoch, replaced if Spark repeats the epoch.
        changed.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("epoch").parquet(updates)

    keep_state_in_rocksdb(rows.sparkSession)
    writer = fold(rows).writeStream.queryName(name).outputMode("update")
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(append).start()


def latest(spark: SparkSession, updates: str, key: str) -> DataFrame:
    """One row per group: the value its last epoch emitted."""
    rows = spark.read.parquet(updates)
    values = [c for c in rows.columns if c not in (key, "epoch")]
    newest = F.max_by(F.struct(*values), "epoch").alias("v")
    return rows.groupBy(key).agg(newest).select(key, "v.*")
