"""Stored state as plain Parquet tables partitioned by hash bucket of their key.

A batch reads the buckets its keys fall into, merges, and writes those buckets back with Spark's
dynamic partition overwrite: buckets the batch did not touch are neither read nor written.
Rejects go to one ``batch_id=`` folder per batch, so a batch that runs again replaces its own.

Runs are idempotent rather than transactional: every merge keeps first sightings by the least
order key, counters by the greatest and marks by the oldest time, so applying a batch again,
whole or after a failure half way, leaves the state as one application does. A stream's
``foreachBatch`` therefore needs no record of applied epochs; Spark's checkpoint repeats at most
the last one. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumflow.plans.batch import Batch, run_batch
from forumflow.schemas import REJECT, STATE
from forumflow.semantics import DEFAULT, Semantics
from forumflow.session import scratch_path

# Buckets per table. Aim at 256 MB to 1 GB per bucket of the full-grown table.
DEFAULT_BUCKETS = {"post": 64, "comment": 64, "community": 4, "post_mark": 4, "comment_mark": 4}


class KeyedStore:
    """The state tables under one root path; the bucket counts are fixed when it is created."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: Mapping[str, int] | None = None,
        semantics: Semantics = DEFAULT,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.semantics = semantics
        self.buckets = {**DEFAULT_BUCKETS, **(buckets or {})}

    def _keys(self, name: str) -> list[str]:
        return {"post": ["title"], "comment": list(self.semantics.comment_key)}.get(
            name, ["community"]
        )

    def bucket(self, name: str):
        """The bucket of a row of table ``name``, from its key."""
        return F.pmod(F.hash(*self._keys(name)), F.lit(self.buckets[name])).cast("int")

    def _read(self, path: str, schema) -> DataFrame | None:
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(hadoop_path):
            return None
        return self.spark.read.schema(schema).parquet(path)

    def table(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        """Current rows of a table, or of some of its buckets (read by partition pruning)."""
        rows = self._read(f"{self.root}/{name}", STATE[name])
        if rows is None:
            return self.spark.createDataFrame([], STATE[name])
        if buckets is not None and "bucket" in rows.columns:  # none after empty batches only
            rows = rows.where(F.col("bucket").isin(buckets))
        return rows.select(*STATE[name].names)

    def rejects(self) -> DataFrame:
        """Rejected records of all batches."""
        rows = self._read(f"{self.root}/rejects", REJECT)
        if rows is None:
            return self.spark.createDataFrame([], REJECT)
        return rows.select(*REJECT.names)

    def apply(self, items: DataFrame, run_started_at: datetime, batch_id: int) -> None:
        """Type, check, fold and merge one batch into the stored tables."""
        work = scratch_path(self.spark, f"batch-{batch_id}")
        touched: dict[str, list[int]] = {}

        def written(rows: DataFrame, name: str, by: str | None = None) -> DataFrame:
            writer = rows.write.partitionBy(by) if by else rows.write
            writer.parquet(f"{work}/{name}")
            return self.spark.read.schema(rows.schema).parquet(f"{work}/{name}")

        def stage(name: str, rows: DataFrame, by: str | None) -> DataFrame:
            return written(rows, name, by)

        def stored(name: str, rows: DataFrame) -> DataFrame:
            # At most one number per bucket reaches the driver.
            touched[name] = [r[0] for r in rows.select(self.bucket(name)).distinct().collect()]
            return self.table(name, touched[name])

        def emit(name: str, rows: DataFrame) -> DataFrame:
            if name == "rejects":
                out, by = rows.withColumn("batch_id", F.lit(batch_id)), "batch_id"
            else:
                out, by = rows.withColumn("bucket", self.bucket(name)), "bucket"
            # Written down first: the merge read the buckets it is about to replace.
            merged = written(out, f"out-{name}")
            (
                merged.repartition(by)  # one file per bucket
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(by)
                .parquet(f"{self.root}/{name}")
            )
            return merged.drop(by)

        batch = Batch(batch_id, run_started_at, self.semantics, stage, emit)
        try:
            run_batch(items, stored, batch)
        finally:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(work)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
