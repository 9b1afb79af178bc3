"""Token ids as Parquet files with list columns.

Files hold documents in ascending doc_id order, file after file. ``ids`` is a list column with
dictionary encoding (a vocabulary fits into one dictionary page); ``doc_id`` and ``n_tokens`` are
written as deltas. Row groups and pages are small, and pages carry column and offset indexes, so a
reader that wants a range of documents, or their lengths alone, reads little else.

Defined results: null and empty texts are the end id alone; a null doc_id comes first; equal
doc_ids keep the order the files have; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forumflow.llm.staging import batches_of
from forumflow.llm.tokens import encoder

_BATCH = 3 << 20
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",  # deltas where there is no dictionary
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens and ids (the end id among them) of each document, in the given order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer).encode
        for batch in batches_of(batches, "text", _BATCH):
            ids, first = ids_of(batch.column("text"))
            n = len(first) - 1
            ends = np.zeros(len(ids) + n, bool)
            ends[first[1:] + np.arange(n)] = True
            full = np.full(len(ends), end_id, np.int32)
            full[~ends] = ids
            offsets = first + np.arange(n + 1)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(full))
            lengths = pa.array(np.diff(offsets), pa.int64())
            yield pa.record_batch(
                [batch.column("doc_id"), lengths, lists], ["doc_id", "n_tokens", "ids"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, n_tokens bigint, ids array<int>"
    )


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write the ids of all documents in ascending doc_id order."""
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    encoded(ordered, tokenizer, end_id).write.options(**LAYOUT).parquet(path)


def read_token_files(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """doc_id, n_tokens and ids; a condition on doc_id or n_tokens is checked against the indexes."""
    rows = spark.read.parquet(path)
    return rows if where is None else rows.filter(where)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold per document: doc_id, start, n_tokens, ids_crc32.

    Starts are sums within a file and over the files before it. Only numbers are shuffled; the
    one window without partitions runs over a row per file.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            low = int(offsets[0]) if len(offsets) else 0
            raw = ids.values.to_numpy()[low:].astype("<u4", copy=False).tobytes()
            ends = ((offsets - low) * 4).tolist()
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            columns = [batch.column(c) for c in ("doc_id", "file", "at")]
            sizes = pa.array(np.diff(offsets), pa.int64())
            yield pa.record_batch(
                [*columns, sizes, pa.array(crc, pa.int64())],
                ["doc_id", "file", "at", "n_tokens", "ids_crc32"],
            )

    files = spark.read.parquet(path)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    kind = files.schema["doc_id"].dataType.simpleString()
    rows = files.select("doc_id", name.alias("file"), F.col("_metadata.row_index").alias("at"), "ids")
    checked = rows.mapInArrow(
        check, f"doc_id {kind}, file int, at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    sums = files.select(name.alias("file"), "n_tokens").groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = sums.select(
        "file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before")
    )
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("at")) - F.col("n_tokens")
    return (
        checked.withColumn("inside", inside)
        .join(before, "file")
        .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
