"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_working: list[str] = []
_tracking = False


def staged(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read again.

    This cuts the lineage: executors lost later cost no recomputation of what is written.
    """
    path = scratch_path(rows.sparkSession, name)
    if _tracking:
        _working.append(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def shuffled_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """The join of two sides that both grow with the input; neither is ever broadcast.

    Spark sizes what it has not run by compressed files, and an explode by the rows that go into
    it, so it may take a side many times the broadcast limit for a small one; the driver would
    then hold that side.
    """
    return left.join(right.hint("merge"), on, how)


@contextmanager
def working_files(spark: SparkSession) -> Iterator[None]:
    """Around a step whose predecessor's result has been written elsewhere by now.

    What the predecessor staged is deleted; what is staged inside is left to the next such step,
    as the result may still be read from it.
    """
    global _tracking
    while _working:
        path = spark._jvm.org.apache.hadoop.fs.Path(_working.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _tracking = True
    try:
        yield
    finally:
        _tracking = False


def batches_of(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``most_bytes`` of ``column``, or one row."""
    for batch in batches:
        start, size = 0, 0
        lengths = text_bytes(batch.column(column))
        for i, n in enumerate(lengths):
            if size and size + n > most_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def text_bytes(column: pa.Array):
    """Bytes of each value of a string array, 0 for null."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).tolist()


def numbered(docs: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``row`` (unique) and the columns of every row, written down so that numbers stay.

    ``doc`` among the columns stands for a struct of all columns of the input.
    """
    picked = [F.struct(*docs.columns).alias("doc") if c == "doc" else F.col(c) for c in columns]
    return staged(docs.select(F.monotonically_increasing_id().alias("row"), *picked), name)


def bitmap(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of ``2**bits`` positions occur in a column, as booleans.

    Positions are packed into 64-bit numbers before anything reaches the driver, so what is
    collected is at most ``2**bits / 8`` bytes, whatever the rows.
    """
    bit = F.expr(f"shiftleft(1L, cast({column} & 63 as int))")
    packed = rows.groupBy(F.shiftright(column, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = packed.toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)
