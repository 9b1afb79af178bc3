"""Best-fit packing with certified bin counts.

Documents become token ids with an end id; longer ones are cut into pieces of ``capacity``, and a
full piece is a sequence of its own. The other pieces are dealt to partitions of a bounded number
of pieces, and each partition is packed by best-fit decreasing. Dual-feasible functions give a
lower bound of the number of bins any packing needs, so a partition whose bins equal its bound is
certified. Partitions with a gap give up all their pieces, certified ones only the pieces of bins
that are not full; these are dealt out anew over fewer partitions and packed again, and that
packing is kept if it has fewer bins. Rounds end when the total meets the bound of all pieces
together or nothing is gained.

Only integers reach the driver: bin counts per partition, and how many pieces have each length
(at most ``capacity`` numbers), from which the overall bound is computed.

Defined results: null and empty texts are one piece with the end id alone; equal rows are packed
as separate documents; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumflow.llm.staging import batches_of, staged
from forumflow.llm.tokens import encoder

CAPACITY = 4096
PER_PARTITION = 100_000
_BATCH = 3 << 20


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins needed at least; ``counts[x]`` pieces have length x.

    The best of three families of dual-feasible functions: the identity; those that round
    lengths over ``capacity - a`` up to a whole bin and drop lengths under a; and those that
    round to multiples of 1/k where (k + 1) * length / capacity is no whole number.
    """
    x = np.arange(capacity + 1)
    volume = counts * x
    below = np.concatenate([[0], np.cumsum(counts)])
    filled = np.concatenate([[0], np.cumsum(volume)])
    best = -(-int(volume.sum()) // capacity)
    a = np.arange(1, capacity // 2 + 1)
    large = below[-1] - below[capacity - a + 1]
    middle = filled[capacity - a + 1] - filled[a]
    best = max(best, int((large - (-middle // capacity)).max()))
    for k in range(1, 21):
        whole = (k + 1) * x % capacity == 0
        value = np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; bins are numbered from 0.

    Open bins lie in stacks by their free space, and bit g of a number says whether the stack of
    free space g has any, so the tightest bin that fits is the lowest bit from the length on.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, opened = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            stack = stacks[free]
            at = stack.pop()
            if not stack:
                mask ^= 1 << free
        else:
            free, at = capacity, opened
            opened += 1
        bins[i], offsets[i] = at, capacity - free
        free -= n
        if free:
            stacks[free].append(at)
            mask |= 1 << free
    return bins, offsets


_PACKED = (
    "item bigint, length bigint, part bigint, bin bigint, offset bigint, free bigint,"
    " bins bigint, bound bigint"
)


def _pack_parts(items: DataFrame, capacity: int, salt: int) -> DataFrame:
    """Best-fit decreasing in partitions of about ``PER_PARTITION`` items."""
    parts = max(1, -(-items.count() // PER_PARTITION))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("item")
        lengths = rows["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        used = np.bincount(bins, weights=lengths).astype(np.int64)
        counts = np.bincount(lengths, minlength=capacity + 1)
        return pd.DataFrame(
            {
                "item": rows["item"],
                "length": lengths,
                "part": rows["part"],
                "bin": bins,
                "offset": offsets,
                "free": capacity - used[bins],
                "bins": len(used),
                "bound": lower_bound(counts, capacity),
            }
        )

    part = F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(parts)).alias("part")
    return items.select("item", "length", part).groupBy("part").applyInPandas(pack, _PACKED)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(item, sequence_id, offset) of every row of a written table (item, length)."""
    rest = items.filter(F.col("length") < capacity)
    found = rest.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for r in found:
        counts[r["length"]] = r["n"]
    bound = lower_bound(counts, capacity)
    open_ = F.col("offset") == 0  # one row of each bin
    now = staged(_pack_parts(rest, capacity, 0).withColumn("round", F.lit(0)), "packing-round")
    total, k = now.filter(open_).count(), 0
    while total > bound:
        k += 1
        gives = (F.col("bins") > F.col("bound")) | (F.col("free") > 0)
        pool = now.filter(gives)
        again = staged(
            _pack_parts(pool.select("item", "length"), capacity, k).withColumn("round", F.lit(k)),
            "packing-again",
        )
        gain = pool.filter(open_).count() - again.filter(open_).count()
        if gain <= 0:
            break
        total -= gain  # so the rounds come to an end
        now = staged(now.filter(~gives).unionByName(again), "packing-round")
    # 15 bits for the round, 24 for the partition and 24 for the bin in it
    sequence = (
        F.shiftleft(F.col("round").cast("long"), 48)
        .bitwiseOR(F.shiftleft("part", 24))
        .bitwiseOR(F.col("bin"))
    )
    whole = items.filter(F.col("length") == capacity).select(
        "item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return now.select("item", sequence.alias("sequence_id"), "offset").unionByName(whole)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and the checksum of its ids, for each piece of each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches_of(batches, "text", _BATCH):
            ids, first = encode(batch.column("text"))
            raw = ids.astype("<u4").tobytes()
            doc, start, length, crc = [], [], [], []
            for d, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                n = b - a + 1
                for s in range(0, n, capacity):
                    e = min(s + capacity, n)
                    code = zlib.crc32(raw[4 * (a + s) : 4 * min(a + e, b)])
                    crc.append(zlib.crc32(end, code) if e == n else code)
                    doc.append(d)
                    start.append(s)
                    length.append(e - s)
            at = pa.array(start, pa.int64())
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(pa.array(doc, pa.int64())),
                    pa.array(np.array(start, np.int64) // capacity, pa.int32()),
                    at,
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY
) -> DataFrame:
    """Every piece of every document with its sequence and place in it."""
    cut = pieces(docs, tokenizer, end_id, capacity)
    items = staged(cut.withColumn("item", F.monotonically_increasing_id()), "packing-pieces")
    placed = pack(items.select("item", "length"), capacity)
    return items.join(placed, "item").drop("item")
