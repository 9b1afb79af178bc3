"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item becomes windows of ``size`` consecutive words (a shorter item is one window).
A window occurs in a document when all its shingles do, in order. So one shingle of each window
is a necessary prefix, and the rarest is taken: shingles are ordered by how often they occur in
all documents. Documents meet the windows on that shingle alone; bounds on length and position
follow, then the words are compared.

What a document brings to the join are its runs of words whose neighbouring pairs occur in some
item. Pairs are looked up in a bitmap of fixed size, so the scan broadcasts half a megabyte however
large the benchmark is; a bitmap never misses a pair, so no window is lost.

Defined results: null and empty texts have no words and no hits; equal rows are results of their
own; an item without words has no window; items with equal ids count once and a null id is not
counted; with no items every document is clean; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumflow.llm.staging import batches_of, bitmap, numbered, staged
from forumflow.llm.words import mix, words_of

PAIR_BITS = 22
SHINGLE = 3
_BATCH = 2 << 20


def _pair_hashes(h: np.ndarray) -> np.ndarray:
    """A number below 2**PAIR_BITS for each word and the next."""
    return (mix(h[:-1] * np.uint64(31) + h[1:]) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _word_hashes(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ np.uint64(0x5BD1E995)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _lists(first: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)


def item_words(items: DataFrame) -> DataFrame:
    """``item_id``, the words of each item, and the bits of its pairs (or of its only word)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text", _BATCH):
            w = words_of(batch.column("text"))
            h, counts = w.hashes(), w.counts()
            bits = np.zeros(len(h), np.int64)
            bits[:-1] = _pair_hashes(h)
            last = np.zeros(len(h), bool)
            last[w.first[1:][counts > 0] - 1] = True
            alone = last.copy()
            alone &= np.repeat(counts == 1, counts)
            bits[alone] = _word_hashes(h[alone])
            use = ~last | alone
            first = np.concatenate([[0], np.cumsum(use)])[w.first]
            yield pa.record_batch(
                [
                    batch.column("item_id"),
                    _lists(w.first, pa.array(w.strings(np.arange(len(h))), pa.string())),
                    _lists(first, pa.array(bits[use], pa.int64())),
                ],
                ["item_id", "words", "bits"],
            )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(
        read, f"item_id {kind}, words array<string>, bits array<bigint>"
    )


def item_windows(words: DataFrame, size: int) -> DataFrame:
    """Each window of each item once."""
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - size, F.lit(0)) + 1)
    windows = F.transform(starts, lambda i: F.slice("words", i, F.least(n, F.lit(size))))
    return words.filter(n > 0).select("item_id", F.explode(windows).alias("window")).distinct()


def document_runs(
    docs: DataFrame, keep: list[str], pairs: np.ndarray, singles: np.ndarray | None, shortest: int
) -> DataFrame:
    """The ``keep`` columns of each document, its number of words, and its runs.

    ``singles`` marks the words of one-word items; ``shortest`` is the least number of words of
    any other window.
    """
    shared = docs.sparkSession.sparkContext.broadcast((pairs, singles))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_pairs, known_words = shared.value
        for batch in batches_of(batches, "text", _BATCH):
            w = words_of(batch.column("text"))
            h = w.hashes()
            boundary = np.zeros(len(h) + 1, bool)
            boundary[w.first] = True  # a text begins at this word
            good = np.zeros(len(h) + 1, bool)
            if len(h) > 1:
                good[1:-1] = known_pairs[_pair_hashes(h)] & ~boundary[1:-1]
            # good[i] joins word i to the one before it
            alive = (good[:-1] | good[1:])[: len(h)]
            alone = known_words[_word_hashes(h)] if known_words is not None else None
            if alone is not None:
                alive = alive | alone
            edge = np.diff(np.concatenate([[False], alive, [False]]).astype(np.int8))
            begin = np.flatnonzero((edge[:-1] == 1) | (boundary[:-1] & alive))
            following = np.append(begin[1:], len(h))
            end = np.minimum(following, _next(edge, begin))
            enough = end - begin >= shortest
            if alone is not None:
                total = np.concatenate([[0], np.cumsum(alone)])
                enough |= total[end] > total[begin]
            begin, end = begin[enough], end[enough]
            length = end - begin
            inner = np.concatenate([[0], np.cumsum(length)])
            which = np.arange(inner[-1]) + np.repeat(begin - inner[:-1], length)
            doc = np.searchsorted(w.first, begin, "right") - 1
            runs = pa.StructArray.from_arrays(
                [
                    pa.array(begin - w.first[doc], pa.int64()),
                    _lists(inner, pa.array(w.strings(which), pa.string())),
                ],
                ["start", "words"],
            )
            first = np.searchsorted(doc, np.arange(len(w.first)))
            yield pa.record_batch(
                [
                    *[batch.column(c) for c in keep],
                    pa.array(w.counts(), pa.int64()),
                    _lists(first, runs),
                ],
                [*keep, "n_words", "runs"],
            )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(
        scan,
        f"{kinds}, n_words bigint, runs array<struct<start:bigint,words:array<string>>>",
    )


def _next(edge: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each begin, where the alive words around it end."""
    ends = np.flatnonzero(edge == -1)
    if not len(begin):
        return begin
    return ends[np.searchsorted(ends, begin, "right")]


def window_hits(runs: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """(row, start, length, item_id) of every occurrence of a window.

    ``runs`` has ``row`` and the runs of each document, written down.
    """
    run = runs.select("row", F.explode("runs").alias("run")).select("row", "run.*")
    n = F.size("words")
    # Shingles have SHINGLE words, or as many as a shorter window has.
    short = windows.filter(F.size("window") < SHINGLE).select(F.size("window").alias("k"))
    ks = sorted({SHINGLE, *[r.k for r in short.distinct().collect()]})  # at most SHINGLE values
    places = F.explode(F.sequence(F.lit(0), n - 1)).alias("i")
    spread = run.select("row", "start", places, "words")
    low = F.greatest(F.col("i") - (size - 1), F.lit(0))
    context = F.slice("words", low + 1, F.lit(2 * size - 1))
    keys = F.array(
        *[
            F.when(F.col("i") + k <= n, F.concat_ws(" ", F.slice("words", F.col("i") + 1, k)))
            for k in ks
        ]
    )
    doc_side = spread.select(
        "row",
        (F.col("start") + F.col("i")).alias("at"),
        (F.col("i") - low).alias("before"),
        context.alias("around"),
        F.explode(keys).alias("key"),
    ).filter(F.col("key").isNotNull())

    counts = doc_side.groupBy("key").agg(F.count(F.lit(1)).alias("frequency"))
    length = F.size("window")
    k = F.least(length, F.lit(SHINGLE))
    offsets = F.explode(F.sequence(F.lit(0), length - k)).alias("offset")
    shingles = windows.select("item_id", "window", offsets).select(
        "item_id",
        "window",
        "offset",
        F.concat_ws(" ", F.slice("window", F.col("offset") + 1, k)).alias("key"),
    )
    rarity = F.struct(F.coalesce("frequency", F.lit(0)).alias("frequency"), "key", "offset")
    prefix = (
        shingles.join(counts, "key", "left")
        .groupBy("item_id", "window")
        .agg(F.min(rarity).alias("rarest"))
        .filter(F.col("rarest.frequency") > 0)
        .select("item_id", "window", "rarest.key", "rarest.offset")
    )
    fits = (F.col("before") >= F.col("offset")) & (
        F.size("around") - F.col("before") >= F.size("window") - F.col("offset")
    )
    same = (
        F.slice("around", F.col("before") - F.col("offset") + 1, F.size("window"))
        == F.col("window")
    )
    return (
        doc_side.join(staged(prefix, "decontaminate-prefix"), "key")
        .filter(F.when(fits, same).otherwise(False))
        .select(
            "row",
            (F.col("at") - F.col("offset")).alias("start"),
            F.size("window").alias("length"),
            "item_id",
        )
    )


def contamination(docs: DataFrame, items: DataFrame, keep: list[str], size: int = 10) -> DataFrame:
    """The ``keep`` columns of every document with its words, hit words and items."""
    words = staged(item_words(items), "decontaminate-items")
    windows = staged(item_windows(words, size), "decontaminate-windows")
    n = F.size("words")
    bits = words.select(n.alias("n"), F.explode("bits").alias("bit"))
    pairs = bitmap(bits.filter("n > 1"), "bit", PAIR_BITS)
    singles = bitmap(bits.filter("n = 1"), "bit", PAIR_BITS)
    shortest = words.filter(n > 1).agg(F.min(F.least(n, F.lit(size)))).first()[0] or size
    found = document_runs(docs, keep, pairs, singles if singles.any() else None, shortest)
    runs = staged(
        found.withColumn("row_", F.monotonically_increasing_id()), "decontaminate-runs"
    )
    hits = window_hits(runs.select(F.col("row_").alias("row"), "runs"), windows, size)
    spans = F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))
    per_doc = hits.groupBy(F.col("row").alias("row_")).agg(
        F.sort_array(spans).alias("spans"),
        F.array_sort(F.transform(F.collect_set("item_id"), lambda x: x.cast("string"))).alias(
            "items"
        ),
    )
    state = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))

    def cover(acc, span):
        new = F.greatest(span["end"] - F.greatest(acc["end"], span["start"]), F.lit(0))
        return F.struct(
            (acc["hit"] + new).alias("hit"), F.greatest(acc["end"], span["end"]).alias("end")
        )

    hit = F.coalesce(F.aggregate("spans", state, cover)["hit"], F.lit(0).cast("long"))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return runs.select("row_", *keep, "n_words").join(per_doc, "row_", "left").select(
        *keep,
        "n_words",
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    rows = numbered(docs, ["doc", "text"], "decontaminate-docs")
    marked = contamination(rows, items, ["row"], size).filter("contaminated").select("row")
    return rows.join(staged(marked, "decontaminate-marked"), "row", "left_anti").select("doc.*")
