"""Spelling variant grouping: Bloom-guided edit neighbourhoods and an exact vocabulary join.

Words: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` in every whole text, A-Z lower-cased. Let h be
the unsigned crc32 of the UTF-8 of ``<doc_id>:<run>``; if ``PRIME`` divides h, the run's code point
``h % length`` is deleted. The vocabulary is the distinct results of at least ``MIN_LENGTH`` code
points occurring at least ``MIN_COUNT`` times (n) in all texts. Two words are near if one inserted,
deleted or replaced code point turns one into the other. A word's form is its near word of
largest n (ties: the smallest in code-point order), if that n is at least ``DOMINANCE`` times the
word's own; its root follows forms to the end. Forms only lead to larger counts, so roots end.

The method. Near pairs of different lengths are found from the longer word, by deleting one code
point; pairs of equal length by replacing one with another letter of the alphabet. Every such
edit is a probe. Probes are never spelled out: a word's polynomial hash gives the hash of every
deletion and replacement by arithmetic on its prefix hashes, all in numpy, and a probe is the
word's key with the length and 64-bit key of the edit. Each hash is
tested against a blocked Bloom filter of the vocabulary words of the probe's length (one 512-bit
block per test, ``HASHES`` bits in it). The filters are built by an aggregation (bit-or per
64-bit slot), sized at ``BITS_PER_WORD`` bits a word, and broadcast when their size, known from
a count before they are built, is at most ``BROADCAST_BYTES``; beyond that every probe goes on
as if positive, a slower way with the same result. Only positives shuffle, to an exact join with
the vocabulary on (length, key) and a check of the two words by edit distance, which removes the
false positives (of the filter and of the hash alike).

At scale: runs, the deletion rule and the counts are DataFrame expressions, combined in each task
before the exchange, so a word a third of all texts hold arrives as one row per task. Probing runs
per vocabulary partition in Arrow batches. The one step per word that Python takes is the probe
generation, bounded by the word's length times the alphabet. Forms are an aggregation over the
near pairs, roots a join per step of the chain; every step is written to the shared scratch folder.

Defined cases: a null text has no words; a null doc_id gives a null h, so no deletion. Empty
table, or no word reaching the bounds: an empty result. Repeated rows count as often as they
occur. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumflow.llm.staging import staged

# Fixed values of the contract: the letters of a run, the deletion rule and the bounds.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PRIME = 199
MIN_LENGTH = 6
MIN_COUNT = 5
DOMINANCE = 5
# Code points a word can hold after lower-casing: a-z and U+00C0 to U+00FF.
ALPHABET = np.array([ord(c) for c in LOWER] + list(range(0xC0, 0x100)), np.uint64)

BITS_PER_WORD = 16
HASHES = 6
BROADCAST_BYTES = 64 << 20
# Vocabulary words per task while probing: each costs its length times the alphabet in hashing.
PROBE_WORDS = 20_000
_BASE = 0x100000001B3
_MASK = (1 << 64) - 1


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of all texts that reaches the bounds."""
    runs = docs.select(
        "doc_id",
        F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({RUN})"), 1)),
    ).select("doc_id", F.translate("col", UPPER, LOWER).alias("run"))
    h = F.crc32(F.encode(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run"), "UTF-8"))
    cut = "concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))"
    words = runs.select("run", h.alias("h")).select(
        F.when(F.col("h") % PRIME == 0, F.expr(cut)).otherwise(F.col("run")).alias("word")
    )
    counted = (
        words.where(F.length("word") >= MIN_LENGTH)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.where(F.col("n") >= MIN_COUNT)


def _codes(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    out, p = [], 1
    for _ in range(n + 1):
        out.append(p)
        p = (p * _BASE) & _MASK
    return np.array(out, np.uint64)


def _full(codes: np.ndarray, powers: np.ndarray) -> np.uint64:
    n = len(codes)
    with np.errstate(over="ignore"):
        return np.uint64(np.sum(codes * powers[n - 1 :: -1][:n] if n else codes, dtype=np.uint64))


def _mix(h: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A splitmix finalizer of (hash, length), so that all bits of the key spread."""
    with np.errstate(over="ignore"):
        z = h ^ (length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _slots(g: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key and each of HASHES bits: its 64-bit slot within the shard and its mask."""
    block = (g >> np.uint64(32)) % blocks.astype(np.uint64)
    a = g & np.uint64(511)
    b = ((g >> np.uint64(9)) & np.uint64(511)) | np.uint64(1)
    pos = (a[:, None] + np.arange(HASHES, dtype=np.uint64)[None, :] * b[:, None]) & np.uint64(511)
    slot = block[:, None] * np.uint64(8) + (pos >> np.uint64(6))
    return slot, np.uint64(1) << (pos & np.uint64(63))


def _edits(word: str) -> tuple[np.ndarray, np.ndarray, list]:
    """Hashes and lengths of every deletion and replacement of a word, and how to spell each."""
    c = _codes(word)
    n = len(c)
    pw = _powers(n)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, np.uint64)
        for i in range(n):
            prefix[i + 1] = prefix[i] * np.uint64(_BASE) + c[i]
        full = prefix[n]
        suffix = full - prefix * pw[n - np.arange(n + 1)]  # hash of c[i:]
        tail = pw[n - 1 - np.arange(n)]  # weight of position i
        dele = prefix[:n] * pw[n - 1 - np.arange(n)] + suffix[1:]
        subs = full + (ALPHABET[None, :] - c[:, None]) * tail[:, None]
    ok = ALPHABET[None, :] != c[:, None]
    keys = [dele] if n - 1 >= MIN_LENGTH else [np.zeros(0, np.uint64)]
    keys.append(subs[ok])
    lengths = [np.full(len(keys[0]), n - 1), np.full(len(keys[1]), n)]
    return np.concatenate(keys), np.concatenate(lengths), (len(keys[0]), np.nonzero(ok))


def _word_keys(words: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    lengths = words.str.len().to_numpy()
    hashes = np.zeros(len(words), np.uint64)
    most = int(lengths.max()) if len(words) else 0
    pw = _powers(most)
    for k, w in enumerate(words):
        hashes[k] = _full(_codes(w), pw)
    return _mix(hashes, lengths), lengths


def _bloom_bits(shards: dict[int, int]):
    """mapInPandas function: (length, slot, bits) of the vocabulary words in each batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            g, lengths = batch["key"].to_numpy().view(np.uint64), batch["length"].to_numpy()
            blocks = np.array([shards[int(n)] for n in lengths], np.int64)
            slot, mask = _slots(g, blocks)
            yield pd.DataFrame(
                {
                    "length": np.repeat(lengths, HASHES).astype(np.int64),
                    "slot": slot.ravel().astype(np.int64),
                    "bits": mask.ravel().view(np.int64),
                }
            )

    return run


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas function: every vocabulary word with its length and 64-bit key."""
    for batch in batches:
        g, lengths = _word_keys(batch["word"])
        yield batch.assign(length=lengths.astype(np.int64), key=g.view(np.int64))


def _probe(bloom):
    """mapInPandas function: (key of a word, length and key of an edit) the filters let pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters = bloom.value if bloom is not None else None
        for batch in batches:
            out_a, out_len, out_key = [], [], []
            for word, key in zip(batch["word"], batch["key"]):
                keys, lengths, _ = _edits(word)
                if not len(keys):
                    continue
                g = _mix(keys, lengths)
                if filters is not None:
                    offsets, blocks, bits = filters
                    sizes = (len(word) - 1, len(word))
                    base = np.array([offsets.get(n, -1) for n in sizes])
                    nb = np.array([blocks.get(n, 0) for n in sizes])
                    side = (lengths == len(word)).astype(int)
                    has = (base[side] >= 0) & (nb[side] > 0)
                    hit = np.zeros(len(keys), bool)
                    if has.any():
                        slot, mask = _slots(g[has], nb[side][has])
                        at = base[side][has][:, None].astype(np.uint64) + slot
                        hit[has] = ((bits[at] & mask) == mask).all(axis=1)
                    g, lengths = g[hit], lengths[hit]
                out_a.append(np.full(len(g), key, np.int64))
                out_len.append(lengths.astype(np.int64))
                out_key.append(g.view(np.int64))
            if out_a:
                yield pd.DataFrame(
                    {
                        "a_key": np.concatenate(out_a),
                        "b_length": np.concatenate(out_len),
                        "b_key": np.concatenate(out_key),
                    }
                )

    return run


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(a, b) for every ordered pair of near vocabulary words."""
    spark = vocab.sparkSession
    keyed = staged(
        vocab.select("word").mapInPandas(_keyed, "word string, length long, key long"),
        "spelling-keys",
    )
    per_length = {
        r["length"]: r["c"]
        for r in keyed.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect()
    }  # one row per distinct length
    shards = {n: max(1, -(-c * BITS_PER_WORD // 512)) for n, c in per_length.items()}
    total_bytes = 64 * sum(shards.values())
    bloom = None
    if total_bytes <= BROADCAST_BYTES:
        bits = (
            keyed.select("length", "key")
            .mapInPandas(_bloom_bits(shards), "length long, slot long, bits long")
            .groupBy("length", "slot")
            .agg(F.bit_or("bits").alias("bits"))
            .toArrow()
        )  # at most total_bytes / 8 rows
        offsets, at = {}, 0
        for n in sorted(shards):
            offsets[n] = at
            at += shards[n] * 8
        table = np.zeros(at, np.uint64)
        if bits.num_rows:
            start = np.array([offsets[int(n)] for n in bits["length"].to_numpy()], np.int64)
            table[start + bits["slot"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
        bloom = spark.sparkContext.broadcast((offsets, shards, table))
    parts = max(spark.sparkContext.defaultParallelism, -(-sum(per_length.values()) // PROBE_WORDS))
    positives = keyed.select("word", "key").repartition(parts).mapInPandas(
        _probe(bloom), "a_key long, b_length long, b_key long"
    )
    words_b = keyed.select(F.col("word").alias("b"), F.col("length").alias("b_length"), F.col("key").alias("b_key"))
    words_a = keyed.select(F.col("word").alias("a"), F.col("key").alias("a_key"))
    found = (
        positives.join(words_b, ["b_length", "b_key"])
        .join(words_a, "a_key")
        .where((F.levenshtein("a", "b", 1) == 1))
        .select("a", "b")
    )
    return found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every vocabulary word."""
    vocab = staged(vocabulary(docs), "spelling-vocabulary")
    pairs = staged(near_pairs(vocab), "spelling-pairs")
    other = vocab.select(F.col("word").alias("b"), F.col("n").alias("nb"))
    best = (
        pairs.join(other, "b")
        .groupBy("a")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("nb")).alias("neg"), F.col("b").alias("b"))).alias("best"),
        )
    )
    forms = vocab.join(best, vocab["word"] == best["a"], "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.neg") >= DOMINANCE * F.col("n"), F.col("best.b")).alias("form"),
    )
    forms = staged(forms, "spelling-forms")
    step = forms.select(F.col("word").alias("at"), F.col("form").alias("next")).where(
        F.col("next").isNotNull()
    )
    roots = forms.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        moved = roots.join(step, roots["root"] == step["at"], "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = staged(moved, "spelling-roots")
        if not moved.where("moved").limit(1).collect():
            break
        roots = moved.drop("moved")
    counts = vocab.select(F.col("word").alias("form"), F.col("n").alias("form_n"))
    return (
        forms.join(moved.select("word", "root"), "word")
        .join(counts, "form", "left")
        .select(
            "word",
            "form",
            "root",
            F.col("n").cast("long").alias("n"),
            "n_near",
            F.col("form_n").cast("long").alias("form_n"),
        )
    )
