"""N-gram Jaccard join with Bayesian candidate pruning.

Texts whose five-word shingle sets have a Jaccard similarity of at least 4/5 are linked.

1. Texts with equal shingle sets form one class, found by a digest of the set; one of them stands
   for the others from here on.
2. A set gets 128 MinHash values. Bands of four are bucket keys: two sets of similarity 0.8 share
   no bucket with a probability of 5e-8.
3. In a bucket, pairs are compared 16 values at a time. By the matches m among n values, the
   posterior of reaching the threshold under a uniform prior is P(Bin(n + 1, t) <= m); a pair is
   dropped once that falls below the tolerance (1e-6). A pair that shares several buckets belongs
   to the first of them.
4. What remains is verified exactly on the shingle sets.

Pairs never become rows: a bucket gives out members, then links per member and a spanning forest.
A bucket of more than ``BLOCK`` members is split into blocks that meet two at a time in tasks of
their own, so no task holds a whole hot bucket and no pair is lost. The work of a group of n
different near copies is n * n / 2 comparisons, which exact link counts demand.

The joins of the method are shuffled, so what the driver holds does not grow with the input. The
one exception finds the texts to verify: up to ``FEW`` row numbers may be broadcast, which spares
all texts a shuffle.

Defined results: null and empty texts have no shingles, link to nothing, and each is a class of
its own; a text of fewer than five words has one shingle of all its words; equal rows are copies
of each other; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumflow.llm.components import connected_components
from forumflow.llm.staging import batches_of, numbered, shuffled_join, staged
from forumflow.llm.words import gram_hashes, mix, words_of

SHINGLE = 5
HASHES, BAND = 128, 4
BANDS = HASHES // BAND
STEP = 16
THRESHOLD = (4, 5)
TOLERANCE = 1e-6
BLOCK = 512
FEW = 1 << 18
_BATCH = 2 << 20
_PAIRS = 1 << 18
_GROUP = ["band", "key", "low", "high"]

_SEED = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_A = (_SEED[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (_SEED[HASHES:] >> np.uint64(32)).astype(np.uint32)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For 16, 32, ... compared values, the fewest matches with which a pair goes on.

    Values are compared by one byte, so unequal ones match once in 256.
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


_LEAST = least_matches(THRESHOLD[0] / THRESHOLD[1], TOLERANCE)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted shingle hashes of each text, each once."""
    grams, first = gram_hashes(words_of(texts), SHINGLE)
    return [np.unique(grams[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of non-empty sets, one row each."""
    out = np.empty((len(sets), HASHES), np.uint32)
    at = 0
    while at < len(sets):  # a few sets at a time, so that they stay in the cache
        stop, size = at, 0
        while stop < len(sets) and (stop == at or size + len(sets[stop]) <= 1 << 15):
            size += len(sets[stop])
            stop += 1
        x = (np.concatenate(sets[at:stop]) >> np.uint64(32)).astype(np.uint32)
        first = np.cumsum([0, *map(len, sets[at : stop - 1])])
        for k in range(HASHES):
            out[at:stop, k] = np.minimum.reduceat(x * _A[k] + _B[k], first)
        at = stop
    return out


def signatures(rows: DataFrame) -> DataFrame:
    """``row``, the digest of its shingle set, one byte per MinHash value, and bucket keys."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text", _BATCH):
            sets = shingle_sets(batch.column("text"))
            full = [i for i, s in enumerate(sets) if len(s)]
            values = minhashes([sets[i] for i in full])
            mixed = mix(values.astype(np.uint64))
            bands = np.zeros((len(full), BANDS), np.uint64)
            for k in range(BAND):
                bands = mix(bands * np.uint64(31) + mixed[:, k::BAND])
            keys = (bands >> np.uint64(32)).astype(np.uint32).view(np.int32)
            small = (mixed >> np.uint64(56)).astype(np.uint8)
            digests = [hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest() for i in full]
            yield pa.record_batch(
                [
                    batch.column("row").take(pa.array(full, pa.int64())),
                    pa.array(digests, pa.binary()),
                    pa.array([s.tobytes() for s in small], pa.binary()),
                    pa.array([s.tobytes() for s in keys], pa.binary()),
                ],
                ["row", "digest", "small", "keys"],
            )

    schema = "row bigint, digest binary, small binary, keys binary"
    return rows.select("row", "text").mapInArrow(read, schema)


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """A column of binaries of one length as the rows of a matrix."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(len(column), -1)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of sorted rows, and where each group begins."""
    rest: pa.Table | None = None

    def starts(t: pa.Table) -> np.ndarray:
        keys = np.stack([t.column(c).to_numpy() for c in _GROUP])
        change = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        return np.concatenate([[0], np.flatnonzero(change) + 1])

    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = now if rest is None else pa.concat_tables([rest, now])
        first = starts(now)
        if first[-1]:
            yield now.slice(0, first[-1]), first
        rest = now.slice(first[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def _own_pairs(
    small: np.ndarray, keys: np.ndarray, band: int, blocks: np.ndarray, cross: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one group's members that it owns and that are not pruned, in chunks."""
    n = len(small)
    rows = max(1, _PAIRS // n)
    for top in range(0, n, rows):
        a, b = np.divmod(np.arange(min(rows, n - top) * n), n)
        a += top
        use = a < b
        if cross:
            use &= blocks[a] != blocks[b]
        a, b = a[use], b[use]
        if band and len(a):
            earlier = (keys[a, :band] == keys[b, :band]).any(axis=1)
            a, b = a[~earlier], b[~earlier]
        matches = np.zeros(len(a), np.int32)
        for step, least in enumerate(_LEAST):
            part = slice(step * STEP, (step + 1) * STEP)
            matches = matches + (small[a, part] == small[b, part]).sum(axis=1, dtype=np.int32)
            alive = matches >= least
            a, b, matches = a[alive], b[alive], matches[alive]
            if not len(a):
                break
        if len(a):
            yield a, b


def _groups(table: pa.Table, first: np.ndarray):
    """Each group of a table: its place and what its pairs are found with."""
    small = _matrix(table.column("small"), np.uint8)
    keys = _matrix(table.column("keys"), np.int32)
    band, low, high, block = (
        table.column(c).to_numpy() for c in ("band", "low", "high", "block")
    )
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        cross = low[a] != high[a]
        yield a, b, _own_pairs(small[a:b], keys[a:b], int(band[a]), block[a:b], cross)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each group that have a pair left there."""
    for table, first in _whole_groups(batches):
        keep = np.zeros(table.num_rows, bool)
        for a, _, pairs in _groups(table, first):
            for left, right in pairs:
                keep[a + left] = True
                keep[a + right] = True
        yield from table.select([*_GROUP, "block", "rep"]).filter(pa.array(keep)).to_batches()


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets of a group have in common."""
    n = len(sets)
    _, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    common = counts > 1  # a shingle of one set alone is shared by no two
    column = np.cumsum(common) - 1
    use = common[at]
    at, owner = column[at[use]], owner[use]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    out = np.zeros((n, n), np.float64)
    width = 4096
    for base in range(0, int(common.sum()), width):
        a, b = np.searchsorted(at, [base, base + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], at[a:b] - base] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links of each group: per member its number, and the least member it is tied to."""
    over, under = THRESHOLD
    for table, first in _whole_groups(batches):
        reps, copies = (table.column(c).to_numpy() for c in ("rep", "copies"))
        shingles = table.column("shingles")
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a, b, pairs in _groups(table, first):
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in shingles.slice(a, b - a)]
            size = np.array([len(s) for s in sets])
            shared = _shared(sets)
            linked = np.zeros((b - a, b - a), bool)
            for left, right in pairs:
                both = shared[left, right]
                yes = both * (over + under) >= over * (size[left] + size[right])
                linked[left[yes], right[yes]] = True
            linked |= linked.T
            have = np.flatnonzero(linked.any(axis=1))
            if not len(have):
                continue
            number = linked @ copies[a:b]
            root = reps[a:b].copy()
            while True:
                near = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1)
                new = np.minimum(root, near)
                if (new == root).all():
                    break
                root = new
            out.append((reps[a:b][have], root[have], number[have]))
        if out:
            columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
            yield pa.record_batch(columns, ["rep", "root", "links"])


def _sets_of(rows: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text", _BATCH):
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"))]
            yield pa.record_batch(
                [batch.column("row"), pa.array(sets, pa.binary())], ["rep", "shingles"]
            )

    return rows.select("row", "text").mapInArrow(read, "rep bigint, shingles binary")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "rep")


def links(rows: DataFrame) -> DataFrame:
    """(row, root, n_links) of every row of a written table (row, text).

    ``root`` is the least row of the group a row is linked to, directly or through others.
    """
    signed = staged(signatures(rows), "jaccard-signatures")
    classes = staged(
        signed.groupBy("digest").agg(
            F.min("row").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("small").alias("small"),  # equal sets have equal values
            F.first("keys").alias("keys"),
        ),
        "jaccard-classes",
    )
    key = F.substring("keys", 4 * F.col("band") + 1, F.lit(4))
    bands = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    at = classes.select("rep", "keys", bands).select(
        "rep", "band", F.conv(F.hex(key), 16, 10).cast("bigint").alias("key")
    )
    shared = at.groupBy("band", "key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    in_buckets = (
        shuffled_join(at, shared, ["band", "key"])
        .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
        .select("rep", "band", "key", block.alias("block"), "blocks")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    groups = in_buckets.select("rep", "band", "key", "block", other).select(
        "rep",
        "band",
        "key",
        "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )
    values = classes.select("rep", "small", "keys")
    members = staged(
        _grouped(shuffled_join(groups, values, "rep")).mapInArrow(
            _members, "band int, key bigint, low int, high int, block int, rep bigint"
        ),
        "jaccard-members",
    )
    wanted = staged(members.select(F.col("rep").alias("row")).distinct(), "jaccard-wanted")
    if wanted.count() > FEW:
        sets = _sets_of(shuffled_join(rows, wanted, "row", "left_semi"))
    else:
        sets = _sets_of(rows.join(wanted, "row", "left_semi"))
    full = shuffled_join(members, classes.select("rep", "small", "keys", "copies"), "rep")
    full = shuffled_join(full, sets, "rep")
    found = staged(
        _grouped(full).mapInArrow(_links, "rep bigint, root bigint, links bigint"),
        "jaccard-links",
    )
    roots = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per_class = shuffled_join(classes.select("digest", "rep", "copies"), linked, "rep", "left")
    per_class = shuffled_join(per_class, roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest",
        F.coalesce("root", "rep").alias("root"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    # Copies of one text may be a third of all rows; adaptive execution splits such a join.
    classed = shuffled_join(signed.select("row", "digest"), per_class, "digest").drop("digest")
    return shuffled_join(rows.select("row"), classed, "row", "left").select(
        "row",
        F.coalesce("root", "row").alias("root"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Each document's class (the least doc_id of its group) and its number of links."""
    rows = numbered(docs, ["doc_id", "text"], "jaccard-docs")
    found = staged(links(rows), "jaccard-found")
    named = staged(shuffled_join(rows.select("row", "doc_id"), found, "row"), "jaccard-named")
    least = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return shuffled_join(named, least, "root").select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, the one of least doc_id, with its own columns."""
    rows = numbered(docs, ["doc", "doc_id", "text"], "jaccard-docs")
    found = staged(links(rows.select("row", "text")), "jaccard-found")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    firsts = (
        rows.select("row", "doc_id")
        .join(found, "row")
        .groupBy("root")
        .agg(F.min(order).alias("first"))
        .select("first.row")
    )
    # Fewer documents go than stay, so the removed rows are the side to join with.
    removed = staged(found.select("row").join(firsts, "row", "left_anti"), "jaccard-removed")
    return rows.join(removed, "row", "left_anti").select("doc.*")
