"""Approximate nearest neighbours by cosine: a hash-prefix forest (LSH forest).

Every tree hashes a vector to a long bit string: the signs of its projections on ``BITS`` random
hyperplanes, drawn once from ``SEED`` (nothing is fitted on the data). Sorted by these strings, the
vectors sharing a prefix with a query lie together; the longer the shared prefix, the nearer they
tend to be. A query descends each tree to its longest prefix match, then all trees ascend in step
(shorter and shorter prefixes, a bit at a time) until the buckets of all trees together hold
``SHARE`` of all classes (``CANDIDATES`` at least). Those candidates are scored exactly by cosine on the original
vectors, in double precision, and the best ``K`` returned, ties to the smaller vec_id.

As Spark jobs: the sorted arrays of a tree are its buckets at every prefix length, counted once
at full length and then each length from the one below (the counts shrink as lengths do); "descend, then ascend in step" is the greatest prefix
length at which the counts of the query's buckets, summed over trees, reach that number, taken
by an aggregation per query. Candidates are looked up in blocks: the query classes and all classes
are packed into blocks of bounded size, each pair of blocks is one row of a cross join, and a task
marks a pair of blocks' candidates tree by tree (equal prefixes at the query's length), so that no
pair of vectors ever becomes a row. It hands on the ``K + 1`` best classes a query has there.
Nothing is capped: a bucket is taken whole, so a query whose buckets hold
fewer vectors than asked gets them all, and at length 0 every vector is a candidate.

Identical vectors are one class before any of this (an aggregation by the vector): a vector that
a third of all rows hold is one point of the forest, its bucket does not grow with its copies,
and its members come back only as the ``K + 1`` smallest vec_ids, taken by a window over salted
parts of the class. Projections and scores run in Arrow batches with numpy. Broadcast by hand are
the hyperplanes only (``TREES * BITS`` times the vector length).

Recall against brute force (tests and README): the embeddings given are nearly isotropic, so
prefixes discriminate weakly and the share is what buys recall; the comparisons per query grow
with the table (those of all queries with its square, at some tens of nanoseconds each).

Queries are the rows whose vec_id is divisible by ``EVERY``, candidates all other kept rows.
Defined cases: rows with a null vec_id, a null, empty or zero vector, or a null or non-finite
component take no part; nor does a vector whose length differs from that of the smallest vec_id.
Rows of one vec_id are one row, with the least of their vectors. No kept row, or no query: an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumflow.llm.codebooks import finite
from forumflow.llm.staging import staged

TREES = 64
BITS = 16
CANDIDATES = 256
# Bucket entries of all trees together (a class counted once per tree that holds it), as a share of
# all classes, at which the ascent stops. The embeddings here are nearly isotropic (nearest cosine
# about 0.37), so a fixed number would lose recall as the table grows.
SHARE = 1.0
K = 5
EVERY = 50
SEED = 20240611
SALTS = 64
# Classes and query classes packed into one row, and the most bytes of vectors in it.
BLOCK, QUERY_BLOCK = 2048, 256
BLOCK_BYTES = 4 << 20
# Above the rounding of a cosine however summed: what comes within it of the best is scored exactly.
MARGIN = 1e-9
# Pairs scored at a time, and found rows held by a task before only the best are kept.
CHUNK = 1 << 14
HELD = 1 << 17


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def _hyperplanes(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((TREES * BITS, dim))


def _hashes(planes):
    """mapInPandas function: each class with its TREES bit strings as numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        for batch in batches:
            if not len(batch):
                continue
            v = np.stack(batch["v"].to_numpy())
            signs = (v @ planes.value.T > 0).reshape(len(batch), TREES, BITS)
            keys = (signs * weights).sum(-1)
            yield pd.DataFrame({"rep": batch["rep"].to_numpy(), "v": batch["v"], "keys": list(keys)})

    return run


def _packed(size: int, names: list[str], types: list):
    """mapInPandas function: rows packed by up to ``size``, the values of each column as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame(columns=names)
        for batch in batches:
            held = pd.concat([held, batch[names]], ignore_index=True) if len(held) else batch[names]
            while len(held) >= size:
                yield pack(held.iloc[:size])
                held = held.iloc[size:]
        if len(held):
            yield pack(held)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        values = {n: np.stack(rows[n].to_numpy()).astype(t).tobytes() for n, t in zip(names, types)}
        return pd.DataFrame({n: [v] for n, v in values.items()})

    return run


def _blocks(rows: DataFrame, size: int, parts: int, types: dict) -> DataFrame:
    """The rows in blocks of up to ``size``, dealt over ``parts`` partitions."""
    schema = ", ".join(f"{c} binary" for c in types)
    spread = rows.select(*types).repartition(parts)
    return spread.mapInPandas(_packed(size, list(types), list(types.values())), schema)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Cosines of rows of two matrices, summed in index order, as SQL's dot product."""
    dot = np.cumsum(q * c, axis=1)[:, -1]
    norms = np.sqrt(np.cumsum(q * q, axis=1)[:, -1]) * np.sqrt(np.cumsum(c * c, axis=1)[:, -1])
    return dot / norms


def _candidates(levels: np.ndarray, qkeys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which classes share, in any tree, a query's prefix of its level."""
    found = np.ones((len(levels), len(keys)), bool)
    for level in np.unique(levels[levels > 0]):
        mine = np.flatnonzero(levels == level)
        asked = (qkeys[mine] >> (BITS - level)).T.astype(np.uint16, order="C")
        there = (keys >> (BITS - level)).T.astype(np.uint16, order="C")
        hit = np.zeros((len(mine), len(keys)), bool)
        for tree in range(TREES):
            hit |= asked[tree][:, None] == there[tree][None, :]
        found[mine] = hit
    return found


def _best(found: pd.DataFrame) -> pd.DataFrame:
    """The K + 1 best classes of each query class, ties to the smaller; NaN counts as greatest."""
    order = np.where(np.isnan(found["score"]), -np.inf, -found["score"])
    place = np.lexsort((found["crep"].to_numpy(), order, found["qrep"].to_numpy()))
    return found.iloc[place].groupby("qrep", sort=False).head(K + 1)


def _matches(dim: int):
    """mapInPandas function over pairs of blocks: best candidates of each query class by cosine."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            for pair in batch.itertuples(index=False):
                held.append(matched(pair))
                n += len(held[-1])
                if n > HELD:
                    held = [_best(pd.concat(held, ignore_index=True))]
                    n = len(held[0])
                    if n > HELD // 2:
                        yield held.pop()
                        n = 0
        if held:
            yield _best(pd.concat(held, ignore_index=True))

    def matched(pair) -> pd.DataFrame:
        creps, qreps = np.frombuffer(pair.rep, np.int64), np.frombuffer(pair.qrep, np.int64)
        c, q = (np.frombuffer(x, np.float64).reshape(-1, dim) for x in (pair.v, pair.qv))
        keys, qkeys = (np.frombuffer(x, np.int32).reshape(-1, TREES) for x in (pair.keys, pair.qkeys))
        found = _candidates(np.frombuffer(pair.level, np.int32), qkeys, keys)
        with np.errstate(all="ignore"):
            norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1)[None, :]
            near = (q @ c.T) / norms
            near[np.isnan(near)] = np.inf
            near[~found] = -np.inf
            if len(creps) > K + 1:
                least = np.partition(near, len(creps) - K - 1, axis=1)[:, len(creps) - K - 1]
                found &= ~(near < least[:, None] - MARGIN)
            i, j = np.nonzero(found)
            scores = [
                _exact(q[i[a : a + CHUNK]], c[j[a : a + CHUNK]]) for a in range(0, len(i), CHUNK)
            ]
        score = np.concatenate(scores) if scores else np.zeros(0)
        return _best(pd.DataFrame({"qrep": qreps[i], "crep": creps[j], "score": score}))

    return run


def kept_rows(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v) of every row that takes part, v in double precision."""
    v = F.transform(vector, lambda x: x.cast("double"))
    good = rows.where(F.col("vec_id").isNotNull() & finite(vector)).select("vec_id", v.alias("v"))
    good = good.where(_dot(F.col("v"), F.col("v")) > 0)
    first = good.orderBy("vec_id", "v").select(F.size("v").alias("n")).limit(1).collect()
    if not first:
        return None
    one = good.groupBy("vec_id").agg(F.min("v").alias("v"))
    return one.where(F.size("v") == first[0]["n"])


def nearest(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the K nearest found for every query row."""
    spark = rows.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    kept = kept_rows(rows, vector)
    if kept is None:
        return spark.createDataFrame([], schema)
    kept = staged(kept, "ann-vectors")
    dim = kept.select(F.size("v").alias("n")).first()["n"]

    # Classes of identical vectors; each member knows its class's smallest vec_id.
    classes = staged(
        kept.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size")),
        "ann-classes",
    )
    members = kept.join(classes.select("v", "rep"), "v").select("vec_id", "rep")
    salted = Window.partitionBy("rep", "salt").orderBy("vec_id")
    firsts = (
        members.withColumn("salt", F.pmod("vec_id", F.lit(SALTS)))
        .withColumn("i", F.row_number().over(salted))
        .where(F.col("i") <= K + 1)
        .groupBy("rep")
        .agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, K + 1).alias("firsts"))
    )  # at most (K + 1) * SALTS ids a class before the slice

    planes = spark.sparkContext.broadcast(_hyperplanes(dim))
    hashed = staged(
        classes.select("rep", "v").mapInPandas(
            _hashes(planes), "rep bigint, v array<double>, keys array<bigint>"
        ),
        "ann-hashes",
    )
    leaves = hashed.select("rep", F.posexplode("keys").alias("tree", "key"))
    # Bucket sizes at every prefix length, each length aggregated from the one below.
    level = leaves.groupBy("tree", F.col("key").alias("prefix")).agg(
        F.count(F.lit(1)).alias("size")
    )
    sizes = [level.withColumn("level", F.lit(BITS))]
    for n in range(BITS - 1, -1, -1):
        level = level.groupBy("tree", F.shiftright("prefix", 1).alias("prefix")).agg(
            F.sum("size").alias("size")
        )
        sizes.append(level.withColumn("level", F.lit(n)))
    sizes = staged(reduce(DataFrame.unionByName, sizes), "ann-sizes")

    n_classes = classes.count()
    want = max(CANDIDATES, math.ceil(SHARE * n_classes))
    queries = members.where(F.col("vec_id") % EVERY == 0).select(
        F.col("vec_id").alias("query_id"), F.col("rep").alias("qrep")
    )
    asked = queries.select("qrep").distinct()
    mine = (
        leaves.join(asked, leaves["rep"] == asked["qrep"])
        .select("qrep", "tree", F.explode(F.sequence(F.lit(0), F.lit(BITS))).alias("level"), "key")
        .select("qrep", "tree", "level", F.expr(f"shiftright(key, {BITS} - level)").alias("prefix"))
    )
    found = (
        mine.join(sizes, ["tree", "level", "prefix"])
        .groupBy("qrep", "level")
        .agg(F.sum(F.col("size") - 1).alias("others"))
    )
    depth = found.groupBy("qrep").agg(
        F.coalesce(F.max(F.when(F.col("others") >= want, F.col("level"))), F.lit(0)).alias("level")
    )
    asking = staged(
        hashed.join(depth, hashed["rep"] == depth["qrep"]).select(
            "qrep", "level", F.col("v").alias("qv"), F.col("keys").alias("qkeys")
        ),
        "ann-queries",
    )
    most = max(1, BLOCK_BYTES // (8 * dim))
    size, q_size = min(BLOCK, most), min(QUERY_BLOCK, most)
    cores = spark.sparkContext.defaultParallelism
    n_blocks, n_q_blocks = -(-n_classes // size), -(-asking.count() // q_size)
    types = {"rep": np.int64, "v": np.float64, "keys": np.int32}
    q_types = {"qrep": np.int64, "level": np.int32, "qv": np.float64, "qkeys": np.int32}
    blocks = _blocks(hashed, size, max(cores, n_blocks // 16, 1), types)
    q_blocks = _blocks(asking, q_size, max(n_q_blocks // 64, 1), q_types)
    pairs = staged(blocks, "ann-blocks").crossJoin(staged(q_blocks, "ann-query-blocks"))
    schema = "qrep bigint, crep bigint, score double"
    first = Window.partitionBy("qrep").orderBy(F.col("score").desc(), F.col("crep"))
    scored = (
        staged(pairs.mapInPandas(_matches(dim), schema), "ann-scores")
        .withColumn("i", F.row_number().over(first))
        .where(F.col("i") <= K + 1)
        .drop("i")
    )  # each class has a member besides the query, but the query's own may
    expanded = (
        queries.join(scored, "qrep")
        .join(firsts.withColumnRenamed("rep", "crep"), "crep")
        .select("query_id", "score", F.explode("firsts").alias("vec_id"))
        .where(F.col("vec_id") != F.col("query_id"))
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        expanded.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= K)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
