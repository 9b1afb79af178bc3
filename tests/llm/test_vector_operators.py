"""Vector codes and nearest neighbours on small made-up embeddings, against plain numpy."""

import hashlib
import math
import random

import numpy as np
import pytest

from forumflow.llm import codebooks

ROWS = "vec_id bigint, embedding array<float>, label int, code string"


def vectors(n, dim=32, seed=3, repeat=0):
    r = np.random.default_rng(seed)
    out = [(i, [float(x) for x in r.normal(0, 0.2, dim).astype(np.float32)], int(i % 3)) for i in range(n)]
    for k in range(repeat):  # copies of one vector, a hot cell
        out.append((n + k, out[0][1], 1))
    return out


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """Plain k-means of integer parts, as the contract states it."""
    kept = [
        (v, e, l)
        for v, e, l in rows
        if v is not None and e and all(x is not None and math.isfinite(x) for x in e)
        and len(e) % parts == 0
    ]
    kept.sort(key=lambda r: (r[0], r[1]))
    if not kept:
        return {}, ""
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    q = np.array([[math.floor(np.float64(np.float32(x)) * 256) for x in e] for _, e, _ in kept], np.int64)
    w = dim // parts
    x = q.reshape(len(kept), parts, w)
    books = [x[: min(entries, len(kept)), p].copy() for p in range(parts)]

    def assign():
        idx = np.zeros((len(kept), parts), int)
        dist = np.zeros((len(kept), parts), np.int64)
        for p in range(parts):
            d = ((x[:, p, None, :] - books[p][None]) ** 2).sum(-1)
            idx[:, p] = d.argmin(1)
            dist[:, p] = d.min(1)
        return idx, dist

    for _ in range(rounds):
        idx, _ = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                mine = x[idx[:, p] == j, p]
                if len(mine):
                    books[p][j] = np.floor_divide(mine.sum(0), len(mine))
    idx, dist = assign()
    text = ",".join(str(v) for p in range(parts) for e in books[p] for v in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    error = dist.sum(1)
    by_label = {}
    for (_, _, l), err in zip(kept, error):
        by_label[l] = by_label.get(l, 0) + int(err)
    out = {}
    for (v, _, l), i, err in zip(kept, idx, error):
        out.setdefault(v, []).append(("".join(f"{j:02x}" for j in i), int(err), by_label[l]))
    return out, digest


def spark_codes(spark, rows, schema="vec_id bigint, embedding array<float>, label int"):
    got = codebooks.compressed_embeddings(spark.createDataFrame(rows, schema)).collect()
    out = {}
    for r in got:
        out.setdefault(r["vec_id"], []).append((r["code"], r["error"], r["label_error"]))
    return {k: sorted(v) for k, v in out.items()}, {r["codebooks_sha256"] for r in got}


@pytest.mark.parametrize("n,repeat", [(10, 0), (150, 40)])
def test_codes_equal_plain_kmeans(spark, n, repeat):
    rows = vectors(n, repeat=repeat)
    want, digest = brute_codes(rows)
    got, digests = spark_codes(spark, rows)
    assert got == {k: sorted(v) for k, v in want.items()}
    assert digests == {digest}


def test_odd_rows_are_dropped_or_kept_as_stated(spark):
    rows = vectors(70)
    rows += [
        (1000, None, 1),
        (1001, [], 1),
        (1002, [float("nan")] * 32, 1),
        (1003, [float("inf")] + [0.0] * 31, 1),
        (1004, [None] + [0.0] * 31, 1),
        (1005, [0.1] * 48, 1),  # a multiple of 16, but not the first vector's length
        (1006, [0.1] * 20, 1),
        (None, [0.1] * 32, 1),
        (5, rows[5][1], None),  # a repeated id, a null label
        (1007, [1e6] * 32, None),  # far away
    ]
    want, digest = brute_codes(rows)
    got, digests = spark_codes(spark, rows)
    assert got == {k: sorted(v) for k, v in want.items()}
    assert digests == {digest}
    assert not set(got) & {1000, 1001, 1002, 1003, 1004, 1005, 1006, None}
    assert len(got[5]) == 2


def test_empty_and_clashing_columns(spark):
    empty, _ = spark_codes(spark, [])
    assert empty == {}
    rows = [(v, e, l, "x") for v, e, l in vectors(20)]
    got = codebooks.compressed_embeddings(spark.createDataFrame(rows, ROWS)).collect()
    assert len(got) == 20 and "code" in got[0].asDict()


def test_pruning_never_drops_the_nearest():
    # The least distance to a box never exceeds, and the greatest never falls short of, any
    # point's distance within it; so an entry beaten everywhere is never the nearest.
    r = random.Random(1)
    for _ in range(2000):
        cell = [r.randint(-5, 5) for _ in range(4)]
        point = [c * codebooks.CELL + r.randint(0, codebooks.CELL - 1) for c in cell]
        e = [r.randint(-200, 200) for _ in range(4)]
        d = sum((a - b) ** 2 for a, b in zip(point, e))
        lo = sum(max(c * 32 - a, a - (c * 32 + 31), 0) ** 2 for c, a in zip(cell, e))
        hi = sum(max(abs(a - c * 32), abs(a - c * 32 - 31)) ** 2 for c, a in zip(cell, e))
        assert lo <= d <= hi


from forumflow.llm import neighbours  # noqa: E402

ANN = "vec_id bigint, embedding array<float>, label int"


def brute_nearest(rows, every=50, k=5):
    kept = {}
    for v, e, _ in rows:
        if v is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        x = np.array(e, np.float32).astype(np.float64)
        if not (x * x).sum() > 0:
            continue
        kept[v] = min(kept.get(v, list(x)), list(x))
    if not kept:
        return {}
    dim = len(kept[min(kept)])
    kept = {v: np.array(x) for v, x in kept.items() if len(x) == dim}
    out = {}
    for q in sorted(v for v in kept if v % every == 0):
        a = kept[q]
        scored = sorted(
            (-(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), v) for v, b in kept.items() if v != q
        )
        out[q] = [v for _, v in scored[:k]]
    return out


def spark_nearest(spark, rows):
    got = neighbours.nearest(spark.createDataFrame(rows, ANN)).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out, got


def test_nearest_recall_against_brute_force(spark):
    rows = vectors(1500, dim=16, seed=9)
    want = brute_nearest(rows)
    got, raw = spark_nearest(spark, rows)
    assert set(got) == set(want)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    assert all(len(v) == 5 for v in got.values())
    assert [r["rank"] for r in raw if r["query_id"] == 0] == [1, 2, 3, 4, 5]


def test_nearest_copies_ties_and_odd_rows(spark):
    rows = vectors(120, dim=16, seed=4)
    copy = rows[7][1]
    rows += [(1000 + i, copy, 0) for i in range(60)]  # a hot vector, and 1050 is a query in it
    rows += [
        (2000, None, 1),
        (2001, [], 1),
        (2002, [0.0] * 16, 1),
        (2003, [float("nan")] * 16, 1),
        (2004, [None] * 16, 1),
        (2050, [0.1] * 8, 1),  # another length: takes no part, though a query
        (None, copy, 1),
        (50, rows[50][1], 2),  # a repeated row
    ]
    want = brute_nearest(rows)
    got, raw = spark_nearest(spark, rows)
    assert got == want  # small: the forest reaches every class
    assert got[1050] == [7, 1000, 1001, 1002, 1003]  # equal scores go to smaller vec_ids
    assert 2050 not in got and not {r["vec_id"] for r in raw} & {2000, 2001, 2002, 2003, 2004, 2050}


def test_nearest_few_candidates_and_empty(spark):
    assert spark_nearest(spark, [])[0] == {}
    rows = [(0, [1.0, 0.0], 0), (3, [0.0, 1.0], 0), (100, [1.0, 1.0], 0), (7, [0.5, 0.4], 0)]
    got, _ = spark_nearest(spark, rows)
    assert got == brute_nearest(rows) and len(got[0]) == 3


def test_nearest_in_small_blocks_without_a_row_for_each_pair(spark, monkeypatch):
    rows = vectors(1500, dim=16, seed=9)
    want, _ = spark_nearest(spark, rows)
    counts = {}

    def counted(table, name):
        out = staged(table, name)
        counts[name] = out.count()
        return out

    staged = neighbours.staged
    monkeypatch.setattr(neighbours, "staged", counted)
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    got, _ = spark_nearest(spark, rows)
    assert got == want and len(got) == 30
    # At most the best six of each query a task, where a task has a block of classes or more.
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    assert counts["ann-scores"] <= tasks * 30 * 6
    assert counts["ann-scores"] < 30 * 1500 / 10


def test_block_matches_equal_plain_comparison(monkeypatch):
    import pandas as pd

    r = np.random.default_rng(5)
    dim, n, nq = 8, 90, 11
    v = r.normal(0, 1, (n, dim))
    v[40:60] = v[3] * np.arange(1, 21)[:, None]  # one direction: ties but for rounding
    keys = r.integers(0, 1 << neighbours.BITS, (n, neighbours.TREES))
    level = r.integers(0, 12, nq)
    monkeypatch.setattr(neighbours, "CHUNK", 13)
    monkeypatch.setattr(neighbours, "HELD", 60)
    whole = pd.DataFrame({"rep": np.arange(n), "v": list(v), "keys": list(keys)})
    asked = pd.DataFrame(
        {"qrep": np.arange(nq), "level": level, "qv": list(v[:nq]), "qkeys": list(keys[:nq])}
    )
    types = {"rep": np.int64, "v": np.float64, "keys": np.int32}
    q_types = {"qrep": np.int64, "level": np.int32, "qv": np.float64, "qkeys": np.int32}

    def blocks(rows, size, types):
        pack = neighbours._packed(size, list(types), list(types.values()))
        return pd.concat(pack(iter([rows.iloc[:50], rows.iloc[50:50], rows.iloc[50:]])))

    pairs = blocks(whole, 32, types).merge(blocks(asked, 4, q_types), how="cross")
    assert len(pairs) == 9
    out = pd.concat(neighbours._matches(dim)(iter([pairs.iloc[:5], pairs.iloc[5:]])))
    for q in range(nq):
        shift = neighbours.BITS - level[q]
        near = ((keys >> shift) == (keys[q] >> shift)).any(1)
        scores = neighbours._exact(np.repeat(v[q : q + 1], n, 0), v)
        best = sorted((-scores[i], i) for i in np.flatnonzero(near))[: neighbours.K + 1]
        mine = out[out["qrep"] == q]
        got = sorted(zip(-mine["score"], mine["crep"]))[: neighbours.K + 1]
        assert got == best
