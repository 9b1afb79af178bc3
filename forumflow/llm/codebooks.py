"""Vector code compression: product codes by rounds of k-means with memoised grid cells.

Every kept vector becomes integers ``floor(256 * x)`` and is cut into ``PARTS`` equal consecutive
parts. Each part position has a codebook of ``ENTRIES`` entries, started from that part of the
vectors with the smallest ids. A round assigns every part to its codebook's nearest entry (squared
Euclidean distance, ties to the lower index) and replaces each entry by the componentwise
``floor(sum / count)`` of its parts; entries nobody chose stay. After ``ROUNDS`` rounds parts are
assigned once more, and that gives the codes.

How the nearest entry is found (the method): the integer space of a part is cut into a coarse grid
of ``CELL`` units a side. Every part hashes to its cell. For each distinct (part position, cell),
computed once per round and shared by all parts in it, an entry is kept as a candidate unless it
is dominated across the cell's box: its least distance to the box exceeds the greatest distance
to the box of some other entry. Only candidates are evaluated exactly. A dominated entry is
farther than another entry from every point of the box, so the pruning never changes a result,
ties included (an entry tying the threshold is kept).

At scale: all of it is DataFrame expressions (higher-order functions on arrays, joins and
aggregates); no Python runs in tasks. The codebooks (``PARTS * ENTRIES`` entries of the part's
width) are the only thing that reaches the driver. The table of cells grows with the data, but
only up to the number of distinct cells; it is broadcast when a count shows it small
(``BROADCAST_CELLS``) and joined by a shuffle otherwise, where adaptive execution splits a cell
that a third of all parts fall into. Updates are sums, combined in each task before the exchange,
so a hot entry arrives as one row per task. The parts are written to the shared scratch folder
once, which cuts the lineage for the rounds.

Defined cases: a row whose vector is null, empty, holds a null or non-finite component, or whose
length is not a multiple of ``PARTS`` or differs from that of the first kept vector (smallest
vec_id) is dropped. A null vec_id is dropped. Repeated rows are kept, one output row each; for
the starting entries rows are ordered by vec_id, then by the vector. With fewer than ``ENTRIES``
kept vectors each codebook has as many entries as vectors. A null label groups with the null
labels. No kept row: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from forumflow.llm.staging import staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
CELL = 32
BROADCAST_CELLS = 200_000


def finite(vector: str) -> Column:
    """True for a non-empty vector of non-null finite components."""
    ok = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ok


def kept_vectors(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """Kept rows as (row, vec_id, label, q) with integer components, and the vector length."""
    good = rows.where(F.col("vec_id").isNotNull() & finite(vector)).where(
        F.size(vector) % PARTS == 0
    )
    first = good.orderBy("vec_id", vector).select(F.size(vector).alias("n")).limit(1).collect()
    if not first:
        return None, 0
    dim = first[0]["n"]
    q = F.transform(vector, lambda x: F.floor(x.cast("double") * 256)).alias("q")
    label = F.col("label") if "label" in rows.columns else F.lit(None).cast("int")
    kept = good.where(F.size(vector) == dim).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", label.alias("label"), q
    )
    return staged(kept, "codebook-vectors"), dim


def _distance(a: Column, b: Column, width: int) -> Column:
    return sum(((a[i] - b[i]) * (a[i] - b[i]) for i in range(width)), F.lit(0).cast("long"))


def _box_bounds(e: Column, cell: Column, width: int) -> tuple[Column, Column]:
    """Least and greatest squared distance from entry ``e`` to the integer box of ``cell``."""
    least, most = F.lit(0).cast("long"), F.lit(0).cast("long")
    for i in range(width):
        lo, hi = cell[i] * CELL, cell[i] * CELL + (CELL - 1)
        gap = F.greatest(lo - e[i], e[i] - hi, F.lit(0).cast("long"))
        far = F.greatest(F.abs(e[i] - lo), F.abs(e[i] - hi))
        least, most = least + gap * gap, most + far * far
    return least, most


def _cells(parts: DataFrame, books: DataFrame, width: int) -> DataFrame:
    """Candidate entries of every distinct (p, cell): those not dominated across its box."""
    cells = parts.select("p", "cell").distinct()
    entries = books.groupBy("p").agg(
        F.collect_list(F.struct("idx", "e")).alias("entries")
    )  # at most ENTRIES per part position
    scored = cells.join(F.broadcast(entries), "p").select(
        "p",
        "cell",
        F.transform(
            "entries",
            lambda x: F.struct(
                x["idx"].alias("idx"),
                x["e"].alias("e"),
                *(
                    b.alias(n)
                    for n, b in zip(("least", "most"), _box_bounds(x["e"], F.col("cell"), width))
                ),
            ),
        ).alias("scored"),
    )
    threshold = F.array_min(F.transform("scored", lambda x: x["most"]))
    return scored.select(
        "p",
        "cell",
        F.transform(
            F.filter("scored", lambda x: x["least"] <= threshold),
            lambda x: F.struct(x["idx"].alias("idx"), x["e"].alias("e")),
        ).alias("cands"),
    )


def _assign(parts: DataFrame, books: DataFrame, width: int) -> DataFrame:
    """Every part with the index and squared distance of its nearest entry."""
    cells = _cells(parts, books, width)
    if cells.count() <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    joined = parts.join(cells, ["p", "cell"])
    start = F.struct(F.lit(None).cast("long").alias("d"), F.lit(-1).alias("idx"))

    def better(best: Column, c: Column) -> Column:
        d = _distance(F.col("x"), c["e"], width)
        wins = best["d"].isNull() | (d < best["d"]) | ((d == best["d"]) & (c["idx"] < best["idx"]))
        return F.when(wins, F.struct(d.alias("d"), c["idx"].alias("idx"))).otherwise(best)

    best = F.aggregate("cands", start, better)
    return joined.select("row", "p", "x", best["idx"].alias("idx"), best["d"].alias("d"))


def _update(assigned: DataFrame, books: DataFrame, width: int) -> DataFrame:
    """Entries replaced by the floor of their parts' mean; unused entries stay."""
    sums = assigned.groupBy("p", "idx").agg(
        F.count(F.lit(1)).alias("c"), *(F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(width))
    )
    mean = F.array(
        *((F.col(f"s{i}") - F.pmod(F.col(f"s{i}"), F.col("c"))) / F.col("c") for i in range(width))
    ).cast(ArrayType(LongType()))
    moved = sums.select("p", "idx", mean.alias("moved"))
    return books.join(moved, ["p", "idx"], "left").select(
        "p", "idx", F.coalesce("moved", "e").alias("e")
    )


def _local(books: DataFrame) -> DataFrame:
    """A small codebook table brought to the driver and back, so that rounds do not stack plans."""
    rows = sorted((r["p"], r["idx"], list(r["e"])) for r in books.collect())
    schema = "p int, idx int, e array<bigint>"
    return books.sparkSession.createDataFrame(rows, schema)


def compress(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, list]:
    """Codes of every kept row and the final codebooks.

    Returns rows (row, vec_id, label, code string, error long) and the codebooks as sorted
    (part, entry, components) triples.
    """
    spark = rows.sparkSession
    kept, dim = kept_vectors(rows, vector)
    if kept is None:
        empty = "row bigint, vec_id bigint, label int, code string, error bigint"
        return spark.createDataFrame([], empty), []
    width = dim // PARTS
    parts = kept.select(
        "row",
        "vec_id",
        F.posexplode(
            F.array(*(F.slice("q", p * width + 1, width) for p in range(PARTS)))
        ).alias("p", "x"),
    ).select(
        "row",
        "vec_id",
        F.col("p").cast("int").alias("p"),
        "x",
        F.transform("x", lambda c: F.floor(c / CELL)).alias("cell"),
    )
    parts = staged(parts, "codebook-parts")
    first = (
        kept.select("row", "vec_id", "q")
        .orderBy("vec_id", "q", "row")
        .limit(ENTRIES)
        .select(F.col("row").alias("r"), "vec_id")
    )  # at most ENTRIES rows
    starts = [(r["r"], i) for i, r in enumerate(first.collect())]
    numbering = spark.createDataFrame(starts, "r bigint, idx int")
    books = _local(
        parts.join(F.broadcast(numbering), parts["row"] == numbering["r"]).select(
            "p", "idx", F.col("x").alias("e")
        )
    )
    for _ in range(ROUNDS):
        books = _local(_update(_assign(parts, books, width), books, width))
    final = _assign(parts, books, width)
    codes = final.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("p", "idx"))).alias("ps"),  # PARTS per row
        F.sum("d").alias("error"),
    )
    code = F.lower(
        F.concat_ws("", F.transform("ps", lambda s: F.lpad(F.hex(s["idx"]), 2, "0")))
    )
    out = kept.select("row", "vec_id", "label").join(
        codes.select("row", code.alias("code"), "error"), "row"
    )
    # Written once: the per-label sums and the rows both read it.
    return staged(out, "codebook-codes"), sorted((r["p"], r["idx"], list(r["e"])) for r in books.collect())


def codebook_digest(books: list) -> str:
    """sha256 of all entries' components by part, entry and position, comma-joined."""
    text = ",".join(str(v) for _, _, e in sorted(books) for v in e)
    return hashlib.sha256(text.encode()).hexdigest()


def compressed_embeddings(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Per kept row: vec_id, code, error, label_error and the codebooks' digest."""
    coded, books = compress(rows, vector)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return (
        coded.join(by_label, coded["label"].eqNullSafe(by_label["label"]))
        .select(
            coded["vec_id"],
            "code",
            F.col("error").cast("long").alias("error"),
            F.col("label_error").cast("long").alias("label_error"),
            F.lit(codebook_digest(books)).alias("codebooks_sha256"),
        )
    )
