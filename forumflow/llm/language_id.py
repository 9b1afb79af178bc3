"""Language identification by Bayesian fusion of evidence.

    log P(language | all) = log prior(address) + log P(text | language)
                            + log P(declared | language) + log P(suffix | language) + constant

* Text: a multinomial over hashed byte trigrams per language, fitted on at most ``SAMPLE`` texts of
  each declared language; every declared language is modelled. It is taken against a background in
  which all trigrams are equally likely. Long texts are tempered to the weight of ``FULL`` trigrams, as trigrams
  of one text are not independent.
* Declared language (of the markup, or the table's own column): how often a text that reads as a
  language declares each code, counted over all rows.
* Address suffix: likewise, how often each suffix occurs per language.
* Prior: shares of languages of a host, smoothed towards those of its domain, these towards those
  of the suffix, and these towards all rows. Each level is one grouped aggregation over all rows.

A row is accepted if its language reaches the posterior ``LEAST`` and explains the text no worse than
the background does; the posterior alone is shared out among the modelled languages, one of which
always comes nearest to a text of none.

Defined results: a text without letters has no text evidence and is undetermined ("und") and
rejected, null and empty texts among them; a null declaration or address is a value of its own that
weighs what it weighs elsewhere; if no row declares a language, none can be modelled, and texts with
letters are undetermined ("und", posterior 0) but accepted; equal rows are results of their own; with no rows there are none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumflow.llm.staging import batches_of, staged
from forumflow.llm.words import mix

SAMPLE = 2_000
BLOCK = 64  # languages whose counts are collected at a time
BITS = 16
UNSEEN = 0.5  # occurrences every trigram is given
FULL = 60
STRENGTH = 20.0  # rows a parent's shares weigh in its child's
LEAST = 0.5  # posterior a language must reach
_BATCH = 4 << 20
_SCORES = 1 << 20  # numbers of a batch of scores

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[0x41:0x5B] += 32
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the byte trigrams that hold a letter in the middle, the text of each, and letters
    per text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    raw = np.frombuffer(data, np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets)) if len(texts) else np.empty(0, int)
    letter = _LETTER[raw]
    counts = np.bincount(owner[letter], minlength=len(texts))
    if len(raw) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), counts
    folded = np.where(letter, _FOLD[raw], 0x20).astype(np.uint64)
    use = letter[1:-1] & (owner[:-2] == owner[2:])
    code = (folded[:-2] << np.uint64(16)) | (folded[1:-1] << np.uint64(8)) | folded[2:]
    return (mix(code[use]) >> np.uint64(64 - BITS)).astype(np.int64), owner[1:-1][use], counts


def languages(rows: DataFrame) -> dict[str, int]:
    """Every declared language with its number of rows, the most frequent first."""
    found = (
        rows.filter(F.col("declared").isNotNull() & (F.col("declared") != ""))
        .groupBy("declared")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    return {r["declared"]: r["n"] for r in sorted(found, key=lambda r: (-r["n"], r["declared"]))}


@dataclass(frozen=True)
class Model:
    """log P(trigram | language) less that of the background, by language.

    A trigram not seen in language k has ``base[k]``; those seen are ``code[first[k]:first[k + 1]]``
    and have as much more as ``gain`` says.
    """

    first: np.ndarray
    code: np.ndarray
    gain: np.ndarray
    base: np.ndarray

    def scores(self, code: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """Summed over the trigrams of each row, one column per language."""
        n = np.bincount(owner, minlength=rows)
        out = np.empty((rows, len(self.base)))
        for k, base in enumerate(self.base):
            own = slice(self.first[k], self.first[k + 1])
            gain = np.zeros(1 << BITS, np.float32)
            gain[self.code[own]] = self.gain[own]
            out[:, k] = np.bincount(owner, gain[code], rows) + n * base
        return out


def fit(rows: DataFrame, sizes: dict[str, int], sample: int = SAMPLE) -> Model:
    """The trigrams of every language, numbered as in ``sizes``."""
    if not sizes:
        return Model(np.zeros(1, np.int64), np.empty(0, np.uint16), np.empty(0, np.float32), np.empty(0))
    # An even part of each language, found by a hash of the row; about ``sample`` rows of each.
    large = [x for language, n in sizes.items() if n > sample for x in (language, sample / n)]
    share = F.lit(1.0)
    if large:
        share = F.coalesce(F.create_map(*map(F.lit, large))[F.col("declared")], share)
    picked = rows.filter(F.col("declared").isNotNull() & (F.col("declared") != "")).filter(
        F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < share * (1 << 20)
    )
    number = {language: i for i, language in enumerate(sizes)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(iter([batch]), "text", _BATCH):
                code, owner, _ = trigrams(part.column("text"))
                language = np.array([number[d] for d in part.column("declared").to_pylist()])
                at, n = np.unique(language[owner] * (1 << BITS) + code, return_counts=True)
                yield pa.record_batch(
                    [
                        pa.array((at >> BITS).astype(np.int32)),
                        pa.array((at & ((1 << BITS) - 1)).astype(np.int32)),
                        pa.array(n.astype(np.int64)),
                    ],
                    ["language", "code", "n"],
                )

    counts = staged(
        picked.select("text", "declared")
        .mapInArrow(count, "language int, code int, n bigint")
        .groupBy("language", "code")
        .agg(F.sum("n").alias("n")),
        "language-trigrams",
    )
    first, codes, gains, base = [0], [], [], []
    for low in range(0, len(sizes), BLOCK):  # at most BLOCK * 2**BITS rows at a time
        part = counts.filter((F.col("language") >= low) & (F.col("language") < low + BLOCK)).toArrow()
        language, code, n = (part[c].to_numpy() for c in ("language", "code", "n"))
        order = np.lexsort((code, language))
        codes.append(code[order].astype(np.uint16))
        gains.append(np.log1p(n[order] / UNSEEN).astype(np.float32))
        width = min(BLOCK, len(sizes) - low)
        first.extend((first[-1] + np.cumsum(np.bincount(language - low, minlength=width))).tolist())
        total = np.bincount(language - low, n, width) + UNSEEN * (1 << BITS)
        base.append(np.log(UNSEEN * (1 << BITS) / total))
    return Model(np.array(first), *map(np.concatenate, (codes, gains, base)))


def with_likelihood(rows: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """The ``keep`` columns, ``letters``, and ``text_log``: tempered log P(text | language) less
    that of the background."""
    # The trigrams seen in the samples: a few thousand numbers per language.
    shared = rows.sparkSession.sparkContext.broadcast(model)
    most = max(1, _SCORES // max(1, len(model.base)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches_of(batches, "text", _BATCH):
            for at in range(0, whole.num_rows, most):
                batch = whole.slice(at, most)
                code, owner, letters = trigrams(batch.column("text"))
                sums = shared.value.scores(code, owner, batch.num_rows)
                n = np.bincount(owner, minlength=batch.num_rows)
                weight = np.minimum(1.0, FULL / np.maximum(n, 1))
                flat = pa.array((sums * weight[:, None]).ravel())
                first = pa.array(np.arange(len(n) + 1) * sums.shape[1], pa.int32())
                yield pa.record_batch(
                    [
                        *[batch.column(c) for c in keep],
                        pa.array(letters.astype(np.int64)),
                        pa.ListArray.from_arrays(first, flat),
                    ],
                    [*keep, "letters", "text_log"],
                )

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "text").mapInArrow(
        read, f"{kinds}, letters bigint, text_log array<double>"
    )


def _counts(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """How many rows of each group read as each language: ``n``, an array."""
    each = rows.groupBy(*by, "best").agg(F.count(F.lit(1)).cast("double").alias("n"))
    some = F.collect_list(F.when(F.col("best").isNotNull(), F.struct("best", "n")))
    per = each.groupBy(*by).agg(F.map_from_entries(some).alias("some"))
    n = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.element_at("some", i), F.lit(0.0)))
    return per.select(*by, n.alias("n"))


def _totals(rows: DataFrame, k: int) -> list[float]:
    """How many rows read as each language."""
    found = {r["best"]: r["count"] for r in rows.groupBy("best").count().collect()}
    return [float(found.get(i, 0)) for i in range(k)]


def _likelihood(rows: DataFrame, column: str, totals: list[float]) -> DataFrame:
    """log P(value | language) for each value of a column, plus-one smoothed."""
    number = rows.agg(F.count_distinct(F.coalesce(F.col(column), F.lit("")))).first()[0] + 1
    below = F.array(*[F.lit(t + number) for t in totals])
    log = F.zip_with("n", below, lambda n, t: F.log((n + 1) / t))
    return _counts(rows, [column], len(totals)).select(column, log.alias(f"{column}_log"))


def _priors(rows: DataFrame, totals: list[float]) -> DataFrame:
    """log P(language | host), each level smoothed towards the one above."""
    k = len(totals)
    shares = F.array(*[F.lit((t + 1.0) / (sum(totals) + k)) for t in totals])
    levels = [["suffix"], ["suffix", "domain"], ["suffix", "domain", "host"]]
    above = None
    for by in levels:
        now = _counts(rows, by, k)
        if above is None:
            now = now.withColumn("up", shares)
        else:
            now = _join(now, above.withColumnRenamed("share", "up"), by[:-1])
        size = F.aggregate("n", F.lit(0.0), lambda a, x: a + x)
        share = F.zip_with("n", "up", lambda n, up: (n + STRENGTH * up) / (F.col("size") + STRENGTH))
        above = now.withColumn("size", size).select(*by, share.alias("share"))
    return above.select("host", "domain", "suffix", F.transform("share", lambda x: F.log(x)).alias("prior_log"))


def _join(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null."""
    renamed = right.select(*[F.col(c).alias(f"r_{c}") for c in by], *[c for c in right.columns if c not in by])
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    return left.join(renamed, on, how).drop(*[f"r_{c}" for c in by])


def fuse(measured: DataFrame, known: Sequence[str]) -> DataFrame:
    """Rows with ``text_log``, ``letters``, ``declared`` and ``host``: language and posterior."""
    k = len(known)
    if not k:
        return measured.select(
            "*",
            F.lit("und").alias("text_language"),
            F.lit("und").alias("language"),
            F.lit(0.0).alias("posterior"),
            (F.col("letters") > 0).alias("accepted"),
        )
    labels = F.split(F.col("host"), r"\.")
    parts = {
        "suffix": F.element_at(labels, -1),
        "domain": F.array_join(F.slice(labels, -2, 2), "."),
    }
    domain = F.when(F.size(labels) < 2, F.col("host")).otherwise(parts["domain"])
    suffix = F.when(F.size(labels) < 2, F.lit("")).otherwise(parts["suffix"])
    best = F.when(F.col("letters") > 0, F.array_position("text_log", F.array_max("text_log")) - 1)
    rows = measured.withColumns({"suffix": suffix, "domain": domain, "best": best.cast("int")})
    rows = staged(rows, "language-rows")
    totals = _totals(rows, k)
    # Each joined table has a row per host, suffix or code; a host of very many rows is split by
    # adaptive execution.
    out = _join(rows, staged(_priors(rows, totals), "language-priors"), ["host", "domain", "suffix"])
    out = _join(out, staged(_likelihood(rows, "declared", totals), "language-declared"), ["declared"])
    out = _join(out, staged(_likelihood(rows, "suffix", totals), "language-suffix"), ["suffix"])
    sums = F.col("text_log")
    for log in ("prior_log", "declared_log", "suffix_log"):
        sums = F.zip_with(sums, log, lambda x, y: x + y)
    out = out.withColumn("all_log", sums).withColumn("high", F.array_max("all_log"))
    norm = F.aggregate(
        F.transform("all_log", lambda x: F.exp(x - F.col("high"))), F.lit(0.0), lambda a, x: a + x
    )
    names = F.array(*[F.lit(x) for x in known])
    read = F.col("letters") > 0
    chosen = (F.array_position("all_log", F.col("high")) - 1).cast("int")
    out = out.withColumns(
        {
            "text_language": F.when(read, names[F.col("best")]).otherwise("und"),
            "language": F.when(read, names[chosen]).otherwise("und"),
            "posterior": F.when(read, 1 / norm).otherwise(0.0),
        }
    )
    own = [c for c in measured.columns]
    explained = F.col("text_log")[chosen] >= 0
    accepted = read & explained & (F.col("posterior") >= LEAST)
    return out.select(*own, "text_language", "language", "posterior", accepted.alias("accepted"))


def identify(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``rows`` is a written table (row, text, declared, host and the ``keep`` columns)."""
    known = languages(rows)
    carried = list(dict.fromkeys([*keep, "declared", "host"]))
    measured = with_likelihood(rows, carried, fit(rows, known))
    return fuse(measured, list(known))


def document_languages(docs: DataFrame) -> DataFrame:
    """Language of every document; its source stands for the host."""
    picked = docs.select("doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host"))
    rows = picked.withColumn("row", F.coalesce(F.col("doc_id"), F.lit(0)))
    return identify(rows, ["doc_id"]).select(
        "doc_id", "declared", "host", "text_language", "language", "posterior", F.col("accepted").alias("kept")
    )


def page_languages(pages: DataFrame) -> DataFrame:
    """Language of every page, from its text, markup and address."""
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]+)", 1))
    plain = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    rows = pages.select(
        "page_id",
        F.col("page_id").alias("row"),
        plain.alias("text"),
        F.when(declared != "", declared).alias("declared"),
        F.lower(F.try_parse_url("url", F.lit("HOST"))).alias("host"),
    )
    return identify(rows, ["page_id"]).select(
        "page_id", "declared", "host", "text_language", "language", "posterior", F.col("accepted").alias("kept")
    )


def language_filter(docs: DataFrame) -> DataFrame:
    """Documents whose language is determined, with their own columns."""
    doc = F.struct(*docs.columns).alias("doc")
    columns = ["text", F.col("lang").alias("declared"), F.col("source").alias("host")]
    row = F.monotonically_increasing_id().alias("row")
    rows = staged(docs.select(row, doc, *columns), "language-docs")
    rejected = identify(rows.select("row", "text", "declared", "host"), ["row"]).filter(~F.col("accepted"))
    rejected = staged(rejected.select("row"), "language-rejected")
    return rows.join(rejected, "row", "left_anti").select("doc.*")
