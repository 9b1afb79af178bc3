"""Quality rules: base limits, then robust multivariate outliers per language and source.

The statistics of a text become a vector of four transformed values. For each language and
source a minimum-covariance-determinant estimate is found by concentration steps: start from
the medians, keep the h = 3/4 of the rows that lie nearest, take their mean and covariance, and
repeat. A row whose Mahalanobis distance to the estimate is beyond the cutoff is rejected.

Everything is DataFrame functions. A step is one grouped aggregation into a histogram of distances, so a group with a third of all rows arrives as one partial row per task;
the nearest h are found from the histogram, which has at most ``_BINS`` rows per group however
large the group is. Values are whole numbers of 1/256, which keeps the sums exact and the result
independent of the order of rows.

Defined results: null text has no words and fails the base limits; null language or source is a
group of its own; a group of fewer than ``min_rows`` rows takes the estimate of its language, and
a language that small takes that of all rows; with no rows at all the result is empty.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumflow.llm.staging import staged

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("x0", "x1", "x2", "x3")
UNIT = 256
_BINS = 4096
_P = len(FEATURES)
LEVEL = ["level", "a", "b"]


@dataclass(frozen=True)
class Rules:
    """Parameters. ``floor`` is the least standard deviation a value is taken to have, which
    keeps the estimate regular where most rows share a value (such as no symbols at all)."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_rows: int = 30
    steps: int = 4
    cutoff: float = 36.0  # chi-square with 4 degrees of freedom exceeds it 3 times in 10 million
    floor: tuple[float, ...] = (0.25, 0.15, 0.35, 0.35)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def _window_hash(words: Column, i: Column) -> Column:
    return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))


def _repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    A first pass sorts plain numbers, 40 bits of the window's hash and 24 of its place, and keeps
    the windows whose neighbour has the same bits; these few are sorted by their whole hash, so
    equal windows are neighbours. A start covers three words less what the next start covers.
    """
    places = (1 << 24) - 1

    def packed(word: Column, i: Column) -> Column:
        whole = F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2))
        return whole.bitwiseAND(F.lit(~places).cast("long")).bitwiseOR(i.cast("long"))

    def same_bits(rows: Column) -> Column:
        def like(other: int):
            return lambda x, k: F.shiftright(x.bitwiseXOR(F.get(rows, k + other)), 24) == 0

        def both(firsts: Column) -> Column:
            lasts = F.filter(rows, like(-1))
            return F.when(F.size(firsts) == 0, firsts).otherwise(F.array_union(firsts, lasts))

        return _bind(F.filter(rows, like(1)), both)

    def whole(place: Column) -> Column:
        return F.struct(_window_hash(words, place).alias("h"), place.alias("i"))

    def repeats(rows: Column) -> Column:
        pairs = F.zip_with(
            rows,
            F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        )
        starts = F.flatten(F.filter(pairs, lambda p: p.isNotNull()))
        return _bind(F.sort_array(F.array_distinct(starts)), covered)

    def covered(starts: Column) -> Column:
        gaps = F.zip_with(
            starts,
            F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))),
            lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    firsts = F.slice(words, F.lit(1), F.size(words) - 2)
    every = F.sequence(F.lit(0), F.size(words) - 3)
    few = F.transform(
        _bind(F.sort_array(F.transform(firsts, packed)), same_bits),
        lambda x: whole(x.bitwiseAND(F.lit(places).cast("long")).cast("int")),
    )
    many = F.transform(every, whole)
    return (
        F.when(F.size(words) < 4, F.lit(0))
        .when(F.size(words) < (1 << 24), _bind(F.sort_array(few), repeats))
        .otherwise(_bind(F.sort_array(many), repeats))
    )


def with_stats(rows: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    """The rows with a struct of the five base statistics of the whole text."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    inner = F.btrim(body, F.lit(SPACE))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, r"[\x20\x09-\x0D]+")
    )
    stats = _bind(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.when(~body.rlike("[#*$%&|<>]"), F.lit(0))
            .otherwise(F.length(body) - F.length(F.translate(body, SYMBOLS, "")))
            .cast("long")
            .alias("n_symbols"),
            _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("long")
            .alias("n_dup_lines"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    return rows.withColumn(into, stats)


def base_failed(stats: str, rules: Rules) -> Column:
    n, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < rules.min_words) | (100 * repeated > rules.max_repeat_percent * n)


def features(stats: str) -> list[Column]:
    """Transformed statistics in whole units of 1/256."""
    n = F.greatest(F.col(f"{stats}.n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col(f"{stats}.word_chars"), F.lit(1)).cast("double")
    values = [
        F.log(n),
        F.log(chars / n) * 2,
        F.log(1 + 200 * F.col(f"{stats}.n_symbols") / chars),
        F.log(1 + 20 * F.col(f"{stats}.n_repeat_words") / n + F.col(f"{stats}.n_dup_lines") / 4),
    ]
    return [F.round(v * UNIT).cast("long").alias(x) for v, x in zip(values, FEATURES)]


def _distance(estimate: str = "") -> Column:
    """Squared Mahalanobis distance: forward substitution with the Cholesky factor."""
    y: list[Column] = []
    for i, x in enumerate(FEATURES):
        rest = F.col(x) / UNIT - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * y[k]
        y.append(rest / F.col(f"l{i}{i}"))
    total = y[0] * y[0]
    for v in y[1:]:
        total = total + v * v
    return total


def _with_cholesky(moments: DataFrame, rules: Rules, factor: float) -> DataFrame:
    """Mean and Cholesky factor columns from the sums of a group's kept rows."""
    out = moments
    for i in range(_P):
        out = out.withColumn(f"m{i}", F.col(f"s{i}") / F.col("s") / UNIT)
    for i in range(_P):
        for j in range(i + 1):
            cov = F.col(f"q{i}{j}") / F.col("s") / (UNIT * UNIT) - F.col(f"m{i}") * F.col(f"m{j}")
            cov = F.greatest(cov, F.lit(0.0)) * factor if i == j else cov * factor
            if i == j:
                cov = cov + rules.floor[i] ** 2
            for k in range(j):
                cov = cov - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            if i == j:
                cov = F.sqrt(F.greatest(cov, F.lit(rules.floor[i] ** 2)))
            else:
                cov = cov / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", cov)
    return out


def consistency() -> float:
    """What the covariance of the nearest 3/4 of normal rows is to be multiplied by.

    3/4 over the part of a chi-square with p + 2 degrees of freedom below the 3/4 quantile of
    one with p; both have closed forms for even p.
    """

    def below(q: float, degrees: int) -> float:
        terms = [(q / 2) ** k / math.factorial(k) for k in range(degrees // 2)]
        return 1 - math.exp(-q / 2) * sum(terms)

    low, high = 0.0, 100.0
    for _ in range(200):
        q = (low + high) / 2
        low, high = (q, high) if below(q, _P) < 0.75 else (low, q)
    return 0.75 / below(q, _P + 2)


def _bin() -> Column:
    """Distances on a logarithmic scale, in whole bins."""
    return F.least(F.floor(F.log1p(_distance()) * 128), F.lit(_BINS - 1))


def _reached(bins: DataFrame, by: list[str], share: float) -> DataFrame:
    """The bins of a group up to the first at which ``share`` of its rows are reached.

    ``bins`` is a histogram: at most ``_BINS`` rows per group.
    """
    group = Window.partitionBy(*by)
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return bins.withColumns(
        {"seen": F.sum("n").over(upto), "total": F.sum("n").over(group)}
    ).filter(F.col("seen") - F.col("n") < F.col("total") * share)


def _start(vectors: DataFrame, rules: Rules) -> DataFrame:
    """The start: the median of each value, to 1/8, and a wide scale; for large groups only."""
    values = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.floor(F.col(x) / 32).alias("bin"))
                for i, x in enumerate(FEATURES)
            ]
        )
    ).alias("v")
    bins = vectors.select(*LEVEL, values).groupBy(*LEVEL, "v.i", "v.bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    reached = _reached(bins, [*LEVEL, "i"], 0.5)
    medians = reached.groupBy(*LEVEL).agg(
        F.max("total").alias("rows"),
        *[
            ((F.max(F.when(F.col("i") == i, F.col("bin"))) + 0.5) / (UNIT / 32)).alias(f"m{i}")
            for i in range(_P)
        ],
    )
    scale = {
        f"l{i}{j}": F.lit(4 * rules.floor[i] if i == j else 0.0)
        for i in range(_P)
        for j in range(i + 1)
    }
    return medians.filter(F.col("rows") >= rules.min_rows).withColumns(scale)


def _step(vectors: DataFrame, now: DataFrame, rules: Rules) -> DataFrame:
    """One concentration step: a single pass, summing per group and distance bin."""
    near = _by_group(vectors, now, LEVEL).select(*LEVEL, *FEATURES, _bin().alias("bin"))
    products = {
        f"q{i}{j}": F.col(x).cast("double") * F.col(FEATURES[j]).cast("double")
        for i, x in enumerate(FEATURES)
        for j in range(i + 1)
    }
    sums = {f"s{i}": F.col(x).cast("double") for i, x in enumerate(FEATURES)} | products
    bins = near.groupBy(*LEVEL, "bin").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(k) for k, v in sums.items()]
    )
    kept = _reached(bins, LEVEL, 0.75).groupBy(*LEVEL).agg(
        F.sum("n").cast("double").alias("s"), *[F.sum(k).alias(k) for k in sums]
    )
    return _with_cholesky(kept, rules, consistency())


def _by_group(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join on group columns that may be null."""
    renamed = right.select(
        *[F.col(c).alias(f"r_{c}") for c in by], *[c for c in right.columns if c not in by]
    )
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    return left.join(renamed, on, how).drop(*[f"r_{c}" for c in by])


def estimates(vectors: DataFrame, rules: Rules) -> DataFrame:
    """Mean and scatter of the nearest rows of each group of ``min_rows``.

    A group is a language and source (level 0), a language (1), or everything (2).
    """
    none = F.lit(None).cast("string")
    groups = [(0, F.col("g0"), F.col("g1")), (1, F.col("g0"), none), (2, none, none)]
    named = [
        F.struct(F.lit(level).alias("level"), a.alias("a"), b.alias("b")) for level, a, b in groups
    ]
    levels = F.explode(F.array(*named))
    grouped = vectors.select(levels.alias("g"), *FEATURES).select("g.*", *FEATURES)
    now = staged(_start(grouped, rules).select(*LEVEL, *_estimate_columns()), "quality-start")
    for _ in range(rules.steps):
        step = _step(grouped, now, rules).select(*LEVEL, *_estimate_columns())
        now = staged(step, "quality-step")
    return now


def _estimate_columns() -> list[str]:
    return [f"m{i}" for i in range(_P)] + [f"l{i}{j}" for i in range(_P) for j in range(i + 1)]


def verdicts(
    rows: DataFrame,
    stats: str = "stats",
    language: str = "lang",
    source: str = "source",
    rules: Rules = Rules(),
) -> DataFrame:
    """The rows (with ``stats``) and ``base_failed``, ``distance`` and ``kept``.

    ``rows`` is read several times, so it should be a written table.
    """
    failed = base_failed(stats, rules)
    groups = [F.col(language).alias("g0"), F.col(source).alias("g1")]
    passed = rows.filter(~failed).select(*groups, *features(stats))
    found = staged(passed, "quality-vectors").transform(estimates, rules)
    out = rows.select(
        F.struct(*rows.columns).alias("row"), failed.alias("base_failed"), *groups, *features(stats)
    )
    columns = _estimate_columns()
    estimate = F.struct(*columns)
    for level, by in ((0, ["g0", "g1"]), (1, ["g0"])):
        names = [F.col(c).alias(g) for c, g in zip("ab", by)]
        one = found.filter(F.col("level") == level).select(*names, estimate.alias(f"e{level}"))
        out = _by_group(out, one, by, "left")
    every = found.filter("level = 2").select(*columns).first()  # a row of numbers, if any
    rest = F.struct(*[F.lit(every[c] if every else None).cast("double").alias(c) for c in columns])
    out = out.select("row", "base_failed", *FEATURES, F.coalesce("e0", "e1", rest).alias("e"))
    out = out.select("row", "base_failed", *FEATURES, "e.*").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= rules.cutoff, F.lit(True))
    return out.select("row.*", "base_failed", "distance", kept.alias("kept"))


def document_quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Statistics and verdict of every document, without its text."""
    measured = staged(
        with_stats(docs).select("doc_id", "lang", "source", "stats"), "quality-stats"
    )
    return verdicts(measured, rules=rules).select(
        "doc_id", *[F.col(f"stats.{s}").alias(s) for s in STATS], "base_failed", "kept"
    )


def quality_filter(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that are kept, with their own columns."""
    measured = staged(
        docs.select(F.struct(*docs.columns).alias("doc"), "lang", "source", "text")
        .transform(with_stats)
        .drop("text"),
        "quality-docs",
    )
    return verdicts(measured, rules=rules).filter("kept").select("doc.*")
