"""Toxicity by a weighted lexicon.

Texts are folded letter by letter (case, homoglyphs of other scripts, full-width forms, digits and
signs that stand for letters) and everything else becomes a space; invisible characters vanish. An
Aho-Corasick automaton then finds the terms of the lexicon, word beginnings or whole words, and the
exception phrases. A hit inside an exception phrase does not count. The weights found are summed,
set against the number of words, and turned into a score by a logistic function.

The lexicon starts from a short fixed list. More terms, their weights, the exceptions and the
function's coefficients are learned from a sample of distinct labelled texts, at most ``SAMPLE`` of
them: all toxic ones up to half the sample, clean ones for the rest, and toxic ones again if the clean
ones do not fill it. The function's constant is set back to the shares before sampling. The lexicon has
at most ``TERMS`` terms. Both bounds are parameters of the model alone:
every whole text is scored.

Defined results: null and empty texts have no hits; documents that occur twice are scored twice; a
label without a document is ignored and the larger of several labels counts; without labels of
both kinds the fixed list and default coefficients score; no documents give no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumflow.llm.staging import batches_of, staged

SAMPLE = 20_000
TERMS = 2_000
# Insults every lexicon begins with, and phrases in which they are none.
INSULTS = (
    "idiot", "moron", "stupid", "scum", "trash", "loser", "pathetic", "worthless", "disgusting",
    "clown",
)
EXCEPTIONS = ("trash can", "trash bin", "clown fish")
# Letters of other scripts that look like Latin ones, and digits and signs used so.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ⅼ": "l",
}
SUBSTITUTES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}
_BATCH = 4 << 20
_LEARN_BATCH = 256 << 10
_HELD = 200_000  # pairs of words a task holds while learning
PREFIXES = (3, 4, 5, 6, 7, 8)
LEAST_GAIN = 18.0  # nats by which a term must beat the share of toxic documents
LEAST_ODDS = 3.0
_INNER = re.compile(r"(?<=[^\W\d_])!(?=[^\W\d_])")


class _Fold(dict):
    """Translation table that works out each character once."""

    def __missing__(self, code: int):
        char = chr(code)
        if unicodedata.category(char) in ("Cf", "Mn"):
            out = None
        else:
            plain = unicodedata.normalize("NFKC", char).lower()
            plain = SUBSTITUTES.get(plain, HOMOGLYPHS.get(plain, plain))
            out = plain if len(plain) == 1 and plain.isalpha() else " "
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """Folded words with one space or more between, and one at either end."""
    if "!" in text:
        text = _INNER.sub("i", text)
    return f" {text.translate(_FOLD)} "


@dataclass(frozen=True)
class Lexicon:
    """Terms begin with a space (a word begins) and may end with one (the word ends)."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    coefficients: tuple[float, ...] = (-4.0, 6.0, 0.5)


BASE = Lexicon({f" {w}": 5.0 for w in INSULTS})


class Matcher:
    """The automaton of a lexicon."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.coefficients = np.array(lexicon.coefficients)
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.weights.items():
            self.automaton.add_word(term, (len(term), weight, term))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, None))
        self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, tuple[float, str]]:
        """Where words begin that count, with their weight and term."""
        found: dict[int, tuple[float, str]] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight, term) in self.automaton.iter(folded):
            start = end - size + 1
            if term is None:
                spared.append((start, end))
            elif weight > found.get(start, (0.0, ""))[0]:
                found[start] = (weight, term)
        for a, b in spared:
            for start in [s for s in found if a <= s < b]:
                del found[start]
        return found

    def measure(self, text: str | None) -> tuple[float, int, int]:
        """Summed weight, hits and words of a text."""
        if not text:
            return 0.0, 0, 0
        folded = fold(text)
        found = self.hits(folded)
        return sum(w for w, _ in found.values()), len(found), len(folded.split())


def values(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the logistic function sees: how far the weight goes towards certainty, and the weight
    per hundred words."""
    rate = 100 * weight / np.maximum(words, 1)
    return np.stack([np.ones(len(weight)), 1 - np.exp(-weight), np.log1p(rate)], axis=1)


@lru_cache(maxsize=2)
def _matcher(key: tuple) -> Matcher:
    weights, exceptions, coefficients = key
    return Matcher(Lexicon(dict(weights), exceptions, coefficients))


def matcher(lexicon: Lexicon) -> Matcher:
    """One automaton per Python worker."""
    key = (tuple(lexicon.weights.items()), lexicon.exceptions, lexicon.coefficients)
    return _matcher(key)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's labels must not be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word and word beginning with the codes of the words before it, by label.

    A task puts together what it has seen, so a term seldom comes twice, and each word before it is
    four bytes.
    """
    seen: dict[tuple[str, int], set[int]] = {}
    held = 0

    def emit() -> pa.RecordBatch:
        terms: dict[tuple[str, int], set[int]] = {}
        for (word, toxic), before in seen.items():
            for term in [f" {word} ", *[f" {word[:n]}" for n in PREFIXES if len(word) >= n]]:
                terms.setdefault((term, toxic), set()).update(before)
        sizes = np.cumsum([0, *map(len, terms.values())])
        flat = np.fromiter((c for before in terms.values() for c in before), np.uint32, sizes[-1])
        return pa.record_batch(
            [
                pa.array([t for t, _ in terms], pa.string()),
                pa.array([x for _, x in terms], pa.int32()),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat.view(np.int32))),
            ],
            ["term", "toxic", "before"],
        )

    for batch in batches_of(batches, "text", _LEARN_BATCH):
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = fold(text or "").split()
            for last, word in zip(["", *words], words):
                own = seen.setdefault((word, toxic), set())
                size = len(own)
                own.add(zlib.crc32(last.encode()))
                held += len(own) - size
        if held >= _HELD:
            yield emit()
            seen.clear()
            held = 0
    if seen:
        yield emit()


def _gain(n: Column, k: Column, share: float) -> Column:
    """How many nats better k toxic of n documents fit their own share than the given one."""
    rest = n - k
    return F.when(k > 0, k * F.log(k / n / share)).otherwise(0.0) + F.when(
        rest > 0, rest * F.log(rest / n / (1 - share))
    ).otherwise(0.0)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """A lexicon from labelled documents that are not held out."""
    known, number, every = _sample(docs, labels, sample)
    toxic, clean = number.get(1, 0), number.get(0, 0)
    if not toxic or not clean:
        return BASE
    share = toxic / (toxic + clean)
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    odds = F.log((k + 0.5) / (toxic + 1)) - F.log((n - k + 0.5) / (clean + 1))

    def distinct(toxic: int) -> Column:
        # The same words around a term are one piece of evidence, however many copies.
        lists = F.collect_list(F.when(F.col("toxic") == toxic, F.col("before")))
        return F.size(F.array_distinct(F.flatten(lists))).cast("long")

    found = (
        known.mapInArrow(_terms, "term string, toxic int, before array<int>")
        .groupBy("term")
        .agg(distinct(0).alias("rest"), distinct(1).alias("k"))
        .withColumn("n", F.col("rest") + F.col("k"))
        .select("term", "k", odds.alias("odds"), _gain(n, k, share).alias("gain"))
        .filter((F.col("odds") >= LEAST_ODDS) & (F.col("gain") >= LEAST_GAIN))
        .orderBy(F.desc("gain"), "term")
        .limit(10 * TERMS)
        .collect()
    )
    # A longer term that finds as much is more specific than its beginning; one that only
    # extends a chosen term adds nothing.
    number = {r["term"]: r["k"] for r in found}
    covered: set[str] = set()
    for term, k in number.items():
        covered.update(
            term[:i] for i in range(2, len(term)) if k >= 0.95 * number.get(term[:i], math.inf)
        )
    weights = dict(BASE.weights)
    for r in sorted(found, key=lambda r: (len(r["term"]), r["term"])):
        term = r["term"]
        if term not in covered and not any(term[:i] in weights for i in range(2, len(term))):
            weights[term] = round(r["odds"], 4)
    best = sorted(weights.items(), key=lambda x: (-x[1], x[0]))[:TERMS]
    first = Lexicon(dict(best))
    rows = known.mapInArrow(_contexts(first), "phrase string, toxic int")
    phrases = (
        rows.groupBy("phrase")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k"))
        .filter((F.col("n") - F.col("k") >= 3) & (F.col("k") <= share * F.col("n")))
        .orderBy(F.desc("n"), "phrase")
        .limit(TERMS)
        .collect()
    )
    exceptions = tuple(sorted({*EXCEPTIONS, *[r["phrase"] for r in phrases]}))
    second = Lexicon(dict(best), exceptions)
    measured = measure(known.select("text", "toxic"), ["toxic"], second).select(
        "toxic", "weight", "n_words"
    )
    table = measured.toPandas()  # at most ``sample`` rows of three numbers
    x = values(table["weight"].to_numpy(), table["n_words"].to_numpy())
    first, *rest = _logistic(x, table["toxic"].to_numpy())
    first += math.log(every[1] / every[0]) - math.log(toxic / clean)
    return Lexicon(dict(best), exceptions, (first, *rest))


def _sample(
    docs: DataFrame, labels: DataFrame, sample: int
) -> tuple[DataFrame, dict[int, int], dict[int, int]]:
    """Distinct texts with labels, written; how many of each label; and how many there are at all."""
    marked = (
        labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.max("toxic").cast("int") > 0).cast("int").alias("toxic"))
    )
    # Texts are told apart by their hashes, so that only the sample's own are moved.
    code = F.xxhash64("text", F.lit(1)).alias("code")
    texts = staged(
        docs.select("doc_id", code)
        .join(marked, "doc_id")
        .groupBy("code", "toxic")
        .agg(F.min("doc_id").alias("doc_id")),
        "toxic-labelled",
    )
    every = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    half = sample // 2
    toxic = min(every.get(1, 0), max(half, sample - every.get(0, 0)))
    sizes = {1: toxic, 0: min(every.get(0, 0), sample - toxic)}
    # At most ``sample`` rows of three numbers in all, whatever the documents.
    parts = [
        texts.filter(F.col("toxic") == mark).orderBy("code", "doc_id").limit(size)
        for mark, size in sizes.items()
    ]
    picked = F.broadcast(parts[0].unionByName(parts[1]))
    rows = docs.select("doc_id", "text", code).join(picked, ["doc_id", "code"])
    known = staged(rows.dropDuplicates(["code", "toxic"]).select("text", "toxic"), "toxic-sample")
    return known, sizes, every


def _contexts(lexicon: Lexicon):
    """Two-word phrases around hits, once per document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = matcher(lexicon)
        for batch in batches_of(batches, "text", _BATCH):
            phrases: list[str] = []
            marks: list[int] = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded = fold(text or "")
                own = set()
                for start in find.hits(folded):
                    before = folded[max(0, start - 80) : start].split()[-1:]
                    word = folded[start : start + 160].split()[:2]
                    own.add(" ".join(word))
                    own.add(" ".join([*before, word[0]]))
                own = {p for p in own if " " in p}
                phrases.extend(own)
                marks.extend([toxic] * len(own))
            yield pa.record_batch([pa.array(phrases, pa.string()), pa.array(marks, pa.int32())], ["phrase", "toxic"])

    return read


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> list[float]:
    """Coefficients by Newton steps; the ridge keeps separable data finite."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def measure(docs: DataFrame, keep: list[str], lexicon: Lexicon) -> DataFrame:
    """The ``keep`` columns with weight, n_hits, n_words and score of each whole text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = matcher(lexicon)
        for batch in batches_of(batches, "text", _BATCH):
            rows = [find.measure(t.as_py()) for t in batch.column("text")]
            weight = np.array([r[0] for r in rows], float)
            hits = np.array([r[1] for r in rows], np.int64)
            words = np.array([r[2] for r in rows], np.int64)
            score = 1 / (1 + np.exp(-np.clip(values(weight, words) @ find.coefficients, -30, 30)))
            yield pa.record_batch(
                [*[batch.column(c) for c in keep], *map(pa.array, (weight, hits, words, score))],
                [*keep, "weight", "n_hits", "n_words", "score"],
            )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(
        read, f"{kinds}, weight double, n_hits bigint, n_words bigint, score double"
    )


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted label of every document, and its hits and words."""
    lexicon = learn(docs, labels)
    return measure(docs, ["doc_id"], lexicon).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_hits",
        "n_words",
    )
