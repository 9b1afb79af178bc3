"""Spelling variants against a plain Python version, with odd rows."""

import collections
import random
import re
import zlib

import pytest

from forumflow.llm import spelling

DOCS = "doc_id bigint, text string, lang string, extra string"
ALPHA = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xC0, 0x100))


def brute(rows):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(table)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                count[run] += 1
    vocab = {w: n for w, n in count.items() if n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if abs(len(a) - len(b)) != 1:
            return False
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    links = {w: [v for v in vocab if v != w and near(w, v)] for w in vocab}
    form = {}
    for w, n in vocab.items():
        best = min(links[w], key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= 5 * n else None
    out = {}
    for w, n in vocab.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(links[w]), vocab[form[w]] if form[w] else None)
    return out


def run(spark, rows):
    got = spelling.spelling_variants(spark.createDataFrame(rows, DOCS)).collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}


def corpus(seed=5):
    r = random.Random(seed)
    base = ["sunshine", "rainfall", "mountain", "élégance", "ÇafÉteria", "whisper", "lanterns"]
    texts = []
    for i in range(120):
        words = [r.choice(base) for _ in range(30)]
        if i % 4 == 0:
            words += ["sunshime", "rainfal", "mountains", "mountainn", "élégançe", "whispers"]
        if i % 9 == 0:
            words += ["sunshimes", "rainfalls", "SUNSHINE", "MoUnTaIn"]
        texts.append(" ".join(words) + " 12 x-y" + "q" * (i % 3))
    rows = [(i, t, "en", "e") for i, t in enumerate(texts)]
    rows += [(500, None, None, None), (501, "", "en", None), (None, "sunshime " * 6, "en", None)]
    rows += [rows[3], rows[3]]  # repeated rows count as often as they occur
    rows += [(502, ("abcdefgh" * 2000 + " ") * 6, "en", None)]  # a very long word, six times
    return rows


def test_equal_to_brute_force(spark):
    rows = corpus()
    want = brute(rows)
    got = run(spark, rows)
    assert got == want
    assert any(v[0] for v in want.values())


def test_chains_and_ties(spark):
    # aaaaaa (5) -> aaaaab (25) -> aaaabb (125); baaaaa (25) ties with aaaaab: the smaller wins.
    rows = [(1, " ".join(["aaaaaa"] * 5 + ["aaaaab"] * 25 + ["aaaabb"] * 125 + ["baaaaa"] * 25), "x", "")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert got["aaaaaa"][:2] == ("aaaaab", "aaaabb")


def test_empty_tables_and_no_words(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, None, None, None), (2, "short word", "", "")]) == {}


@pytest.mark.parametrize("bloom", [True, False])
def test_without_the_filters_the_result_is_the_same(spark, monkeypatch, bloom):
    if not bloom:
        monkeypatch.setattr(spelling, "BROADCAST_BYTES", 0)
    rows = corpus(seed=11)
    assert run(spark, rows) == brute(rows)
