"""Language, toxicity, quality, duplicates, decontamination and packing on small documents."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumflow.llm import (
    components,
    decontaminate,
    jaccard,
    language_id,
    packing,
    quality,
    staging,
    token_files,
    toxicity,
)
from forumflow.llm.components import connected_components
from forumflow.llm.queries import TOKENIZER
from forumflow.llm.words import words_of

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key int, host string"
RANDOM = random.Random(7)
SYLLABLES = "ka lo mi ne or re sa ti un ve bo du".split()


def prose(n, r=RANDOM):
    return " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(n))


LONG = prose(3000)
BASE = prose(120)
NEAR = " ".join(BASE.split()[:-2] + ["changed", "end"])
ODD = [
    (1, None, "en", "a", None, "x", 1, "h"),
    (2, "", "en", "a", 0, "x", 1, "h"),
    (3, "  \n\t ", None, None, 0, None, None, None),
    (4, LONG, "en", "a", 1, "x", 1, "h"),
    (5, BASE, "en", "a", 1, "x", 1, "h"),
    (6, BASE, "en", "b", 1, "x", 1, "h"),
    (6, BASE, "en", "b", 1, "x", 1, "h"),
    (7, NEAR, "de", None, 1, "y", 2, "g"),
    (None, "one two", "de", "b", 1, "y", 2, "g"),
    (8, "three \x00 ünï 漢字 words %%% ###", None, "b", 1, "y", 2, "g"),
]


@pytest.fixture(scope="module")
def docs(spark):
    more = [(100 + i, prose(60 + i), "en", "a", 1, "x", 1, "h") for i in range(30)]
    return spark.createDataFrame(ODD + more, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def brute_words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_words():
    import pyarrow as pa

    texts = [r[1] for r in ODD] + ["A-b c_d\x7fe", "é9"]
    found = words_of(pa.array(texts))
    for i, text in enumerate(texts):
        which = np.arange(found.first[i], found.first[i + 1])
        assert found.strings(which) == brute_words(text)


def test_quality_stats(spark, docs):
    def brute(text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)

    more = ["a b c a b c", "a a a a", "x\n\nx\n\x0b\nx y", "p q r\np q r\np q r\np q r"]
    rows = docs.select("text").union(spark.createDataFrame([(t,) for t in more], "text string"))
    for r in quality.with_stats(rows).collect():
        assert tuple(r["stats"]) == brute(r["text"])


def test_quality_rejects_outliers(spark):
    clean = [(i, prose(RANDOM.randint(60, 300)), "en", "s%d" % (i % 3)) for i in range(200)]
    junk = [(1000 + i, " ".join(w + "%%%" for w in prose(200).split()), "en", "s0") for i in range(8)]
    rows = spark.createDataFrame(clean + junk, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.document_quality(rows).collect()}
    assert not any(kept[d[0]] for d in junk)
    assert sum(kept[d[0]] for d in clean) >= 198
    assert {r.doc_id for r in quality.quality_filter(rows).collect()} == {d for d, k in kept.items() if k}


def test_quality_odd(docs, none):
    rows = {r.doc_id: r for r in quality.document_quality(docs).collect()}
    assert rows[1].n_words == rows[3].n_words == 0 and rows[1].base_failed and not rows[1].kept
    assert quality.document_quality(docs).count() == docs.count()
    assert quality.quality_filter(none).columns == none.columns
    assert quality.quality_filter(none).count() == 0


def test_language(spark, docs, none):
    plain = [("en", "the cat sat with the other cats and was there"), ("de", "der Hund und die Katze sind nicht hier und dort")]
    rows = [(i, " ".join([t] * 3), lang if i % 10 else "de", "a.example.de" if lang == "de" else "b.example.org") for i in range(200) for lang, t in [plain[i % 2]]]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = {r.doc_id: r for r in language_id.document_languages(table).collect()}
    wrong = [i for i, *_ in rows if found[i].language != plain[i % 2][0]]
    assert not wrong and all(r.kept for r in found.values())
    odd = {r.doc_id: r for r in language_id.document_languages(docs).collect()}
    assert odd[1].language == odd[3].language == "und" and not odd[2].kept and odd[4].kept
    kept = language_id.language_filter(docs)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 3
    assert language_id.language_filter(none).count() == 0


def test_language_posterior_is_bayes(spark):
    """The fused posterior of two documents, worked out by hand."""
    rows = spark.createDataFrame(
        [(1, "a", "h", 5, [-1.0, -2.0]), (2, "b", "h", 5, [-3.0, -1.0]), (3, None, None, 0, [0.0, 0.0])],
        "id bigint, declared string, host string, letters bigint, text_log array<double>",
    )
    found = {r.id: r for r in language_id.fuse(rows, ["a", "b"]).collect()}
    every = np.array([2.0, 2.0]) / 4
    prior = (np.array([1.0, 1.0]) + 20 * every) / 22
    declared = np.array([2 / 4, 1 / 4])  # (1 + 1) / (1 + 3) and (0 + 1) / (1 + 3): values a, b, none
    suffix = np.array([2 / 3, 2 / 3])
    both = np.exp([-1.0, -2.0]) * prior * declared * suffix
    assert found[1].language == "a"
    assert found[1].posterior == pytest.approx((both / both.sum())[0])
    assert found[3].language == "und"


def test_no_language_is_declared(spark):
    rows = [(1, "some words of a text", None, "a"), (2, "", "", "a"), (3, None, None, None), (4, "12 34", None, "b"), (5, "漢字", "", None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = {r.doc_id: (r.language, r.posterior, r.kept) for r in language_id.document_languages(table).collect()}
    assert found == {i: ("und", 0.0, i in (1, 5)) for i in range(1, 6)}
    assert sorted(r.doc_id for r in language_id.language_filter(table).collect()) == [1, 5]


def test_every_declared_language_is_modelled(spark):
    """70 languages of their own letters, and a text whose trigrams none has."""
    r = random.Random(11)
    names = [f"l{i:02d}" for i in range(70)]
    rows = []
    for i, name in enumerate(names):
        letters = "".join(chr(0x4E00 + 40 * i + k) for k in range(8))
        for _ in range(3 if i < 64 else 2):
            rows.append((len(rows), " ".join("".join(r.choices(letters, k=4)) for _ in range(30)), name, None))
    # a hundred syllables that occur nowhere else
    rows.append((1000, "".join(chr(0xAC00 + 97 * k) for k in range(100)), None, None))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = {d.doc_id: d for d in language_id.document_languages(table).collect()}
    assert all(found[i].language == lang and found[i].kept for i, _, lang, _ in rows[:-1])
    assert not found[1000].kept
    assert {d.doc_id for d in language_id.language_filter(table).collect()} == set(range(len(rows) - 1))


def test_toxicity(spark, docs, none):
    clean = [(i, prose(80)) for i in range(300)]
    rude = ["you IDIOT", "such a m0r0n there", "what а ѕtupid thing", "ｌｏｓｅｒ", "go in the trash can"]
    insults = [(1000 + i, prose(40) + f" zorg{RANDOM.choice(SYLLABLES)} " + prose(40)) for i in range(120)]
    table = spark.createDataFrame(clean + insults + [(5000 + i, t) for i, t in enumerate(rude)], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, 0) for i, _ in clean[:200]] + [(i, 1) for i, _ in insults] + [(None, 1), (999999, 0), (5, None)],
        "doc_id bigint, toxic int",
    )
    found = {r.doc_id: r for r in toxicity.score_documents(table, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    hidden = [i for i, _ in insults if found[i].held_out]
    assert sum(found[i].predicted for i in hidden) >= 0.95 * len(hidden)
    assert sum(found[i].predicted for i, _ in clean) <= 3
    assert [found[5000 + i].predicted for i in range(5)] == [1, 1, 1, 1, 0]
    empty = labels.limit(0)
    odd = toxicity.score_documents(docs, empty).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score_documents(none, empty).count() == 0


def test_toxicity_learns_from_rare_labels(spark):
    """Under one percent of the labels are toxic, and many clean texts are copies."""
    r = random.Random(13)
    clean = [(i, prose(20, r)) for i in range(3000)] + [(10_000 + i, BASE) for i in range(3000)]
    rude = [(20_000 + i, prose(15, r) + f" zorg{r.choice(SYLLABLES)} " + prose(15, r)) for i in range(50)]
    table = spark.createDataFrame(clean + rude, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i >= 20_000)) for i, _ in clean + rude], "doc_id bigint, toxic int")
    known, number, every = toxicity._sample(table, labels, 400)
    texts = {i: t for i, t in clean + rude if zlib.crc32(str(i).encode()) % 3 != 1}
    toxic = {t for i, t in texts.items() if i >= 20_000}
    got = [(d.text, d.toxic) for d in known.collect()]
    assert {t for t, x in got if x} == toxic and number == {1: len(toxic), 0: 400 - len(toxic)}
    assert every == {1: len(toxic), 0: len(set(texts.values()) - toxic)} and len(set(got)) == len(got) == 400
    lexicon = toxicity.learn(table, labels, sample=400)
    assert any(term.startswith(" zor") for term in lexicon.weights)
    scored = toxicity.measure(table, ["doc_id"], lexicon).collect()
    assert sum(d.score >= 0.7 for d in scored if d.doc_id >= 20_000) >= 48
    assert not any(d.score >= 0.7 for d in scored if d.doc_id < 20_000)


def test_terms_of_many_pieces(spark, monkeypatch):
    """Terms are counted once per word before them, in however many pieces a task gives them."""
    texts = [("ab xyzw ab xyzw q xyz", 1), ("q xyz q xyzw", 0), ("q xyzw r xyzw", 1)]
    import pyarrow as pa

    want = collections.defaultdict(set)
    for text, toxic in texts:
        words = text.split()
        for last, word in zip(["", *words], words):
            for term in {f" {word} ", *[f" {word[:n]}" for n in toxicity.PREFIXES if len(word) >= n]}:
                want[term, toxic].add(zlib.crc32(last.encode()))
    batch = pa.RecordBatch.from_pydict({"text": [t for t, _ in texts], "toxic": [x for _, x in texts]})
    for held in (1, 200_000):
        monkeypatch.setattr(toxicity, "_HELD", held)
        got = collections.defaultdict(set)
        for part in toxicity._terms(iter([batch.slice(i, 1) for i in range(3)])):
            for row in part.to_pylist():
                got[row["term"], row["toxic"]].update(c % 2**32 for c in row["before"])
        assert got == want


def brute_jaccard(rows):
    sets = []
    for _, text, *_ in rows:
        w = brute_words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    n = len(rows)
    linked = [[i != j and bool(sets[i]) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i], *[root[j] for j in range(n) if linked[i][j]]]) for i in range(n)]
    return [(root[i], sum(linked[i])) for i in range(n)]


def test_jaccard_against_brute_force(spark, monkeypatch):
    r = random.Random(3)
    rows = []
    for group in range(12):
        words = prose(r.randint(3, 150), r).split()
        for _ in range(r.randint(1, 14)):
            copy = list(words)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                copy[r.randrange(len(copy))] = "x" + r.choice(SYLLABLES)
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "a"), (len(rows) + 3, "a")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {i: (root, n) for (i, _), (root, n) in zip(rows, brute_jaccard(rows))}
    for block in (512, 5):  # whole buckets, and buckets that meet block by block
        monkeypatch.setattr(jaccard, "BLOCK", block)
        got = {d.doc_id: (d.class_id, d.n_links) for d in jaccard.near_duplicates(table).collect()}
        assert got == want


@pytest.mark.parametrize("few", [0, 1 << 18])
def test_jaccard_broadcasts_no_side_that_grows(spark, monkeypatch, few):
    """The exploded band keys look small by the files they come from; the driver held them all."""
    r = random.Random(5)
    texts = [prose(60, r) for _ in range(20)]
    rows = [(i + 100 * k, t + " end" * k) for i, t in enumerate(texts) for k in (0, 1)]
    plans = []

    def recorded(rows, name):
        plans.append((name, rows._jdf.queryExecution().executedPlan().toString()))
        return staging.staged(rows, name)

    monkeypatch.setattr(jaccard, "FEW", few, raising=False)
    monkeypatch.setattr(jaccard, "staged", recorded)
    monkeypatch.setattr(components, "staged", recorded)
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    plans.append(("result", found._jdf.queryExecution().executedPlan().toString()))
    assert sum("Join" in plan for _, plan in plans) >= 6
    # Only the row numbers of the texts to verify may be broadcast, and only while they are few.
    assert {name for name, plan in plans if "Broadcast" in plan} == ({"jaccard-links"} if few else set())
    assert "".join(plan for _, plan in plans).count("BroadcastHashJoin") == (1 if few else 0)
    got = {d.doc_id: (d.class_id, d.n_links) for d in found.collect()}
    assert got == {i: (i % 100, 1) for i, _ in rows}


def test_least_matches():
    least = jaccard.least_matches(0.8, 1e-6)
    assert all(0 <= m < 16 * (i + 1) for i, m in enumerate(least))
    assert least == sorted(least) and least[-1] > 64


def test_jaccard_keep_one(docs, none):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and not {6, 7} & set(ids) and {1, 2, 3, 4, 8, None} <= set(ids)
    assert jaccard.keep_one(none).count() == 0


def test_components(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 101), (7, 7), (200, 300), (300, 250)]
    edges = spark.createDataFrame(chain, "a bigint, b bigint")
    root = {r.node: r.root for r in connected_components(edges).collect()}
    assert all(root[i] == 0 for i in range(41))
    assert root[101] == root[100] == 100 and root[300] == root[250] == 200


def test_decontamination(spark, docs, none):
    ten, short = prose(14), "alpha beta"
    items = spark.createDataFrame(
        [(1, ten), (2, short), (3, "omega"), (4, None), (5, ""), (1, ten), (None, short), (20, ten.upper())],
        "item_id bigint, text string",
    )
    w = ten.split()
    texts = [ten, "x " + " ".join(w[2:12]) + " y", " ".join(w[:9]), "Alpha, BETA gamma omega", "alpha x beta", ten + " " + ten, None]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(table, items, ["doc_id"]).collect()}
    assert found == {0: (14, 14, 2), 1: (12, 10, 2), 2: (9, 0, 0), 3: (4, 3, 2), 4: (3, 0, 0), 5: (28, 28, 2), 6: (0, 0, 0)}
    assert {r.doc_id for r in decontaminate.remove_contaminated(table, items).collect()} == {2, 4, 6}
    assert decontaminate.contamination(docs, items.limit(0), ["doc_id"]).filter("contaminated").count() == 0
    assert decontaminate.remove_contaminated(docs, items).columns == docs.columns
    assert decontaminate.contamination(none, items, ["doc_id"]).count() == 0


def test_best_fit_bounds():
    r = random.Random(1)
    for _ in range(50):
        lengths = np.array([r.randint(1, 100) for _ in range(r.randint(1, 60))])
        bins, offsets = packing.best_fit_decreasing(lengths, 100)
        used = np.bincount(bins, weights=lengths)
        assert used.max() <= 100
        bound = packing.lower_bound(np.bincount(lengths, minlength=101), 100)
        assert bound <= len(used) <= bound * 1.25 + 1
        for b in range(len(used)):
            own = sorted((o, n) for o, n, at in zip(offsets, lengths, bins) if at == b)
            assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
    assert packing.lower_bound(np.bincount([51] * 4, minlength=101), 100) == 4
    assert packing.lower_bound(np.bincount([34] * 6, minlength=101), 100) == 3


def test_packing_rounds(spark, monkeypatch):
    """Many small partitions leave gaps; exchanging documents closes them."""
    monkeypatch.setattr(packing, "PER_PARTITION", 20)
    r = random.Random(2)
    lengths = [r.randint(1, 60) for _ in range(400)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item bigint, length bigint")
    found = packing.pack(items, 100).toPandas()
    assert sorted(found["item"]) == list(range(400))
    assert found["sequence_id"].nunique() <= -(-sum(lengths) // 100) + 1


def test_packing_rounds_go_on_while_they_gain(spark, monkeypatch):
    monkeypatch.setattr(packing, "PER_PARTITION", 8)
    deal, salts = packing._pack_parts, []
    monkeypatch.setattr(packing, "_pack_parts", lambda i, c, salt: salts.append(salt) or deal(i, c, salt))
    r = random.Random(4)
    lengths = [r.randint(5, 40) for _ in range(1500)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item bigint, length bigint")
    found = packing.pack(items, 100).toPandas()
    assert sorted(found["item"]) == list(range(1500)) and (found["sequence_id"] >= 0).all()
    sizes = found.assign(length=[lengths[i] for i in found["item"]]).groupby("sequence_id")["length"].sum()
    assert sizes.max() <= 100
    assert salts == list(range(len(salts))) and len(salts) > 5  # rounds 1 to 4 all gained


@pytest.fixture(scope="module")
def encoded(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]


def test_packed_documents(docs, none, encoded):
    rows = packing.pack_documents(docs, TOKENIZER, end_id=1).collect()
    want = collections.Counter()
    for doc_id, ids in encoded:
        ids = np.array([*ids, 1], "<u4")
        for s in range(0, len(ids), 4096):
            part = ids[s : s + 4096]
            want[doc_id, s // 4096, s, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in rows) == want
    placed = collections.defaultdict(list)
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 4096
    assert packing.pack_documents(none, TOKENIZER).count() == 0


def test_token_files(spark, docs, none, encoded, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "tokens")
    token_files.write_token_files(docs, path, TOKENIZER, end_id=2)
    rows = token_files.token_index(spark, path).collect()
    want = sorted(((i if i is not None else -1, [*ids, 2]) for i, ids in encoded), key=lambda x: x[0])
    rows.sort(key=lambda r: r.start)
    start = 0
    for r, (i, ids) in zip(rows, want):
        assert (r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens) == (i, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(rows) == len(want)
    some = token_files.read_token_files(spark, path, F.col("doc_id") == 4).collect()
    assert [list(r.ids) for r in some] == [ids for i, ids in want if i == 4]
    file = max((tmp_path / "tokens").glob("*.parquet"), key=lambda p: p.stat().st_size)
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    empty = str(tmp_path / "none")
    token_files.write_token_files(none, empty, TOKENIZER)
    assert token_files.token_index(spark, empty).count() == 0


def test_batch_encoder_equals_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from forumflow.llm.tokens import BatchEncoder

    r = random.Random(5)
    texts = [None, "", "it's I'll 'string", "<|endoftext|> a", "a\x1cb", "² ½ x²", "café", "ΑΣ İ", "a\u0085b c"]
    texts += ["".join(r.choice("ab'sS \n\t.,<|>éÀß½İΣ́ \x1c9") for _ in range(r.randint(0, 30))) for _ in range(500)]
    ids, first = BatchEncoder(TOKENIZER).encode(pa.array(texts))
    want = Tokenizer.from_file(TOKENIZER).encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [e.ids for e in want]
