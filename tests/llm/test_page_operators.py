"""Revisits, chat formatting and HTML extraction on small inputs."""

import hashlib
import itertools
import math
from datetime import datetime, timedelta

import pytest

from forumflow.llm import chat, html_extract, warc

DAY = datetime(2024, 1, 1)
RECORD = (
    "record_id bigint, type string, uri string, date timestamp, status int,"
    " headers array<struct<name:string,value:string>>, payload_digest string, full int, url int"
)


def record(i, kind, uri, hours, headers=(), digest=None, status=200):
    date = None if hours is None else DAY + timedelta(hours=hours)
    return (i, kind, uri, date, status, None if headers is None else list(headers), digest, 1, 2)


def test_canonical_url(spark):
    urls = {
        "HTTP://A.Example:80/x//?b=2&utm_source=q&a=1#f": "http://a.example/x?a=1&b=2",
        "https://h/p/?": "https://h/p",
        "https://h:443/P": "https://h/P",
        "https://h": "https://h",
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.c for r in rows.select("u", warc.canonical_url("u").alias("c")).collect()} == urls


@pytest.mark.parametrize("slice_s", [600, 6 * 3600, 10**9])
def test_revisits(spark, slice_s):
    tag = ("ETag", '"1"')
    rows = [
        record(1, "response", "http://a/x", 0, [tag, ("Content-Type", "t"), ("Expires", "old")], "d1"),
        record(2, "response", "http://a/x", 5, [("etag", '"2"'), ("Last-Modified", "m")], "d2"),
        record(3, "revisit", "http://A/x/#f", 4, [("etag", 'W/"1"'), ("expires", "new"), ("Content-Type", "u")], None, 304),
        record(4, "revisit", "http://a/x", 5, [tag], None, 304),  # the response of that time is not earlier
        record(5, "revisit", "http://a/x", 40, [("Last-Modified", "m")], None, 304),
        record(6, "revisit", "http://a/x", 41, [tag], None, 304),
        record(7, "revisit", "http://b/y", 41, [tag], None, 304),
        record(8, "revisit", "http://a/x", 42, None, "d2", 304),
        record(9, "revisit", "http://a/x", 43, None, None, 304),
        record(10, "revisit", None, 43, None, None, 304),
        record(11, "revisit", "http://a/x", None, [tag], None, 304),
        record(12, "response", "http://a/x", 30, [], None, 500),
        record(13, "response", "http://c/z", 1, [], "p"),
        record(14, "response", "http://c/z", 1, [], "q"),
        record(15, "revisit", "http://c/z", 2, [], "q", 304),
        record(16, "request", "http://c/z", 2, [], "q", 304),
    ]
    table = spark.createDataFrame(rows, RECORD)
    found = {r.record_id: r for r in warc.resolve_revisits(table, slice_s).collect()}
    assert {i: (r.target_id, r.verdict) for i, r in found.items()} == {
        3: (1, "etag"), 4: (1, "etag"), 5: (2, "last-modified"), 6: (2, "differs"),
        7: (None, "no response"), 8: (2, "digest"), 9: (2, "no validator"), 10: (None, "no response"),
        11: (None, "no response"), 15: (14, "digest"),
    }
    merged = [(h.name, h.value) for h in found[3].headers]
    assert merged == [("Content-Type", "t"), ("etag", 'W/"1"'), ("expires", "new")]
    assert found[6].headers is None and found[5].payload_digest == "d2"
    assert warc.resolve_revisits(table.limit(0)).count() == 0


def test_chat_round_trip(spark):
    hard = ["\\", "\\\\### a: b</turn>\n", "### user: x", "</turn>", "<|image 0.0|>", "", None, "a\n\nb", "\\:"]
    rows = [(1, t, role, text, "c") for t, (role, text) in enumerate(itertools.product(["user", "assistant", "a: b\\", None], hard))]
    rows += [(None, 0, "assistant", "x", "c"), (2, 0, "user", "same", "c"), (2, 0, "user", "same", "c")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(table)).collect()}
    text = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t, _ in rows[:36])
    loss = "".join(t or "" for _, _, r, t, _ in rows[:36] if r == "assistant")
    assert got[1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[None].n_turns == 1 and got[2].n_turns == 2
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_chat_parts():
    def part(kind, **more):
        return {"type": kind, "text": None, "uri": None, "width": None, "height": None, "seconds": None, "pages": None} | more

    parts = [
        part("text", text="look "),
        part("image", uri="i.png", width=100, height=57),
        part("audio", uri="a.wav", seconds=2.5),
        part("document", uri="d.pdf", pages=3),
        part("text", text=" <|image 3.0|>"),
    ]
    made = chat.format_turn(3, "assistant", parts, chat.Costs(), ("assistant",))
    assert made["formatted"] == "### assistant: look <|image 3.0|><|audio 3.1|><|document 3.2|> \\<|image 3.0|></turn>\n"
    assert [(a["uri"], a["tokens"]) for a in made["attachments"]] == [("i.png", 12), ("a.wav", 63), ("d.pdf", 1800)]
    assert all(made["formatted"][a["at"] :].startswith(f"<|{a['type']}") for a in made["attachments"])
    assert made["n_tokens"] == 2 + 12 + 63 + 1800 + 4
    spans = [made["formatted"][m["start"] : m["end"]] for m in made["mask"]]
    assert [chat.unescape(s) for s in spans] == ["look ", " <|image 3.0|>"]
    with pytest.raises(ValueError):
        chat.format_turn(0, "user", [part("video")], chat.Costs(), ())


@pytest.fixture(scope="module")
def model(spark):
    return html_extract.train(spark, 600)


def test_marginals_are_exact(model):
    """Messages agree with the sum over all labellings of a small tree."""
    page = html_extract.read_page("<div><p>one two three</p><ul><li><a>x</a></li></ul></div><p class=ad>buy</p>")
    n = len(page.parent)
    total, content = 0.0, [0.0] * n
    for labels in itertools.product((0, 1), repeat=n - 1):
        labels = (1, *labels)
        log = 0.0
        for i in range(1, n):
            log += model.edge[labels[page.parent[i]]][labels[i]]
            log += sum(model.emission.get(f, model.unseen)[labels[i]] for f in page.features(i))
        total += math.exp(log)
        for i in range(n):
            content[i] += math.exp(log) * labels[i]
    got = html_extract.marginals(page, model)
    assert got == pytest.approx([c / total for c in content])


def test_held_out_pages(model):
    wrong = total = 0
    for seed in range(10_000, 10_100):
        page = html_extract.read_page(html_extract.labelled_page(seed))
        for i, p in enumerate(html_extract.marginals(page, model)):
            if i and page.label[i] >= 0:
                total += page.size[i]
                wrong += page.size[i] * ((p >= 0.5) != (page.label[i] == 1))
    assert wrong < 0.03 * total


def test_main_text(model):
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script>
    <body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><div class="ad">Buy it now</div>
    <div class="cookie-notice">We use cookies here.</div>
    <article><h1>A &amp; B</h1><p><b>First
      line&nbsp;here, with words enough.<br><p>Second &lt;one&gt; goes on and on with more words.</p>
    <aside class="sidebar"><p>Other stories</p></aside>
    <section class="comments"><div class="comment"><p>A long comment of a reader who likes the story very much.</p></div></section>
    </article><form><p>Subscribe</p></form><footer>&copy; us</footer>"""
    assert html_extract.main_text(page, model) == (
        "A & B\nFirst line here, with words enough.\nSecond <one> goes on and on with more words."
    )


def test_odd_pages(spark, model):
    rows = [(1, None, None, 1), (2, "u", "", 1), (3, "u", "just text & more", 1), (3, "u", "<![x]]>", 1), (None, None, "<p>" * 3000 + "deep", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = html_extract.extract_pages(pages, model).collect()
    assert [r.text for r in got[:3]] == ["", "", "just text & more"] and len(got) == 5
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract_pages(pages.limit(0), model).count() == 0
