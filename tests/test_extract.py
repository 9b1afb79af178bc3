"""Pages written by hand, in the layout the rules describe, and pages that are not tidy."""

import datetime as dt

from pyspark.sql import functions as F

from forumflow.operators.extract import (
    LINK,
    POST_LAYOUT,
    TITLE,
    assemble_items,
    drop_promoted,
    extract_firsts,
    extract_posts,
    resolve_url,
)
from forumflow.operators.markup import Nodes, parse, text_nodes
from forumflow.plans.batch import empty_state, run_staged
from forumflow.schemas import PAGE, POST_ITEM
from forumflow.sources.pages import items_from_pages, linkless_cards, post_links

AT = dt.datetime(2024, 5, 1, 12)
BASE = "https://forum.example"


def card(label, href):
    shown = f"<span>{label}</span>" if label is not None else ""
    link = f'<a href="{href}">go</a>' if href is not None else ""
    return (
        "<div>"
        f"<div></div><div><div><div><div>{shown}<span>x</span></div></div></div></div>"
        f"<div><div><div></div><div><div>{link}</div></div></div></div>"
        "</div>"
    ).replace("<span>x</span>", "" if label is None else "<span>x</span>")


def listing(*cards):
    inner = "<div></div><div></div><div></div><div>" + "".join(cards) + "</div>"
    return (
        "<html><body><div id='SHORTCUT_FOCUSABLE_DIV'><div></div><div><div><div><div><div></div>"
        f"<div><div></div><div></div><div><div>{inner}</div></div></div>"
        "</div></div></div></div></div></body></html>"
    )


def comment(author, votes, age, *paragraphs):
    user = f'<a href="/user/{author}/">{author}</a>' if author else ""
    when = f'<a id="CommentTopMeta--Created--1">{age}</a>' if age else ""
    text = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f'<div><div><a href="/other">no</a>{user}{when}'
        f'<div id="vote-arrows-c"><div>{votes}</div></div><div><div>{text}</div></div></div></div>'
    )


def post_page(title, author, age, votes, percent, paragraphs, comments, block=6):
    blocks = "".join(
        f"<div><div></div><div><span>{percent}</span></div></div>" if n == block else "<div></div>"
        for n in range(1, 7)
    )
    text = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f"""<html><head><script>var t="<p>no</p>";</script></head><body>
<div><div></div><div><div><div><div><a href="/u">{author}</a></div></div></div></div></div>
<h1>{title}</h1><a data-click-id="timestamp">{age}</a>
<div id="vote-arrows-1"><button></button><div>{votes}</div></div>
<div data-test-id="post-content">{blocks}<div><div>{text}</div></div></div>
<div style="--commentswrapper-gradient-color:#fff"><div>{"".join(comments)}</div></div>
</body></html>"""


def page(url, kind, seq, html, community="stocks"):
    return (url, community, kind, AT, seq, html)


def pages(spark):
    return spark.createDataFrame(
        [
            page(f"{BASE}/r/stocks/new", "listing", 1, listing(
                card("u/a", "/p/1"), card("promoted", "/p/2"), card("Promoted", "/p/3"),
                card(None, "/p/4"), card("u/b", None), card("u/c", "https://else.example/p/5"),
            )),
            page(f"{BASE}/p/1", "post", 2, post_page(
                "One &amp; only", "u/a", "3 hours ago", "1.2k", "97% Upvoted",
                ["first <b>lost</b> tail", "", "<i>in</i> rest"],
                [comment("x", "5", "2 hours ago", "c1", "", "c2"), comment("y", "Vote", None, "c3")],
            )),
            page(f"{BASE}/p/2", "post", 3, post_page("Paid", "u/p", "just now", "1", "1% Up", [], [])),
            page(f"{BASE}/p/3", "post", 4, post_page(
                "Three", "u/c", "just now", "•", "50% Upvoted", [], [], block=5
            )),
            page("https://else.example/p/5", "post", 5, "<p>nothing here"),
        ],
        PAGE,
    )


def test_links_and_cards(spark):
    links = {r.url for r in post_links(pages(spark), BASE).collect()}
    assert links == {f"{BASE}/p/1", f"{BASE}/p/3", "https://else.example/p/5"}
    assert [(r.reason, r.pos) for r in linkless_cards(pages(spark)).collect()] == [("href", 4)]


def test_items(spark):
    items = {r.seq: r for r in items_from_pages(pages(spark), BASE).collect()}
    assert set(items) == {2, 4, 5}
    one = items[2]
    assert one.asDict()["postTitle"] == "One & only"
    assert (one.postUserName, one.postTimeSince, one.postUpVotes) == ("u/a", "3 hours ago", "1.2k")
    assert one.postPercentUpVotes == "97% Upvoted"
    assert one.postText == ["first ", None, "in"]
    first, second = one.comments
    assert first.asDict() == {
        "commentUserName": "x",
        "commentUpVotes": "5",
        "commentTimeSince": "2 hours ago",
        "commentText": ["c1", None, "c2"],
    }
    assert (second.commentUserName, second.commentUpVotes, second.commentTimeSince) == ("y", "Vote", None)
    assert items[4].postPercentUpVotes == "50% Upvoted"
    assert (items[5].postTitle, items[5].comments, items[5].postText) == (None, [], [])


def test_pages_to_state(spark):
    items = items_from_pages(pages(spark), BASE)
    assert items.schema == POST_ITEM
    out = run_staged(items, empty_state(spark), AT)
    posts = {r.title: r for r in out["post"].collect()}
    assert set(posts) == {"One & only", "Three"}
    assert posts["One & only"].upvotes == 1200
    assert posts["One & only"].datetime == AT - dt.timedelta(hours=3)
    assert posts["One & only"].comment_count == 2
    assert [(r.text, r.upvotes) for r in out["comment"].collect()] == [("c1 c2", 5)]
    rejects = {(r.stage, r.reason, r.seq, r.pos) for r in out["rejects"].collect()}
    assert rejects == {("post", "votes", 5, None), ("comment", "incomplete", 2, 1)}
    assert {r.datetime for r in out["post_mark"].collect()} == {AT - dt.timedelta(hours=3)}
    assert {r.datetime for r in out["comment_mark"].collect()} == {AT - dt.timedelta(hours=2)}


def test_text_nodes():
    root = parse("<div>a<b>b<i>c</i>d</b>e<!-- x -->f<br>g</div>")
    assert [t for _, t in text_nodes(root)] == list("abcdefg")
    rule = Nodes(".//b")
    assert rule.first_text(root) == "b"
    # Elements without text of their own are passed over.
    assert Nodes(".//div").first_text(parse("<div><p>x</p><div>y</div>z</div>")) == "y"
    assert Nodes(".//div").first_text(parse("<div><b>x</b></div>")) is None


def test_document_order_not_path_order():
    root = parse("<div><div><p>1</p></div><p>2</p></div>")
    assert Nodes(".//div/p").paragraph_texts(root) == ["1", "2"]


def test_untidy_markup():
    root = parse('<p>a<p>b<ul><li>x<li>y</ul><p>c<br>d</div></p><td>e<script>"</p>"</script>')
    assert [p.text for p in root.findall(".//p")] == ["a", "b", "c"]
    assert [p.text for p in root.findall(".//li")] == ["x", "y"]
    for odd in ("", "<", "<![", "<!", "</", "<a href=", "&#xFFFFFFF;", "<![CDATA[x]]>", "<?x", "\x00"):
        parse(odd)
    parse("<div>" * 20000 + "x")


def test_unreadable_page_is_one_empty_record(spark):
    rows = spark.createDataFrame([(1, None), (2, "<h1>ok</h1>")], "k int, html string")
    out = extract_posts(rows, POST_LAYOUT, ["k"]).sort("k").collect()
    assert [r.postTitle for r in out] == [None, "ok"]


def test_first_text_and_link(spark):
    pages = {
        "<h1></h1><h1>second</h1>": ("second", None),
        "<h1><b>x</b>y</h1>": ("y", None),
        "<H1 id=t>A &amp; B</H1><a name=n>n</a><a href=/x?a=1&amp;b=2>l</a>": ("A & B", "/x?a=1&b=2"),
        "<!-- <h1>no</h1> --><script>'<h1>no</h1>'</script><h1>yes</h1><A HREF='/q'>": ("yes", "/q"),
        "<h10>no</h10>": (None, None),
        "": (None, None),
    }
    rows = spark.createDataFrame([(h,) for h in pages], "h string")
    out = extract_firsts(rows.withColumn("html", F.col("h")), {"t": TITLE, "a": LINK}, ["h"]).collect()
    assert {r.h: (r.t, r.a) for r in out} == pages


def test_promoted_and_urls(spark):
    cards = spark.createDataFrame(
        [("promoted", "/1"), ("Promoted", "/2"), (None, "/3"), (" promoted", "http://x/4"), ("a", None)],
        "label string, href string",
    )
    out = drop_promoted(cards).select(resolve_url("http://b", F.col("href")).alias("u")).collect()
    assert [r.u for r in out] == ["http://b/2", "http://x/4", None]


def test_assembly_in_parts(spark):
    posts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, community string")
    comments = spark.range(25).selectExpr("1 k", "id pos", "struct(cast(id as string) t) comment")
    comments = comments.union(spark.sql("select 2, 0L, struct('z')"))
    out = assemble_items(posts, comments.repartition(3), ["k"], part_size=10)
    rows = {(r.k, r.pos_offset): r for r in out.collect()}
    assert set(rows) == {(1, 0), (1, 10), (1, 20), (2, 0), (3, 0)}
    assert [c.t for c in rows[1, 10].comments] == [str(n) for n in range(10, 20)]
    assert len(rows[1, 20].comments) == 5
    assert {k: r.comment_total for (k, o), r in rows.items()} == {1: 25, 2: 1, 3: 0}
    assert rows[3, 0].comments == []


def test_parts_count_once(spark):
    """A discussion that arrives in parts gives the same state as in one piece."""
    posts = spark.sql(
        "select 1L seq, 'stocks' community, timestamp_ntz'2024-05-01 12:00:00' captured_at, 'T' postTitle,"
        " 'u' postUserName, 'just now' postTimeSince, '3' postUpVotes, array('p') postText"
    )
    comments = spark.range(25).selectExpr(
        "1L seq", "id pos",
        "struct('u' commentUserName, '1' commentUpVotes, concat(id, ' hours ago') commentTimeSince,"
        " array(concat('t', id % 20)) commentText) comment",
    )
    state = empty_state(spark)
    bad = posts.selectExpr("2L seq", "community", "captured_at", "'B' postTitle", "postUserName",
                           "postTimeSince", "'many' postUpVotes", "postText")
    posts = posts.union(bad)
    comments = comments.union(comments.selectExpr("2L", "pos", "comment"))
    whole = run_staged(assemble_items(posts, comments, ["seq"]), state, AT)
    assert whole["rejects"].count() == 1
    parts = run_staged(assemble_items(posts, comments, ["seq"], part_size=4), state, AT)
    for name in whole:
        assert sorted(whole[name].collect(), key=str) == sorted(parts[name].collect(), key=str)
    assert parts["post"].first().comment_count == 25
    assert parts["comment"].count() == 20
    lost = assemble_items(posts, comments, ["seq"], part_size=4).filter("pos_offset > 0")
    late = run_staged(lost, state, AT)
    assert late["comment"].count() == late["post"].count() == 0
    assert [(r.stage, r.reason) for r in late["rejects"].collect()] == [("comment", "post")] * 21
