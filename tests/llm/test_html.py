"""Main text of pages with known articles, and votes against counting by hand."""

from __future__ import annotations

import random
from html import escape
from html.parser import HTMLParser

import pytest

from wayloom.llm import common, html

SHAPE = "page_id bigint, url string, html string, text string, host int, path int, paths string, votes int"
WORDS = "river stone über mañana light house green window paper door".split()


def table(spark, rows):
    """Pages with columns whose names clash with those the operator gives or uses."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], SHAPE)


def said(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def page(rng, host, paragraphs, longer_sidebar=False):
    """A page in its host's template, and its article."""
    lines = [said(rng, 6), *(said(rng, rng.randint(25, 60)) for _ in range(paragraphs))]
    body = "".join(f"<p class='t{rng.randint(0, 999)}'>{escape(line)}</p>" for line in lines[1:])
    asides = f"<div class='widget-{rng.randint(0, 9)}'>Advert &amp; {said(rng, 9)}</div><form><p>Sign up<input></form>"
    box = f"<div class='box'><p>{said(rng, 400 if longer_sidebar else 8)}</p></div>"
    comments = f"<section id=comments><div class=comment><p>{said(rng, 300)}</p></div></section>"
    main = {
        0: f"<article><h1>{lines[0]}</h1>{asides}{body}</article>",
        1: f"<div class='entry-{rng.randint(1, 99)} wide'><h2>{lines[0]}</h2>{body}{comments}</div>",
        2: f"<table><tr><td class=left>{box}<td class=middle><h1>{lines[0]}</h1>{body}</table>",
    }[host]
    menu = "<nav><ul><li><a href='/a'>Home<li><a href='/b'>News</ul></nav>"
    script = "<script>var t = \"</p><p>not text\"; if (1 < 2) {}</script>"
    foot = f"<footer>&copy; {said(rng, 5)}</footer>"
    text = f"<!DOCTYPE html><html><head><title>No</title></head><body>{menu}{script}{box if host != 2 else ''}{main}{foot}</body></html>"
    return text, "\n".join(lines)


@pytest.mark.parametrize("limit", [0, common.BROADCAST_ROWS])
def test_articles_by_consensus(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(90):
        text, want[i] = page(rng, i % 3, rng.randint(2, 6), longer_sidebar=i % 10 == 7)
        rows.append((i, f"https://Host{i % 3}.example/x/{i}?a://b", text))
    got = {r["page_id"]: r for r in html.extract_text(table(spark, rows)).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert {r["host"] for r in got.values()} == {"host0.example", "host1.example", "host2.example"}
    # Some pages alone would be read wrongly: their hosts' paths set them right.
    alone = [i for i, _, text in rows if html.text_on(html.parse(text), [html.best_path(html.votes(html.parse(text)))])[1] != want[i]]
    assert alone


def test_votes_are_sums_over_pages(spark):
    rng = random.Random(9)
    rows = [(i, f"http://h{i % 2}/", page(rng, i % 3, 2)[0]) for i in range(30)]
    rows += [(None, None, rows[0][2]), (7, "no host", rows[1][2]), (8, "http://h0/", None)]
    count = {}
    for _, url, text in rows:
        if url and "://" in url and text:
            for path, share in html.votes(html.parse(text)).items():
                have = count.setdefault((url[7:9], path), [0, 0])
                have[0] += share
                have[1] += 1
    voted = html.host_paths(table(spark, rows))
    assert {(r["host"], r["path"]): [r["votes"], r["pages"]] for r in voted.collect()} == count
    ranked = {h: [p for _, p in sorted((-v[0], p) for (g, p), v in count.items() if g == h)] for h in ("h0", "h1")}
    assert {r["host"]: r["paths"] for r in html.winning_paths(voted, 2).collect()} == {h: p[:2] for h, p in ranked.items()}


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ("", ""),
        ("plain words &lt;b&gt; a &amp;amp; b", "plain words <b> a &amp; b"),
        ("<p>one<p>two <b>bold<i>er</b> x</i><br>three", "one\ntwo bolder x three"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("<p>5 < 6 &nbsp; and\t\n7 <!-- no > </p> --> 8</p>", "5 < 6 and 7 8"),
        ("<p>kept<script>x</p></SCRIPT ><style>p{}</style> too</p>", "kept\ntoo"),
        ("<p>a <span class='ad'>buy <span>now</span></span> b</p>", "a b"),
        ("<p hidden>gone</p><p style='display: none'>gone</p><p>here", "here"),
        ("<ul><li>one<li>two<ul><li>deep</ul></ul>", "one\ntwo\ndeep"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<p title='a > b'>quoted</p><a href=\"open>rest</a> of it", "quoted\nrest of it"),
        ("<p>cut <b", "cut"),
        ("</div></p></b>only ends", "only ends"),
        ("<p>&#x1F600; &#233; &eacute;</p><!-- open <p>lost</p>", "😀 é é"),
        ("<body class='has-sidebar'><p>shown</p><div class=sidebar-left>not</div>", "shown"),
        ("<svg><p>not</p></svg><pre> a\n b </pre>", "a b"),
    ],
)
def test_markup(markup, text):
    assert html.text_on(html.parse(markup), ["#page"])[1] == text


def test_blocks_agree_with_a_plain_reader():
    """On tidy pages the standard library's reader gives the same blocks."""

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.blocks, self.held = [], ""

        def flush(self):
            if words := " ".join(self.held.split()):
                self.blocks.append(words)
            self.held = ""

        def handle_starttag(self, tag, attrs):
            if tag not in html.INLINE:
                self.flush()

        def handle_endtag(self, tag):
            if tag not in html.INLINE:
                self.flush()

        def handle_data(self, data):
            self.held += data

    rng = random.Random(10)

    def tidy(depth):
        if not depth or rng.random() < 0.2:
            return escape(said(rng, 3)) + rng.choice(["", "&amp;", " <b>x</b> ", "\n"])
        tag = rng.choice(["div", "section", "em", "blockquote", "h3"])
        return f"<{tag}>" + "".join(tidy(depth - 1) for _ in range(rng.randint(0, 3))) + f"</{tag}>"

    for _ in range(300):
        markup = tidy(5).replace("<em>", "<i>").replace("</em>", "</i>")
        if "<i>" in markup:
            markup = markup.replace("<i>", "").replace("</i>", "")
        reader = Reader()
        reader.feed(markup)
        reader.close()
        reader.flush()
        assert [words for _, words, _ in html.parse(markup).blocks] == reader.blocks


def test_pages_of_nothing_and_long_ones(spark):
    deep = "<div>" * 3_000 + "<p>bottom</p>"
    long = "<article>" + "<p>word " * 100_000 + "</article>"
    rows = [(1, None, None), (1, "http://a/", ""), (None, "http://a/", deep), (2, "x://b", long), (2, "x://b", long)]
    got = [(r["page_id"], r["url"], r["text"]) for r in html.extract_text(table(spark, rows)).collect()]
    text = "\n".join(["word"] * 100_000)
    want = [(1, None, ""), (1, "http://a/", ""), (None, "http://a/", "bottom"), (2, "x://b", text), (2, "x://b", text)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert html.extract_text(table(spark, [])).count() == 0
