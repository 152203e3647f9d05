"""Main text of web pages, by agreement between the pages of a host.

A page's containers are scored by the running text that lies in them. Each page votes for the generalised
tag-class paths of its containers; votes are added up for each host in Spark. Then the pages are read
again, and the text is taken from the elements on the best path of their host that a page has. So a page
whose own scores mislead (a long sidebar, a short article) is read like its neighbours.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayloom.llm.common import join_few, lower_ascii, row_batches, scratch, stored

# Elements without content, with unparsed text, within lines, and how open ones end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img br".split()
)
CLOSES = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
#: An open element further out than one of these is not ended by a new one of its kind.
SCOPES = frozenset("ul ol menu dl table select body article section main".split())
CONTAINERS = frozenset("#page body main article section div td center".split())

# What is not the article: by element, and by the first or last word of a class, id or role.
ASIDE = frozenset(
    "head script style noscript template title nav header footer aside form button select textarea iframe object svg "
    "canvas dialog menu xmp noembed noframes math audio video".split()
)
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies dialog disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination pager popup promo promotion related replies reply respond responses search share sharing sidebar signup "
    "social sponsor sponsored subscribe toolbar widget".split()
)
KEPT_TAGS = frozenset("html body main article".split())
GOOD_WORDS = frozenset("article content entry main post story text".split())

#: Labels of a path, from the element outwards.
DEPTH = 32
#: Share of a paragraph's weight that each further container around it gets, and how far out.
PASSED_ON, REACH = 0.5, 4
GOOD = 2.0
#: Votes for a page's best path; paths under a tenth of it get none.
FULL_VOTE, LEAST_VOTE = 1000, 100
#: A host's list of winning paths; a page that has none of them goes by its own best one.
WINNERS = 16

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_TAG_END = re.compile(r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>""")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?""")
_WORD = re.compile(r"[A-Za-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Page:
    """Elements in page order (parent, label, whether aside), and blocks of text with their element."""

    parents: list[int] = field(default_factory=lambda: [-1])
    tags: list[str] = field(default_factory=lambda: ["#page"])
    labels: list[str] = field(default_factory=lambda: ["#page"])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def path(self, element: int) -> str:
        labels: list[str] = []
        while element >= 0 and len(labels) < DEPTH:
            labels.append(self.labels[element])
            element = self.parents[element]
        return ">".join(reversed(labels))

    def containers(self) -> list[int]:
        """Of each element the nearest container, itself included."""
        out: list[int] = []
        for e, tag in enumerate(self.tags):
            out.append(e if tag in CONTAINERS or "-" in tag else out[self.parents[e]])
        return out


def _is_aside(tag: str, given: dict[str, str]) -> bool:
    if tag in ASIDE or "hidden" in given or given.get("aria-hidden") == "true" or _HIDDEN.search(given.get("style", "")):
        return True
    if tag in KEPT_TAGS:
        return False
    for name in f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}".split():
        words = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))
        words = [w.lower() for w in words]
        if words and words[0] not in ("no", "has", "with") and (words[0] in ASIDE_WORDS or words[-1] in ASIDE_WORDS):
            return True
    return False


def parse(html: str) -> Page:
    """The page's elements and blocks of text; what lies in asides, scripts and comments gives no block."""
    page = Page()
    stack, open_tags = [0], defaultdict(int)
    asides = links = 0  # open ones
    aside = [False]
    text: list[str] = []
    link_chars = 0
    balanced = True

    def flush() -> None:
        nonlocal link_chars
        if text:
            if words := " ".join("".join(text).split()):
                page.blocks.append((next(e for e in reversed(stack) if page.tags[e] not in INLINE), words, link_chars))
            text.clear()
        link_chars = 0

    def pop() -> None:
        nonlocal asides, links
        e = stack.pop()
        open_tags[page.tags[e]] -= 1
        asides -= aside[e]
        links -= page.tags[e] == "a"

    def close(tags: frozenset[str], stop: frozenset[str]) -> None:
        """End the nearest open element of `tags`, and all within, unless one of `stop` comes first."""
        for n in range(len(stack) - 1, 0, -1):
            found = page.tags[stack[n]]
            if found in tags:
                while len(stack) > n:
                    pop()
                return
            if found in stop:
                return

    def data(value: str) -> None:
        nonlocal link_chars
        if value and not asides:
            value = unescape(value) if "&" in value else value
            text.append(value)
            if links:
                link_chars += len(value)

    at, n = 0, len(html)
    while at < n:
        start = html.find("<", at)
        if start < 0:
            data(html[at:])
            break
        data(html[at:start])
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        ending = html.startswith("/", start + 1)
        name = _NAME.match(html, start + 1 + ending)
        if not name:
            if html[start + 1 : start + 2] in ("!", "?", "/"):
                end = html.find(">", start)
                at = n if end < 0 else end + 1
            else:
                data("<")
                at = start + 1
            continue
        end = _TAG_END.match(html, name.end()) if balanced else None
        if end:
            at = end.end()
        else:
            # A quote is open to the end of the page: from here on quotes mean nothing.
            balanced = False
            found = html.find(">", name.end())
            at = n if found < 0 else found + 1
        tag = name[0].lower()
        inline = tag in INLINE
        if ending:
            if not inline:
                flush()
            if open_tags[tag]:
                if inline:
                    for m in range(len(stack) - 1, 0, -1):
                        if page.tags[stack[m]] == tag:
                            while len(stack) > m:
                                pop()
                            break
                        if page.tags[stack[m]] not in INLINE:
                            break
                else:
                    close(frozenset((tag,)), frozenset())
            elif tag == "br":
                data(" ")
            continue
        if tag == "br":
            data(" ")
            continue
        if not inline:
            flush()
            # A paragraph holds inline elements only, so it is open if it comes right under those.
            if open_tags["p"]:
                for e in reversed(stack):
                    if page.tags[e] == "p":
                        close(frozenset(("p",)), frozenset())
                    if page.tags[e] not in INLINE:
                        break
            if tag in CLOSES:
                close(CLOSES[tag], SCOPES)
        if tag in VOID:
            continue
        attributes = html[name.end() : at - 1] if at > name.end() else ""
        given: dict[str, str] = {}
        if attributes.strip(" /"):
            for a in _ATTRIBUTE.finditer(attributes):
                given.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
        e = len(page.tags)
        classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in given.get("class", "").split()})
        page.parents.append(stack[-1])
        page.tags.append(tag)
        page.labels.append(".".join((tag, *classes)))
        aside.append(_is_aside(tag, given))
        if tag in RAW:
            # Nothing within is markup, and none of it belongs to the text.
            found = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(html, at)
            end = html.find(">", found.end()) if found else -1
            at = n if end < 0 else end + 1
            continue
        if attributes.endswith("/") and tag not in KEPT_TAGS and "-" in tag:
            continue
        stack.append(e)
        open_tags[tag] += 1
        asides += aside[e]
        links += tag == "a"
    flush()
    return page


def scores(page: Page) -> dict[str, float]:
    """By path: the text of its containers in whole, of those within by half for each level; links count against it."""
    nearest = page.containers()
    own: dict[int, float] = defaultdict(float)
    for element, words, link_chars in page.blocks:
        own[nearest[element]] += max(0, len(words) - 2 * link_chars)
    found: dict[int, float] = defaultdict(float)
    for container, weight in own.items():
        for _ in range(REACH + 1):
            found[container] += weight
            weight *= PASSED_ON
            if page.parents[container] < 0:
                break
            container = nearest[page.parents[container]]
    out: dict[str, float] = defaultdict(float)
    for container, score in found.items():
        label = page.labels[container]
        good = page.tags[container] in ("article", "main") or GOOD_WORDS & set(_WORD.findall(label.partition(".")[2]))
        out[page.path(container)] += score * (GOOD if good else 1.0)
    return out


def votes(page: Page) -> dict[str, int]:
    found = scores(page)
    most = max(found.values(), default=0.0)
    shares = {path: int(FULL_VOTE * score / most) for path, score in found.items()} if most else {}
    return {path: share for path, share in shares.items() if share >= LEAST_VOTE}


def best_path(found: dict[str, int]) -> str | None:
    """The most votes; of equal ones the first by text."""
    return min(found, key=lambda p: (-found[p], p), default=None)


def text_on(page: Page, paths: Iterable[str]) -> tuple[str | None, str]:
    """The first of the paths under which the page has text, and that text, a line for each block."""
    nearest = page.containers()
    known = {c: page.path(c) for c in set(nearest)}
    present = set(known.values())
    for path in paths:
        if path in present:
            inside: list[bool] = []
            for e, parent in enumerate(page.parents):
                inside.append((parent >= 0 and inside[parent]) or (nearest[e] == e and known[e] == path))
            if lines := [words for element, words, _ in page.blocks if inside[element]]:
                return path, "\n".join(lines)
    return None, ""


def _hosts(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host = lower_ascii(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)).alias("host")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host, html)


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path, votes and pages: what each host's pages make of each path. Pages without a host have no vote."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            out = [
                (host, path, share)
                for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)
                for path, share in votes(parse(html)).items()
            ]
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "path", "votes"])

    hosts = _hosts(pages).where("host <> ''").select("host", "html")
    cast = hosts.mapInArrow(run, "host string, path string, votes bigint")
    return cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.count("*").alias("pages"))


def winning_paths(voted: DataFrame, winners: int = WINNERS) -> DataFrame:
    """host and its paths by falling votes, equal ones by text."""
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    first = voted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= winners)
    listed = F.sort_array(F.collect_list(F.struct("_rank", "path")))
    return first.groupBy("host").agg(listed.alias("_paths")).select("host", F.col("_paths.path").alias("paths"))


def extract_text(pages: DataFrame, winners: int = WINNERS) -> DataFrame:
    """page_id, url, host, path (the one the text was taken from) and text of each row of `pages`.

    One row for each row, repeated and null ids included. A null html is empty, and a page without text
    has an empty text and no path. A page goes by the first path in its host's list under which it has
    text, or else by its own best one, as do pages without a host (no url, or none with `://`). Text
    outside of all containers belongs to the page itself. Pages of any length are read whole. Other
    columns are not looked at.
    """
    spark = pages.sparkSession
    agreed = stored(winning_paths(host_paths(pages), winners), f"{scratch(spark)}/paths")
    rows = join_few(_hosts(pages), agreed, ["host"], [F.col("page_id"), F.col("url")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            taken = []
            for html, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist(), strict=True):
                page = parse(html)
                path, text = text_on(page, paths or ())
                if path is None and (own := best_path(votes(page))):
                    path, text = text_on(page, [own])
                if path is None:
                    path, text = text_on(page, ["#page"])
                taken.append((path, text))
            columns = list(zip(*taken, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "url", "host")), *(pa.array(c, pa.string()) for c in columns)],
                ["page_id", "url", "host", "path", "text"],
            )

    shape = "page_id bigint, url string, host string, path string, text string"
    return rows.select("page_id", "url", "host", "html", "paths").mapInArrow(run, shape)
