"""Pages: crawl levels, regions, links, text blocks.

Pages are rows (page_id, url, html). Native expressions serve well-formed regions; ``clean_html`` parses where
structure matters. Null html counts as an empty page.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from weftgraph.functions import vocab

#: Element classes that are noise on encyclopedia pages, and tags that hold no content.
NOISE = {"top-tool", "after-content", "right-box", "lemma-album", "lemma-relation", "before-content", "references", "navbox", "ambox", "hatnote", "thumbcaption", "mw-editsection", "printfooter", "catlinks"}
DROPPED = {"script", "style", "nav", "header", "footer", "aside", "noscript"}
#: What is taken out of an encyclopedia host's main content, and out of a wiki's content.
HOST_NOISE = {"top-tool", "after-content", "right-box", "lemma-album", "lemma-relation", "before-content"}
WIKI_NOISE = {("ol", "references"), ("div", "navbox"), ("table", "ambox"), ("div", "hatnote"), ("div", "thumbcaption"), ("span", "mw-editsection"), ("div", "printfooter"), ("div", "catlinks")}
TRAILING = ("参见", "外部链接", "参考文献", "注释", "脚注")
HEADINGS = {"h2", "h3", "h4"}
BODY_NOISE = {"nav", "header", "footer", "aside", "script", "style"}
HOST = "baike.baidu.com"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: A link: its address in double quotes, in single ones, or bare; what it encloses.
ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""


def seeds(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that are not blank, stripped."""
    return lines.select(F.trim(F.col(column)).alias("url")).where("url != ''")


def file_key(url: Column) -> Column:
    return F.concat(F.md5(url), F.lit(".html"))


def needs_render(html: Column) -> Column:
    """Short pages, and pages that ask for scripts, are to be rendered in a browser."""
    h = F.coalesce(html, F.lit(""))
    return (F.char_length(h) < 500) | F.contains(F.lower(h), F.lit("<noscript>"))


def after_offset(pages: DataFrame, n: int) -> DataFrame:
    """Pages from place ``n`` on, in the stable order of their keys."""
    # a global rank from ranks within sixteen key ranges and the sizes of the ranges before
    ranged = pages.withColumn("key", file_key(F.col("url"))).withColumn("r", F.substr("key", F.lit(1), F.lit(1)))
    before = ranged.groupBy("r").agg(F.count("*").alias("c"))
    total = before.select("r", (F.sum("c").over(Window.orderBy("r")) - F.col("c")).alias("before"))  # sixteen rows
    own = F.row_number().over(Window.partitionBy("r").orderBy("key", "page_id"))
    return ranged.withColumn("own", own).join(F.broadcast(total), "r").where(F.col("own") + F.col("before") > n).drop("r", "own", "before")


def source_url(html: Column) -> Column:
    """The page's own URL from a header line, a lemma title or an encyclopedia title; null where there is none."""
    head = F.regexp_extract(F.array_join(F.slice(F.split(html, "\n"), 1, 10), "\n"), r"URL:\s*([^\n]*)", 1)
    head = F.regexp_replace(F.trim(head), r"[\s>-]+$", "")
    item = lambda title: F.concat(F.lit("https://baike.baidu.com/item/"), F.replace(F.url_encode(title), F.lit("+"), F.lit("%20")))
    lemma = F.regexp_extract(html, r'data-lemmatitle="([^"]+)"', 1)
    title = F.regexp_extract(html, r"<title>([^<]*)_百度百科</title>", 1)
    return F.when(head != "", head).when(lemma != "", item(lemma)).when(title != "", item(title))


def region(html: Column) -> Column:
    """The first content region of well-formed pages: article, main, or body."""
    out = html
    for tag in ("body", "main", "article"):
        got = F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)
        out = F.when(got != "", got).otherwise(out)
    return out


def plain(html: Column) -> Column:
    """Text of a fragment: scripts, styles, comments and tags dropped, spaces joined."""
    t = F.regexp_replace(html, r"(?is)<(script|style|nav|footer|header|aside)(\s[^>]*)?>.*?</\1>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"<[^>]*>", " "), r"[ \t\r\n]+", " "))


class _Blocks(HTMLParser):
    """Text of kept elements, and of infobox and summary elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.main: list[str] = []
        self.found: list[tuple[str, list[str]]] = []

    def handle_starttag(self, tag, attrs):
        classes = set((dict(attrs).get("class") or "").split())
        kind = "drop" if tag in DROPPED or classes & NOISE else ""
        if classes & {"infobox", "infobox_v2", "infobox_v3"}:
            kind = "bs4_infobox"
        elif tag == "p" and ("summary" in classes or self.stack and self.stack[-1][1] == "abstract"):
            kind = "bs4_summary"
        elif tag == "div" and "abstract" in classes:
            kind = "abstract"
        if kind.startswith("bs4"):
            self.found.append((kind, []))
        if tag not in VOID:
            self.stack.append((tag, kind))

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return

    def handle_data(self, data):
        kinds = [k for _, k in self.stack]
        if "drop" in kinds or not data.strip():
            return
        self.main.append(data.strip())
        if any(k.startswith("bs4") for k in kinds):
            self.found[-1][1].append(data.strip())


class _Elements(HTMLParser):
    """Elements in order of their start: (tag, id, classes, start, inner end, end, parent), places counted in the source."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.html, self.all, self.open, self.count = html, [], [], Counter()
        self.line = [0, *(m.end() for m in re.finditer("\n", html))]
        self.feed(html)
        self.close()
        for k in self.open:
            self.all[k][4] = self.all[k][5] = len(html)

    def place(self) -> int:
        line, column = self.getpos()
        return self.line[line - 1] + column

    def handle_starttag(self, tag, attrs):
        a, start = dict(attrs), self.place()
        end = start + len(self.get_starttag_text())
        self.all.append([tag, a.get("id") or "", set((a.get("class") or "").split()), start, end, end, self.open[-1] if self.open else None])
        if tag not in VOID:
            self.open.append(len(self.all) - 1)
            self.count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.count[tag] -= 1
            self.open.pop()

    def handle_endtag(self, tag):
        if not self.count[tag]:
            return
        at = self.place()
        while True:  # elements left open end where the one around them does
            e = self.all[self.open.pop()]
            self.count[e[0]] -= 1
            e[4] = e[5] = at
            if e[0] == tag:
                e[5] = (self.html.find(">", at) + 1) or len(self.html)
                return


def clean_html(html: str | None, url: str | None = None) -> str:
    """The content of a page, as its source has it: an encyclopedia host's main content, a wiki's content without its
    noise and trailing sections, the first article, the first main element, the body without navigation, or the whole
    page. Elements left open end with the one around them. Null html is an empty page."""
    html = html or ""
    found = _Elements(html).all
    first = lambda ok: next((e for e in found if ok(e)), None)
    tag = lambda name: first(lambda e: e[0] == name)
    gone: list[tuple[int, int]] = []
    if HOST in (url or ""):
        part = first(lambda e: e[0] == "div" and "main-content" in e[2])
        if part:
            gone = [(e[3], e[5]) for e in found if e[2] & HOST_NOISE and e is not part]
        part = part or tag("body")
    elif part := first(lambda e: e[0] == "div" and e[1] == "mw-content-text"):
        gone = [(e[3], e[5]) for e in found if any((e[0], c) in WIKI_NOISE for c in e[2])]
        for name in TRAILING:
            e = first(lambda e: e[0] == "span" and e[1] == name and part[3] <= e[3] < part[5])  # noqa: B023
            while e and e[0] not in HEADINGS:
                e = None if e[6] is None else found[e[6]]
            if e and e[3] > part[3]:  # from the heading to the next one beside it, or to the end of what holds both
                stop = next((x[3] for x in found if x[6] == e[6] and x[0] in HEADINGS and x[3] > e[3]), found[e[6]][4])
                gone.append((e[3], stop))
    elif not (part := tag("article") or tag("main")) and (part := tag("body")):
        gone = [(e[3], e[5]) for e in found if e[0] in BODY_NOISE]
    at, end = (part[3], part[5]) if part else (0, len(html))
    out = []
    for a, b in sorted(gone):
        if at <= a < end:
            out.append(html[at:a])
        at = max(at, b) if a < end else at
    return "".join([*out, html[at:end]])


@F.pandas_udf(StringType())
def clean_udf(html: pd.Series, url: pd.Series) -> pd.Series:
    return pd.Series([clean_html(h, u) for h, u in zip(html, url)])


def cleaned(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html) with the content of each page in place of its html."""
    return pages.withColumn("html", clean_udf("html", "url"))


def parse_blocks(html: str | None) -> list[tuple[str, str]]:
    """(source, text) of a page: its main text, infoboxes, summaries; empty ones and repeated texts left out."""
    p = _Blocks()
    p.feed(html or "")
    p.close()
    all_ = [("main", " ".join(p.main)), *((k, "\n".join(t)) for k, t in p.found)]
    seen: dict[str, str] = {}
    for source, text in all_:
        if text.strip():
            seen.setdefault(text.strip(), source)
    return [(s, t) for t, s in seen.items()]


@F.pandas_udf(ArrayType(StructType([StructField("source", StringType()), StructField("text", StringType())])))
def blocks_udf(html: pd.Series) -> pd.Series:
    return pd.Series([[{"source": s, "text": t} for s, t in parse_blocks(h)] for h in html])


def text_blocks(pages: DataFrame) -> DataFrame:
    """(url, block_id, source, text): blocks of each page in order, each text once."""
    rows = pages.select("url", F.posexplode(blocks_udf("html")).alias("pos", "b"))
    return rows.select("url", (F.col("pos") + 1).alias("block_id"), "b.source", "b.text")


def first_of_text(blocks: DataFrame) -> DataFrame:
    """The first block of each text of a page."""
    w = Window.partitionBy("url", "text").orderBy("block_id")
    return blocks.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def batches(blocks: DataFrame, size: int = 3) -> DataFrame:
    """Chunks of ``size`` blocks of a page; ids count from 1 within the chunk."""
    w = Window.partitionBy("url").orderBy("block_id")
    rows = blocks.withColumn("p", F.row_number().over(w) - 1)
    rows = rows.select("url", F.floor(F.col("p") / size).cast("int").alias("chunk"), (F.col("p") % size + 1).alias("id"), "text")
    return rows.groupBy("url", "chunk").agg(F.sort_array(F.collect_list(F.struct("id", "text"))).alias("blocks"))


def links(pages: DataFrame) -> DataFrame:
    """(page_id, url, pos, href, link_text): every link of a page, in order."""
    found = F.arrays_zip(*(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(k)).alias(n) for k, n in enumerate(("a", "b", "c", "inner"), 1)))
    rows = pages.select("page_id", "url", F.posexplode(found).alias("pos", "l"))
    return rows.select("page_id", "url", "pos", F.concat_ws("", "l.a", "l.b", "l.c").alias("href"), plain(F.col("l.inner")).alias("link_text"))


def followable(text: Column) -> Column:
    """Link texts of two characters at least, not digits alone, without a stop word."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return (F.char_length(t) >= 2) & ~t.rlike("^[0-9]+$") & ~F.lower(t).rlike("|".join(vocab.LINK_STOP_WORDS))


def resolved(url: Column, href: Column) -> Column:
    """The absolute URL of a link against scheme and host of its page, without query and fragment."""
    root = F.regexp_extract(url, "^([A-Za-z]+://[^/?#]*)", 1)
    bare = F.regexp_replace(href, "[?#].*$", "")
    return F.when(bare.rlike("^[A-Za-z]+://"), bare).when(bare.startswith("//"), F.concat(F.regexp_extract(url, "^([A-Za-z]+:)//", 1), bare)).otherwise(F.concat(root, F.when(bare.startswith("/"), bare).otherwise(F.concat(F.lit("/"), bare))))


def admissible(url: Column, href: Column, target: Column) -> Column:
    """Links to the same host, without fragment, without a colon in the path."""
    host = lambda u: F.regexp_extract(u, "^[A-Za-z]+://([^/?#]*)", 1)
    return target.startswith("http") & (host(url) == host(target)) & ~F.contains(href, F.lit("#")) & ~F.contains(F.regexp_replace(target, "^[A-Za-z]+://[^/]*", ""), F.lit(":"))


def next_level(frontier: DataFrame, pages: DataFrame, visited: DataFrame, max_depth: int = 5) -> DataFrame:
    """One level of a breadth-first crawl: (url, depth, history) of links not yet visited, each once.

    The first arrival wins: by depth, then by the page and place of the link.
    """
    here = frontier.where(F.col("depth") < max_depth).join(pages.select("page_id", "url", "html"), "url")
    found = links(here.select("page_id", "url", "html")).where(followable(F.col("link_text")))
    found = found.withColumn("target", resolved(F.col("url"), F.col("href"))).where(admissible(F.col("url"), F.col("href"), F.col("target")))
    found = found.join(visited.select(F.col("url").alias("target")), "target", "left_anti")
    first = found.groupBy("target").agg(F.min(F.struct("page_id", "pos", "url")).alias("f"))  # partial aggregation: hot targets stay narrow
    rows = first.select("target", F.col("f.url").alias("url")).join(frontier, "url")
    return rows.select(F.col("target").alias("url"), (F.col("depth") + 1).alias("depth"), F.array_append("history", F.col("target")).alias("history"))


def crawl(spark, start: DataFrame, pages: DataFrame, max_depth: int = 5, max_pages: int = 50_000) -> DataFrame:
    """(url, depth, history) of the pages that breadth-first levels reach, until nothing is new or ``max_pages`` of them
    are found. URLs that no page answers are visited once and do not count."""
    from weftgraph.session import materialise

    have = pages.select("url").distinct()
    frontier = materialise(start.select("url").distinct().select("url", F.lit(0).alias("depth"), F.array("url").alias("history")), "frontier")
    seen = frontier
    for _ in range(max_depth):
        if frontier.isEmpty() or seen.join(have, "url", "left_semi").count() >= max_pages:
            break
        frontier = materialise(next_level(frontier, pages, seen, max_depth), "frontier")
        seen = seen.unionByName(frontier)
    return seen.join(have, "url", "left_semi").orderBy("depth", "url").limit(max_pages)
