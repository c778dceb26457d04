"""Queries over crawling, page cleaning, links and text blocks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weftgraph.functions import vocab
from weftgraph.operators import pages
from weftgraph.plans.base import query, table

_STOPS = "|".join(vocab.LINK_STOP_WORDS)
_A = pages.ANCHOR.replace("'", "''")
_PLAIN = r"trim(regexp_replace(regexp_replace(regexp_replace({0}, '(?is)<script(\s[^>]*)?>.*?</script>|<style(\s[^>]*)?>.*?</style>|<nav(\s[^>]*)?>.*?</nav>|<footer(\s[^>]*)?>.*?</footer>|<header(\s[^>]*)?>.*?</header>|<aside(\s[^>]*)?>.*?</aside>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g'), ' ')".replace(r"\t\r\n", "\\t\\r\\n")
LINKS_SQL = rf"""l00 AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{_A}', 1)) AS h1, unnest(regexp_extract_all(html, '{_A}', 2)) AS h2, unnest(regexp_extract_all(html, '{_A}', 3)) AS h3, unnest(regexp_extract_all(html, '{_A}', 4)) AS inner_, unnest(range(len(regexp_extract_all(html, '{_A}', 1)))) AS pos FROM pages),
l0 AS (SELECT page_id, url, concat(h1, h2, h3) AS href, inner_, pos FROM l00),
links AS (SELECT page_id, url, pos, href, {_PLAIN.format("inner_")} AS link_text FROM l0)"""
_TARGET = r"""t AS (SELECT *, regexp_replace(href, '[?#].*$', '') AS bare, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) AS root FROM links),
u AS (SELECT *, CASE WHEN regexp_matches(bare, '^[A-Za-z]+://') THEN bare WHEN bare LIKE '//%' THEN regexp_extract(url, '^([A-Za-z]+:)//', 1) || bare WHEN bare LIKE '/%' THEN root || bare ELSE root || '/' || bare END AS target FROM t)"""
_OK_TEXT = f"length(trim(link_text)) >= 2 AND NOT regexp_matches(trim(link_text), '^[0-9]+$') AND NOT regexp_matches(lower(link_text), '{_STOPS}')"
_OK = r"target LIKE 'http%' AND regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) = regexp_extract(target, '^[A-Za-z]+://([^/?#]*)', 1) AND NOT contains(href, '#') AND NOT contains(regexp_replace(target, '^[A-Za-z]+://[^/]*', ''), ':')"


def _pages(spark, sf):
    return table(spark, sf, "pages")


@query("SELECT trim(url) AS url FROM pages WHERE trim(url) <> ''")
def seed_list(spark, sf):
    return pages.seeds(_pages(spark, sf), "url")


@query("SELECT page_id, md5(url) || '.html' AS file_key FROM pages")
def page_file_keys(spark, sf):
    return _pages(spark, sf).select("page_id", pages.file_key(F.col("url")).alias("file_key"))


@query("SELECT page_id, length(html) < 2500 OR contains(lower(html), '<noscript>') AS short, length(html) < 500 OR contains(lower(html), '<noscript>') AS needs_render FROM pages")
def page_needs_render(spark, sf):
    short = (F.char_length("html") < 2500) | F.contains(F.lower("html"), F.lit("<noscript>"))
    return _pages(spark, sf).select("page_id", short.alias("short"), pages.needs_render(F.col("html")).alias("needs_render"))


@query("SELECT count(*) AS pages, count(html) AS readable, sum(length(html))::BIGINT AS chars FROM pages")
def page_scan(spark, sf):
    return _pages(spark, sf).agg(F.count("*").alias("pages"), F.count("html").alias("readable"), F.sum(F.char_length("html")).alias("chars"))


@query("SELECT page_id FROM (SELECT page_id, row_number() OVER (ORDER BY md5(url) || '.html', page_id) AS n FROM pages) WHERE n > 100")
def resume_offset(spark, sf):
    return pages.after_offset(_pages(spark, sf), 100).select("page_id")


_MARKED = "SELECT page_id, CASE page_id % 4 WHEN 0 THEN '<!-- URL: ' || url || ' -->\n' || html WHEN 1 THEN '<i data-lemmatitle=\"A ' || page_id || '\"></i>' || html WHEN 2 THEN '<title>B ' || page_id || '_百度百科</title>' ELSE html END AS html FROM pages"


@query(rf"""WITH m AS ({_MARKED}), h AS (SELECT page_id, html, regexp_replace(trim(regexp_extract(array_to_string(string_split(html, chr(10))[1:10], chr(10)), 'URL:\s*([^\n]*)', 1)), '[\s>-]+$', '') AS head FROM m)
SELECT page_id, CASE WHEN head <> '' THEN head WHEN regexp_extract(html, 'data-lemmatitle="([^"]+)"', 1) <> '' THEN 'https://baike.baidu.com/item/' || url_encode(regexp_extract(html, 'data-lemmatitle="([^"]+)"', 1))
  WHEN regexp_extract(html, '<title>([^<]*)_百度百科</title>', 1) <> '' THEN 'https://baike.baidu.com/item/' || url_encode(regexp_extract(html, '<title>([^<]*)_百度百科</title>', 1)) END AS source_url FROM h""")
def source_url_recovery(spark, sf):
    p = _pages(spark, sf)
    k = F.col("page_id") % 4
    html = F.when(k == 0, F.concat(F.lit("<!-- URL: "), "url", F.lit(" -->\n"), "html")).when(k == 1, F.concat(F.lit('<i data-lemmatitle="A '), F.col("page_id").cast("string"), F.lit('"></i>'), "html"))
    html = html.when(k == 2, F.concat(F.lit("<title>B "), F.col("page_id").cast("string"), F.lit("_百度百科</title>"))).otherwise(F.col("html"))
    return p.select("page_id", pages.source_url(html).alias("source_url"))


@query(r"""SELECT page_id, md5(coalesce(nullif(regexp_extract(html, '(?is)<article(?:\s[^>]*)?>(.*?)</article>', 1), ''), nullif(regexp_extract(html, '(?is)<main(?:\s[^>]*)?>(.*?)</main>', 1), ''), nullif(regexp_extract(html, '(?is)<body(?:\s[^>]*)?>(.*?)</body>', 1), ''), html)) AS region_md5 FROM pages""")
def content_region(spark, sf):
    return _pages(spark, sf).select("page_id", F.md5(pages.region(F.col("html"))).alias("region_md5"))


_BODY_NOISE = "|".join(rf"<{t}(\s[^>]*)?>.*?</{t}>" for t in sorted(pages.BODY_NOISE))


@query(rf"""SELECT page_id, md5(coalesce(nullif(regexp_extract(html, '(?is)<article(?:\s[^>]*)?>.*?</article>'), ''), nullif(regexp_extract(html, '(?is)<main(?:\s[^>]*)?>.*?</main>'), ''),
  nullif(regexp_replace(regexp_extract(html, '(?is)<body(?:\s[^>]*)?>.*?</body>'), '(?is){_BODY_NOISE}', '', 'g'), ''), html, '')) AS content_md5 FROM pages""")
def cleaned_pages(spark, sf):
    return pages.cleaned(_pages(spark, sf).select("page_id", "url", "html")).select("page_id", F.md5("html").alias("content_md5"))


@query(f"SELECT page_id, md5({_PLAIN.format('html')}) AS text_md5 FROM pages")
def page_plain_text(spark, sf):
    return _pages(spark, sf).select("page_id", F.md5(pages.plain(F.col("html"))).alias("text_md5"))


@query("SELECT url, 0 AS block_id, '' AS text FROM pages WHERE false")
def noise_removal(spark, sf):
    """Text of pages with encyclopedia noise put in, which the parser removes again: rows whose text it changed."""
    p = _pages(spark, sf)
    noisy = F.concat(F.lit('<div class="top-tool">tool</div><ol class="references"><li>r</li></ol>'), F.col("html"), F.lit('<div class="navbox">n</div>'))
    a = pages.text_blocks(p).select("url", "block_id", "text")
    return pages.text_blocks(p.withColumn("html", noisy)).select("url", "block_id", "text").exceptAll(a)


@query(f"WITH {LINKS_SQL} SELECT page_id, pos::INT AS pos, href, link_text FROM links")
def link_extraction(spark, sf):
    return pages.links(_pages(spark, sf)).select("page_id", "pos", "href", "link_text")


@query(f"WITH {LINKS_SQL} SELECT page_id, pos::INT AS pos, {_OK_TEXT} AS ok FROM links")
def link_text_predicate(spark, sf):
    return pages.links(_pages(spark, sf)).select("page_id", "pos", pages.followable(F.col("link_text")).alias("ok"))


@query(f"WITH {LINKS_SQL}, {_TARGET} SELECT page_id, pos::INT AS pos, target FROM u")
def url_normalisation(spark, sf):
    return pages.links(_pages(spark, sf)).select("page_id", "pos", pages.resolved(F.col("url"), F.col("href")).alias("target"))


@query(f"WITH {LINKS_SQL}, {_TARGET} SELECT page_id, pos::INT AS pos, {_OK} AS ok FROM u")
def link_admissibility(spark, sf):
    target = pages.resolved(F.col("url"), F.col("href"))
    return pages.links(_pages(spark, sf)).select("page_id", "pos", pages.admissible(F.col("url"), F.col("href"), target).alias("ok"))


@query(f"""WITH {LINKS_SQL}, {_TARGET}, f AS (SELECT DISTINCT url FROM pages WHERE page_id % 2 = 0),
ok AS (SELECT * FROM u WHERE url IN (SELECT url FROM f) AND {_OK_TEXT} AND {_OK} AND target NOT IN (SELECT url FROM f)),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY page_id, pos, url) AS n FROM ok)
SELECT target AS url, 1 AS depth, url || ' > ' || target AS history FROM r WHERE n = 1""")
def crawl_level(spark, sf):
    p = _pages(spark, sf)
    f = p.where("page_id % 2 = 0").select("url").distinct().select("url", F.lit(0).alias("depth"), F.array("url").alias("history"))
    return pages.next_level(f, p, f).select("url", "depth", F.array_join("history", " > ").alias("history"))


@query(f"""WITH {LINKS_SQL}, {_TARGET}, f AS (SELECT DISTINCT url FROM pages WHERE page_id % 5 = 0),
ok AS (SELECT * FROM u WHERE {_OK_TEXT} AND {_OK} AND target IN (SELECT url FROM pages)),
l1 AS (SELECT DISTINCT target AS url FROM ok WHERE url IN (FROM f) AND target NOT IN (FROM f)),
l2 AS (SELECT DISTINCT target AS url FROM ok WHERE url IN (FROM l1) AND target NOT IN (FROM f) AND target NOT IN (FROM l1)),
l3 AS (SELECT DISTINCT target AS url FROM ok WHERE url IN (FROM l2) AND target NOT IN (FROM f) AND target NOT IN (FROM l1) AND target NOT IN (FROM l2))
SELECT url, 0 AS depth FROM f UNION ALL SELECT url, 1 FROM l1 UNION ALL SELECT url, 2 FROM l2 UNION ALL SELECT url, 3 FROM l3""")
def crawl_loop(spark, sf):
    p = _pages(spark, sf)
    return pages.crawl(spark, p.where("page_id % 5 = 0").select("url"), p, max_depth=3).select("url", "depth")


@query("SELECT url, page_id FROM (SELECT url, page_id, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM pages) WHERE n = 1")
def visited_dedupe(spark, sf):
    return _pages(spark, sf).groupBy("url").agg(F.min("page_id").alias("page_id"))


@query()
def text_blocks(spark, sf):
    return pages.text_blocks(_pages(spark, sf))


@query()
def infobox_blocks(spark, sf):
    box = F.concat(F.lit('<table class="infobox"><tr><td>'), "url", F.lit('</td></tr></table><p class="summary">'), F.col("page_id").cast("string"), F.lit("</p>"), "html")
    return pages.text_blocks(_pages(spark, sf).withColumn("html", box)).where("source != 'main'")


_LINES = "SELECT doc_id, CAST(doc_id AS VARCHAR) AS url, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents"


def _lines(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("url"), F.posexplode(F.split("text", "\n")).alias("block_id", "text"))
    return d


@query(f"WITH l AS ({_LINES}) SELECT url, min(pos)::INT AS block_id, text FROM l GROUP BY url, text")
def block_dedupe(spark, sf):
    return pages.first_of_text(_lines(spark, sf)).select("url", "block_id", "text")


@query(f"WITH l AS ({_LINES}), n AS (SELECT url, row_number() OVER (PARTITION BY url ORDER BY pos) - 1 AS p, text FROM l) SELECT url, (p // 3)::INT AS chunk, string_agg((p % 3 + 1) || ':' || text, '|' ORDER BY p) AS blocks FROM n GROUP BY url, p // 3")
def block_batches(spark, sf):
    b = pages.batches(_lines(spark, sf))
    return b.select("url", "chunk", F.array_join(F.transform("blocks", lambda x: F.concat_ws(":", x["id"].cast("string"), x["text"])), "|").alias("blocks"))


@query("SELECT conv_id, (turn_rank // 2)::INT AS batch, string_agg(text, '|' ORDER BY turn_rank) AS texts FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS turn_rank FROM conversations) GROUP BY conv_id, turn_rank // 2")
def conversation_batches(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn", "text")
    c = table(spark, sf, "conversations").select("conv_id", "text", (F.row_number().over(w) - 1).alias("r"))
    g = c.groupBy("conv_id", F.floor(F.col("r") / 2).cast("int").alias("batch")).agg(F.sort_array(F.collect_list(F.struct("r", "text"))).alias("t"))
    return g.select("conv_id", "batch", F.array_join(F.transform("t", lambda x: x["text"]), "|").alias("texts"))
