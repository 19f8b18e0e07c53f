"""Main text of pages: hand-made cases, and templates counted plainly."""

import random
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import duckdb
from pyspark.sql import functions as F

from sessionlens.llm import html_extract, queries
from sessionlens.llm.shared import table

SF = "/root/testdata/sf0.001"


def host_of(url):
    return url.split("://", 1)[1].split("/")[0].split(":")[0].lower() if "://" in (url or "") else ""


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_blocks_and_references():
    html = page("<nav>Menu</nav><article><h1>A &amp; B</h1><p>one\n  <b>two</b>&nbsp;&#233;<br>three</p><script>x('<p>no</p>')</script><ul><li>i<li>j</ul></article><footer>foot</footer>")
    assert html_extract.extract(html) == "A & B\none two é\nthree\ni\nj"


def test_noise_inside_the_article():
    html = page('<main><p>keep</p><div class="ad-box advert">buy</div><aside>side</aside><form><p>mail</p></form><div role="complementary">x</div><section id="comments"><p>first!</p></section><p>also</p></main>')
    assert html_extract.extract(html) == "keep\nalso"


def test_broken_and_empty_pages():
    assert html_extract.extract(None) == "" and html_extract.extract("") == "" and html_extract.extract("plain  text") == "plain text"
    assert html_extract.extract("<p>a<p>b</div><i>c") == "a\nbc"
    assert html_extract.extract("<p>1 < 2 <!-- no -->and</p><p title='x>y'>z") == "1 < 2 and\nz"
    assert html_extract.extract("<div><" * 2000 + "end") != ""
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    assert html_extract.extract(deep) == "deep"


def test_recurring_subtrees_are_deleted_by_host(spark):
    box = '<div class="box7"><p>Read our house rules</p></div>'
    rows = [(i, f"https://A.example/{i}", page(f"<article><p>text {i}</p>{box}</article>")) for i in range(12)]
    rows += [(100 + i, "http://b.example/x", page(f"<article><p>text {i}</p>{box}</article>")) for i in range(3)]
    rows += [(200, None, page("<p>no url</p>")), (201, "http://a.example/null", None), (202, "http://a.example/empty", ""), (None, "x", page("<p>no id</p>"))]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("templates", F.lit(0)).withColumn("id", F.lit(1))
    out = html_extract.extracted(df).collect()
    assert len(out) == len(rows)
    text = {r["page_id"]: r["text"] for r in out}
    assert text[3] == "text 3"  # on twelve pages of its host
    assert text[101] == "text 1\nRead our house rules"  # on three of another
    assert text[200] == "no url" and text[201] == "" and text[202] == "" and text[None] == "no id"
    assert html_extract.extracted(df.limit(0)).collect() == []


def test_templates_by_distinct_pages(spark):
    notice, menu = "<p>Please read our house rules first</p>", "<ul><li>one thing</li><li>another</li></ul>"
    rows = [(i, f"http://hot.example/{i}", page(f"<article><p>text {i}</p>{notice if i < 55 else ''}</article>")) for i in range(300)]
    rows += [(1000 + i, f"http://c.example/{i}", page(f"<nav>{i}</nav><article><p>a story</p>{menu}</article>")) for i in range(12)]
    rows += [(2000 + i, f"http://d.example/{i}", page(f"<article><p>text {i} is <b>very</b> good</p></article>")) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r["page_id"]: r["text"] for r in html_extract.extracted(df).collect()}
    assert text[3] == "text 3" and text[299] == "text 299"  # on 55 of 300 pages
    assert all(text[1000 + i] == "a story\none thing\nanother" for i in range(12))  # copies of one article
    assert text[2001] == "text 1 is very good"


def test_templates_by_shape(spark):
    rng = random.Random(4)
    said = lambda n: " ".join(rng.choices("one two three four five six seven".split(), k=n))

    def site(i):
        links = "".join(f'<li><a href="/{rng.random()}">{said(2)}</a></li>' for _ in range(rng.randint(3, 9)))
        return page(f'<div class="top"><ul>{links}</ul></div><div class="box">{said(5)}</div><div class="story"><p>{i} {said(40)}</p><div class="quote">{said(6)}</div><p>{said(30)}</p></div><div class="end">{said(4)} {i}</div>')

    rows = [(i, f"http://a.example/{i}", site(i)) for i in range(30)] + [(100 + i, f"http://b.example/{i}", site(i)) for i in range(4)]
    found = {r["page_id"]: r for r in html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(30):  # other words on every page, alike shapes; the quote recurs inside the story
        lines = found[i]["text"].split("\n")
        assert found[i]["by_template"] and len(lines) == 3 and lines[0].startswith(f"{i} ")
    assert all(len(found[100 + i]["text"].split("\n")) > 5 and not found[100 + i]["by_template"] for i in range(4))


def test_templates_alone_find_most_texts():
    """Without names of menus, adverts and footers, recurring subtrees leave the same text on nearly all pages."""
    pages = duckdb.sql("SELECT url, html FROM '/root/testdata/sf0.1/pages.parquet' WHERE html IS NOT NULL").fetchall()
    held, total = defaultdict(set), defaultdict(set)
    for url, html in pages:
        _, key, hashes, _ = html_extract.evidence(html)
        total[host_of(url)].add(key)
        for h in hashes:
            held[host_of(url), h].add(key)
    drop = defaultdict(set)
    for (name, h), keys in held.items():
        if len(keys) >= 10 and len(keys) >= min(50, 0.2 * len(total[name])):
            drop[name].add(h)
    same = [html_extract.extract(html, drop[host_of(url)], named=False) == html_extract.extract(html) for url, html in pages]
    assert sum(same) >= 0.97 * len(pages)
    assert all(html_extract.extract(html, drop[host_of(url)]) == html_extract.extract(html) for url, html in pages[::7])  # and nothing of an article goes


class Article(HTMLParser):
    """The text of articles, block by block, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.skipped, self.blocks = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.skipped += tag in ("script", "style", "aside", "form", "nav", "footer")
        if tag in html_extract.BLOCKS:
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.skipped -= tag in ("script", "style", "aside", "form", "nav", "footer")
        if tag in html_extract.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.skipped:
            self.blocks[-1] += data


def test_query_equals_other_parser(spark):
    """On pages whose article holds no classed noise, the text is that of the standard library's parser."""
    found = {r["page_id"]: r["text"] for r in queries.op2_html_extract(spark, SF).collect()}
    tried = 0
    for r in table(spark, SF, "pages").collect():
        html = r["html"] or ""
        if html.count("<article") != 1 or "class=" in html.split("<article", 1)[1]:
            continue
        parser = Article()
        parser.feed(html)
        tried += 1
        assert found[r["page_id"]] == "\n".join(b for b in (re.sub(r"\s+", " ", x).strip() for x in parser.blocks) if b)
    assert tried > 20


def test_query_equals_plain(spark):
    pages = table(spark, SF, "pages").collect()
    config = html_extract.HtmlConfig()
    host = {r["page_id"]: host_of(r["url"]) for r in pages}
    often, total = Counter(), Counter(host.values())
    for r in pages:
        for h in html_extract.templates_of(r["html"]):
            often[host[r["page_id"]], h] += 1
    drop = {k for k, n in often.items() if n >= config.min_pages and n >= config.min_share * total[k[0]]}
    wanted = {r["page_id"]: html_extract.extract(r["html"], {h for x, h in drop if x == host[r["page_id"]]}) for r in pages}
    found = queries.op2_html_extract(spark, SF).collect()
    assert {r["page_id"]: r["text"] for r in found} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in found)
