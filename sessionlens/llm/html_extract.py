"""Main text of web pages, with site templates removed.

Pages are parsed into elements. An element has two hashes of its subtree: one of names, classes,
roles and texts, and one of its shape, without texts and with a run of alike children as one.
Spark counts on how many pages of a host each subtree stands, and subtrees that recur on many
pages of their host (10, and a fifth of the host or 50) are templates and are deleted. Pages of
equal main text are copies and count once.

Shapes recur in prose too, so they count only for elements that are mostly links or that stand
beside the page's main container: from the root downward, the child element that holds half of
the words outside links or more. Elements with over a third of these words, and those named
and classed like a main container, are never deleted by shape.

What remains is searched for the main part: ``article`` or ``main`` elements if there are some,
else the body; and inside it, elements that are menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles or reader comments, by name, role or class, are left out. This
serves pages that are too few on their host to show templates.

The text of a block is what stands between block boundaries: character references decoded,
white space folded to one space and trimmed. Blocks are joined by a line feed in page order.

Defined results: a null or empty page has the empty text; a url without a host belongs to
the host ''; repeated rows count once for templates and get equal texts; an empty
table gives an empty result; columns besides id, url and html are not read.

Pages are parsed once to find subtrees and the text that names alone would leave, and again only
where a template lies in that text. Each host, page and subtree goes through the shuffle as a few
numbers; texts stay where they are, but for those that are made again. A page is joined with the
templates in its own text, not with those of its host, so that rows stay as small as pages on a
host with very many templates.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe object".split())
DROPPED = frozenset("head nav header footer aside form script style noscript template textarea title svg math iframe object button select dialog menu canvas audio video map datalist".split())
BLOCKS = frozenset("html body address article aside blockquote br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption legend".split())
_CLOSES_P = BLOCKS - {"br", "html", "body"}
#: An open element of the first kind ends where one of the second begins.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
_SCOPE = frozenset("article section div body html td th li table ul ol main aside nav header footer form blockquote dl".split())
#: Elements that templates are made of. Headings and other inline elements are not deleted
#: on their own, as words recur in prose.
TEMPLATE_NAMES = frozenset("div section ul ol dl table nav aside header footer form figure details iframe center fieldset menu".split())
#: These too, if they hold MIN_WORDS words.
WORDED_NAMES = frozenset("p span li dd blockquote address".split())
MIN_WORDS = 4
NOISE = re.compile(r"(?:^|[\s_-])(?:ads?|advert(?:s|isement|ising)?|sponsor(?:ed)?|promo(?:tion)?|banner|nav(?:bar|igation)?|menu|breadcrumbs?|sidebar|footer|header|masthead|cookies?|consent|gdpr|notice|newsletter|subscribe|signup|popup|modal|overlay|share|sharing|social|related|recommend(?:ed|ations)?|comments?|respond|replies|disqus|widget|toolbar|pagination|pager|skip-link|login|search)(?:$|[\s_-])", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"[0-9]+")
#: What no reader sees.
UNSEEN = frozenset("head script style noscript template textarea title svg math iframe object canvas audio video map datalist".split())
_INLINE = frozenset("b i em strong span u s small big sub sup abbr cite code q mark font time var kbd samp wbr br img".split())
_CONTAINERS = frozenset("html body div section main article center table tbody tr td".split())


@dataclass(frozen=True)
class HtmlConfig:
    min_pages: int = 10  # pages of the host that hold the subtree
    min_share: float = 0.2  # and their share of the host's pages,
    most_pages: int = 50  # though so many pages are enough on any host


class Node:
    """An element: hash and shape of its subtree, its words, and those of them outside links."""

    __slots__ = ("name", "attrs", "items", "hash", "shape", "words", "prose")

    def __init__(self, name: str, attrs: str = ""):
        self.name, self.attrs, self.items = name, attrs, []
        self.hash = self.shape = self.words = self.prose = 0


def parse(page: str | None) -> Node:
    """The element tree. Items of a node are nodes and decoded strings."""
    root = Node("#root")
    stack = [root]
    page = page or ""
    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].items.append(entities.unescape(page[at:]))
            break
        if m.start() > at:
            stack[-1].items.append(entities.unescape(page[at : m.start()]))
        at = max(m.end(), at + 1)
        if m[1]:
            name = m[1].lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
        elif m[2]:
            name, attrs = m[2].lower(), m[3] or ""
            if name in _CLOSES_P:
                _close(stack, "p")
            for k, ends in _ENDS.items():
                if name in ends:
                    _close(stack, k)
            node = Node(name, attrs)
            stack[-1].items.append(node)
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|$)", re.I).search(page, at)
                node.items.append(page[at : end.start() if end else len(page)])
                at = end.end() if end else len(page)
            elif name not in VOID and not attrs.rstrip().endswith("/"):
                stack.append(node)
    return root


def _close(stack: list[Node], name: str) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name == name:
            del stack[k:]
            return
        if stack[k].name in _SCOPE:
            return


def marks(node: Node) -> str:
    """Name, classes and role of an element; digits count as one another. Other attributes vary from page to page."""
    if not node.attrs:
        return node.name
    kept = [m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(node.attrs) if m[1].lower() in ("class", "role")]
    return _DIGITS.sub("0", " ".join([node.name, *kept]))


def hashed(root: Node) -> list[Node]:
    """Give every element its hashes and numbers of words; all elements, children first."""
    out: list[Node] = []
    work = [(root, False)]
    while work:
        node, ready = work.pop()
        if not ready:
            work.append((node, True))
            work.extend((x, False) for x in node.items if isinstance(x, Node))
            continue
        exact, shape = [marks(node)], [marks(node)]
        node.words = node.prose = 0
        unseen = node.name in UNSEEN
        for x in node.items:
            if isinstance(x, Node):
                exact.append(f"\x01{x.hash:x}")
                mark = f"\x01{x.shape:x}" if x.name not in _INLINE else "\x02" if x.words else ""
                node.words += x.words
                node.prose += x.prose
            else:
                text = _SPACE.sub(" ", x).strip()
                exact.append(text)
                mark = "\x02" if text else ""
                n = 0 if unseen or not text else text.count(" ") + 1
                node.words += n
                node.prose += n
            if mark and mark != shape[-1]:
                shape.append(mark)
        if node.name == "a":
            node.prose = 0
        node.hash = xxhash.xxh64_intdigest("\x00".join(exact).encode("utf-8", "replace"))
        node.shape = xxhash.xxh64_intdigest("".join(shape).encode("utf-8", "replace"), 1)
        out.append(node)
    return out


def shaped(root: Node) -> list[Node]:
    """Elements of a hashed page that may be deleted by shape."""
    chain = [root]
    while chain[-1].name not in ("article", "main"):
        best = max((x for x in chain[-1].items if isinstance(x, Node)), key=lambda x: x.prose, default=None)
        if best is None or not best.prose or 2 * best.prose < chain[-1].prose or best.name not in _CONTAINERS:
            break
        chain.append(best)
    like = set(map(marks, chain))
    found = []
    work = [(root, True)]
    while work:
        node, beside = work.pop()
        inner = beside and node is not chain[-1]
        for x in node.items:
            if not isinstance(x, Node):
                continue
            if x in chain:
                work.append((x, True))
                continue
            work.append((x, inner))
            links = x.words - x.prose
            if x.name in TEMPLATE_NAMES and 3 * x.prose <= root.prose and (inner or links and links >= x.prose) and marks(x) not in like:
                found.append(x)
    return found


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def is_noise(node: Node) -> bool:
    if node.name in DROPPED:
        return True
    if not node.attrs:
        return False
    for m in _ATTR.finditer(node.attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id") and node.name not in ("article", "main", "body", "html") and NOISE.search(value):
            return True
        if key == "role" and value.lower() in _ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
    return False


def _templates(root: Node) -> dict[int, Node]:
    """Subtrees of a page that may be templates, by hash (one of those of equal hash)."""
    by_text = {signed(n.hash): n for n in hashed(root) if n.items and (n.name in TEMPLATE_NAMES or n.name in WORDED_NAMES and n.words >= MIN_WORDS)}
    return by_text | {signed(n.shape): n for n in shaped(root)}


def templates_of(page: str | None) -> set[int]:
    return set(_templates(parse(page)))


def evidence(page: str) -> tuple[str, int, set[int], set[int]]:
    """The text without regard to templates, a hash that copies of one page share (of that text, or of the page if
    there is none), templates_of, and those of them that lie in the text."""
    root = parse(page)
    seen: set[int] = set()
    text = _extract(root, frozenset(), seen=seen)
    hashes = set(_templates(root))
    inside = {signed(h) for x in _all(root) if id(x) in seen for h in (x.hash, x.shape)}
    return text, signed(xxhash.xxh64_intdigest((text or page).encode("utf-8", "replace"))), hashes, hashes & inside


def _all(root: Node) -> Iterator[Node]:
    work = [root]
    while work:
        node = work.pop()
        yield node
        work.extend(x for x in node.items if isinstance(x, Node))


def main_parts(root: Node) -> list[Node]:
    """Outermost article or main elements outside noise, else the whole page."""
    found: list[Node] = []
    work = [root]
    while work:
        node = work.pop()
        if node.name in ("article", "main"):
            found.append(node)
        elif node is root or not is_noise(node):
            work.extend(x for x in reversed(node.items) if isinstance(x, Node))
    return found or [root]


def deleted(root: Node, drop: frozenset[int] | set[int]) -> frozenset[int]:
    """Python ids of the elements of a page that are templates."""
    nodes = hashed(root)
    return frozenset([id(n) for n in nodes if signed(n.hash) in drop] + [id(n) for n in shaped(root) if signed(n.shape) in drop])


def extract(page: str | None, drop: frozenset[int] | set[int] = frozenset(), named: bool = True) -> str:
    """Main text of a page without the subtrees whose hashes are in ``drop``.

    ``named=False`` leaves out only templates and what no reader sees.
    """
    root = parse(page)
    return _extract(root, deleted(root, drop) if drop else frozenset(), named)


def _extract(root: Node, gone: frozenset[int], named: bool = True, seen: set[int] | None = None) -> str:
    """``seen`` gets the Python ids of the elements that the text comes from."""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(line)).strip()
        if text:
            blocks.append(text)
        line.clear()

    for part in main_parts(root) if named else [root]:
        flush()
        if seen is not None:
            seen.add(id(part))
        work: list[Node | str | None] = [*reversed(part.items)]
        while work:
            x = work.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                line.append(x)
            elif (is_noise(x) if named else x.name in UNSEEN) or id(x) in gone:
                if x.name in BLOCKS:
                    flush()
            else:
                if seen is not None:
                    seen.add(id(x))
                if x.name in BLOCKS:
                    flush()
                    work.append(None)
                work.extend(reversed(x.items))
    flush()
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    """Host of a url in lower case; '' if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, url, host (64 bits of a hash), two keys of 64 bits of host and html, and html."""
    html, url = F.col(html_col).cast("string"), F.col(url_col).cast("string")
    host = host_of(url)
    keys = [F.xxhash64(F.lit(k), host, html).alias(name) for k, name in ((0, "key"), (1, "key2"))]
    return pages.select(F.col(id_col).alias("id"), url.alias("url"), F.xxhash64(host).alias("host"), *keys, html.alias("html"))


def first_look(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Per row: id, url, host, keys, text without regard to templates, page (which copies share), hashes, and those inside the text."""
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [evidence(x or "") for x in batch.column(5).to_pylist()]
            lists = [pa.array([[0, *x[2]] for x in found], pa.list_(pa.int64())), pa.array([list(x[3]) for x in found], pa.list_(pa.int64()))]  # 0 counts the page
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64()), *lists], names=["id", "url", "host", "key", "key2", "text", "page", "hashes", "inside"])

    return _keyed(pages, id_col, url_col, html_col).mapInArrow(run, f"id {id_type}, url string, host long, key long, key2 long, text string, page long, hashes array<long>, inside array<long>")


def host_templates(look: DataFrame, config: HtmlConfig = HtmlConfig()) -> DataFrame:
    """host and hash of the subtrees that recur on many pages of a host."""
    each = look.select("host", "page", F.explode("hashes").alias("hash")).distinct()
    counts = stored(each.groupBy("host", "hash").agg(F.count("*").alias("n")).filter((F.col("hash") == 0) | (F.col("n") >= config.min_pages)), "html-counts")
    total = counts.filter("hash = 0").select("host", F.col("n").alias("pages"))
    many = counts.filter("hash <> 0").join(total, "host").filter(F.col("n") >= F.least(F.col("pages") * config.min_share, F.lit(config.most_pages)))
    return stored(many.select("host", "hash"), "html-templates")


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", config: HtmlConfig = HtmlConfig()) -> DataFrame:
    """Per row: id, url, ``text`` and ``by_template``, whether templates lie in what the names of elements leave."""
    look = stored(first_look(pages, id_col, url_col, html_col), "html-look")
    keys = ["host", "key", "key2"]
    inside = look.filter(F.size("inside") > 0).select(*keys, F.explode("inside").alias("hash")).join(host_templates(look, config), ["host", "hash"])
    again = stored(inside.groupBy(*keys).agg(F.sort_array(F.collect_set("hash")).alias("templates")), "html-again")
    stay = look.join(again.select(*keys), keys, "left_anti").select("id", "url", "text", F.lit(False).alias("by_template"))
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, frozenset(h)) for page, h in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    rows = _keyed(pages, id_col, url_col, html_col).join(again, keys).select("id", "url", "html", "templates")
    changed = rows.mapInArrow(run, f"id {id_type}, url string, text string").withColumn("by_template", F.lit(True))
    return stay.unionByName(changed).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "by_template")
