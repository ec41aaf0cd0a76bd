"""Main text of web pages by site template removal.

Every block element's subtree is hashed (tag, attributes, text, children). Spark counts,
for each host, the different pages that hold a subtree; subtrees on at least ``MIN_PAGES`` of them and
``MIN_SHARE`` of the host's different pages are its template and are deleted, wherever the host's pages have them.
Pages with equal trees count once. The page itself, its html and body and inline elements in running text are never template. What isn't text of a page at
all (scripts, styles, head) or says by its tag, role, class or id that it isn't the article (navigation,
header, footer, aside, form, advert, notice, comments) goes too, as sites with few pages can't show what
recurs. If a page marks its article (``article``, ``main`` or that role), the text is taken from there.
Subtrees inside it (share bars, notices, menus) are counted apart, over the host's different articles: copies of an article
count once, whatever surrounds them.

Blocks are parted by block elements and line breaks; white space in a block becomes one
space; empty blocks are left out; character references are decoded, once.

The table of templates goes to the tasks by broadcast while it has at most ``MOST_HASHES`` rows;
beyond that, pages meet their templates by joins. Both give the same rows.

Results, by case: null and empty html give empty text; a null url is a host of its own (the empty
one); unclosed and stray tags are closed or ignored where they occur; repeated rows are extracted
each, but a template is counted over different page contents, whatever their ids; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ship, written

MIN_PAGES = 5
MIN_SHARE = 0.3
INSIDE = 0x5851F42D4C957F2D
MOST_HASHES = 2_000_000

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
HIDDEN = frozenset("head script style title noscript template iframe svg canvas object select option button textarea datalist".split())
ASIDE = frozenset("nav footer aside form menu dialog".split())
WHOLE = frozenset("#page html body".split())
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary
table tbody td tfoot th thead tr ul""".split())
CLOSES = {"p": BLOCKS - {"br", "body", "html"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
LIMITS = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]),
          "td": frozenset(["table"]), "th": frozenset(["table"]), "option": frozenset(["select"])}
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: Words of a class or id that name what surrounds an article.
AROUND = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu
breadcrumb breadcrumbs sidebar aside widget header masthead footer cookie cookies consent notice notices notification popup modal
newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist disqus
replies pagination pager skip toolbar copyright""".split())
#: Inside a marked article only these whole names of a class or id do; single words such as header, share or menu name content there too.
WITHIN = frozenset("""ad ads ad-box ad-banner ad-container ad-slot ad-unit ad-wrapper adsbygoogle advert adverts advertisement advertising
sponsored-content promo-box navbar site-nav main-nav nav-links post-navigation breadcrumb breadcrumbs sidebar site-header site-footer
cookie-notice cookie-banner cookie-consent newsletter newsletter-signup newsletter-form subscribe-box share-bar share-buttons share-links
sharedaddy social-share social-sharing social-buttons social-links social-media-links related-posts related-articles related-links related-content
recommended-posts recommended-articles comments comment-list commentlist comments-area comment-form comment-respond disqus_thread replies
pagination pager skip-link""".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[a-z]+|\d+")


class Node:
    __slots__ = ("tag", "attributes", "children", "hash", "inside")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []


def tree(page: str) -> Node:
    """The element tree of a page; children are nodes and decoded texts."""
    root = Node("#page")
    stack, at = [root], 0
    while at < len(page):
        m = TAG.search(page, at)
        if m is None:
            break
        if m.start() > at:
            stack[-1].children.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        closed = [k for k in range(len(stack) - 1, 0, -1) if stack[k].tag in CLOSES and tag in CLOSES[stack[k].tag]]
        for k in closed[:1]:
            # an open element ends at a tag that can't be in it, unless its container opened since
            limit = LIMITS.get(stack[k].tag, BLOCKS - {"p", "br"})
            if not any(n.tag in limit for n in stack[k + 1:]):
                kept = [Node(n.tag, n.attributes) for n in stack[k + 1:] if n.tag not in BLOCKS]
                del stack[k:]
                for n in kept:  # inline elements go on in the next block
                    stack[-1].children.append(n)
                    stack.append(n)
        node = Node(tag, m.group(3).strip())
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*>?", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if tag in ("title", "textarea"):
                node.children.append(html.unescape(page[at:stop]))
            at = end.end() if end else len(page)
        elif tag not in VOID and not node.attributes.endswith("/"):
            stack.append(node)
        elif node.attributes.endswith("/") and tag not in VOID:
            stack.append(node)
    if at < len(page):
        stack[-1].children.append(html.unescape(page[at:]))
    return root


def attributes(node: Node) -> dict[str, str]:
    return {m.group(1).lower(): html.unescape(next((g for g in m.groups()[1:] if g is not None), "")) for m in ATTRIBUTE.finditer(node.attributes)}


def is_article(node: Node) -> bool:
    return node.tag in ("article", "main") or bool(node.attributes) and attributes(node).get("role", "").lower() in ("main", "article")


def is_around(node: Node, inside: bool) -> bool:
    """Whether the element names itself as something around the article."""
    if node.tag in HIDDEN or node.tag in ASIDE or node.tag == "header" and not inside:
        return True
    if not node.attributes:
        return False
    a = attributes(node)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in ROLES:
        return True
    if node.tag in ("body", "html", "article", "main"):
        return False
    if inside:
        return any(w in WITHIN for w in (a.get("class", "") + " " + a.get("id", "")).lower().split())
    return any(w in AROUND for w in NAME.findall((a.get("class", "") + " " + a.get("id", "")).lower()))


def walk(root: Node) -> list[Node]:
    """All elements, parents first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += [c for c in reversed(n.children) if isinstance(c, Node)]
    return out


def mark(root: Node) -> tuple[list[Node], list[Node]]:
    """Elements parents first, each with its subtree's hash and whether an article holds
    it; and the outermost articles that the page marks (outside what surrounds one)."""
    nodes, found = walk(root), []
    root.inside = False
    around = {id(root): False}
    for n in nodes:
        if n is not root:
            around[id(n)] = around[id(n)] or is_around(n, n.inside)
        article = not around[id(n)] and is_article(n)
        if article and not n.inside:
            found.append(n)
        for c in n.children:
            if isinstance(c, Node):
                c.inside = n.inside or article
                around[id(c)] = around[id(n)]
    for n in reversed(nodes):
        parts = [n.tag, "\0", n.attributes]
        for c in n.children:
            parts.append(f"\1{c.hash:x}" if isinstance(c, Node) else "\2" + " ".join(c.split()))
        n.hash = xxhash.xxh3_64_intdigest("".join(parts).encode("utf-8", "surrogatepass"))
    return nodes, found


def removable(nodes: list[Node]) -> list[Node]:
    """The elements with content that may be template: blocks inside an article, blocks outside
    that hold none, and inline elements that stand among the body's blocks, not in text."""
    holds, free = set(), set()
    for n in reversed(nodes):
        if is_article(n) or any(isinstance(c, Node) and id(c) in holds for c in n.children):
            holds.add(id(n))
        if n.tag in WHOLE and not any(isinstance(c, str) and c.strip() for c in n.children):
            free.update(id(c) for c in n.children)
    return [n for n in nodes if n.children and n.tag not in HIDDEN and n.tag not in WHOLE
            and (not is_article(n) if n.inside else id(n) not in holds) and (n.tag in BLOCKS or "-" in n.tag or id(n) in free)]


def key(n: Node) -> int:
    """The hash (signed) of a subtree, another inside an article than outside."""
    return (n.hash ^ INSIDE if n.inside else n.hash) - 2**63


def candidates(page: str) -> list[tuple[bool, int, int | None]]:
    """(inside an article, hash of the page or of its articles, hash): the removable subtrees, and a row with
    a null hash for the page and for its articles."""
    root = tree(page)
    nodes, marked = mark(root)
    whole = root.hash - 2**63
    out = [(False, whole, None)]
    if marked:
        articles = xxhash.xxh3_64_intdigest(" ".join(f"{n.hash:x}" for n in marked)) - 2**63
        out.append((True, articles, None))
    found = removable(nodes)
    out += [(False, whole, h) for h in sorted({key(n) for n in found if not n.inside})]
    return out + [(True, articles, h) for h in sorted({key(n) for n in found if n.inside})]


def text_of(page: str, template) -> str:
    """The main text without the subtrees whose hashes are in ``template``."""
    root = tree(page)
    nodes, marked = mark(root)
    shared = {id(n) for n in removable(nodes) if key(n) in template} if template else ()
    blocks, now = [], []

    def close():
        t = " ".join("".join(now).split())
        if t:
            blocks.append(t)
        now.clear()

    # (node or text, kept by an article) or None for the end of a block
    todo = [(root, False)]
    while todo:
        n, kept = todo.pop()
        if n is None:
            close()
        elif isinstance(n, str):
            if kept or not marked:
                now.append(n)
        else:
            if n is not root and is_around(n, n.inside) or id(n) in shared:
                if n.tag in BLOCKS:
                    close()
                continue
            block = n.tag in BLOCKS
            if block:
                close()
                todo.append((None, False))
            kept = kept or is_article(n)
            todo += [(c, kept) for c in reversed(n.children)]
    close()
    return "\n".join(blocks)


def hosts(url):
    """The host of a URL, lower case, without port or user."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


SHARED = "host string, page_id long, inside boolean, content long, hash long"


def _shared(pages: DataFrame) -> DataFrame:
    """(host, page_id, inside, content, hash), the latter three as ``candidates`` gives them."""
    ship(pages.sparkSession)

    def run(batches):
        from reviewflow.llm import html_template, runtime
        for batch in batches:
            for part, texts in runtime.text_slices(batch, "html", chars=2_000_000):
                found = [html_template.candidates(t) for t in texts]
                rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), *(pa.array([x[k] for f in found for x in f], t) for k, t in enumerate((pa.bool_(), pa.int64(), pa.int64())))],
                    names=["host", "page_id", "inside", "content", "hash"])

    return pages.select("host", "page_id", "html").mapInArrow(run, SHARED)


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, hash) of the subtrees that recur on at least ``min_pages`` different pages of a
    host and ``min_share`` of them (inside articles: of its different articles)."""
    rows = pages.select(hosts(F.col("url")).alias("host"), F.lit(0).cast("long").alias("page_id"), "html")
    different = _shared(rows.where("html is not null")).select("host", "inside", "content", "hash").distinct()
    counted = different.groupBy("host", "inside", "hash").agg(F.count("*").alias("pages")).where(F.col("hash").isNull() | (F.col("pages") >= min_pages))
    counted = written(counted, "subtrees")
    totals = counted.where("hash is null").select("host", "inside", F.col("pages").alias("of"))
    return counted.where("hash is not null").join(totals, ["host", "inside"]).where(F.col("pages") >= F.col("of") * min_share).select("host", "hash")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", min_pages: int = MIN_PAGES,
            most_hashes: int = MOST_HASHES) -> DataFrame:
    """(page_id, url, text) of every page."""
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    found = written(templates(rows, min_pages), "templates")
    n = found.count()
    if n <= most_hashes:
        by_host: dict[str, set] = {}
        for r in found.toLocalIterator():
            by_host.setdefault(r.host, set()).add(r.hash)
        shared = spark.sparkContext.broadcast({h: np.array(sorted(s), np.int64) for h, s in by_host.items()})
        given = rows.select("page_id", "url", "html", hosts(F.col("url")).alias("host"))

        def per_row(part):
            cache = per_row.cache
            for h in part.column(3).to_pylist():
                if h not in cache:
                    cache[h] = frozenset(shared.value.get(h, np.zeros(0, np.int64)).tolist())
                yield cache[h]
        per_row.cache = {}
        return given.mapInArrow(_extractor(per_row), "page_id long, url string, text string")
    # beyond the broadcast's bound: each page's own template subtrees, by joins on small rows
    given = rows.withColumn("row", F.xxhash64("page_id", "url", "html"))
    keyed = given.select(hosts(F.col("url")).alias("host"), F.col("row").alias("page_id"), "html")
    own = _shared(keyed).select("host", "page_id", "hash").distinct().join(found.hint("merge"), ["host", "hash"]).groupBy("page_id").agg(F.collect_set("hash").alias("own"))
    met = given.join(own.withColumnRenamed("page_id", "row").hint("merge"), "row", "left").select("page_id", "url", "html", "own")
    return met.mapInArrow(_extractor(lambda part: (frozenset(o or ()) for o in part.column(3).to_pylist())), "page_id long, url string, text string")


def _extractor(template_of):
    def run(batches):
        from reviewflow.llm import html_template, runtime
        for batch in batches:
            for part, texts in runtime.text_slices(batch, "html", chars=2_000_000):
                got = [html_template.text_of(t, own) for t, own in zip(texts, template_of(part))]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(1), pa.array(got, pa.string())], names=["page_id", "url", "text"])

    return run
