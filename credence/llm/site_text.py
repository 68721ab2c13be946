"""Main text of web pages by site style trees (Yi, Liu & Li, 2003).

Each page is parsed to a tree of elements, and the trees of a host are merged:
an element is known by its style path (tags and classes from the root). For each
style path of a host two entropies are taken over the pages that have it: of
its presentation (the sequences of its children) and of its content (its own
text). Their mean, scaled by the logarithm of the number of pages, is the path's
own importance, and a branch is as important as its most important node: branches
that look and read the same on every page score near 0.

Removed from a page are
- branches that are no article by their element or their class, id or role
  (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
  comments of readers): presentation whose meaning is fixed;
- low-importance branches, on hosts with ``MIN_PAGES`` pages with that path. Below
  an article (or main) element they go too, with two limits: words inside a
  sentence stay (an inline element goes only where it stands alone in a
  container), and an article of which nothing but headings or dates would be left
  is a repeated article and stays whole.
If the page has article (or main) elements, only their text stays; of a main whose
articles hold more than half of its text, only that of the articles. An article is
never removed for being repeated: copies of one article are still articles, and
they count once for the entropies of the paths below it.

(host, path) counts are shuffled, pre-aggregated per task, and the distinct
articles' path digests; a host with a third of all pages is many partial counts.
The low-importance paths are few, and are broadcast only after their number is
checked.

A line-break element ends a block as a paragraph does.

Cases: null and empty html give an empty text; broken markup is closed as far
as it goes; a null or odd url is the host "". Rows may repeat; other columns are
ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.llm.common import as_texts, stored

MIN_PAGES = 8
LOW = 0.25
BROADCAST_PATHS = 500_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
NOISE_TAGS = frozenset("head script style noscript template nav header footer aside form button select textarea input "
                       "iframe object embed svg canvas dialog menu option label fieldset audio video map".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                        "toolbar".split())
NOISE_NAMES = frozenset("nav navbar navigation menu menus topbar header masthead footer sidebar aside ad ads advert adverts "
                        "advertisement advertising sponsor sponsored sponsors promo promoted banner cookie cookies consent "
                        "gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
                        "login search form comments comment commentlist reply replies disqus discussion responses related "
                        "recommended widget widgets breadcrumb breadcrumbs pagination pager share sharing social toolbar "
                        "skip copyright legal disclaimer paywall".split())
#: Elements whose start closes an open element of the same row.
CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                   "h6 header hgroup hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header time".split())
CONTAINERS = frozenset("article main section div".split())
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACES = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "names", "role", "hidden", "parent", "children", "path")

    def __init__(self, tag: str, parent: Element | None, attributes: str = "") -> None:
        self.tag, self.parent, self.children = tag, parent, []
        self.names, self.role, self.hidden = (), "", False
        style = ""
        if attributes and "=" in attributes:
            names = []
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), (a or b or c).lower()
                if name in ("class", "id"):
                    names += value.split()
                    style += "." + ".".join(value.replace(">", " ").split()) if name == "class" else ""
                elif name == "role":
                    self.role = value
            self.names = tuple(names)
        self.hidden = bool(attributes) and re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) is not None
        self.path = (parent.path + ">" if parent else "") + tag + style


def parse(page: str) -> Element:
    """Tree of a page; children are elements and strings of text."""
    root = Element("", None)
    now, at = root, 0
    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        text = page[at: m.start() if m else size]
        if text:
            now.children.append(text)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            up = now
            while up.parent is not None and up.tag != tag:
                up = up.parent
            if up.parent is not None:
                now = up.parent
            continue
        if tag in ENDS_P:
            now = _closed(now, {"p"}, frozenset(("article", "body", "main", "section", "div", "td", "li", "blockquote")))
        if tag in CLOSES and tag != "p":
            now = _closed(now, CLOSES[tag], SCOPES.get(tag, frozenset()))
        new = Element(tag, now, m[3])
        now.children.append(new)
        if tag in VOID or m[3].endswith("/") and tag not in INLINE and tag not in ENDS_P:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            new.children.append(page[at: end.start() if end else size])
            at = end.end() if end else size
            continue
        now = new
    return root


def _closed(now: Element, tags, scope) -> Element:
    """The parent of the nearest open element of ``tags``, if it is within scope."""
    up = now
    while up.parent is not None and up.tag not in scope:
        if up.tag in tags:
            return up.parent
        up = up.parent
    return now


def noise(e: Element) -> bool:
    """Whether an element's own presentation says it is no article."""
    if e.tag in NOISE_TAGS:
        return e.tag != "header" or not _within(e, "article")
    if e.role in NOISE_ROLES or e.hidden:
        return True
    if e.tag in ("html", "body", "article", "main"):
        return False
    return any(part in NOISE_NAMES for name in e.names for part in re.split(r"[-_]+", name))


def _within(e: Element, tag: str) -> bool:
    while e.parent is not None:
        e = e.parent
        if e.tag == tag:
            return True
    return False


def host(url: str) -> Column:
    """The host of an address, lower-cased: what stands between ``//``, a user name,
    and a port or path, whatever characters it or the rest has. The tree and the
    page take theirs from here."""
    found = F.regexp_extract(F.col(url).cast("string"), r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def styles(root: Element) -> list[tuple[str | None, str, int, int]]:
    """Of every style path of a page outside noise: digests of the children's
    tags and of its own text. Paths below the page's article carry a digest of the
    article, by which its copies are folded."""
    tops = set(map(id, regions(root)))
    seen: tuple[dict, dict] = {}, {}
    stack = [(root, False)]
    while stack:
        e, inside = stack.pop()
        inside = inside or id(e) in tops
        kids = [c for c in e.children if isinstance(c, Element)]
        entry = seen[inside].setdefault(e.path, [[], []])
        entry[0].append(" ".join(dict.fromkeys(c.tag for c in kids)))
        entry[1].append(" ".join(c.strip() for c in e.children if isinstance(c, str)))
        stack += [(c, inside) for c in kids if not noise(c)]
    page, article = ([(p, xxhash.xxh64_intdigest("|".join(a)) >> 1, xxhash.xxh64_intdigest("|".join(sorted(b))) >> 1)
                      for p, (a, b) in s.items()] for s in seen)
    copy = xxhash.xxh3_128_hexdigest(repr(sorted(article)))
    return [(None, *r) for r in page] + [(copy, *r) for r in article]


def regions(root: Element) -> list[Element]:
    """The page's outermost article or main elements that aren't noise; instead of
    a main, the articles inside that hold most of its text."""
    found, stack = [], [root]
    while stack:
        e = stack.pop()
        if e.tag in ("article", "main") or e.role in ("main", "article"):
            articles = _articles(e) if e.tag == "main" else []
            found += articles if articles and 2 * sum(map(_size, articles)) > _size(e) else [e]
        else:
            stack += [c for c in reversed(e.children) if isinstance(c, Element) and not noise(c)]
    return found


def _articles(e: Element) -> list[Element]:
    out, stack = [], [e]
    while stack:
        e = stack.pop()
        if e.tag == "article":
            out.append(e)
        else:
            stack += [c for c in reversed(e.children) if isinstance(c, Element) and not noise(c)]
    return out


def _size(e: Element) -> int:
    """Characters of an element's text outside noise."""
    size, stack = 0, [e]
    while stack:
        for c in stack.pop().children:
            if isinstance(c, str):
                size += len(c.strip())
            elif not noise(c):
                stack.append(c)
    return size


def _repeated(e: Element, low: frozenset[str] | set[str]) -> bool:
    """Whether a branch below an article is a low-importance one that can go."""
    if e.path not in low or e.tag in VOID:
        return False
    if e.tag not in INLINE:
        return True
    return e.parent.tag in CONTAINERS and not any(isinstance(c, str) and c.strip() for c in e.parent.children)


def _has_story(tops: list[Element], low: frozenset[str] | set[str]) -> bool:
    """Whether text other than headings and dates is left without the low branches."""
    stack = list(tops)
    while stack:
        for c in stack.pop().children:
            if isinstance(c, str):
                if c.strip():
                    return True
            elif not (noise(c) or c.tag in HEADINGS or _repeated(c, low)):
                stack.append(c)
    return False


def main_text(page: str, low: frozenset[str] | set[str] = frozenset()) -> str:
    """Blocks of a page's article, by one line break each."""
    if not page:
        return ""
    root = parse(page)
    chosen = regions(root)
    if low and chosen and not _has_story(chosen, low):
        low = frozenset()
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = SPACES.sub(" ", "".join(parts)).strip()
        if text:
            blocks.append(text)
        parts.clear()
    for top in chosen or [root]:
        stack: list = [iter((top,))]
        ends: list[bool] = []
        while stack:
            c = next(stack[-1], None)
            if c is None:
                stack.pop()
                if ends and ends.pop():
                    flush()
            elif isinstance(c, str):
                parts.append(entities.unescape(c) if "&" in c else c)
            elif c is not top and chosen and _repeated(c, low):
                if c.tag not in INLINE:
                    flush()
            elif c is top or not (noise(c) or (not chosen and c.path in low)):
                block = c.tag not in INLINE
                if block:
                    flush()
                if c.tag not in VOID:
                    stack.append(iter(c.children))
                    ends.append(block)
        flush()
    return "\n".join(blocks)


def _style_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(h, *r) for h, page in zip(batch.column("host").to_pylist(), as_texts(batch.column("html")), strict=True)
               if page for r in styles(parse(page))]
        yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in
                               enumerate((pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                              names=["host", "copy", "path", "look", "content"])


def _entropy(rows: DataFrame, by: str) -> DataFrame:
    """(host, path, n, entropy scaled to 0..1) of a digest over pages."""
    counts = rows.groupBy("host", "path", by).agg(F.count("*").alias("c"))
    sums = counts.groupBy("host", "path").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("s"))
    h = F.log("n") - F.col("s") / F.col("n")
    return sums.select("host", "path", F.col("n"), F.when(F.col("n") > 1, h / F.log("n")).otherwise(1.0).alias("h_" + by))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, n, importance) of the merged trees of every host."""
    rows = stored(pages.select(host("url").alias("host"), F.col("html").cast("string").alias("html"))
                  .mapInArrow(_style_rows, "host string, copy string, path string, look long, content long"), "styles")
    # copies of one article count once for the paths below it
    rows = rows.where("copy is null").union(rows.where("copy is not null").distinct()).drop("copy")
    own = (_entropy(rows, "look").join(_entropy(rows, "content").drop("n"), ["host", "path"])
           .select("host", "path", "n", ((F.col("h_look") + F.col("h_content")) / 2).alias("own")))
    # a branch is as important as its most important node
    steps = F.split("path", ">")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), ">"))
    best = (own.select("host", F.explode(above).alias("path"), "own").groupBy("host", "path")
            .agg(F.max("own").alias("importance")))
    return own.join(best, ["host", "path"]).select("host", "path", "n", "importance")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    low = (style_tree(pages).where((F.col("n") >= MIN_PAGES) & (F.col("importance") < LOW))
           .where("path not in ('', '>html', '>html>body')")
           .groupBy("host").agg(F.collect_set("path").alias("low")))
    low = stored(low.select(F.col("host").alias("_host"), "low"), "low")
    p = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host("url").alias("_host"))
    size = low.agg(F.coalesce(F.sum(F.size("low")), F.lit(0))).first()[0]
    p = p.join(F.broadcast(low) if size <= BROADCAST_PATHS else low, "_host", "left").select("page_id", "url", "html", "low")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(h, set(lo or ())) for h, lo in zip(as_texts(batch.column("html")),
                                                                  batch.column("low").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                                   pa.array(list(map(len, text)), pa.int64())], schema=schema)
    return (p.withColumn("page_id", F.col("page_id").cast("long")).withColumn("url", F.col("url").cast("string"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
