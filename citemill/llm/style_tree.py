"""Main text of web pages by a style tree per site.

The pages of a host are merged into one tree: a node is a place in the page (the
chain of tags, classes and positions down to it). Every page that has the place
adds a presentation (the tags of its children) and a content (its text). A place
whose presentation and content hardly vary over the site's pages, measured by
entropy, is furniture: the importance of a node is the entropy of its contents
and presentations over its ``m`` pages, to the base ``m``, and branches of low
importance are taken off each page, but for what an ``article`` or ``main``
element holds: headings and closing lines that a site's articles share are text.
The tree says nothing on places with fewer than ``MIN_PAGES`` pages of different
bodies; there, names, roles and classes alone decide. Before that, elements that by name, role or
class are menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles or reader comments are left out, and what an ``article`` or ``main``
element holds goes before the rest of the body. A class or id never takes away
what holds such an element, unless that is an ``article`` of such a class itself.

Pages of a host with the same body (what ``article`` or ``main`` hold, or without
them all that is kept) count as one page, so mirrored pages do not make their own
text furniture. Copies that differ in the body count apart.

Only (host, place, feature hash, count) rows are shuffled, summed per task first,
so a host with a third of all pages is spread by place and feature. The bodies go
the same way; only pages found to be copies are parsed again, and their counts
taken off. Places of low importance come back as one short list per host.

Defined cases: a null or empty page, or one without text, has the empty text;
pages without a host are one site; rows with equal ids are worked on one by one
and count as pages of their own; a null id stays null; an empty table gives an
empty result; other columns are not read. Broken mark-up never fails: what is
open at the end is closed, stray end tags are passed over.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.llm.common import as_bytes, map_arrow
from citemill.shared import lookup_join, materialise

# A place needs so many pages of different bodies, and less importance than this, to be furniture.
MIN_PAGES = 8
MIN_IMPORTANCE = 0.1
# How much of the importance is that of the contents.
CONTENT_WEIGHT = 0.9

# HTML element names and usual class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output progress"
    " q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head nav footer aside form button select option input dialog menu object audio video canvas map".split()
) | RAW
CLOSED_BY_BLOCK = frozenset(["p"])
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
              "th": {"td", "th"}, "option": {"option"}}
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_CLASSES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion"
    " cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe signup"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc sidebar sidenav rail aside widget"
    " footer header masthead topbar"
    " comment comments commentlist commenter commentary reply replies respond response responses disqus discussion"
    " feedback reactions talkback guestbook"
    " share sharing social related recommended login search".split()
)
# Words that name other things as well: they count with no other words than these beside them,
# and never take an element that holds text by its kind.
AMBIGUOUS = frozenset(
    "social search related share sharing notice notices discussion reply replies respond rail widget overlay modal header"
    " consent promotion recommended subscribe login popup response responses feedback reactions".split()
)
COMPANIONS = frozenset(
    "bar box button buttons links link list block section area container wrap wrapper form icons icon media post posts"
    " article articles stories news items item row group panel top bottom left right main site page global inner js"
    " to us this now me field input reader readers user users".split()
)
TEXT_ELEMENTS = frozenset("table figure p blockquote pre dl h1 h2 h3 h4 h5 h6".split())
# Class parts that say that something else is there ("has-sidebar").
QUALIFIERS = frozenset("has with no without is".split())
KEPT_ALWAYS = frozenset("html body main article".split())

TAG = re.compile(
    r"<(?:!--(?s:.*?)(?:-->|\Z)"
    r"|(?P<slash>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)"
    r"|[!?/][^>]*+(?:>|\Z))"
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
KEEP, BY_NAME, BY_CLASS = range(3)
# Kinds of counted rows: presentation, content, and the body with a page's key.
PRESENTATION, CONTENT, BODY = range(3)
NAME_PARTS = re.compile(r"[a-z0-9]+")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Node:
    """An element with children (nodes and texts), its place and whether it is kept."""

    __slots__ = ("name", "label", "children", "place", "dropped", "central", "counts", "reason", "opens", "holds")

    def __init__(self, name: str, label: str, place: int, dropped: bool, central: bool):
        self.name, self.label, self.place, self.dropped, self.central = name, label, place, dropped, central
        self.children: list = []
        self.counts: Counter = Counter()
        #: Why it is left out by itself, whether it is an article or main part, whether it holds one.
        self.reason, self.opens, self.holds = KEEP, False, False


def hashed(*values) -> int:
    data = "\x00".join(map(str, values)).encode("utf-8", "replace")
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def attributes(rest: str) -> dict[str, str]:
    if "=" not in rest:
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}


def class_dropped(name: str, own: dict[str, str]) -> bool:
    """Whether a class or the id of an element says that it is no article text."""
    for value in (*own.get("class", "").lower().split(), own.get("id", "").lower()):
        parts = NAME_PARTS.findall(value)
        if not parts or parts[0] in QUALIFIERS:
            continue
        hits = DROPPED_CLASSES.intersection(parts)
        if hits - AMBIGUOUS:
            return True
        beside = (p for p in parts if p not in hits and not p.isdigit())
        if hits and name not in TEXT_ELEMENTS and COMPANIONS.issuperset(beside):
            return True
    return False


def unwanted(name: str, own: dict[str, str]) -> int:
    """Whether an element is left out by its name or role, or by its class or id. Headers: see :func:`settle`."""
    if name in DROPPED:
        return BY_NAME
    if name in KEPT_ALWAYS:
        return KEEP
    if own.get("role", "").lower() in DROPPED_ROLES or own.get("itemprop", "").lower() == "comment":
        return BY_NAME
    return BY_CLASS if class_dropped(name, own) else KEEP


def settle(node: Node, parent: Node) -> None:
    """Whether a node is dropped and whether it is central, once this is known of its parent."""
    left_out = node.reason == BY_NAME or (node.reason == BY_CLASS and not node.holds)
    node.dropped = parent.dropped or left_out or (node.name == "header" and not parent.central)
    node.central = (parent.central or node.opens) and not node.dropped


def parse(html: str) -> Node:
    """The page as a tree. Linear in the page but for very deep nesting of unclosed elements."""
    root = Node("", "", 0, False, False)
    stack, open_names, at = [root], Counter(), 0
    held_back = False
    lower = None

    def close(depth: int) -> None:
        while len(stack) > depth:
            open_names[stack.pop().name] -= 1

    def nearest(names, barrier=()) -> int | None:
        """Depth of the innermost open element of these names, if nothing of ``barrier`` is within."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                return depth
            if stack[depth].name in barrier:
                return None
        return None

    while at < len(html):
        start = html.find("<", at)
        if start < 0:
            start = len(html)
        match = TAG.match(html, start) if start < len(html) else None
        if start > at:
            stack[-1].children.append(html[at:start])
        if match is None:
            if start < len(html):
                stack[-1].children.append("<")
            at = start + 1
            continue
        at = match.end()
        name = (match["name"] or "").lower()
        if not name:
            continue
        if match["slash"]:
            if open_names[name]:
                close(nearest((name,)))
            continue
        if name not in INLINE and name not in VOID and open_names["p"]:
            depth = nearest(CLOSED_BY_BLOCK, ("div", "article", "section", "td", "li", "table", "button"))
            if depth:
                close(depth)
        if name in SAME_LEVEL and any(open_names[n] for n in SAME_LEVEL[name]):
            depth = nearest(SAME_LEVEL[name], ("ul", "ol", "dl", "table", "select"))
            if depth:
                close(depth)
        parent, own = stack[-1], attributes(match["rest"])
        classes = " ".join(sorted(own.get("class", "").lower().split()))
        label = f"{name}.{classes}" if classes else name
        parent.counts[label] += 1
        node = Node(name, label, hashed(parent.place, label, parent.counts[label]), False, False)
        node.reason = unwanted(name, own)
        node.opens = name in ("article", "main") or own.get("role", "").lower() == "main" or (
            own.get("itemprop", "") == "articleBody"
        )
        if node.opens and node.reason == KEEP and not (name == "article" and class_dropped(name, own)):
            for above in reversed(stack):
                if above.holds:
                    break
                above.holds = True
                held_back |= above.reason == BY_CLASS
        settle(node, parent)
        parent.children.append(node)
        if name in RAW:
            lower = html.lower() if lower is None else lower
            if len(lower) != len(html):  # a letter whose lower case is longer
                lower = re.sub(r"[A-Z]+", lambda m: m[0].lower(), html)
            end = lower.find(f"</{name}", at)
            at = len(html) if end < 0 else end
            if at < len(html):
                closing = html.find(">", at)
                at = len(html) if closing < 0 else closing + 1
        elif name not in VOID:
            stack.append(node)
            open_names[name] += 1
    if held_back:
        for node, down in walk(root):
            if down:
                for child in node.children:
                    if isinstance(child, Node):
                        settle(child, node)
    return root


def walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """Nodes on the way down (True) and up (False), without recursion."""
    stack = [(root, True)]
    while stack:
        node, down = stack.pop()
        yield node, down
        if down:
            stack.append((node, False))
            stack += [(c, True) for c in reversed(node.children) if isinstance(c, Node)]


def squeeze(text: str) -> str:
    return " ".join(unescape(text).split())


def features(html: str) -> Iterator[tuple[int, int, int]]:
    """(place, kind, hash) of the presentation and the content of every kept node; last (body, BODY, 0)."""
    inner: dict[int, int] = {}
    central: list[int] = []
    for node, down in walk(parse(html)):
        if down or node.dropped:
            continue
        texts = [squeeze(c) if isinstance(c, str) else inner.get(id(c), 0) for c in node.children]
        content = hashed(*(t for t in texts if t))
        if not node.central:
            central += [inner[id(c)] for c in node.children if isinstance(c, Node) and c.central]
        if node.name:
            inner[id(node)] = content
            yield node.place, PRESENTATION, hashed(*(c.label for c in node.children if isinstance(c, Node)))
            yield node.place, CONTENT, content
        else:
            yield hashed("body", *central) if central else content, BODY, 0


def main_text(html: str, furniture: dict[int, float]) -> str:
    """The text of a page without its furniture (places and their importance)."""
    root = parse(html)
    central = any(n.central for n, down in walk(root) if down)
    blocks: list[list[str]] = [[]]
    skip: Node | None = None

    def gone(node: Node) -> bool:
        # What a site's articles share (headings, closing lines) is article text: the tree judges outside only.
        if node.dropped or node.central or node.name in KEPT_ALWAYS:
            return node.dropped
        return furniture.get(node.place, 1.0) < MIN_IMPORTANCE

    stack: list = [root]
    while stack:
        item = stack.pop()
        if item is None:
            blocks.append([])
        elif isinstance(item, tuple):
            blocks[-1].append(item[0])
        elif not gone(item):
            block = item.name not in INLINE
            if block:
                blocks.append([])
                stack.append(None)
            keep_text = item.central or not central
            stack += [c if isinstance(c, Node) else (c,) for c in reversed(item.children) if keep_text or isinstance(c, Node)]
    return " ".join(filter(None, (squeeze("".join(b)) for b in blocks)))


def importance(counts: DataFrame) -> DataFrame:
    """``host, place, pages, importance`` from ``host, place, kind, feature, n``."""
    n = F.col("n").cast("double")
    each = counts.groupBy("host", "place", "kind").agg(
        F.sum("n").alias("pages"), (F.log(F.sum(n)) - F.sum(n * F.log(n)) / F.sum(n)).alias("entropy")
    )
    part = F.when(F.col("pages") > 1, F.col("entropy") / F.log("pages")).otherwise(1.0)
    weight = F.when(F.col("kind") == 1, CONTENT_WEIGHT).otherwise(1 - CONTENT_WEIGHT)
    return each.groupBy("host", "place").agg(
        F.max("pages").alias("pages"), F.sum(weight * part).alias("importance")
    )


def counted(pages: DataFrame, bodies: bool) -> DataFrame:
    """``host, place, kind, feature, n`` over ``host, key, weight, html``; summed per piece before the shuffle.

    With ``bodies``, rows of kind ``BODY`` have the body as place and the page's key as feature.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for host, key, weight, html in zip(*(c.to_pylist() for c in batch.columns)):
            for place, kind, feature in features((html or b"").decode("utf-8", "replace")):
                if kind != BODY:
                    counts[host, place, kind, feature] += weight
                elif bodies:
                    counts[host, place, kind, key] += weight
        if counts:
            columns = [*zip(*counts), list(counts.values())]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.float64()]
            names = ["host", "place", "kind", "feature", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

    rows = pages.select("host", "key", "weight", as_bytes("html").alias("html"))
    return map_arrow(rows, run, "host string, place long, kind int, feature long, n double")


def feature_counts(pages: DataFrame) -> DataFrame:
    """``host, place, kind, feature, n`` over the pages of different bodies."""
    keyed = pages.select("host", F.xxhash64("html").alias("key"), "html")
    same = ["host", "place", "kind", "feature"]
    every = counted(keyed.withColumn("weight", F.lit(1.0)), True).groupBy(*same).agg(F.sum("n").alias("n"))
    every = materialise(every, "features")
    # The first key of a body stays; of several rows with that key one.
    bodies = every.filter(F.col("kind") == BODY)
    copied = bodies.groupBy("host", "place").agg(F.min("feature").alias("first"), F.sum("n").alias("pages"))
    copied = materialise(copied.filter("pages > 1").drop("pages"), "copied")
    weight = F.when(F.col("feature") == F.col("first"), 1 / F.col("n") - 1).otherwise(-1.0)
    copies = lookup_join(bodies, copied, ["host", "place"], "inner", ["feature"])
    copies = copies.select("host", F.col("feature").alias("key"), weight.alias("weight")).filter("weight < 0")
    copies = materialise(copies, "copies")
    counts = every.filter(F.col("kind") != BODY)
    less = counted(lookup_join(keyed, copies, ["host", "key"], "inner", ["key"]), False)
    # Rows of one key take off a fraction each; together these are whole.
    sums = counts.unionByName(less).groupBy(*same).agg(F.round(F.sum("n")).cast("long").alias("n"))
    return sums.filter("n > 0")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    url = F.col(url_col).cast("string")
    host = F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host.alias("host"),
        F.col(html_col).cast("string").alias("html"),
    )
    low = importance(feature_counts(rows)).filter((F.col("pages") >= MIN_PAGES) & (F.col("importance") < MIN_IMPORTANCE))
    sites = low.groupBy("host").agg(F.collect_list(F.struct("place", "importance")).alias("furniture"))
    joined = lookup_join(rows, materialise(sites, "sites"), ["host"], "left", ["page_id", "url"])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, known = [], {}
        for host, places, html in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            if host not in known:
                known[host] = {p["place"]: p["importance"] for p in places or []}
            texts.append(main_text((html or b"").decode("utf-8", "replace"), known[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    return map_arrow(
        joined.select("page_id", "url", "host", "furniture", as_bytes("html").alias("html")),
        run,
        "page_id long, url string, text string, n_chars long",
    )
