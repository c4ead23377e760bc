"""Main text of web pages by composite text density.

A page becomes a tree of elements.  Every element gets its characters, tags,
characters in links and link tags (its whole subtree's) and from them the
composite density: characters per tag, times a logarithm that falls as the
share of link characters and link tags rises.  An element's density sum adds
the densities of its children and of its own direct text.  The element with
the largest sum holds the main text; the smallest density on its path to body
is the threshold.  If it stands in an article (or main) element, that is taken
whole; else it grows to its parent, below body, while a neighbour reaches the
threshold.  Within the chosen subtree, parts that are mostly links and below
the threshold go, but not in an article: its link paragraphs, lists of references
and tables are its text.

What is never main text leaves the tree first: scripts, styles, forms, menus,
headers, footers, asides and whatever its role, class or id names as such, as
advert, notice or reader comment (``NOISE``), and what is hidden.  A class or an
id is such a name as a whole: its other words only say where or in what the
element stands.  Headings stay whatever their class or id, paragraphs but for
the class of an advert or a comment.  An element with an article or main inside
is kept whatever its name; so is one with most of the page's text outside links,
unless it is named as advert, comment, cookie notice, footer or menu (``FIRM``).

Character references are decoded; white space inside a block becomes one
space; blocks are trimmed and joined in page order by two line feeds.

Defined results: null or empty html, or html without text, gives an empty
text; unclosed and stray tags are repaired the usual way; html without any tag
is one block; repeated rows give equal texts; an empty table gives an empty
result."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import mapped, spread

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4
h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul""".split())
#: A start tag that ends open elements of these names (up to the nearest of the second set).
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Elements that an end tag or a new paragraph does not reach past.
SCOPE = frozenset("html body table td th button".split())
#: Never main text.
DROPPED = frozenset("""head script style noscript template nav header footer aside form button select textarea input label iframe svg canvas object
audio video map menu dialog datalist""".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Words that, alone or with each other, name what is not main text as a class or id.
NOISE = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu
breadcrumb breadcrumbs header masthead topbar footer sidebar aside cookie cookies consent gdpr notice popup modal overlay newsletter
subscribe subscription signup login share sharing social comment comments disqus reply replies respond related recommended widget
pagination pager toolbar copyright adsbygoogle commentlist adbox adblock adslot adunit adspace""".split())
#: Of these, adverts and comments, which may be paragraphs; names whose elements go whatever they hold; names that also tell a page's layout.
FIRM_P = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo comment comments adsbygoogle commentlist adbox adblock adslot adunit adspace".split())
FIRM = FIRM_P | frozenset("""disqus reply replies respond cookie cookies consent gdpr footer copyright breadcrumb breadcrumbs nav navbar navigation
pagination pager""".split())
LAYOUT = frozenset("banner header masthead topbar sidebar aside notice popup modal overlay widget toolbar menu".split())
#: Other words that may stand in such a class or id; the second ones not where its words of NOISE are all of LAYOUT.
FRAME = frozenset("""site main global top bottom left right primary secondary upper lower wrap wrapper container inner outer box bar area block
group row holder bg wp mobile desktop list links link item items icon icons button buttons form field title text label close""".split())
OWNERS = frozenset("""post posts entry article articles page pages section content story stories news product products body author meta count thread
media slot unit space zone google dfp law info for you email user users reader readers visitor visitors member members guest""".split())
COMPOUNDS = frozenset("article-sidebar blog-sidebar page-sidebar post-sidebar sidebar-widgets footer-widgets header-widgets".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Dropped with all they hold, an article too, where their end tag is met; without it they end with their parent.
CLOSED = frozenset("noscript template iframe svg".split())
#: Start tags that end an open svg: drawings have no such elements.
NOT_DRAWN = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre
ruby s small span strong strike sub sup table tt u ul var article aside footer header main nav section""".split())

# A quote opens a string only where a value begins.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+"""
# Comments and declarations; text of script, style, textarea and title up to the end tag or the page's end; self-closed
# ones, and elements that are dropped whole, where the next tag of that name is the end tag (others are nodes); tags.
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*+>|<(script|style|textarea|title)(?=[\s/>])[^>]*+(?<!/)>.*?(?:</\1\s*+>|\Z)"""
    rf"""|<(script|style|textarea|title)(?=[\s/>])[^>]*+(?<=/)>(?:(?!</?\2[\s/>]).)*+</\2\s*+>"""
    rf"""|<(noscript|template|iframe)(?=[\s/>]){_ATTRIBUTES}(?<!/)>(?:(?!</?\3[\s/>]).)*+</\3\s*+>"""
    rf"""|<svg(?=[\s/>]){_ATTRIBUTES}(?<!/)>(?:(?!</?(?:svg|{"|".join(sorted(NOT_DRAWN))})[\s/>]).)*+</svg\s*+>"""
    rf"""|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Node:
    __slots__ = ("chars", "children", "density", "hold", "link_chars", "link_tags", "own", "parent", "tag", "tags", "total")

    def __init__(self, tag: str, parent: _Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.chars = self.link_chars = self.tags = self.link_tags = self.own = 0


def _named(names: str) -> set[str]:
    """The words of NOISE of each class or id that names noise as a whole."""
    found: set[str] = set()
    for name in names.split():
        words = {w.lower() for w in _WORDS.findall(name) if len(w) > 1}
        noise = words & NOISE
        if noise and (words <= NOISE | FRAME or words <= NOISE | FRAME | OWNERS and not noise <= LAYOUT):
            found |= noise
        elif name.lower().replace("_", "-") in COMPOUNDS:
            found |= noise or {"widget"}
    return found


def _noise(tag: str, raw: str) -> bool | str:
    """Whether the element's name, role, class or id says that it is not main
    text; a string where that holds only for an element without most of the text."""
    if tag in DROPPED:
        return True
    if not raw or raw.isspace():
        return False
    attributes = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(raw)}
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if tag in ("html", "body", "main") or tag in HEADINGS:
        return False
    if tag == "p":
        return bool(_named(attributes.get("class", "")) & FIRM_P)
    named = _named(f"{attributes.get('class', '')} {attributes.get('id', '')}")
    if tag == "article":
        return bool(named & {"comment", "comments", "reply", "ad", "advert", "sponsored", "promo"})
    return bool(named & FIRM) or ("header" if named & {"header", "masthead"} else "named" if named else False)


def _tree(html: str) -> _Node:
    """The page's tree; children are nodes and strings (decoded text).  ``hold`` marks what is noise."""
    root = at = _Node("html", None)
    root.hold = False
    last, drawn, rest = 0, False, ""
    whole = html.rfind(">") + 1
    if html.count("<", whole) > 1:  # no tag ends there: looking for each one's end would read the rest again and again
        html, rest = html[:whole], html[whole:].partition("<!--")[0]
    for m in _TOKEN.finditer(html):
        if m.start() > last:
            at.children.append(unescape(html[last : m.start()]))
        last = m.end()
        name = m[5] or m[8]
        if not name:  # a comment, a declaration or an element of raw text
            if rest and last == whole and (m[0].startswith("<!--") and not m[0].endswith("-->") or m[1] and not re.search(rf"</{m[1]}\s*>\Z", m[0], re.I)):
                rest = ""  # open to the page's end
            continue
        tag, closing, raw = name.lower(), m[4] or m[7], (m[6] if m[5] else m[9]) or ""
        if closing:
            x = at
            while x is not None and x.tag != tag and not (x.tag in SCOPE and tag not in SCOPE and tag != "tr"):
                x = x.parent
            if x is not None and x.tag == tag and x.parent is not None:
                at = x.parent
                if tag in CLOSED:
                    x.children = []
            continue
        if tag in NOT_DRAWN and drawn:
            x = at
            while x is not None and x.tag not in ("svg", "foreignobject"):
                x = x.parent
            if x is None:
                drawn = False
            elif x.tag == "svg":
                at = x.parent
        if tag in ("html", "body") and at.parent is None:
            if tag == "html":
                continue
        if tag in BLOCK:  # an open paragraph ends
            x = at
            while x.parent is not None and x.tag != "p" and x.tag not in SCOPE and x.tag not in BLOCK:
                x = x.parent
            if x.tag == "p":
                at = x.parent
        if tag in ENDS:
            names, bound = ENDS[tag]
            x, found = at, None
            while x.parent is not None and x.tag not in bound:
                if x.tag in names:
                    found = x
                x = x.parent
            if found is not None:
                at = found.parent
        node = _Node(tag, at)
        node.hold = tag in DROPPED if at.tag in ("pre", "code") else _noise(tag, raw)  # classes in code are for its colours
        at.children.append(node)
        if tag not in VOID and not raw.endswith("/"):
            at = node
            drawn = drawn or tag == "svg"
    if last < len(html) or rest:
        at.children.append(unescape(html[last:] + rest))
    return root


def _in_order(root: _Node) -> list[_Node]:
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += [c for c in reversed(x.children) if not isinstance(c, str)]
    return order


def _pruned(root: _Node) -> list[_Node]:
    """Take noise out of the tree; the nodes that stay, parents first.  An
    element that holds an article or main stays, or one that is only named as
    noise and holds most of the text outside links; of a header inside an
    article its headings stay."""
    order, holds = _in_order(root), set()
    if any(isinstance(x.hold, str) for x in order):
        for x in reversed(order):
            if x.tag != "a" and x.hold is not True:
                x.chars = sum(len(" ".join(c.split())) if isinstance(c, str) else c.chars for c in x.children)
        for x in order:
            if isinstance(x.hold, str) and 2 * x.chars > root.chars:
                x.hold = False
    for x in order:
        if x.tag in ("article", "main") and not x.hold:
            up = x.parent
            while up is not None and id(up) not in holds:
                holds.add(id(up))
                up = up.parent
    kept, todo = [], [(root, False)]
    while todo:
        x, inside = todo.pop()
        kept.append(x)
        inside = inside or x.tag in ("article", "main")
        children = []
        for c in x.children:
            if isinstance(c, str) or not c.hold or id(c) in holds:
                children.append(c)
            elif (c.tag == "header" or c.hold == "header") and inside:
                children += [h for h in _in_order(c) if h.tag in HEADINGS]
        x.children = children
        for c in reversed(children):
            if not isinstance(c, str):
                c.parent = x
                todo.append((c, inside))
    return kept


def _densities(nodes: list[_Node], body: _Node) -> None:
    for x in nodes:
        x.own = sum(len(" ".join(c.split())) for c in x.children if isinstance(c, str))
        x.chars = x.own
    links: set[int] = set()
    for x in nodes:
        if x.tag == "a" or (x.parent is not None and id(x.parent) in links):
            links.add(id(x))
            x.link_chars = x.own
    for x in reversed(nodes):
        up = x.parent
        if up is not None:
            up.chars += x.chars
            up.link_chars += x.link_chars
            up.tags += x.tags + 1
            up.link_tags += x.link_tags + (x.tag == "a")
    share = body.link_chars / max(body.chars, 1)
    for x in nodes:
        x.density = _density(x.chars, x.tags, x.link_chars, x.link_tags, share)
    for x in nodes:
        x.total = sum(c.density for c in x.children if not isinstance(c, str))
        if x.own:
            x.total += _density(x.own, 0, x.own if id(x) in links else 0, 0, share)


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Composite text density.  Zero denominators count as one, and the
    logarithm's base is e at least (the formula's own is 1 on a page without links)."""
    if not chars:
        return 0.0
    base = log(chars / max(chars - link_chars, 1) * link_chars + share * chars + e)
    inner = chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)
    return chars / max(tags, 1) * max(log(inner), 0.0) / max(log(base), 1.0)


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    root = _tree(html)
    nodes = _pruned(root)
    body = next((x for x in nodes if x.tag == "body"), root)
    _densities(nodes, body)
    inside = set()
    for x in nodes:
        if x is body or id(x.parent) in inside:
            inside.add(id(x))
    best = max((x for x in nodes if id(x) in inside and x.chars), key=lambda x: x.total, default=None)
    if best is None:
        return ""
    path = [best]
    while path[-1] is not body:
        path.append(path[-1].parent)
    threshold = min(x.density for x in path)
    article = next((x for tag in ("article", "main") for x in reversed(path) if x.tag == tag), None)
    if article is not None:
        best = article
    else:
        while best is not body and best.parent is not body and any(
                not isinstance(c, str) and c is not best and c.chars and c.density >= threshold for c in best.parent.children):
            best = best.parent
    return _written(best, threshold)


def _written(top: _Node, threshold: float) -> str:
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    todo: list[_Node | str | None] = [top]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            line.append(x)
        elif x is not top and top.tag != "article" and x.tag in BLOCK and x.density < threshold and 2 * x.link_chars > x.chars:
            end()
        else:
            if x.tag in BLOCK:
                end()
                todo.append(None)
            elif x.tag in ("br", "td", "th"):
                line.append(" ")
            todo += reversed(x.children)
    end()
    return "\n\n".join(blocks)


def extracted(pages: DataFrame, html_col: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The carried columns and ``text`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 512):
                b = whole.slice(s, 512)
                text = pa.array([main_text(x.as_py()) for x in b.column(b.num_columns - 1)], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], text], [*b.schema.names[:-1], "text_"])

    given = spread(pages).select(*[F.col(c).alias(f"carry_{c}") for c in carry], F.col(html_col).alias("html_"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1]], "text_ string"])
    return mapped(given, run, schema).select(*[F.col(f"carry_{c}").alias(c) for c in carry], F.col("text_").alias("text"))
