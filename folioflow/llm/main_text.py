"""Main text of web pages by composite text density.

Every element has its characters C, tags T, characters in links LC and tags that are links LT. Its density is C / T, damped
by a logarithm whose base grows with the share of link text; the density sum of an element adds the densities of its
children. The element of the largest density sum is the kernel of the text. The smallest density on the path from it up to the body
is the threshold. A kernel inside ``article`` or ``main`` stands for the outermost of them, and others of that kind that reach the threshold
count too. On other pages every element that reaches it gives its part of the largest density sum, anywhere under the body; paragraphs and
elements of the same class beside such a block belong to it however short, unless half of them is link text, and so do headings before it.
Elements that say what they are (navigation, adverts, forms, comments and the like) are left out before. A class or id must name such a
role as a whole (``cookie-banner``, not ``share-price`` or ``has-sidebar``). Adverts and comments then go; of the others, inside ``article`` and ``main``
links or a low density must confirm the name, elsewhere none may hold more than half of the page's text. Elsewhere a name that only
mentions a role counts if links or a low density confirm it.
One pass per page in Arrow batches, no shuffle; a page is parsed by its task alone.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import in_batches

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
LEFT_OUT = frozenset("nav footer aside form script style noscript template iframe object svg math button select textarea input dialog menu "
                     "head title audio video canvas map".split())
#: Start tags that end an open paragraph, and elements whose end tag may be missing.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
                   "nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html article main section div".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in class and id that name what is not main text.
NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
                  "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist respond disqus share sharing "
                  "social related recommended newsletter subscribe subscription popup modal overlay widget login signup search skip pagination pager toolbar".split())
#: Of these, the ones that need no confirmation inside the article; and words that may go with any of them in one class or id.
SURE = frozenset("ad ads adv advert adverts advertisement advertising sponsor comment comments commentlist respond disqus".split())
BESIDES = frozenset("area article articles bar body block box button buttons container content form heading icon icons inner item items left link links "
                    "list media news outer panel post posts right row section slot stories story thread title toggle unit units wrap wrapper".split())
#: Words that make a name tell of what surrounds something, or lacks it.
AROUND = frozenset("has have with without no not non is hide hidden show under below above after before".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements beside a block that read on with it.
BESIDE = frozenset("p section blockquote pre".split())
_OPENING = re.compile(r"<[A-Za-z/!?]")
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Node:
    __slots__ = ("tag", "parent", "parts", "drop", "chars", "tags", "link_chars", "link_tags", "density", "total", "kind", "doubt")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, kind: str = "", doubt: str = ""):
        self.tag, self.parent, self.drop, self.kind, self.doubt = tag, parent, drop, kind, doubt
        self.parts: list[str | Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _named_out(tag: str, attrs: dict[str, str | None], in_text: bool) -> bool:
    if tag in LEFT_OUT or (tag == "header" and not in_text) or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if (attrs.get("role") or "").lower() in ROLES or "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
        return True
    if tag in HEADINGS:
        return False
    names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    return _role(attrs, SURE) or (not in_text and tag not in ("article", "main") and any(_ends_as_role(name, SURE) for name in names))


def _doubt(tag: str, attrs: dict[str, str | None], in_text: bool) -> str:
    """What must be found of an element before its name counts: ``inside``, ``whole`` or ``weak``, or nothing."""
    if tag in HEADINGS or tag in ("article", "main"):
        return ""
    if in_text:
        return "inside" if _role(attrs, NAMES) else ""
    names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    if _role(attrs, NAMES | {"header"}) or any(_ends_as_role(name, NAMES | {"header"}) for name in names):
        return "whole"
    return "weak" if any(t.lower() in NAMES or t.lower() == "header" for name in names for t in _TOKENS.findall(name)) else ""


def _ends_as_role(name: str, roles: frozenset[str]) -> bool:
    """Whether a compound is of the kind that its last telling word names: ``site-header``, but not ``no-header``."""
    words = [t.lower() for t in _TOKENS.findall(name)]
    while words and (words[-1] in BESIDES or words[-1].isdigit()):
        words.pop()
    return bool(words) and words[-1] in roles and not AROUND.intersection(words)


def _role(attrs: dict[str, str | None], roles: frozenset[str]) -> bool:
    """Whether a whole class or the id names one of the roles: its first word does, and the others are roles, numbers or go with any."""
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        first, *more = [t.lower() for t in _TOKENS.findall(name)] or [""]
        if first in roles and all(t in NAMES or t in BESIDES or t == "x" or t.isdigit() for t in more):
            return True
    return False


class Tree(HTMLParser):
    """A tolerant tree: missing end tags are supplied, stray ones ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("html", None)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in ENDS_P:
            self._close({"p"}, SCOPE)
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], SCOPE)
        up, in_text = self.now, False
        while up is not None:
            in_text, up = in_text or up.tag in ("article", "main"), up.parent
        given = dict(attrs)
        node = Node(tag, self.now, _named_out(tag, given, in_text), given.get("class") or "", _doubt(tag, given, in_text))
        self.now.parts.append(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._close({tag}, frozenset() if tag in SCOPE else frozenset(("article", "main", "body")))

    def handle_data(self, data):
        self.now.parts.append(data)

    def _close(self, tags, scope):
        up = self.now
        while up.parent is not None and up.tag not in tags:
            if up.tag in scope:
                return
            up = up.parent
        if up.parent is not None:
            self.now = up.parent


def _in_order(root: Node) -> list[Node]:
    """Kept elements, each before its children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.parts) if isinstance(c, Node) and not c.drop]
    return out


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.total = 0.0
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len("".join(part.split()))
            elif not part.drop:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags + (part.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    body = nodes[0]
    share = body.link_chars / max(1, body.chars)
    for node in nodes:
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, share)
    for node in nodes[1:]:
        node.parent.total += node.density


def _confirm(nodes: list[Node]) -> bool:
    """Leaves out the doubtful elements that their name and their text agree on.

    To confirm a name, links make up a third of the text, or the density is below half that of the article, or the page, around.
    """
    dropped, body = False, nodes[0]
    for node in nodes:
        if node.doubt:
            up = node.parent
            while up.parent is not None and up.tag not in ("article", "main"):
                up = up.parent
            confirmed = node.doubt == "whole" or 3 * node.link_chars >= node.chars or 2 * node.density < up.density
            if confirmed and (node.doubt == "inside" or 2 * node.chars <= body.chars):
                node.drop = dropped = True
    return dropped


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Counts of 0 are taken as 1, so that text without links stays comparable with text with some."""
    if not chars:
        return 0.0
    t, lc, lt = max(1, tags), max(1, link_chars), max(1, link_tags)
    base = math.log(chars / max(1, chars - link_chars) * lc + share * chars + math.e)
    return chars / t * math.log(chars / lc * t / lt + 1, base)


def _blocks(nodes: list[Node]) -> tuple[set[Node], set[Node]]:
    """The elements that make up the main text, and those of which only the text outside their block elements does."""
    best = max(nodes, key=lambda n: n.total)  # the first in page order
    path = []
    up = best
    while up is not None:
        path.append(up)
        up = up.parent
    threshold = min(n.density for n in path)
    named = [n for n in path if n.tag in ("article", "main")]
    articles = [n for n in named if n.tag == "article"]
    beside, bare = frozenset(), set()
    if named:
        whole = (articles or named)[-1]
        taken = {n for n in nodes if n is whole or (n.tag == whole.tag and n.density >= threshold)}
    else:
        beside, taken = BESIDE, _dense(nodes, threshold)
        bare = {n for n in nodes if n not in taken and n.tag not in INLINE and n.tag not in HEADINGS and _bare_density(n, nodes[0]) >= threshold}
    for parent in {n.parent for n in taken} - {None}:
        inside = [p for p in parent.parts if isinstance(p, Node) and not p.drop]
        kinds = {(n.tag, n.kind) for n in inside if n in taken and (n.kind or n.tag == "article")}
        taken.update(n for n in inside if (n.tag in beside or (n.tag, n.kind) in kinds) and n.chars and 2 * n.link_chars < n.chars)
    return taken | _headings(nodes, taken, bare), bare


def _dense(nodes: list[Node], threshold: float) -> set[Node]:
    """Of every block element whose density reaches the threshold, the element of the largest density sum within it."""
    peak: dict[Node, Node] = {}
    holds: set[Node] = set()  # elements with a dense one inside
    taken = set()
    for node in reversed(nodes):
        if node.tag not in INLINE and (node not in peak or node.total >= peak[node].total):
            peak[node] = node
        dense = node.tag not in INLINE and node.tag not in HEADINGS and node.density >= threshold
        if dense and peak[node].density >= threshold and peak[node].tag not in HEADINGS:
            taken.add(peak[node])
        elif dense and node not in holds:
            taken.add(node)
        if (dense or node in holds) and node.parent is not None:
            holds.add(node.parent)
        if node in peak and node.parent is not None and (node.parent not in peak or peak[node].total >= peak[node.parent].total):
            peak[node.parent] = peak[node]
    return taken


def _bare_density(node: Node, body: Node) -> float:
    own = [p for p in node.parts if isinstance(p, str) or (p.tag in INLINE and not p.drop)]
    if not any(isinstance(p, str) and not p.isspace() for p in own):
        return 0.0
    chars = sum(len("".join(p.split())) if isinstance(p, str) else p.chars for p in own)
    inner = [p for p in own if isinstance(p, Node)]
    return _density(chars, sum(p.tags + 1 for p in inner), sum(p.link_chars for p in inner), sum(p.link_tags + (p.tag == "a") for p in inner),
                    body.link_chars / max(1, body.chars))


def _headings(nodes: list[Node], taken: set[Node], bare: set[Node]) -> set[Node]:
    """Headings with nothing but headings between them and the text they head; the last h1 above all text, unless it is a link, in any case."""
    found: set[Node] = set()
    waiting: list[Node] = []
    first: Node | None = None
    done: set[Node] = set()  # elements whose inside is not looked at
    begun = False
    for node in nodes:
        if node.parent in done:
            done.add(node)
        elif node in taken or node in bare:
            found.update(waiting)
            if first is not None and not begun:
                found.add(first)
            waiting, begun = [], True
            if node in taken:
                done.add(node)
        elif node.tag in HEADINGS:
            done.add(node)
            if node.parent in bare:
                found.add(node)
            else:
                waiting.append(node)
            if node.tag == "h1" and node.link_chars < node.chars:
                first = node
        elif any(isinstance(p, str) and not p.isspace() for p in node.parts):
            waiting = []
    return found


def _text(root: Node, taken: set[Node], bare: set[Node]) -> str:
    """Text of the taken elements, and of bare ones outside their block elements, in page order."""
    out: list[str] = []
    todo: list[tuple[str | Node, bool]] = [(root, False)]
    while todo:
        part, inside = todo.pop()
        if isinstance(part, str):
            if inside:
                out.append(part)
        elif not part.drop:
            inside = inside or part in taken
            text = inside or part in bare
            parts = [(p, text if isinstance(p, str) or p.tag in INLINE else inside) for p in reversed(part.parts)]
            todo += parts if part.tag in INLINE else [(" ", True), *parts, (" ", True)]
    return " ".join("".join(out).split())


def extract(html: str | None) -> str:
    """The main text; empty for null, empty or text-free pages."""
    if not html:
        return ""
    tail = html.rfind(">") + 1
    unfinished = _OPENING.search(html, tail)  # a tag that the page breaks off in
    tree = Tree()
    tree.feed(html[:unfinished.start()] if unfinished else html)
    tree.close()
    nodes = _in_order(tree.root)
    _measure(nodes)
    if _confirm(nodes):
        nodes = _in_order(tree.root)
        _measure(nodes)
    return _text(tree.root, *_blocks(nodes))


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row, repeated rows included; null ids and urls stay null."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [extract(h) for h in part.column(2).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                      names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return in_batches(rows, run, "page_id bigint, url string, text string, n_chars bigint")
