"""Operator 6: main text of HTML pages by tree scoring.

A page becomes a small tree.  Elements that are never main text (menus,
headers, footers, sidebars, adverts, notices, forms, comments, scripts) are
cut by tag, role or class name.  Words with other uses (search, related,
notice, widget, ...) cut by themselves only elements that do not read as
text; ids count as a whole inside an article or main element, and never on
headings; a name never cuts an element without which the page has next to no
text, so names on the wrapper of a page do no harm; a form stays where it holds the main element or most of the page's
text.  Each paragraph gives points for itself, its commas and its length to
its parent, half to the parent's parent and less to further ancestors; a
container's sum is discounted by its share of link text.  The best container
is widened to the article or main element around it; without one, to the
elements around it, up to the first that has many links.  Further article
elements beside it with text of their own stay, too.  Of these all is kept
but lists of links beside the container.  Blocks inside are joined by a line
break.

Defined results: null or empty html gives an empty text; a page without
paragraphs falls back to all text that is not cut; broken markup is closed
as browsers do for paragraphs, list items and cells; nesting depth is not
limited, for the result or by time; null ids and repeated rows pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# fixed values: element and class names with a role in the page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CUT_TAGS = frozenset("head script style noscript template nav footer aside button select textarea iframe "
                     "object svg canvas dialog menu audio video".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu".split())
CUT_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments commentlist commentform "
    "discussion disqus respond replies "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share "
    "sharing social related recommended widget toolbar pagination pager search".split())
# of these, words that stand in names and headings of text as well
TWO_USES = frozenset("header notice notices alert search share sharing social related recommended widget banner promo "
                     "promotion overlay modal popup menu toolbar pager signup login discussion".split())
# ids that advert servers give
_AD_ID = re.compile(r"(?:^|[-_])(?:google[-_]ads?|gpt[-_]ad|adsense|ad[-_](?:slot|unit|container|wrapper|banner))(?:[-_]|\d|$)")
TEXT_NAMES = frozenset("article post entry story".split())
MAIN_TAGS = frozenset(("article", "main"))
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td "
                   "tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote td dd li".split())
# an element with few links reads as text from so many characters, or with a paragraph or heading in a widget's frame
FEW_LINKS = 0.25
LONG_TEXT = 140
# a start tag closes the open element of these names, up to a border
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"})}
P_BORDER = frozenset(("button", "table", "td", "th", "caption", "object", "html"))
_NAME = re.compile(r"[a-z0-9]+")
# a tag that the end of the page cuts short is no text
_CUT_SHORT = re.compile(r"<[A-Za-z/!?][^<>]*\Z")
# "has-sidebar" says what stands beside an element, not what it is
_BESIDE = re.compile(r"\b(?:no|has|with|without)[-_]+[a-z0-9]+")
# "comments-open" tells the state of a page
_STATE = re.compile(r"\b[a-z0-9]+[-_](?:open|opened|closed|enabled|disabled|active|inactive|on|off)\b")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "kids", "cut", "soft", "weak", "form", "framed", "in_main", "score", "chars", "links",
                 "holds_main", "holds_text", "commas", "open_p")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False):
        self.tag, self.parent, self.kids = tag, parent, []
        # soft: cut by name, unless the main element is inside; weak: the same, unless it reads as text
        self.cut, self.soft, self.weak, self.framed, self.form = cut, False, False, False, False
        self.in_main = parent is not None and (parent.in_main or parent.tag in MAIN_TAGS)
        self.score, self.chars, self.links, self.holds_main, self.holds_text = 0.0, 0, 0, False, False
        self.commas = 0
        # the paragraph that a block closes here
        self.open_p = self if tag == "p" else None if parent is None or tag in P_BORDER else parent.open_p


class TreeBuilder(HTMLParser):
    """The tree of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None)
        # open elements by name: nobody climbs for one that is not open
        self.open: Counter = Counter()

    def _leave(self, node: Node) -> None:
        """Close a node and all that is open in it."""
        at = self.at
        while at is not node:
            self.open[at.tag] -= 1
            at = at.parent
        self.open[node.tag] -= 1
        self.at = node.parent

    def _close(self, names, borders) -> None:
        if not any(self.open[n] for n in names):
            return
        node = self.at
        while node is not self.root and node.tag not in borders:
            if node.tag in names:
                self._leave(node)
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.at.kids.append(" ")
        if tag in VOID:
            if tag == "hr":
                self.at.kids.append(Node(tag, self.at))
            return
        if tag in BLOCKS and self.at.open_p is not None:
            self._leave(self.at.open_p)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        a = {k: v or "" for k, v in attrs}
        hidden = "hidden" in a or a.get("aria-hidden", "").lower() == "true" or \
            "display:none" in a.get("style", "").replace(" ", "").lower()
        node = Node(tag, self.at, tag in CUT_TAGS or hidden)
        if tag not in ("html", "body", *MAIN_TAGS):
            self._judge(node, a.get("class", ""), a.get("id", ""), a.get("role", "").lower())
        self.at.kids.append(node)
        self.at = node
        self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        node = self.at
        while node is not self.root and node.tag != tag:
            if node.tag in ("td", "th", "table") and tag not in ("tr", "table", "body", "html"):
                return  # a stray end tag does not reach out of its cell
            node = node.parent
        if node is not self.root:
            self._leave(node)

    def handle_data(self, data):
        self.at.kids.append(data)

    @staticmethod
    def _judge(node: Node, classes: str, ident: str, role: str) -> None:
        """How the names of an element cut it."""
        node.form = node.tag == "form" or role == "form"
        node.soft = role in CUT_ROLES
        plain = _CAMEL.sub("-", classes).lower()
        plain = _STATE.sub(" ", plain)
        names = set(_NAME.findall(_BESIDE.sub(" ", plain)))
        whole = set(plain.split())
        ident = _CAMEL.sub("-", ident).lower()
        ident = _STATE.sub(" ", ident)
        slug = set(_NAME.findall(_BESIDE.sub(" ", ident))) if node.tag not in HEADINGS else set()
        advert = bool(_AD_ID.search(ident)) and node.tag not in HEADINGS
        if node.tag == "header":
            names.add("header")
            whole.add("header")
        if "header" in names | slug and ((names | slug) & TEXT_NAMES or node.in_main):
            # the article's own header, with its title
            names.discard("header")
            whole.discard("header")
            slug.discard("header")
        if node.in_main:
            slug &= {ident}
        names &= CUT_NAMES
        slug &= CUT_NAMES
        node.framed = names == {"widget"} and "widget" not in whole and not slug
        sure = advert or names - TWO_USES or slug - TWO_USES or names & whole or \
            not node.in_main and (names - {"widget"} or slug & {ident})
        if sure:
            node.soft = True
        elif names or slug:
            node.weak = True


def _nodes(root: Node) -> list[Node]:
    """All elements, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(k for k in reversed(node.kids) if isinstance(k, Node))
    return out


def _blocks(root: Node) -> list[str]:
    """Text blocks below a node in page order, without what is cut."""
    out: list[str] = []
    line: list[str] = []

    def flush():
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()
    stack: list = [root]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            line.append(x)
        elif not x.cut:
            if x.tag in BLOCKS:
                flush()
                stack.append(None)
            stack.extend(reversed(x.kids))
    flush()
    return out


def _reads(node: Node) -> bool:
    """Whether an element with a name of two uses is text: long, or paragraphs in a frame or an article, and with few links."""
    if node.tag == "a" or not node.chars or node.links >= FEW_LINKS * node.chars:
        return False
    return node.chars >= LONG_TEXT or (node.framed or node.in_main) and node.holds_text


def _measure(nodes: list[Node]) -> None:
    """Characters and link characters of every element that is not cut, from the leaves up; weak names cut here."""
    for node in reversed(nodes):
        node.chars = node.links = node.commas = 0
        node.holds_text = False
        if node.cut:
            continue
        for k in node.kids:
            if isinstance(k, str):
                node.chars += len(k.strip())
                node.commas += k.count(",")
            elif not k.cut:
                node.chars += k.chars
                node.commas += k.commas
                node.links += k.chars if k.tag == "a" else k.links
                node.holds_text = node.holds_text or k.holds_text
        if node.chars and (node.tag in PARAGRAPHS or node.tag in HEADINGS):
            node.holds_text = True
        if node.weak and not node.holds_main and not _reads(node):
            node.cut = True


def _spare(nodes: list[Node]) -> None:
    """Lift the names of elements without which next to no text is left: they are the page, whatever they are called.

    An article or main element elsewhere is the page, however short."""
    if nodes[0].holds_main:
        return
    words: dict[int, int] = {}
    for node in reversed(nodes):
        # unlinked text, of what is neither cut nor linked
        words[id(node)] = 0 if node.cut or node.tag == "a" else sum(
            len(k.strip()) if isinstance(k, str) else words[id(k)] for k in node.kids)
    page = words[id(nodes[0])]
    # what all named elements leave
    left = dict(words)
    for node in reversed(nodes):
        if node.soft and not node.holds_main:
            left[id(node)] = 0
        elif not node.cut and node.tag != "a":
            left[id(node)] = sum(len(k.strip()) if isinstance(k, str) else left[id(k)] for k in node.kids)
    rest = left[id(nodes[0])]
    if 2 * rest >= page:
        return
    for node in nodes:
        own = words[id(node)]
        if node.soft and not node.holds_main and 2 * own > page and rest < max(LONG_TEXT, own / 10):
            node.soft = False


def _cut(nodes: list[Node]) -> None:
    """Decide what is cut, and measure the rest."""
    for node in reversed(nodes):
        node.holds_main = node.tag in MAIN_TAGS or any(isinstance(k, Node) and k.holds_main for k in node.kids)
    _spare(nodes)
    for node in nodes:
        node.cut = node.cut or (node.soft and not node.holds_main) or (node.parent is not None and node.parent.cut)
    _measure(nodes)
    page = nodes[0].chars - nodes[0].links
    for node in nodes:
        if node.form and not node.holds_main and 2 * (node.chars - node.links) <= page:
            node.cut = True
        node.cut = node.cut or (node.parent is not None and node.parent.cut)
    if any(node.form and node.cut for node in nodes):
        _measure(nodes)
        for node in nodes:
            node.cut = node.cut or (node.parent is not None and node.parent.cut)


def _without_open_comment(html: str) -> str:
    """The page up to a comment that never ends."""
    at = html.rfind("<!--")
    if at < 0 or html.find("-->", at + 4) >= 0:
        return html
    before = html[:at].lower()
    if any(before.rfind(f"<{t}") > before.rfind(f"</{t}") for t in ("script", "style", "textarea", "title")):
        return html
    return html[:at]


def extract(html: str) -> str:
    """The main text of one page."""
    builder = TreeBuilder()
    builder.feed(_CUT_SHORT.sub("", _without_open_comment(html)))
    builder.close()
    nodes = _nodes(builder.root)
    _cut(nodes)
    for node in nodes:
        if node.cut or not node.chars:
            continue
        loose = node.tag not in PARAGRAPHS and any(isinstance(k, str) and k.strip() for k in node.kids)
        if node.tag not in PARAGRAPHS and not (loose and node.tag in BLOCKS and node.tag not in HEADINGS):
            continue
        if loose:
            own = "".join(k if isinstance(k, str) else " " for k in node.kids)
            size, commas = len(own.strip()), own.count(",")
        else:
            size, commas = node.chars, node.commas
        points = (1 + commas + min(size / 100, 30)) * (1 - node.links / node.chars)
        to, share = (node if loose else node.parent), 1.0
        while to is not None and share > 0.01:
            to.score += points * share
            to, share = to.parent, share / 2
    best = max((n for n in nodes if not n.cut and n.chars), default=None,
               key=lambda n: n.score * (1 - n.links / n.chars))
    if best is None:
        return ""
    if best.score <= 0:
        best = builder.root
    node = best
    while node is not None:
        if node.tag in MAIN_TAGS:
            best = node  # the widest article or main element around the best container
        node = node.parent
    if best.parent is None or best.tag in MAIN_TAGS:
        return "\n".join(b for part in _with_siblings(best, nodes) for b in _blocks(part))
    least = max(5.0, 0.2 * best.score)
    top, few = best, True
    while few and top.parent is not None:
        few = top.parent.links < FEW_LINKS * top.parent.chars
        _drop_links(top, least)
        top = top.parent
    return "\n".join(_blocks(top))


def _with_siblings(best: Node, nodes: list[Node]) -> list[Node]:
    """The chosen article with the other articles of the page that have a share of its text and few links, in order."""
    if best.tag != "article":
        return [best]
    least = (best.chars - best.links) / 4
    out = []
    for node in nodes:
        if node is best or (node.tag == "article" and not node.cut and not node.in_main
                            and node.chars - node.links >= least and node.links < FEW_LINKS * node.chars):
            out.append(node)
    return out


def _drop_links(node: Node, least: float) -> None:
    """Drop lists of links beside a node: low-scoring blocks and runs of text and inline elements with many links."""
    kids: list = []
    run: list = []

    def close():
        chars = sum(len(k.strip()) if isinstance(k, str) else k.chars for k in run)
        links = sum(k.chars if k.tag == "a" else k.links for k in run if isinstance(k, Node))
        if links < FEW_LINKS * chars or sum(k.score for k in run if isinstance(k, Node)) >= least:
            kids.extend(run)
        elif run:
            kids.append(Node("hr", node.parent))  # what stands before and after stays apart
        run.clear()
    for k in node.parent.kids:
        if k is node:
            close()
            kids.append(k)
        elif isinstance(k, Node) and k.cut:
            continue
        elif isinstance(k, Node) and k.tag in BLOCKS:
            close()
            run.append(k)
            close()
        else:
            run.append(k)
    close()
    node.parent.kids = kids


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    def run(batches):
        for b in batches:
            # a few pages at a time: the texts of a whole batch need not be held twice
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = [extract(h) if h else "" for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                        F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
