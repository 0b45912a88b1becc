"""Main text of web pages by tag-path ratios.

Every text node has a path from the root to its block: tags with their classes, inline marks left out.  A page's paths
get the characters outside links and the punctuation marks of their blocks per block; along the page the fused ratio
(characters times punctuation) is smoothed with its neighbours, and nodes above a share of the page's mean are content
nodes.  The element that holds nearly all of their weight is the article.  Inside it the ratios select again: a block
below the threshold leaves if its path is told from plain paragraphs by a class or is mostly links; a sub-heading whose
blocks have all left goes with them.  Plain lists, tables and short paragraphs of the article stay whatever their ratio.
Menus, forms, notices and the like are left out by their tags, roles and names before; a named element that holds the
page's ``h1`` or ``main`` stays.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelsift.llm.textkit import slices

THRESHOLD = 0.25  # of the mean smoothed ratio: the nodes whose weight finds the article
WITHIN = 0.6  # of the mean smoothed ratio: blocks of the article told apart by a class or by links
HOLDS = 0.7  # share of the content weight that a child must hold to go down into it
KERNEL = np.array([0.25, 0.5, 0.25])

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)(?![a-zA-Z0-9:-])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|math|iframe|object|select)(?![a-zA-Z0-9:-])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tag>/?[a-zA-Z][a-zA-Z0-9:-]*)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<odd>/?[a-zA-Z][a-zA-Z0-9:-]*)[^<>]*>"  # an unbalanced quote in the attributes
    r"|<[/a-zA-Z][^<>]*\Z",
    re.S | re.I,
)
#: name, value; matches follow each other, so that a name never starts inside another name or a value
_ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_PUNCTUATION = re.compile(r"[.,;:!?¿¡…。、，]")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
_LEAVE = frozenset("nav footer aside form button input label fieldset menu dialog head".split())
_CONTAINER = frozenset("html body div main article section center table tbody tr td".split())
_TEXTUAL = frozenset("pre blockquote figure figcaption table caption thead tbody tfoot tr td th".split())  # parts of an article whatever their class
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MOST_LINKS = 0.5  # share of a path's characters that lie in links
#: words of class names and ids that mark what is not the article, alone or with the words of place below
_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer comment comments commentlist disqus reply replies respond opinions related recommended recommendations share sharing social newsletter subscribe subscription signup login widget widgets pagination pager toolbar copyright skip".split())
_PLACE = frozenset("area bar block box btn button container content field form group holder inner item items left link links list main outer page panel post posts right row section site slot text title top unit user users wrap wrapper".split())
_OUTER = frozenset("header masthead topbar top".split())  # only outside an article
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())


class Node:
    __slots__ = ("tag", "parent", "skip", "article", "weight", "children", "path", "named", "holds", "link", "classed")

    def __init__(self, tag: str, parent: Node | None, skip: bool, article: bool, path: int = 0, classed: bool = False, named: bool = False):
        self.tag, self.parent, self.skip, self.article, self.path, self.classed = tag, parent, skip, article, path, classed
        self.weight, self.children, self.holds = 0.0, [], False
        self.named = self if named else parent.named if parent else None  # nearest element left out by its name
        self.link = tag == "a" or parent is not None and parent.link
        if parent is not None:
            parent.children.append(self)

    def left(self) -> bool:
        at = self.named
        while at is not None:
            if not at.holds:
                return True
            at = at.parent.named
        return False


def _named(words: str, outer: bool) -> bool:
    """Whether a class or id says what is not the article: all its words are names or words of place, one a name."""
    pieces = [w for w in re.split(r"[^a-z]+", words) if w]
    names = _NAMES | _OUTER if outer else _NAMES
    return any(w in names for w in pieces) and all(w in names or w in _PLACE for w in pieces)


def _judged(tag: str, attr: str, parent: Node) -> tuple[bool, bool, str]:
    """(left out by tag, role or hiding, left out by name, class) of an element."""
    if tag in _LEAVE or tag == "header" and not parent.article:
        return True, False, ""
    named, kind = False, ""
    if not attr:
        return False, named, kind
    whole = tag in ("html", "body", "main") or tag == "article" and not parent.article
    for key, value in _ATTR.findall(attr):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "class":
            kind = kind or " ".join(value.split())
            named = named or not whole and any(_named(t, not parent.article) for t in value.split())
        elif key == "id":
            named = named or not whole and tag != "p" and tag not in _HEADINGS and _named(value, not parent.article)
        elif key == "role" and value in _ROLES or key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True, False, kind
    return False, named, kind


def parse(page: str) -> list[tuple[Node, str, int]]:
    """(node, decoded text, block number) of the text nodes outside what is left out."""
    root = Node("", None, False, False)
    stack, out, block, at = [root], [], 0, 0
    paths: dict[tuple[int, str, str], int] = {}

    def text(upto: int) -> None:
        if upto > at and not stack[-1].skip:
            t = html.unescape(page[at:upto])
            out.append((stack[-1], t, block))

    def close(tag: str, until: frozenset = frozenset()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                del stack[i:]
                return
            if stack[i].tag in until:
                return

    for m in _MARKUP.finditer(page):
        text(m.start())
        at = m.end()
        tag = (m["tag"] or m["odd"] or "").lower()
        if not tag:
            continue
        if tag[0] == "/":
            tag = tag[1:]
            block += tag in _BLOCK
            close(tag)
            continue
        if tag == "br":
            if not stack[-1].skip:
                out.append((stack[-1], " ", block))
            continue
        if tag in _BLOCK:
            block += 1
            close("p", frozenset(("table", "td", "th", "button")))
            if tag in ("li", "dt", "dd", "tr", "td", "th"):
                for same in {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}[tag]:
                    close(same, frozenset(("ul", "ol", "dl", "table")))
        if tag in _VOID or m["attr"] and m["attr"].endswith("/") and tag not in _BLOCK:
            continue
        top = stack[-1]
        skip, named, kind = (True, False, "") if top.skip else _judged(tag, m["attr"] or "", top)
        inline = tag not in _BLOCK
        path = top.path if inline else paths.setdefault((top.path, tag, kind), len(paths) + 1)
        article = tag in ("article", "main")
        # a class tells a block from the plain ones of its article; wrappers around the article do not count
        classed = not article and (top.classed or not inline and bool(kind) and tag not in _HEADINGS | _TEXTUAL)
        stack.append(Node(tag, top, skip, top.article or article, path, classed, named))
        if tag in ("h1", "main") and not skip:
            up = stack[-1].named
            while up is not None and not up.holds:
                up.holds, up = True, up.parent.named
    text(len(page))
    return [x for x in out if not x[0].left()]


def content_nodes(nodes: list[tuple[Node, str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, smoothed ratio as a share of its mean, on a path of mostly links) of each text node."""
    chars = np.array([len(t.strip()) for _, t, _ in nodes], float)
    if not chars.any():
        return chars, chars, chars > 0
    marks = np.array([len(_PUNCTUATION.findall(t)) for _, t, _ in nodes], float)
    linked = np.array([n.link for n, _, _ in nodes])
    path = np.unique(np.array([n.path for n, _, _ in nodes]), return_inverse=True)[1]
    full = chars > 0
    # per block of the path: a block's inline pieces count as one
    seen = np.unique(np.stack([path[full], np.array([b for _, _, b in nodes])[full]]), axis=1)[0]
    count = np.maximum(np.bincount(seen, minlength=path.max() + 1), 1)
    plain, total = np.bincount(path, np.where(linked, 0, chars)), np.bincount(path, chars)
    ratio = plain / count * (1 + np.bincount(path, marks) / count)
    smooth = np.convolve(np.pad(ratio[path], 1, mode="edge"), KERNEL, "valid")
    return chars, smooth / max(smooth[full].mean(), 1e-9), (plain < (1 - MOST_LINKS) * total)[path]


def _article(nodes: list[tuple[Node, str, int]], weight: np.ndarray) -> Node | None:
    """The element that holds the content: down from the root while one child has most of the weight."""
    root = None
    for (n, _, _), w in zip(nodes, weight, strict=True):
        while n is not None:
            n.weight += w
            root, n = n, n.parent
    at = root
    while at is not None and at.tag not in ("article", "main"):
        down = next((c for c in at.children if c.tag in _CONTAINER and c.weight >= HOLDS * at.weight > 0), None)
        if down is None:
            break
        at = down
    if at is not None and at.tag == "main":  # an article inside it, if that is nearly all
        inner = next((c for c in at.children if c.tag == "article" and c.weight >= HOLDS * at.weight > 0), None)
        at = inner or at
    return at


def _kept(blocks: list[tuple[str, bool, str]]) -> Iterator[str]:
    """Texts of the (heading tag, selected, text) blocks that stay; a sub-heading leaves with the blocks under it."""
    for i, (head, keep, text) in enumerate(blocks):
        if head and head != "h1":
            under = []
            for other, kept, _ in blocks[i + 1 :]:
                if other:
                    break
                under.append(kept)
                if kept:
                    break
            keep = not under or any(under)
        if head == "h1" or keep:
            yield text


def main_text(page: str | None) -> str:
    """The article's blocks, white space folded, joined by an empty line; empty for null, empty or textless pages."""
    nodes = parse(page or "")
    chars, ratio, links = content_nodes(nodes)
    top = _article(nodes, np.where(ratio >= THRESHOLD, chars, 0.0))
    inside: dict[int, bool] = {}
    texts: dict[int, list[str]] = {}
    heading: dict[int, str] = {}
    chosen: dict[int, bool] = {}
    for (n, t, b), is_content, is_links in zip(nodes, ratio >= WITHIN, links, strict=True):
        if id(n) not in inside:
            at = n
            while at is not None and at is not top:
                if at.tag in _HEADINGS:
                    heading.setdefault(b, at.tag)
                at = at.parent
            inside[id(n)] = at is not None
        if inside[id(n)]:
            texts.setdefault(b, []).append(t)
            # a block stays if any text of it is selected; blank pieces decide nothing
            if t.strip():
                chosen[b] = chosen.get(b, False) or bool(is_content) or not is_links and not (n.classed and top.classed < n.classed)
    blocks = [(heading.get(b, ""), chosen.get(b, True), " ".join("".join(t).split())) for b, t in texts.items()]
    return "\n\n".join(t for t in _kept([x for x in blocks if x[2]]) if t)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "html"):
        text = [main_text(p) for p in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html); other columns are ignored.

    Null or empty html gives an empty text; repeated rows give a row each; an empty table gives no rows.  A page is read
    whole and alone, so the work is one map without a shuffle.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_run, "page_id long, url string, text string, n_chars long")
