"""Main text of web pages by composite text density.

Each page is parsed in its task into a small tree.  Parts that by tag or role aren't the article (menus, scripts and the
like) are cut, and so are reader comments.  Forms and parts with a class or id that is nothing but a name of such a part
are cut too, unless they hold half of the page's text, mostly not of links, and no other part could be the article.  A
part whose class or id merely has such a name among other words is cut unless it holds a main heading or half of the
page's text.  Posts of readers are also known by their form: siblings alike, each with its author, after other text.
Every node left gets a composite density, its characters per tag adjusted for
links, and the sum of its children's densities.  The node with the largest sum is the article's body; the smallest
density on its path to the page's body is the threshold at which parts beside that path belong to the article too; so do
headings beside it inside an article element.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed sets of HTML element names.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
CUT = frozenset("head script style noscript template title nav footer aside button select option input textarea label iframe svg canvas object embed audio video dialog menu map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())
HEADINGS = TITLES | {"p"}
SCOPE = frozenset("html body article section main div table td th ul ol dl blockquote".split())
#: Fixed names that mark parts which aren't the article, compared with the words of class and id.
NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer sidebar sidenav aside rail ad ads adbox adslot advert adverts advertisement advertising "
    "sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments disqus reply replies respond pagination pager toolbar widget search".split()
)
#: Fixed names of reader comments, which may be longer than the article.
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
ROLES = frozenset("navigation banner contentinfo complementary dialog alertdialog alert menu menubar toolbar".split())
#: Fixed roles that a whole page may be wrapped in.
WRAPPERS = frozenset("form search".split())
#: Fixed names of the author of a post.
AUTHORS = frozenset("author user username avatar commenter nickname poster".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^>\"'<]|\"(?:[^\"<]|<(?![a-zA-Z/!?]))*+\"|'(?:[^'<]|<(?![a-zA-Z/!?]))*+'|[\"'])*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Tree:
    """Nodes in page order; node 0 is the root.  parts holds texts and child numbers in order."""

    tag: list[str] = field(default_factory=lambda: ["#root"])
    parent: list[int] = field(default_factory=lambda: [-1])
    #: Cut for certain, cut unless nothing else can be the article, and cut unless it holds what the article would.
    cut: list[bool] = field(default_factory=lambda: [False])
    wrapper: list[bool] = field(default_factory=lambda: [False])
    doubtful: list[bool] = field(default_factory=lambda: [False])
    #: The class as it stands, and whether class or rel name an author.
    form: list[str] = field(default_factory=lambda: [""])
    author: list[bool] = field(default_factory=lambda: [False])
    #: Inside an article or main element.
    inside: list[bool] = field(default_factory=lambda: [False])
    parts: list[list] = field(default_factory=lambda: [[]])

    def add(self, tag: str, parent: int, verdict: int) -> int:
        n = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.cut.append(verdict == CERTAIN)
        self.wrapper.append(verdict == WRAPPER)
        self.doubtful.append(verdict == DOUBTFUL)
        self.form.append("")
        self.author.append(tag == "cite")
        self.inside.append(self.inside[parent] or tag in ("article", "main"))
        self.parts.append([])
        self.parts[parent].append(n)
        return n


KEEP, DOUBTFUL, WRAPPER, CERTAIN = 0, 1, 2, 3


def unwanted(tag: str, found: dict[str, str], inside: bool) -> int:
    """Whether an element isn't part of the article; ``inside`` an article or main element a header is."""
    if tag in CUT or (tag == "header" and not inside):
        return CERTAIN
    if not found:
        return WRAPPER if tag == "form" else KEEP
    role = found.get("role", "").lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")) or role in ROLES:
        return KEEP if tag in ("html", "body") else CERTAIN
    # The id of a heading is an anchor made of its words.
    names = ("class",) if tag in TITLES else ("class", "id")
    tokens = [{w.lower() for w in _NAME_WORDS.findall(t)} for k in names for t in found.get(k, "").split()]
    if tag in ("html", "body", "main", "article"):
        return CERTAIN if tag == "article" and any(t and t <= COMMENTS for t in tokens) else KEEP
    if any(t & COMMENTS and len(t) <= 2 for t in tokens):
        return CERTAIN
    if tag == "form" or role in WRAPPERS:
        return WRAPPER
    if inside and any(t == {"header"} for t in tokens):
        return DOUBTFUL
    if tag not in HEADINGS and any(t and t <= NAMES for t in tokens):
        return WRAPPER
    return DOUBTFUL if any(t & NAMES for t in tokens) else KEEP


def parse(page: str) -> Tree:
    """A tree of the page; closing tags that nothing opened are ignored, missing ones supplied."""
    tree, here, at, n = Tree(), 0, 0, len(page)
    opened: dict[str, int] = {}

    def text(piece: str) -> None:
        if piece:
            tree.parts[here].append(html.unescape(piece) if "&" in piece else piece)

    def close(names: set[str], scope: frozenset[str]) -> int:
        """The parent of the nearest open element of these names, not looking beyond the scope; here if there is none."""
        if not any(opened.get(x) for x in names):
            return here
        k, passed = here, []
        while k:
            passed.append(tree.tag[k])
            if tree.tag[k] in names:
                for x in passed:
                    opened[x] -= 1
                return tree.parent[k]
            if tree.tag[k] in scope:
                return here
            k = tree.parent[k]
        return here

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            last = rest.rfind("<")
            broken = last >= 0 and re.fullmatch(r"<(?:/?[a-zA-Z][^<>]*)?", rest[last:])  # a tag that the page's end cuts off
            text(rest[:last] if broken else rest)
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            here = close({tag}, frozenset() if tag in SCOPE else SCOPE)
            continue
        if tag in CLOSES_P:
            here = close({"p"}, SCOPE)
        if tag in SIBLINGS:
            here = close(SIBLINGS[tag], frozenset({"ul", "ol", "dl", "table", "select"}))
        found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(m[3])} if m[3].strip() else {}
        new = tree.add(tag, here, unwanted(tag, found, tree.inside[here]))
        if found:
            tree.form[new] = found.get("class", "")
            tree.author[new] |= not AUTHORS.isdisjoint(w.lower() for k in ("class", "rel") for w in _NAME_WORDS.findall(found.get(k, "")))
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            here = new
            opened[tag] = opened.get(tag, 0) + 1
    return tree


def settle(tree: Tree) -> None:
    """Cut what only looks like the article and what is doubtful.

    A wrapper stays if it holds half of the text that isn't cut for certain, less than a third of it in links, and there
    is no main heading, article or main element beside it; inside an article the last doesn't matter.  What is doubtful
    stays with a main heading or half of the text.  Posts of readers go.
    """
    size = len(tree.tag)
    for i in range(1, size):
        tree.cut[i] |= tree.cut[tree.parent[i]]
    chars, links, heading, marks, author = [0] * size, [0] * size, [False] * size, [0] * size, list(tree.author)
    for i in range(size - 1, -1, -1):
        if tree.cut[i]:
            continue
        chars[i] += sum(len("".join(p.split())) for p in tree.parts[i] if isinstance(p, str))
        if tree.tag[i] == "a":
            links[i] = chars[i]
        heading[i] |= tree.tag[i] == "h1"
        marks[i] += tree.tag[i] in ("h1", "article", "main") and chars[i] > 0
        if i:
            p = tree.parent[i]
            author[p] |= author[i]
            chars[p] += chars[i]
            links[p] += links[i]
            heading[p] |= heading[i]
            marks[p] += marks[i]
    above = [0] * size  # article and main elements around a node
    before = 0  # text that stays before a node, in page order
    for i in range(1, size):
        p = tree.parent[i]
        above[i] = above[p] + (tree.tag[p] in ("article", "main"))
        large = 2 * chars[i] >= chars[0] > 0
        alone = tree.inside[p] or marks[0] == marks[i] + above[i]
        tree.cut[i] |= tree.cut[p] or (tree.wrapper[i] and not (large and alone and 3 * links[i] < chars[i])) or (tree.doubtful[i] and not heading[i] and not large)
        if not tree.cut[i]:
            if before and not heading[i] and posts(tree, i, chars, author):
                tree.cut[i] = True
            else:
                before += sum(len(x.strip()) for x in tree.parts[i] if isinstance(x, str))


def posts(tree: Tree, i: int, chars: list[int], author: list[bool]) -> bool:
    """Whether a node's text is nearly all in two or more children alike, each with an author and other text."""
    if tree.tag[i] in INLINE:
        return False
    alike: dict[tuple[str, str], list[int]] = {}
    for c in tree.parts[i]:
        if not isinstance(c, str) and chars[c] and author[c] and tree.tag[c] not in INLINE and not tree.author[c]:
            alike.setdefault((tree.tag[c], tree.form[c]), []).append(c)
    return any(len(found) > 1 and 5 * sum(chars[c] for c in found) >= 4 * chars[i] for found in alike.values())


def selected(tree: Tree) -> list[int]:
    """The nodes whose subtrees are the article, in page order."""
    settle(tree)
    size = len(tree.tag)
    chars, tags, link_chars, links = [0] * size, [0] * size, [0] * size, [0] * size
    for i in range(size - 1, -1, -1):
        if tree.cut[i]:
            continue
        chars[i] += sum(len("".join(p.split())) for p in tree.parts[i] if isinstance(p, str))
        if tree.tag[i] == "a":
            link_chars[i], links[i] = chars[i], links[i] + 1
        if (p := tree.parent[i]) >= 0:
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            links[p] += links[i]
    body = next((i for i in range(size) if tree.tag[i] == "body" and not tree.cut[i]), 0)
    page_ratio = link_chars[body] / max(1, chars[body])

    def density(i: int) -> float:
        c, t, lc, lt = chars[i], max(1, tags[i]), link_chars[i], max(1, links[i])
        if not c:
            return 0.0
        base = math.log(c * lc / max(1, c - lc) + page_ratio * c + math.e)
        return c / t * math.log(max(1.0, c / max(1, lc) * t / lt) + 1) / math.log(base + 1)

    own = [0.0 if tree.cut[i] else density(i) for i in range(size)]
    total = [0.0] * size
    for i in range(size - 1, 0, -1):
        total[tree.parent[i]] += own[i]
    inside = [i for i in range(size) if not tree.cut[i] and chars[i] and tree.tag[i] not in INLINE and (i >= body)]
    if not inside:
        return []
    best = max(inside, key=lambda i: (total[i] or own[i] * 1e-9, -i))
    while tree.tag[best] in ("p", "h1", "h2", "h3", "li", "ul", "ol", "blockquote", "pre") and best != body and tree.parent[best] > 0:
        best = tree.parent[best]  # a paragraph is part of what holds it
    path, k = [], best
    while k > 0:
        path.append(k)
        if k == body:
            break
        k = tree.parent[k]
    threshold = min(own[i] for i in path) if path else 0.0
    chosen = {best}
    for child, above in zip(path, path[1:], strict=False):
        for p in tree.parts[above]:
            if not isinstance(p, str) and p != child and not tree.cut[p] and ((tree.inside[p] and tree.tag[p] in TITLES) or own[p] >= threshold > 0) and 3 * link_chars[p] < chars[p]:
                chosen.add(p)
    return sorted(chosen)


def main_text(page: str) -> str:
    """The article's blocks, each with single spaces, one a line."""
    tree = parse(page)
    blocks: list[list[str]] = [[]]
    for root in selected(tree):
        blocks.append([])
        stack: list[tuple[int, int]] = [(root, 0)]
        while stack:
            i, k = stack.pop()
            if k == 0 and tree.tag[i] not in INLINE:
                blocks.append([])
            if k < len(tree.parts[i]):
                stack.append((i, k + 1))
                part = tree.parts[i][k]
                if isinstance(part, str):
                    blocks[-1].append(part)
                elif not tree.cut[part]:
                    stack.append((part, 0))
            elif tree.tag[i] not in INLINE:
                blocks.append([])
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, *, page: str = "html", into: str = "text") -> DataFrame:
    """Every row of pages with the main text of its HTML in ``into`` and its code points in n_chars.

    A null page counts as empty; an empty page, or one without text in its body, has an empty text.  Quotes that nothing
    closes end with their tag.  Whole pages are
    parsed; text is a function of the page, so repeated rows get equal texts.  The page's column is dropped; columns
    named as the added ones are replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(page)
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [main_text(x.as_py() or "") for x in part.column(at)]
                rest = [i for i in range(batch.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in rest), pa.array(texts, pa.string())], names=[*(batch.schema.names[i] for i in rest), into])

    kept = pages.select(*[c for c in pages.columns if c not in (into, "n_chars") or c == page])
    schema = kept.drop(page).withColumn(into, F.lit("")).schema
    return kept.mapInArrow(run, schema).withColumn("n_chars", F.length(into).cast("long"))
