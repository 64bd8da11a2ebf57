"""Main text of web pages from flat text blocks, classified by a decision tree.

A page is read into blocks: text between block-level tags, with its number of words, link density, whether it is a
heading, whether it stands in the page's article, and whether a part around it is named as something else (a menu, an
advert, ...). A class, id or role names a part unless it says that something is there or not (has-sidebar, no-comments). A
form, or a part that a class, id or role names, is not taken by its name if it holds more than half of the page's words and
an article, main part or first heading: then it is a wrapper of the page. Start tags of head are passed over, as its end tag
may be left out. Text in inline elements is always text of its block, whatever they are named.

A block's neighbours' words and link density are features too. The tree is trained on the small labelled table below when the
operator is set up. Beside the names, the neighbours decide: a row of linked blocks in an article is a list of links, a linked
line between paragraphs is text.

Null and empty html have no text. Pages are taken one by one, so repeated rows and ties give equal results; a very long page
needs memory for itself alone. Empty tables give empty results.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from metaloom.llm.common import pick

_TAG = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)
      |(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
      |(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>
      |[!?/][^>]*>)""", re.DOTALL | re.VERBOSE)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split())
#: Their content is not text of the page. What has no end tag: RAW goes on to the end of the page; SKIPPED, being no text of
#: the page, up to the next of ENDING or the end of the element around it.
RAW = frozenset("script style title textarea".split())
SKIPPED = frozenset("template svg math iframe object select noscript".split())
ENDING = frozenset(
    "address article aside blockquote body center dd details div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main"
    " nav ol p pre section table ul".split())
#: Elements, and words in class, id and role, that name what is not the main text; SAYING before such a word takes it back.
NOT_MAIN = frozenset("nav aside footer header form button dialog menu fieldset".split())
WRAPPERS = frozenset("form fieldset".split())
SAYING = frozenset("has have no not non with without hide hides disable disabled enable enabled".split())
NAMED = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header banner masthead footer foot copyright contentinfo sidebar"
    " side aside complementary related recommended recommendations widget rail ad ads adv advert adverts advertisement"
    " sponsor sponsored sponsors promo promotion teaser cookie cookies consent gdpr notice notices notification alert"
    " popup modal overlay dialog newsletter subscribe subscription signup login form search share sharing social comment"
    " comments respond replies reply disqus pagination pager toolbar skip".split())
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Part:
    """An element that is named, with the number of words in it, and whether it may be a wrapper of the page."""
    __slots__ = ("around", "loose", "words", "leads")

    def __init__(self, around: "Part | None", loose: bool):
        self.around, self.loose, self.words, self.leads = around, loose, 0, False


class Block:
    __slots__ = ("text", "words", "linked", "heading", "inside", "named")

    def __init__(self, text: str, words: int, linked: int, heading: bool, inside: bool, named: bool):
        self.text, self.words, self.linked, self.heading, self.inside, self.named = text, words, linked, heading, inside, named


def _is_named(name: str, attributes: str) -> bool:
    if name in NOT_MAIN:
        return True
    if not attributes or name in ("html", "head", "body"):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role", "aria-label"):
            for one in value.split():
                words = [t.lower() for t in _TOKENS.findall(one)]
                if not NAMED.isdisjoint(words) and SAYING.isdisjoint(words[:-1]):
                    return True
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _ends(page: str, name: str) -> dict[int, int]:
    """Where the elements of a name end, by the place after their start tag; those without an end tag are left out."""
    found, begun = {}, []
    rest = r"""(?:(?:[^>"']++|"[^"]*"|'[^']*')*+>|[^>]*>)"""
    for tag in re.compile(rf"<(/?){name}(?=[\s/>]){rest}", re.IGNORECASE).finditer(page):
        if not tag[1]:
            if tag[0][-2] != "/":
                begun.append(tag.end())
        elif begun:
            found[begun.pop()] = tag.start()
    return found


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    found: list[Block] = []
    stack: list[tuple[str, Part | None, bool, bool]] = [("", None, False, False)]  # name, named part around, inside, heading
    parts: list[str] = []
    words = linked = links = at = 0
    heading = unclosed = False
    named_parts: list[Part] = []
    ends: dict[str, dict[int, int]] = {}

    def close() -> None:
        nonlocal words, linked, heading
        if parts and (text := " ".join("".join(parts).split())):
            _, named, inside, _ = stack[-1]
            found.append(Block(text, text.count(" ") + 1, linked, heading, inside, named))
            if named is not None:
                named.words += found[-1].words
        parts.clear()
        linked, heading = 0, False

    def add(text: str) -> None:
        nonlocal linked, heading
        if text:
            text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(text.split())
            heading = heading or stack[-1][3]

    n = len(page)
    while at < n:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        if tag["end"] or tag["end2"]:
            if name not in INLINE:
                close()
            elif name == "a":
                links = max(0, links - 1)
            if name not in INLINE and any(e[0] == name for e in stack):
                while stack.pop()[0] != name:
                    pass
            continue
        rest = tag["rest"] if tag["name"] else tag["rest2"]
        if name in RAW and not rest.endswith("/"):
            close()
            end = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(page, at)
            at = end.start() if end else n
            continue
        if name in SKIPPED and not rest.endswith("/"):
            close()
            if name not in ends:
                ends[name] = _ends(page, name)
            if at in ends[name]:
                at = ends[name][at]
            else:
                _, _, inside, head = stack[-1]
                named_parts.append(Part(stack[-1][1], False))
                stack.append((name, named_parts[-1], inside, head))
                unclosed = True
            continue
        if unclosed and name in ENDING and (open_ := next((i for i, e in enumerate(stack) if e[0] in SKIPPED), 0)):
            close()
            del stack[open_:]
            unclosed = False
        if name == "br":
            parts.append(" ")
        elif name in INLINE:
            links += name == "a"
        else:
            close()
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or name in HEADINGS:
                if stack[-1][0] in ("p", name) or stack[-1][0] in HEADINGS:
                    stack.pop()
            if name not in VOID and not rest.endswith("/"):
                _, named, inside, head = stack[-1]
                main = name in MAIN or 'role="main"' in rest
                own = _is_named(name, rest)
                if name == "header" and inside and not named:
                    own = False  # an article's own head
                if own:
                    named_parts.append(named := Part(named, name in WRAPPERS or name not in NOT_MAIN))
                elif (main or name == "h1") and named is not None and named.loose:
                    named.leads = True
                stack.append((name, named, inside or main, head or name in HEADINGS))
            links = 0
    close()
    return _unwrapped(found, named_parts)


def _unwrapped(found: list[Block], parts: list[Part]) -> list[Block]:
    """Blocks with ``named`` as yes or no: parts that are wrappers of the page name nothing. Parts come before those in them."""
    for p in reversed(parts):
        if p.around is not None:
            p.around.words += p.words
            p.around.leads = p.around.leads or p.leads and p.loose
    total = sum(b.words for b in found)
    names = {None: False}
    for p in parts:
        names[p] = names[p.around] or not (p.loose and p.leads and 2 * p.words > total)
    for b in found:
        b.named = names[b.named]
    return found


FEATURES = ("words", "link density", "words before", "link density before", "words after", "link density after",
            "heading", "inside", "page has an article", "named")


def features(found: list[Block]) -> np.ndarray:
    rows = np.zeros((len(found) + 2, 2))
    rows[1:-1] = [(b.words, b.linked / b.words) for b in found] if found else np.zeros((0, 2))
    own = np.array([(b.heading, b.inside, False, b.named) for b in found], float).reshape(-1, 4)
    own[:, 2] = any(b.inside for b in found)
    return np.hstack([rows[1:-1], rows[:-2], rows[2:], own])


#: Labelled pages; a block is (main text, words, linked words, heading, inside, named).
LABELLED = [
    # An article with a menu, an advert and a footer.
    [(0, 1, 1, 0, 0, 1), (0, 1, 1, 0, 0, 1), (0, 2, 2, 0, 0, 1), (0, 9, 0, 0, 0, 1), (1, 8, 0, 1, 1, 0), (1, 64, 0, 0, 1, 0),
     (1, 3, 0, 0, 1, 0), (1, 120, 4, 0, 1, 0), (1, 1, 0, 0, 1, 0), (0, 14, 0, 0, 0, 1)],
    # An article of one short paragraph between long boilerplate.
    [(0, 4, 4, 0, 0, 1), (0, 60, 0, 0, 0, 1), (1, 3, 0, 1, 1, 0), (1, 2, 0, 0, 1, 0), (0, 45, 0, 0, 0, 1), (0, 80, 2, 0, 0, 1)],
    # An article with a list, a sidebar, a form and readers' comments inside.
    [(0, 2, 2, 0, 0, 1), (1, 5, 0, 1, 1, 0), (1, 30, 0, 0, 1, 0), (1, 4, 0, 0, 1, 0), (1, 6, 1, 0, 1, 0), (1, 2, 0, 0, 1, 0),
     (0, 25, 3, 0, 1, 1), (0, 3, 0, 0, 1, 1), (1, 48, 0, 0, 1, 0), (0, 2, 0, 1, 1, 1), (0, 33, 0, 0, 1, 1), (0, 70, 0, 0, 1, 1)],
    # An article with an unnamed list of links, and one linked line that is text.
    [(1, 40, 0, 0, 1, 0), (1, 6, 6, 0, 1, 0), (1, 52, 0, 0, 1, 0), (1, 35, 30, 0, 1, 0), (1, 28, 0, 0, 1, 0)],
    # Lists of links in an article, which nothing names.
    [(0, 2, 2, 0, 0, 1), (1, 5, 0, 1, 1, 0), (1, 44, 2, 0, 1, 0), (1, 61, 0, 0, 1, 0), (0, 6, 6, 0, 1, 0), (0, 5, 5, 0, 1, 0), (0, 7, 7, 0, 1, 0), (0, 4, 4, 0, 1, 0)],
    [(0, 4, 4, 0, 1, 0), (0, 5, 5, 0, 1, 0), (0, 3, 3, 0, 1, 0), (1, 38, 1, 0, 1, 0), (1, 57, 0, 0, 1, 0), (0, 8, 0, 0, 0, 1)],
    # Much linked text, in an article and in what stands beside and inside it.
    [(0, 8, 1, 0, 0, 1), (0, 30, 4, 0, 0, 1), (1, 9, 1, 1, 1, 0), (1, 10, 2, 0, 1, 0), (1, 60, 7, 0, 1, 0), (1, 20, 5, 0, 1, 0),
     (1, 8, 4, 0, 1, 0), (1, 12, 3, 0, 1, 0), (1, 5, 5, 0, 1, 0), (0, 30, 2, 0, 1, 1), (0, 25, 5, 0, 1, 1), (0, 12, 6, 0, 1, 1),
     (1, 33, 2, 0, 1, 0), (1, 7, 2, 0, 1, 0), (0, 40, 12, 0, 0, 1), (0, 9, 1, 1, 0, 1), (0, 18, 2, 0, 0, 0), (0, 7, 1, 0, 0, 0)],
    [(0, 55, 6, 0, 0, 1), (1, 24, 24, 0, 1, 0), (1, 3, 0, 0, 1, 0), (1, 16, 2, 0, 1, 0), (0, 3, 0, 0, 1, 1), (1, 2, 0, 0, 1, 0), (0, 2, 0, 0, 0, 1)],
    # Articles that end the page.
    [(0, 2, 2, 0, 0, 1), (1, 4, 0, 1, 1, 0), (1, 33, 0, 0, 1, 0), (1, 3, 0, 0, 1, 0)],
    [(1, 6, 0, 1, 1, 0), (1, 45, 0, 0, 1, 0), (1, 90, 1, 0, 1, 0)],
    [(0, 12, 0, 0, 0, 0), (1, 5, 0, 1, 1, 0), (1, 14, 0, 0, 1, 0)],
    [(1, 1, 0, 0, 1, 0)], [(1, 220, 0, 0, 1, 0)], [(0, 3, 3, 0, 0, 1), (1, 70, 0, 0, 1, 0)],
    # A main element with nothing named, and text outside it.
    [(0, 1, 1, 0, 0, 0), (0, 1, 1, 0, 0, 0), (0, 22, 0, 0, 0, 0), (1, 4, 0, 1, 1, 0), (1, 18, 0, 0, 1, 0), (1, 90, 2, 0, 1, 0),
     (0, 16, 0, 0, 0, 0), (0, 40, 0, 0, 0, 0), (0, 8, 2, 0, 0, 0), (0, 65, 0, 0, 0, 0)],
    # No article element: menus and footers unnamed.
    [(0, 1, 1, 0, 0, 0), (0, 1, 1, 0, 0, 0), (0, 2, 2, 0, 0, 0), (0, 1, 1, 0, 0, 0), (1, 7, 0, 1, 0, 0), (1, 55, 1, 0, 0, 0),
     (1, 80, 0, 0, 0, 0), (1, 6, 0, 0, 0, 0), (1, 47, 3, 0, 0, 0), (0, 6, 2, 0, 0, 0), (0, 2, 2, 0, 0, 0), (0, 5, 0, 0, 0, 0)],
    [(0, 3, 3, 0, 0, 0), (0, 2, 2, 0, 0, 0), (0, 4, 0, 0, 0, 0), (0, 2, 2, 0, 0, 0), (1, 6, 0, 1, 0, 0), (1, 22, 0, 0, 0, 0),
     (1, 16, 0, 0, 0, 0), (1, 30, 0, 0, 0, 0), (0, 12, 10, 0, 0, 0), (0, 20, 18, 0, 0, 0), (0, 3, 3, 0, 0, 0), (0, 4, 0, 0, 0, 0)],
    # No article element, what is not main is named.
    [(0, 2, 2, 0, 0, 1), (0, 35, 0, 0, 0, 1), (1, 5, 0, 1, 0, 0), (1, 12, 0, 0, 0, 0), (1, 41, 0, 0, 0, 0), (1, 14, 0, 0, 0, 0),
     (0, 50, 0, 0, 0, 1), (0, 9, 1, 0, 0, 1)],
    # Short lines, some of them linked, in a page without an article.
    [(0, 1, 1, 0, 0, 0), (0, 3, 3, 0, 0, 0), (1, 9, 0, 1, 0, 0), (1, 11, 1, 0, 0, 0), (1, 19, 4, 0, 0, 0), (1, 28, 2, 0, 0, 0),
     (1, 13, 1, 0, 0, 0), (0, 5, 3, 0, 0, 0), (0, 7, 4, 0, 0, 0), (0, 4, 2, 0, 0, 0), (0, 3, 0, 0, 0, 0)],
    # A page of links only.
    [(0, 2, 2, 0, 0, 0), (0, 5, 5, 0, 0, 0), (0, 8, 8, 0, 0, 0), (0, 15, 15, 0, 0, 0), (0, 3, 3, 1, 0, 0), (0, 6, 6, 0, 0, 0)],
    # One paragraph, or a few, and nothing else.
    [(1, 25, 0, 0, 0, 0)], [(1, 150, 2, 0, 0, 0)], [(1, 40, 0, 0, 0, 0), (1, 12, 0, 0, 0, 0), (1, 85, 0, 0, 0, 0)],
    [(1, 4, 0, 1, 0, 0), (1, 60, 2, 0, 0, 0)],
]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows = [[Block("", w, k, bool(h), bool(i), bool(n)) for _, w, k, h, i, n in page] for page in LABELLED]
    return np.vstack([features(r) for r in rows]), np.array([b[0] for page in LABELLED for b in page])


class Tree:
    """A binary decision tree by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8):
        self.answer, self.feature = bool(2 * y.sum() >= len(y)), None
        if depth == 0 or y.min() == y.max():
            return
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                left = x[:, f] <= cut
                score = sum(len(s) * s.mean() * (1 - s.mean()) for s in (y[left], y[~left]))
                if best is None or score < best[0] - 1e-12:
                    best = score, f, cut
        if best is None:
            return
        _, self.feature, self.cut = best
        left = x[:, self.feature] <= self.cut
        self.low, self.high = Tree(x[left], y[left], depth - 1), Tree(x[~left], y[~left], depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature is None:
            return np.full(len(x), self.answer)
        out, left = np.empty(len(x), bool), x[:, self.feature] <= self.cut
        out[left], out[~left] = self.low.predict(x[left]), self.high.predict(x[~left])
        return out


def main_blocks(page: str | None, tree: Tree) -> list[tuple[str, bool, int, float]]:
    """(text, whether it is main text, words, link density) of each block."""
    found = blocks(page) if page else []
    kept = tree.predict(features(found)) if found else []
    return [(b.text, bool(k), b.words, b.linked / b.words) for b, k in zip(found, kept)]


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", all_blocks: bool = False) -> DataFrame:
    """page_id, url, text, n_chars, and blocks (text, main, words, link_density; with ``all_blocks``) of every page."""
    tree = Tree(*labelled_table())
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col)
    block = T.StructType([T.StructField("text", T.StringType()), T.StructField("main", T.BooleanType()), T.StructField("words", T.LongType()), T.StructField("link_density", T.DoubleType())])
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("blocks", T.ArrayType(block))])
    arrow = pa.list_(pa.struct([("text", pa.string()), ("main", pa.bool_()), ("words", pa.int64()), ("link_density", pa.float64())]))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                found = [main_blocks(p, tree) for p in part.column("html").to_pylist()]
                texts = ["\n".join(b[0] for b in page if b[1]) for page in found]
                listed = [[dict(zip(block.names, b)) for b in page] if all_blocks else None for page in found]
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(listed, arrow)], names=schema.names)

    return rows.mapInArrow(take, schema)
