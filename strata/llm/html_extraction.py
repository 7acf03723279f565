"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into blocks at block-level tags. Each block has its word count,
the share of its words inside links, whether it lies in content or in
boilerplate elements (by tag name and by the words of class, id and role), and
the word counts and link shares of the blocks before and after it. A small
decision tree, trained on the labelled blocks of ``TRAINING``, says which are
main text. Scripts, styles, comments, the head and form fields are no text.

Character references are decoded, white space inside a block is one space,
blocks are joined in page order by one space. Null and empty pages, and pages
without main text, give an empty text. Broken markup is read as far as it
goes: an end tag closes the nearest open element of its name, a tag that never
ends is text. Pages are independent, so ties and repeated rows need no care.
Extra columns are not read.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import released, ship, table

# Element names by their role.
BLOCKS = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 header hr html iframe legend li main menu nav
noscript ol option p pre section select summary table tbody td textarea tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("""script style template svg math canvas object applet audio video head title noscript iframe select
textarea button option""".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
# Words of class, id and role that tell what an element is for.
BOILERPLATE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertisements advertising banner breadcrumb
breadcrumbs comment comments commentary cookie cookies consent copyright disclaimer disqus footer footnote gdpr header
links login masthead menu menubar modal nav navbar navigation newsletter notice notices notification outbrain overlay
pager pagination paywall popup privacy promo promoted promotion related reply replies respond share sharing sidebar
signin signup sitemap social sponsor sponsored sponsors subscribe subscription taboola tags teaser toc toolbar widget
complementary contentinfo search alert alertdialog""".split())
CONTENT_WORDS = frozenset("article articlebody content entry main maincontent post postbody story storybody".split())
# Words before which a class speaks of something inside or near the element, and
# words that a class of an article has for its parts or looks.
MODIFIERS = frozenset("with without has have no not is show shows hide hides can js".split())
LAYOUT_WORDS = frozenset("""header footer links menu menubar nav navbar navigation share sharing sidebar social tags toc
toolbar pager pagination search widget breadcrumb breadcrumbs banner overlay modal""".split())

# without backtracking, so that reading a page takes time in proportion
_TOKEN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>")
_PLAIN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")
#: What a block is inside of; a form is boilerplate that an article can stand in.
NEUTRAL, CONTENT, BOILERPLATE, FORM = 0, 1, 2, 4


def _named(value: str) -> tuple[set[str], bool]:
    """(boilerplate words, whether a content word) of a class, id or role. Each of its names is
    read by itself, up to a modifier: what follows is not what the element is."""
    found: set[str] = set()
    content = False
    for name in value.split():
        words = [w.lower() for w in _PARTS.findall(name)]
        said = next((i for i, w in enumerate(words) if w in MODIFIERS), len(words))
        own = {*words[:said], "".join(words[:said])}
        if own & BOILERPLATE_WORDS:
            found |= own & BOILERPLATE_WORDS
        else:
            content |= bool(own & CONTENT_WORDS)
    return found, content


def _role(name: str, attributes: str, around: int) -> tuple[int, bool]:
    """(role of an element with what is around it, whether it is hidden).

    A main element is content wherever it stands, and so is an article unless a name
    says what other kind it is (a comment, a teaser). An element that has both a content
    and a boilerplate name is what the names of its own kind say: boilerplate only if it
    has no content name. The header of a content element holds its title and stays.
    """
    hidden = name in HIDDEN
    words: set[str] = set()
    content = False
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                hidden = True
            elif key == "style":
                hidden |= "display:none" in _SPACE.sub("", value.lower())
            elif key in ("class", "id", "role") and name not in ("body", "html"):
                found, one = _named(value)
                words |= found
                content |= one
    if name == "main":
        return CONTENT, hidden
    if around == BOILERPLATE:
        return around, hidden
    if name == "article" and not words - LAYOUT_WORDS:
        return CONTENT, hidden
    if around == FORM:
        return FORM, hidden
    if name == "form":  # some pages lie in one form as a whole: only main text elements come out of it
        return FORM, hidden
    if name == "header" and around == CONTENT and not words - LAYOUT_WORDS:
        return CONTENT, hidden
    if name in BOILERPLATE_TAGS or words and not (content and words <= LAYOUT_WORDS):
        return BOILERPLATE, hidden
    return (CONTENT if content else around), hidden


class Block:
    __slots__ = ("text", "linked", "role", "words")

    def __init__(self, text: str, linked: int, role: int):
        self.text, self.linked, self.role = text, linked, role
        self.words = text.count(" ") + 1


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order. A block's role is that of the innermost element with
    one; inside boilerplate only a main element is content again, inside a form an article too."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    # open elements: (name, role with what is around, hidden with what is around, link)
    stack: list[tuple[str, int, bool, bool]] = [("", NEUTRAL, False, False)]
    open_count: dict[str, int] = {}

    def flush(role: int) -> None:
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                inside = len(_SPACE.sub(" ", html.unescape(" ".join(linked))).split())
                out.append(Block(text, inside, role))
            parts.clear()
            linked.clear()

    def add(text: str) -> None:
        _, _, hidden, link = stack[-1]
        if not hidden and text:
            parts.append(text)
            if link:
                linked.append(text)

    at, n = 0, len(page)
    no_quotes = False
    while at < n:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        m = (_PLAIN if no_quotes else _TOKEN).match(page, start)
        if m is None and not no_quotes and page[start + 1:start + 3].strip("/")[:1].isalpha():
            no_quotes = True  # a quote that never closes: read the rest without quotes
            m = _PLAIN.match(page, start)
        if m is None:
            if page.find(">", start) < 0:  # a tag that never ends
                add(page[at:])
                break
            add(page[at:start + 1])
            at = start + 1
            continue
        add(page[at:start])
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        if m.lastindex is None or m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in BLOCKS:
            flush(stack[-1][1])
        if closing:
            if open_count.get(name):
                while len(stack) > 1:
                    own = stack.pop()[0]
                    open_count[own] -= 1
                    if own == name:
                        break
            continue
        if name in VOID or m[3].endswith("/") and name not in BLOCKS:
            continue
        if name in ("p", "li", "option", "tr", "td", "th", "dt", "dd") and stack[-1][0] == name:
            open_count[name] -= 1  # closed by the next of its kind
            stack.pop()
        _, around, was_hidden, link = stack[-1]
        role, hidden = _role(name, m[3], around)
        stack.append((name, role, hidden or was_hidden, link or name == "a"))
        open_count[name] = open_count.get(name, 0) + 1
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(page, at)
            if end is None:
                at = n
            else:
                add(page[at:end.start()])
                at = end.start()
    flush(stack[-1][1])
    return out


#: words, link share, role; words and link share before; the same after
FEATURES = 7


def features(page: list[Block]) -> np.ndarray:
    """One row of FEATURES numbers for each block of a page."""
    out = np.zeros((len(page), FEATURES))
    for i, b in enumerate(page):
        out[i, :3] = b.words, min(1.0, b.linked / b.words), min(b.role, BOILERPLATE)
        if i:
            out[i, 3:5] = page[i - 1].words, min(1.0, page[i - 1].linked / page[i - 1].words)
        if i + 1 < len(page):
            out[i, 5:7] = page[i + 1].words, min(1.0, page[i + 1].linked / page[i + 1].words)
    return out


# The labelled table: blocks as (words, link share, role, words before, link
# share before, words after, link share after, main text or not).
TRAINING = (
    # paragraphs, titles and lists inside an article
    (60, 0.0, 1, 8, 0.0, 45, 0.0, 1), (8, 0.0, 1, 6, 0.0, 60, 0.0, 1), (1, 0.0, 1, 12, 0.0, 30, 0.0, 1),
    (2, 0.0, 1, 1, 1.0, 120, 0.0, 1), (300, 0.02, 1, 40, 0.0, 25, 0.0, 1), (25, 0.3, 1, 60, 0.0, 40, 0.0, 1),
    (5, 0.0, 1, 50, 0.0, 0, 0.0, 1), (12, 0.1, 1, 3, 0.0, 2, 0.0, 1), (4, 0.25, 1, 90, 0.0, 70, 0.1, 1),
    (3, 0.0, 1, 0, 0.0, 0, 0.0, 1), (40, 0.6, 1, 70, 0.0, 55, 0.0, 1), (1, 0.0, 1, 1, 0.0, 1, 0.0, 1),
    (3, 1.0, 1, 80, 0.0, 60, 0.0, 1), (9, 0.0, 1, 5, 0.0, 6, 0.9, 1), (70, 0.0, 1, 4, 1.0, 4, 1.0, 1),
    # link lists inside an article
    (3, 1.0, 1, 3, 1.0, 3, 1.0, 0), (2, 1.0, 1, 2, 1.0, 4, 1.0, 0), (5, 1.0, 1, 4, 1.0, 2, 1.0, 0),
    (6, 1.0, 1, 2, 0.9, 5, 1.0, 0),
    # menus, headers, footers, sidebars, notices, adverts, forms, comments
    (1, 1.0, 2, 1, 1.0, 1, 1.0, 0), (2, 1.0, 2, 0, 0.0, 1, 1.0, 0), (6, 0.0, 2, 1, 1.0, 30, 0.0, 0),
    (9, 0.0, 2, 45, 0.0, 0, 0.0, 0), (45, 0.0, 2, 4, 0.0, 50, 0.0, 0), (120, 0.0, 2, 90, 0.0, 60, 0.0, 0),
    (30, 0.1, 2, 200, 0.0, 12, 0.0, 0), (15, 0.5, 2, 60, 0.0, 0, 0.0, 0), (3, 0.0, 2, 3, 0.0, 3, 0.0, 0),
    (300, 0.0, 2, 10, 0.0, 10, 0.0, 0), (1, 0.0, 2, 0, 0.0, 0, 0.0, 0), (80, 0.02, 2, 2, 1.0, 3, 1.0, 0),
    # pages without telling elements: length and links of a block and its neighbours decide
    (60, 0.0, 0, 40, 0.0, 55, 0.0, 1), (25, 0.05, 0, 50, 0.0, 8, 0.0, 1), (14, 0.0, 0, 30, 0.0, 42, 0.0, 1),
    (200, 0.1, 0, 3, 1.0, 3, 1.0, 1), (5, 0.0, 0, 45, 0.0, 60, 0.0, 1), (4, 0.0, 0, 2, 1.0, 70, 0.0, 1),
    (6, 0.0, 0, 55, 0.0, 48, 0.1, 1), (35, 0.0, 0, 4, 0.0, 2, 1.0, 1), (18, 0.1, 0, 25, 0.0, 22, 0.0, 1),
    (11, 0.0, 0, 28, 0.0, 19, 0.0, 1), (20, 0.0, 0, 0, 0.0, 0, 0.0, 1), (2, 0.0, 0, 40, 0.0, 35, 0.0, 1),
    (2, 1.0, 0, 1, 1.0, 2, 1.0, 0), (1, 1.0, 0, 0, 0.0, 1, 1.0, 0), (3, 1.0, 0, 60, 0.0, 2, 1.0, 0),
    (8, 0.9, 0, 5, 1.0, 6, 1.0, 0), (4, 0.0, 0, 2, 1.0, 3, 1.0, 0), (5, 0.0, 0, 60, 0.0, 0, 0.0, 0),
    (3, 0.0, 0, 4, 0.0, 2, 0.0, 0), (30, 0.8, 0, 10, 0.9, 12, 1.0, 0), (6, 0.5, 0, 3, 1.0, 0, 0.0, 0),
    (2, 1.0, 0, 0, 0.0, 60, 0.0, 0), (3, 1.0, 0, 2, 1.0, 120, 0.0, 0), (6, 1.0, 0, 0, 0.0, 25, 0.0, 0),
    (12, 0.9, 0, 1, 1.0, 40, 0.0, 0), (4, 0.0, 0, 0, 0.0, 1, 1.0, 0), (2, 0.0, 0, 3, 0.0, 4, 1.0, 0), (7, 0.0, 0, 5, 0.0, 3, 0.0, 0),
)


class DecisionTree:
    """Binary splits by least Gini impurity; equal splits go to the first feature and value."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8):
        self.nodes: list[tuple] = []
        self._grow(x, y, depth)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        at = len(self.nodes)
        share = float(y.mean())
        self.nodes.append((share,))
        if depth == 0 or share in (0.0, 1.0):
            return at
        best = (len(y) * share * (1 - share) - 1e-9, None)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= cut
                impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[low], y[~low]))
                if impurity < best[0] - 1e-12:
                    best = (impurity, (f, float(cut)))
        if best[1]:
            f, cut = best[1]
            low = x[:, f] <= cut
            left = self._grow(x[low], y[low], depth - 1)
            right = self._grow(x[~low], y[~low], depth - 1)
            self.nodes[at] = (share, f, cut, left, right)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        out = np.zeros(len(x))
        for i, node in enumerate(self.nodes):  # children come after their parent
            here = at == i
            if len(node) == 1:
                out[here] = node[0]
            else:
                _, f, cut, left, right = node
                at[here] = np.where(x[here, f] <= cut, left, right)
        return out > 0.5


def trained() -> DecisionTree:
    table_ = np.array(TRAINING, dtype=float)
    return DecisionTree(table_[:, :FEATURES], table_[:, FEATURES])


def main_text(page: str | None, tree: DecisionTree) -> str:
    own = blocks(page) if page else []
    if not own:
        return ""
    main = tree.predict(features(own))
    return " ".join(b.text for b, keep in zip(own, main) if keep)


@released
def _extract(batches):
    tree = trained()
    for batch in batches:
        out = [main_text(p, tree) for p in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.string()),
             pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its number of code points of every page."""
    ship(spark)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")


def op4_block_tree_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages"))
