"""Main text of web pages by tag-path ratios.

A page is a list of text pieces, each at the end of a path of elements from
the root. For every path the page's pieces are added up: characters, words'
punctuation, pieces. Their two ratios, text per piece and punctuation per
piece, are smoothed along the page, fused, and paths above the threshold
select the content. On a page with a main element or articles that have text,
only paths inside them count. The article or main element around all selected
pieces (but those that only their neighbours lift), or else the smallest
element that holds them all, is the article; all text in it is kept, but for
elements that are boilerplate by kind. A path is a number given to (parent's
path, tag, marks), so deep pages take memory in proportion to their length.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import steps

# HTML's elements by kind.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt "
                    "ruby s samp small span strike strong sub sup time tt u var wbr".split())
_RAW = frozenset("script style noscript template textarea title svg math iframe object canvas select button".split())
_ASIDE = frozenset("nav footer aside menu dialog".split())
# Elements that a new element closes: paragraphs, items, cells.
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                      "header hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
# Elements that are part of a text, never the whole of it.
_PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr figure figcaption".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
_BARRIER = frozenset("table ul ol dl article section div body html main td th blockquote".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, role and id tokens, which are cut at hyphens, underscores and
# capitals. A plain mark says boilerplate wherever it stands in a token, a weak
# one only if the token's other words are general. Reader comments stay
# boilerplate however long they are.
_COMMENTS = frozenset("comment comments commentlist commenter disqus respond replies".split())
_PLAIN = _COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promos promotion cookie cookies gdpr consent popup "
    "modal newsletter subscribe nav navbar navigation menu breadcrumb breadcrumbs footer sidebar share sharing login signup "
    "pagination pager toolbar".split())
_WEAK = frozenset("header masthead banner notice widget related recommended social search reply complementary contentinfo".split())
_GENERAL = frozenset(
    "list section area wrapper wrap container box block item items inner outer bar slot unit thread form holder panel group site "
    "page top bottom left right main user reader global row col links posts articles stories news buttons icons".split())
_HEADER = frozenset("header masthead".split())
# A token that begins or ends with one of these speaks of another element.
_ABOUT_OTHERS = frozenset("no not with without has hide is".split())
_STATES = frozenset("open closed enabled disabled".split())
_WORDS = re.compile(r"[A-Z]?[^\W_A-Z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WHITE = re.compile(r"\s+")

SMOOTHING = 1.0
THRESHOLD = 0.5


class Element:
    __slots__ = ("tag", "parent", "path", "noise", "kind", "hidden", "comments", "block", "story", "chars", "story_chars", "has_main",
                 "hits")

    def __init__(self, tag: str, attributes: str, parent: "Element | None", paths: dict[tuple[int, str, str], int]):
        self.tag, self.parent = tag, parent
        self.kind, self.hidden, self.chars, self.story_chars, self.has_main = tag in _ASIDE or tag in _RAW, False, 0, 0, tag == "main"
        self.hits, self.comments = 0, False
        # Where its text is the article's by kind: in an article, in main.
        self.story = tag if tag == "article" else parent and parent.story or (tag if tag == "main" else "")
        mark, noise = "", tag in ("form", "head")
        if attributes:
            for name, value in _ATTRIBUTE.findall(attributes):
                value, name = value.strip("\"'"), name.lower()
                if name in ("hidden", "aria-hidden"):
                    self.hidden = self.hidden or value.lower() != "false"
                else:
                    mark += f".{value}"
                    noise = self._marked(name, value) or noise
        if self.comments:  # a reader's comment may be an article of its own
            self.story = ""
        if tag == "header":  # a page's header; an article's own holds its title
            noise = noise or not self.story
        self.noise = noise
        self.path = paths.setdefault((parent.path if parent else -1, tag, mark), len(paths))
        self.block = tag not in _INLINE

    def _marked(self, name: str, value: str) -> bool:
        """Whether a class token, role or id says boilerplate. Headings never
        do, an id in an article is a topic unless it says comments, and an
        article can only be a comment."""
        if self.tag in ("html", "body", "main") or self.tag in _HEADINGS:
            return False
        found = False
        for token in value.split():
            words = [w.lower() for w in _WORDS.findall(token)]
            if not words or words[0] in _ABOUT_OTHERS or words[-1] in _STATES:
                continue
            general = all(w in _PLAIN or w in _WEAK or w in _GENERAL or w.isdigit() for w in words)
            if self.tag == "article":
                says = words[0] == "comment"
            else:
                says = any(w in _COMMENTS for w in words) and (general or name != "id" or not self.story)
            if says:
                self.comments = found = True
            elif self.tag == "article" or name == "id" and self.story == "article":
                continue
            elif any(w in _PLAIN for w in words):
                found = True
            elif general and any(w in _WEAK and not (self.story and w in _HEADER) for w in words):
                found = True
        return found


def _settle_noise(elements: list[Element], found: list[tuple[Element, int, str]]) -> None:
    """Boilerplate is inherited, but what holds main, or an article with most
    of the page's text, isn't any. Nor is an element by its class, role, id or
    as a form if it holds most of its articles' text (any of it, if no article
    stands outside such elements) or, on a page without main or articles, most
    of the page's; comments stay comments. ``elements`` are in the order of
    the page."""
    for element, _, text in found:
        n = len(text.strip())
        element.chars += n
        if element.story == "article":
            element.story_chars += n
    for e in reversed(elements[1:]):
        e.parent.chars += e.chars
        e.parent.story_chars += e.story_chars
        e.parent.has_main = e.parent.has_main or e.has_main
    page = elements[0]
    plain = not page.has_main and not page.story_chars
    marked: set[Element] = set()
    free = False
    for e in elements[1:]:
        if e.noise or e.kind or e.hidden or e.parent in marked:
            marked.add(e)
        elif e.tag == "article" and e.chars:
            free = True
    for e in elements[1:]:
        if e.has_main or 2 * e.story_chars > page.chars:
            e.noise = e.kind = False
        if plain and not e.comments and 2 * e.chars > page.chars or e.story != "article" and (
                2 * e.story_chars > page.story_chars or e.story_chars and not free):
            e.noise = False
        e.noise = e.noise or e.kind or e.hidden or e.parent.noise


def pieces(page: str) -> tuple[list[Element], list[tuple[Element, int, str]]]:
    """All elements in order, and (element, block, text) of every piece of
    text that isn't boilerplate by kind; pieces of one block have one number."""
    paths: dict[tuple[int, str, str], int] = {}
    root = at = Element("", "", None, paths)
    elements = [root]
    out: list[tuple[Element, int, str]] = []
    open_tags: Counter[str] = Counter()
    block = pos = 0

    def leave(to: Element) -> None:
        nonlocal at
        while at is not to:
            open_tags[at.tag] -= 1
            at = at.parent

    while pos < len(page):
        cut = page.find("<", pos)
        match = _TOKEN.match(page, cut) if cut >= 0 else None
        while cut >= 0 and not match:  # a lone "<" is text
            cut = page.find("<", cut + 1)
            match = _TOKEN.match(page, cut) if cut >= 0 else None
        text = page[pos:cut] if match else page[pos:]
        if text:
            out.append((at, block, html.unescape(text)))
        if not match:
            break
        pos = match.end()
        slash, tag, attributes = match.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if open_tags[tag] > 0:
                near = at
                while near.tag != tag:
                    near = near.parent
                if any_block(at, near.parent):
                    block += 1
                leave(near.parent)
            continue
        closes = _SIBLINGS.get(tag, set()) | ({"p"} if tag in _CLOSES_P else set())
        if any(open_tags[x] > 0 for x in closes):
            near = at
            while near.parent and near.tag not in closes and near.tag not in _BARRIER:
                near = near.parent
            if near.tag in closes:
                leave(near.parent)
        element = Element(tag, attributes, at, paths)
        elements.append(element)
        if element.block:
            block += 1
        elif tag == "br":
            out.append((at, block, " "))
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*(?:>|$)", re.I).search(page, pos)
            if not attributes.rstrip().endswith("/") or end:
                pos = end.end() if end else len(page)
        elif tag not in _VOID and not attributes.rstrip().endswith("/"):
            at = element
            open_tags[tag] += 1
    _settle_noise(elements, out)
    return elements, [x for x in out if not x[0].noise]


def any_block(low: Element, high: Element) -> bool:
    """Whether a block ends between an element and one that holds it."""
    while low is not high:
        if low.block:
            return True
        low = low.parent
    return False


def _smooth(x: np.ndarray) -> np.ndarray:
    kernel = np.exp(-np.arange(-2, 3) ** 2 / (2 * SMOOTHING**2))
    weights = np.convolve(np.ones(len(x)), kernel)[2:-2]
    return np.convolve(x, kernel)[2:-2] / weights


def _around(elements: list[Element], chosen: set[Element]) -> Element:
    """The outermost article around all ``chosen`` elements, or else the
    outermost main, or else the smallest element that holds them all."""
    for e in elements:
        e.hits = int(e in chosen)
    low = elements[0]
    for e in reversed(elements[1:]):
        if e.hits == len(chosen):
            low = e  # the last one in the page's order is the smallest
            break
        e.parent.hits += e.hits
    while low.tag in _PARTS:
        low = low.parent
    found, at = {}, low
    while at:
        found[at.tag] = at
        at = at.parent
    return found.get("article") or found.get("main") or low


def _in_story(runs: list[tuple[Element, str]]) -> list[bool]:
    """Which pieces may be selected: on a page whose main has text, or whose
    articles have a fifth of the text (any, if there is one), only those."""
    in_main, in_article, articles = [], [], set()
    main: dict[Element, bool] = {}
    for element, _ in runs:
        above, e, found = [], element, False
        while e and e not in main:
            above.append(e)
            e = e.parent
        for x in reversed(above):
            main[x] = x.tag == "main" or bool(x.parent and main[x.parent])
        found = main[element]
        in_main.append(found)
        in_article.append(element.story == "article")
    if any(in_main):
        return in_main
    for element, _ in runs:
        if element.story == "article":
            while element.tag != "article":
                element = element.parent
            articles.add(element)
    share = sum(len(t) for (_, t), x in zip(runs, in_article) if x)
    if len(articles) == 1 or articles and 5 * share >= sum(len(t) for _, t in runs):
        return in_article
    return [True] * len(runs)


def main_text(page: str) -> str:
    """The article's blocks, joined by newlines."""
    elements, found = pieces(page)
    blocks: dict[int, list] = {}
    for element, block, text in found:
        if block in blocks:
            blocks[block][1] += text
        else:
            blocks[block] = [element, text]
    runs = []
    for element, text in blocks.values():
        text = _WHITE.sub(" ", text).strip()
        if text:
            while element.parent and not element.block:  # its block's path
                element = element.parent
            runs.append((element, text))
    if not runs:
        return ""
    sums: dict[int, list[int]] = {}
    for element, text in runs:
        s = sums.setdefault(element.path, [0, 0, 0])
        s[0] += len(text)
        s[1] += len(_PUNCTUATION.findall(text))
        s[2] += 1
    length = np.array([sums[e.path][0] / sums[e.path][2] for e, _ in runs])
    marks = np.array([1 + sums[e.path][1] / sums[e.path][2] for e, _ in runs])
    score = np.sqrt(_smooth(length) * _smooth(marks))
    by_path: dict[int, float] = {}
    for (element, _), x in zip(runs, score.tolist()):
        by_path[element.path] = max(x, by_path.get(element.path, 0.0))
    story = _in_story(runs)
    least = THRESHOLD * np.average(score[story], weights=[len(t) for (_, t), x in zip(runs, story) if x])
    chosen = {e for (e, _), x in zip(runs, story) if x and by_path[e.path] >= least}
    # Not what only its neighbours lift, such as a link beside the text.
    own = {e.path: x for (e, _), x in zip(runs, np.sqrt(length * marks).tolist())}
    article = _around(elements, {e for e in chosen if own[e.path] >= least or e.tag in _PROSE} or chosen)
    inside: set[Element] = set()
    for e in elements:
        if e is article or e.parent in inside:
            inside.add(e)
    return "\n".join(text for element, text in runs if element in inside)


def _extract(batches):
    for batch in steps(batches, "html"):
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    Null and empty pages, and pages without text, have an empty text.
    Repeated rows give repeated results, null ids and addresses pass
    through, an empty table gives an empty result, other columns are
    ignored. Markup that is cut off or never closed ends with the page.
    """
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")) \
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
