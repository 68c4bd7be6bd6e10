"""Main text of web pages: words score positive, tags negative, and the best contiguous region is the content.

How much a word counts and a tag costs is taken from labelled pages, those that mark their article themselves: of every
kind of element it is counted how often it stands inside the article and beside it. The words of a page are then worth
the share of their element (nothing in one that is boilerplate by its share), its tags cost what is missing to one, and a
linear scan finds the maximum-scoring region.
The region is widened to the element that holds it, and elements that are boilerplate by their share are left out.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.base import prepare

#: Labelled pages that the weights are counted on, about.
FIT_PAGES = 4096
#: Kinds of elements that get a weight of their own (the most frequent), and elements that a kind must have.
KINDS, LEAST_ELEMENTS = 10_000, 8
#: Elements that a prior stands for.
PRIOR_WEIGHT = 4.0
#: Cost of any tag, and of a tag whose elements are never content.
TAG_COST, BOILERPLATE_COST = 0.05, 20.0
#: Share from which an element may be content.
CONTENT = 0.5

# Element names of HTML by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HEAD = frozenset("base link meta noscript script style template title".split())
HIDDEN = frozenset("head script style template noscript iframe svg canvas object audio video title textarea xmp noembed "
                   "noframes math map".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog button select option input label fieldset legend datalist".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
                   "summary table tbody td tfoot th thead title tr ul caption select textarea button noscript template".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre address figcaption summary td th tr caption".split())
PROSE = TEXT_BLOCKS | frozenset("b i em strong u s a br span sub sup code q cite small mark abbr time tbody table".split())
CLOSES_P = BLOCKS - frozenset("body html head li dd dt td th tr tbody thead tfoot caption option legend".split())
CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
SCOPES = frozenset("table td th ul ol dl body html article main section div nav header footer aside form button".split())
# Words of class, id and role that name something other than the article.
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond discussion disqus".split())
OTHER_WORDS = COMMENT_WORDS | frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar cookie cookies "
    "consent gdpr notice alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs masthead header footer "
    "toolbar share sharing social related recommended newsletter subscribe subscription signup login search widget "
    "pagination pager complementary contentinfo".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+>|[^>]*(?:>|\Z))", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-zA-Z]+")
_MARKS = (("role", "main"), ("itemprop", "articlebody"))


class Page:
    """Elements and texts of a page in order. A tag whose quotes do not close ends at the next ``>``.

    ``nodes``: (parent, name, words of class, id and role); node 0 is the page. ``events``: (node, text): None is the start
    of the node, True its end, a string is text in it. ``ends``: the event at which each node ends.
    """

    def __init__(self, html: str):
        self.nodes: list[tuple] = [(-1, "html", ())]
        self.events: list[tuple] = []
        self.ends: list[int] = [0]
        self.starts: list[int] = [0]
        self.stack = [0]
        at, size = 0, len(html)
        while at < size:
            found = _TOKEN.search(html, at)
            upto = found.start() if found else size
            if upto > at:
                self.events.append((self.stack[-1], unescape(html[at:upto])))
            if not found:
                break
            at = found.end()
            name = (found[2] or "").lower()
            if not name:
                continue
            if found[1]:
                self._close(name)
            elif name not in ("html", "body"):
                self._open(name, found[3])
                if name in RAW:
                    end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
                    at = end.start() if end else size
        while len(self.stack) > 1:
            self._pop()
        self.ends[0] = len(self.events)

    def _pop(self) -> None:
        node = self.stack.pop()
        self.ends[node] = len(self.events)
        self.events.append((node, True))

    def _pop_to(self, names: set, inline: bool = False) -> bool:
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.nodes[self.stack[depth]][1]
            if name in names:
                while len(self.stack) > depth:
                    self._pop()
                return True
            if name in BLOCKS if inline else name in SCOPES and not names & SCOPES:
                return False
        return False

    def _open(self, name: str, attributes: str) -> None:
        if len(self.stack) == 2 and self.nodes[self.stack[1]][1] == "head" and name not in HEAD:
            self._pop()
        if name in CLOSES_P:
            self._pop_to({"p"})
        if name in CLOSED_BY:
            self._pop_to(CLOSED_BY[name])
        words = ()
        if len(attributes) > 4 and (named := _NAMED.findall(attributes)):
            words = tuple({w.lower() for found in named for w in _WORD.findall("".join(found[1:]))}
                          | {"=main" for a, *v in named if (a.lower(), "".join(v).strip().lower()) in _MARKS})
        node = len(self.nodes)
        self.nodes.append((self.stack[-1], name, words))
        self.starts.append(len(self.events))
        self.events.append((node, None))
        self.ends.append(len(self.events))
        if name not in VOID:
            self.stack.append(node)

    def _close(self, name: str) -> None:
        if name in ("body", "html"):
            return
        self._pop_to({name}, inline=name not in BLOCKS)


def marks_article(name: str, words: tuple) -> bool:
    return name in ("article", "main") or "=main" in words


def kinds_of(name: str, words: tuple) -> tuple:
    """What an element is counted as: the words of its class, id and role where it has any, else its name."""
    return tuple("." + w for w in words) or (name,)


def other_by_prior(name: str, words: tuple) -> bool:
    return name in HIDDEN or name in BOILERPLATE or not OTHER_WORDS.isdisjoint(words)


def _prior(kind: str) -> float:
    if kind[0] == ".":
        return 0.02 if kind[1:] in OTHER_WORDS else 0.9
    return 0.0 if kind in HIDDEN else 0.02 if kind in BOILERPLATE else 0.99 if kind in PROSE else 0.9


def _articles(page: Page) -> list[int]:
    """The outermost elements that mark an article and do not stand in something else, such as comments."""
    out, covered = [], [False] * len(page.nodes)
    for i, (parent, name, words) in enumerate(page.nodes):
        covered[i] = parent >= 0 and covered[parent]
        if not covered[i] and i and marks_article(name, words):
            out.append(i)
            covered[i] = True
        elif other_by_prior(name, words) and name != "form":
            covered[i] = True
    return out


def count_kinds(html: str, counts: dict) -> None:
    """Add a labelled page to ``counts``: kind -> [elements in the article, outermost elements beside it]."""
    page = Page(html)
    articles = set(_articles(page))
    if not articles:
        return
    holds = set()
    for node in articles:
        while node >= 0:
            holds.add(node)
            node = page.nodes[node][0]
    place = ["holds"] * len(page.nodes)
    for i, (parent, name, words) in enumerate(page.nodes):
        if i in holds:
            place[i] = "in" if i in articles else "holds"
            continue
        where = place[parent]
        if where == "in" and not other_by_prior(name, words):
            place[i] = "in"
            for kind in kinds_of(name, words):
                counts[kind][0] += 1
        elif where == "skip":
            place[i] = "skip"
        else:  # what is in it belongs to it
            place[i] = "skip"
            for kind in kinds_of(name, words):
                counts[kind][1] += 1


class Weights:
    """Share of each kind of element that is content, from counts and priors."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.shares = {k: (i + PRIOR_WEIGHT * _prior(k)) / (i + o + PRIOR_WEIGHT) for k, (i, o) in counts.items()}

    def share(self, name: str, words: tuple) -> float:
        if name in HIDDEN:
            return 0.0
        found = min(self.shares.get(k, _prior(k)) for k in kinds_of(name, words))
        return min(found, _prior(name)) if name in BOILERPLATE else found


def best_region(scores: list[float]) -> tuple[int, int]:
    """(first, last + 1) of the contiguous region with the greatest sum, the first of equal ones; empty if none is positive."""
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for i, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += x
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


def extract(html: str, weights: Weights) -> str:
    """The blocks of the page's content joined by newlines; empty where no word of the page may be content."""
    page = Page(html)
    nodes, events = page.nodes, page.events
    own = [1.0] + [weights.share(name, words) for _, name, words in nodes[1:]]
    for node in _articles(page):  # a form or a wrapper around the article is no boilerplate
        own[node] = max(own[node], 0.99)
        node = nodes[node][0]
        while node > 0:
            if nodes[node][1] == "form" or nodes[node][1] not in BOILERPLATE and COMMENT_WORDS.isdisjoint(nodes[node][2]):
                own[node] = max(own[node], 0.9)
            node = nodes[node][0]
    share = own[:]
    for i in range(1, len(nodes)):
        share[i] = min(own[i], share[nodes[i][0]])
    scores = [-TAG_COST - BOILERPLATE_COST * (1 - own[node]) if not isinstance(what, str)
              else len(what.split()) * share[node] if share[node] >= CONTENT else 0.0 for node, what in events]
    begin, end = best_region(scores)
    held = [i for i in range(begin, end) if isinstance(events[i][1], str) and share[events[i][0]] >= CONTENT and events[i][1].strip()]
    if not held:
        return ""
    first, last = held[0], held[-1]
    node = events[first][0]
    while node > 0 and page.ends[node] < last:
        node = nodes[node][0]
    above = node
    while above > 0 and not marks_article(*nodes[above][1:]):
        above = nodes[above][0]
    if above > 0:
        node = above
    while node > 0 and (nodes[node][1] in TEXT_BLOCKS or nodes[node][1] not in BLOCKS):
        node = nodes[node][0]
    if node > 0:
        first, last = page.starts[node], page.ends[node] - 1
    else:  # nothing smaller than the page holds the region
        block = lambda i: nodes[events[i][0]][1] in BLOCKS and not isinstance(events[i][1], str)
        while first > 0 and not block(first - 1):
            first -= 1
        while last + 1 < len(events) and not block(last + 1):
            last += 1
    blocks, parts = [], []
    for at, what in events[first:last + 1]:
        name = nodes[at][1]
        if not isinstance(what, str):
            if name in BLOCKS:
                blocks.append("".join(parts))
                parts = []
            elif name == "br" and share[nodes[at][0]] >= CONTENT:
                parts.append(" ")
        elif share[at] >= CONTENT:
            parts.append(what)
    blocks.append("".join(parts))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def fit_weights(pages: DataFrame, fit_pages: int = FIT_PAGES) -> Weights:
    """Weights from about ``fit_pages`` labelled pages, chosen by a hash of the page. At most ``KINDS`` counts reach the driver."""
    html = pages.select(F.col("html")).where("html rlike '(?i)<article|<main|articlebody|role *= *[^>]?main'")
    n = html.count()
    if n > fit_pages:
        html = html.where(F.pmod(F.xxhash64("html"), F.lit(n)) < fit_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = defaultdict(lambda: [0, 0])
        for batch in batches:
            for page in batch.column(0).to_pylist():
                count_kinds(page, counts)
        if counts:
            yield pa.RecordBatch.from_pydict({"kind": list(counts), "i": [x for x, _ in counts.values()], "o": [x for _, x in counts.values()]})

    found = html.mapInArrow(run, "kind string, i long, o long").groupBy("kind").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))
    found = found.where(F.col("i") + F.col("o") >= LEAST_ELEMENTS).orderBy(F.desc(F.col("i") + F.col("o")), "kind").limit(KINDS)
    return Weights({r["kind"]: (r["i"], r["o"]) for r in found.toArrow().to_pylist()})


def main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``pages`` (page_id, url, html) to (page_id, url, text, n_chars), one row per row; other columns are ignored.

    Character references are decoded, white space inside a block (line breaks by ``br`` too) is one space, blocks are
    joined by a newline. A null or empty page and one without content give an empty text. Without ``weights`` they are
    taken from the pages themselves; where none is labelled, from priors alone.
    """
    prepare(pages.sparkSession)
    fitted = weights or fit_weights(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(html or "", fitted) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=names)

    names = ["page_id", "url", "text", "n_chars"]
    kinds = {f.name: f.dataType.simpleString() for f in pages.select("page_id", "url").schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
