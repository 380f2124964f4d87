"""HTML extraction: the maximum-scoring subsequence of words and tags.

A page is a sequence of tokens: words and block tags. Words score positive and tags negative, with weights
learnt from labelled pages: pages that mark their text with one ``article`` or ``main`` element. A
token's weight is the log-odds of lying inside that element, kept at its sign (words at least
``LEAST``, tags at most ``-LEAST``). Words inside elements that are never text (menus, forms, footers, adverts ...)
score as those elements' tags do. One linear scan finds the contiguous region with the largest sum.

An element is never text by its name, by the attribute hidden, or by a whole class, id or role token (``MARKS``).
Tokens that only have such a word as a part (``with-sidebar``) cost a tag's weight and keep their text. A marked element
beside the text or inside of it stays out, however long it is; only one that holds the text is a wrapper. The text is
the article or main with the most words that no marked element holds (words of marked elements inside don't count); on pages without,
the words outside of marked elements. Only where there are none either do wrappers give way: those around the main or
article with the most words, or else, from the outside in, the marked element, form or head with the most
words until one has words of its own. Several articles come out together, if the region spans them, with what is between.

The region then grows to whole blocks: to the innermost container (article, main, section, div, table cell or
page) that holds it, and to the outermost article or main around that. Its blocks without the elements
that are never text are the result: character references decoded, white space inside a block one
space, blocks in page order joined by a line feed.

Labelled pages are a bounded sample (``SAMPLE`` pages, drawn by hash); without any, words weigh 1
and tags -1. One pass in Arrow batches, no shuffle. Null or empty html and pages without words in text give an
empty string. Pages may be cut anywhere; an unfinished tag at the end is no text. Equal regions are settled by
the first. Repeated pages get equal texts; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ledgerloom.llm.common import drawn

SAMPLE = 400
LEAST = 0.1
MOST = 6.0

# Element names and their roles.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "select", "object", "noembed", "xmp")
NEVER_TEXT = frozenset((*RAW, "head", "nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "label", "input"))
CONTAINERS = frozenset(("article", "main", "section", "div", "td", "th", "body", "html"))
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: these end an open element of the same kind
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: those of them that are told by their words too
MAY_HOLD_PAGE = ("form", "head")
#: whole tokens of class, id and role attributes that mark what is never text, with a hyphen for an underscore
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertisements banner banners promo promos promotion sponsor sponsored sidebar sidebars "
    "side-bar nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead comment comments reader-comments "
    "disqus replies cookie cookies cookie-notice consent notice notices popup modal newsletter subscribe signup share sharing social "
    "related recommended widget toolbar search login pagination pager complementary contentinfo "
    "ad-box ad-banner ad-container ad-slot ad-unit ad-wrapper banner-ad google-ad nav-bar nav-menu main-nav main-menu site-nav "
    "top-nav site-header site-footer page-footer cookie-banner cookie-consent comment-list comment-form comments-area "
    "share-buttons social-share social-links related-posts related-articles newsletter-signup".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<note>annotation(?:-xml)?)\b[^>]*>.*?(?:</(?P=note)\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<cut>/?[a-zA-Z][^<>]*)\Z|<\Z|</\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none")
_WHITE = re.compile(r"\s+")


def marks(name: str, rest: str) -> tuple[bool, bool]:
    """Whether an element is never text by its name or attributes, and whether a part of a token hints at it."""
    if name in NEVER_TEXT:
        return True, True
    if not rest or name in ("article", "main", "body", "html"):
        return False, False
    hinted = False
    for match in _ATTRIBUTE.finditer(rest.lower()):
        key, value = match[1], match[2] or match[3] or match[4] or ""
        if key in ("class", "id", "role"):
            for word in value.replace("_", "-").split():
                if word in MARKS:
                    return True, True
                hinted = hinted or not MARKS.isdisjoint(word.split("-"))
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _NOT_SHOWN.search(value):
            return True, True
    return False, hinted


class Page:
    """Tokens of a page: runs of words and block tags, with the elements around them."""

    def __init__(self, source: str):
        #: (kind, number of words or 1); kind: "w" words in text, "x" words elsewhere, or the tag's name
        self.tokens: list[tuple[str, int]] = []
        self.pieces: list[tuple[int, str]] = []  # text by token
        #: containers as [name, first token, last token, container around it]
        self.boxes: list[list] = [["page", 0, -1, -1]]
        #: elements that are never text unless they hold it, as [element of them around it, whether it or one around it is
        #: told by name alone, own token if inline or -1, words in no other of them]
        self.left_out: list[list] = []
        self._runs: list[tuple[int, int, str]] = []  # token, innermost element left out or -1, text
        self._around: dict[int, int] = {}  # outermost article or main: the innermost element left out around it
        self._plain: Counter = Counter()  # by outermost article or main, and -1: words in no element left out inside of it
        open_names: list[tuple[str, int, int, int, int]] = []  # name, place in left_out or -1, element left out, box and article around
        names_open: Counter = Counter()
        hold, area, inner_box = -1, -1, 0

        def close() -> str:
            nonlocal hold, area, inner_box
            name, box, hold, inner_box, area = open_names.pop()
            names_open[name] -= 1
            if box >= 0:
                self.boxes[box][2] = len(self.tokens)
            return name

        at = 0
        for match in _TAG.finditer(source):
            if match.start() > at:
                self._text(source[at : match.start()], hold, area)
            at = match.end()
            name = match["name"]
            if not name:
                if match["raw"]:
                    self.tokens.append(("x", 1))
                continue
            name = name.lower()
            never, hinted = marks(name, match["rest"])
            if name not in BLOCKS and not never:
                if name == "br":
                    self._text(" ", hold, area)
                if name in VOID or not match["close"]:
                    continue
            if match["close"]:
                if not names_open[name]:
                    continue
                while open_names and close() != name:
                    pass
                if name in BLOCKS:
                    self.tokens.append((name, 1))
                continue
            ends = SIBLINGS.get(name, ())
            # a block ends an open paragraph, an item the item before it in the same list
            while open_names and (open_names[-1][0] == "p" and name in BLOCKS or open_names[-1][0] in ends):
                close()
            self.tokens.append((f"{name}!" if hinted and name not in NEVER_TEXT else name, 1))
            if name in VOID or match["rest"].endswith("/"):
                continue
            box = len(self.boxes) if name in CONTAINERS else -1
            open_names.append((name, box, hold, inner_box, area))
            names_open[name] += 1
            if never:
                named = name in NEVER_TEXT and name not in MAY_HOLD_PAGE or hold >= 0 and self.left_out[hold][1]
                self.left_out.append([hold, named, -1 if name in BLOCKS else len(self.tokens) - 1, 0])
                hold = len(self.left_out) - 1
            if box >= 0:
                self.boxes.append([name, len(self.tokens) - 1, -1, inner_box])
                inner_box = box
            if area < 0 and name in ("article", "main"):
                area = box
                self._around[area] = hold
        if at < len(source):
            self._text(source[at:], hold, area)
        for box in self.boxes:
            if box[2] < 0:
                box[2] = len(self.tokens)
        self._settle()

    def _text(self, raw: str, hold: int, area: int) -> None:
        number = len(raw.split())
        self._runs.append((len(self.tokens), hold, raw))
        self.tokens.append(("w", number) if number else ("", 0))
        if hold >= 0:
            self.left_out[hold][3] += number
        # words of menus and the like say nothing about where the text is
        if number and hold == self._around.get(area, -1) and not (hold >= 0 and self.left_out[hold][1]):
            self._plain[area] += number

    def _wrappers(self) -> set[int]:
        """The elements of ``left_out`` that hold the page's text."""
        held = {k: around for k, around in self._around.items() if self._plain[k]}
        best = max((k for k in held if held[k] < 0), key=lambda k: self._plain[k], default=-1)
        if best < 0:
            best = next((k for k in held if self.boxes[k][0] == "main"), -1)
        if best < 0 and self._plain[-1]:
            return set()
        if best < 0:
            best = max(held, key=lambda k: self._plain[k], default=-1)
        kept: set[int] = set()
        if best >= 0:
            up = held[best]
            while up >= 0:
                kept.add(up)
                up = self.left_out[up][0]
            return kept
        # no words but in marked elements: the ones with the most of them, from the outside in
        words = [0 if named else own for _, named, _, own in self.left_out]
        inside: dict[int, list[int]] = {}
        for k in range(len(words) - 1, -1, -1):  # an element comes before those inside of it
            around = self.left_out[k][0]
            inside.setdefault(around, []).append(k)
            if around >= 0:
                words[around] += words[k]
        level = -1
        while level < 0 or not self.left_out[level][3]:
            level = max(reversed(inside.get(level, [])), key=lambda k: words[k], default=-1)
            if level < 0 or not words[level]:
                break
            kept.add(level)
        return kept

    def _settle(self) -> None:
        """Decides which marked elements are left out."""
        kept = self._wrappers()
        dead = []
        for k, (around, _, inline, _) in enumerate(self.left_out):
            dead.append(k not in kept or around >= 0 and dead[around])
            if k in kept and inline >= 0:
                self.tokens[inline] = ("", 0)
        for k, hold, raw in self._runs:
            if hold < 0 or not dead[hold]:
                self.pieces.append((k, raw))
            elif self.tokens[k][1]:
                self.tokens[k] = ("x", self.tokens[k][1])

    def labelled_box(self) -> list | None:
        """The one article or main element, if there is just one."""
        found = [b for b in self.boxes if b[0] in ("article", "main")]
        return found[0] if len(found) == 1 else None

    def region(self, weights: dict[str, float]) -> tuple[int, int] | None:
        """First and last token of the maximum-scoring subsequence; None if no word scores."""
        best, where, total, first = 0.0, None, 0.0, 0
        for k, (kind, number) in enumerate(self.tokens):
            if total <= 0:
                total, first = 0.0, k
            total += number * weights.get(kind, 1.0 if kind == "w" else -1.0)
            if total > best:
                best, where = total, (first, k)
        return where

    def container(self, region: tuple[int, int]) -> tuple[int, int]:
        """The tokens of the innermost container around the region, or of the outermost article around it."""
        inside = [k for k, b in enumerate(self.boxes) if b[1] <= region[0] and region[1] <= b[2]]
        at = max(inside, key=lambda k: (self.boxes[k][1], k))
        box, up = self.boxes[at], at
        while up >= 0:
            if self.boxes[up][0] in ("article", "main"):
                box = self.boxes[up]
            up = self.boxes[up][3]
        return box[1], box[2]

    def text(self, first: int, last: int) -> str:
        """The blocks of a range of tokens."""
        blocks, current, seen = [], [], first
        for k, raw in self.pieces:
            if not first <= k <= last:
                continue
            # a block tag since the piece before ends the block
            if any(kind not in ("w", "") for kind, _ in self.tokens[seen:k]):
                blocks.append("".join(current))
                current = []
            seen = k
            current.append(raw)
        blocks.append("".join(current))
        clean = (_WHITE.sub(" ", html.unescape(block)).strip() for block in blocks)
        return "\n".join(block for block in clean if block)


def learn_weights(pages: Iterable[str]) -> dict[str, float]:
    """Log-odds of each token to lie in the text of the labelled pages, words positive, tags negative."""
    inside, outside = Counter(), Counter()
    for source in pages:
        page = Page(source)
        box = page.labelled_box()
        if box is None:
            continue
        for k, (kind, number) in enumerate(page.tokens):
            if kind:
                (inside if box[1] < k < box[2] else outside)[kind] += number
    weights = {}
    for kind in set(inside) | set(outside):
        odds = math.log((inside[kind] + 0.5) / (outside[kind] + 0.5))
        odds = max(-MOST, min(MOST, odds))
        weights[kind] = max(LEAST, odds) if kind == "w" else min(-LEAST, odds)
    return weights


def main_text(source: str, weights: dict[str, float]) -> str:
    page = Page(source)
    region = page.region(weights)
    return page.text(*page.container(region)) if region else ""


def text_column(weights: dict[str, float], source: Column) -> Column:
    @arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(s.as_py() or "", weights) for s in batch], pa.string())

    return extracted(source)


def labelled_pages(pages: DataFrame, sample: int = SAMPLE) -> list[str]:
    """At most ``sample`` pages that mark their text, drawn by hash; of more pages while too few are found."""
    total, wanted, found = pages.count(), 4 * sample, []
    marked = pages.where(F.lower("html").rlike("<(article|main)[ >]"))
    while total:
        some = marked.where(drawn(F.struct("page_id", "url"), wanted, total))
        ordered = some.orderBy(F.md5(F.coalesce("url", F.lit(""))), "page_id", "html")
        found = [row.html for row in ordered.select("html", "url", "page_id").limit(sample).collect()]
        if len(found) == sample or wanted >= total:
            break
        wanted *= 8
    return found


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    weights = learn_weights(labelled_pages(pages, sample))
    done = pages.select("page_id", "url", text_column(weights, F.col("html")).alias("text"))
    return done.withColumn("n_chars", F.char_length("text").cast("long"))
