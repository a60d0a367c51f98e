"""Main text of web pages by line-block distribution.

Markup is stripped to lines: one per block element. What is marked as no part of an article (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, hidden parts, reader comments) leaves blank lines, and text inside links
weighs nothing. The text lengths of `window` lines from each line on are summed: where the sum rises from 0 a run
surges, where it falls to 0 it dives. A run is kept, with all its short lines, if its greatest sum reaches `surge` characters; if no
run does, the greatest one is kept. Where a page marks its article, the tag is a weight, not a choice: a line in it weighs `surge`
characters more, one of links alone weighs 1. Lines outside it weigh what they are long, and a long run there is kept too.

An element that is left out ends where HTML ends it: at its end tag, at a tag that implies one, or at its parent's end tag. If the page lacks
an end tag of its name, an article ends it too; if that leaves a page without any text, the next block does.

Defined results: a null or empty page has an empty text; unclosed and cut off markup is read as far as it goes; `<` before
anything but a tag is text; repeated rows give repeated results; a null page_id or url is carried through; further columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import ship, text_slices

# Names of HTML elements and usual class names.
RAW = frozenset("script style textarea".split())
EMBEDDED = frozenset("noscript template svg math iframe object canvas audio video select button".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("head nav header footer aside form fieldset dialog menu".split())
ARTICLE = frozenset("article main".split())
NO_ARTICLE = frozenset("nav head header form".split())
# Start tags that end an open element of their kind whose end tag may be left out, and what shields it from them.
ENDS_P = frozenset(
    """address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup
    hr li main menu nav ol p pre search section summary table ul""".split()
)
CELLS, ROWS, GROUPS = ("td", "th"), ("tr",), ("tbody", "thead", "tfoot", "caption", "colgroup")
IMPLIED = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": CELLS, "th": CELLS, "tr": (*CELLS, *ROWS), "option": ("option",), "optgroup": ("option", "optgroup"),
           "button": ("button",), "select": ("select",), "body": ("head",)} | {g: (*CELLS, *ROWS, *GROUPS) for g in GROUPS}
SHIELDS = {
    **dict.fromkeys(("li",), frozenset("ul ol menu table td th section article aside nav main header footer blockquote form dl".split())),
    **dict.fromkeys(("dd", "dt"), frozenset("dl ul ol table td th section article aside nav main header footer blockquote form".split())),
    **dict.fromkeys((*CELLS, *ROWS, *GROUPS), frozenset(["table"])),
    **dict.fromkeys(("option", "optgroup"), frozenset(["select", "datalist"])),
    "p": frozenset("table td th caption button object template svg math".split()),
}
OPTIONAL = frozenset(["p", "li", "dd", "dt", *CELLS, *ROWS, *GROUPS, "option", "optgroup", "head"])
NOISE = frozenset(
    """ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline-share comment comments commentlist consent
    cookie cookies copyright disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices
    overlay pagination popup promo promotion promoted related recommended reply replies respond search share sharing sidebar signup skip
    social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets alert disclaimer teaser""".split()
)
COMMENTS = frozenset("comment comments commentlist".split())
# Labels that headings and paragraphs of an article bear as well.
OWN = frozenset("header teaser".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 p".split())
CONTENT = frozenset("article body content entry has main no page post story text with without wrapper container layout".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())

_DROPPED = re.compile(rf"<!--.*?(?:-->|\Z)|<({'|'.join(sorted(RAW))})(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*)()[^>]*(?:>|\Z)")
_ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _is_noise(name: str, attributes: str, in_article: bool = False) -> bool:
    """Whether an element's attributes say that it is no part of the text."""
    if not attributes.strip():
        return False
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    noise = NOISE - OWN if in_article and name in HEADINGS else NOISE
    for label in f"{found.get('class', '')} {found.get('id', '')}".lower().split():
        parts = [x for x in re.split(r"[-_\d]+", label) if x]
        if parts and (parts[0] in noise or parts[-1] in noise) and not CONTENT & set(parts):
            return True
        if COMMENTS & set(parts):
            return True
    return False


class Tags:
    """The tags of a page, and for each start tag the number of the tag that ends its element."""

    def __init__(self, html: str):
        self.found = list(_TAG.finditer(html))
        self.name = [(m[2] or m[5]).lower() for m in self.found]
        self.closing = [bool(m[1] or m[4]) for m in self.found]
        n = len(self.found)
        self.end = [n] * n
        #: Ended by its own end tag, or by what ends an element whose end tag may be left out.
        self.whole = [False] * n
        self._stack: list[int] = []
        self._open: Counter[str] = Counter()
        for i, name in enumerate(self.name):
            if self.closing[i]:
                stop = SHIELDS.get(name, frozenset())
                self._close(i, (name,), stop if name not in INLINE else None)
                continue
            if name in ENDS_P:
                self._close(i, ("p",), SHIELDS["p"])
            for old in IMPLIED.get(name, ()):
                self._close(i, (old,), SHIELDS.get(old, frozenset()))
            if name in VOID or name in ("html", "body") or self.shut(i):
                self.end[i], self.whole[i] = i, True
            else:
                self._stack.append(i)
                self._open[name] += 1
        #: Names of elements that lack an end tag: another one of the name may have taken its parent's.
        self.loose = {self.name[i] for i in range(n) if not self.closing[i] and not self.whole[i]} - OPTIONAL

    def shut(self, i: int) -> bool:
        return (self.found[i][3] or "").rstrip().endswith("/")

    def _close(self, at: int, names: tuple[str, ...], stop: frozenset[str] | None) -> None:
        """Ends the innermost open element of these names and all in it; what is in `stop` (for None: any block) is not left."""
        if not any(self._open[x] for x in names):
            return
        for k in range(len(self._stack) - 1, -1, -1):
            name = self.name[self._stack[k]]
            if name in names:
                for i in self._stack[k:]:
                    self.end[i], self.whole[i] = at, self.name[i] in OPTIONAL or i == self._stack[k]
                    self._open[self.name[i]] -= 1
                del self._stack[k:]
                return
            if name in stop if stop is not None else name not in INLINE:
                return

    def left_until(self, i: int, sure: bool) -> int:
        """The tag up to which a left-out element goes. If its end tag is missing, an embedded one, or one that would take the rest
        of the page, ends at the next block; without `sure` one that may have taken its parent's end tag does so, too."""
        n = len(self.found)
        if not sure and self.name[i] in self.loose - OUTSIDE:
            pass
        elif self.whole[i] or self.name[i] not in EMBEDDED and (self.end[i] < n or self.name[i] in OUTSIDE):
            return self.end[i]
        return next((j for j in range(i + 1, self.end[i]) if self.name[j] not in INLINE | VOID | EMBEDDED | {"option", "optgroup", "source"}), self.end[i])


def lines(html: str, window: int, sure: bool = True) -> tuple[list[str], list[int], list[bool]]:
    """Lines of text, the characters of each that are not in links, and whether each is in a marked article.

    Without `sure`, a left-out element goes to the next block only if the page lacks an end tag of its name.
    """
    html = _DROPPED.sub(" ", html)
    texts, weights, inside = [], [], []
    pieces: list[str] = []
    weight = links = articles = 0
    tags = Tags(html)
    outside, until = "", 0  # the element left out, and the tag that ends it

    def close() -> None:
        nonlocal weight
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            texts.append(text)
            weights.append(weight)
            inside.append(articles > 0)
        pieces.clear()
        weight = 0

    def blank(gap: int) -> None:
        for _ in range(gap):
            texts.append("")
            weights.append(0)
            inside.append(False)

    at = 0
    for i, tag in enumerate(tags.found):
        closing, name = tags.closing[i], tags.name[i]
        if outside:
            if i == until:
                ended, outside = outside, ""
                if closing and name == ended:
                    at = tag.end()
                    continue
            elif name in ARTICLE and not closing and (outside in NO_ARTICLE or outside in tags.loose) and not _is_noise(name, tag[3] or ""):
                outside = ""  # such an element was never closed
            else:
                continue
            at = tag.start()
        if tag.start() > at:
            part = html[at : tag.start()]
            pieces.append(part)
            if not links:
                weight += len(part.strip())
        at = tag.end()
        if not closing and name not in VOID and name not in ("html", "body") and not tags.shut(i):
            if name in EMBEDDED:
                pieces.append(" ")
                outside, until = name, tags.left_until(i, sure)
                continue
            if name in OUTSIDE and not (name == "header" and articles) or _is_noise(name, tag[3] or "", articles > 0):
                close()
                # A part of the page's frame ends a run; a notice or an advert between paragraphs does not.
                blank(window if name in OUTSIDE else 1)
                outside, until = name, tags.left_until(i, sure)
                continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        if name in INLINE or name in EMBEDDED:
            continue
        close()
        if name in ARTICLE:
            articles = max(0, articles + (-1 if closing else 1))
            blank(window)
        links = 0  # a block ends a link that was left open
    if not outside:
        pieces.append(html[at:])
        weight += len(html[at:].strip()) if not links else 0
    close()
    return texts, weights, inside


def main_text(html: str | None, window: int = 3, surge: int = 80) -> str:
    if not html:
        return ""
    texts, weights, inside = lines(html, window)
    if not any(texts):
        texts, weights, inside = lines(html, window, sure=False)
    # In a marked article a line of text surges however short it is, and a line of links alone goes on a run but makes none.
    weights = [(w + surge if w else 1) if t and y else w for t, w, y in zip(texts, weights, inside, strict=True)]
    sums = np.convolve(weights, np.ones(window, int))[window - 1 :] if weights else np.zeros(0, int)
    runs, start = [], None
    for i, s in enumerate([*sums.tolist(), 0]):
        if s and start is None:
            start = i
        elif not s and start is not None:
            runs.append((max(sums[start:i].tolist()), start, i))
            start = None
    most = max((r[0] for r in runs), default=0)
    kept = [texts[i] for s, a, b in runs if s >= surge or s == most for i in range(a, b)]
    return " ".join(t for t in kept if t)


def extract(pages: DataFrame, window: int = 3, surge: int = 80) -> DataFrame:
    """For each row: page_id, url, text, n_chars."""
    ship(pages.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "html"):
            texts = [main_text(h, window, surge) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    found = pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(rows, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
