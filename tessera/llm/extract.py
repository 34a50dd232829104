"""Main text of web pages: the best-scoring contiguous run of words and tags, with weights from labelled pages."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, held, least_hashes, pick

#: Labelled pages that the weights are taken from, those of the least hashes.
FIT_PAGES = 2000
SMOOTH = 5.0
#: What a tag costs at least, and at most; a word gives between -1 and 1.
TAG_COST = (0.02, 1.0)
#: What a word costs in an element that is never article text, and all of such an element at most: an
#: advert does not cut an article in two.
OUTSIDE_COST = (0.1, 2.0)

# Fixed values of the HTML standard: elements by their role.
RAW = "script style noscript template iframe canvas object textarea title annotation annotation-xml"
VOID = "area base br col embed hr img input link meta param source track wbr"
INLINE = "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img"
#: Elements that are never article text, and those that mark it on labelled pages.
OUTSIDE = "nav footer aside form button select dialog menu fieldset head datalist"
LABELS = ("article", "main")
#: Parts of drawings and formulas: their text counts, they do not.
SILENT = "path circle ellipse rect line polyline polygon g defs use stop lineargradient radialgradient clippath mask pattern marker tspan mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mspace mstyle mpadded mphantom semantics"
#: Of the elements that are never article text, those in which an article is a teaser or a comment.
SHUT = "nav footer aside button select dialog menu datalist"
#: Elements whose id names their subject.
TITLED = "h1 h2 h3 h4 h5 h6 p section article main"
#: Words in a class, id or role that say the same of an element when a name ends with one, before words for what
#: holds it; a header so named is that of the page. A name with a word for a state says nothing (has-sidebar).
KEYWORDS = (
    "ad ads adbox advert advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification alert "
    "newsletter subscribe subscription signup paywall sidebar aside widget related recommended recommendations share sharing social menu nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager header masthead topbar footer copyright comment comments commentlist reply replies respond disqus popup modal overlay login search toolbar contentinfo complementary"
)
HOLDERS = "box bar wrap wrapper container holder inner outer list area block notice message button buttons link links item items icon icons form field panel left right top bottom posts articles stories section"
STATES = "has no with without is not hide show"
SITE = "site page global top main"
#: Weight of a keyword elsewhere in a name, where none is learned.
FIXED = -0.5
#: A name says nothing of an element that holds so many words, and so many times the words of the article without it,
#: but for words for what readers and other articles say.
MOST_WORDS = 30
MOST_TIMES = 4
OTHERS = "comment comments commentlist reply replies respond disqus related recommended recommendations"
#: Elements whose name says nothing; their class, id and role do.
GENERIC = "html body div section span center table tbody thead tr td"
_RAW, _VOID, _INLINE, _OUTSIDE, _KEYWORDS, _GENERIC = (frozenset(x.split()) for x in (RAW, VOID, INLINE, OUTSIDE, KEYWORDS, GENERIC))
_SILENT, _SHUT, _TITLED, _HOLDERS, _STATES, _SITE, _OTHERS = (frozenset(x.split()) for x in (SILENT, SHUT, TITLED, HOLDERS, STATES, SITE, OTHERS))
_FIXED = {f".{word}": FIXED for word in _KEYWORDS}
_IN_RAW = {name: re.compile(rf"</{name}\s*(?:>|$)|</{name}(?=[\s/])[^>]*>?", re.I) for name in _RAW}
_MARKUP = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|$)", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")

Token = tuple[str, str, str]


def tokens(page: str) -> Iterator[Token]:
    """(text, data, ''), (open, name, attributes) and (close, name, '') in order; comments and raw elements are left out."""
    at = 0
    while at < len(page):
        m = _MARKUP.search(page, at)
        if not m:
            break
        if m.start() > at:
            yield "text", page[at : m.start()], ""
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            yield "close", name, ""
        elif name in _RAW and not (m[3] or m[6] or "").rstrip().endswith("/"):
            end = _IN_RAW[name].search(page, at)
            at = end.end() if end else len(page)
        else:
            yield "open", name, m[3] or m[6] or ""
    if at < len(page):
        yield "text", page[at:], ""


def _names(name: str, attributes: str) -> list[list[str]]:
    """The words of each name in class, id and role; ids of headings, paragraphs and sections and names of states are left out."""
    if "=" not in attributes:
        return []
    found = []
    for m in _NAMED.finditer(attributes):
        if m[1].lower() == "id" and name in _TITLED:
            continue
        for each in html.unescape(m[2] or m[3] or m[4] or "").split():
            parts = [p.lower() for p in _PART.split(each) if p]
            if parts and _STATES.isdisjoint(parts):
                found.append(parts)
    return found


def _outside(parts: list[str], labelled: bool) -> bool:
    """Whether a name says that its element is never article text."""
    last = len(parts) - 1
    while last and parts[last] not in _KEYWORDS and parts[last] in _HOLDERS:
        last -= 1
    if parts[last] == "header":
        return not labelled and (not last or parts[0] in _SITE)
    return parts[last] in _KEYWORDS


class _Open:
    """An open element: its name, features, and what holds for text in it."""

    __slots__ = ("name", "features", "outside", "shut", "labelled", "around", "weight", "region", "mark")

    def __init__(self, name: str, names: list[list[str]], above: _Open | None, weights: dict[str, float], number: int, plain: bool) -> None:
        """number counts the elements of the page; the names of a plain one do not put it outside."""
        self.name = name
        self.features = [*([] if name in _GENERIC else [name]), *[f".{m}" for parts in names for m in parts]]
        self.labelled = bool(above and above.labelled) or name in LABELS
        marked = not plain and any(_outside(parts, self.labelled) for parts in names)
        own = name in _OUTSIDE or (name == "header" and not self.labelled) or (name not in (*LABELS, "body", "html") and marked)
        self.shut = bool(above and above.shut) or name in _SHUT
        # an article in a marked element is article text, unless the mark is in another article or on this one
        inherited = bool(above and above.outside)
        if name in LABELS and not (above and above.labelled) and not self.shut and not marked:
            inherited = False
        self.outside = inherited or own
        # the article or main around it, and the outermost element in that which is outside by its names alone
        self.region = above.region if above and above.region is not None else number if name in LABELS else None
        self.mark = above.mark if above and inherited else None
        if marked and not inherited and self.region not in (None, number) and name not in _OUTSIDE and not any(_OTHERS.intersection(parts) for parts in names):
            self.mark = number
        # a feature counts once, however often elements with it are nested
        around = above.around if above else frozenset()
        new = [f for f in dict.fromkeys(self.features) if f not in around]
        self.around = around.union(new) if new else around
        self.weight = (above.weight if above else 0.0) + sum(weights.get(f, _FIXED.get(f, 0.0)) for f in new)


def walk(page: str, weights: dict[str, float], plain: frozenset[int] = frozenset()) -> Iterator[tuple[str, str, _Open | None, list[str]]]:
    """(kind, data, innermost open element, features) of each token; forgives unclosed and stray tags."""
    stack: list[_Open] = []
    number = 0
    for kind, name, attributes in tokens(page):
        top = stack[-1] if stack else None
        if kind == "text":
            yield kind, name, top, []
            continue
        if name in _SILENT:
            continue
        if kind == "open":
            if name == "body":  # a head without its end
                while stack and stack[-1].name == "head":
                    stack.pop()
            if name in LABELS:  # a menu without its end
                menu = next((k for k, x in enumerate(stack) if x.name == "nav"), None)
                if menu is not None:
                    del stack[menu:]
            if name not in _INLINE and name not in _VOID:  # a block ends an open paragraph, an item the item before
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].name == "p" or (name == "li" and stack[k].name == "li"):
                        del stack[k:]
                        break
                    if stack[k].name not in _INLINE:
                        break
            number += 1
            opened = _Open(name, _names(name, attributes), stack[-1] if stack else None, weights, number, number in plain)
            yield kind, name, opened, opened.features
            if name not in _VOID and not attributes.rstrip().endswith("/"):
                stack.append(opened)
            continue
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name == name:
                yield kind, name, stack[k], [] if name in _GENERIC else [name]
                del stack[k:]
                break


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run of the largest sum above 0, the longest of equal ones; (0, 0) if there is none."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += score
        if total > best or (total == best > 0 and i + 1 - start > found[1] - found[0]):
            best, found = total, (start, i + 1)
    return found


def main_text(page: str, weights: dict[str, float], plain: frozenset[int] = frozenset()) -> str:
    """Blocks of the best run, without what is outside the article, one a line.

    Names that would put nearly all words of an article outside it are passed over (see MOST_WORDS).

    A word scores between -1 and 1 by the weights of the elements around it; a tag costs what its
    weight says, at least a little. In elements that are never article text, words have a cost with
    a bound for each such element, and tags have none.
    """
    steps: list[tuple[float, str | None]] = []  # score, and text or None for a border of blocks
    spent = 0.0  # in the present element outside the article
    inside: Counter[int] = Counter()  # words of each article
    marked: Counter[tuple[int, int]] = Counter()  # words outside it by names alone
    for kind, data, element, features in walk(page, weights, plain):
        outside = bool(element and element.outside)
        if not outside:
            spent = 0.0
        if kind == "text":
            n = len(data.split())
            if element and element.region is not None:
                if element.mark is not None:
                    marked[element.region, element.mark] += n
                elif not outside:
                    inside[element.region] += n
            if outside:
                cost = min(n * OUTSIDE_COST[0], OUTSIDE_COST[1] - spent)
                spent += cost
                steps.append((-cost, ""))
                continue
            odds = element.weight if element else 0.0
            if element and element.labelled:  # names in an article lower its text, but do not cut it
                odds = max(0.0, odds + 2.0)
            steps.append((n * max(-1.0, min(1.0, 0.5 + odds / 2)), data))
        elif outside:
            steps.append((0.0, "" if data in _INLINE else None))
        else:
            labelled = bool(element and element.labelled and data not in LABELS)
            odds = sum(weights.get(f, 0.0) for f in features)
            cost = TAG_COST[0] if labelled else min(TAG_COST[1], max(TAG_COST[0], -odds))
            steps.append((-cost, "" if data in _INLINE else None))
    passed = frozenset(mark for (region, mark), n in marked.items() if n >= MOST_WORDS and n > MOST_TIMES * inside[region])
    if passed and not plain:
        return main_text(page, weights, passed)
    a, b = best_run([s for s, _ in steps])
    blocks, held = [], []
    for _, text in [*steps[a:b], (0.0, None)]:
        if text is not None:
            held.append(text)
            continue
        block = " ".join(html.unescape("".join(held)).split())
        if block:
            blocks.append(block)
        held = []
    return "\n".join(blocks)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[tuple[str, bool]] = Counter()
        for page in batch.column("html").to_pylist():
            for kind, data, element, _ in walk(page, {}):
                if kind != "text" or element is None:
                    continue
                n = len(data.split())
                counts["", element.labelled] += n
                for feature in element.features:
                    if feature not in LABELS:
                        counts[feature, element.labelled] += n
        yield pa.record_batch(
            {"feature": pa.array([k[0] for k in counts], pa.string()), "labelled": pa.array([k[1] for k in counts], pa.bool_()), "n": pa.array(list(counts.values()), pa.int64())}
        )


def learn(counts: list[tuple[str, bool, int]], smooth: float = SMOOTH) -> dict[str, float]:
    """Weight of each feature: log odds of a word in the element being content, against that of words at large, in [-3, 3]."""
    found: dict[str, list[float]] = {}
    for feature, labelled, n in counts:
        found.setdefault(feature, [0.0, 0.0])[bool(labelled)] += n
    out, into = found.pop("", [0.0, 0.0])
    if not out or not into:
        return {}
    return {f: max(-3.0, min(3.0, math.log((b + smooth * into / (into + out)) / into) - math.log((a + smooth * out / (into + out)) / out))) for f, (a, b) in found.items()}


def fit_weights(pages: DataFrame, fit_pages: int = FIT_PAGES) -> dict[str, float]:
    """Weights from at most fit_pages whole pages that label their content by an article or main element."""
    labelled = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]")).select("html", F.xxhash64("html").alias("h"))
    counts = least_hashes(labelled, fit_pages).select("html").mapInArrow(_feature_counts, "feature string, labelled boolean, n bigint")
    return learn([tuple(r) for r in counts.groupBy("feature", "labelled").agg(F.sum("n")).collect()])


def _extract(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        table = weights.value
        for batch in (part for whole in batches for part in chunks(whole, "html")):
            texts = [main_text(page or "", table) for page in batch.column("html").to_pylist()]
            yield pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return run


def extract(pages: DataFrame, fit_pages: int = FIT_PAGES) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars (code points).

    Weights come from pages that label their content (words in and out of it, by element and by words
    in class, id and role); the label itself is a fixed +2. A page is read once, whole. Null and empty html, and
    pages where no run scores above 0, give an empty text. Broken and unclosed markup is read as far as it
    goes. Null ids and urls stay null; repeated rows come back alike; an empty table gives no rows; other
    columns are ignored.
    """
    pages = pick(pages, "page_id", "url", "html")
    weights = pages.sparkSession.sparkContext.broadcast(fit_weights(pages, fit_pages))
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(_extract(weights), f"page_id {kind}, url string, text string, n_chars bigint")


def op8_extract_text(spark, sf_dir):
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
