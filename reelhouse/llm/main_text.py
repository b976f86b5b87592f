"""Main text of web pages: the highest-scoring stretch of a page whose words score up and tags down."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.functions import pandas_udf

from reelhouse.llm.common import ship

# Bound of the labelled sample (pages), features kept, least labelled words for one.
SAMPLE, KEPT, LEAST_WORDS = 5000, 5000, 20
# What one container of other text can cost at most, so that a long advert doesn't split an article.
MOST_COST = 30.0

# Elements that hold no text of the page, that start a block, and that are sections.
SKIPPED = frozenset("script style template noscript svg math iframe object canvas video audio select textarea title head".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption option".split())
MAIN, OTHER = frozenset(("article", "main")), frozenset("nav header footer aside form menu dialog button".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class, id and role names that tell before any page is seen: +, of main text; -, of other text.
HINTS = {
    "+": "article main content post entry story body text",
    "-": "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright discussion disqus "
         "disclaimer footer form header login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination "
         "paywall popup promo promoted promotion recommended related reply replies respond share sharing shares sidebar signup social "
         "sponsor sponsored subscribe subscription tags teaser toolbar tracking widget complementary contentinfo search alert",
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)[^>]*>"
    r"|(?P<text>[^<]+|<)", re.S)
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=\s|$|=)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)


class Token(NamedTuple):
    tag: str  # "" for text; a tag's name otherwise
    text: str
    place: int  # number of the innermost section it lies in; 0 is the page
    block: bool  # a tag that ends a block


class Page(NamedTuple):
    tokens: list[Token]
    sections: list[frozenset[str]]  # features of each section
    inside: list[bool]  # whether a section lies in an article or main element, and in nothing else within that
    around: list[bool]  # whether a section holds such an element


def _features(tag: str, attrs: str) -> frozenset[str]:
    """Features of an element that is a section: its name, and words of its class, id and role."""
    names = {w for m in NAMES.finditer(attrs) for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[1] or m[2] or m[3] or "").lower()) if w}
    found = {f".{n}" for n in names}
    if tag in MAIN | OTHER | {"body"}:
        found.add(tag)
    if HIDDEN.search(attrs):
        found.add(".hidden")
    return frozenset(found)


def parse(page: str) -> Page:
    """Text pieces and tags in page order. Comments, declarations and elements without page text are left out."""
    tokens: list[Token] = []
    sections, inside, around, parents = [frozenset()], [False], [False], [-1]
    stack: list[tuple[str, int]] = [("", 0)]
    opened: Counter = Counter()  # elements of each name in the stack: an end tag without one is not looked for
    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        place = stack[-1][1]
        if m["text"] is not None:
            tokens.append(Token("", html.unescape(m["text"]), place, False))
        elif not tag:
            continue
        elif m["end"] or m["end2"]:
            while opened[tag]:
                name, _ = stack.pop()
                opened[name] -= 1
                if name == tag:
                    break
            tokens.append(Token(tag, "", place, tag in BLOCKS))
        else:
            attrs = m["attrs"] or ""
            if tag in RAW:
                close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = close.end() if close else len(page)
                continue
            features = _features(tag, attrs)
            if features and tag not in EMPTY:
                sections.append(features)
                inside.append(tag in MAIN and not _hinted(features) or inside[place] and tag not in OTHER and not _hinted(features))
                around.append(False)
                parents.append(place)
                holder = place if inside[-1] and not inside[place] else -1
                while holder >= 0 and not around[holder]:
                    around[holder] = True
                    holder = parents[holder]
                place = len(sections) - 1
            tokens.append(Token(tag, "", place, tag in BLOCKS))
            if tag not in EMPTY and not attrs.rstrip().endswith("/"):
                if tag in ("p", "li", "option") and stack[-1][0] == tag:  # these end where the next begins
                    opened[stack.pop()[0]] -= 1
                    place = place if features and tag not in EMPTY else stack[-1][1]
                stack.append((tag, place))
                opened[tag] += 1
    return Page(tokens, sections, inside, around)


def _hinted(features: frozenset[str]) -> bool:
    return ".hidden" in features or any(f[1:] in _OTHER_NAMES for f in features if f[0] == ".")


_OTHER_NAMES = frozenset(HINTS["-"].split())
PRIOR = {f".{w}": 4.0 for w in HINTS["+"].split()} | {f".{w}": -8.0 for w in HINTS["-"].split()} \
    | {t: 6.0 for t in MAIN} | {t: -6.0 for t in OTHER} | {".hidden": -8.0}


class Weights(NamedTuple):
    sections: dict[str, float]  # log-odds of a word being main text, by feature of its section
    tags: dict[str, float]  # cost of a tag, above 0


def count_page(page: str, counts: Counter) -> None:
    """Add the words and tags of a page that marks its main text by an article or main element.

    Words beside that element, in what holds it, tell of pages that mark their text only: they count for ``around``, not for
    the names of the section. The body and the page hold whatever there is, so their own names never count.
    """
    parsed = parse(page)
    for t in parsed.tokens:
        main = parsed.inside[t.place]
        if t.tag:
            counts["tag", t.tag, main] += 1
        elif words := len(t.text.split()):
            features = parsed.sections[t.place]
            for f in ("around",) if parsed.around[t.place] and not main else () if "body" in features else features:
                counts["section", f, main] += words


def labelled_counts(pages: DataFrame, page: str = "html", sample: int = SAMPLE) -> DataFrame:
    """(kind, feature, main, other) over about ``sample`` pages that mark their main text, chosen by a hash of the page."""
    marked = pages.where(F.lower(F.col(page)).rlike(r"<(article|main)[\s>]")).select(F.col(page).alias("html"))
    total = marked.agg(F.count(F.lit(1)).alias("n")).head().n
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                count_page(page, counts)
        yield pa.RecordBatch.from_pylist(
            [{"kind": k, "feature": f, "main": n if main else 0, "other": 0 if main else n} for (k, f, main), n in counts.items()],
            pa.schema([("kind", pa.string()), ("feature", pa.string()), ("main", pa.int64()), ("other", pa.int64())]))

    ship(pages.sparkSession)
    found = marked.where(place < sample / max(total, 1)).mapInArrow(count, "kind string, feature string, main long, other long")
    return found.groupBy("kind", "feature").agg(F.sum("main").alias("main"), F.sum("other").alias("other"))


def learn(pages: DataFrame, page: str = "html") -> Weights:
    """Weights of the KEPT most frequent features; those not seen keep what their name tells."""
    counts = labelled_counts(pages, page).where(F.col("main") + F.col("other") >= LEAST_WORDS)
    rows = counts.orderBy(F.desc(F.col("main") + F.col("other")), "kind", "feature").limit(KEPT).collect()
    sections, tags = dict(PRIOR), {}
    for r in rows:
        share = (r.main + 1) / (r.main + r.other + 2)
        if r.kind == "tag":
            tags[r.feature] = 0.05 + 2 * (1 - share)
        else:
            odds = max(-6.0, min(6.0, math.log(share / (1 - share))))
            sections[r.feature] = PRIOR.get(r.feature, 0.0) + odds
    return Weights(sections, tags)


def _stretch(parsed: Page, odds: list[float], shown: list[bool], weights: Weights) -> tuple[float, str]:
    """Score and blocks of the best stretch, without its sections of negative odds and those not shown."""
    kept = [o >= 0 and s for o, s in zip(odds, shown, strict=True)]
    spent = [0.0] * len(odds)
    best, best_sum, start, running = (0, 0), 0.0, 0, 0.0
    for i, t in enumerate(parsed.tokens):
        if t.tag:
            score = -weights.tags.get(t.tag, 0.5)
        elif kept[t.place]:
            score = len(t.text.split()) * (1 + odds[t.place])
        else:
            score = max(len(t.text.split()) * min(odds[t.place], 0.0), spent[t.place] - MOST_COST)
            spent[t.place] -= score
        running += score
        if running <= 0:
            start, running = i + 1, 0.0
        elif running > best_sum:
            best, best_sum = (start, i + 1), running
    blocks, block = [], []
    for t in parsed.tokens[slice(*best)]:
        if t.block:
            blocks.append(block)
            block = []
        elif t.tag == "br":
            block.append(" ")
        elif not t.tag and kept[t.place]:
            block.append(t.text)
    lines = (" ".join("".join(b).split()) for b in [*blocks, block])
    return best_sum, "\n".join(line for line in lines if line)


def _odds(features: frozenset[str], weights: Weights) -> float:
    """Log-odds of a section; the name of its element tells nothing where its class says that it is other text, as for a comment that is an article."""
    return sum(weights.sections.get(f, 0.0) for f in (features - MAIN if _hinted(features) else features))


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best stretch, one per line; empty without a word in main text.

    Sections of negative odds are left out as long as the rest scores more than the words of the weightiest of them, each divided
    by the square of its odds. Else that section is what the page has to say: odds then count from its own, and the
    stretch is sought again. Hidden sections stay out, and so do elements that hold other text by definition; a form may hold
    the whole page.
    """
    if not page:
        return ""
    parsed = parse(page)
    odds = [_odds(features | {"around"} if around and not inside else features, weights)
            for features, inside, around in zip(parsed.sections, parsed.inside, parsed.around, strict=True)]
    shown = [".hidden" not in features for features in parsed.sections]
    found, text = _stretch(parsed, odds, shown, weights)
    named = [s and not features & (OTHER - {"form"}) for s, features in zip(shown, parsed.sections, strict=True)]
    masses: Counter = Counter()
    for t in parsed.tokens:
        if not t.tag and odds[t.place] < 0 and named[t.place]:
            masses[odds[t.place]] += len(t.text.split()) / (1 - odds[t.place]) ** 2
    level, mass = max(masses.items(), key=lambda m: (m[1], m[0]), default=(0.0, 0.0))
    if mass > found:
        shown = [n or s and o >= 0 for n, s, o in zip(named, shown, odds, strict=True)]
        text = _stretch(parsed, [o - level for o in odds], shown, weights)[1] or text
    return text


def extract(pages: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of each page, weights learned from the pages that mark theirs.

    Null and empty pages, and pages without main text, give an empty text. Without marked pages
    the weights are those that names of elements and classes tell.
    """
    weights = pages.sparkSession.sparkContext.broadcast(tuple(learn(pages, page)))

    @pandas_udf("string")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for found in batches:
            yield pd.Series([main_text(p, Weights(*weights.value)) for p in found], dtype=object)

    return pages.withColumn(text, find(F.col(page)))
