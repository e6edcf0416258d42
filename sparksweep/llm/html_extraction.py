"""Main text of HTML pages as the maximum-scoring contiguous run of tokens.

A page is a sequence of tags and words. What is never shown (head, scripts, styles, controls, hidden parts) isn't part of it.
Every text block (between block-level tags) has features: the element it stands in, whether its words are links, its length,
and whether it lies in a box, an element that is furniture by its name, role, class or id. Words score by what the
features say, positive but in links and boxes, and every tag negative; one linear scan finds the contiguous run with the largest sum. All
of one box together costs no more than ``BOX``, so that a long box inside an article doesn't cut it. The run is
then widened to the ``article`` or ``main`` around it, or else the smallest container, if the run holds most of that element's words; boxes inside it
(menus, adverts, forms, comments of readers) are left out, and its text is cut into blocks at block-level tags.

A class or id makes a box only if it consists of marks only; inside an article, and on headings and sections, a class only. An
element with a mark as a part of a longer name ("related-work") is none: outside an article its words score
like those of links, unless it holds more than half of the page's words.

Weights come from labelled pages: those with exactly one ``article`` or ``main`` element, whose words outside boxes are content
and whose other words are not. The label itself is no feature: words and tags score alike inside and outside of
such an element. The weight of a feature is the logarithm of how much larger its share of the content's words is than its share of
the other words; of a tag, of how much more often it stands in content, held below zero. They are fitted on
at most ``SAMPLE`` labelled pages (those with the smallest hashes of their ids);
extraction reads all pages whole.

Defined results: a null or empty page, or one without words, has the empty text; of
equal runs the first is taken, as long as it goes; repeated rows are
extracted each on its own; an empty table gives an empty result. Clashing
column names of the input are replaced by the operator's, other columns pass through.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.llm.batch import drop_columns, slices

SAMPLE = 2000
ADDED = ("text", "n_chars")

# Element names of HTML, and words that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp svg".split())
UNSEEN = frozenset("head button select object audio video canvas".split()) | RAW  # never article text
FURNITURE = frozenset("nav footer aside form menu dialog".split()) | UNSEEN
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
CONTENT = frozenset(("article", "main"))
CONTAINERS = CONTENT | {"section", "div", "td"}
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads adsense advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menubar topbar breadcrumb breadcrumbs sidebar aside masthead header footer cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup login comment comments "
    "commentlist disqus respond reply replies share sharing social related recommended recommendations widget toolbar "
    "pagination pager search hidden".split())
LAYOUT = frozenset("header footer nav navbar navigation menu menubar sidebar aside topbar masthead breadcrumb breadcrumbs banner".split())
# An end tag of one of these may be left out: a start tag of the same group ends it.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
DEFAULT = {"word": 1.0, "links: all": -1.5, "box: yes": -2.0, "tag": -0.05}
BOX = 0.5  # what all of a box costs at most: less than a word, as it is left out in any case
LEAST = 0.1  # of a word that is neither a link nor in a box
ODDS = 2.0  # the largest weight of a feature
LENGTHS = (2, 5, 10, 20, 40)  # words of a block: bounds of the classes

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    # possessive, and a quote without a partner is a character: every tag matches at the first try
                    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")


def _marks(value: str) -> list[set[str]]:
    """The parts of each name in a class or id."""
    return [set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", v).lower())) - {""} for v in value.split()]


def _set_aside(name: str, rest: str, in_content: bool) -> bool | None:
    """Whether the element is furniture; None if only a part of a name says so, outside an article."""
    if name in FURNITURE or name == "header" and not in_content:
        return True
    if not rest.strip(" \t\r\n/") or name in ("html", "body"):
        return False
    at = {k.lower(): next((v for v in vs if v), "") for k, *vs in ATTRIBUTE.findall(rest)}
    if "hidden" in at or at.get("aria-hidden", "").lower() == "true" or at.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", ""), re.I):
        return True
    heading = re.fullmatch("h[1-6]", name)
    names = _marks(at.get("class", ""))
    if not (in_content or heading or name == "section" or name in CONTENT):
        names += _marks(at.get("id", ""))  # elsewhere it may be made from a title
    beside = LAYOUT if name in CONTENT else {"header"} if in_content or heading else set()  # may stand beside or be a part of it
    if any(parts and parts <= MARKS and parts - beside for parts in names):
        return True
    if in_content or heading or name in CONTENT:
        return False
    return None if any(parts & MARKS for parts in names) else False


@dataclass
class Token:
    kind: str  # ``tag`` or ``text``
    value: str
    inside: bool  # of article or main
    link: bool
    box: int  # number of the box it lies in, or 0
    parent: str  # the innermost block-level element
    doubtful: tuple[int, ...]  # numbers of the open elements that may be furniture


def tokens(page: str) -> tuple[list[Token], list[tuple[int, int]]]:
    """The page's tags and texts but what is never shown, and the bounds of each element outside boxes (its tags, too).
    An element that holds more than half of the words is no furniture by a part of its name."""
    items, spans = _tokens(page)
    held: Counter = Counter()
    for t in items:
        if t.kind == "text" and not t.box:
            held.update(dict.fromkeys((*t.doubtful, 0), len(t.value.split())))
    for t in items:
        t.link = t.link or any(2 * held[d] <= held[0] for d in t.doubtful)
    return items, spans


def _tokens(page: str) -> tuple[list[Token], list[tuple[int, int]]]:
    items: list[Token] = []
    spans: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []  # open elements and the places of their start tags
    parents: list[str] = []  # the block-level ones
    doubtful: list[tuple[int, int]] = []  # (depth, number)
    seen = boxes = 0
    aside = None  # depth of the open box
    unseen = None  # depth of the open element that is never shown
    content = links = 0
    opened: Counter = Counter()  # names on the stack
    at, n = 0, len(page)

    def emit(kind: str, value: str) -> None:
        if unseen is None:
            items.append(Token(kind, value, content > 0, links > 0, boxes if aside is not None else 0,
                               parents[-1] if parents else "", tuple(k for _, k in doubtful)))

    def pop() -> str:
        nonlocal content, links, aside, unseen
        top, start = stack.pop()
        opened[top] -= 1
        content -= top in CONTENT
        links -= top == "a"
        if top in BLOCKS:
            parents.pop()
        if aside is None and unseen is None:
            spans.append((start, len(items)))
        if aside is not None and len(stack) < aside:
            aside = None
        if unseen is not None and len(stack) < unseen:
            unseen = None
        while doubtful and doubtful[-1][0] > len(stack):
            doubtful.pop()
        return top

    while at < n:
        m = MARKUP.search(page, at)
        if m is None or m.start() > at:
            emit("text", page[at: m.start() if m else n])
        if m is None:
            break
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["end"]:
            if opened[name]:
                while stack[-1][0] != name:  # closes what was left open inside, too
                    pop()
            emit("tag", name)
            if opened[name]:
                pop()
            continue
        rest = m["rest"]
        if name in VOID:
            emit("tag", name)
            continue
        if (aside is not None or unseen is not None) and name in CONTENT and not _set_aside(name, rest, False):
            while aside is not None or unseen is not None:  # an unclosed menu or box ends where the article begins
                pop()
        for top in IMPLIED.get(name, ()):
            if stack and stack[-1][0] == top and (aside is None or len(stack) > aside):
                pop()
        if rest.endswith("/") and name not in BLOCKS and name not in RAW:
            continue  # closes itself
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(page, at)
            emit("tag", name)
            at = end.end() if end else n
            continue
        if aside is None and unseen is None:
            found = _set_aside(name, rest, content > 0)
            if found:
                boxes += 1
                aside = len(stack) + 1
            elif found is None:
                seen += 1
                doubtful.append((len(stack) + 1, seen))
        emit("tag", name)
        if unseen is None and (name in UNSEEN or HIDDEN.search(rest)):
            unseen = len(stack) + 1
        stack.append((name, len(items) - 1))
        opened[name] += 1
        content += name in CONTENT
        links += name == "a"
        if name in BLOCKS:
            parents.append(name)
    if aside is None and unseen is None:  # elements left open end with the page
        spans += [(start, len(items)) for _, start in stack]
    return items, spans


def features(items: list[Token]) -> list[tuple[str, ...]]:
    """The features of each token; those of a text are its block's."""
    out: list[tuple[str, ...]] = []
    block: list[int] = []

    def end() -> None:
        words = [len(items[i].value.split()) for i in block]
        total, linked = sum(words), sum(w for i, w in zip(block, words, strict=True) if items[i].link)
        kind = "all" if linked == total else "most" if 2 * linked > total else "few"
        for i in block:
            out[i] = (f"in: {items[i].parent}", f"links: {kind}", f"length: {bisect_left(LENGTHS, total)}", f"box: {'yes' if items[i].box else 'no'}")
        block.clear()

    for i, t in enumerate(items):
        out.append(("tag",) if t.kind == "text" or t.value in CONTENT else (t.value,))
        if t.kind == "text":
            t.value = entities.unescape(t.value) if "&" in t.value else t.value
            block.append(i)
        elif t.value in BLOCKS or t.value in UNSEEN:
            end()
    end()
    return out


def count_features(page: str) -> Counter:
    """How often each feature stands in the content of a labelled page and elsewhere; tags by themselves, others by words."""
    found: Counter = Counter()
    if len(re.findall(r"<(?:article|main)\b", page, re.I)) == 1:
        items, _ = tokens(page)
        for t, names in zip(items, features(items), strict=True):
            for name in names if t.kind == "tag" else (*names, "word"):
                found[name, t.inside and not t.box] += 1 if t.kind == "tag" else len(t.value.split())
    return found


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Features within ``ODDS`` of zero, tags from -2 to -0.02."""
    if not any(inside for _, inside in counts):
        return dict(DEFAULT)
    out = dict(DEFAULT)
    content, others = counts.get(("word", True), 0), counts.get(("word", False), 0)
    for name in {n for n, _ in counts} - {"word", "tag"}:
        a, b = counts.get((name, True), 0), counts.get((name, False), 0)
        if ": " in name:
            odds = math.log((a + 1) / (content + 2)) - math.log((b + 1) / (others + 2))
            out[name] = max(-ODDS, min(ODDS, odds))
        else:
            out[name] = max(-2.0, min(-0.02, math.log((a + 1) / (b + 1))))
    out["box: yes"] = -ODDS  # is left out in any case
    return out


def region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the run with the largest positive sum; of equal sums the
    first, as long as it goes. (0, 0) if no score is positive."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best + 1e-9 or total > 0 and abs(total - best) <= 1e-9 and start == bounds[0]:
            best, bounds = max(best, total), (start, i + 1)
    return bounds


def scores_of(items: list[Token], weights: dict[str, float]) -> list[float]:
    """Each token's score; a box's words and tags together at least -``BOX``."""
    out, spent = [], {}
    for t, names in zip(items, features(items), strict=True):
        if t.kind == "tag":
            score = weights.get(names[0], weights["tag"])
        else:
            score = weights["word"] + sum(weights.get(n, 0.0) for n in names)
            score = len(t.value.split()) * (score if t.link or t.box else max(score, LEAST))
        if t.box:
            left = BOX - spent.get(t.box, 0.0)
            score = max(min(score, 0.0), -left)
            spent[t.box] = spent.get(t.box, 0.0) - score
        out.append(score)
    return out


def widened(first: int, last: int, items: list[Token], spans: list[tuple[int, int]]) -> tuple[int, int]:
    """The article or main around the run, or else the smallest container, if the run holds most of its words."""
    around = [(items[a].value in CONTENT, a - b, a, b) for a, b in spans
              if a <= first < last <= b and items[a].value in CONTAINERS and items[a].kind == "tag"]
    if not around:
        return first, last
    *_, a, b = max(around)
    words = lambda i, j: sum(len(t.value.split()) for t in items[i:j] if t.kind == "text" and not t.box)
    return (a, b) if 2 * words(first, last) > words(a, b) else (first, last)


def extract(page: str | None, weights: dict[str, float]) -> str:
    items, spans = tokens(page or "")
    first, last = widened(*region(scores_of(items, weights)), items, spans)
    blocks, part = [], []
    for t in items[first:last]:
        if t.kind == "text":
            if not t.box:
                part.append(t.value)
        elif t.value in BLOCKS or t.value in UNSEEN:
            blocks.append("".join(part))
            part = []
        elif t.value == "br":
            part.append(" ")
    blocks.append("".join(part))
    clean = (" ".join(b.split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def fit(pages: DataFrame, html: str = "html", page_id: str = "page_id", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most ``sample`` labelled pages."""
    order = F.xxhash64(F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit("html-sample"))
    labelled = pages.where(F.size(F.regexp_extract_all(F.lower(F.col(html)), F.lit(r"<(?:article|main)\b"), F.lit(0))) == 1)
    # the hashes alone are sorted; only pages below the last one chosen go on
    last = labelled.select(order.alias("o")).orderBy("o").limit(sample).agg(F.max("o")).first()[0]
    rows = labelled.select(F.col(html).alias("html"), order.alias("o")).where(F.col("o") <= F.lit(last)).limit(sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                total.update(count_features(page))
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.string()), pa.array([i for _, i in keys], pa.bool_()),
                                          pa.array([total[k] for k in keys], pa.int64())], ["feature", "inside", "n"])

    found = rows.repartition(16, "o").mapInArrow(count, "feature string, inside boolean, n long")
    got = found.groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect()  # names of tags in the sample
    return weights_from({(r["feature"], r["inside"]): r["n"] for r in got})


def extract_pages(pages: DataFrame, weights: dict[str, float], html: str = "html") -> DataFrame:
    """Add text and n_chars to every page, in place of its html."""
    plain = drop_columns(pages, [c for c in ADDED if c.lower() != html.lower()])
    keep = [f for f in plain.schema.fields if f.name != html]
    schema = T.StructType([*keep, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            texts = [extract(p, weights) for p in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in keep], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return plain.mapInArrow(run, schema)
