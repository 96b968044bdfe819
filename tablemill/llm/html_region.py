"""Main text of web pages: the contiguous region of a page with the largest score.

A page is a sequence of texts and tags.  Words score positive where content stands and tags score
negative, with weights fitted to labelled pages; one linear scan finds the run of events with the
largest sum.  Elements that are no content by their kind or name (menus, adverts, comments, scripts)
count as one tag and give no text, also inside the region.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablemill.llm.arrow_text import slices

TAG = re.compile(
    r"<!--(?P<note>.*?)(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
NAMED = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg math object video audio canvas".split())
BLOCK = set(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
SPACED = set("br td th wbr".split())
# Elements that hold no main text, and words in class, id or role that say the same.
OTHER_TAGS = set("head nav menu footer aside form button select option dialog".split())
OTHER_NAMES = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs footer contentinfo sidebar complementary widget widgets related recommended share sharing "
    "social cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login comment comments commentlist reply replies respond disqus pagination pager toolbar search skip discussion "
    "discussions reactions responses rail".split()
)
# Some of them are common in names of content too and count as the last word only: social, but not social-science.
SUBJECTS = set(
    "social related comment comments notice notices search share sharing alert menu rail reactions responses discussion "
    "discussions reply replies respond subscription complementary skip".split()
)
# Words that may follow without changing what a name says: related-posts, but not related-work.
HOLDERS = set(
    "area bar block body box button buttons container content form group holder icon icons inner item items layout left "
    "line link links list main media message outer page panel post posts right row section slot strip thread top "
    "bottom story stories text title unit wrap wrapper zone articles author count date info toggle primary secondary small "
    "large facebook twitter".split()
)
HEAD_NAMES = {"header", "masthead", "topbar"}
MAIN_NAMES = {"article", "main"}
# Elements that tell where the main part of a page is, the surest first.
MARKED = ("main", "article", "h1", "p")
# A class that begins or ends with one of these tells of another element: has-sidebar, no-comments, share-enabled.
BEFORE, AFTER = {"has", "no", "not", "with", "without"}, {"enabled", "disabled", "off"}

# Where a text stands, by the elements around it; the first that is open counts.
PLACE_OF = {"a": "link", **dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), "head"), **dict.fromkeys("li td th dt dd pre".split(), "item")}
PLACES = ("link", "head", "item", "plain")
# A block of so many words is text without a full stop as well.
MANY_WORDS = 12
SENTENCE_ENDS, CLOSING = set(".!?:;\u2026\u3002\uff01\uff1f"), "\"')]\u201d\u2019\u00bb"

# How many tags are worth a word of the same odds.
TAG_SHARE = 10

Event = tuple[str, str]


def is_other(name: str, rest: str, in_main: bool, by_name: bool = True) -> bool:
    """Whether an element holds no main text, by its kind and, if ``by_name``, by its names."""
    if name in OTHER_TAGS:
        return True
    if name == "header" and not in_main:
        return True
    if name in ("html", "body", "main"):
        return False
    if not rest:
        return False
    said = set()
    for kind, *values in NAMED.findall(rest):
        if kind.lower() != "aria-label":
            for one in "".join(values).split():
                parts = [word.lower() for word in PARTS.findall(one)]
                if parts and parts[0] not in BEFORE and parts[-1] not in AFTER:
                    while len(parts) > 1 and parts[-1] in HOLDERS:
                        parts.pop()
                    said.add(parts[-1])
                    said.update(part for part in parts[:-1] if part not in SUBJECTS)
    if name == "article":
        return "comment" in said
    if not by_name:
        return is_hidden(rest)
    return bool(said & OTHER_NAMES) or (not in_main and bool(said & HEAD_NAMES)) or is_hidden(rest)


def is_hidden(rest: str) -> bool:
    """Whether an element's attributes, not words within their values, hide it."""
    for name, *values in ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and NO_DISPLAY.search(value):
            return True
    return False


def events(page: str) -> list[Event]:
    """("tag", name), ("other", name) for a whole element without main text, ("note", comment), and texts, decoded.

    Texts are told apart by where they stand: ("article", text) inside an article or main element, ("outside",
    text) elsewhere on a page that has text in one.  On other pages: ("link", text) in a link, ("head", text) in a
    headline, ("item", text) in a list, table or preformatted text, ("short", text) in a block that is no sentence
    if the page has a block of many words, and ("plain", text).
    """
    found = list(_scan(page, _wrappers(page)))
    if any(kind == "article" and not value.isspace() for kind, value in found):
        return [("outside", value) if kind in PLACES else (kind, value) for kind, value in found]
    return _without_sentences(found)


def _without_sentences(found: list[Event]) -> list[Event]:
    """``found`` with plain texts of blocks that are no sentence as short ones, beside blocks of many words."""
    blocks, members, words = [], [], []
    for at, (kind, value) in enumerate(found):
        if kind in ("tag", "other") and value in BLOCK:
            blocks.append((members, words))
            members, words = [], []
        elif kind in PLACES:
            members.append(at)
            words += value.split()
    blocks.append((members, words))
    if not any(len(words) >= MANY_WORDS for _, words in blocks):
        return found
    for members, words in blocks:
        if len(words) < MANY_WORDS and not (len(words) > 1 and words[-1].rstrip(CLOSING)[-1:] in SENTENCE_ENDS):
            for at in members:
                if found[at][0] == "plain":
                    found[at] = ("short", found[at][1])
    return found


def _wrappers(page: str) -> set[int]:
    """Where the elements begin that hold the main part of a page, so that their names cannot leave it out.

    They hold every main element, or without one every article, or without these every h1, or without any of these,
    forms alone, all paragraphs, if there are several.  Articles beside a headline elsewhere are teasers if there are several.
    Forms may hold the main part as well.
    """
    marks: dict[str, list] = {}
    for _ in _scan(page, None, marks):
        pass
    for name in MARKED:
        if name not in marks or name == "p" and marks[name][0] < 3:
            continue
        n, first, still_open, _ = marks[name]
        around = set(first[:still_open])
        if name == "p":
            around = {at for at in around if page[at : at + 5].lower() == "<form"}
        if name == "article" and n > 1 and "h1" in marks:
            around &= set(marks["h1"][1])
        return around
    return set()


def _scan(page: str, wrappers: set[int] | None, marks: dict[str, list] | None = None) -> Iterator[Event]:
    """The events of a page, told by names as well but for ``wrappers``; without these by kind alone, filling
    ``marks``: how many elements of a kind there are, where those begin that hold the first, how many of them hold
    the last as well, and how many are open."""
    stack: list[str] = []
    begins: list[int] = []
    at, other, depth_main = 0, 0, 0
    within = dict.fromkeys(PLACES, 0)
    while at < len(page):
        found = TAG.search(page, at)
        until = found.start() if found else len(page)
        if until > at and not other:
            where = "article" if depth_main else next((place for place in PLACES if within[place]), "plain")
            yield where, html.unescape(page[at:until])
        if not found:
            return
        at = found.end()
        name = (found["name"] or "").lower()
        if found["note"] is not None:
            yield "note", found["note"]
        if not name:
            continue
        if found["end"]:
            if name in stack:
                while True:
                    gone = stack.pop()
                    begins.pop()
                    depth_main -= gone in MAIN_NAMES
                    if gone in PLACE_OF:
                        within[PLACE_OF[gone]] -= 1
                    if other and len(stack) < other:
                        other = 0
                    if gone == name:
                        break
            if not other:
                yield "tag", name
            continue
        if name in RAW:
            closed = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
            if closed or name in ("script", "style"):
                at = closed.end() if closed else len(page)
            if not other:
                yield "other", name
            continue
        if name in VOID:
            if not other:
                yield "tag", name
            continue
        if name in BLOCK and "p" in stack or name == "li" and stack and stack[-1] == "li":
            ends = "p" if name in BLOCK and "p" in stack else "li"
            while True:
                gone = stack.pop()
                begins.pop()
                if gone in PLACE_OF:
                    within[PLACE_OF[gone]] -= 1
                if other and len(stack) < other:
                    other = 0
                if gone == ends:
                    break
        if name == "body" and other and stack[other - 1 :][:1] == ["head"]:
            for gone in stack[other - 1 :]:
                if gone in PLACE_OF:
                    within[PLACE_OF[gone]] -= 1
            del stack[other - 1 :], begins[other - 1 :]
            other = 0
        stack.append(name)
        begins.append(found.start())
        for mark in marks.values() if marks else ():
            mark[3] = min(mark[3], len(stack) - 1)
        depth_main += name in MAIN_NAMES
        if name in PLACE_OF:
            within[PLACE_OF[name]] += 1
        if other:
            continue
        in_main = depth_main - (name in MAIN_NAMES) > 0 or (depth_main > 0 and name not in MAIN_NAMES)
        around = wrappers is None or found.start() in wrappers
        if not (name == "form" and around) and is_other(name, found["rest"], in_main, not around):
            other = len(stack)
            yield "other", name
        else:
            if marks is not None and name in MARKED:
                if name not in marks:
                    marks[name] = [0, begins[:-1], 0, len(stack) - 1]
                mark = marks[name]
                mark[0], mark[2] = mark[0] + 1, mark[3]
            yield "tag", name


def fit_weights(pages: Iterable[str]) -> dict[Event, float]:
    """Log-odds of standing inside the content, for words by where they stand and for tags by name.

    ``pages`` mark their content by the comments ``keep`` and ``/keep``.  Words keep the sign that the
    pages give them; tags are held below 0, and are worth a part of a word, as a page has many of them.
    """
    inside, outside, keep = Counter(), Counter(), False
    for page in pages:
        for kind, value in events(page):
            if kind == "note":
                keep = {"keep": True, "/keep": False}.get(value.strip(), keep)
                continue
            key, times = ((kind, value), 1) if kind in ("tag", "other") else ((kind, ""), len(value.split()))
            (inside if keep else outside)[key] += times
    weights = {}
    for key in inside | outside:
        odds = math.log((inside[key] + 0.5) / (outside[key] + 0.5))
        weights[key] = min(odds, -0.01) / TAG_SHARE if key[0] in ("tag", "other") else odds
    return weights


def labelled_pages() -> list[str]:
    """The pages labelled by hand that lie beside this module."""
    return [path.read_text(encoding="utf-8") for path in sorted((Path(__file__).parent / "labelled_pages").glob("*.html"))]


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the run with the largest sum, the first of equal ones; empty if none is above 0."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, best_at = total, (start, at + 1)
    return best_at


def main_text(page: str | None, weights: dict[Event, float]) -> str:
    """The blocks of the best region, white space made one space, joined by an empty line."""
    found = [event for event in events(page or "") if event[0] != "note"]
    scores = []
    for kind, value in found:
        if kind in ("tag", "other"):
            scores.append(weights.get((kind, value), -0.001))
        else:
            scores.append(weights.get((kind, ""), 0.0) * len(value.split()))
    start, end = best_region(scores)
    blocks, current = [], []
    for kind, value in found[start:end]:
        if kind == "other" or kind == "tag" and value in BLOCK:
            if kind == "other" and value not in BLOCK:
                continue
            blocks.append("".join(current))
            current = []
        elif kind == "tag":
            if value in SPACED:
                current.append(" ")
        else:
            current.append(value)
    blocks.append("".join(current))
    return "\n\n".join(block for block in (" ".join(one.split()) for one in blocks) if block)


def extract(weights: dict[Event, float]):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(page, weights) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": part.column("page_id"),
                    "url": part.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(text) for text in texts], pa.int64()),
                }
            )

    return rows


def main_texts(df: DataFrame, labelled: Iterable[str] | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``df`` (page_id, url, html).

    Weights come from ``labelled``, pages with marked content, or from those that come with the module;
    they do not depend on ``df``.  NULL and empty pages, and pages without content, have an empty text.
    Repeated rows each give a row, an empty frame none; other columns are ignored.  Each page is read
    whole, in one linear pass; nothing is shuffled.
    """
    weights = fit_weights(labelled if labelled is not None else labelled_pages())
    shaped = df.select(F.col("page_id").cast("long"), "url", "html")
    return shaped.mapInArrow(extract(weights), "page_id long, url string, text string, n_chars long")
