"""Main text of HTML pages by the maximum-scoring subsequence of words and tags.

A page is read as a sequence of tags and word runs. Words score by where they
stand (plain, in a link, in a heading, ...), tags score negatively by kind; the
contiguous stretch with the greatest sum is the content region, found in one
linear scan. The weights are learnt from labelled pages by a structured
perceptron, words in plain text kept positive and tags negative. The labelled
pages are built here from templates with a marked article; a bounded sample of
pages whose own markup has exactly one ``article`` element may be added.

The region is widened to whole blocks, and to its whole ``article`` or ``main``
element if it lies in one; else to all blocks with a score above 0 of the least
``div`` or ``section`` (or the like) that holds it, and of this element's siblings of
the same kind whose own best stretch scores at least a third as much. Blocks of menus, headers, footers, sidebars,
notices, adverts, forms and comments inside it are left out. Inside an article
and of a section, a class or id tells such a block only by its whole name (all
of its words are hints or words of layout); ids of headings, paragraphs, cells
and list items, ids that may be subjects of the text and bylines tell nothing. An
inline element whose class is such a name goes as well, up to its end or that of
its block, and so do closing lines that state a copyright after an unmarked article.
Character references are decoded, white space in a block becomes one space,
blocks are joined by a line feed. The text of formulas (``math``) is text.

Defined results: null or empty html and pages without words give an empty text;
unclosed comments, scripts, styles, templates and text areas end with the page,
other unclosed elements are read on. Rows are read each for itself; other
columns are not read.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record_batches

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split())
CONTAINERS = frozenset(
    "article aside body details dialog div dl fieldset figure footer form head header html main menu nav ol p section "
    "table td th tr ul li a h1 h2 h3 h4 h5 h6 title".split())
DROPPED = frozenset(
    "script style noscript template textarea select button svg iframe object canvas audio video".split())
TO_END = frozenset("script style template textarea".split())  # these end with the page if nothing closes them
UNWANTED = frozenset("nav aside footer form menu dialog head title fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HINTS = frozenset(
    "ad ads adsbygoogle adv advert advertisement adverts advertising banner banners breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies copyright discussion disqus feedback footer footnav gdpr legal login masthead menu menubar "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo "
    "promos promoted recommended recommendations related replies reply respond responses share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription teaser teasers toolbar topbar widget widgets alert alertbox "
    "search searchbox complementary contentinfo alertdialog".split())
ARTICLE_HINTS = frozenset("comment comments reply teaser related promo ad sponsored".split())
#: Hints that are also subjects of text: as an id inside an article they need a second sign, a class or role.
SUBJECTS = frozenset(
    "alert alertbox banner banners byline consent cookie cookies copyright discussion feedback legal menu modal navigation "
    "notice notices notification overlay recommendations related response responses search sharing share skip social "
    "sponsor sponsors subscription teaser teasers widget widgets".split())
#: Words that stand beside hints in the names of page parts; a name of hints and these only is a whole match.
LAYOUT = frozenset(
    "area article articles bar block bottom box button buttons card cards center col column container content count desktop "
    "entry first fixed float floating footer form global grid group head header icon icons inline inner item items large last "
    "left link links list main media medium meta mobile more module outer page panel post posts primary region right row "
    "secondary section site slot small stories story text thread title top unit wrap wrapper zone".split())
TEXTUAL = frozenset("p li td th tr h1 h2 h3 h4 h5 h6".split())
HEADER_HINTS = frozenset("header banner masthead topbar".split())
INLINE = frozenset("abbr b cite code em font i ins label mark q s small span strong sub sup time u".split())
BOXES = frozenset("article aside blockquote center details dialog div dl fieldset figure form main section table td".split())
BARRIERS = frozenset("ul ol div section article main table nav aside body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SIBLING = 1 / 3  # of the region's score that a like sibling of its element must reach
EXCUSES = frozenset("has with no without".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:_-]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:_-]*)[^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_RAW = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for x in DROPPED}
_HINT_ATTR = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ARTICLE_ROLE = re.compile(r"""(?<![\w-])role\s*=\s*["']?(?:main|article)\b""", re.I)
_RIGHTS = re.compile(r"(?:copyright\b|©|\(c\)).*(?:©|\(c\)|\b(?:19|20)\d\d\b|reserved\b)", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(frozen=True)
class Event:
    """A tag, or a run of text; ``block`` numbers the block, ``scope`` the innermost article or main element."""
    feature: str
    words: int        # 0 for a tag
    text: str
    block: int
    scope: int
    unwanted: bool
    marked: bool      # inside the element that a labelled page marks
    box: int = 0      # the innermost element of BOXES that is open after it; 0 for none


TAG_FEATURES = {
    **dict.fromkeys("p br pre blockquote hr".split(), "tag:paragraph"),
    **dict.fromkeys("b i em strong span u small sub sup code mark q cite abbr font time".split(), "tag:inline"),
    "a": "tag:link", **dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), "tag:heading"),
    **dict.fromkeys("ul ol li dl dt dd menu".split(), "tag:list"),
    **dict.fromkeys("table thead tbody tfoot tr td th".split(), "tag:table"),
    **dict.fromkeys("article main".split(), "tag:article"), **dict.fromkeys("div section figure".split(), "tag:part"),
    **dict.fromkeys("nav aside footer header form".split(), "tag:frame"),
}
WORD_FEATURES = ("word:plain", "word:heading", "word:list", "word:link", "word:unwanted")
START = {"word:plain": 1.0, "word:heading": 1.0, "word:list": 0.5, "word:link": -0.5, "word:unwanted": -1.0,
         **dict.fromkeys(set(TAG_FEATURES.values()) | {"tag:other"}, -0.3)}


def _unwanted(name: str, attrs: str, in_article: bool) -> bool:
    if name in ("html", "body", "main"):
        return False
    if name in UNWANTED or (name == "header" and not in_article):
        return True
    if not attrs:
        return False
    if _HIDDEN.search(attrs):
        return True
    for kind, *values in _HINT_ATTR.findall(attrs):
        kind = kind.lower()
        if kind == "id" and (name in TEXTUAL or name == "a"):
            continue  # often made from the text
        for value in "".join(values).split():
            parts = {p.lower() for p in _PART.findall(value)}
            if parts & EXCUSES:
                continue
            found = parts & (ARTICLE_HINTS if name == "article" else HINTS)
            if in_article or name in ("article", "section"):
                if not parts <= HINTS | LAYOUT:
                    continue
                found -= {"byline"}
                if kind == "id" or (kind == "class" and name in TEXTUAL):
                    found -= SUBJECTS
            if found - HEADER_HINTS or (found and not in_article):
                return True
            if "header" in parts and not in_article and name != "article":
                return True
    return False


def _tokens(page: str) -> Iterator[re.Match]:
    """Comments, tags and runs of text in order; of a dropped element neither tags nor content.

    A dropped element that nothing closes is an ordinary tag, but for those of TO_END. What has no closing
    tag after one place has none after a later one, so it is looked for once.
    """
    at, size, unclosed = 0, len(page), set()
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if name in DROPPED and not (m["close"] or m["close2"]):
            if name == "svg" and (m["attrs"] or "").endswith("/"):
                continue
            closing = None if name in unclosed else _RAW[name].search(page, at)
            if closing:
                at = closing.end()
                continue
            if name in TO_END:
                return
            unclosed.add(name)
        yield m


@dataclass
class Box:
    """An element of BOXES: its parent, kind (name and class) and the events it spans; boxes are numbered as they open."""
    parent: int
    kind: tuple[str, str]
    start: int
    stop: int = -1
    last: int = -1  # the last box inside it


class Page(list):
    """The events of a page, and its boxes (the first of them stands for the page)."""

    def __init__(self) -> None:
        super().__init__()
        self.boxes = [Box(-1, ("", ""), 0)]


@dataclass(frozen=True)
class Open:
    name: str
    unwanted: bool
    scope: int
    marked: bool
    article: bool  # an article or main element, by its name or role
    box: int


class Stack:
    """The open elements. Places of each name are kept, so that nothing is looked for in the whole stack."""

    def __init__(self, page: Page, marked: bool) -> None:
        self.page, self.items, self.places = page, [Open("", False, 0, marked, False, 0)], {}
        self.articles, self.headings = 0, 0

    @property
    def top(self) -> Open:
        return self.items[-1]

    def has(self, name: str) -> bool:
        return bool(self.places.get(name))

    def push(self, item: Open) -> None:
        self.places.setdefault(item.name, []).append(len(self.items))
        if item.name in BARRIERS:
            self.places.setdefault("*", []).append(len(self.items))
        self.articles += item.article
        self.headings += item.name in HEADINGS
        self.items.append(item)

    def pop(self) -> None:
        item = self.items.pop()
        self.places[item.name].pop()
        if item.name in BARRIERS:
            self.places["*"].pop()
        self.articles -= item.article
        self.headings -= item.name in HEADINGS
        if item.box != self.top.box:
            box = self.page.boxes[item.box]
            box.stop, box.last = len(self.page), len(self.page.boxes) - 1

    def close(self, name: str, within: bool = False) -> None:
        """End the innermost element of that name, if there is one (``within`` the innermost barrier)."""
        places = self.places.get(name)
        if places and not (within and self.places.get("*") and self.places["*"][-1] > places[-1]):
            while len(self.items) > places[-1] if places else False:
                last = len(self.items) - 1 == places[-1]
                self.pop()
                if last:
                    break

    def end_inline(self) -> None:
        while self.top.name in INLINE:
            self.pop()


def events(page: str, marker: str | None = None) -> Page:
    """The page's tags and word runs in order."""
    out = Page()
    stack = Stack(out, marker is None)
    block = scopes = 0
    for m in _tokens(page):
        top = stack.top
        text = m["text"]
        if text is not None:
            text = html.unescape(text)
            if top.unwanted:
                feature = "word:unwanted"
            elif stack.has("a"):
                feature = "word:link"
            elif stack.headings:
                feature = "word:heading"
            else:
                feature = "word:list" if stack.has("li") else "word:plain"
            out.append(Event(feature, len(text.split()), text, block, top.scope, top.unwanted, top.marked, top.box))
            continue
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        close = bool(m["close"] or m["close2"])
        if name == "br":
            out.append(Event(TAG_FEATURES["br"], 0, " ", block, top.scope, top.unwanted, top.marked, top.box))
            continue
        if name in BLOCKS:
            block += 1
            stack.end_inline()
        attrs = m["attrs"] or ""
        if not close and name in CONTAINERS:
            if name in ("p", "li", "a", "td", "th", "tr") or name in HEADINGS:
                stack.close(name, within=True)  # these end an unclosed one of their kind
            elif name not in ("html", "head", "title"):
                while stack.top.name in ("p", "a", "title", "head"):
                    stack.pop()
            top = stack.top
            scope = top.scope
            if name in ("article", "main"):
                scopes += 1
                scope = scopes if not top.scope or name == "article" else top.scope
            box = top.box
            if name in BOXES:
                box = len(out.boxes)
                out.boxes.append(Box(top.box, (name, _class_of(attrs)), len(out)))
            stack.push(Open(name, top.unwanted or _unwanted(name, attrs, stack.articles > 0), scope,
                            top.marked or (marker is not None and marker in attrs),
                            name in ("article", "main") or bool(_ARTICLE_ROLE.search(attrs)), box))
        elif not close and name in INLINE and attrs and not top.unwanted and _unwanted_inline(attrs):
            stack.push(Open(name, True, top.scope, top.marked, False, top.box))
        top = stack.top
        if close and (name in CONTAINERS or name in INLINE):
            stack.close(name, within=name in INLINE)
        out.append(Event(TAG_FEATURES.get(name, "tag:other"), 0, "", block, top.scope, top.unwanted, top.marked, stack.top.box))
    while len(stack.items) > 1:
        stack.pop()
    out.boxes[0].stop, out.boxes[0].last = len(out), len(out.boxes) - 1
    return out


def _class_of(attrs: str) -> str:
    for kind, *values in _HINT_ATTR.findall(attrs):
        if kind.lower() == "class":
            return " ".join("".join(values).split())
    return ""


def _unwanted_inline(attrs: str) -> bool:
    """A class that is a hint as a whole, and no possible subject of the text."""
    for kind, *values in _HINT_ATTR.findall(attrs):
        if kind.lower() == "class":
            for value in "".join(values).split():
                parts = {p.lower() for p in _PART.findall(value)}
                if parts <= HINTS | LAYOUT and parts & (HINTS - SUBJECTS - {"byline", "header", "footer", "search", "login"}):
                    return True
    return False


def _score(e: Event, weights: dict[str, float]) -> float:
    return weights[e.feature] * (e.words if e.words or not e.feature.startswith("tag") else 1)


def best_region(sequence: list[Event], weights: dict[str, float]) -> tuple[int, int]:
    """The contiguous stretch [from, to) with the greatest score; empty if no stretch is above 0."""
    best, best_range, total, start = 0.0, (0, 0), 0.0, 0
    for i, e in enumerate(sequence):
        total += _score(e, weights)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_range = total, (start, i + 1)
    return best_range


def _held_blocks(sequence: Page, box: Box, number: int, weights: dict[str, float]) -> set[int]:
    """The blocks of a box with a score above 0."""
    scores: dict[int, float] = {}
    for e in sequence[box.start:box.stop]:
        if number <= e.box <= box.last and not e.unwanted:
            scores[e.block] = scores.get(e.block, 0.0) + _score(e, weights)
    return {b for b, x in scores.items() if x > 0}


def _widened(sequence: Page, region: tuple[int, int], weights: dict[str, float]) -> set[int]:
    """Further blocks of the least box that holds the region, and of its like siblings."""
    words = [k for k in range(*region) if sequence[k].words and not sequence[k].unwanted]
    number = min((sequence[k].box for k in range(words[0], words[-1] + 1)))  # boxes open in order: an outer one comes first
    if not number:
        return set()
    own = sequence.boxes[number]
    found = _held_blocks(sequence, own, number, weights)
    least = SIBLING * sum(_score(e, weights) for e in sequence[slice(*region)])
    for k, box in enumerate(sequence.boxes):
        if k != number and box.parent == own.parent and box.kind == own.kind:
            inside = sequence[box.start:box.stop]
            a, b = best_region(inside, weights)
            if sum(_score(e, weights) for e in inside[a:b]) >= least and any(e.words and not e.unwanted for e in inside[a:b]):
                found |= _held_blocks(sequence, box, k, weights)
    return found


def region_text(sequence: Page, region: tuple[int, int], weights: dict[str, float] | None = None) -> str:
    """The region's wanted blocks, widened to whole blocks and to the element they lie in."""
    inside = [e for e in sequence[slice(*region)] if e.words and not e.unwanted]
    if not inside:
        return ""
    scopes = {e.scope for e in inside}
    scope = scopes.pop() if len(scopes) == 1 else 0
    blocks = {e.block for e in inside}
    if not scope and weights is not None:
        blocks |= _widened(sequence, region, weights)
    first, last = min(blocks), max(blocks)
    texts: dict[int, list[str]] = {}
    for e in sequence:
        if e.unwanted or not (first <= e.block <= last or (scope and e.scope == scope)):
            continue
        texts.setdefault(e.block, []).append(e.text)
    lines = [x for x in (" ".join("".join(parts).split()) for _, parts in sorted(texts.items())) if x]
    while not scope and len(lines) > 1 and _RIGHTS.match(lines[-1]) and len(lines[-1]) < 200:
        lines.pop()
    return "\n".join(lines)


def extract(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    sequence = events(page)
    return region_text(sequence, best_region(sequence, weights), weights)


# -- learning ---------------------------------------------------------------

MARKER = "data-main-text"


def labelled_pages(count: int = 120, seed: int = 5) -> list[str]:
    """Pages from templates; the element that carries MARKER holds the article."""
    rng = random.Random(seed)

    def words(low, high):
        return " ".join("".join(rng.choice("aeioubcdlmnprst") for _ in range(rng.randint(2, 9)))
                        for _ in range(rng.randint(low, high)))

    def links(n):
        return "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(n))

    def menu():
        return rng.choice([f"<nav><ul>{links(rng.randint(3, 20))}</ul></nav>", f"<ul>{links(rng.randint(3, 12))}</ul>",
                           f'<div class="menu">{links(rng.randint(3, 9))}</div>'])

    def junk():
        return rng.choice([
            f'<div class="ad">{words(2, 25)}</div>', f'<aside><p>{words(3, 40)}</p></aside>',
            f'<div id="cookie-notice"><p>{words(5, 30)}</p></div>', f'<form><p>{words(2, 8)}</p><input name="q"></form>',
            f'<div><a href="/x">{words(2, 9)}</a> <a href="/y">{words(2, 9)}</a></div>', menu()])

    def comments():
        each = "".join(f'<div class="comment"><b>{words(1, 2)}</b><p>{words(3, 60)}</p></div>'
                       for _ in range(rng.randint(0, 6)))
        return f'<section class="comments"><h2>{words(1, 2)}</h2>{each}</section>' if each else ""

    pages = []
    for _ in range(count):
        parts = [f"<h1>{words(2, 10)}</h1>"]
        for _ in range(rng.choice([1, 1, 2, 4, 8, 16])):
            kind = rng.random()
            if kind < 0.7:
                parts.append(rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br>"]).format(words(1, 120)))
            elif kind < 0.8:
                parts.append(f"<ul><li>{words(2, 20)}</li><li>{words(2, 20)}</li></ul>")
            elif kind < 0.9:
                parts.append(f"<h2>{words(1, 6)}</h2><p>{words(5, 80)} <a href='/z'>{words(1, 3)}</a> {words(2, 20)}</p>")
            else:
                parts.append(f"<p>{words(5, 50)}</p>{junk()}<p>{words(5, 50)}</p>")
        name = rng.choice(["article", "main", "div", "section"])
        main = f"<{name} {MARKER}>{''.join(parts)}</{name}>"
        before = "".join(rng.choice([menu, junk])() for _ in range(rng.randint(1, 4)))
        after = comments() + "".join(junk() for _ in range(rng.randint(0, 3)))
        foot = rng.choice([f"<footer>&copy; {words(2, 10)}</footer>", f"<div><p>{words(2, 6)}</p></div>"])
        pages.append(f"<html><head><title>{words(2, 8)}</title></head><body><header>{words(1, 4)}</header>"
                     f"{before}{main}{after}{foot}</body></html>")
    return pages


def learn(sequences: list[list[Event]], rounds: int = 6) -> dict[str, float]:
    """Weights by an averaged structured perceptron: the true region is made to outscore the best other one."""
    weights, sums, steps = dict(START), dict.fromkeys(START, 0.0), 0
    for _ in range(rounds):
        for sequence in sequences:
            marked = [i for i, e in enumerate(sequence) if e.marked and e.words and not e.unwanted]
            if marked:
                region = best_region(sequence, weights)
                change = dict.fromkeys(START, 0.0)
                for part, sign in (((marked[0], marked[-1] + 1), 1.0), (region, -1.0)):
                    for e in sequence[slice(*part)]:
                        change[e.feature] += sign * (e.words if e.feature.startswith("word") else 1)
                size = sum(abs(x) for x in change.values())
                if size:
                    for name, x in change.items():
                        weights[name] += 0.05 * x / size
                    for name in weights:  # words in plain text are positive, tags negative
                        if name == "word:plain":
                            weights[name] = max(weights[name], 0.5)
                        elif name.startswith("tag"):
                            weights[name] = min(weights[name], -0.01)
            steps += 1
            for name, x in weights.items():
                sums[name] += x
    return {name: x / steps for name, x in sums.items()}


@dataclass
class Learner:
    """Weights from the templates, and from up to ``sample`` pages that mark their article themselves."""
    sample: int = 64
    longest: int = 200_000  # characters of a sampled page
    weights: dict[str, float] = field(default_factory=dict)

    def fit(self, pages: DataFrame) -> Learner:
        sequences = [events(p, MARKER) for p in labelled_pages()]
        opening = F.size(F.split(F.lower(pages["html"]), "<article")) - 1
        own = pages.where((opening == 1) & (F.length(pages["html"]) <= self.longest)).select(
            F.xxhash64(pages["html"]).alias("order"), pages["html"].alias("html"))
        chosen = [r["order"] for r in own.select("order").distinct().orderBy("order").limit(self.sample).collect()]
        for _, page in own.where(F.col("order").isin(chosen)).groupBy("order").agg(F.min("html")).orderBy("order").collect():
            sequences.append(events(re.sub(r"(?i)<article", f"<article {MARKER}", page), MARKER))
        self.weights = learn(sequences)
        return self


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_pages(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for page_id, url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                                              strict=True):
                    text = extract(page.as_py(), weights)
                    yield page_id, url, text, len(text)
        return record_batches(rows(), _TEXTS, 512)

    return pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        pages["html"].cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
