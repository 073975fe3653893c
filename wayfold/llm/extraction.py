"""HTML extraction by tree scoring.

A page becomes a light element tree (implied end tags and missing ends included). Parts that are never main
text are left out: by element (menus, headers and footers, sidebars, forms, scripts, ...), by the attribute hidden
and the like, or by a class, id or role that is as a whole the name of such a part (adverts, notices, comments, ...) or
a known compound, written apart or as one word; class and id never mark headings, and paragraphs only as adverts; an id marks no section, cell, item or part
that begins with a heading of that text, unless it names reader comments. A name alone does not decide, the points of the part are held against those of the page:
names of adverts, notices and the like mark nothing that holds over half of the points, unless an article outside has any;
names of reader comments mark whatever leaves a paragraph's worth outside (LEFT); names of a place (left column, bottom) mark what holds under a quarter.
Of a table row one of whose cells holds over half of the points in blocks, cells with less than a fifth of that cell's text go. Every block that holds text of its own
then passes points to its ancestors: one, one per comma, and up to three for its length, whole to its parent
(a container to itself), half to the next, less beyond, each discounted by the share of its text that
stands in links; headings pass none. The container with the most points wins; if it lies in
an article or main element, the outermost such element is the container. Beside it, whatever its tag,
every block or run of bare text with few links (LINKED) is kept, short or long, but for a copyright line. Further out, a part with few links
is kept if it has a fifth of the container's points (SHARE), is a heading in front of it, or holds a sentence of some length.

The text is that of the container and the kept siblings in page order: character references decoded,
white space in a block turned into one space, blocks joined by one space. Nothing is capped.

Defined cases: null, empty or textless pages give an empty text; pages of headings only are scored by those;
broken or cut markup is read as far as it goes; extra columns are ignored; repeated rows
are extracted one by one.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayfold.llm.common import small_batches

#: Names of HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
SKIPPED = frozenset(
    "script style template noscript iframe object svg canvas head title nav header footer aside form button select textarea input"
    " label fieldset menu dialog audio video map noembed noframes".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
PARAGRAPHS = frozenset("p pre td th blockquote li dt dd caption figcaption summary h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Fixed value: blocks beside the container are kept if less than this share of their text is in links.
LINKED = 0.25
CLOSES_P = BLOCK - frozenset("body html caption tbody td tfoot th thead tr legend".split())
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table tr tbody thead tfoot menu select html body".split())
#: Words in a class, id or role that mark a part as no main text.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar footer header masthead cookie cookies consent notice notices gdpr popup modal newsletter subscribe signup social share"
    " sharing comment comments disqus replies respond related recommended pager pagination toolbar widget widgets search login contentinfo complementary"
    " alert disclaimer outbrain taboola copyright commenters commenting reaction reactions responses".split()
)
#: Words that make a known compound with those above, as in share-bar or site-footer, and other known names.
COMPOUND = frozenset(
    "area bar block box bottom btn button buttons center column container form group icon icons inner item items js left link links list main"
    " mobile outer overlay panel primary right row secondary section site slot thread top unit user window wrap wrapper zone google".split()
)
COMPOUNDS = frozenset("related-posts related-articles related-stories recommended-posts recommended-articles post-comments post-navigation cc-window".split())
#: Names of reader comments, of adverts, and whose part they may be, as in entry-comments.
READERS = frozenset("comment comments commenters commenting disqus reaction reactions replies respond responses".split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored copyright outbrain taboola".split())
OWNERS = frozenset("article blog entry post reader readers story".split())
OWNED = READERS | ADVERTS | frozenset("footer nav navigation newsletter pager pagination promo related share sharing sidebar social".split())
#: Words that name a place beside the text, and those that may stand with them.
PLACES = frozenset("left right side rail bottom".split())
BESIDE = PLACES | frozenset("area bar block box col column content inner outer panel wrap wrapper".split())
#: Points that must be left outside of reader comments, and the share of the container's points that parts further out have.
LEFT = 1.5
SHARE = 0.2
#: A sentence of some length, and a copyright line.
SENTENCE = re.compile(r"[.!?\u3002\uff01\uff1f][\"')\]\u201d\u2019]?(?:\s|\Z)")
LONG = 80
OWNERSHIP = re.compile(r"\s*(?:copyright\s*)?(?:\u00a9|\(c\)\s*\d{4}|copyright\s+\d{4})", re.I)
#: Where an id tells a place in the text.
ANCHORED = frozenset("section dt dd li td th tr pre blockquote figure span a code".split())
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-zA-Z]+")


class Element:
    __slots__ = ("tag", "parent", "children", "skipped", "score", "marked", "anchor")

    def __init__(self, tag: str, parent: Element | None, skipped: bool) -> None:
        self.tag, self.parent, self.skipped = tag, parent, skipped
        self.children: list[Element | str] = []
        self.score = 0.0
        #: What its names mark it as, and its id, if that does.
        self.marked, self.anchor = "", ""


@lru_cache(1 << 14)
def _parted(word: str) -> tuple[str, ...]:
    """A word as it is known, or cut in a boilerplate word and a word that may stand with one, as in commentlist."""
    if word in BOILERPLATE or word in COMPOUND or word in BESIDE or word in OWNERS:
        return (word,)
    for at in range(2, len(word) - 1):
        front, back = word[:at], word[at:]
        if front in BOILERPLATE and back in COMPOUND or front in COMPOUND and back in BOILERPLATE:
            return front, back
    return (word,)


def _named(name: str) -> str:
    """What a whole name is, by its words or as a known compound of them: readers, advert, frame, place or nothing."""
    written = [w.lower() for w in WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))]
    words = [part for w in written for part in _parted(w)]
    known = not BOILERPLATE.isdisjoint(words) and all(w in BOILERPLATE or w in COMPOUND or len(w) == 1 for w in words)
    owned = not OWNED.isdisjoint(words) and all(w in OWNED or w in OWNERS or w in COMPOUND for w in words)
    if known or owned or "-".join(written) in COMPOUNDS:
        return "readers" if not READERS.isdisjoint(words) else "advert" if not ADVERTS.isdisjoint(words) else "frame"
    return "place" if not PLACES.isdisjoint(words) and all(w in BESIDE for w in words) else ""


def _attributes(tag: str, written: str) -> tuple[bool, str, str]:
    """(whether the element is hidden, what its role or class mark it as, its id if only that does)."""
    if not written or written.isspace():
        return False, "", ""
    given: dict[str, str] = {}
    for name, *value in ATTRIBUTE.findall(written):
        given.setdefault(name.lower(), "".join(value))
    hidden = "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true" or bool(NO_DISPLAY.search(given.get("style", "")))
    named = {"frame"} if any(r.lower() in BOILERPLATE for r in given.get("role", "").split()) else set()
    if tag in HEADINGS:
        return hidden, max(named, default=""), ""
    named |= {kind for kind in map(_named, given.get("class", "").split()) if kind and (tag != "p" or kind == "advert")}
    if named:
        return hidden, next(kind for kind in ("readers", "advert", "frame", "place") if kind in named), ""
    own = _named(given.get("id", "")) if tag != "p" else ""
    if tag in ANCHORED and not (tag == "section" and own == "readers"):
        own = ""
    return hidden, own, given["id"] if own else ""


def tree(page: str) -> Element:
    root = top = Element("html", None, False)
    at = 0
    while True:
        found = TOKEN.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            top.children.append(entities.unescape(text))
        if not found:
            return root
        at = found.end()
        name = found[2]
        if name is None:
            continue
        tag = name.lower()
        if found[1]:
            walk: Element | None = top
            while walk is not None and walk.tag != tag:
                # An inline end tag does not close the block that it stands in.
                walk = None if tag not in BLOCK and walk.tag in BLOCK else walk.parent
            if walk is not None and walk.parent is not None:
                top = walk.parent
            continue
        if tag in ("html", "body"):
            if tag == "body" and top.tag in ("head", "html"):
                top = root
            continue
        if tag in CLOSES_P:
            walk = top
            while walk is not None and walk.tag != "p" and (walk.tag not in BLOCK):
                walk = walk.parent
            if walk is not None and walk.tag == "p":
                top = walk.parent or root
        if tag in ITEMS:
            walk = top
            while walk is not None and walk.tag not in ITEMS[tag] and walk.tag not in SCOPES:
                walk = walk.parent
            if walk is not None and walk.tag in ITEMS[tag]:
                top = walk.parent or root
        if top.tag == "head" and tag not in ("meta", "title", "link", "script", "style", "base", "noscript", "template"):
            top = top.parent or root
        # A header or footer inside an article is part of the page's frame all the same.
        hidden, named, own = _attributes(tag, found[3]) if tag not in ("article", "main") else (False, "", "")
        made = Element(tag, top, top.skipped or tag in SKIPPED or hidden)
        made.marked, made.anchor = named, own
        top.children.append(made)
        if tag in VOID or found[3].endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if stop > at:
                made.children.append(page[at:stop])
            at = page.find(">", stop) + 1 if end else len(page)
            at = at or len(page)
            continue
        top = made


def _walk(node: Element) -> Iterator[tuple[Element, str | None, bool]]:
    """(element, its text piece or None, whether the element opens) in page order, without recursion."""
    stack: list[tuple[Element, Iterator]] = [(node, iter(node.children))]
    yield node, None, True
    while stack:
        here, rest = stack[-1]
        for child in rest:
            if isinstance(child, str):
                yield here, child, False
            elif not child.skipped:
                yield child, None, True
                stack.append((child, iter(child.children)))
                break
        else:
            stack.pop()
            yield here, None, False


def blocks(node: Element) -> list[str]:
    """Texts of the blocks under a node, in page order."""
    out: list[str] = []
    now: list[str] = []
    for element, text, _ in _walk(node):
        if text is not None:
            now.append(text)
        elif element.tag in BLOCK or element.tag == "br":
            if element.tag == "br":
                now.append(" ")
            elif now:
                out.append(" ".join("".join(now).split()))
                now = []
    out.append(" ".join("".join(now).split()))
    return [b for b in out if b]


def _heading(element: Element) -> str:
    """The text of the heading that an element begins with, as an id."""
    for child in element.children:
        if not isinstance(child, str):
            return "-".join(w.lower() for w in WORDS.findall(" ".join(blocks(child)))) if child.tag in HEADINGS else ""
        if not child.isspace():
            break
    return ""


def _skip_marked(root: Element) -> None:
    """Skips what class, id or role mark, by the points that it holds, but for parts whose id was made from their heading."""
    elements = [e for e, text, opens in _walk(root) if opens and text is None]
    marked = [e for e in elements if e.marked]
    marked = [e for e in marked if e.marked == "readers" or not e.anchor or "-".join(w.lower() for w in WORDS.findall(e.anchor)) != _heading(e)]
    cells = [e for e in elements if e.tag in ("td", "th")]
    if not marked and not cells:
        return
    points, inside, around = _held(root)
    every = points.get(id(root), 0.0)
    for e in marked:
        own = points.get(id(e), 0.0)
        if e.marked == "readers":
            e.skipped = every - own >= LEFT
        elif e.marked == "place":
            e.skipped = own < every / 4
        if e.marked in ("advert", "frame") or not e.skipped and e.marked == "readers":
            e.skipped = own <= every / 2 or inside[id(root)] > inside[id(e)] + around[id(e)]
    if cells:
        _skip_cells(root, cells)


def _skip_cells(root: Element, cells: list[Element]) -> None:
    """Skips the small cells beside one that holds over half of the page's points in blocks: that row lays out the page."""
    given, sums = _measure(root)
    points = _held(root, given)[0]
    for e in cells:
        own = points.get(id(e), 0.0)
        inner = sum(not isinstance(c, str) and c.tag in BLOCK and not c.skipped for c in e.children)
        if not e.skipped and inner > 1 and e.parent is not None and own > points.get(id(root), 0.0) / 2:
            for beside in e.parent.children:
                if not isinstance(beside, str) and not beside.skipped and beside.tag in ("td", "th") and sums[id(beside)][0] < SHARE * sums[id(e)][0]:
                    beside.skipped = True


def _held(root: Element, given: list[tuple[Element, float]] | None = None) -> tuple[dict[int, float], dict[int, int], dict[int, int]]:
    """By element: the points that it holds, the articles with points in it, and the articles around it."""
    points = {id(e): own for e, own in (_measure(root)[0] if given is None else given)}
    inside: dict[int, int] = {}
    around: dict[int, int] = {}
    for element, text, opens in _walk(root):
        here, up = id(element), id(element.parent)
        if text is None and opens:
            around[here] = around.get(up, 0) + (element.parent is not None and element.parent.tag in ("article", "main"))
        elif text is None:
            inside[here] = inside.get(here, 0) + (element.tag in ("article", "main") and points.get(here, 0.0) > 0)
            if element.parent is not None:
                points[up] = points.get(up, 0.0) + points.get(here, 0.0)
                inside[up] = inside.get(up, 0) + inside[here]
    return points, inside, around


def _measure(root: Element) -> tuple[list[tuple[Element, float]], dict[int, list[float]]]:
    """Blocks that hold text with their points, and (text length, text length in links, commas) of every element."""
    sums: dict[int, list[float]] = {}
    # The same of the text that no block further in holds.
    own: dict[int, list[float]] = {}
    around: list[Element] = []
    order: list[Element] = []
    links = 0
    for element, text, opens in _walk(root):
        if text is not None:
            squeezed = " ".join(text.split())
            if squeezed:
                for part in (sums[id(element)], own[id(around[-1])]):
                    part[0] += len(squeezed)
                    part[1] += len(squeezed) if links else 0
                    part[2] += squeezed.count(",")
        elif opens:
            sums[id(element)] = [0, 0, 0]
            links += element.tag == "a"
            if element.tag in BLOCK:
                own[id(element)] = [0, 0, 0]
                around.append(element)
                order.append(element)
        else:
            links -= element.tag == "a"
            if element.tag in BLOCK:
                around.pop()
            if element.parent is not None and id(element.parent) in sums:
                up = sums[id(element.parent)]
                for i, value in enumerate(sums[id(element)]):
                    up[i] += value
    filled = [e for e in order if own[id(e)][0]]
    filled = [e for e in filled if e.tag not in HEADINGS] or filled
    return [(e, (1 + commas + min(length / 100, 3)) * (1 - linked / length)) for e in filled for length, linked, commas in [own[id(e)]]], sums


def _scores(root: Element) -> tuple[list[Element], dict[int, list[float]], dict[int, float]]:
    """Elements with points, the lengths of every element, and the points that it holds."""
    scored: dict[int, Element] = {}
    given, sums = _measure(root)
    for e, points in given:
        parent, share, level = (e.parent or e) if e.tag in PARAGRAPHS else e, 1.0, 0
        while parent is not None and level < 4:
            parent.score += points * share
            scored[id(parent)] = parent
            parent, level = parent.parent, level + 1
            share = 0.5 / level
    return list(scored.values()), sums, _held(root, given)[0]


def _runs(node: Element, here: Element) -> Iterator[Element]:
    """``here`` and a node's blocks, and what stands between them as one element each."""
    run: list[Element | str] = []
    for child in node.children:
        if child is here or not isinstance(child, str) and child.tag in BLOCK:
            if run:
                yield _between(node, run)
                run = []
            if not child.skipped:
                yield child
        elif isinstance(child, str) or not child.skipped:
            run.append(child)
    if run:
        yield _between(node, run)


def _between(node: Element, run: list[Element | str]) -> Element:
    made = Element("span", node, False)
    made.children = run
    return made


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = tree(page)
    _skip_marked(root)
    candidates, sums, points = _scores(root)
    if not candidates:
        return ""

    def lengths(e: Element) -> tuple[float, float]:
        if id(e) in sums:
            return sums[id(e)][0], sums[id(e)][1]
        length = linked = 0
        for c in e.children:
            more = (len(" ".join(c.split())), 0) if isinstance(c, str) else lengths(c)
            length, linked = length + more[0], linked + more[1]
        return length, linked

    def density(e: Element) -> float:
        length, linked = lengths(e)
        return linked / length if length else 0.0

    best = max(candidates, key=lambda e: e.score * (1 - density(e)))
    walk: Element | None = best
    while walk is not None:
        if walk.tag in ("article", "main"):
            best = walk
        walk = walk.parent
    def belongs(part: Element, level: int, seen: bool) -> bool:
        if not lengths(part)[0] or density(part) >= LINKED:
            return False
        texts = blocks(part)
        if all(map(OWNERSHIP.match, texts)):
            return False
        return (
            level == 0
            or points.get(id(part), 0.0) >= SHARE * points.get(id(best), 0.0)
            or not seen and part.tag in HEADINGS
            or any(len(t) >= LONG and SENTENCE.search(t) for t in texts)
        )

    # From the container outwards, so that an article in several containers comes back whole.
    parts, here, level = deque([best]), best, 0
    while here.parent is not None:
        before, after, seen = [], [], False
        for s in _runs(here.parent, here):
            if s is here:
                seen = True
                continue
            if belongs(s, level, seen):
                (after if seen else before).append(s)
        parts.extendleft(reversed(before))
        parts.extend(after)
        # A container of nothing else is no step outwards.
        level += sum(not c.isspace() if isinstance(c, str) else not c.skipped for c in here.parent.children) > 1
        here = here.parent
    return " ".join(b for p in parts for b in blocks(p))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], ["id", "url", "text", "n_chars"])

    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(run, f"{own}, text string, n_chars bigint").select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
