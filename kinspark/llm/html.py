"""Main text of web pages by equivalence-class template deduction.

A page is read as a sequence of tokens: the elements that begin and end in it, each with
its path of block elements and their classes, and the texts of its blocks. Over all pages of a host, a
token's occurrence vector (how often each page has it) is summed up as a hash that does
not depend on the order of pages; tokens of one host with equal vectors form an equivalence
class. Classes are valid if they have at least two tokens (the page itself is one), occur in at
least SUPPORT of the host's pages, of LEAST_PAGES or more, and their tokens recur in one order on
every page. Taken by falling support, a class joins the template if, on every page, it lies in one
slot of each class before it or holds that in one of its own.

The template's texts are fixed and are taken out of every page. What stands between the tokens of
its first class that is once on every page are the page's slots; the slot with most text over the
host's pages is the content's, and the innermost element of the template around it (if that is
more than the body) is what is extracted, slot by slot, from every page. Elements that say what they
are (navigation, footers, forms, adverts, ...) are never content, wherever they are. A page without
that element, or of a host without a template, is read by itself: inside `article` or `main` where it
has them, else in the element with most text of its own.

Occurrence hashes and counts are sums by host and token, combined before the shuffle, so
a hot host is spread. Templates hold tokens that most pages of a host have, no more than a page does;
they are broadcast only if they are measured to be under BROADCAST_BYTES in all, and joined otherwise.

Defined results: null or blank html has empty text; a null url or one without `://` has
an empty host, like others a host of its own; repeated rows count once and are extracted alike; an
empty table gives an empty result; tags that are not closed are text up to the next one; added columns (text, n_chars) replace columns of those names.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from .common import cut
from .urls import parts_of

SUPPORT = 0.6
LEAST_PAGES = 5
BROADCAST_BYTES = 16_000_000

# Element and attribute words of HTML pages.
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "html head body article section main header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption form fieldset address details summary hgroup center dialog menu select option button svg template label legend".split()
)
NOT_CONTENT = {"head", "nav", "footer", "aside", "form", "fieldset", "dialog", "menu", "select", "option", "button", "svg", "template", "label", "legend"}
NOT_CONTENT_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert "
    "sidebar side rail menu nav navbar navigation topnav breadcrumb breadcrumbs footer foot comment comments discussion disqus reply replies respond "
    "share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay widget toolbar pagination pager copyright masthead skip".split()
)
NOT_CONTENT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
CONTENT_WORDS = {"article", "content", "post", "entry", "story", "main"}
HEADS = {"header", "masthead", "banner"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "body", "html", "article", "section", "main", "div", "blockquote", "form", "nav", "aside", "footer", "header", "menu", "select"}

# no part goes beyond the next "<" but quoted values, and none is tried again in another way: one pass over any text
_MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^'"<>]++|"[^"]*+"|'[^']*+')*+)>|<[!?][^<>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True)
class Block:
    key: int
    text: str
    #: In an article (2), in main or an element named as content (1), elsewhere (0).
    rank: int
    #: All of the text is in links.
    linked: bool
    #: In an element that is no content.
    out: bool
    #: The number of the element that holds it as a container.
    home: int


@dataclass(slots=True)
class _Element:
    tag: str
    key: int
    out: bool
    rank: int
    number: int
    home: int
    end: int = 0


@dataclass(slots=True)
class Event:
    token: int
    #: Of an element's begin (1) and end (-1) its number and tag; of a text (0) its block.
    step: int
    number: int = 0
    tag: str = ""
    block: Block | None = None


def token(*parts: str | int) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


@lru_cache(maxsize=4096)
def _named(tag: str, attributes: str, inside: int) -> tuple[str, bool, int]:
    """An element's name with the words of its class and id, whether it is no content, and its rank."""
    name, out, rank = tag, tag in NOT_CONTENT or (tag == "header" and inside < 1), {"article": 2, "main": 1}.get(tag, 0)
    if attributes.strip():
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), entities.unescape(value.strip("\"'")).lower()
            if key in ("class", "id"):
                words = set(_PART.split(value))
                # names with digits tell pages apart, not places
                name += "." + ".".join(sorted(w for w in value.split() if not any(map(str.isdigit, w))))
                # a content element's own name may well have such a word in it, and an article its header
                if tag not in ("html", "body", "main") and words & NOT_CONTENT_WORDS and not (inside and words & HEADS):
                    out = True
                elif words & CONTENT_WORDS and tag in ("div", "section", "td"):
                    rank = max(rank, 1)
            elif key == "role":
                out |= value in NOT_CONTENT_ROLES
                rank = max(rank, {"main": 1, "article": 2}.get(value, 0))
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                out = True
    return name, out, rank


@lru_cache(maxsize=1 << 14)
def _element(parent: int, name: str) -> tuple[int, int, int]:
    """An element's path, and the tokens of its begin and end."""
    key = token(parent, name)
    return key, token("begin", key), token("end", key)


MASK = (1 << 64) - 1
CONTAINERS = {"div", "section", "body", "td", "main", "article", "center"}


def read_page(page: str | None) -> list[Event]:
    """The page's tokens in order. Depth costs nothing: a path is a hash, and tags that close nothing are known as such."""
    page = page or ""
    stack = [_Element("", 0, False, 0, 0, 0)]
    held: Counter = Counter()
    events: list[Event] = []
    text: list[str] = []
    anchors, linked, plain, number = 0, 0, 0, 0
    at = 0

    def end_block():
        nonlocal linked, plain
        top = stack[-1]
        if text and (words := entities.unescape("".join(text)).split()):
            block = Block(top.key, " ".join(words), top.rank, plain == 0 and linked > 0, top.out, top.home)
            events.append(Event(xxhash.xxh64_intdigest(block.text.encode("utf-8", "surrogatepass"), top.key & MASK) - (1 << 63), 0, block=block))
        text.clear()
        linked = plain = 0

    def pop(k: int):
        """Close the elements from place k of the stack on."""
        while len(stack) > k:
            e = stack.pop()
            held[e.tag] -= 1
            events.append(Event(e.end, -1, e.number, e.tag))

    def add(part: str):
        nonlocal linked, plain
        if part:
            text.append(part)
            if part.strip():
                linked, plain = linked + bool(anchors), plain + (not anchors)

    while m := _MARK.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                anchors = max(0, anchors - 1)
            elif tag in BLOCKS:
                end_block()
                if held[tag]:
                    pop(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
        elif tag in RAW:
            closing = re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
            at = closing.end() if closing else len(page)
        elif tag == "a":
            anchors += 1
        elif tag in ("br", "hr"):
            add(" ")
            if tag == "hr":
                end_block()
        elif tag in BLOCKS:
            end_block()
            if stack[-1].tag == "p" and tag != "p":
                pop(len(stack) - 1)
            elif tag == "p" or tag in CLOSES:
                shut = CLOSES.get(tag, {"p"})
                k = len(stack) - 1
                while k > 0 and stack[k].tag not in SCOPES and any(held[t] for t in shut):
                    if stack[k].tag in shut:
                        pop(k)
                        if tag != "tr":
                            break
                    k -= 1
            if m[3].endswith("/"):
                continue
            top = stack[-1]
            name, out, rank = _named(tag, m[3], top.rank)
            number += 1
            key, begin, end = _element(top.key, name)
            stack.append(_Element(tag, key, top.out or out, max(rank, top.rank), number, number if tag in CONTAINERS else top.home, end))
            held[tag] += 1
            events.append(Event(begin, 1, number, tag))
    add(page[at:])
    end_block()
    pop(1)
    return events


#: The token that every page has once.
PAGE = token("page")


def tokens_of(events: list[Event]) -> Counter:
    """How often a page has each token."""
    return Counter([PAGE, *(e.token for e in events)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(h, p, t, n) for h, p, page in zip(*(c.to_pylist() for c in b.columns), strict=True) for t, n in tokens_of(read_page(page)).items()]
        if rows:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["host", "page", "token", "n"])


def _places(tokens: list[int], class_of: dict[int, int]) -> dict[int, tuple[list[tuple[int, int]], list[int], bool]]:
    """Of each class on a page: (place, token) in order, the order in which its tokens recur, and whether they do."""
    places: dict[int, list[tuple[int, int]]] = {}
    for at, t in enumerate(tokens):
        if t in class_of:
            places.setdefault(class_of[t], []).append((at, t))
    found = {}
    for c, own in places.items():
        size = len({t for _, t in own})
        order = [t for _, t in own[:size]]
        found[c] = own, order, len(set(order)) == size and [t for _, t in own] == order * (len(own) // size)
    return found


def relations(events: list[Event], class_of: dict[int, int]) -> list[tuple[int, int, int]]:
    """(a, b, how) of a page's classes. For a = b, the hash of the order in which the tokens of the class recur, 0 if in
    none; else the slot of a that holds all of b, 0 before, after or between the recurrences of a, -1 if in no one slot."""
    found, ordered = [], {}
    for c, (own, order, runs) in _places([PAGE, *(e.token for e in events)], class_of).items():
        found.append((c, c, token(*order) or 1 if runs else 0))
        if runs:
            ordered[c] = ([at for at, _ in own], len(order))
    for a, (at, size) in ordered.items():
        for b, (other, n) in ordered.items():
            if a != b:
                ends = {(bisect_left(at, other[i]), bisect_left(at, other[i + n - 1])) for i in range(0, len(other), n)}
                slots = {x % size if x == y else -1 for x, y in ends}
                found.append((a, b, slots.pop() if len(slots) == 1 else -1))
    return found


def slots(events: list[Event], class_of: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """(class, from, to, characters) of a page's slots, for classes that are on it once: the characters of texts that are
    neither in links nor in elements that are no content, and the tokens that what is extracted for the slot lies between,
    the ends of the innermost element of the class around it or, where that is the whole body, of the slot."""
    known = {e.token: e for e in events if e.step}
    found = []
    for c, (own, order, runs) in _places([PAGE, *(e.token for e in events)], class_of).items():
        if not runs or len(own) != len(order):
            continue
        chars: dict[int, int] = defaultdict(int)
        at = [a for a, _ in own]
        for i, e in enumerate(events, 1):
            if e.block and e.token not in class_of and not e.block.out and not e.block.linked and (k := bisect_left(at, i)):
                chars[k - 1] += len(e.block.text)
        around: list[tuple[int, int]] = []
        ends = {known[t].number: t for t in order if t in known and known[t].step < 0}
        for k, t in enumerate(order):
            e = known.get(t)
            if e and e.step > 0 and e.number in ends and e.tag not in ("html", "body"):
                around.append((t, ends[e.number]))
            elif around and t == around[-1][1]:
                around.pop()
            if chars[k]:
                begin, end = around[-1] if around else (t, order[k + 1] if k + 1 < len(order) else PAGE)
                found.append((c, begin, end, chars[k]))
    return found


def _relate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets: dict = {}
    for b in batches:
        rows = []
        for h, page, known in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            if h not in sets:
                sets[h] = {t["token"]: t["class"] for t in known.as_py()}
            events = read_page(page)
            rows += [(h, *r, None) for r in relations(events, sets[h])]
            rows += [(h, *r) for r in slots(events, sets[h])]
        if rows:
            kinds = [pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["host", "a", "b", "how", "chars"])


def nested(classes: list[dict], fits: set[tuple[int, int]]) -> list[int]:
    """The classes of a host's template, by falling support: those in one order on every page that lie, on every page,
    in one slot of each class taken before, or hold it in one of theirs."""
    taken: list[int] = []
    for c in sorted(classes, key=lambda c: (-c["pages"], -c["size"], c["class"])):
        k = c["class"]
        if (k, k) in fits and all((k, x) in fits or (x, k) in fits for x in taken):
            taken.append(k)
    return taken


def _nest(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for classes, fits in columns:
        yield pa.array([nested(c, {(f["a"], f["b"]) for f in x or []}) for c, x in zip(classes.to_pylist(), fits.to_pylist(), strict=True)], pa.list_(pa.int64()))


_nest.__annotations__ = {"columns": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def _small(table: DataFrame, bytes_of: Column) -> DataFrame:
    """table, broadcast if it is measured to be small."""
    return F.broadcast(table) if (table.agg(F.sum(bytes_of)).first()[0] or 0) < BROADCAST_BYTES else table


def templates(pages: DataFrame) -> DataFrame:
    """host, boilerplate (the template's tokens) and place (the tokens that the content lies between), from pages (host, page, html)."""
    from pyspark.sql.pandas.functions import arrow_udf

    rows = pages.select("host", "page", "html").mapInArrow(_count, "host string, page long, token long, n long")
    rows = rows.groupBy("host", "page", "token").agg(F.max("n").alias("n"))  # a page that is there in copies counts once
    vectors = rows.groupBy("host", "token").agg(F.count("*").alias("pages"), F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector"))
    # what fewer pages have than the least support of the smallest host is in no class
    vectors = cut(vectors.where(F.col("pages") >= SUPPORT * LEAST_PAGES))
    of_host = vectors.where(F.col("token") == PAGE).select("host", F.col("pages").alias("all")).where(F.col("all") >= LEAST_PAGES)
    held = vectors.join(of_host, "host").where(F.col("pages") >= SUPPORT * F.col("all"))
    # the classes of a host: tokens of one vector, no more than a page has
    classes = held.withColumn("class", F.xxhash64("pages", "vector")).groupBy("host", "class", "pages").agg(F.count("*").alias("size"), F.collect_list("token").alias("tokens")).where("size >= 2")
    classes = cut(classes)
    known = classes.select("host", "class", F.explode("tokens").alias("token")).groupBy("host").agg(F.collect_list(F.struct("token", "class")).alias("known"))
    known = _small(cut(known, done=[vectors]).withColumnRenamed("host", "h"), F.size("known") * 16 + 64)
    seen = pages.join(known, F.col("host") == F.col("h")).select("host", "html", "known").mapInArrow(_relate, "host string, a long, b long, how long, chars long")
    # relations: the same on every page or not; slots: characters in all
    seen = cut(seen.groupBy("host", "a", "b", F.when(F.col("chars").isNotNull(), F.col("how")).alias("to")).agg(F.min("how").alias("least"), F.max("how").alias("most"), F.sum("chars").alias("chars")))
    fits = seen.where("chars is null").where("least = most and if(a = b, least <> 0, least >= 0)").groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("fits"))
    listed = classes.groupBy("host").agg(F.collect_list(F.struct("class", "pages", "size")).alias("classes")).join(fits, "host", "left")
    taken = cut(listed.withColumn("class", arrow_udf(_nest, ArrayType(LongType()))("classes", "fits")).select("host", F.explode("class").alias("class")))
    own = classes.join(taken, ["host", "class"])
    fixed = own.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("boilerplate"))
    # of the first class that is once on every page, the slot of most text
    mass = seen.where("chars is not null").select("host", F.col("a").alias("class"), F.col("b").alias("from"), "to", "chars")
    best = mass.join(own.select("host", "class", "pages", "size"), ["host", "class"]).groupBy("host").agg(F.max(F.struct("pages", "size", "class", "chars", "from", "to")).alias("best"))
    return fixed.join(best, "host", "left").select("host", "boilerplate", F.struct("best.from", "best.to").alias("place"))


def _alone(events: list[Event]) -> list[Block]:
    """Of a page that shows no template, the texts that are its content."""
    blocks = [e.block for e in events if e.block and not e.block.out]
    if top := max((b.rank for b in blocks), default=0):
        return [b for b in blocks if b.rank == top]
    chars: Counter = Counter()
    for b in blocks:
        chars[b.home] += 0 if b.linked else len(b.text)
    home = max(chars, key=lambda k: (chars[k], -k), default=0)
    found, inside = [], home == 0
    for e in events:
        if e.step and e.number == home:
            inside = e.step > 0
        elif e.block and inside and not e.block.out and not e.block.linked:
            found.append(e.block)
    return found


def main_text(page: str | None, boilerplate: set[int], place: tuple[int, int] | None) -> str:
    events = read_page(page)
    if place and any(e.token == place[0] for e in events):
        found, inside = [], False
        for e in events:
            if inside and e.token == place[1]:
                inside = False
            elif e.token == place[0]:
                inside = True
            if inside and e.block and e.token not in boilerplate and not e.block.out:
                found.append(e.block)
        return "\n".join(b.text for b in found)
    fixed = {id(e.block) for e in events if e.block and e.token in boilerplate}
    return "\n".join(b.text for b in _alone(events) if id(b) not in fixed)


def _texts(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for pages, fixed, places in columns:
        sets: dict = {}
        out = []
        for page, own, place in zip(pages.to_pylist(), fixed, places.to_pylist(), strict=True):
            key = own.as_py() or []
            between = (place["from"], place["to"]) if place and place["from"] is not None else None
            out.append(main_text(page, sets.setdefault(tuple(key), set(key)), between))
        yield pa.array(out, pa.string())


_texts.__annotations__ = {"columns": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def extract(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """pages with text and n_chars."""
    from pyspark.sql.pandas.functions import arrow_udf

    host, _ = parts_of(F.col("url"))
    keyed = pages.withColumns({"__host": host, "__page": F.xxhash64("html")})
    found = cut(templates(keyed.select(F.col("__host").alias("host"), F.col("__page").alias("page"), "html")))
    table = _small(found, F.size("boilerplate") * 8 + 64 + F.length("host"))
    joined = keyed.join(table.select(F.col("host").alias("__h"), F.col("boilerplate").alias("__fixed"), F.col("place").alias("__place")), F.col("__host") == F.col("__h"), "left")
    out = joined.withColumn("text", arrow_udf(_texts, StringType())("html", "__fixed", "__place"))
    return out.withColumn("n_chars", F.length("text").cast("long")).drop("__host", "__page", "__h", "__fixed", "__place")


def op5_html(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
