"""Main text of web pages: structure first, then a suffix array per host.

A page's visible blocks fall in three zones: the article (``article``, else
``main``), known furniture (menus, headers, footers, sidebars, notices, adverts,
forms, reader comments; an article's own ``header`` and ``footer`` are such, with any
headline in them), and the rest.  Furniture within a line, as a hidden ``span`` or a
``button``, goes from its block; an ``article`` that its class, role or state marks as a
comment, advert or hidden is furniture.  A page is parsed in time linear in its length.  All pages take one path: structure
names the blocks that may be main text (the article's; the rest, where no article has
text); those of every page, an article's too, are asked for runs that the host repeats, and
what these show to be furniture is cut from them.  Outside
articles, what repeats across distinct pages of the host goes.  In an article, whole
blocks in a row of ``min_tokens`` tokens at least go if runs of that length cover them
that repeat outside articles on distinct pages of the host and stand in such rows of two articles
of different text as well: a notice set into every article, not a teaser of this one, nor
what two articles quote, nor a headline that is an advert elsewhere.  Pages are distinct if
any of their visible text differs, so a host that sets the same menu and footer around every
article is many pages.  Two kinds of runs
count outside articles: runs of ``min_tokens`` tokens wherever they stand,
and whole blocks in a row (from a block's start to a block's end, on both pages) of
``block_tokens`` tokens at least.  A shorter phrase inside a block is never cut,
however many pages share it.

Long repeats are found with suffix arrays over the token streams of all pages outside
articles, furniture and what stands beside an article in ``main`` included.  Each task concatenates its pages' streams host by
host, sorts the suffixes by their first ``min_tokens`` tokens (prefix doubling;
deeper order is never needed), and neighbours that agree on them are one run.
A run leaves the task as one row with the smallest and largest page it occurs
in, so a hot host's menu is a row per task, and Spark merges runs by (host, run).
Whole blocks are merged in the same way: of them, only the shortest rows of blocks
that reach ``block_tokens`` from each start and back from each end are compared,
since these cover every longer one.  No host is ever gathered in one place.
"""

from __future__ import annotations

import html as htmllib
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import passes_columns
from ..operators.joins import broadcast_if_small
from ..session import scratch_path
from .arrow import map_arrow

MIN_TOKENS = 50            # a repeat anywhere in the text
BLOCK_TOKENS = 6           # a repeat of whole blocks
STREAM_TOKENS = 1 << 20    # tokens in one task's suffix array
SPAN_ROWS = 1 << 16        # spans in one Arrow batch
SMALL_RUNS = 500_000       # repeated runs that are broadcast
JOINER = "\n\n"

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template iframe desc metadata annotation annotation-xml".split())
TO_END = frozenset("script style textarea".split())      # raw to the page's end if never closed
CHOICES = frozenset("select datalist option optgroup".split())
APART = frozenset("svg text math iframe object audio video canvas noscript".split())    # not one word with what is beside
BLOCKS = frozenset(("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary "
                    "table tbody tfoot thead tr ul caption").split())
FURNITURE = frozenset("nav header footer aside form menu dialog button fieldset label".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
HINTS = frozenset(("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
                   "sidebar nav navbar navigation menu breadcrumb breadcrumbs footer header masthead comment comments "
                   "disqus related share sharing social cookie cookies consent gdpr newsletter subscribe subscription "
                   "signup popup modal overlay notice notices disclaimer alert widget widgets toolbar pagination pager "
                   "login search commentlist").split())
HINT_PARTS = frozenset(("ad ads advert sponsor sidebar nav navbar menu breadcrumb breadcrumbs footer comment comments "
                        "cookie cookies newsletter related promo notice alert").split())
#: Furniture in which a nested ``article`` is not the page's own; a dot marks words of class and id.
HOLDING = frozenset("aside .comment .comments .disqus .related .sidebar .widget .widgets".split())
#: Beside one of these, a word as ``sidebar-right`` says where the sidebar is, not what the element is.
CONTENT = frozenset("content main page layout primary article".split())

_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_SPECIAL = re.compile("[>\"']")
#: Most tags: no ``<`` in them and quotes that pair up; an attempt never passes the next ``<``.
_PLAIN = re.compile(r"<(/?)([A-Za-z][^\s/><\"']*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>")
_ATTR = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_BORDER = rf"</?(?:{'|'.join(sorted(BLOCKS - {'hr', 'legend'}))})[\s/>]"
#: Where the choices of a form end: at their end tag, else before the next block or choice.
_CHOICE_END = {name: re.compile(rf"</{name}\s*>|(?={_BORDER})" + (r"|(?=<option[\s/>]|<optgroup[\s/>]|</select|</datalist)"
                                                                  if name in ("option", "optgroup") else ""), re.I)
               for name in CHOICES}


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _furniture(name: str, attrs: str) -> str | None:
    """What kind of furniture a start tag opens, if any."""
    if name in FURNITURE:
        return name
    if not attrs.strip() or name in ("html", "body", "main"):
        return None
    found = {}
    for m in _ATTR.finditer(attrs):
        value = m[2] or ""
        found.setdefault(m[1].lower(), htmllib.unescape(value[1:-1] if value[:1] in "\"'" and value else value))
    if found.get("role", "").lower() in ROLES:
        return "role"
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return "hidden"
    named = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    layout = any(CONTENT & set(re.split(r"[-_]+", w)) for w in named if "sidebar" not in w)
    for word in named:
        if word in HINTS:
            return f".{word}"
        parts = re.split(r"[-_]+", word)
        if len(parts) > 1 and not {"no", "has", "with", "without"} & set(parts):
            for edge in (parts[0], parts[-1]):
                if edge in HINT_PARTS and not (edge == "sidebar" and layout):
                    return f".{edge}"
    return None


class _Tags:
    """The tags of a page by one forward scan.

    A tag ends at the next ``>`` outside quotes, or at the next at all where quotes never
    pair up.  What follows a quote or ``>`` outside quotes depends on its place alone, so
    it is worked out once a place; behind the page's last ``>`` there are no tags.  Thus
    no text is gone over again for every ``<``."""

    def __init__(self, page: str):
        self.page, self.last, self.ends = page, page.rfind(">"), {}

    def _end(self, at: int) -> int:
        """The ``>`` that ends a tag whose attributes begin at ``at``, or -1."""
        path = []
        while True:
            m = _SPECIAL.search(self.page, at)
            if m is None:
                end = -1
                break
            place = m.start()
            if place in self.ends:
                end = self.ends[place]
                break
            path.append(place)
            if m[0] == ">":
                end = place
                break
            pair = self.page.find(m[0], place + 1)
            if pair < 0:
                end = -1
                break
            at = pair + 1
        for place in path:
            self.ends[place] = end
        return end

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """``begin, end, name, is an end tag, attributes`` of the next tag, comment or
        declaration (these without a name) from ``at`` on."""
        page = self.page
        while (begin := page.find("<", at)) >= 0:
            if m := _PLAIN.match(page, begin):
                return begin, m.end(), m[2].lower(), m[1] == "/", m[3]
            if page.startswith("<!--", begin):
                end = page.find("-->", begin + 4)
                return begin, len(page) if end < 0 else end + 3, "", False, ""
            if begin > self.last:       # only a comment can follow
                begin = page.find("<!--", begin)
                return None if begin < 0 else (begin, len(page), "", False, "")
            if m := _NAME.match(page, begin):
                end = self._end(m.end())
                if end < 0:
                    end = page.index(">", m.end())
                return begin, end + 1, m[1].lower(), page[begin + 1] == "/", page[m.end():end]
            if page[begin + 1:begin + 2] in ("!", "?", "/"):
                end = page.find(">", begin + 2)
                if end >= 0:
                    return begin, end + 1, "", False, ""
            at = begin + 1
        return None


class _Stack:
    """Open elements with the furniture they open, and what is asked of them all kept
    as they come and go: the places of every name, the furniture, and its kinds."""

    def __init__(self):
        self.items: list[tuple[str, str | None]] = []
        self.places: dict[str, list[int]] = {n: [] for n in ("article", "main", "li", "ul", "ol", "p", "svg", "math")}
        self.furniture: list[int] = []
        self.kinds: dict[str, int] = {}

    def push(self, name: str, kind: str | None) -> None:
        at = len(self.items)
        self.items.append((name, kind))
        if name in self.places:
            self.places[name].append(at)
        else:
            self.places[name] = [at]
        if kind:
            self.furniture.append(at)
            self.kinds[kind] = self.kinds.get(kind, 0) + 1

    def cut(self, at: int) -> None:
        """Close the element at ``at`` and all inside it."""
        while len(self.items) > at:
            name, kind = self.items.pop()
            self.places[name].pop()
            if kind:
                self.furniture.pop()
                self.kinds[kind] -= 1

    def last(self, *names: str) -> int:
        """The place of the innermost of these, or -1."""
        place = -1
        for name in names:
            if (some := self.places.get(name)) and some[-1] > place:
                place = some[-1]
        return place

    def holding(self) -> set[str]:
        return {k for k in HOLDING if self.kinds.get(k)}


def blocks(page: str | None) -> list[tuple[str, str]]:
    """``(zone, text)`` of the page's visible blocks in order; zone is ``article``,
    ``main``, ``rest`` or ``furniture``.  Character references are decoded, white
    space is one space, and blocks without text are left out.

    If the only articles stand inside what class or id names a sidebar or the like,
    that name may tell the layout: the single article is the page's own if it has as
    many words as the unmarked text, and all are if there is no such text."""
    found, held = _parse(page or "", False)
    if held and not marked(found):
        freed, _ = _parse(page or "", True)
        own, rest = (sum(len(t.split()) for z, t in some if z in zones)
                     for some, zones in ((freed, ("article", "main")), (found, ("rest",))))
        if not rest or held == 1 and own >= rest:
            return freed
    return found


def marked(found: list[tuple[str, str]]) -> list[str]:
    """The blocks of the article, else of ``main``; none if neither has text."""
    for wanted in ("article", "main"):
        if some := [t for z, t in found if z == wanted]:
            return some
    return []


def _parse(page: str, free: bool) -> tuple[list[tuple[str, str]], int]:
    """The blocks, and how many articles only a class or id holds; ``free`` lets these be the page's own."""
    held = 0
    stack, tags = _Stack(), _Tags(page)
    articles, mains, furniture, items = stack.places["article"], stack.places["main"], stack.furniture, stack.places["li"]
    paragraphs = stack.places["p"]
    out, words, aside, at = [], [], [], 0
    no_end: set[str] = set()      # raw elements that no end tag follows any more

    def say(text: str) -> None:
        """Text belongs to the furniture it stands in, also within a line."""
        (aside if furniture else words).append(text)

    def close() -> None:
        zone = "article" if articles else "main" if mains else "rest"
        for some, kind in ((words, zone), (aside, "furniture")):
            if some:
                text = " ".join("".join(some).split())
                if text:
                    out.append((kind, text))
                some.clear()

    while at < len(page):
        tag = tags.next(at)
        if tag is None:
            say(htmllib.unescape(page[at:]))
            break
        begin, end, name, ends, attrs = tag
        if begin > at:
            say(htmllib.unescape(page[at:begin]))
        at = end
        if not name:
            continue
        if name in APART:
            say(" ")
        if ends:
            if name in BLOCKS:
                close()
            place = stack.last(name)
            # a stray inline end tag closes nothing beyond an article
            if place >= 0 and (name in BLOCKS or stack.last("article", "main") < place):
                stack.cut(place)
            continue
        if attrs[-1:] == "/" and (name in RAW - TO_END or name in ("svg", "math") or stack.last("svg", "math") >= 0):
            continue                                   # closed in its start tag
        if name in RAW:
            found = None if name in no_end else re.compile(rf"</{name}(?![^\s/>])[^>]*>", re.I).search(page, at, tags.last + 1)
            if found is None:
                no_end.add(name)
            at = found.end() if found else len(page) if name in TO_END else at
            continue
        if name in CHOICES:
            found = _CHOICE_END[name].search(page, at)
            at = found.end() if found else len(page)
            say(" ")
            continue
        kind = _furniture(name, attrs) if attrs or name in FURNITURE else None
        if name in BLOCKS:
            close()
            if name in ("article", "main") and furniture:   # an unclosed menu or header does not hold the article
                holding = stack.holding()
                classed = holding and "aside" not in holding and stack.last("article", "main") < 0
                held += bool(classed)
                if not holding or classed and free:
                    stack.cut(furniture[0])
            if name == "article" and kind and kind.startswith(".") and stack.last("article", "main") < 0:
                held += not furniture                  # only its class says that it is no article
                kind = None if free else kind
            if name == "li" and items and stack.last("ul", "ol") < items[-1]:
                stack.cut(items[-1])
            elif paragraphs and name not in ("html", "body"):
                stack.cut(paragraphs[-1])
        elif name in ("br", "td", "th", "img", "wbr", "input"):
            say("" if name == "wbr" else " ")
        if name not in VOID:
            stack.push(name, kind)
    close()
    return out, held


def article_text(page: str | None) -> str:
    """The blocks of the page's article, else of ``main``, joined by two line feeds."""
    return JOINER.join(marked(blocks(page)))


def _hashes(tokens: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t.encode()) for t in tokens), np.uint64, len(tokens))


def run_key(tokens: list[str], begin: int, size: int) -> int:
    """A signed 64-bit key of the ``size`` tokens from ``begin`` on."""
    key = xxhash.xxh64_intdigest(" ".join(tokens[begin:begin + size]).encode(), 4)
    return key - (1 << 64) if key >> 63 else key


def suffix_runs(streams: list[np.ndarray], size: int):
    """Suffix array of the concatenated streams, sorted to depth ``size``.

    Returns ``(order, first)``: the suffix positions that have ``size`` tokens in
    their own stream, as ``(stream, offset)`` rows in suffix order, and for each
    whether it starts a new run (differs from its predecessor within ``size`` tokens)."""
    lengths = np.array([len(s) for s in streams])
    whole = np.concatenate(streams)
    _, rank = np.unique(whole, return_inverse=True)
    have = 1
    while have < size:                                  # prefix doubling, the last step overlapping
        step = min(have, size - have)
        after = np.concatenate([rank[step:], np.full(min(step, len(rank)), -1)])[:len(rank)]
        _, rank = np.unique(rank * np.int64(len(whole) + 1) + after + 1, return_inverse=True)
        have += step
    begins = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(streams)), lengths)
    offset = np.arange(len(whole)) - begins[owner]
    inside = np.flatnonzero(offset + size <= lengths[owner])
    order = inside[np.argsort(rank[inside], kind="stable")]
    first = np.ones(len(order), bool)
    first[1:] = rank[order][1:] != rank[order][:-1]
    return np.stack([owner[order], offset[order]], axis=1), first


def border_spans(lengths: list[int], size: int) -> np.ndarray:
    """``(begin, end)`` token spans of whole blocks in a row: from each block's start the
    shortest of ``size`` tokens at least, and back from each block's end.

    Every row of whole blocks with so many tokens is the union of such spans inside it."""
    borders = [0, *accumulate(lengths)]
    found, end, begin = set(), 0, 0
    for at in borders[:-1]:
        while end < len(borders) and borders[end] < at + size:
            end += 1
        if end == len(borders):
            break
        found.add((at, borders[end]))
    for at in borders[1:]:
        if at < size:
            continue
        while borders[begin + 1] <= at - size:
            begin += 1
        found.add((borders[begin], at))
    return np.array(sorted(found), np.int64).reshape(-1, 2)


def _zones(url: str | None, found: list[tuple[str, str]]) -> tuple[int, int, int, bool, list[str], list[str], list[str]]:
    """``host, page, key, marked, furniture, rest, main``: the host; the page, known by all its visible
    text; the key that its main text's repeats go by; whether an article is marked; the blocks of
    furniture, of the rest, and those that may be main text: the article's, known by their text, else the rest."""
    own, furniture = marked(found), [t for z, t in found if z == "furniture"]
    zone = "article" if any(z == "article" for z, _ in found) else "main"
    rest = [t for z, t in found if z not in ("furniture", zone)]
    host = xxhash.xxh64_intdigest(host_of(url).encode()) >> 1
    page = xxhash.xxh64_intdigest(JOINER.join([*furniture, "", *rest, "", *own]).encode(), 1) >> 1
    key = xxhash.xxh64_intdigest(JOINER.join(own).encode(), 3) >> 1 if own else page
    return host, page, key, bool(own), furniture, rest, own or rest


def _flat(stream: list[list[str]]) -> list[str]:
    return [w for block in stream for w in block]


def _border_keys(stream: list[list[str]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The stream's whole-block spans and a 64-bit key of each one's tokens."""
    spans, tokens = border_spans([len(b) for b in stream], size), _flat(stream)
    keys = [xxhash.xxh64_intdigest(" ".join(tokens[b:e]).encode(), 2) for b, e in spans.tolist()]
    return spans, np.array(keys, np.uint64).view(np.int64)


def zones(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """What ``_zones`` tells of every page with text; ``main`` is empty where it is the rest."""
    rows = pages.select(F.col(f"`{url_col}`").cast("string"), F.col(f"`{html_col}`").cast("string"))
    texts = pa.list_(pa.string())
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), texts, texts, texts]
    names = ["host", "page", "key", "marked", "furniture", "rest", "main"]

    def run(batches):
        for b in batches:
            out = [[] for _ in names]
            for url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if found := blocks(page):
                    *row, is_marked, furniture, rest, main = _zones(url, found)
                    for o, v in zip(out, (*row, is_marked, furniture, rest, main if is_marked else [])):
                        o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=names)

    schema = ("host BIGINT, page BIGINT, key BIGINT, marked BOOLEAN, furniture ARRAY<STRING>, rest ARRAY<STRING>, "
              "main ARRAY<STRING>")
    path = scratch_path(pages.sparkSession, "page-zones")
    map_arrow(rows, run, schema).write.parquet(path)
    return pages.sparkSession.read.schema(schema).parquet(path)


def repeated_runs(outside: DataFrame, min_tokens: int, block_tokens: int) -> DataFrame:
    """``host, run, long`` (1 or 0) of long runs and of whole blocks that occur outside articles in two distinct
    pages of a host, kept in the shared folder."""

    def bounds(host, keys, pages_, at, is_long):
        """One row a run, from its key and smallest and largest page; runs begin at ``at``."""
        return (np.full(len(at), host, np.int64), keys, np.minimum.reduceat(pages_, at), np.maximum.reduceat(pages_, at),
                np.full(len(at), is_long, np.int64))

    def runs(hosts: dict[int, list[tuple[int, list[str], np.ndarray]]]):
        out = []
        for host, streams in hosts.items():
            border = np.concatenate([k for _, _, k in streams])
            if len(border):
                order = np.argsort(border, kind="stable")
                border = border[order]
                pages_ = np.repeat(np.array([p for p, _, _ in streams], np.int64), [len(k) for _, _, k in streams])[order]
                at = np.flatnonzero(np.concatenate([[True], border[1:] != border[:-1]]))
                out.append(bounds(host, border[at], pages_, at, 0))
            streams = [s for s in streams if len(s[1]) >= min_tokens]
            if not streams:
                continue
            order, first = suffix_runs([_hashes(t) for _, t, _ in streams], min_tokens)
            pages_ = np.array([p for p, _, _ in streams], np.int64)[order[:, 0]]
            at = np.flatnonzero(first)
            out.append(bounds(host, np.array([run_key(streams[s][1], o, min_tokens) for s, o in order[at].tolist()], np.int64),
                              pages_, at, 1))
        cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=["host", "run", "lo", "hi", "long"])

    def run(batches):
        hosts, held = {}, 0
        for b in batches:
            for host, key, *streams in zip(*(c.to_pylist() for c in b.columns)):
                for stream in streams:
                    if stream:
                        parts = [t.split() for t in stream]
                        tokens = _flat(parts)
                        hosts.setdefault(host, []).append((key, tokens if len(tokens) >= min_tokens else [],
                                                           _border_keys(parts, block_tokens)[1]))
                        held += len(tokens)
                if held >= STREAM_TOKENS:
                    yield runs(hosts)
                    hosts, held = {}, 0
        yield runs(hosts)

    local = map_arrow(outside.select("host", "page", "furniture", "rest"), run, "host BIGINT, run BIGINT, lo BIGINT, hi BIGINT, long BIGINT")
    path = scratch_path(outside.sparkSession, "page-repeats")
    (local.groupBy("host", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("long").alias("long"))
     .filter("lo != hi").select("host", "run", "long").write.parquet(path))
    return outside.sparkSession.read.schema("host BIGINT, run BIGINT, long BIGINT").parquet(path)


_SPANS = "host BIGINT, page BIGINT, marked BOOLEAN, pos BIGINT, upto BIGINT, run BIGINT, n BIGINT, place BIGINT"


def asked_spans(found: DataFrame, min_tokens: int, block_tokens: int) -> DataFrame:
    """``host, page, marked, pos, upto, run, n, place``: what the main text of every page is asked for.

    A marked article's spans are its shortest rows of whole blocks that reach ``min_tokens``, each
    covered by ``n`` runs side by side, not asked for a run from every token; other pages' are
    every run of ``min_tokens`` and the rows of whole blocks of ``block_tokens``."""
    names = ["host", "page", "marked", "pos", "upto", "run", "n", "place"]

    def spans(is_marked: bool, main: list[str]):
        parts = [t.split() for t in main]
        tokens = _flat(parts)
        if is_marked:
            if len(tokens) >= min_tokens:
                for begin, end in border_spans([len(p) for p in parts], min_tokens).tolist():
                    places = [*range(begin, end - min_tokens, min_tokens), end - min_tokens]
                    for i, at in enumerate(places):
                        yield begin, end, run_key(tokens, at, min_tokens), len(places), i
            return
        for at in range(len(tokens) - min_tokens + 1):
            yield at, at + min_tokens, run_key(tokens, at, min_tokens), 1, 0
        whole, keys = _border_keys(parts, block_tokens)
        for (begin, end), key in zip(whole.tolist(), keys.tolist()):
            yield begin, end, key, 1, 0

    def batch(rows):
        cols = [*zip(*rows)] or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if n == "marked" else pa.int64()) for n, c in zip(names, cols)],
                                          names=names)

    def run(batches):
        rows = []
        for b in batches:
            for host, page, is_marked, main in zip(*(c.to_pylist() for c in b.columns)):
                for span in spans(is_marked, main):
                    rows.append((host, page, is_marked, *span))
                    if len(rows) == SPAN_ROWS:
                        yield batch(rows)
                        rows = []
        yield batch(rows)

    main = F.when(F.col("marked"), F.col("main")).otherwise(F.col("rest"))
    return map_arrow(found.select("host", F.col("key").alias("page"), "marked", main.alias("main")), run, _SPANS)


def repeated_spans(found: DataFrame, repeated: DataFrame, min_tokens: int, block_tokens: int) -> DataFrame:
    """``host, page, pos, upto``: the spans of every page's main text (``page`` is its key) that go.

    Outside articles, one run that repeats on the host is enough.  In an article all of a span's
    runs must be long ones that repeat outside articles and stand in two articles of different text."""
    spark, path = found.sparkSession, scratch_path(found.sparkSession, "page-spans")
    (asked_spans(found, min_tokens, block_tokens).join(broadcast_if_small(repeated, SMALL_RUNS), ["host", "run"])
     .filter("NOT marked OR long = 1").select("host", "page", "marked", "pos", "upto", "run", "n", "place").write.parquet(path))
    met = spark.read.schema(_SPANS).parquet(path)
    inside = met.filter("marked")
    common = (inside.groupBy("host", "run").agg(F.min("page").alias("lo"), F.max("page").alias("hi"))
              .filter("lo != hi").select("host", "run"))
    covered = (inside.join(common, ["host", "run"]).groupBy("host", "page", "pos", "upto", "n")
               .agg(F.countDistinct("place").alias("met"))          # copies of an article give its runs again
               .filter("met = n"))
    return (met.filter("NOT marked").select("host", "page", "pos", "upto")
            .unionAll(covered.select("host", "page", "pos", "upto")))


@passes_columns
def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", out_col: str = "main_text",
            min_tokens: int = MIN_TOKENS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``pages`` plus ``out_col``: the main text, empty if there is none.

    Blocks are joined by two line feeds; what goes is told above.  Null and empty pages give the empty
    text; a null url is a host of its own; pages of a host with the same visible
    text count as one page, so copies never cut each other.  Extra columns are passed on.  An empty table stays empty."""
    if out_col in pages.columns:
        raise ValueError(f"column {out_col} is there already")
    own = [F.col(f"`{c}`") for c in pages.columns]
    n = len(own)
    at, url_at = pages.columns.index(html_col), pages.columns.index(url_col)
    found = zones(pages, url_col, html_col)
    repeated = repeated_runs(found.select("host", "page", "furniture", "rest"), min_tokens, block_tokens)
    covered = (repeated_spans(found, repeated, min_tokens, block_tokens)
               .groupBy("host", "page").agg(F.collect_set(F.struct("pos", "upto")).alias("__spans")))
    path = scratch_path(pages.sparkSession, "page-runs")
    covered.write.parquet(path)
    spans_type = "ARRAY<STRUCT<pos: BIGINT, upto: BIGINT>>"
    covered = (pages.sparkSession.read.schema(f"host BIGINT, page BIGINT, __spans {spans_type}").parquet(path)
               .withColumnsRenamed({"host": "__on", "page": "__of"}))

    def keyed(batches):
        for b in batches:
            hosts, keys, mains = [], [], []
            for url, page in zip(b.column(url_at).to_pylist(), b.column(at).to_pylist()):
                host, _, key, _, _, _, main = _zones(url, blocks(page))
                hosts.append(host)
                keys.append(key)
                mains.append(main)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(hosts, pa.int64()), pa.array(keys, pa.int64()), pa.array(mains, pa.list_(pa.string()))],
                names=[*b.schema.names, "__host", "__page", "__main"])

    asked = map_arrow(pages, keyed, T.StructType([*pages.schema.fields, T.StructField("__host", T.LongType()),
                                                  T.StructField("__page", T.LongType()),
                                                  T.StructField("__main", T.ArrayType(T.StringType()))]))
    # few pages have spans where articles are marked: the pages then stay where they are
    asked = (asked.join(broadcast_if_small(covered), (F.col("__host") == F.col("__on")) & (F.col("__page") == F.col("__of")), "left")
             .select(*own, "__main", "__spans"))

    def cut(batches):
        for b in batches:
            made = []
            for main, spans in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist()):
                gone = {k for s in spans or () for k in range(s["pos"], s["upto"])}
                kept, pos = [], 0
                for text in main:
                    words = text.split()
                    unique = [w for i, w in enumerate(words, pos) if i not in gone] if gone else words
                    pos += len(words)
                    if unique:
                        kept.append(" ".join(unique))
                made.append(JOINER.join(kept))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(made, pa.string())],
                                             names=[*b.schema.names[:n], out_col])

    return map_arrow(asked, cut, T.StructType([*pages.schema.fields, T.StructField(out_col, T.StringType())]))
