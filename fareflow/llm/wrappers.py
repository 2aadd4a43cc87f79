"""Main text of web pages by wrapper induction over the pages of a host.

A page's DOM is folded into its shape: siblings with the same tag and classes become one node if
all of them hold text alone, or if tags inside them agree, so a shape has a node per kind of place,
not per paragraph, and an article is told from an advert of the same tag. Every host has a reference, its
most frequent shape, and each other shape is aligned with it by simple tree matching. Over
all pages of the host, a place whose text is always the same is template; a place whose text
varies is a slot. The content region is the deepest container of the reference that holds most
of the varying text, widened to the article or main element around it. A page's main text is
what stands in the region, without template places and without places that are named as
furniture (menus, adverts, forms, comments and the like), unless they hold most of the varying text.
Inside a region below the body, headings, lists, quotations and tables stay though they repeat.

Pages are parsed once and written as blocks. Statistics are combining aggregations over places
of all pages; alignment is one row per shape and host. Only the wrappers, one small row per shape and host, meet the pages again.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import small_batches, stored
from fareflow.llm.urls import host_and_path

# A place counts as template from this many different pages on, if others of the host's texts vary.
TEMPLATE_PAGES = 5
REGION_SHARE = 0.6

# A tag's name, and the rest of it where no attribute has a value.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)(?:([^<>=]*+)>)?")
# What ends a tag, or opens a quoted value inside it.
_STOP = re.compile(r"""[<>]|=\s*+["']""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAMING = frozenset("class id role".split())
_RAW = frozenset("script style textarea title iframe noscript noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements of which an open one of the same kind ends where the next begins.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
         "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table article section main body div td th nav aside".split())
FURNITURE_TAGS = frozenset(
    "head nav header footer aside form script style noscript template iframe textarea button select option "
    "menu dialog svg object canvas title noembed noframes xmp".split()
)
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar "
    "nav navbar navigation menu breadcrumb breadcrumbs masthead header footer cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "comment comments disqus replies respond related recommended recommendations widget widgets toolbar "
    "pagination pager copyright complementary contentinfo search".split()
)
_WIDE = ("article", "main")
# What belongs to an article although its words repeat from page to page.
_PARTS = frozenset("h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote table caption thead tbody tr td th pre".split())


@dataclass
class Place:
    """One kind of place in a page: a node of its shape."""

    label: str
    parent: int
    children: dict[int, int] = field(default_factory=dict)


@dataclass
class Page:
    places: list[Place]
    blocks: list[tuple[int, str]]

    def shape(self) -> str:
        """The shape as text: places in order, each with its parent's number."""
        return "\n".join(f"{p.parent} {p.label}" for p in self.places)


def parse(page: str | None) -> Page:
    """Shape and text blocks of a page, in time linear in its length for ordinary nesting.

    Broken markup is read as far as it goes. A quoted attribute value ends at its closing quote,
    however far that is; where there is none, the tag ends at the next ``>``.
    """
    elements, blocks, open_, text = [("", -1)], [], [("", 0)], []
    opened: defaultdict[str, int] = defaultdict(int)
    at = done = 0
    page = page or ""
    unclosed: set[int] = set()
    closable = True

    def flush() -> None:
        words = entities.unescape("".join(text)).split()
        if words:
            blocks.append((open_[-1][1], " ".join(words)))
        text.clear()

    def cut(k: int) -> None:
        for tag, _ in open_[k:]:
            opened[tag] -= 1
        del open_[k:]

    def close(kinds: set[str]) -> None:
        """End the nearest open element of these kinds inside its scope."""
        if not any(map(opened.__getitem__, kinds)):
            return
        for k in range(len(open_) - 1, 0, -1):
            if open_[k][0] in kinds:
                return cut(k)
            if open_[k][0] in _SCOPE:
                return

    while (start := page.find("<", at)) >= 0:
        at = start + 1
        mark = page[start + 1 : start + 2]
        if mark in ("!", "?"):
            cdata = page.startswith("<![CDATA[", start)
            ending = "-->" if page.startswith("<!--", start) else "]]>" if cdata else ">"
            end = page.find(ending, start + 2) if closable or ending != ">" else -1
            if end < 0 and ending == ">":
                closable = False
                continue
            end = len(page) if end < 0 else end
            text.append(page[done:start])
            if cdata:
                text.append(page[start + 9 : end])
            at = done = min(end + len(ending), len(page))
            continue
        found = _TAG.match(page, start)
        if found is None:
            continue
        end_mark, tag, rest = found.groups()
        stop = found.end()
        if rest is None:
            named = stop
            stop = _tag_end(page, named, unclosed) + 1
            if not stop:
                continue
            rest = page[named : stop - 1]
        if start > done:
            text.append(page[done:start])
        at = done = stop
        tag = tag.lower()
        if tag in _RAW and not end_mark:
            raw_end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = done = raw_end.end() if raw_end else len(page)
            continue
        if tag in _INLINE:
            if tag == "br":
                text.append(" ")
            continue
        if text:
            flush()
        if end_mark:
            if opened[tag]:
                cut(next(k for k in range(len(open_) - 1, 0, -1) if open_[k][0] == tag))
            continue
        if tag in _ENDS:
            close(_ENDS[tag])
        if tag not in _ENDS and tag not in ("html", "body"):
            close({"p"})
        if tag in _VOID:
            continue
        elements.append((_label(tag, rest), open_[-1][1]))
        if not rest.endswith("/"):
            open_.append((tag, len(elements) - 1))
            opened[tag] += 1
    text.append(page[done:])
    flush()
    places, place_of = _folded(elements)
    return Page(places, [(place_of[e], words) for e, words in blocks])


def _folded(elements: list[tuple[str, int]]) -> tuple[list[Place], list[int]]:
    """Places of a page's elements (label, parent), and each element's place.

    An element joins an earlier one of its label in the same place if neither holds
    elements, or if a tag stands in both.
    """
    inner: list[set[str]] = [set() for _ in elements]
    for label, parent in elements[1:]:
        inner[parent].add(label.split(" ", 1)[0])
    places, place_of = [Place("", -1)], [0]
    kinds: dict[tuple[int, str], list[tuple[int, set[str]]]] = {}
    for (label, parent), tags in zip(elements[1:], inner[1:]):
        parent = place_of[parent]
        alike = kinds.setdefault((parent, label), [])
        for place, known in alike:
            if known & tags or not (known or tags):
                known |= tags
                break
        else:
            place = len(places)
            places[parent].children[place] = place
            places.append(Place(label, parent))
            alike.append((place, tags))
        place_of.append(place)
    return places, place_of


def _tag_end(page: str, at: int, unclosed: set[int]) -> int:
    """Where the ``>`` of a tag stands whose name ends at ``at``; -1 if it is none.

    ``unclosed`` keeps the quotes from which a search has already come to nothing, so that
    all searches of a page together read it a bounded number of times.
    """
    passed, here = [], at
    while (stop := _STOP.search(page, here)) is not None:
        mark, quote = stop.group()[-1], stop.end() - 1
        if mark == ">":
            return quote
        if mark == "<":
            unclosed.update(passed)
            return -1
        passed.append(quote)
        close = -1 if quote in unclosed else page.find(mark, quote + 1)
        if close < 0:
            break
        here = close + 1
    unclosed.update(passed)
    plain = _PLAIN.match(page, at)
    return plain.end() - 1 if plain else -1


_PLAIN = re.compile(r"[^<>]*+>")


def _label(tag: str, rest: str) -> str:
    if not rest:
        return tag
    values = (m for m in _ATTRIBUTE.finditer(rest) if m[1].lower() in _NAMING)
    names = {n for m in values for n in (m[2] or m[3] or m[4] or "").lower().split()}
    return " ".join([tag, *sorted(re.sub(r"\d+", "0", n) for n in names)])


@lru_cache(maxsize=4096)
def is_furniture(label: str) -> bool:
    tag, *names = label.split()
    words = {w for n in names for w in re.split("[^a-z]+", n)}
    return tag in FURNITURE_TAGS or (tag not in ("html", "body", *_WIDE) and bool(words & FURNITURE_NAMES))


def read_shape(shape: str) -> list[Place]:
    places = []
    for line in shape.split("\n"):
        parent, _, label = line.partition(" ")
        if int(parent) >= 0:
            places[int(parent)].children[len(places)] = len(places)
        places.append(Place(label, int(parent)))
    return places


class _Numbers:
    """Numbers for subtrees, equal ones alike: by tags only, and by tags and names."""

    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        self.tags: list[str] = []
        self.inner: list[tuple[int, ...]] = []

    def of(self, places: list[Place]) -> tuple[list[int], list[int]]:
        bare, named = [0] * len(places), [0] * len(places)
        for i in range(len(places) - 1, -1, -1):
            below = places[i].children.values()
            bare[i] = self._number(places[i].label.split(" ")[0], tuple(bare[c] for c in below))
            named[i] = self._number(places[i].label, tuple(named[c] for c in below))
        return bare, named

    def _number(self, label: str, inner: tuple[int, ...]) -> int:
        number = self.known.setdefault((label, inner), len(self.tags))
        if number == len(self.tags):
            self.tags.append(label)
            self.inner.append(inner)
        return number


def _depths(places: list[Place]) -> list[int]:
    out: list[int] = []
    for p in places:
        out.append(out[p.parent] + 1 if p.parent >= 0 else 0)
    return out


def _most(left: tuple[int, ...], right: tuple[int, ...], weight: dict[tuple[int, int], int]) -> int:
    """The weight of the best order-keeping matching of two lists of subtree numbers."""
    if len(left) * len(right) <= 64:
        row = [0] * (len(right) + 1)
        for x in left:
            last = row
            row = [0]
            for j, y in enumerate(right):
                row.append(max(last[j + 1], row[j], last[j] + weight.get((x, y), 0)))
        return row[-1]
    rows: dict[int, np.ndarray] = {}
    best = np.zeros(len(right) + 1, dtype=np.int64)
    for x in left:
        if x not in rows:
            rows[x] = np.array([weight.get((x, y), 0) for y in right], dtype=np.int64)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + rows[x]))
    return int(best[-1])


def _pairs(gains: Callable[[int], np.ndarray], n: int, m: int) -> Iterator[tuple[int, int]]:
    """The pairs of the best order-keeping matching of two lists, last first; a bit or two a cell are kept."""
    best = np.zeros(m + 1)
    taken, above = [], []
    for i in range(n):
        gain = gains(i)
        cross = best[:-1] + gain
        new = np.maximum.accumulate(np.maximum(best[1:], cross))
        taken.append(np.packbits((gain > 0) & (new == cross)))
        above.append(np.packbits(new == best[1:]))
        best[1:] = new
    i, j = n - 1, m - 1
    while i >= 0 and j >= 0:
        byte, bit = j >> 3, 128 >> (j & 7)
        if taken[i][byte] & bit:
            yield i, j
            i, j = i - 1, j - 1
        elif above[i][byte] & bit:
            i -= 1
        else:
            j -= 1


def align(one: list[Place], two: list[Place]) -> dict[int, int]:
    """Simple tree matching: which place of ``two`` each matched place of ``one`` stands for.

    Matched places have the same tag, their parents match, and order is kept; the number
    of matches is the largest there is. Among equals, each pair's children are matched so that
    most have the same names, in them and below. Subtrees of the same tags are weighed once,
    so siblings that differ in their names only cost one row of numbers each.
    """
    numbers = _Numbers()
    (bare_one, named_one), (bare_two, named_two) = numbers.of(one), numbers.of(two)
    levels: dict[int, dict[str, tuple[set[int], set[int]]]] = {}
    for side, (places, bare) in enumerate(((one, bare_one), (two, bare_two))):
        for depth, number in zip(_depths(places), bare):
            levels.setdefault(depth, {}).setdefault(numbers.tags[number], (set(), set()))[side].add(number)
    # Only places of one depth and tag can match; the deepest come first.
    weight: dict[tuple[int, int], int] = {}
    for depth in sorted(levels, reverse=True):
        for xs, ys in levels[depth].values():
            for x, y in product(xs, ys):
                if (x, y) not in weight:
                    weight[x, y] = 1 + _most(numbers.inner[x], numbers.inner[y], weight)

    found, todo = {0: 0}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        left, right = list(one[a].children.values()), list(two[b].children.values())
        # Equal first and last children match each other in some best matching.
        head = 0
        while head < min(len(left), len(right)) and named_one[left[head]] == named_two[right[head]]:
            head += 1
        tail = 0
        while tail < min(len(left), len(right)) - head and named_one[left[-1 - tail]] == named_two[right[-1 - tail]]:
            tail += 1
        pairs = list(zip(left[:head], right[:head])) + list(zip(left[len(left) - tail :], right[len(right) - tail :]))
        left, right = left[head : len(left) - tail], right[head : len(right) - tail]
        if left and right:
            pairs += [(left[i], right[j]) for i, j in _matched(one, two, left, right, weight, bare_one, bare_two, named_one, named_two)]
        found.update(pairs)
        todo += pairs
    return found


def _matched(one, two, left, right, weight, bare_one, bare_two, named_one, named_two) -> Iterator[tuple[int, int]]:
    """Pairs of two lists of siblings, by weight and then by equal names."""
    kinds = [bare_two[y] for y in right]
    labels = np.array([hash(two[y].label) for y in right])
    whole = np.array([named_two[y] for y in right])
    # Together less than one match.
    bonus = 0.5 / (1 + min(len(left), len(right)))
    rows: dict[int, np.ndarray] = {}

    def gains(i: int) -> np.ndarray:
        x = left[i]
        kind = bare_one[x]
        if kind not in rows:
            rows[kind] = np.array([weight.get((kind, y), 0) for y in kinds], dtype=float)
        same = (labels == hash(one[x].label)).astype(float) + (whole == named_one[x])
        return rows[kind] + np.where(rows[kind] > 0, bonus * same, 0.0)

    return _pairs(gains, len(left), len(right))


def furnished(places: list[Place], open_: set[int] | frozenset[int] = frozenset()) -> list[bool]:
    """Whether each place is furniture itself or stands in some. Names do not count for ``open_`` ones."""
    out: list[bool] = []
    for i, p in enumerate(places):
        label = p.label.split(" ")[0] if i in open_ else p.label
        out.append(p.parent >= 0 and (out[p.parent] or is_furniture(label)))
    return out


def _held(places: list[Place], mass: dict[int, float], skip: list[bool]) -> list[float]:
    """The varying text in and below each place."""
    held = [0.0 if skip[i] else mass.get(i, 0.0) for i in range(len(places))]
    for i in range(len(places) - 1, 0, -1):
        held[places[i].parent] += held[i]
    return held


def wrapping(places: list[Place], mass: dict[int, float]) -> set[int]:
    """Places too large for furniture, whatever their names: they hold most of the varying text.

    An article or main element beside such a place that holds varying text leaves it to its name.
    """
    tags_only = furnished(places, set(range(len(places))))
    held = _held(places, mass, tags_only)
    large = {i for i in range(1, len(places)) if held[0] and held[i] >= REGION_SHARE * held[0]}
    above: list[set[int]] = []
    for i, p in enumerate(places):
        above.append({i} | (above[p.parent] if p.parent >= 0 else set()) if i in large else (above[p.parent] if p.parent >= 0 else set()))
    wide = [i for i, p in enumerate(places) if p.label.split(" ")[0] in _WIDE and held[i] and i not in large]
    return {i for i in large if all(i in above[w] for w in wide)}


def region_of(places: list[Place], mass: dict[int, float]) -> int:
    """The deepest container with most of the varying text, widened to the article around it."""
    held = _held(places, mass, furnished(places, wrapping(places, mass)))
    best = 0
    while True:
        inner = [c for c in places[best].children.values() if places[c].children and held[c] >= REGION_SHARE * held[0]]
        if not inner or not held[0]:
            break
        best = inner[0]
    up = best
    while up > 0:
        if places[up].label.split(" ")[0] in _WIDE:
            best = up
        up = places[up].parent
    if places[best].label.split(" ")[0] not in _WIDE and held[0]:
        # A lone article without inner containers: its only kind of block holds the text.
        inner = [i for i, p in enumerate(places) if p.label.split(" ")[0] in _WIDE and held[i] >= REGION_SHARE * held[0]]
        best = max(inner, default=best)
    return best


def content_places(
    shape: str, region: int, matched: dict[int, int], template: set[int], open_: set[int] | frozenset[int] = frozenset()
) -> list[int]:
    """The places of a shape that hold content, given what the host's reference says.

    Without the region, a shape's own article or main element stands in, else all of it.
    """
    places = read_shape(shape)
    skip = furnished(places, {i for i, ref in matched.items() if ref in open_})
    roots = {i for i, ref in matched.items() if ref == region}
    if not roots or roots == {0}:
        roots = {i for i, p in enumerate(places) if p.label.split(" ")[0] in _WIDE} or {0}
    inside: list[bool] = []
    for i, p in enumerate(places):
        inside.append(i in roots or (p.parent >= 0 and inside[p.parent]))
    apart = all(places[i].label.split(" ")[0] not in ("", "html", "body") for i in roots)
    part: list[bool] = []
    for i, p in enumerate(places):
        inherited = p.parent >= 0 and part[p.parent]
        part.append(apart and inside[i] and i not in roots and (inherited or p.label.split(" ")[0] in _PARTS))
    return [
        i for i in range(len(places))
        if inside[i] and not skip[i] and (part[i] or matched.get(i, -1) not in template)
    ]


# Spark side.

PARSED = (
    "shape string, code long, page long, places array<struct<place: int, digest: long, chars: long>>, "
    "blocks array<struct<place: int, text: string>>"
)


def _code(shape: str) -> int:
    return xxhash.xxh64_intdigest(shape.encode()) - (1 << 63)


def _measure(pages: pd.Series) -> pd.DataFrame:
    rows = []
    for page in pages:
        parsed = parse(page)
        texts: dict[int, list[str]] = {}
        for place, text in parsed.blocks:
            texts.setdefault(place, []).append(text)
        joined = {place: "\n".join(t) for place, t in texts.items()}
        shape = parsed.shape()
        places = [{"place": p, "digest": _code(t), "chars": len(t)} for p, t in joined.items()]
        whole = _code("\n".join([shape, *(f"{p['place']} {p['digest']}" for p in places)]))
        blocks = [{"place": p, "text": t} for p, t in parsed.blocks]
        rows.append((shape, _code(shape), whole, places, blocks))
    return pd.DataFrame(rows, columns=["shape", "code", "page", "places", "blocks"])


def _aligned(shapes: pd.Series, references: pd.Series) -> pd.Series:
    out = []
    for one, two in zip(shapes, references):
        found = align(read_shape(one), read_shape(two))
        out.append([{"place": a, "ref": b} for a, b in sorted(found.items())])
    return pd.Series(out)


def _regions(shapes: pd.Series, masses: pd.Series) -> pd.Series:
    return pd.Series([
        region_of(read_shape(s), {m["ref"]: m["mass"] for m in found}) for s, found in zip(shapes, masses)
    ])


def _wrapping(shapes: pd.Series, masses: pd.Series) -> pd.Series:
    return pd.Series([
        sorted(wrapping(read_shape(s), {m["ref"]: m["mass"] for m in found})) for s, found in zip(shapes, masses)
    ])


def _contents(batch: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for shapes, regions, matches, templates, opens in batch:
        yield pd.Series([
            content_places(s, r, {m["place"]: m["ref"] for m in found}, set(t), set(o))
            for s, r, found, t, o in zip(shapes, regions, matches, templates, opens)
        ])


def read_pages(pages: DataFrame, host: Column, html: str = "html") -> DataFrame:
    """``pages`` parsed once and written down: ``host`` and the columns of ``PARSED`` in place of ``html``."""
    small_batches(pages.sparkSession)
    parsed = pages.select(*[c for c in pages.columns if c != html], host.alias("host"), F.pandas_udf(_measure, PARSED)(html).alias("p"))
    return stored(parsed.select("*", "p.*").drop("p"), "wrapper_pages")


def induce(read: DataFrame) -> DataFrame:
    """The wrappers of ``read_pages``: ``host``, ``code`` of a shape, and its ``content`` places."""
    # Copies of a page count once: what stands only in them does not repeat on different pages.
    measured = read.select("host", "page", "code", "shape", "places").dropDuplicates(["host", "page"])
    # A shape's row first, with place -1, so that one pass over the pages serves both counts. Only it carries the shape.
    shape_row = F.array(F.struct(F.lit(-1).alias("place"), F.lit(0).cast("long").alias("digest"), F.lit(0).cast("long").alias("chars")))
    rows = measured.select("host", "code", "shape", F.explode(F.concat(shape_row, "places")).alias("at"))
    rows = rows.withColumn("shape", F.when(F.col("at.place") == -1, F.col("shape")))
    stats = stored(
        rows.groupBy("host", "code", "shape", "at.place").agg(
            F.count(F.lit(1)).alias("pages"), F.min("at.digest").alias("low"), F.max("at.digest").alias("high"),
            F.sum("at.chars").alias("chars"),
        ),
        "wrapper_stats",
    )
    shapes = stats.where("place = -1").select("host", "code", "shape", "pages")
    best = shapes.groupBy("host").agg(F.max_by("shape", F.struct("pages", "code")).alias("reference"))
    matched = F.pandas_udf(_aligned, "array<struct<place: int, ref: int>>")("shape", "reference")
    aligned = stored(shapes.join(best, "host").withColumn("matched", matched), "wrapper_aligned")
    refs = aligned.select("host", "code", F.explode("matched").alias("m")).select("host", "code", "m.place", "m.ref")
    slots = (
        stats.where("place >= 0").drop("shape").join(refs, ["host", "code", "place"])
        .groupBy("host", "ref").agg(
            F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("chars").alias("chars"),
        )
        .withColumn("varies", F.col("low") != F.col("high"))
    )
    # Where nothing varies (one page, or only copies) all text counts.
    mass = F.collect_list(F.struct("ref", F.when(F.col("varies"), F.col("chars").cast("double")).otherwise(0.0).alias("mass")))
    every = F.collect_list(F.struct("ref", F.col("chars").cast("double").alias("mass")))
    same = F.collect_list(F.when(~F.col("varies") & (F.col("pages") >= TEMPLATE_PAGES), F.col("ref")))
    judged = slots.groupBy("host").agg(mass.alias("mass"), every.alias("every"), same.alias("same"))
    region = F.pandas_udf(_regions, "int")
    hosts = best.join(judged, "host", "left")
    empty = F.array().cast("array<struct<ref: int, mass: double>>")
    varying = F.coalesce("mass", empty)
    inner = region(F.col("reference"), varying)
    outer = region(F.col("reference"), F.coalesce("every", empty))
    large = F.pandas_udf(_wrapping, "array<int>")
    open_inner, open_outer = large("reference", varying), large("reference", F.coalesce("every", empty))
    hosts = stored(
        hosts.select("host", inner.alias("inner"), outer.alias("outer"),
                     open_inner.alias("open_inner"), open_outer.alias("open_outer"), F.coalesce("same", F.array().cast("array<int>")).alias("same")),
        "wrapper_hosts",
    )
    joined = aligned.join(hosts, "host")
    varies = F.col("inner") > 0
    content = F.pandas_udf(_contents, "array<int>")(
        F.col("shape"),
        F.when(varies, F.col("inner")).otherwise(F.col("outer")),
        F.col("matched"),
        F.when(varies, F.col("same")).otherwise(F.array().cast("array<int>")),
        F.when(varies, F.col("open_inner")).otherwise(F.col("open_outer")),
    )
    return stored(joined.select("host", "code", content.alias("content")), "wrappers")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``: the main text of every page, blocks by line.

    Null and empty pages have an empty text. Pages without host share one. Repeated rows
    stay, and none is a template of the other: a place must repeat on ``TEMPLATE_PAGES`` different pages
    while the rest of the host varies.
    """
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    read = read_pages(rows, host_and_path(F.col("url"))[0])
    joined = read.select("page_id", "url", "host", "code", "blocks").join(induce(read), ["host", "code"])
    kept = F.filter("blocks", lambda b: F.array_contains("content", b["place"]))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
