"""Main text of web pages (operator 5).

Pages are sorted by host and URL path, so that a page's neighbours are the pages
with the nearest URLs of its host. The lines (text blocks) of a page are aligned
with those of both neighbours by longest common subsequence, and lines in the
alignment are deleted: what nearby pages share in order is their template.
Landmarks of the markup settle what the alignment leaves open. Lines in menus,
forms, adverts and the like go even if no neighbour has them. Lines inside an
article element stay, because articles may share a sentence, often their first.
Beside an article element the unshared lines stay if they are more text than
the article's own; otherwise the element holds the article.

A neighbour with nearly the same text is a copy or another version, says
nothing about the template and is passed over for the next nearest page of the
host. What the two do not share tells versions from short texts on one template.

Ranges of host, path and id spread a large host over many tasks. Their bounds
come from the keys alone, and the pages at the edges of a range are also given
to the range beside it, so that a page has its neighbours however many ranges
there are; only a run of more versions than ``HALO`` over an edge misses the
pages beyond the run. A task holds some pages before the last, the pages of a
run of versions, each line of which it keeps once, and the ids of a run of
copies. Alignments need memory linear in the lines.

Defined results: a NULL page has the empty text; a URL that is NULL or not a URL
counts as host "" ; repeated rows are pages of their own with equal texts; pages
with one path are ordered by page_id; an empty table gives an empty result; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup, and is skipped.
RAW = frozenset("script style noscript template iframe object svg math textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li"
    " main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead"
    " title tr ul".split()
)
DROPPED = frozenset(
    "head nav footer aside form fieldset button select option datalist dialog menu audio video"
    " canvas label output progress".split()
)
# Names of a class, id or role that mark a part as no article text, alone or
# joined with each other and with FRAME words ("cookie-banner", "site-footer").
DROPPED_MARKS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner cookie"
    " cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe"
    " signup sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar"
    " footer comment comments discussion disqus replies related recommended share sharing social"
    " widget skip search login".split()
)
FRAME = frozenset(
    "area bar block body bottom box btn button buttons col column container content desktop entries"
    " entry fixed form global group header icons inner item items left link links list main mobile"
    " outer page panel placeholder post posts primary right row secondary section site slot sticky"
    " story stories thread top unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CORE = frozenset(["article", "main"])
CORE_ROLES = frozenset(["main", "article"])

TAG_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
TAG_END = re.compile(r"[^>\"']*+(?:\"[^\"]*\"[^>\"']*+|'[^']*'[^>\"']*+)*+>")
MARKS = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:[\s=/>]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*\"[^\"]*display\s*:\s*none)", re.I)
MARK_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

OPEN, IN_CORE, IN_DROPPED = 0, 1, 2

# Share of common word pairs from which what is left of two pages is alike.
ALIKE = 0.5
# Pages that are kept before the last, each no version of the next.
STEPS = 8
# Pages at each edge of a range that the range beside it is given too.
HALO = 8


@dataclass
class Page:
    """Lines of a page and the region of each."""

    lines: list[str] = field(default_factory=list)
    regions: list[int] = field(default_factory=list)

    @property
    def size(self) -> int:
        return sum(map(len, self.lines))


def _marked(name: str) -> bool:
    """Whether a class, id or role names a part that is no article text."""
    found = {w.lower() for w in MARK_WORD.findall(name)}
    return bool(found & DROPPED_MARKS) and found <= DROPPED_MARKS | FRAME


def _region(name: str, attributes: str, above: int) -> int:
    """Region of an element from its name and attributes and its parent's.
    Headings are never dropped by name, nor parts of an article by their ids,
    which are made from headings."""
    if above == IN_DROPPED:
        return above
    # The page's own frame is never dropped whole because of a class.
    framing = name in ("html", "body") or name in CORE
    marked = False
    roles: set[str] = set()
    for kind, value in MARKS.findall(attributes) if "=" in attributes else ():
        names = value.strip("\"'").split()
        kind = kind.lower()
        if kind == "role":
            roles.update(x.lower() for x in names)
        if not framing and name not in HEADINGS and (kind != "id" or above != IN_CORE):
            marked = marked or any(map(_marked, names))
    if name in DROPPED or (name == "header" and above != IN_CORE):
        return IN_DROPPED
    if marked:
        return IN_DROPPED
    if attributes and HIDDEN.search(attributes) and not framing:
        return IN_DROPPED
    return IN_CORE if name in CORE or roles & CORE_ROLES else above


def parse(source: str) -> Page:
    """Text blocks of a page in order, white space made single spaces."""
    page = Page()
    stack: list[tuple[str, int]] = []
    text: list[str] = []
    region, at, size, quoted = OPEN, 0, len(source), True

    def flush() -> None:
        if text:
            line = " ".join("".join(text).split())
            text.clear()
            if line:
                page.lines.append(line)
                page.regions.append(region)

    while at < size:
        opening = source.find("<", at)
        if opening < 0:
            opening = size
        if opening > at:
            text.append(html.unescape(source[at:opening]))
        if opening == size:
            break
        if source.startswith("<!--", opening):
            close = source.find("-->", opening + 4)
            at = size if close < 0 else close + 3
            continue
        tag = TAG_NAME.match(source, opening + 1)
        if not tag:
            if source.startswith(("<!", "<?", "</"), opening):
                close = source.find(">", opening)
                at = size if close < 0 else close + 1
            else:  # a bare sign
                text.append("<")
                at = opening + 1
            continue
        end = TAG_END.match(source, tag.end()) if quoted else None
        if end:
            at = end.end()
        else:  # a quote that never closes; from here on it ends with the tag
            quoted = False
            close = source.find(">", tag.end())
            at = size if close < 0 else close + 1
        name = tag[1].lower()
        if name in BLOCK:
            flush()
        if source[opening + 1] == "/":
            if any(name == n for n, _ in stack):
                while True:
                    closed, region_above = stack.pop()
                    if closed in BLOCK:
                        flush()
                    elif region_above != region:
                        flush()
                    region = region_above
                    if closed == name:
                        break
            continue
        attributes = source[tag.end() : at - 1]
        if name in RAW:
            if not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
                at = size if close is None else close.start()
                end = source.find(">", at)
                at = size if end < 0 else end + 1
            continue
        if name in VOID:
            continue
        inner = _region(name, attributes, region)
        if inner != region:
            flush()
        stack.append((name, region))
        region = inner
    flush()
    return page


def _row_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` and each prefix of
    ``b``, by bit-parallel dynamic programming."""
    places: dict[int, int] = {}
    for j, item in enumerate(b):
        places[item] = places.get(item, 0) | 1 << j
    every = (1 << len(b)) - 1
    row = every
    for item in a:
        hit = row & places.get(item, 0)
        row = ((row + hit) | (row - hit)) & every
    raw = np.frombuffer((every & ~row).to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    bits = np.unpackbits(raw, bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])


def _align(a: list[int], b: list[int], start: int, found: set[int]) -> None:
    """Add the places in ``a`` (from ``start``) of one longest common
    subsequence. The halves of ``a`` meet where both lengths add up to most."""
    work = [(a, b, start)]
    while work:
        a, b, start = work.pop()
        while a and b and a[0] == b[0]:
            found.add(start)
            a, b, start = a[1:], b[1:], start + 1
        while a and b and a[-1] == b[-1]:
            found.add(start + len(a) - 1)
            a, b = a[:-1], b[:-1]
        if not a or not b:
            continue
        if len(a) == 1:
            if a[0] in b:
                found.add(start)
            continue
        half = len(a) // 2
        total = _row_lengths(a[:half], b) + _row_lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int(total.argmax())
        work += [(a[:half], b[:cut], start), (a[half:], b[cut:], start + half)]


def shared_lines(page: list[str], other: list[str]) -> set[int]:
    """Places of the page's lines in a longest common subsequence with another
    page's. Lines that only one of them has cannot take part."""
    both = set(page) & set(other)
    mine = [(i, line) for i, line in enumerate(page) if line in both]
    ids = {line: k for k, line in enumerate(both)}
    found: set[int] = set()
    _align([ids[x] for _, x in mine], [ids[x] for x in other if x in both], 0, found)
    return {mine[k][0] for k in found}


def _pairs(lines: list[str]) -> Counter[tuple[str, str]]:
    """Pairs of neighbouring words inside the lines."""
    words = (line.split() for line in lines)
    return Counter(pair for ws in words for pair in zip(ws, ws[1:]))


def template_lines(page: Page, other: Page, copy_share: float) -> set[int] | None:
    """Places of the page's lines that it shares with another page; None where
    the other is a version of it.

    What is left of both tells, not how much they share, as a short text on a
    long template shares nearly all: versions have nothing left, or nearly the
    same words. If only one has lines left, they must be few; if the article
    elements of both are nearly the same, one rewritten line does not matter.
    Lines in dropped regions do not count.
    """
    shared = shared_lines(page.lines, other.lines)
    common = Counter(page.lines[i] for i in shared)
    mine, theirs = [], []
    for i, (line, region) in enumerate(zip(page.lines, page.regions)):
        if i not in shared and region != IN_DROPPED:
            mine.append(line)
    for line, region in zip(other.lines, other.regions):
        if common[line]:
            common[line] -= 1
        elif region != IN_DROPPED:
            theirs.append(line)
    if not mine and not theirs:
        return None
    if not mine or not theirs:
        longer = page if mine else other
        size = sum(len(x) for x, r in zip(longer.lines, longer.regions) if r != IN_DROPPED)
        return None if sum(map(len, mine + theirs)) <= (1 - copy_share) * size else shared
    left, right = _pairs(mine), _pairs(theirs)
    if 2 * (left & right).total() >= ALIKE * (left.total() + right.total()) > 0:
        return None
    core = [i for i, region in enumerate(page.regions) if region == IN_CORE]
    theirs_core = sum(len(x) for x, r in zip(other.lines, other.regions) if r == IN_CORE)
    size = max(sum(len(page.lines[i]) for i in core), theirs_core)
    both = sum(len(page.lines[i]) for i in core if i in shared)
    return None if both > copy_share * size else shared


def kept_text(page: Page, before: set[int] | None, after: set[int] | None) -> str:
    """The page's text without the lines it shares with the neighbour before and
    after it; None where there is none. Without either, landmarks decide alone."""
    template = (before or set()) | (after or set())
    core, beside = [], []
    for i, (line, region) in enumerate(zip(page.lines, page.regions)):
        if region == IN_CORE:
            core.append((i, line))
        elif region == OPEN and i not in template:
            beside.append((i, line))

    def size(lines: list[tuple[int, str]]) -> int:
        return sum(len(line) for _, line in lines)

    compared = before is not None or after is not None
    if not core or (compared and size(beside) > size(core)):
        core = sorted(core + beside)
    return " ".join(line for _, line in core)


def main_text(page: Page, neighbours: list[Page], copy_share: float) -> str:
    """The page's text as the pages before and after it tell it."""
    shared = [template_lines(page, other, copy_share) for other in neighbours]
    return kept_text(page, *(shared + [None, None])[:2])


@dataclass
class Entry:
    """A page, the ids of its run of copies, the nearest page before it that is
    no version of it, and the lines shared with that and with the one after."""

    page: Page
    ids: list[tuple]
    before: Entry | None = None
    shared_before: set[int] | None = None
    shared_after: set[int] | None = None

    @property
    def text(self) -> str:
        return kept_text(self.page, self.shared_before, self.shared_after)


class Neighbourhood:
    """Pages of one host in order. A page waits until a page comes that is no
    version of it; pages between two versions are taken for versions too."""

    def __init__(self, copy_share: float) -> None:
        self.copy_share = copy_share
        self.last: Entry | None = None
        self.waiting: list[Entry] = []
        self.spelled: dict[str, str] = {}

    def add(self, page: Page, key: tuple) -> list[Entry]:
        """The pages that are done once this one is known."""
        last = self.last
        if last and page.lines == last.page.lines and page.regions == last.page.regions:
            last.ids.append(key)
            return []
        # Versions share their lines, so those that wait take little memory.
        page.lines = [self.spelled.setdefault(line, line) for line in page.lines]
        entry = self.last = Entry(page, [key])
        while last:
            places = template_lines(page, last.page, self.copy_share)
            if places is not None:
                entry.shared_before, entry.before = places, last
                break
            last = last.before
        done = []
        # A version of the last page is one of those that wait for the same page.
        if self.waiting and entry.before is self.waiting[-1]:
            rest = []
            for waits in self.waiting:
                places = template_lines(waits.page, page, self.copy_share)
                if places is None:
                    rest.append(waits)
                else:
                    waits.shared_after = places
                    done.append(waits)
            self.waiting = rest
            if not rest:
                self.spelled = {line: line for line in page.lines}
        self.waiting.append(entry)
        oldest: Entry | None = entry
        for _ in range(STEPS):
            oldest = oldest and oldest.before
        if oldest:
            oldest.before = None
        return done


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    return F.lower(F.regexp_extract(known, pattern, 1)), F.regexp_extract(known, pattern, 2)


Key = tuple[str, str, int | None]


@dataclass
class Range:
    """Some pages in a row: their number, and the first and last of their keys."""

    count: int
    first: list[Key]
    last: list[Key]

    def joined(self, other: Range) -> Range:
        first = (self.first + other.first)[:HALO] if self.count < HALO else self.first
        last = (self.last + other.last)[-HALO:] if other.count < HALO else other.last
        return Range(self.count + other.count, first, last)


def ranges(keys: DataFrame, order: list[str], n: int) -> list[Range]:
    """At most ``n`` ranges of the sorted keys, none shorter than four halos if
    there are that many pages. The driver gets ``2 * HALO`` keys of each."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, first, last = 0, [], deque(maxlen=HALO)
        for rows in batches:
            count += rows.num_rows
            first += rows.slice(0, HALO - len(first)).to_pylist()
            last.extend(rows.slice(max(0, rows.num_rows - HALO)).to_pylist())
        if count:
            yield pa.RecordBatch.from_pylist(
                [{"count": count, "first": first, "last": list(last)}], schema=shape
            )

    kinds = keys.select(*order).schema
    listed = f"array<{kinds.simpleString()}>"
    key = pa.struct([(c, pa.string()) for c in order[:2]] + [(order[2], pa.int64())])
    shape = pa.schema([("count", pa.int64()), ("first", pa.list_(key)), ("last", pa.list_(key))])
    found = (
        keys.select(*order)
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(edges, f"count bigint, first {listed}, last {listed}")
        .collect()
    )
    whole: list[Range] = []
    for row in sorted(found, key=lambda r: _sortable(r["first"][0])):
        part = Range(row["count"], list(map(tuple, row["first"])), list(map(tuple, row["last"])))
        if whole and min(whole[-1].count, part.count) < 4 * HALO:
            whole[-1] = whole[-1].joined(part)
        else:
            whole.append(part)
    return whole


def _sortable(key: Key) -> tuple:
    """Strings as bytes and NULLs first, as Spark sorts them."""
    host, path, page_id = key
    return host.encode(), path.encode(), page_id is not None, page_id or 0


def extract(pages: DataFrame, copy_share: float = 0.8) -> DataFrame:
    """page_id, url, text and n_chars per page. For versions and ``copy_share``
    see :func:`template_lines`."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    order = ["_host", "_path", "_id"]
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"_host": host, "_path": path, "_id": F.col("page_id").cast("bigint")})
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = ranges(rows, order, n)

    def keys(listed: list[Key]) -> Column:
        shape = "array<struct<_host:string,_path:string,_id:bigint>>"
        values = [F.struct(*(F.lit(v).alias(c) for v, c in zip(k, order))) for k in listed]
        return F.array(*values).cast(shape)

    key = F.struct(*order)
    # A page at an edge also goes to the range beside its own.
    home = F.size(F.filter(keys([p.first[0] for p in parts[1:]]), lambda first: first <= key))
    starts = keys([p.first[-1] for p in parts])
    ends = keys([p.last[0] for p in parts])
    placed = rows.withColumn("_home", home).withColumn(
        "_range",
        F.explode(
            F.filter(
                F.array(
                    F.when((F.col("_home") > 0) & (key <= F.get(starts, "_home")), F.col("_home") - 1),
                    F.col("_home"),
                    F.when(
                        (F.col("_home") < len(parts) - 1) & (key >= F.get(ends, "_home")),
                        F.col("_home") + 1,
                    ),
                ),
                lambda r: r.isNotNull(),
            )
        ),
    )
    dealt = (
        placed.repartitionById(n, "_range")
        .sortWithinPartitions("_range", *order)
        .select("page_id", "url", "html", "_host", "_range", "_home")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Neighbourhood(copy_share)
        current = None
        key_type = pa.int64()

        def batch(entry: Entry) -> Iterator[pa.RecordBatch]:
            own = [(key, url) for key, url, home in entry.ids if home]
            if own:
                found, urls = zip(*own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found, key_type),
                        pa.array(urls, pa.string()),
                        pa.array([entry.text] * len(own), pa.string()),
                    ],
                    names=["page_id", "url", "text"],
                )

        for rows in batches:
            key_type = rows.schema.field(0).type
            for key, url, source, host, part, home in zip(*rows.columns):
                place = (part.as_py(), host.as_py())
                if place != current:
                    for entry in near.waiting:
                        yield from batch(entry)
                    near, current = Neighbourhood(copy_share), place
                known = (key.as_py(), url.as_py(), home.as_py() == place[0])
                for entry in near.add(parse(source.as_py()), known):
                    yield from batch(entry)
        for entry in near.waiting:
            yield from batch(entry)

    kind = pages.schema["page_id"].dataType.simpleString()
    found = dealt.mapInArrow(scan, f"page_id {kind}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
