"""Main text of pages by nearest-URL page differencing.

Pages are paired by URL path within their host, their text lines are aligned by longest common subsequence (LCS), and
lines that are shared are deleted. Three jobs: the line hashes of every page are written (a few bytes a line); those rows
are put in (host, path) order and cut into blocks that overlap, so that a host with very many pages fills many tasks
and no page lacks a neighbour because a block ends; the deleted lines go back to the pages.

Two things differencing alone can't tell are told apart as follows. Copies of an article share its lines though they
are no template: a page that holds one of another's telling lines (the longest of those that at most half of the pages
around have), or all of its lines, is its copy and no partner for it. Menus, adverts and footers may differ on every page: blocks whose mark-up
names them go whether or not they are shared.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import MOST_PARTITIONS, written

# Elements whose text is never shown or never article, elements that are outside any article, blocks,
# elements without an end, and elements that hold raw text.
SILENT = frozenset("script style template noscript head title iframe object svg canvas math select option textarea button input datalist audio video".split())
OUTSIDE = frozenset("nav footer aside form dialog menu".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
ENDED_BY_LIKE = frozenset("p li td th tr dd dt option".split())
NOT_ENDED_THROUGH = frozenset("ul ol table dl div section article body main blockquote".split())
# Class, id and role words of containers that are not article. Those of the second group hold headings
# and lead-ins within an article, so they count only outside one.
MARKS = frozenset("ad ads advert adverts advertisement adsense banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar widget widgets comment comments commentlist respond replies disqus cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations toolbar legal disclaimer".split())
OUTER_MARKS = MARKS | frozenset("header masthead footer side aside skip copyright toc".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar alert".split())
# Only these carry such words; a class never deletes a heading, a paragraph or a word within one.
CONTAINERS = frozenset("div section ul ol dl table aside header footer nav form figure details center".split())
ARTICLE_MARKS = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story)(?:[\s_-]?(?:body|content|text|main))?(?:$|[\s_-])", re.IGNORECASE)
PARTS_OF_NAMES = re.compile(r"[\s_-]+")
SPACES = re.compile(r"\s+")
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>")
# References to characters beyond any code point, and leading zeros, which may be longer than a number can be read.
NO_CHARACTER = re.compile(r"&#(?:0*[1-9][0-9]{7,}|[xX]0*[1-9a-fA-F][0-9a-fA-F]{6,});?")
LEADING_ZEROS = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])")
ATTRIBUTES = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}

# What mark-up says of a line: nothing, that it lies in an article, that it lies outside of one.
PLAIN, INSIDE, APART = 0, 1, 2
# The pages to each side in (host, path) order that tell which lines are rare, and that are looked at first for partners; the partners compared for lines of an article; how many of them
# there must be, since a sentence that two articles quote is shared as well.
REACH, PARTNERS, LEAST_PARTNERS = 32, 8, 4
# Rows of a block, besides those that overlap.
BLOCK_ROWS = 4096
TELLING_LINES = 3


def decoded(text: str) -> str:
    """Text with its character references decoded."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = LEADING_ZEROS.sub(r"&#\1", NO_CHARACTER.sub("\ufffd", text))
    return entities.unescape(text)


def tokens(html: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """(start, end, match of a tag) of comments, declarations and tags, in order; the caller may send where to go on.

    One pass: where no `>` follows, a `<` opens nothing, and what is left is text up to a comment.
    """
    at = 0
    while (start := html.find("<", at)) >= 0:
        after = html[start + 1 : start + 2]
        found = None
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            stop = len(html) if end < 0 else end + 3
        else:
            end = html.find(">", start)
            if end < 0:
                start = html.find("<!--", start)
                if start >= 0:
                    yield start, len(html), None
                return
            letter = html[start + 2 : start + 3] if after == "/" else after
            if after and after in "!?":
                stop = end + 1
            elif letter.isascii() and letter.isalpha():
                found = TAG.match(html, start)
                stop = found.end()
            else:
                at = start + 1
                continue
        sent = yield start, stop, found
        at = stop if sent is None else sent


class Opened:
    """The open elements, each with the state around it. The last of a name, and of those that end no item, are known without a search."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[bool, bool, bool]]] = []
        self.places: dict[str, list[int]] = {}
        self.walls: list[int] = []

    def open(self, tag: str, state: tuple[bool, bool, bool]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in NOT_ENDED_THROUGH:
            self.walls.append(len(self.stack))
        self.stack.append((tag, state))

    def close(self, tag: str, through_walls: bool) -> tuple[bool, bool, bool] | None:
        """End the last element of a name and all within it; the state around it. None where there is none to end."""
        mine = self.places.get(tag)
        if not mine or not through_walls and self.walls and self.walls[-1] > mine[-1]:
            return None
        k = mine[-1]
        state = self.stack[k][1]
        while len(self.stack) > k:
            name, _ = self.stack.pop()
            self.places[name].pop()
            if self.walls and self.walls[-1] == len(self.stack):
                self.walls.pop()
        return state


def page_blocks(html: str | None) -> list[tuple[str, int]]:
    """Blocks of text in page order, each with what mark-up says of it. The time grows with the page's length, however broken it is."""
    out: list[tuple[str, int]] = []
    now: list[str] = []
    # A state is (silent, apart, in an article).
    opened = Opened()
    state = (False, False, False)

    def flush() -> None:
        text = SPACES.sub(" ", "".join(now)).strip()
        now.clear()
        if text:
            out.append((text, APART if state[1] else INSIDE if state[2] else PLAIN))

    html = html or ""
    at = 0
    scan = tokens(html)
    token = next(scan, None)
    while token is not None:
        start, stop, found = token
        if start > at and not state[0]:
            now.append(decoded(html[at:start]))
        at = stop
        if found:
            tag = found[2].lower()
            if tag in BLOCKS:
                flush()
            if found[1]:
                state = opened.close(tag, True) or state
            elif tag not in VOID:
                if tag in ENDED_BY_LIKE:
                    # A new item or paragraph ends an open one, unless a list, table or section lies between.
                    state = opened.close(tag, False) or state
                if tag in RAW:
                    # Its text is raw up to its own end and never shown.
                    end = RAW_END[tag].search(html, at)
                    at = end.start() if end else len(html)
                silent, apart, article = state
                named = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTES.findall(found[3])} if found[3].strip() else {}
                names = f"{named.get('class', '')} {named.get('id', '')}".strip()
                opened.open(tag, state)
                apart = apart or tag in OUTSIDE or (tag == "header" and not article) or named.get("role", "").lower() in ROLES
                if not apart and names and tag in CONTAINERS:
                    apart = not (MARKS if article else OUTER_MARKS).isdisjoint(PARTS_OF_NAMES.split(names.lower()))
                own = tag in ("article", "main") or tag in ("div", "section", "td") and not article and bool(names and ARTICLE_MARKS.search(names))
                state = (silent or tag in SILENT or "hidden" in named, apart, article or own and not apart)
        try:
            token = scan.send(at)
        except StopIteration:
            token = None
    if at < len(html) and not state[0]:
        now.append(decoded(html[at:]))
    flush()
    return out


def lcs_lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """LCS length of all of x with each prefix of y; one row at a time, by a running maximum."""
    row = np.zeros(len(y) + 1, np.int32)
    for item in x:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(y == item, row[:-1] + 1, 0)))
    return row


def shared_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of a's lines lie in a longest common subsequence with b. Memory is linear: the halves of a are matched apart."""
    keep = np.zeros(len(a), bool)
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            keep[a0] = True
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            keep[a1 - 1] = True
            a1, b1 = a1 - 1, b1 - 1
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            keep[a0] = bool((b[b0:b1] == a[a0]).any())
            continue
        half = (a0 + a1) // 2
        first = lcs_lengths(a[a0:half], b[b0:b1])
        rest = lcs_lengths(a[half:a1][::-1], b[b0:b1][::-1])[::-1]
        cut = b0 + int(np.argmax(first + rest))
        work += [(a0, half, b0, cut), (half, a1, cut, b1)]
    return keep


def common_lines(a: np.ndarray, b: np.ndarray, also: frozenset[int]) -> set[int]:
    """Line numbers of a that are shared with b, whose lines are also the set `also`."""
    mine = [k for k, h in enumerate(a.tolist()) if h in also]
    if not mine:
        return set()
    held = frozenset(a[mine].tolist())
    theirs = [k for k, h in enumerate(b.tolist()) if h in held]
    return {mine[k] for k in np.flatnonzero(shared_lines(a[mine], b[theirs])).tolist()}


class Page:
    """A page's lines as hashes; main numbers its own lines (of its article, or plain ones), longest first."""

    def __init__(self, place: int, host: str, path: str, lines: bytes, kinds: bytes, sizes: bytes):
        self.place, self.host, self.path = place, host, path
        self.lines, self.kinds = np.frombuffer(lines, np.int64), np.frombuffer(kinds, np.uint8)
        self.all = self.lines.tolist()
        # The hash of all lines counts as one that the page holds and that tells it: pages that are equal are copies.
        self.whole = int.from_bytes(hashlib.blake2b(lines, digest_size=8).digest(), "little", signed=True)
        self.held = frozenset(self.all) | {self.whole}
        wanted = INSIDE if INSIDE in kinds else PLAIN
        lengths = np.frombuffer(sizes, np.uint32)
        self.main = sorted(np.flatnonzero(self.kinds == wanted).tolist(), key=lambda k: (-int(lengths[k]), k))
        self.telling: list[int] = []

    def copies(self, other: Page) -> bool:
        return not (other.held.isdisjoint(self.telling) and self.held.isdisjoint(other.telling))


def find_telling_lines(pages: list[Page]) -> None:
    """Each page's longest lines of its own that at most half of the pages around it on its host have."""
    counts: Counter[int] = Counter()
    low = high = 0
    for at, page in enumerate(pages):
        if at and page.host != pages[at - 1].host:
            counts.clear()
            low = high = at
        while high < len(pages) and high <= at + REACH and pages[high].host == page.host:
            counts.update(pages[high].held)
            high += 1
        while low < at - REACH:
            counts.subtract(pages[low].held)
            low += 1
        page.telling = [*islice((page.all[k] for k in page.main if 2 * counts[page.all[k]] <= high - low), TELLING_LINES), page.whole]


def nearness(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def around(pages: list[Page], at: int, step: int) -> Iterator[Page | None]:
    """The pages of the host to one side, the nearest first; None where more follow after REACH of them."""
    for k in range(at + step, at + step * (REACH + 2), step):
        if not (0 <= k < len(pages) and pages[k].host == pages[at].host):
            return
        yield pages[k] if abs(k - at) <= REACH else None


def partners(page: Page, before: Iterator[Page | None], after: Iterator[Page | None]) -> Iterator[Page | None]:
    """The pages of the host nearest by path (the longer common beginning, then the fewer pages between, then the one before), without copies of the page or of each other.

    before and after: the pages to each side, the nearest first. Where a side ends in None, more of it is not at hand, and
    which page is next is not known: None, and no more.
    """
    taken: list[Page] = []
    left, right = next(before, False), next(after, False)
    while left is not False or right is not False:
        if left is None or right is None:
            yield None
            return
        by_left = nearness(page.path, left.path) if left else -1
        by_right = nearness(page.path, right.path) if right else -1
        if by_left > by_right or by_left == by_right and page.place - left.place <= right.place - page.place:
            next_page, left = left, next(before, False)
        else:
            next_page, right = right, next(after, False)
        if not page.copies(next_page) and not any(p.copies(next_page) for p in taken):
            taken.append(next_page)
            yield next_page


def deleted_lines(page: Page, before: Iterator[Page | None], after: Iterator[Page | None]) -> list[int] | None:
    """Numbers of the page's lines that go: those shared with its nearest partner, and of an article those shared with each of several. None where pages that are not at hand decide.

    A page that would leave nothing of this one is no partner either.
    """
    if not page.host or not page.main:
        return []
    main = frozenset(page.main)
    gone: set[int] = set()
    inside: set[int] | None = None
    met = 0
    for partner in partners(page, before, after):
        if partner is None:
            return None
        shared = common_lines(page.lines, partner.lines, partner.held)
        if main <= shared:
            continue
        met += 1
        if met == 1:
            gone = {k for k in shared if page.kinds[k] != INSIDE}
        article = {k for k in shared if page.kinds[k] == INSIDE}
        inside = article if inside is None else inside & article
        if not inside or met == PARTNERS:
            break
    if inside and met >= LEAST_PARTNERS:
        gone |= inside
    return sorted(gone)


def main_text(blocks: list[tuple[str, int]], gone: list[int]) -> str:
    """The blocks that stay, joined: those of the page's article where it has one, else those that mark-up doesn't set apart."""
    wanted = INSIDE if any(kind == INSIDE for _, kind in blocks) else PLAIN
    away = set(gone)
    return " ".join(text for k, (text, kind) in enumerate(blocks) if kind == wanted and k not in away)


def line_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def page_key() -> list:
    """Two 64-bit hashes that tell rows apart by their contents; equal rows have one result."""
    return [F.xxhash64("page_id", "url", "html").alias("k1"), F.xxhash64("html", F.lit(1), "url", F.lit(2), "page_id").alias("k2")]


def page_lines(pages: DataFrame) -> DataFrame:
    """k1, k2, page_id, host, path, and of each line its hash, kind and length, of every row."""
    keyed = pages.select(
        *page_key(), "page_id", F.coalesce(F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"), "html",
    )

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, kinds, sizes = [], [], []
            for html in batch.column(5):
                blocks = page_blocks(html.as_py())
                lines.append(np.array([line_hash(t) for t, _ in blocks], np.int64).tobytes())
                kinds.append(bytes(kind for _, kind in blocks))
                sizes.append(np.array([len(t) for t, _ in blocks], np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *(pa.array(x, pa.binary()) for x in (lines, kinds, sizes))], names=["k1", "k2", "page_id", "host", "path", "lines", "kinds", "sizes"])

    return keyed.mapInArrow(per_batch, "k1 long, k2 long, page_id long, host string, path string, lines binary, kinds binary, sizes binary")


def numbered(ordered: DataFrame) -> tuple[DataFrame, int]:
    """Rows of sorted partitions with their place in the whole order (`place`), known without one task that sees all rows, and how many there are.

    Each partition numbers its own rows; only the partitions' sizes come to the driver. Rows that repeat (k1, k2) lie
    side by side and are one.
    """

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2 = np.asarray(batch.column("k1")), np.asarray(batch.column("k2"))
            fresh = np.ones(len(k1), bool)
            fresh[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            fresh[0] = last != (k1[0], k2[0])
            last = (k1[-1], k2[-1])
            batch = batch.filter(pa.array(fresh))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], names=[*batch.schema.names, "part", "own"])
            at += n

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    held = written(ordered.mapInArrow(per_partition, f"{fields}, part int, own long"), "ordered-lines")
    sizes = sorted((r["part"], r["n"]) for r in held.groupBy("part").agg(F.max("own").alias("n")).collect())
    starts, total = [], 0
    for part, last in sizes:
        starts.append((part, total))
        total += last + 1
    begin = held.sparkSession.createDataFrame(starts, "part int, start long")
    return held.join(F.broadcast(begin), "part").withColumn("place", F.col("start") + F.col("own")).drop("part", "own", "start"), total


PAGE = ["place", "host", "path", "lines", "kinds", "sizes"]


def told_pages(group: pd.DataFrame) -> tuple[pd.DataFrame, list[Page]]:
    """The rows of a block in order, and their pages with telling lines."""
    group = group.sort_values("place")
    held = [Page(*row) for row in group[PAGE].itertuples(index=False)]
    find_telling_lines(held)
    return group, held


def differences(pages: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """k1, k2, gone: the numbers of the lines to delete, for each distinct row that has any.

    Most pages find their partners among REACH pages to each side; for the others all of their host is looked through (farther).
    """
    rows = written(page_lines(pages), "page-lines")
    places, total = numbered(rows.repartitionByRange("host", "path", "page_id", "k1", "k2").sortWithinPartitions("host", "path", "page_id", "k1", "k2"))
    # A row goes to its own block and to those where it is a neighbour, or a neighbour's neighbour.
    edges = F.sequence(F.floor((F.greatest(F.col("place") - 2 * REACH, F.lit(0))) / block_rows), F.floor((F.col("place") + 2 * REACH) / block_rows))
    # As many partitions as blocks, up to what a driver can schedule; beyond, a partition takes several blocks one after the other.
    dealt = lambda df: df.withColumn("block", F.explode(edges)).repartition(min(total // block_rows + 1, MOST_PARTITIONS), "block").groupBy("block")

    def per_block(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group, held = told_pages(group)
        own = (group["place"] // block_rows == key[0]).to_numpy()
        gone = [(k, deleted_lines(held[k], around(held, k, -1), around(held, k, 1))) for k in np.flatnonzero(own).tolist()]
        gone = [(k, g) for k, g in gone if g != []]
        at = [k for k, _ in gone]
        return pd.DataFrame({"k1": group["k1"].to_numpy()[at], "k2": group["k2"].to_numpy()[at], "host": group["host"].to_numpy()[at], "gone": pd.Series([g for _, g in gone], dtype=object)})

    def told(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group, held = told_pages(group)
        group["telling"] = pd.Series([p.telling for p in held], dtype=object, index=group.index)
        group["held"] = pd.Series([list(p.held) for p in held], dtype=object, index=group.index)
        return group[group["place"] // block_rows == key[0]][["k1", "k2", *PAGE, "telling", "held"]]

    found = written(dealt(places).applyInPandas(per_block, "k1 long, k2 long, host string, gone array<int>"), "differences")
    unknown = found.where("gone IS NULL")
    if unknown.isEmpty():
        return found.select("k1", "k2", "gone")
    hosts = unknown.select("host").distinct()
    every = dealt(places.join(hosts, "host", "left_semi")).applyInPandas(told, "k1 long, k2 long, place long, host string, path string, lines binary, kinds binary, sizes binary, telling array<long>, held array<long>")
    return found.where("gone IS NOT NULL").select("k1", "k2", "gone").unionByName(farther(written(every, "told-lines"), unknown.select("k1", "k2")))


def runs_of(rows: DataFrame, items: str, wanted: DataFrame) -> DataFrame:
    """host, line, first and last place of each run of rows side by side that have a line among `items`, for the lines wanted (host, line)."""
    having = rows.select("host", "place", F.explode(items).alias("line")).join(wanted.distinct(), ["host", "line"], "left_semi")
    number = F.row_number().over(Window.partitionBy("host", "line").orderBy("place"))
    return having.withColumn("run", F.col("place") - number).groupBy("host", "line", "run").agg(F.min("place").alias("first"), F.max("place").alias("last")).drop("run")


def free_places(at: int, end: int, step: int, runs: list[tuple[int, int]], most: int) -> tuple[list[int], bool]:
    """The places from `at` (without it) to `end` in which no run lies, up to `most` of them, and whether there are more. runs are in order, the nearest first."""
    out: list[int] = []
    at += step
    nearest = iter(runs)
    run = next(nearest, None)
    while (end - at) * step >= 0:
        low, high = run or (None, None)
        if run and (high < at if step > 0 else low > at):
            run = next(nearest, None)
        elif run and low <= at <= high:
            at = (high if step > 0 else low) + step
        elif len(out) == most:
            return out, True
        else:
            out.append(at)
            at += step
    return out, False


def farther(rows: DataFrame, unknown: DataFrame) -> DataFrame:
    """k1, k2, gone of the rows (k1, k2) whose partners lie beyond REACH: exact, over whole hosts.

    rows: all pages of the hosts in question, with their telling lines. Copies mostly lie side by side, so those of a page are known as runs of places and are
    stepped over without a look at each. Of the others the nearest are compared first, and more of them until all pages have been decided.
    """
    asked = rows.join(unknown, ["k1", "k2"], "left_semi")
    lines = lambda c: asked.select("place", "host", F.explode(c).alias("line"))
    copies = [lines(mine).join(runs_of(rows, theirs, lines(mine).select("host", "line")), ["host", "line"]) for mine, theirs in (("telling", "held"), ("held", "telling"))]
    runs = copies[0].unionByName(copies[1]).groupBy("place").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs"))
    ends = rows.groupBy("host").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    left = written(asked.select("place", "host").join(ends, "host").join(runs, "place", "left").drop("host"), "copy-runs")
    out, most = None, 4 * PARTNERS
    while left is not None:
        # The more places a page asks for, the fewer pages are decided in one group.
        together = max(1, 256 * 4 * PARTNERS // most)

        def near(batches: Iterator[pd.DataFrame], most: int = most) -> Iterator[pd.DataFrame]:
            for batch in batches:
                cells = []
                for at, low, high, runs in batch[["place", "low", "high", "runs"]].itertuples(index=False):
                    known = [] if runs is None else [(r["first"], r["last"]) for r in runs]
                    before = free_places(at, low, -1, sorted((r for r in known if r[0] < at), key=lambda r: -r[1]), most)
                    cells.append((at, *before, *free_places(at, high, 1, [r for r in known if r[1] > at], most)))
                yield pd.DataFrame(cells, columns=["place", "before", "more_before", "after", "more_after"])

        def decide(key: tuple, pages: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
            held = {}
            for row, telling in zip(others[PAGE].itertuples(index=False), others["telling"], strict=True):
                held[row.place] = page = Page(*row)
                page.telling = list(telling)
            keys = dict(zip(others["place"], zip(others["k1"], others["k2"], strict=True), strict=True))
            side = lambda places, more: iter([held[k] for k in places] + [None] * bool(more))
            cells = [(r.place, *keys[r.place], deleted_lines(held[r.place], side(r.before, r.more_before), side(r.after, r.more_after))) for r in pages.itertuples(index=False)]
            return pd.DataFrame(cells, columns=["place", "k1", "k2", "gone"])

        at = left.mapInPandas(near, "place long, before array<long>, more_before boolean, after array<long>, more_after boolean").withColumn("block", F.floor(F.col("place") / together))
        at = written(at, "near-places")
        needed = at.select(F.col("block").alias("of"), F.explode(F.concat(F.array("place"), "before", "after")).alias("place")).distinct().join(rows.drop("held"), "place")
        done = written(at.groupBy("block").cogroup(needed.groupBy("of")).applyInPandas(decide, "place long, k1 long, k2 long, gone array<int>"), "differences")
        known = done.where("gone IS NOT NULL AND size(gone) > 0").select("k1", "k2", "gone")
        out = known if out is None else out.unionByName(known)
        rest = done.where("gone IS NULL").select("place")
        left, most = None if rest.isEmpty() else left.join(rest, "place", "left_semi"), 8 * most
    return out


def extract_main_text(pages: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """page_id, url, text, n_chars and n_shared (lines deleted as shared) of every row.

    A page is compared with the nearest pages of its host, in the order of paths, that are no copies of it, however far off
    they lie. Lines shared with the nearest go; lines inside an article go where each of PARTNERS pages (at least
    LEAST_PARTNERS, where the host has no more) has them. Blocks that mark-up sets apart go in any case, and where a page
    has an article so does what lies outside it. The result doesn't depend on partitions or block_rows.
    Null or empty html gives an empty text; a null url has no host and is compared with nothing. Rows that repeat give
    a row each, with equal texts; ties in the order are broken by page_id and contents. Long pages are taken whole.
    An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    both = rows.select(*page_key(), "*").join(differences(rows, block_rows), ["k1", "k2"], "left")

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, shared = [], []
            for html, gone in zip(batch.column(2), batch.column(3), strict=True):
                away = gone.as_py() or []
                texts.append(main_text(page_blocks(html.as_py()), away))
                shared.append(len(away))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(shared, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_shared"])

    return both.select("page_id", "url", "html", "gone").mapInArrow(per_batch, "page_id long, url string, text string, n_chars long, n_shared long")
