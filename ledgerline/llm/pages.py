"""Main text of HTML pages by differencing against the nearest URL (operator 7).

Pages are put in order of host and URL path, so a page's neighbour in that
order is the page of its host whose path is nearest.  A page is read into text
lines (one per block element).  The lines of a page and of its neighbour are
aligned by their longest common subsequence; lines that both share are page
furniture and are deleted.

The structure of a page decides first where it speaks: what lies in menus,
headers, footers, asides, forms, adverts, notices or comments is furniture
whether shared or not, and what lies in ``article`` or ``main`` is text even
where a neighbour repeats it (reprints and copies share whole articles, so
differencing alone would delete them).  The alignment decides every other line,
that is, pages or parts of pages without such marks, beside an article too.

Pages are dealt by ranges of (host, path, page_id) and streamed in order, one
page and its neighbour's line hashes at a time.  A page's neighbour is the page
before it, for the first page of a host the one after it.  Every range also
reads the pages next to its two edges, so where it begins changes nothing.

Defined cases: null html counts as empty and gives empty text; a null or odd
URL counts as an empty host and path; the only page of a host is aligned with
nothing; repeated rows are neighbours of each other; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import text_slices, written

FURNITURE, OTHER, ARTICLE = 0, 1, 2
_BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary
table tbody td tfoot th thead title tr ul""".split())
_FURNITURE = set("""nav header footer aside form button select textarea menu dialog noscript template iframe object
svg canvas head title script style option label input""".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Raw text elements are read by the parser itself and never hold tags.
_MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|masthead|menu|"
    r"modal|nav|navbar|navigation|newsletter|notice|popup|promo|related|share|sharing|sidebar|social|sponsor\w*|"
    r"subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_HEAD = "header of an article"
_FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog"}


class _Lines(HTMLParser):
    """Collects (line, zone) pairs."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.open: list[tuple[str, int]] = []         # block and furniture elements with their zone
        self.depth: Counter[str] = Counter()          # how many of them are open, by name
        self.heads: list[list] = []                   # headers in articles: [first line, holds a heading]
        self.held: list[str] = []

    def zone(self) -> int:
        return self.open[-1][1] if self.open else OTHER

    def flush(self) -> None:
        line = " ".join("".join(self.held).split())
        if line:
            self.lines.append((line, self.zone()))
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.held.append(" ")
        block = tag in _BLOCKS
        if block:
            self.flush()
            if self.open and self.open[-1][0] == "p":   # a block ends an open paragraph
                self.close_from(len(self.open) - 1)
        if tag in _VOID:
            return
        given = dict(attrs)
        # The head of an article is text if it holds a heading, which its end tells.
        head = tag == "header" and self.zone() == ARTICLE
        if tag in _HEADINGS:
            for h in self.heads:
                h[1] = True
        marked = (tag in _FURNITURE and not head or given.get("role") in _FURNITURE_ROLES or "hidden" in given
                  or tag != "body" and tag != "html" and
                  _MARKED.search(f"{given.get('class') or ''} {given.get('id') or ''}") is not None)
        if block or marked:
            if marked and not block:
                self.flush()
            zone = self.zone()
            if marked or zone == FURNITURE:
                zone = FURNITURE
            elif tag in ("article", "main") or given.get("role") == "main":
                zone = ARTICLE
            if head and zone == ARTICLE:
                self.heads.append([len(self.lines), False])
            elif head:
                head = False
            self.open.append((_HEAD if head else tag, zone))
            self.depth[tag] += 1

    def close_from(self, k: int) -> None:
        """Ends the open elements from the k-th on."""
        for tag, _ in self.open[k:]:
            self.depth["header" if tag == _HEAD else tag] -= 1
            if tag == _HEAD:
                first, headed = self.heads.pop()
                if not headed:
                    self.lines[first:] = [(x, FURNITURE) for x, _ in self.lines[first:]]
        del self.open[k:]

    def handle_startendtag(self, tag, attrs):
        if tag in _VOID:
            self.handle_starttag(tag, attrs)
        elif tag in _BLOCKS:
            self.flush()

    def handle_endtag(self, tag):
        if tag in _BLOCKS:
            self.flush()
        if not self.depth[tag]:                        # nothing to end: no search through what is open
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag or tag == "header" and self.open[k][0] == _HEAD:
                self.flush()
                self.close_from(k)
                break

    def handle_data(self, data):
        if not self.open or self.open[-1][0] not in ("script", "style"):
            self.held.append(data)


def page_lines(html: str) -> list[tuple[str, int]]:
    """The text lines of a page in order, each with its zone."""
    reader = _Lines()
    reader.feed(html)
    reader.close()
    reader.flush()
    reader.close_from(0)
    return reader.lines


def shared_lines(a: list[int], b: list[int]) -> set[int]:
    """Indexes in ``a`` of a longest common subsequence with ``b``: the longest
    chain of increasing places in ``b``, found with one bisection per match."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = {*range(head), *range(len(a) - tail, len(a))}
    places = defaultdict(list)
    for j in range(len(b) - tail - 1, head - 1, -1):
        places[b[j]].append(j)                         # descending: one match per line of a
    ends: list[int] = []
    chains: list[tuple] = []                           # (index in a, the chain before)
    for i in range(head, len(a) - tail):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[k], chains[k] = j, chain
    chain = chains[-1] if chains else None
    while chain:
        out.add(chain[0])
        chain = chain[1]
    return out


def main_text(lines: list[tuple[str, int]], neighbour: list[int]) -> tuple[str, int, int]:
    """The text of a page, the number of lines that its neighbour shares, and of those left out for
    their place in the page alone.

    The alignment decides first: a shared line goes.  The structure overrules it in an article, whose lines another
    page may repeat, and takes out furniture that no neighbour shares.
    """
    shared = shared_lines([hash(x) for x, _ in lines], neighbour)
    kept, placed = [], 0
    for i, (x, zone) in enumerate(lines):
        if i in shared and zone != ARTICLE:
            continue
        if zone == FURNITURE:
            placed += 1
            continue
        kept.append(x)
    return "\n\n".join(kept), len(shared), placed


def with_edges(rows: DataFrame, keys: tuple[str, ...], n: int) -> DataFrame:
    """``rows`` with ``place``, the number (from 0) of one of ``n`` ranges of
    ``keys``, and again as ``ghost`` in a range whose edge they are next to, if
    its edge has the same host.

    Only the keys are read to cut the ranges, and one row per range is ordered.
    """
    rows = rows.withColumn("key", F.struct(*keys))
    firsts = (rows.select("key", *keys).repartitionByRange(n, *keys).select(F.spark_partition_id().alias("part"), "key")
              .groupBy("part").agg(F.min("key").alias("first")))
    # Written: ranges are cut by a sample, which another run would draw anew.
    bounds = written(firsts, "ranges").agg(F.collect_list("first").alias("bounds"))
    rows = (rows.crossJoin(F.broadcast(bounds))
            .withColumn("range", F.size(F.filter("bounds", lambda b: b <= F.col("key"))) - 1).drop("bounds"))
    edges = rows.groupBy("range").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    over = Window.orderBy("range")
    edges = edges.select("range", "first", "last", F.lag("range").over(over).alias("below"),
                         F.lag("last").over(over).alias("before"), F.lead("range").over(over).alias("above"),
                         F.lead("first").over(over).alias("after"))
    ghosts = (edges.where("last.host = after.host").select(F.col("last").alias("edge"), F.col("above").alias("to"))
              .unionByName(edges.where("first.host = before.host").select(F.col("first").alias("edge"),
                                                                         F.col("below").alias("to")))
              .groupBy("edge").agg(F.collect_list("to").alias("to")))
    places = F.concat(F.array("range"), F.coalesce("to", F.array().cast("array<int>")))
    return (rows.join(F.broadcast(ghosts), F.col("key") == F.col("edge"), "left")
            .withColumn("place", F.explode(places)).withColumn("ghost", F.col("place") != F.col("range"))
            .drop("key", "edge", "to", "range"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page, its lines that the neighbour shares, and those left out as furniture alone."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                        F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    id_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None                                  # (place and host, line hashes) of the page before
        waiting = None                                 # the first page of a host, until its successor is known
        for part in text_slices(batches, "html"):
            out = []
            ids, urls = part.column(0), part.column(1)
            hosts = list(zip(part.column(5).to_pylist(), part.column(3).to_pylist()))
            ghosts = part.column(6).to_pylist()
            for i, html in enumerate(part.column(2).to_pylist()):
                lines = page_lines(html)
                hashes = [hash(x) for x, _ in lines]
                page = (ids[i].as_py(), urls[i].as_py(), lines)
                near = before is not None and hosts[i] == before[0]
                if waiting:
                    out.append((*waiting[:2], *main_text(waiting[2], hashes if near else [])))
                    waiting = None
                if ghosts[i]:
                    pass                               # its own range returns it
                elif near:
                    out.append((*page[:2], *main_text(lines, before[1])))
                else:
                    waiting = page
                before = (hosts[i], hashes)
            yield _rows(out, ids.type)
        if waiting:
            yield _rows([(*waiting[:2], *main_text(waiting[2], []))], None)

    def _rows(out, kind):
        cols = list(zip(*out)) if out else [[]] * 5
        kind = kind or pa.int64()
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], kind), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()),
             pa.array([len(t) for t in cols[2]], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
            ["page_id", "url", "text", "n_chars", "shared_lines", "furniture_lines"])

    keys = ("host", "path", "page_id", "url")
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (with_edges(rows, keys, n).repartitionById(n, F.col("place"))
            .sortWithinPartitions("place", *keys, F.xxhash64("html"))
            .mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long, shared_lines long, furniture_lines long"))
