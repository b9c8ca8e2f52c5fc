"""Benchmark decontamination with suffix arrays of the training texts (operator 13).

Words are runs outside ASCII punctuation and white space, A-Z lower-cased.  A
benchmark block (all items, or as many as ``BLOCK_BYTES`` hold) is numbered by its
own vocabulary and broadcast.  Every slice of documents is a shard: its words become a
stream of block numbers (0: a word that no item has, and the end of a document), three
words to a 63-bit key.  The shard's suffix array holds the suffixes whose first three
words may begin a test suffix (a bit table decides, false hits only cost time), or that
begin with an item of fewer words; ties are sorted on, three words at a time, as deep
as the longest item.  Every test suffix is then found by binary search, three words
at a time, within the range of the words before; this gives its longest verbatim match
in the shard, and at the window's depth the range of all its occurrences.

``scan`` adds the occurrences up to one row per document, ``longest_matches`` tells each
test suffix's longest match over all shards with its place, and ``decontaminate``
removes the affected documents.

A benchmark beyond one block takes one pass over the documents for each block; only
hit documents are shuffled then, to unite their hits.  Items with one window in common
are never paired with all documents: occurrences are counted by position, and the items of a
document are united in the task that holds its text.

Memory of a task: about 40 bytes a word of its slice; a text longer than a slice is a
shard of its own.

Defined cases: null or wordless texts have no words and no hits; null or wordless items
have no window; an item of fewer words than the window is one window; items with a null
id take part under the empty id; repeated item ids count once; repeated documents are
judged each; windows never cross documents; empty tables give no rows or no hits;
further columns are ignored by ``scan`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import split_words, text_slices

WINDOW = 10
BLOCK_BYTES = 4 << 20

_STEP, _BITS = 3, 21                    # words in a key, bits of a word
_SPREAD, _TABLE_BITS = np.uint64(0x9E3779B97F4A7C15), 22

# a-z for A-Z, a space for everything that ends a word.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def folded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code per word, first word of each text plus the total, distinct words)."""
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    raw = bytes(memoryview(body)[at[0]:at[-1]]).translate(_FOLD) if body is not None else b""
    folded = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(at - at[0])), pa.py_buffer(raw))
    return split_words(folded)


def _keys(words: np.ndarray) -> np.ndarray:
    """Three words from each position on; zeros after the end, which has a key too."""
    w = np.concatenate([words, np.zeros(_STEP, np.int64)])
    n = len(words) + 1
    return (w[:n] << (2 * _BITS)) | (w[1:n + 1] << _BITS) | w[2:n + 2]


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * _SPREAD) >> np.uint64(64 - _TABLE_BITS)


def _cut(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys with only their first words."""
    shift = _BITS * (_STEP - words)
    return (keys >> shift) << shift


class Block:
    """A bounded part of the benchmark: its vocabulary, its suffixes and their windows."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        codes, first, vocabulary = folded_words(pa.array([t for _, t in items], pa.large_string()))
        if len(vocabulary) >= 1 << _BITS:
            raise ValueError("a benchmark block has too many distinct words; lower block_bytes")
        self.vocabulary = vocabulary
        lens = np.diff(first)
        self.names = sorted({i for i, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        owner = np.repeat(np.fromiter((number[i] for i, _ in items), np.int64, len(items)), lens)
        place = np.arange(len(codes)) - np.repeat(first[:-1], lens)
        rest = np.repeat(lens, lens) - place
        need = np.where(rest >= window, window, np.where(place == 0, rest, 0))
        keys = _keys(codes + 1)[:-1]
        keys = _cut(keys, np.minimum(rest, _STEP))
        self.depth = int(lens.max(initial=0))
        self.keys = keys
        searched = np.flatnonzero((rest >= _STEP) | (need > 0))
        self.at, self.rest, self.need = searched, rest[searched], need[searched]
        self.item, self.place = owner[searched], place[searched]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[_slot(keys[searched[self.rest >= _STEP]])] = True
        # Windows of fewer words than a key begin with these.
        few = np.unique(self.need[(self.need > 0) & (self.need < _STEP)])
        self.short = {int(n): np.unique(_cut(keys[searched[self.need == n]], n)) for n in few}

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Block number of each distinct word, 0 where no item has it."""
        return pc.fill_null(pc.index_in(words, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1


class Shard:
    """The suffix array of one slice of documents, seen through a block."""

    def __init__(self, block: Block, codes: np.ndarray, first: np.ndarray, words: pa.Array):
        self.block = block
        lens = np.diff(first)
        self.starts = first[:-1] + np.arange(len(lens))          # one 0 ends each document
        self.size = int(first[-1]) + len(lens)
        stream = np.zeros(self.size, np.int64)
        doc = np.repeat(np.arange(len(lens)), lens)
        stream[np.arange(len(codes)) + doc] = block.numbers(words)[codes]
        self.keys = _keys(stream)
        found = block.table[_slot(self.keys)] & (stream_full(stream))
        for n, short in block.short.items():
            found |= np.isin(_cut(self.keys, np.int64(n)), short) & (self.keys > 0)
        self.sa = self._sorted(np.flatnonzero(found))

    def _key(self, at: np.ndarray, depth: int) -> np.ndarray:
        return self.keys[np.minimum(at + depth, self.size)]

    def _sorted(self, at: np.ndarray) -> np.ndarray:
        key = self.keys[at]
        order = np.argsort(key, kind="stable")
        sa, key = at[order], key[order]
        left = np.arange(len(sa))                     # places whose order is still open
        group = np.zeros(len(sa), np.int64)
        for depth in range(_STEP, self.block.depth + _STEP, _STEP):
            new = np.ones(len(left), bool)
            new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
            # Past a word of no item there is nothing to find, so no order is needed.
            tied = ~(new & np.append(new[1:], True)) & (key & ((1 << _BITS) - 1) > 0)
            group, left = np.cumsum(new)[tied], left[tied]
            if not len(left):
                break
            own = sa[left]
            key = self._key(own, depth)
            order = np.lexsort((key, group))
            sa[left], key = own[order], key[order]
        return sa

    def _first(self, lo: np.ndarray, hi: np.ndarray, depth: int, key: np.ndarray) -> np.ndarray:
        """The first place from lo to hi whose key at this depth is not smaller."""
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._key(self.sa[mid], depth) < key[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]

    def _range(self, lo, hi, depth, key, words):
        """The part of lo to hi whose next ``words`` words are those of the key."""
        low = _cut(key, words)
        lo = self._first(lo, hi, depth, low)
        return lo, self._first(lo, hi, depth, low + (np.int64(1) << (_BITS * (_STEP - words))))

    def search(self):
        """(length of the longest match, one place of it, first and end of the window's range) by test suffix."""
        b, n = self.block, len(self.block.at)
        lo, hi = np.zeros(n, np.int64), np.full(n, len(self.sa))
        length, first, last = (np.zeros(n, np.int64) for _ in range(3))
        live, depth = np.arange(n), 0
        while len(live):
            key = b.keys[b.at[live] + depth]
            due = (b.need[live] > depth) & (b.need[live] <= depth + _STEP)
            own = live[due]
            first[own], last[own] = self._range(lo[own], hi[own], depth, key[due], b.need[own] - depth)
            words = np.minimum(b.rest[live] - depth, _STEP)
            best = np.zeros(len(live), np.int64)
            for fewer in range(_STEP):                       # all of the key's words, else fewer of them
                some = np.flatnonzero((best == 0) & (words > fewer))
                at = live[some]
                low, high = self._range(lo[at], hi[at], depth, key[some], words[some] - fewer)
                ok = low < high
                best[some[ok]] = words[some[ok]] - fewer
                lo[at[ok]], hi[at[ok]] = low[ok], high[ok]
            length[live] += best
            live = live[(best == _STEP) & (b.rest[live] > depth + _STEP)]
            depth += _STEP
        return length, lo, first, last

    def documents(self) -> tuple[np.ndarray, dict[int, list[str]], np.ndarray]:
        """(hit words of each document, item names of the hit ones, hit flag of each stream place)."""
        b = self.block
        _, _, first, last = self.search()
        hit = np.flatnonzero(last > first)
        if not len(hit):
            return np.zeros(len(self.starts), np.int64), {}, np.zeros(self.size, bool)
        # Equal windows have equal ranges; each range is walked once.
        ranges, which = np.unique(np.stack([first[hit], last[hit], b.need[hit]]), axis=1, return_inverse=True)
        which = which.reshape(-1)
        begin, end, width = ranges
        sizes = end - begin
        at = self.sa[np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
        of = np.repeat(np.arange(len(sizes)), sizes)
        edge = np.bincount(at, minlength=self.size + 1) - np.bincount(at + width[of], minlength=self.size + 1)
        covered = np.cumsum(edge)[:self.size] > 0
        n_hit = np.add.reduceat(covered.astype(np.int64), self.starts)
        order = np.argsort(which, kind="stable")
        items = np.split(b.item[hit][order], np.cumsum(np.bincount(which))[:-1])
        doc = np.searchsorted(self.starts, at, "right") - 1
        pairs = np.unique(doc * len(sizes) + of)
        owners, of = pairs // len(sizes), pairs % len(sizes)
        cuts = np.flatnonzero(np.diff(owners)) + 1
        names, known = {}, {}
        for d, own in zip(owners[np.concatenate([[0], cuts])].tolist(), np.split(of, cuts)):
            key = own.tobytes()                          # copies of a document meet the same windows
            if key not in known:
                known[key] = [b.names[i] for i in np.unique(np.concatenate([items[k] for k in own])).tolist()]
            names[d] = known[key]
        return n_hit, names, covered


def stream_full(stream: np.ndarray) -> np.ndarray:
    """Whether three words of the vocabulary stand from each place on (and the end)."""
    w = np.concatenate([stream, np.zeros(_STEP, np.int64)]) > 0
    n = len(stream) + 1
    return w[:n] & w[1:n + 1] & w[2:n + 2]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int, key: str = "item_id", text: str = "text") -> Iterator[list]:
    """The benchmark in parts of about ``block_bytes``, one at a time on the driver."""
    items = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // block_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    for k in range(n):
        yield [(r["id"], r["text"]) for r in items.where(part == k).collect()]


def _shards(batches, block: Block, column: int):
    for part in text_slices(batches, "text"):
        codes, first, words = folded_words(part.column(column))
        yield part, first, Shard(block, codes, first, words)


def _pass(docs: DataFrame, items: list, window: int) -> DataFrame:
    """(doc_id, text, n_words, hits as pairs of word positions, items) through one block."""
    block = docs.sparkSession.sparkContext.broadcast(Block(items, window))

    def run(batches):
        for part, first, shard in _shards(batches, block.value, 1):
            n_hit, names, _ = shard.documents()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(first)), pa.array(n_hit),
                 pa.array([names.get(i, []) for i in range(part.num_rows)], pa.list_(pa.string()))],
                ["doc_id", "n_words", "n_hit", "items"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_hit long, items array<string>")


def _spans(docs: DataFrame, items: list, window: int) -> DataFrame:
    """Hit documents only: (doc_id, digest, spans of hit words, items) through one block."""
    block = docs.sparkSession.sparkContext.broadcast(Block(items, window))

    def run(batches):
        for part, first, shard in _shards(batches, block.value, 1):
            _, names, covered = shard.documents()
            edges = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
            begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            doc = np.searchsorted(shard.starts, begin, "right") - 1
            rows = sorted(names)
            spans = [[{"a": int(a), "b": int(b)} for a, b in zip(
                begin[doc == d] - shard.starts[d], end[doc == d] - shard.starts[d])] for d in rows]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows, pa.int64())), part.column(2).take(pa.array(rows, pa.int64())),
                 pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                 pa.array([names[d] for d in rows], pa.list_(pa.string()))], ["doc_id", "digest", "spans", "items"])

    return docs.mapInArrow(run, "doc_id long, digest string, spans array<struct<a: long, b: long>>, items array<string>")


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit (words within an occurrence of a window),
    items (sorted ids of the items with occurring windows)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = benchmark_blocks(benchmark, block_bytes)
    head = next(blocks)
    tail = next(blocks, None)
    if tail is None:
        return _pass(texts, head, window)
    # Several blocks: one pass each, then the hits of a document are united.
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    keyed = texts.withColumn("digest", digest)
    passes = [_spans(keyed, head, window), _spans(keyed, tail, window)]
    passes += [_spans(keyed, more, window) for more in blocks]
    spans = F.array_sort(F.flatten(F.collect_set("spans")))
    hits = (reduce(DataFrame.unionByName, passes).groupBy("doc_id", "digest")
            .agg(spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    # Sorted spans, added up by how far each goes beyond those before it.
    reach = F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("spans", reach, lambda s, x: F.struct(
        F.greatest(s["to"], x["b"]).alias("to"),
        (s["n"] + F.greatest(F.lit(0).cast("long"), x["b"] - F.greatest(s["to"], x["a"]))).alias("n")))
    hits = hits.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), covered["n"].alias("n_hit"), "items")
    words = keyed.mapInArrow(_count_words, "doc_id long, digest string, n_words long")
    return (words.join(hits, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _count_words(batches):
    for part in text_slices(batches, "text"):
        _, first, _ = folded_words(part.column(1))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(np.diff(first))],
                                         ["doc_id", "digest", "n_words"])


def longest_matches(docs: DataFrame, benchmark: DataFrame, at_least: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, start, length, doc_id, place) for each suffix of an item with a match of
    ``at_least`` words (at least 3): its longest verbatim match over all shards, and a document and
    word position where it stands (of several the smallest).  Suffixes of equal items are told apart by item id."""
    if at_least < _STEP:
        raise ValueError(f"matches of fewer than {_STEP} words are not looked for")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    passes = []
    for items in benchmark_blocks(benchmark, block_bytes):
        block = docs.sparkSession.sparkContext.broadcast(Block(items, at_least))

        def run(batches, block=block):
            for part, _, shard in _shards(batches, block.value, 1):
                length, at, _, _ = shard.search()
                rows = np.flatnonzero(length >= at_least)
                places = shard.sa[at[rows]]
                doc = np.searchsorted(shard.starts, places, "right") - 1
                b = shard.block
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.names[i] for i in b.item[rows]], pa.string()), pa.array(b.place[rows]), pa.array(length[rows]),
                     part.column(0).take(pa.array(doc)), pa.array(places - shard.starts[doc])],
                    ["item_id", "start", "length", "doc_id", "place"])

        passes.append(texts.mapInArrow(run, "item_id string, start long, length long, doc_id long, place long"))
    found = reduce(DataFrame.unionByName, passes)
    best = F.max(F.struct("length", (-F.col("doc_id")).alias("doc"), (-F.col("place")).alias("place")))
    return (found.groupBy("item_id", "start").agg(best.alias("best"))
            .select("item_id", "start", "best.length", (-F.col("best.doc")).alias("doc_id"), (-F.col("best.place")).alias("place")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents in which a window of an item occurs.  Of rows with
    one doc_id all go when one of them is affected; rows without a doc_id are judged by their text."""
    named = docs.where("doc_id IS NOT NULL")
    hit = scan(named, benchmark, window, block_bytes).where("n_hit > 0").select(F.col("doc_id").alias("__hit")).distinct()
    kept = named.join(hit, F.col("doc_id") == F.col("__hit"), "left_anti")
    digest = F.xxhash64("text")
    nameless = docs.where("doc_id IS NULL")
    bad = scan(nameless.select(digest.alias("doc_id"), "text"), benchmark, window, block_bytes).where("n_hit > 0").select(
        F.col("doc_id").alias("__hit")).distinct()
    return kept.unionByName(nameless.join(bad, digest == F.col("__hit"), "left_anti"))
