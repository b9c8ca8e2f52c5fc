"""Byte-level BPE encoding and decoding with DuckDB recursive queries (operator 4).

Every task runs its own in-process DuckDB over the words of its slice of
texts.  Encoding: one row per token position joins the merge table; each
round contracts the leftmost pair of minimum rank in every word, until no
word has a pair left.  Decoding: token rows join the vocabulary and an
ordered aggregation puts their bytes together.

The words of a text are the matches of the pre-tokenizer pattern.  Texts are
first cut before spaces (where no match can span), so the pattern and the
recursion see each distinct unit of a slice once.  Words longer than
``LONG_WORD`` bytes would need one round per merge; the same contraction rule
runs on a heap for them instead.

Defined cases: null text counts as empty; an empty text has no ids and
decodes to no bytes; repeated rows are encoded one by one; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import UnitIds, space_units, text_slices

LONG_WORD = 128

_ENCODE = """
WITH RECURSIVE state(w, p, t, k) AS (
  SELECT w, p, t, 0 FROM word_bytes
  UNION ALL
  SELECT s.w, s.p - (s.p > b.best % 1024)::INT, CASE WHEN s.p = b.best % 1024 THEN b.best // 1024 ELSE s.t END, s.k + 1
  FROM state s
  JOIN (SELECT l.w, min(m.r * 1024 + l.p) AS best
        FROM state l
        JOIN state n ON n.w * 1024 + n.p = l.w * 1024 + l.p + 1
        JOIN merges m ON m.ab = l.t * 65536 + n.t
        GROUP BY l.w) b ON b.w = s.w
  WHERE s.p <> b.best % 1024 + 1
)
SELECT s.w, s.t FROM state s JOIN (SELECT w, max(k) AS k FROM state GROUP BY w) e ON e.w = s.w AND e.k = s.k
ORDER BY s.w, s.p
"""

_DECODE = """
SELECT d, string_agg(v.hex, '' ORDER BY p) AS hex
FROM tokens JOIN vocabulary v ON v.t = tokens.t GROUP BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class DuckBpe:
    """The merge table and vocabulary in one in-process DuckDB."""

    def __init__(self, ranks_path: str, pattern: str, memory: str = "256MB"):
        import duckdb
        import regex

        self.ranks = read_ranks(ranks_path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        pairs = [(self.ranks[tok[:i]], self.ranks[tok[i:]], r)
                 for tok, r in self.ranks.items() for i in range(1, len(tok))
                 if tok[:i] in self.ranks and tok[i:] in self.ranks]
        a, b, r = np.array(pairs, np.int64).T if pairs else np.empty((3, 0), np.int64)
        self._load("merges", pa.table({"ab": a * 65536 + b, "r": r}))
        self._load("vocabulary", pa.table({
            "t": np.array(list(self.ranks.values()), np.int64),
            "hex": [tok.hex() for tok in self.ranks]}))
        self.units = UnitIds(self.encode_units)
        self.words = UnitIds(self.encode_words)

    def _load(self, name: str, rows: pa.Table) -> None:
        self.con.register("__rows", rows)
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM __rows")
        self.con.unregister("__rows")

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in order, and the number of ids of each: by the
        recursive query, and by the heap for long words."""
        raw = [w.encode() for w in words]
        lens = np.array([len(b) for b in raw], np.int64)
        brief = lens <= LONG_WORD
        data = np.frombuffer(b"".join(b for b, x in zip(raw, brief) if x), np.uint8)
        word = np.repeat(np.flatnonzero(brief), lens[brief])
        first = np.cumsum(lens[brief]) - lens[brief]
        rows = pa.table({"w": word, "p": np.arange(len(data)) - np.repeat(first, lens[brief]),
                         "t": self.byte_ids[data]})
        self.con.register("word_bytes", rows)
        got = self.con.sql(_ENCODE).to_arrow_table()
        self.con.unregister("word_bytes")
        w, t = got["w"].to_numpy(), got["t"].to_numpy()
        for i in np.flatnonzero(~brief):
            long = np.array(self.contract_long(raw[i]), np.int64)
            w, t = np.concatenate([w, np.full(len(long), i)]), np.concatenate([t, long])
        if not brief.all():
            order = np.argsort(w, kind="stable")
            w, t = w[order], t[order]
        return t, np.bincount(w, minlength=len(words))

    def contract_long(self, word: bytes) -> list[int]:
        """Leftmost minimum-rank contraction with a heap over live neighbours."""
        n = len(word)
        tok = [int(self.byte_ids[b]) for b in word]
        end, back, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := self.ranks.get(word[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, j, stop = heapq.heappop(heap)
            if not live[i] or end[i] != j or not live[j] or end[j] != stop:
                continue
            tok[i], end[i], live[j] = r, stop, False
            if stop < n:
                back[stop] = i
            offer(i)
            if back[i] >= 0:
                offer(back[i])
        return [tok[i] for i in range(n) if live[i]]

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [self.pattern.findall(u) for u in units]
        index = self.words.index([w for ws in words for w in ws])
        unit = np.repeat(np.arange(len(units)), [len(ws) for ws in words])
        lens = np.bincount(unit, weights=self.words.lengths(index), minlength=len(units))
        return self.words.gather(index), lens.astype(np.int64)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text."""
        codes, values = space_units(texts)
        index = self.units.index(values)
        return [self.units.gather(index[c]) for c in codes]

    def decode(self, ids: list[np.ndarray], tokens_at_once: int = 1 << 20) -> list[bytes]:
        """Bytes of every id list (long lists in parts of ``tokens_at_once``)."""
        out: list[list[bytes]] = [[] for _ in ids]
        parts = [(d, x[at:at + tokens_at_once]) for d, x in enumerate(ids)
                 for at in range(0, len(x), tokens_at_once)]
        while parts:
            n, size = 0, 0
            while n < len(parts) and (n == 0 or size + len(parts[n][1]) <= tokens_at_once):
                size += len(parts[n][1])
                n += 1
            lens = [len(x) for _, x in parts[:n]]
            self.con.register("tokens", pa.table({
                "d": np.repeat(np.arange(n), lens), "p": np.arange(size),
                "t": np.concatenate([x for _, x in parts[:n]]).astype(np.int64)}))
            for k, text in self.con.execute(_DECODE).fetchall():
                out[parts[k][0]].append((k, bytes.fromhex(text)))
            self.con.unregister("tokens")
            parts = parts[n:]
        return [b"".join(x for _, x in sorted(pieces)) for pieces in out]


_ENGINES: dict[tuple[str, str], DuckBpe] = {}


def engine(ranks_path: str, pattern: str) -> DuckBpe:
    """The engine of this Python worker (made once for each vocabulary)."""
    if (ranks_path, pattern) not in _ENGINES:
        _ENGINES[ranks_path, pattern] = DuckBpe(ranks_path, pattern)
    return _ENGINES[ranks_path, pattern]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
                  key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): ids as little-endian unsigned 32-bit integers, and
    the bytes that those ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = engine(ranks_path, pattern)
        for part in text_slices(batches, text):
            ids = bpe.encode(part.column(1))
            decoded = bpe.decode(ids)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                 pa.array(decoded, pa.binary())], ["key", "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), F.col(text).alias(text)).mapInArrow(
        run, f"key {kind}, ids binary, decoded binary")
    return out.withColumnRenamed("key", key)
