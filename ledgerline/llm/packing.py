"""Order-preserving packing into fixed windows by dynamic programming (operator 3).

Documents, in ascending id order, form one token stream for each bucket of
neighbouring ids.  A window may end at a document end (free), a sentence end,
or inside a sentence (only offered where sentences are long); each kind has a
penalty in tokens.  The programme picks the cuts that minimise padding plus
penalties over the whole segment:

    f(j) = penalty(j) + min over i with pos(j) - pos(i) <= window of
           f(i) + window - (pos(j) - pos(i))

so the minimum of f(i) + pos(i) over a sliding range is all that a transition
needs, kept in a monotone queue: one push and at most one pop per cut.

A task holds one segment (about ``segment_tokens`` tokens, closed at a
document end) at a time.  Every token lies in exactly one piece.

Defined cases: null text counts as empty, an empty document is its end token
alone; rows with a null doc_id form the first bucket; repeated rows are packed
one by one, ordered by a hash of their text; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import UnitIds, order_buckets, space_pieces, strings, text_slices

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, cut string")
DOC_END, SENTENCE, HARD = 0, 1, 2
CUT_NAMES = ("document", "sentence", "inside")
MARKS = ".,;:!?"
_RUNS = re.compile(r" \S(?:.*\S)?\Z", re.S).match      # from a space on, without one at the end
SLICE = 12 << 20            # a larger slice looks up a common word less often

# Fixed value: the pre-tokenizer pattern of byte-level BPE files that name the pattern by "use_regex".
BYTE_LEVEL_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def choose_cuts(pos: np.ndarray, kind: np.ndarray, window: int, penalties: tuple[int, int, int]) -> list[int]:
    """Indexes of the chosen cuts among candidates at increasing ``pos`` (the
    last one is always chosen).  Neighbouring candidates, and the start at 0,
    must lie at most ``window`` apart."""
    n = len(pos)
    at = [0, *pos.tolist()]
    pen = [penalties[k] for k in kind.tolist()]
    best, back = [0] * (n + 1), [0] * (n + 1)
    queue: deque[tuple[int, int]] = deque([(0, 0)])     # (f(i) + pos(i), i), increasing
    for j in range(1, n + 1):
        p = at[j]
        while at[queue[0][1]] < p - window:
            queue.popleft()
        low, i = queue[0]
        back[j] = i
        value = low + window + pen[j - 1]               # f(j) + pos(j)
        best[j] = value - p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], n
    while j:
        cuts.append(j - 1)
        j = back[j]
    return cuts[::-1]


def candidates(ids: np.ndarray, ends: np.ndarray, opens: np.ndarray, closes: np.ndarray,
               breaks: np.ndarray, long_gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions and their kinds.  ``ends``: document ends; ``opens``,
    ``closes`` and ``breaks``: by token, whether it starts with white space,
    ends a sentence, or ends a line."""
    after = ids[1:]
    sentence = np.flatnonzero(breaks[ids[:-1]] | (closes[ids[:-1]] & opens[after])) + 1
    pos = sorted_set(sentence, ends)
    gaps = np.diff(pos, prepend=0)
    wide = np.flatnonzero(gaps > long_gap)
    extra = [np.arange(pos[k] - gaps[k] + long_gap, pos[k], long_gap) for k in wide]
    every = sorted_set(pos, *extra) if extra else pos
    kind = np.full(len(every), HARD, np.int8)
    kind[np.searchsorted(every, pos)] = SENTENCE
    kind[np.searchsorted(every, ends)] = DOC_END
    return every, kind


def sorted_set(*parts: np.ndarray) -> np.ndarray:
    """The distinct numbers of all parts, ascending."""
    x = np.sort(np.concatenate(parts))
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def ranked_encoding(tokenizer):
    """The same ids from a faster library, where the file allows it: byte-level BPE whose ids
    are the order of its merges, with the usual pattern and nothing else in the way.  None otherwise."""
    import json

    import tiktoken

    spec = json.loads(tokenizer.to_str())
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and not spec["normalizer"] and before.get("type") == "ByteLevel" and before.get("use_regex", True)
             and not before.get("add_prefix_space") and not model.get("ignore_merges") and not model.get("dropout")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
    if not plain:
        return None
    # Byte-level vocabularies write printable bytes as themselves, the others as letters from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*shown}))}
    added = {t["content"] for t in spec["added_tokens"]}
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    if any(c not in byte_of for t in vocab for c in t):
        return None
    merged = [vocab.get("".join(m) if not isinstance(m, str) else m.replace(" ", "")) for m in model["merges"]]
    letters = [vocab.get(c) for c in byte_of]
    if None in merged or None in letters or merged != sorted(set(merged)) or max(letters) > min(merged, default=1 << 40) or (
            len(vocab) != len(merged) + len(letters)):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}
    return tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Packer:
    """Tokenizer, token classes and the programme's parameters in a worker."""

    def __init__(self, tokenizer_path: str, window: int, end_id: int, penalties, long_gap: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True
        self.window, self.end_id, self.penalties, self.long_gap = window, end_id, penalties, long_gap
        self.words = UnitIds(self.encode_words, limit=400_000)
        self.ranked = ranked_encoding(self.tokenizer)
        size = max(self.tokenizer.get_vocab_size(), end_id + 1)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        # Byte-level vocabularies write space, tab, LF and CR as these letters.
        self.opens = np.array([s.startswith(("Ġ", "ĉ", "Ċ", "č")) for s in names])
        self.closes = np.array([s.endswith((".", "!", "?")) for s in names])
        self.breaks = np.array([s.endswith("Ċ") for s in names])
        self.opens[end_id] = True
        # One letter of a byte-level token stands for one byte.
        self.bytes_of = np.array([len(s) for s in names], np.int64)

    def encode_words(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units in order, and the number of ids of each.

        Units that start at a space and end without one are encoded as one
        running text (a cut before such a space is none for the tokenizer);
        the byte lengths of the tokens tell where each unit ends.
        """
        runs = [bool(_RUNS(u)) for u in units]
        joined = list(compress(units, runs))
        texts = ["".join(joined[k:k + 2000]) for k in range(0, len(joined), 2000)]
        single = [u for u, ok in zip(units, runs) if not ok]
        flat = [np.array(x, np.uint32) for x in self.encode_texts(texts + single)]
        ids = np.concatenate(flat[:len(texts)] or [np.empty(0, np.uint32)])
        lens = np.zeros(len(units), np.int64)
        ends = np.cumsum(pc.binary_length(pa.array(joined, pa.string())).to_numpy(zero_copy_only=False), dtype=np.int64)
        lens[runs] = np.bincount(np.searchsorted(ends, np.cumsum(self.bytes_of[ids]), "left"), minlength=len(joined))
        alone = np.flatnonzero(~np.array(runs, bool))
        lens[alone] = [len(x) for x in flat[len(texts):]]
        if len(alone):
            # Put the ids of both kinds in the order of the units.
            owner = np.concatenate([np.repeat(np.flatnonzero(runs), lens[runs]), np.repeat(alone, lens[alone])])
            ids = np.concatenate([ids, *flat[len(texts):]])[np.argsort(owner, kind="stable")]
        return ids, lens

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        if self.ranked is not None:
            return [self.ranked.encode_ordinary(x) for x in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text, each closed by the end id.

        Marks behind a letter or digit are a word of their own to the tokenizer, so
        distinct pieces are looked up as words and marks; both are far fewer.  Arrow
        kernels cut and number them, and one gather puts the ids of the slice together.
        """
        codes, first, values, heads, whole = space_pieces(texts)
        bare = pc.utf8_rtrim(values, MARKS)
        cut = pc.and_(pc.not_equal(pc.binary_length(bare), pc.binary_length(values)), pc.match_substring_regex(bare, r"[\pL\pN]$"))
        words = pc.if_else(cut, bare, values).dictionary_encode()
        marked = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        marks = pc.replace_substring_regex(values.filter(cut), r"(?s)^.*[\pL\pN]", "").dictionary_encode()
        own = [u for units in whole.values() for u in units]      # of texts cut one by one
        n_words, n_marks = len(words.dictionary), len(marks.dictionary)
        spaced = pc.binary_join_element_wise(pa.scalar(" "), words.dictionary, "")
        index = self.words.index(strings(spaced) + strings(marks.dictionary) + heads + own)
        # A unit is a word and its marks, or one of the other strings.
        n = len(values)
        one = np.concatenate([index[words.indices.to_numpy()], index[n_words + n_marks:]])
        two = np.full(len(one), -1, np.int64)
        two[marked] = index[n_words + marks.indices.to_numpy()]
        parts = np.stack([one, two], axis=1).reshape(-1)
        kept = parts >= 0
        lens = np.zeros(len(parts), np.int64)
        lens[kept] = self.words.lengths(parts[kept])
        ids = np.append(self.words.gather(parts[kept]), np.uint32(self.end_id))
        unit_lens = np.append(lens.reshape(-1, 2).sum(axis=1), 1)          # the last unit is the end id
        unit_starts = np.cumsum(unit_lens) - unit_lens
        # The units of all texts, with the end behind each.
        at_head = np.arange(len(heads)) + n
        codes = codes.copy()
        codes[first[:-1]] = at_head
        pieces, at = [], n + len(heads)
        for i in sorted(whole):
            pieces.append((i, np.arange(at, at + len(whole[i]))))
            at += len(whole[i])
        counts = np.diff(first)
        stream = np.insert(codes, first[1:], at)
        if pieces:
            # Put the texts cut one by one in their places.
            begin = first[:-1] + np.arange(len(counts))
            runs, last = [], 0
            for i, own_codes in pieces:
                runs += [stream[last:begin[i]], own_codes]
                last = begin[i] + counts[i]
                counts[i] = len(own_codes)
            stream = np.concatenate([*runs, stream[last:]])
        sizes = unit_lens[stream]
        total = np.cumsum(sizes)
        small = np.int32 if max(total[-1:].max(initial=0), len(ids)) < 2 ** 31 else np.int64
        place = np.repeat((unit_starts[stream] - (total - sizes)).astype(small), sizes)
        place += np.arange(len(place), dtype=small)
        out = ids.take(place)
        edges = np.concatenate([[0], total[np.cumsum(counts + 1) - 1]]) if len(counts) else np.zeros(1, np.int64)
        return [out[x:y] for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def pack(self, docs: list[tuple[int | None, np.ndarray]], first_sequence: int):
        """Piece rows of one segment and the number of its sequences."""
        ids = np.concatenate([x for _, x in docs])
        sizes = np.array([len(x) for _, x in docs], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        pos, kind = candidates(ids, ends, self.opens, self.closes, self.breaks, self.long_gap)
        cuts = choose_cuts(pos, kind, self.window, self.penalties)
        stops = pos[cuts]
        begins = np.concatenate([[0], stops[:-1]])
        edges = sorted_set(stops, ends)                  # where a piece ends
        from_ = np.concatenate([[0], edges[:-1]])
        doc = np.searchsorted(ends, from_, "right")
        seq = np.searchsorted(stops, from_, "right")
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(from_.tolist(), edges.tolist())]
        names = np.array(CUT_NAMES)[kind[np.searchsorted(pos, edges)]]
        keys = [k for k, _ in docs]
        return pa.RecordBatch.from_arrays([
            pa.array([keys[d] for d in doc.tolist()], pa.int64()),
            pa.array(from_ - starts[doc]), pa.array(edges - from_), pa.array(crc, pa.int64()),
            pa.array(sizes[doc]), pa.array(first_sequence + seq), pa.array(from_ - begins[seq]),
            pa.array(names.tolist(), pa.string()),
        ], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cut"]), len(stops)


_PACKERS: dict[tuple, Packer] = {}


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1,
                   penalties: tuple[int, int, int] = (0, 16, 48), long_gap: int = 96,
                   docs_per_bucket: int = 1024, segment_tokens: int = 1 << 20) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence,
    the checksum of its ids, and the kind of boundary that ends it.

    Sequence ids are unique over the table: bucket * 2^31 + number within the
    bucket.  The text is shuffled once, by bucket; a bucket is a stream, so a
    bucket of any size needs the memory of one segment only.
    """
    key = (tokenizer_path, window, end_id, tuple(penalties), long_gap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _PACKERS:
            _PACKERS[key] = Packer(*key)
        packer = _PACKERS[key]
        bucket, held, tokens, sequence = None, [], 0, 0
        for part in text_slices(batches, "text", SLICE):
            ids = packer.encode(part.column(2))
            for b, doc, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), ids):
                if held and (b != bucket or tokens >= segment_tokens):
                    rows, n = packer.pack(held, ((bucket + 1) << 31) + sequence)
                    yield rows
                    sequence, held, tokens = sequence + n, [], 0
                if b != bucket:
                    bucket, sequence = b, 0
                held.append((doc, x))
                tokens += len(x)
        if held:
            yield packer.pack(held, ((bucket + 1) << 31) + sequence)[0]

    bucket = order_buckets(docs, docs_per_bucket)
    return (docs.select(bucket.alias("bucket"), F.col("doc_id").cast("long").alias("doc_id"), "text")
            .repartition("bucket")
            .sortWithinPartitions("bucket", "doc_id", F.xxhash64("text"))
            .mapInArrow(run, PIECES))
