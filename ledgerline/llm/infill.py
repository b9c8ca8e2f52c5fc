"""Fill-in-the-middle transformation with a wavelet matrix over character classes (operator 11).

A slice of texts is one string of bytes.  Each byte has a class of three bits: a byte that
continues a character, or the first byte of a character, which may be white space or not, and
may begin a word or a line.  A wavelet matrix (three levels of bits with popcounts, reordered by each
level's bit) answers how many bytes of a class stand before a place.  The starts of a unit
(characters, words or lines) are some of the classes, so the sum of their ranks counts the units before a
place; bisection on that sum finds the byte at which a given unit begins, for both cuts of all texts
of the slice at once.

The draw of cuts and form is read from the digest of a seed and the document's id, so it doesn't depend on
partitions or retries.  A cut after k units stands where unit number k (from 0) begins; after 0 units at
the start of the text, after all of them at its end.

``psm``: marks and texts in the order prefix, suffix, middle; ``spm``: suffix, prefix, middle.
``plain``: the text itself, for empty texts, texts that hold a mark, and the share drawn for it.  So the
texts between marks hold none, and ``restored`` finds the parts again from output and form alone.

Memory of a task: about 8 bytes a byte of its slice; a text longer than a slice is a slice of its own.

Defined cases: a null text is empty; a null id is drawn as the empty text; repeated rows give
repeated results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_slices

MARKS = ("<P>", "<S>", "<M>")           # before prefix, suffix and middle
PLAIN, PSM, SPM = "plain", "psm", "spm"

# Classes: inside a character; then by white space or not, start of a word, start of a line.
INNER, SPACE, LETTER, WORD, LINE_SPACE, LINE_WORD = range(6)
UNITS = {"char": (SPACE, LETTER, WORD, LINE_SPACE, LINE_WORD), "word": (WORD, LINE_WORD), "line": (LINE_SPACE, LINE_WORD)}
_LEVELS = 3

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def classes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of every byte; ``starts``: where texts begin."""
    before = np.empty_like(raw)
    before[1:] = raw[:-1]
    before[starts[starts < len(raw)]] = 10              # a text begins a line
    first, space = (raw & 0xC0) != 0x80, _IS_SPACE[raw]
    out = np.where(space, SPACE, np.where(_IS_SPACE[before], WORD, LETTER)).astype(np.uint8)
    line = before == 10
    out[line] = np.where(space[line], LINE_SPACE, LINE_WORD)
    out[~first] = INNER
    return out


class WaveletMatrix:
    """Ranks over a sequence of small symbols."""

    def __init__(self, symbols: np.ndarray, levels: int = _LEVELS):
        self.n, self.levels = len(symbols), []
        self.zeros = []
        for level in reversed(range(levels)):
            bit = (symbols >> level) & 1
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(packed) // 8 + 2, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((words, ones))
            zero = bit == 0
            self.zeros.append(int(np.count_nonzero(zero)))
            symbols = np.concatenate([symbols[zero], symbols[~zero]])

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        words, ones = level
        block, rest = at >> 6, (at & 63).astype(np.uint64)
        return ones[block] + np.bitwise_count(words[block] & ((np.uint64(1) << rest) - np.uint64(1)))

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each place."""
        begin, at = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            if (symbol >> (len(self.levels) - 1 - k)) & 1:
                begin, at = zeros + self._ones(level, begin), zeros + self._ones(level, at)
            else:
                begin, at = begin - self._ones(level, begin), at - self._ones(level, at)
        return at - begin

    def count(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of the symbols stand before each place: a sum of ranks, or what the others leave."""
        others = [s for s in range(LINE_WORD + 1) if s not in symbols]
        if len(others) < len(symbols):
            return at - sum(self.rank(s, at) for s in others)
        return sum(self.rank(s, at) for s in symbols)

    def select(self, symbols: tuple[int, ...], k: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The place of the k-th symbol (from 0, over the whole sequence) between lo and hi, hi when it isn't there."""
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.count(symbols, mid + 1) <= k[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]


def draws(key: Column, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers from the digest of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(rows: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "char", seed: str = "1",
                   plain_percent: int = 10, spm_percent: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """(key, n units, form, prefix_chars, middle_chars, output) of every text."""
    starts_unit = UNITS[unit]
    kind = rows.schema[key].dataType.simpleString()
    given = rows.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    given = given.select("key", "text", *draws(F.col("key"), seed))
    p_mark, s_mark, m_mark = (m.encode() for m in marks)

    def run(batches):
        for part in text_slices(batches, "text"):
            texts = part.column(1).cast(pa.large_string())
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            body = texts.buffers()[2]
            raw = bytes(memoryview(body)[at[0]:at[-1]]) if body is not None else b""
            at = at - at[0]
            begin, end = at[:-1], at[1:]
            matrix = WaveletMatrix(classes(np.frombuffer(raw, np.uint8), begin))
            before = matrix.count(starts_unit, at)
            base, n = before[:-1], np.diff(before)
            h = [part.column(2 + i).to_numpy() for i in range(4)]
            one, two = h[0] % (n + 1), h[1] % (n + 1)
            cuts = []
            for k in (np.minimum(one, two), np.maximum(one, two)):
                where = matrix.select(starts_unit, base + k, begin, end)
                cuts.append(np.where(k == 0, begin, where))
            chars = UNITS["char"]
            char_at = [matrix.count(chars, x) for x in (begin, *cuts)]
            plain = (begin == end) | (h[2] % 100 >= 100 - plain_percent)
            for mark in marks:
                plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
            spm = h[3] % 100 < spm_percent
            out, forms = [], []
            for i, (a, b, c, d) in enumerate(zip(begin.tolist(), cuts[0].tolist(), cuts[1].tolist(), end.tolist())):
                if plain[i]:
                    out.append(raw[a:d])
                    forms.append(PLAIN)
                elif spm[i]:
                    out.append(b"".join((s_mark, raw[c:d], p_mark, raw[a:b], m_mark, raw[b:c])))
                    forms.append(SPM)
                else:
                    out.append(b"".join((p_mark, raw[a:b], s_mark, raw[c:d], m_mark, raw[b:c])))
                    forms.append(PSM)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n), pa.array(forms), pa.array(char_at[1] - char_at[0], mask=plain),
                 pa.array(char_at[2] - char_at[1], mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                ["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    done = given.mapInArrow(run, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return done.withColumnRenamed("key", key)


def restored(output: str = "output", form: str = "form", marks: tuple[str, str, str] = MARKS) -> Column:
    """The text, from the output and its form."""
    pieces = F.split(F.col(output), "|".join(re.escape(m) for m in marks), -1)
    return (F.when(F.col(form) == PSM, F.concat(pieces[1], pieces[3], pieces[2]))
            .when(F.col(form) == SPM, F.concat(pieces[2], pieces[3], pieces[1]))
            .otherwise(F.col(output)))
