"""Helpers shared by the operators: written intermediates, bounded Arrow
slices, dictionary-coded words, document order buckets, bounded samples."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import delete_folder, fresh_dir

SLICE_BYTES = 4 << 20


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Gives the executors this package, once for each application (as
    ``--py-files`` would), so that tasks can import it wherever they run."""
    import ledgerline

    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(ledgerline.__file__)))
    if os.path.isdir(top):
        folder = tempfile.mkdtemp(prefix="ledgerline-code-")   # the driver serves the file from here
        atexit.register(shutil.rmtree, folder, True)
        context.addPyFile(shutil.make_archive(os.path.join(folder, "ledgerline_code"), "zip", top, "ledgerline"))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by a path that only Spark needs to understand."""
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read
    back: cuts the lineage and survives the loss of executors."""
    path = fresh_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Removes the folder of a table that ``written`` made and nothing reads any more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        delete_folder(df.sparkSession, folder)


def text_slices(batches, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that ``column`` holds at most ``max_bytes`` per
    slice (one longer text makes a slice of its own); nulls become empty."""
    for batch in batches:
        k = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(k), "")
        batch = batch.set_column(k, column, texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def ascii_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words between ASCII white space (0x20, 0x09-0x0D), A-Z lower-cased.

    Returns (code per word, first word of each text plus the total, distinct
    words).  Other Unicode white space belongs to words.
    """
    codes, first, words = _coded(pc.ascii_split_whitespace(pc.ascii_lower(texts)))
    return codes, first, words.cast(pa.binary()).to_pylist()


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """As ``ascii_words`` for texts that are lower-cased already; the words as an Arrow array."""
    return _coded(pc.ascii_split_whitespace(texts))


def unicode_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """As ``ascii_words``, lower-cased and cut by the rules of Unicode."""
    codes, first, words = _coded(pc.utf8_split_whitespace(pc.utf8_lower(texts)))
    return codes, first, words.to_pylist()


def _coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    words = lists.flatten()
    lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # Leading and trailing white space leaves empty pieces.
    keep = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False).astype(bool)
    if not keep.all():
        doc = np.repeat(np.arange(len(lens)), lens)[keep]
        words = words.filter(pa.array(keep))
        lens = np.bincount(doc, minlength=len(lens)).astype(np.int64)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, np.concatenate([[0], np.cumsum(lens)]), coded.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (in place)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_EDGES = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def subwords(words: list[str], sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of words, marked as <word> without ASCII
    punctuation at their edges: (bucket, index of the word), by word."""
    marked = [f"<{w.strip(_EDGES)}>" for w in words]
    lens = np.fromiter(map(len, marked), np.int64, len(marked))
    chars = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lens)
    grams, owners = [], []
    for n in sizes:
        if len(chars) < n:
            continue
        m = len(chars) - n + 1
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + chars[j:j + m]
        inside = owner[:m] == owner[n - 1:]
        grams.append((mix64(h[inside]) >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(owner[:m][inside])
    grams = np.concatenate(grams) if grams else np.empty(0, np.int64)
    owners = np.concatenate(owners) if owners else np.empty(0, np.int64)
    order = np.argsort(owners, kind="stable")
    return grams[order], owners[order]


class WordMargins:
    """Mean subword weight of words under one or more linear models, remembered
    for up to ``limit`` words (emptied between slices beyond it)."""

    def __init__(self, weights: np.ndarray, sizes: tuple[int, ...], limit: int = 300_000):
        self.weights, self.sizes, self.limit = weights, sizes, limit
        self.bits = int(weights.shape[0]).bit_length() - 1
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, weights.shape[1]), np.float32)

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known, self.rows = {}, self.rows[:0]
        new = [w for w in words if w not in self.known]
        parts = [self.rows]
        for at in range(0, len(new), 50_000):
            chunk = new[at:at + 50_000]
            grams, owner = subwords(chunk, self.sizes, self.bits)
            count = np.maximum(np.bincount(owner, minlength=len(chunk)), 1)
            rows = np.zeros((len(chunk), self.weights.shape[1]), np.float32)
            for k in range(rows.shape[1]):
                rows[:, k] = np.bincount(owner, weights=self.weights[grams, k], minlength=len(chunk)) / count
            parts.append(rows)
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.rows = np.concatenate(parts)
        return self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]


_JOINED = r" (?:[\s\x0b\x1c-\x1f\x{85}\p{Z}]|$)"
_CUT = re.compile(r"(?= \S)")


def strings(column: pa.Array) -> list[str]:
    """As ``to_pylist`` for text without nulls, some ten times faster."""
    return column.to_numpy(zero_copy_only=False).tolist()


def space_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, list[str], dict[int, list[str]]]:
    """Texts cut before every space that a non-space follows.

    Byte-level BPE pre-tokenizers never join two sides of such a cut, so the
    ids of a text are those of its units one after the other.  Returns (code of each
    piece, first piece of each text plus the total, distinct pieces without the space before
    them, first pieces of the texts (no space before them), and by text the units of those in which
    white space follows a space: such runs must stay whole, so these texts are cut one by one).
    """
    lists = pc.split_pattern(texts, " ")
    words = lists.flatten()
    lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(lens)])
    heads = strings(words.take(pa.array(first[:-1])))
    joined = np.flatnonzero(pc.match_substring_regex(texts, _JOINED).to_numpy(zero_copy_only=False))
    whole = {int(i): [u for u in _CUT.split(texts[int(i)].as_py()) if u] for i in joined}
    return codes, first, coded.dictionary, heads, whole


def space_units(texts: pa.Array) -> tuple[list[np.ndarray], list[str]]:
    """The unit codes of each text and the unit strings (not all distinct), see ``space_pieces``."""
    codes, first, pieces, heads, whole = space_pieces(texts)
    values = [" " + w for w in strings(pieces)]
    codes[first[:-1]] = len(values) + np.arange(len(heads))   # no space before the first piece
    values += heads
    out = [codes[a:b] for a, b in zip(first[:-1], first[1:])]
    for i, units in whole.items():
        out[i] = len(values) + np.arange(len(units))
        values += units
    return out, values


class UnitIds:
    """Token ids of strings, remembered up to ``limit`` strings.

    ``encode`` maps a list of strings to (all their ids, number of ids of each).
    The memory is emptied between slices once it is over the limit, so it stays bounded and
    no string is ever skipped.
    """

    def __init__(self, encode, limit: int = 250_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)

    def index(self, values: list[str]) -> np.ndarray:
        if len(self.known) > self.limit:
            self._clear()
        known = self.known
        new = list(dict.fromkeys(v for v in values if v not in known))
        for part in range(0, len(new), 20_000):
            chunk = new[part:part + 20_000]
            ids, lens = self.encode(chunk)
            k = len(known)
            at = int(self.starts[k])
            while k + len(chunk) + 1 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            while at + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[at:at + len(ids)] = ids
            self.starts[k + 1:k + 1 + len(chunk)] = at + np.cumsum(lens)
            known.update(zip(chunk, range(k, k + len(chunk))))
        return np.fromiter(map(known.__getitem__, values), np.int64, len(values))

    def lengths(self, index: np.ndarray) -> np.ndarray:
        return self.starts[index + 1] - self.starts[index]

    def gather(self, index: np.ndarray) -> np.ndarray:
        """Ids of the indexed strings, one after the other."""
        starts = self.starts[index]
        lens = self.lengths(index)
        total = int(lens.sum())
        shift = np.repeat(starts - (np.cumsum(lens) - lens), lens)
        return self.ids[shift + np.arange(total)]


_SEGMENTS = 64


def order_buckets(docs: DataFrame, docs_per_bucket: int, column: str = "doc_id", tie: str = "text"):
    """A column expression numbering ranges of ``column`` of about
    ``docs_per_bucket`` rows each, in ascending order.

    Quantiles cut the column into up to 64 segments, and each of these into ranges of equal
    width; so ids far from all others widen one segment only.  Rows without an id come
    first, as negative numbers, in ranges of a hash of ``tie`` (ascending too).
    Uneven ids make uneven buckets, never wrong ones.
    """
    col = F.col(column).cast("double")
    n, nulls, lo, hi = docs.agg(F.count(column), F.count(F.when(F.col(column).isNull(), 1)),
                                F.min(col), F.max(col)).first()
    null_buckets = max(1, -(-nulls // docs_per_bucket))
    share = F.xxhash64(tie).cast("double") / F.lit(2.0 ** 64) + 0.5
    null_place = F.least(F.floor(share * null_buckets), F.lit(null_buckets - 1)) - null_buckets
    if not n:
        return null_place.cast("long")
    cuts = []
    if n > docs_per_bucket:
        m = min(_SEGMENTS, -(-n // docs_per_bucket))
        cuts = docs.select(col.alias("x")).stat.approxQuantile("x", [i / m for i in range(1, m)], 0.2 / m)
    lows = sorted({float(lo), *map(float, cuts)})
    highs = [*lows[1:], float(hi) + 1.0]
    inner = max(1, -(-n // (docs_per_bucket * len(lows))))
    segment = F.lit(0)
    for c in lows[1:]:
        segment = segment + F.when(col >= F.lit(c), 1).otherwise(0)
    low = F.get(F.array(*map(F.lit, lows)), segment)
    width = F.get(F.array(*[F.lit(max((h - x) / inner, 1e-300)) for x, h in zip(lows, highs)]), segment)
    place = segment * inner + F.greatest(F.least(F.floor((col - low) / width), F.lit(inner - 1)), F.lit(0))
    return F.when(F.col(column).isNull(), null_place).otherwise(place).cast("long")


def fold(doc_id: str):
    """crc32 of the id as text, modulo 5 (a null id counts as fold 0)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(0))


def bounded_sample(rows: DataFrame, by: str, at_most: int) -> DataFrame:
    """At most ``at_most`` rows for each value of ``by``, the first by a hash of
    doc_id: the same rows at every layout.

    Each of 64 parts of a value keeps that many first, so a frequent value is
    never sorted in one task and the last step meets a bounded number of rows.
    """
    draw = F.xxhash64("doc_id", F.lit(7))
    rows = rows.withColumn("__part", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(64)))
    for keys in ([by, "__part"], [by]):
        order = Window.partitionBy(*keys).orderBy(draw, "doc_id")
        rows = rows.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= at_most).drop("__rank")
    return rows.drop("__part")


def fitted(samples: DataFrame, docs: DataFrame, label: str, fit) -> bytes:
    """The model that ``fit`` makes of a bounded sample (doc_id, label) with
    the texts of ``docs``, fitted in one task; only the model reaches the driver.

    ``fit`` takes an iterator of (text, label) in doc_id order and returns bytes.
    """
    rows = (docs.select("doc_id", "text").join(F.broadcast(samples), "doc_id")
            .select("doc_id", "text", F.col(label).cast("string").alias("label"))
            .repartition(1).sortWithinPartitions("doc_id", F.xxhash64("text")))

    def run(batches):
        def pairs():
            for part in text_slices(batches, "text"):
                yield from zip(part.column(1).to_pylist(), part.column(2).to_pylist())

        yield pa.RecordBatch.from_arrays([pa.array([fit(pairs())], pa.binary())], ["model"])

    model = rows.mapInArrow(run, "model binary").first()    # no rows may mean no task at all
    return bytes(model["model"]) if model else fit(iter(()))
