"""Product codes of vectors, with Drake-Hamerly adaptive bounds (operator 12).

Components become the integers floor(scale * x).  Vectors are cut into equal
consecutive parts, and every part position has a codebook that starts as that part of the
vectors with the smallest ids.  A round assigns each part to the nearest entry (squared Euclidean
distance, ties to the lower index) and replaces each used entry by the floored mean of its parts.

Between rounds each part keeps, in a table on the shared folder: its entry with an upper bound
of the distance, its b closest other entries with lower bounds that never decrease along the
list, and one outer bound for all further entries.  When entries move, the bounds move by as much.
A part whose upper bound stays under its first lower bound keeps its entry unseen; else the
distance to its entry is computed, and then the distances to as many of the list as the bounds leave open,
or to all entries beyond the outer bound.  These distances are compared in integers, so rounding decides
nothing: bounds are only trusted when they differ by more than their rounding.  After each round b
shrinks to what all but a hundredth of the parts needed, at least 2.

Distances are products in doubles while these are exact (below 2^53), then 64-bit integers, then
Python integers without bounds, whichever the largest component asks for.

A round is one pass: its tasks write the next table and, in the same files, one row of sums a
task; Spark adds those up, and the driver meets entries x dimension numbers.  The table of the
round before is removed once the next one is complete.

Defined cases: vectors that are null, empty, hold null or non-finite components (also after
scaling), or have another length than the most frequent one take no part; when the length isn't
a multiple of the parts, part i begins at floor(i * length / parts); fewer vectors than entries make
smaller codebooks; rows with a null id are coded, but come last in the choice of first entries;
repeated rows count each, and repeated ids are taken in the order of their components; an error beyond a long
is null, and so is the sum of its label; without a label column all labels are null; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import removed, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
KEPT, LEAST_KEPT = 4, 2

_LIMB = 32
_UP, _DOWN = np.float32(np.inf), np.float32(-np.inf)


def _over(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + 1e-12)).astype(np.float32), _UP)


def _under(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter((x * (1 - 1e-12)).astype(np.float32), _DOWN), np.float32(0))


def state_type(kept: int) -> np.dtype:
    """What a part remembers: entry, upper bound, closest others, their lower bounds, outer bound."""
    return np.dtype([("entry", "u2"), ("up", "<f4"), ("near", "u2", (kept,)), ("low", "<f4", (kept,)), ("out", "<f4")])


class Part:
    """One part position: its codebook, and how far the entries moved to get there."""

    def __init__(self, book: np.ndarray, moved: np.ndarray, peak: int):
        self.book, self.moved, self.most = book, moved, moved.max(initial=0.0)
        self.plain = book.dtype == object
        self.fast = not self.plain and 4 * book.shape[1] * (peak + 1) ** 2 < 2 ** 53
        if self.fast:
            self.wide = book.astype(np.float64)
            self.square = (self.wide ** 2).sum(axis=1)

    def all_distances(self, x: np.ndarray) -> np.ndarray:
        """Exact squared distances of rows to all entries."""
        if self.fast:
            w = x.astype(np.float64)
            return ((w ** 2).sum(axis=1)[:, None] - 2 * (w @ self.wide.T) + self.square).astype(np.int64)
        return np.stack([((x - c) ** 2).sum(axis=1) for c in self.book], axis=1)

    def distances(self, x: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Exact squared distances of each row to its own entries (one, or one column each)."""
        gap = (x[:, None, :] if to.ndim == 2 else x) - self.book[to]
        return (gap * gap).sum(axis=-1)

    def first(self, x: np.ndarray, kept: int) -> np.ndarray:
        """State from the distances to all entries."""
        out = np.zeros(len(x), state_type(kept))
        if len(self.book) == 1:                          # nothing to choose from
            return out
        if self.plain:
            d = self.all_distances(x)
            out["entry"] = [min(range(len(r)), key=lambda k: (r[k], k)) for r in d]
            return out
        d = self.all_distances(x)
        order = np.argsort(d, axis=1, kind="stable")
        root = np.sqrt(np.take_along_axis(d, order, axis=1).astype(np.float64))
        out["entry"], out["up"] = order[:, 0], _over(root[:, 0])
        out["near"], out["low"] = order[:, 1:kept + 1], _under(root[:, 1:kept + 1])
        out["out"] = _under(root[:, kept + 1]) if d.shape[1] > kept + 1 else _UP
        return out

    def next(self, x: np.ndarray, old: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
        """(state after the entries moved, how many of the list each part needed; kept + 1: all entries)."""
        if self.plain or len(self.book) == 1:
            return self.first(x, kept), np.zeros(len(x), np.int64)
        s = np.zeros(len(x), old.dtype)
        s["entry"], s["near"] = old["entry"], old["near"]
        s["up"] = _over(old["up"].astype(np.float64) + self.moved[old["entry"]])
        s["out"] = _under(old["out"].astype(np.float64) - self.most) if len(self.book) > kept + 1 else _UP
        s["low"] = _under(old["low"].astype(np.float64) - self.moved[old["near"]])
        self._order(s)
        need = np.zeros(len(x), np.int64)
        open_ = np.flatnonzero(s["up"] >= s["low"][:, 0])
        if len(open_):
            s["up"][open_] = _over(np.sqrt(self.distances(x[open_], s["entry"][open_]).astype(np.float64)))
            up = s["up"][open_]
            need[open_] = (up[:, None] >= s["low"][open_]).sum(axis=1) + ((up >= s["low"][open_, -1]) & (up >= s["out"][open_]))
        for m in range(1, kept + 1):
            rows = np.flatnonzero(need == m)
            if len(rows):
                near = np.sort(np.concatenate([s["entry"][rows, None], s["near"][rows, :m]], axis=1), axis=1)
                d = self.distances(x[rows], near)
                order = np.argsort(d, axis=1, kind="stable")
                near, root = np.take_along_axis(near, order, axis=1), np.sqrt(np.take_along_axis(d, order, axis=1).astype(np.float64))
                part = s[rows]
                part["entry"], part["up"] = near[:, 0], _over(root[:, 0])
                part["near"][:, :m], part["low"][:, :m] = near[:, 1:], _under(root[:, 1:])
                s[rows] = part
        self._order(s)
        rows = np.flatnonzero(need > kept)
        if len(rows):
            s[rows] = self.first(x[rows], kept)
        return s, need

    @staticmethod
    def _order(s: np.ndarray) -> None:
        """Lower bounds hold for all entries further down the list too."""
        low = np.concatenate([s["low"], s["out"][:, None]], axis=1)
        s["low"] = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1][:, :-1]


def narrowed(old: np.ndarray, kept: int) -> np.ndarray:
    """The state with a shorter list; what falls off goes under the outer bound."""
    before = old["near"].shape[-1]
    if before == kept:
        return old
    new = np.zeros(old.shape, state_type(kept))
    new["entry"], new["up"] = old["entry"], old["up"]
    new["near"], new["low"] = old["near"][..., :kept], old["low"][..., :kept]
    new["out"] = np.minimum(old["out"], old["low"][..., kept])
    return new


def _limbs(values, n: int) -> list[int]:
    """Integers as n rows of limbs that can be added up apart (one limb: the numbers themselves)."""
    values = [int(v) for v in values]
    if n == 1:
        return values
    out = []
    for k in range(n):
        last = k == n - 1
        out += [(v >> (_LIMB * k)) if last else (v >> (_LIMB * k)) & ((1 << _LIMB) - 1) for v in values]
    return out


def _whole(column: pa.Array, dim: int, scale: int, kind: np.dtype) -> np.ndarray:
    """Rows of whole components."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * float(scale))
    if kind == object:
        return np.array([[int(v) for v in row] for row in x], object).reshape(-1, dim)
    return x.astype(np.int64)


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             kept: int = KEPT) -> tuple[DataFrame, list[list[list[int]]]]:
    """(rows of id, label, code (entry of each part, 16 bits big-endian), error; the final codebooks).

    ``error`` is the sum of the parts' squared distances to their entries.
    """
    spark = rows.sparkSession
    given = rows.select(F.col(key).cast("long").alias("id"),
                        (F.col(label) if label else F.lit(None).cast("int")).alias("label"),
                        F.col(vector).cast("array<double>").alias("v"))
    bound = F.lit(float("inf"))
    given = given.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < bound)))
    label_type = dict(given.dtypes)["label"]
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    shape = (given.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(largest).alias("top"))
             .orderBy(F.desc("n"), "dim").first())
    if shape is None:
        return spark.createDataFrame([], f"id long, label {label_type}, code binary, error long"), [[] for _ in range(parts)]
    dim = shape["dim"]
    peak = int(np.ceil(shape["top"] * scale)) + 1
    plain = 4 * dim * peak ** 2 >= 2 ** 62
    kind = np.dtype(object) if plain else np.dtype(np.int64)
    stored = None if plain else next(t for t in (np.int16, np.int32, np.int64) if peak <= np.iinfo(t).max)
    limbs = 1 if not plain else (peak.bit_length() + 48) // _LIMB + 1
    vectors = given.where(F.size("v") == dim)
    head = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = _whole(pa.array([r["v"] for r in head], pa.list_(pa.float64())), dim, scale, kind)
    edges = [i * dim // parts for i in range(parts + 1)]
    cuts = [slice(a, b) for a, b in zip(edges, edges[1:])]
    books = [start[:, c] for c in cuts]
    moved = [np.zeros(len(start))] * parts
    kept = max(1, min(kept, len(start) - 1))

    def matrix(column: pa.Array) -> np.ndarray:
        if plain:
            return np.array([json.loads(v) for v in column.to_pylist()], object).reshape(-1, dim)
        return np.frombuffer(b"".join(column.to_pylist()), stored).reshape(-1, dim).astype(np.int64)

    def packed(x: np.ndarray) -> pa.Array:
        if plain:
            return pa.array([json.dumps([int(v) for v in r]).encode() for r in x], pa.binary())
        return pa.array([r.tobytes() for r in x.astype(stored)], pa.binary())

    def positions():
        return [Part(b, m, peak) for b, m in zip(books, moved)]

    def one_round(was: int | None, now: int):
        """Assigns every part; yields the rows with their states, and last the task's sums."""
        own = positions()
        n_entries = len(start)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((n_entries, dim), kind)
            counts = np.zeros((parts, n_entries), np.int64)
            needs = np.zeros(KEPT + 2 if was is None else was + 2, np.int64)
            seen = False
            for b in batches:
                if not b.num_rows:
                    continue
                seen = True
                if was is None:
                    x = _whole(b.column(2), dim, scale, kind)
                else:
                    x = matrix(b.column(2))
                    old = np.frombuffer(b"".join(b.column(3).to_pylist()), state_type(was)).reshape(-1, parts)
                    old = narrowed(old, now)
                new = np.zeros((len(x), parts), state_type(now))
                for p, (part, cut) in enumerate(zip(own, cuts)):
                    if was is None:
                        new[:, p] = part.first(x[:, cut], now)
                    else:
                        new[:, p], need = part.next(x[:, cut], old[:, p], now)
                        needs += np.bincount(need, minlength=len(needs))[:len(needs)]
                    entry = new[:, p]["entry"]
                    counts[p] += np.bincount(entry, minlength=n_entries)
                    for k in np.unique(entry):
                        sums[k, cut] += x[entry == k, cut].sum(axis=0)
                raw = np.ascontiguousarray(new)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), packed(x), pa.array([r.tobytes() for r in raw], pa.binary()),
                     pa.nulls(len(x), pa.list_(pa.int64()))], ["id", "label", "v", "state", "sums"])
            if seen:
                total = [*counts.reshape(-1).tolist(), *needs.tolist(), *_limbs(sums.reshape(-1), limbs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, label_arrow), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                     pa.array([total], pa.list_(pa.int64()))], ["id", "label", "v", "state", "sums"])
        return run

    from pyspark.sql.pandas.types import to_arrow_type
    label_arrow = to_arrow_type(vectors.schema["label"].dataType)
    schema = f"id long, label {label_type}, v binary, state binary, sums array<long>"
    table, was = vectors, None
    for _ in range(rounds):
        done = written(table.mapInArrow(one_round(was, kept), schema), "vector-codes")
        totals = (done.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "x"))
                  .groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect())
        if was is not None:
            removed(table)
        total = {r["at"]: int(r["x"]) for r in totals}
        flat = [total[i] for i in range(len(total))]
        n_counts, n_needs = parts * len(start), (KEPT if was is None else was) + 2
        counts = np.array(flat[:n_counts]).reshape(parts, len(start))
        needs, added = flat[n_counts:n_counts + n_needs], flat[n_counts + n_needs:]
        size = len(start) * dim
        sums = np.array([sum(added[k * size + i] << (_LIMB * k) for k in range(limbs)) for i in range(size)], object).reshape(-1, dim)
        fresh, moved = [], []
        for p, cut in enumerate(cuts):
            used = counts[p] > 0
            book = books[p].astype(object)
            for k in np.flatnonzero(used):
                book[k] = [s // int(counts[p][k]) for s in sums[k, cut]]
            gap = ((book - books[p].astype(object)) ** 2).sum(axis=1)
            moved.append(np.zeros(len(book)) if plain else np.sqrt(gap.astype(np.float64)) * (1 + 1e-12))
            fresh.append(book.astype(kind))
        books = fresh
        table, before = done.where("sums IS NULL").drop("sums"), kept
        if was is not None and sum(needs):
            enough = np.cumsum(needs) >= 0.99 * sum(needs)
            kept = max(min(LEAST_KEPT, kept), min(kept, int(np.argmax(enough))))
        was = before
    own = positions()

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            if was is None:
                x, old = _whole(b.column(2), dim, scale, kind), None
            else:
                x = matrix(b.column(2))
                old = narrowed(np.frombuffer(b"".join(b.column(3).to_pylist()), state_type(was)).reshape(-1, parts), kept)
            code, error = np.zeros((len(x), parts), ">u2"), np.zeros(len(x), kind)
            for p, (part, cut) in enumerate(zip(own, cuts)):
                s = part.first(x[:, cut], kept) if old is None else part.next(x[:, cut], old[:, p], kept)[0]
                code[:, p] = s["entry"]
                error = error + part.distances(x[:, cut], s["entry"].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r.tobytes() for r in code], pa.binary()),
                 pa.array([int(e) if int(e) < 2 ** 63 else None for e in error], pa.int64())], ["id", "label", "code", "error"])

    coded = written(table.mapInArrow(last, f"id long, label {label_type}, code binary, error long"), "vector-codes")
    if was is not None:
        removed(table)
    return coded, [[[int(v) for v in entry] for entry in b] for b in books]


def codebooks_digest(books: list[list[list[int]]]) -> str:
    """sha256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the errors summed over rows of an equal label (nulls together);
    null when one of the errors, or the sum, is beyond a long."""
    whole = F.when(F.count("*") == F.count("error"), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = coded.groupBy("label").agg(whole.alias("__sum")).withColumnRenamed("label", "__label")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("__label")), "left")
            .withColumn("label_error", F.expr("try_cast(__sum AS long)")).drop("__label", "__sum"))
