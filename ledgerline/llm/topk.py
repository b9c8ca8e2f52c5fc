"""Exact top-k inner products with norm order, rotation and residual bounds (operator 1).

Vectors are ranked by length into levels, and levels into blocks.  A rotation
from the eigenvectors of the Gram matrix moves most of every product into the
first coordinates.  Each query first meets the block of the longest vectors;
its k-th best score there is a floor.  By Cauchy-Schwarz a level whose longest
vector times the query's length stays below the floor holds no result, so the
query is sent only to the levels it still needs.  Within a block the partial
sum over the leading coordinates plus the product of the residual lengths
bounds a score; only candidates whose bound reaches the floor get their exact
integer product.

Components are the integers floor(scale * x), products are exact, ties go to
the smaller id.  Floating bounds are widened by more than their rounding.

Defined cases: vectors that are null, empty, of another length than the most
frequent one, or hold null or non-finite components take no part, nor do rows
with a null id; repeated rows are candidates each, and one query; a query
meets no row of its own id; with fewer than k candidates all are returned; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import written

LEVELS = 64
_EXACT = float(1 << 53)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of packed float64 vectors."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.float64).reshape(-1, dim)


def usable_vectors(rows: DataFrame, scale: int, key: str, vector: str) -> DataFrame:
    """(id, v array<double>, norm2) with whole components."""
    v = F.col("v")
    good = (F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return (rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
            .where(good).select("id", whole.alias("v"))
            .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the sum of v v^T, largest first; each task adds up its own
    rows, so dim x dim numbers per task reach the driver's sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(dim * dim), pa.int32()), pa.array(total.ravel())], ["i", "g"])

    sums = vectors.select("v").mapInArrow(run, "i int, g double").groupBy("i").agg(F.sum("g").alias("g")).collect()
    gram = np.zeros(dim * dim)
    for r in sums:
        gram[r["i"]] = r["g"]
    _, vecs = np.linalg.eigh(gram.reshape(dim, dim))
    return np.ascontiguousarray(vecs[:, ::-1])


def block_top(queries, ids: np.ndarray, whole: np.ndarray, rotated: np.ndarray, norms: np.ndarray,
              k: int, head: int, chunk: int = 1024):
    """(query row, id, score) of at most k best per query with score >= its
    floor, over one block in descending order of length."""
    q_id, q_whole, q_rot, q_norm, floor = queries
    floor = floor.copy()
    best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float64))
    q_rest = np.sqrt(np.maximum(0, (q_rot[:, head:] ** 2).sum(1)))
    rest = np.sqrt(np.maximum(0, (rotated[:, head:] ** 2).sum(1)))
    for at in range(0, len(ids), chunk):
        slack = 1e-9 * q_norm * norms[at] + 1e-9
        open_ = np.flatnonzero(q_norm * norms[at] + slack >= floor)
        if not len(open_):
            break                                       # later vectors are shorter still
        part = slice(at, at + chunk)
        bound = (q_rot[open_, :head] @ rotated[part, :head].T
                 + q_rest[open_, None] * rest[None, part] + slack[open_, None])
        qi, ci = np.nonzero((bound >= floor[open_, None]) & (q_id[open_, None] != ids[None, part]))
        if not len(qi):
            continue
        if len(qi) * 4 > bound.size:
            score = (q_whole[open_] @ whole[part].T)[qi, ci]
        else:
            score = np.concatenate([np.einsum("ij,ij->i", q_whole[open_[qi[s:s + 65536]]], whole[part][ci[s:s + 65536]])
                                    for s in range(0, len(qi), 65536)])
        qi, ci = open_[qi], ids[part][ci]
        ok = score >= floor[qi]
        qi, ci, score = (np.concatenate([x, y[ok]]) for x, y in zip(best, (qi, ci, score)))
        order = np.lexsort((ci, -score, qi))
        qi, ci, score = qi[order], ci[order], score[order]
        first = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1]])
        rank = np.arange(len(qi)) - np.repeat(first, np.diff(np.r_[first, len(qi)]))
        kth = rank == k - 1
        floor[qi[kth]] = np.maximum(floor[qi[kth]], score[kth])
        best = tuple(x[rank < k] for x in (qi, ci, score))
    return best


def top_k(rows: DataFrame, is_query, k: int = 20, scale: int = 64, key: str = "vec_id",
          vector: str = "embedding", block_rows: int = 8192, queries_per_task: int = 8192) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best rows.

    ``is_query``: a condition on the column ``id``.  Levels are at most
    ``LEVELS`` quantiles of the length; a level of more than ``block_rows``
    rows is dealt over several blocks.  A block is held by one task at a time
    (``block_rows`` in the mean), queries stream past it; more queries than
    ``queries_per_task`` meet copies of the block in other tasks.
    """
    vectors = usable_vectors(rows, scale, key, vector)
    sizes = vectors.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if sizes is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim, n = sizes["dim"], sizes["n"]
    vectors = vectors.where(F.size("v") == dim)
    turn = rotation(vectors, dim)
    head = max(1, dim // 4)
    n_levels = int(min(LEVELS, max(1, -(-n // block_rows))))
    cuts = sorted(set(vectors.stat.approxQuantile("norm2", [i / n_levels for i in range(1, n_levels)], 0.002)),
                  reverse=True) if n_levels > 1 else []
    # Level 0 holds the longest vectors; a level's longest possible length is the cut above it.
    level = F.lit(0)
    for c in cuts:
        level = level + F.when(F.col("norm2") < F.lit(c), 1).otherwise(0)
    splits = int(max(1, -(-n // (block_rows * (len(cuts) + 1)))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.tobytes() for r in x], pa.binary()), b.column(2), b.column(3)],
                ["id", "v", "norm2", "level"])

    packed = vectors.withColumn("level", level).mapInArrow(pack, "id long, v binary, norm2 double, level int")
    packed = written(packed.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(splits)).cast("int")), "vectors")
    queries = packed.where(is_query).dropDuplicates(["id", "v"]).withColumn("qkey", F.xxhash64("id", "v"))
    n_queries = packed.where(is_query).count()
    copies = int(max(1, -(-n_queries // queries_per_task)))

    def search(asked: DataFrame, candidates: DataFrame) -> DataFrame:
        """Best rows per query and block; ``asked``: id, v, norm2, qkey, floor, level, block."""
        asked = asked.select(
            "level", "block", F.pmod("qkey", F.lit(copies)).cast("int").alias("copy"), F.lit(1).alias("role"),
            "id", "v", "norm2", "qkey", "floor")
        held = candidates.select(
            "level", "block", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(0).alias("role"),
            "id", "v", "norm2", F.lit(0).cast("long").alias("qkey"), F.lit(0.0).alias("floor"))
        stream = (held.unionByName(asked).repartition("level", "block", "copy")
                  .sortWithinPartitions("level", "block", "copy", "role", F.desc("norm2"), "id"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place, parts, block = None, [], None
            for b in batches:
                where = list(zip(*(b.column(i).to_pylist() for i in range(4))))
                starts = [0] + [i for i in range(1, len(where)) if where[i] != where[i - 1]] + [len(where)]
                for s, e in zip(starts[:-1], starts[1:]):
                    if s == e:
                        continue
                    own = b.slice(s, e - s)
                    ids, v = own.column(4).to_numpy(), _matrix(own.column(5), dim)
                    norms = np.sqrt(own.column(6).to_numpy())
                    if where[s][:3] != place:
                        place, parts, block = where[s][:3], [], None
                    if where[s][3] == 0:
                        parts.append((ids, v, norms))
                        continue
                    if block is None:
                        if not parts:
                            continue                    # an empty block
                        c_ids, c_v, c_norms = (np.concatenate(x) for x in zip(*parts))
                        block, parts = (c_ids, c_v, c_v @ turn, c_norms), []
                    keys, floors = own.column(7).to_numpy(), own.column(8).to_numpy()
                    for at in range(0, len(ids), 256):
                        p = slice(at, at + 256)
                        q, found, score = block_top(
                            (ids[p], v[p], v[p] @ turn, norms[p], floors[p]), block[0], block[1], block[2], block[3],
                            k, head)
                        # Beyond 2^53 products in doubles are rounded: do those again in integers.
                        big = (norms[p].max(initial=0) * block[3].max(initial=0)) >= _EXACT
                        if big and len(q):
                            lookup = {i: r for r, i in enumerate(block[0].tolist())}
                            score = [max(-2 ** 63, min(2 ** 63 - 1, sum(int(x) * int(y) for x, y in zip(
                                v[p][i], block[1][lookup[f]])))) for i, f in zip(q.tolist(), found.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[p][q]), pa.array(ids[p][q]), pa.array(found),
                             pa.array(np.asarray(score).astype(np.int64) if not big else score, pa.int64())],
                            ["qkey", "query_id", "vec_id", "score"])

        return stream.mapInArrow(run, "qkey long, query_id long, vec_id long, score long")

    # First the longest block of level 0, to learn each query's floor.
    start = queries.withColumn("floor", F.lit(float("-inf"))).withColumn("level", F.lit(0)).withColumn("block", F.lit(0))
    longest = packed.where((F.col("level") == 0) & (F.col("block") == 0))
    seen = written(search(start, longest), "seen")
    floors = seen.groupBy("qkey").agg(F.count("*").alias("n"), F.min("score").alias("low")).where(F.col("n") >= k)
    # Then every level whose longest vector can still reach it.
    tops = [None, *cuts]
    reach = F.array(*[F.when(
        F.lit(True) if top is None else
        (F.sqrt("norm2") * float(np.sqrt(top)) * (1 + 1e-9) + 1e-9 >= F.col("floor")), F.lit(i))
        for i, top in enumerate(tops)])
    asked = (queries.drop("level", "block").join(floors.select("qkey", F.col("low").cast("double").alias("floor")), "qkey", "left")
             .withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
             .withColumn("level", F.explode(F.filter(reach, lambda x: x.isNotNull())))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
             .where("level > 0 OR block > 0"))
    rest = packed.where("level > 0 OR block > 0")
    order = Window.partitionBy("qkey", "query_id").orderBy(F.desc("score"), "vec_id")
    return (seen.unionByName(search(asked, rest)).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
