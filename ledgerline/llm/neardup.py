"""Near-duplicates by circulant MinHash and exact verification (operator 5).

A document's set is its distinct shingles of five words (A-Z lower-cased,
words between ASCII white space); a shorter document is one shingle.  Two
documents are linked when 100 * |intersection| >= 75 * |union|, and components
follow the links.

1. One pass over the texts makes a digest of the word sequence, the set size
   and the band keys.  Circulant MinHash needs two permutations of the 32-bit
   integers only: the first scatters the shingles, the second, shifted
   circularly by k, gives coordinate k of the signature.
2. Documents with one word sequence form a class; its smallest doc_id stands
   for it, so copies never meet each other.
3. Every bucket of a band has a head, the member that meets most others over
   all its buckets (of a group of copies, the one nearest to all); it is
   compared with each other member: a bucket of n members yields n - 1 pairs.
4. Candidate pairs are verified on the full sets of both texts, streamed by
   the head; its members are dealt over several tasks.
5. What step 3 leaves open are pairs of members that both differ from their
   bucket's head.  Those already in one component need no test.
   The Jaccard distance obeys the triangle inequality, so pairs whose
   distances to the head differ by more than 0.25 can't be linked.  An
   intersection is no larger than the smaller side's number of shingles that
   more than ``RARE`` open documents hold, plus the rarer ones that both hold
   (found by a join on them, at most ``RARE`` partners each), so strongly
   edited copies of one text drop out as well.  The rest is verified in the
   same way: no link inside a bucket is lost, and a large group of near copies
   stays nearly linear.
6. Components by alternating large-star and small-star steps on the links.

With ``BANDS`` bands of ``ROWS`` rows a pair at the threshold shares no bucket
with probability (1 - 0.75 ** 5) ** 40 = 2e-5, a pair at 0.9 with 1e-15.

Defined cases: null text counts as empty; documents without words have size
0 and stand alone; a row gets the component of its own text, and texts whose smallest
doc_id is the same count as one document; a null doc_id stands alone with a
null component; repeated rows keep their rows in the result; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_words, mix64, text_slices, written

SHINGLE, BANDS, ROWS = 5, 40, 5
MEMBERS_PER_TASK, RARE = 500, 8
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    return [s for s, _ in _sets(texts)]


def _sets(texts: pa.Array) -> Iterator[tuple[np.ndarray, bytes]]:
    codes, first, words = ascii_words(texts)
    of_word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    hashes = of_word[codes] if len(codes) else np.empty(0, np.uint64)
    for a, b in zip(first[:-1], first[1:]):
        h = hashes[a:b]
        digest = hashlib.md5(h.tobytes()).digest() if b > a else b""
        if b - a >= SHINGLE:
            x = np.zeros(b - a - SHINGLE + 1, np.uint64)
            for j in range(SHINGLE):
                x += mix64(h[j:len(x) + j] + _ODD[j])* _ODD[SHINGLE - 1 - j]
            yield np.unique(mix64(x)), digest
        elif b > a:
            yield np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64), digest
        else:
            yield np.empty(0, np.uint64), digest


def _permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of the 32-bit integers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, size: int = BANDS * ROWS, block: int = 1024) -> np.ndarray:
    """Circulant MinHash coordinates: min over the set of pi(sigma(x) + k mod 2^32)."""
    scattered = _permute((shingles >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    low = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), block):
        table = _permute(scattered[None, at:at + block] + shifts, 0x85EBCA6B, 0xC2B2AE35)
        np.minimum(low, table.min(1), out=low)
    return low


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of rows."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD[0]
    for r in range(ROWS):
        key = mix64(key ^ (rows[:, r] + _ODD[r]))
    return key.astype(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, keys) of every row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            sizes, digests, keys, known = [], [], [], {}
            for s, digest in _sets(part.column(1)):
                if digest not in known:
                    known[digest] = band_keys(signature(s)).tolist() if len(s) else []
                sizes.append(len(s))
                digests.append(digest)
                keys.append(known[digest])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, keys array<long>")


def verify(docs: DataFrame, pairs: DataFrame, pairs_are_many: bool = True) -> DataFrame:
    """(a, b, common, either) of distinct pairs (a, b) of doc_ids: sizes of the
    intersection and the union of their full sets.

    The texts of the documents in question are moved once to their pairs and
    once to the pair's first document.  That document's text goes to every
    task that holds some of its partners, ``MEMBERS_PER_TASK`` in the mean.
    Should a doc_id have several texts, the last of either side counts.
    """
    per_a = pairs.groupBy("a").agg(F.count("*").alias("n"))
    tasks = F.ceil(F.col("n") / MEMBERS_PER_TASK).cast("long")
    dealt = pairs.join(per_a, "a").select("a", "b", F.pmod(F.xxhash64("b"), tasks).alias("task"))
    wanted = dealt.select(F.col("b").alias("doc_id"), "a", "task", F.lit(1).alias("role")).unionByName(
        per_a.select(F.col("a").alias("doc_id"), "a",
                     F.explode(F.sequence(F.lit(0).cast("long"), tasks - 1)).alias("task"),
                     F.lit(0).alias("role")))
    # Written first: its size is then known, and few pairs need no shuffle of the texts.
    wanted = written(wanted, "wanted")
    if pairs_are_many:                                  # the same plan at every size
        wanted = wanted.hint("merge")
    rows = (docs.join(wanted, "doc_id").select("a", "task", "role", "doc_id", "text")
            .repartition("a", "task").sortWithinPartitions("a", "task", "role", "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left = (None, None), np.empty(0, np.uint64)
        for part in text_slices(batches, "text"):
            a, task, role, b = (part.column(k).to_pylist() for k in range(4))
            out = []
            for i, s in enumerate(shingle_sets(part.column(4))):
                if role[i] == 0:
                    held, left = (a[i], task[i]), s
                elif held == (a[i], task[i]):
                    common = len(np.intersect1d(left, s, assume_unique=True))
                    out.append((a[i], b[i], common, len(left) + len(s) - common))
                else:
                    raise ValueError(f"document {a[i]} has no text among its pairs")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)],
                ["a", "b", "common", "either"])

    return rows.mapInArrow(run, "a long, b long, common long, either long").dropDuplicates(["a", "b"])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(doc_id, component_id) of every document of ``edges`` (a, b): the
    smallest doc_id that its links reach, by alternating star contraction.

    Each round's edges are a written table; the rounds needed grow with the
    logarithm of the number of documents.
    """
    step = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), "links")
    state = lambda df: tuple(df.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
    before = state(step)
    for _ in range(rounds):
        # Large star: neighbours above u go to the smallest of u's neighbourhood.
        both = step.unionByName(step.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # Small star: the rest of u's smaller neighbours, and u, go to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        step = written(small, "links")
        now = state(step)
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError("links did not settle")
    return step.groupBy("u").agg(F.min("v").alias("component_id")).withColumnRenamed("u", "doc_id").unionByName(
        step.select(F.col("v").alias("doc_id"), F.col("v").alias("component_id")).distinct())


def open_shingles(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shingle, df) of the documents of ``ids``, with the number of them
    that hold the shingle; shingles of one document only are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            sets = shingle_sets(part.column(1))
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(owner)), pa.array(np.concatenate(sets).astype(np.int64))],
                ["id", "shingle"])

    rows = written(docs.join(ids.withColumnRenamed("id", "doc_id"), "doc_id").select("doc_id", "text").mapInArrow(
        run, "id long, shingle long"), "shingles")
    return rows.join(rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"), "shingle")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(sketches(docs), "sketches")
    classes = (rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest")
               .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")))
    texts = docs.where("doc_id IS NOT NULL")
    banded = classes.select(F.col("rep").alias("id"), "n", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    multi = written(banded.join(shared, "key"), "buckets")
    # A little edited copy meets more of its kind than a strongly edited one.
    weights = multi.groupBy("id").agg(F.sum("members").alias("weight"))
    heads = multi.join(weights, "id").groupBy("key").agg(
        F.max_by("id", F.struct("weight", -F.col("id"))).alias("head"))
    buckets = written(multi.join(heads, "key"), "headed")
    sizes = buckets.where("id = head").select("head", F.col("n").alias("head_n")).distinct()

    # Sets whose sizes differ more can't reach the threshold.
    alike = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))
    first = written(buckets.where("id <> head").select("head", "id", "n").distinct().join(sizes, "head")
                    .where(alike(F.col("n"), F.col("head_n"))).select(F.col("head").alias("a"), F.col("id").alias("b"))
                    .distinct(), "pairs")
    tested = written(verify(texts, first), "tested")
    linked = F.expr(f"100 * common >= {percent} * either")
    labels = written(components(tested.where(linked)), "labels")

    # Open: members of buckets that hold more than one component.
    members = (buckets.where("members > 2 AND id <> head").join(
        labels.withColumnRenamed("doc_id", "id"), "id", "left")
        .withColumn("label", F.coalesce("component_id", "id")))
    mixed = members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    far = tested.select(F.col("a").alias("head"), F.col("b").alias("id"),
                        (1 - F.col("common") / F.col("either")).alias("d"))
    # Untested against the head means too different in size: at least this far.
    least_far = 1 - F.least("n", "head_n") / F.greatest("n", "head_n")
    still = written(members.join(mixed.select("key"), "key").join(sizes, "head").join(far, ["head", "id"], "left").select(
        "key", "id", "n", "label", F.coalesce("d", least_far).alias("d"), F.col("d").isNotNull().alias("exact")), "open")
    shingles = written(open_shingles(texts, written(still.select("id").distinct(), "open-ids")), "open-shingles")
    # No intersection is larger than the smaller number of common shingles plus the shared rare ones.
    common = shingles.where(F.col("df") > RARE).groupBy("id").agg(F.count("*").alias("common"))
    still = still.join(common, "id", "left").withColumn("common", F.coalesce("common", F.lit(0)))
    # A pair that shares several buckets is met in the smallest of them only.
    places = still.groupBy("id").agg(F.collect_set("key").alias("places"))
    still = still.join(places, "id")
    limit = 1 - percent / 100 + 1e-9
    reaches = lambda most, x, y: 100 * most >= percent * (x + y - most)
    left, right = (still.select("key", *(F.col(c).alias(f"{c}{k}") for c in ("id", "n", "label", "d", "exact", "common", "places")))
                   for k in (1, 2))
    differ = (F.col("label1") != F.col("label2")) & alike(F.col("n1"), F.col("n2"))
    second = (left.join(right, "key").where(
        (F.col("id1") < F.col("id2")) & differ & reaches(F.least("common1", "common2"), F.col("n1"), F.col("n2"))
        & ~(F.col("exact1") & (F.col("d2") - F.col("d1") > limit))
        & ~(F.col("exact2") & (F.col("d1") - F.col("d2") > limit))
        & (F.array_min(F.array_intersect("places1", "places2")) == F.col("key")))
        .select(F.col("id1").alias("a"), F.col("id2").alias("b")))
    rare = shingles.where(F.col("df") <= RARE).select("shingle", "id")
    both = (rare.withColumnRenamed("id", "id1").join(rare.withColumnRenamed("id", "id2"), "shingle")
            .where("id1 < id2").groupBy("id1", "id2").agg(F.count("*").alias("r")))
    facts = still.select("id", "n", "label", "common").distinct()
    for k in (1, 2):
        both = both.join(facts.select(*(F.col(c).alias(f"{c}{k}") for c in ("id", "n", "label", "common"))), f"id{k}")
    second = second.unionByName(both.where(differ & reaches(
        F.least("common1", "common2") + F.col("r"), F.col("n1"), F.col("n2")))
        .select(F.col("id1").alias("a"), F.col("id2").alias("b"))).distinct()
    second = written(second.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "second")
    if not second.isEmpty():
        again = written(verify(texts, second, False).where(linked), "tested")
        if not again.isEmpty():
            labels = written(components(tested.where(linked).select("a", "b").unionByName(again.select("a", "b"))), "labels")

    by_class = classes.select("digest", "rep").join(
        labels.withColumnRenamed("doc_id", "rep"), "rep", "left").select(
        "digest", F.coalesce("component_id", "rep").alias("component"))
    # Rows without words have no class and stand alone.
    out = rows.select("doc_id", "n_shingles", "digest").join(by_class, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
