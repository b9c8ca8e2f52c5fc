"""Toxicity by subword-bag embeddings under a linear softmax (operator 8).

A word is the bag of its character n-grams (3 to 5, with word edges), each an
embedding; a passage of ``PASSAGE`` words is the average of its words'
averages, and a two-class linear softmax scores it.  Embeddings and softmax
are trained jointly, in numpy, from document labels alone: a clean document is
clean in every passage, a toxic one is toxic in its worst passage (which the
model picks itself from round to round).  A document's score is that of its
worst passage, so one insult is not averaged away over a long text, and an
unseen spelling shares most of its n-grams with the seen one.

Since the softmax is linear, an n-gram's share of the margin is one number;
scoring looks up one number per distinct word.

Labels are read only where crc32(doc_id) mod 5 is not 0, from at most
``max_docs`` documents of each label and ``max_words`` words in all.

Defined cases: null text counts as empty; an empty text gets the score of a
passage without words; a null doc_id is held out; a document with several
labels counts as toxic if one says so, null labels are ignored; without
labels every score is 0.1; repeated rows are scored one by one; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import (WordMargins, bounded_sample, fitted, fold, subwords, text_slices,
                                   unicode_words)

SIZES, BITS, DIM, PASSAGE = (3, 4, 5), 17, 8, 4


def fit(pairs, max_words: int, rounds: int = 60, rate: float = 0.05, decay: float = 0.03) -> bytes:
    """float32 margins per n-gram bucket, then the bias."""
    vocabulary: dict[str, int] = {}
    codes, sizes, labels = [], [], []
    total = 0
    for text, label in pairs:
        c, _, words = unicode_words(pa.array([text]))
        if not len(c):
            continue
        ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64)
        codes.append(ids[c].astype(np.int32))
        sizes.append(len(c))
        labels.append(label == "1")
        total += len(c)
        if total >= max_words:
            break
    weights = np.zeros(1 << BITS, np.float32)
    if not codes:
        return weights.tobytes() + np.float32(math.log(1 / 9)).tobytes()
    word = np.concatenate(codes)
    sizes, toxic = np.array(sizes), np.array(labels)
    grams, owner = subwords(list(vocabulary), SIZES, BITS)
    per_word = np.maximum(np.bincount(owner, minlength=len(vocabulary)), 1)
    # Passages: runs of PASSAGE words inside one document.
    at = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    n_passages = -(-sizes // PASSAGE)
    first = np.cumsum(n_passages) - n_passages
    passage = np.repeat(first, sizes) + at // PASSAGE
    in_passage = np.bincount(passage)
    doc = np.repeat(np.arange(len(sizes)), n_passages)
    of_toxic = toxic[doc]
    share = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))

    rng = np.random.default_rng(8)
    table = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    softmax = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.array([0.0, -2.0], np.float32)
    seen = np.bincount(grams, minlength=1 << BITS) > 0
    params = [table, softmax, bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        way = softmax[:, 1] - softmax[:, 0]
        by_word = np.bincount(owner, weights=(table @ way)[grams], minlength=len(vocabulary)) / per_word
        margin = np.bincount(passage, weights=by_word[word]) / in_passage + (bias[1] - bias[0])
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        worst = margin >= np.maximum.reduceat(margin, first)[doc]
        # Early on every passage of a toxic document is suspect, later the worst.
        suspect = np.ones_like(worst) if step <= rounds // 6 else worst
        weight = share[doc] * np.where(of_toxic, suspect / (n_passages[doc] if step <= rounds // 6 else 1),
                                       worst + 1.0 / n_passages[doc])
        pull = weight * (p - of_toxic)
        a = np.bincount(word, weights=(pull / in_passage)[passage], minlength=len(vocabulary)) / per_word
        c = np.bincount(grams, weights=a[owner], minlength=1 << BITS).astype(np.float32)
        d_way = c @ table
        grads = [np.outer(c, way) + decay * table * seen[:, None] / len(sizes),
                 np.stack([-d_way, d_way], 1), np.array([-pull.sum(), pull.sum()])]
        for k, g in enumerate(grads):
            g = g.astype(np.float32)
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            params[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    weights = ((table @ (softmax[:, 1] - softmax[:, 0])) * seen).astype(np.float32)
    return weights.tobytes() + np.float32(bias[1] - bias[0]).tobytes()


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 2500, max_words: int = 4_000_000) -> bytes:
    """The model of a bounded sample of the labelled documents outside the held-out fold."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id") != 0))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    sample = bounded_sample(known, "toxic", max_docs)
    return fitted(sample, docs, "toxic", lambda pairs: fit(pairs, max_words))


def score(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (0 or 1), whole texts, no shuffle.

    All columns of ``docs`` are kept; columns named score or predicted are replaced.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    names_out = schema.names
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.frombuffer(shared.value, np.float32)
        margins, bias = WordMargins(numbers[:-1, None], SIZES), float(numbers[-1])
        for batch in batches:
            for part in text_slices([batch.append_column("__text", batch.column(place))], "__text"):
                codes, first, words = unicode_words(part.column(part.num_columns - 1))
                sizes = np.diff(first)
                at = np.arange(len(codes)) - np.repeat(first[:-1], sizes)
                n = -(-sizes // PASSAGE)
                begin = np.cumsum(n) - n
                passage = np.repeat(begin, sizes) + at // PASSAGE
                worst = np.zeros(len(sizes))
                if len(codes):
                    of_word = margins.of(words)[:, 0][codes]
                    mean = np.bincount(passage, weights=of_word) / np.bincount(passage)
                    full = np.flatnonzero(n)
                    worst[full] = np.maximum.reduceat(mean, begin[full])
                p = 1 / (1 + np.exp(-np.clip(worst + bias, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(part.num_columns - 1)), pa.array(p),
                     pa.array((p >= 0.5).astype(np.int32))], names_out)

    return docs.mapInArrow(run, schema)
