"""Language identification: family first, then pairs within it (operator 9).

Features are hashed character n-grams (1 to 3) of lower-cased words, averaged
over the words of a text.  One linear support vector machine per language
family (against the rest) picks the family; within it, one linear machine per
pair of languages votes.  Machines are fitted in numpy by gradient descent on
the squared hinge, on whole texts and on short cuts of them, so that one-line
texts are decided as well.

Averages are linear, so a distinct word needs its margins once; a text's
margins are the mean over its words.

Labels are read only where crc32(doc_id) mod 5 is not 0, from at most
``max_docs`` documents of each language and ``max_words`` words in all.

Defined cases: null text, an empty one, or one without a letter is ``und``
with score 0; a null or empty lang teaches nothing; without any labels every
text is ``und``; with one learned language every text with a letter is of it
(score 1); a null doc_id is held out; repeated rows are predicted one by
one; further columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import (WordMargins, bounded_sample, fitted, fold, subwords, text_slices,
                                   unicode_words)

SIZES, BITS = (1, 2, 3), 15
# Language families by ISO 639-1 code; any other code is its own family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af", "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk", "turkic": "tr az kk uz", "baltic": "lt lv",
    "finnic": "fi et", "indic": "hi ur bn mr gu pa ne", "semitic": "ar he mt",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


def _svm(ids, owner, values, n, y, bias_scale=1.0, rounds=120, cost=200.0):
    """Weights and bias of a linear machine over sparse rows, squared hinge."""
    w, b = np.zeros(1 << BITS), 0.0
    mw, mb = np.zeros_like(w), 0.0
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    size = np.bincount(owner, weights=values * values, minlength=n).max(initial=1e-9) + bias_scale
    rate = 1.0 / (1.0 + 2 * cost * size)
    for k in range(rounds):                              # accelerated gradient descent
        aw, ab = w + k / (k + 3) * mw, b + k / (k + 3) * mb
        margin = np.bincount(owner, weights=values * aw[ids], minlength=n) + ab
        slack = np.maximum(0, 1 - y * margin)
        pull = -2 * cost * share * y * slack
        gw = aw + np.bincount(ids, weights=values * pull[owner], minlength=1 << BITS)
        gb = pull.sum()
        nw, nb = aw - rate * gw, ab - rate * gb
        mw, mb, w, b = nw - w, nb - b, nw, nb
    return w, b


def fit(pairs, max_words: int, cut: int = 4) -> bytes:
    rows, langs = [], []
    vocabulary: dict[str, int] = {}
    total = 0
    for text, lang in pairs:
        c, _, words = unicode_words(pa.array([text]))
        if not len(c):
            continue
        ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64)[c]
        middle = len(ids) // 2
        for row in [ids] + [ids[at:at + cut] for at in {0, middle} if len(ids) > cut]:
            rows.append(row)
            langs.append(lang)
        total += len(c)
        if total >= max_words:
            break
    names = sorted(set(langs))
    if not names:
        return b""
    grams, owner = subwords(list(vocabulary), SIZES, BITS)
    per_word = np.bincount(owner, minlength=len(vocabulary))
    first = np.cumsum(per_word) - per_word
    ids, rows_of, values = [], [], []
    for k, row in enumerate(rows):
        lens = per_word[row]
        at = np.repeat(first[row] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
        share = np.bincount(grams[at], weights=np.repeat(1 / np.maximum(lens, 1), lens) / len(row))
        got = np.flatnonzero(share)
        ids.append(got)
        values.append(share[got])
        rows_of.append(np.full(len(got), k))
    ids, values, rows_of = map(np.concatenate, (ids, values, rows_of))
    # Rare n-grams are scaled up, so that common letters don't drown them.
    scale = 1 / np.sqrt(np.bincount(ids, weights=values, minlength=1 << BITS) / len(rows) + 1e-4)
    values = values * scale[ids]
    langs = np.array(langs)
    families = np.array([family_of(x) for x in langs])
    kinds = sorted(set(families))
    machines, weights, biases = [], [], []

    def add(name: str, take: np.ndarray, y: np.ndarray):
        new = np.cumsum(take) - 1
        inside = take[rows_of]
        w, b = _svm(ids[inside], new[rows_of[inside]], values[inside], int(take.sum()), y[take])
        machines.append(name)
        weights.append(w * scale)
        biases.append(b)

    everything = np.ones(len(rows), bool)
    if len(kinds) > 1:
        for kind in kinds:
            add(f"family {kind}", everything, np.where(families == kind, 1.0, -1.0))
    for kind in kinds:
        members = [x for x in names if family_of(x) == kind]
        for a, b in combinations(members, 2):
            add(f"pair {a} {b}", (langs == a) | (langs == b), np.where(langs == a, 1.0, -1.0))
    letters = sorted({ord(c) for w in vocabulary for c in w if c.isalpha()})
    out = io.BytesIO()
    np.savez(out, letters=np.array(letters, np.int64), names=np.array(names), machines=np.array(machines, dtype=str),
             weights=np.array(weights, np.float32).reshape(len(machines), 1 << BITS).T, biases=np.array(biases))
    return out.getvalue()


def train(docs: DataFrame, max_docs: int = 300, max_words: int = 2_000_000) -> bytes:
    known = docs.where(F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("doc_id").isNotNull()
                       & (fold("doc_id") != 0)).select("doc_id", "lang")
    return fitted(bounded_sample(known, "lang", max_docs).dropDuplicates(["doc_id"]), docs, "lang",
                  lambda pairs: fit(pairs, max_words))


def decide(margins: np.ndarray, names: list[str], machines: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and confidence of each row of machine margins."""
    n = len(margins)
    at = {m: k for k, m in enumerate(machines)}
    kinds = sorted({family_of(x) for x in names})
    sure = lambda x: 1 / (1 + np.exp(-np.clip(2 * x, -30, 30)))
    if len(kinds) > 1:
        by_kind = margins[:, [at[f"family {k}"] for k in kinds]]
        best = by_kind.argmax(1)
        rest = np.sort(by_kind, 1)
        confidence = sure(rest[:, -1] - rest[:, -2])
    else:
        best, confidence = np.zeros(n, np.int64), np.ones(n)
    out = np.empty(n, object)
    for k, kind in enumerate(kinds):
        rows = np.flatnonzero(best == k)
        members = [x for x in names if family_of(x) == kind]
        votes, total = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
        for i, j in combinations(range(len(members)), 2):
            m = margins[rows, at[f"pair {members[i]} {members[j]}"]]
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            total[:, i] += m
            total[:, j] -= m
        won = (votes + 0.4 * np.tanh(total) / max(1, len(members))).argmax(1)
        out[rows] = np.array(members, object)[won]
        if len(members) > 1:
            confidence[rows] *= sure(total[np.arange(len(rows)), won] / (len(members) - 1))
    return out.tolist(), confidence


def known_letters(words: list[str], codes: np.ndarray, doc: np.ndarray, n: int, letters: np.ndarray) -> np.ndarray:
    """The share of each text's letters that occur in the texts learned from."""
    chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    kinds, which = np.unique(chars, return_inverse=True)
    alpha = np.array([chr(c).isalpha() for c in kinds.tolist()], bool)
    counts = [np.bincount(doc, np.bincount(owner, flag[which], len(words))[codes], n)
              for flag in (alpha, alpha & np.isin(kinds, letters))]
    return counts[1] / np.maximum(counts[0], 1)


def predict(docs: DataFrame, model: bytes, out: tuple[str, str] = ("lang_pred", "score"),
            letters: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1), whole texts, no shuffle.

    All columns of ``docs`` are kept; columns of the two names of ``out`` are replaced.  With
    ``letters`` the score is multiplied by the share of letters that were met in learning.
    """
    docs = docs.drop(*out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema, T.StructField(out[0], T.StringType()),
                           T.StructField(out[1], T.DoubleType())])
    names_out = schema.names
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.load(io.BytesIO(shared.value)) if shared.value else None
        if known is not None:
            names, machines = known["names"].tolist(), known["machines"].tolist()
            biases = known["biases"]
            of = WordMargins(np.ascontiguousarray(known["weights"]), SIZES)
        for batch in batches:
            for part in text_slices([batch.append_column("__text", batch.column(place))], "__text"):
                texts = part.column(part.num_columns - 1)
                lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                langs, score = ["und"] * len(texts), np.zeros(len(texts))
                if known is not None:
                    codes, first, words = unicode_words(texts)
                    sizes = np.diff(first)
                    doc = np.repeat(np.arange(len(texts)), sizes)
                    by_word = of.of(words)
                    margins = np.zeros((len(texts), by_word.shape[1]))      # one language has no machine
                    for k in range(by_word.shape[1]):
                        margins[:, k] = np.bincount(doc, weights=by_word[codes, k], minlength=len(texts))
                    margins = margins / np.maximum(sizes, 1)[:, None] + biases
                    found, sure = decide(margins, names, machines)
                    langs = [x if ok else "und" for x, ok in zip(found, lettered)]
                    score = np.where(lettered, sure, 0.0)
                    if letters and len(codes):
                        score *= known_letters(words, codes, doc, len(texts), known["letters"])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(part.num_columns - 1)), pa.array(langs, pa.string()),
                     pa.array(score)], names_out)

    return docs.mapInArrow(run, schema)


LEAST_CONFIDENCE = 0.3


def accepted(docs: DataFrame, model: bytes, wanted: tuple[str, ...] | None = None,
             least: float = LEAST_CONFIDENCE) -> DataFrame:
    """The rows of ``docs`` whose text is told to be of a wanted language (None: of any that was
    learned) with at least that confidence, in their own columns.

    The model always names one of its languages.  The confidence here counts the letters too: it is
    multiplied by the share of them that the learned texts hold, so a text in another script comes to about 0,
    and a mixed one to its known part.  Another language in the same letters isn't told apart.
    Texts without a letter, null ones too, are of no language.  Without a model (no labels)
    every text with a letter is accepted; with one learned language the letters decide.
    """
    lettered = docs.where(F.col("text").rlike(r"\p{L}"))
    if not model:
        return lettered
    told = predict(docs, model, ("__lang_pred", "__score"), letters=True)
    keep = (F.col("__lang_pred") != "und") & (F.col("__score") >= F.lit(least))
    if wanted is not None:
        keep &= F.col("__lang_pred").isin(*wanted)
    return told.where(keep).select(*docs.columns)
