"""Licence scan: Aho-Corasick phrases and a shunting-yard expression parser (operator 10).

A text's words are runs of ASCII letters, digits and non-ASCII characters,
A-Z lower-cased.  One automaton over the words, joined by single spaces,
finds every phrase at word boundaries in one pass, however many phrases there
are: base phrases, further notice phrases, and the words of identifier tags.
A text with an identifier tag is read again around the tag: the expression
behind it is tokenised, turned to postfix order by the shunting-yard rule
(WITH binds before AND, AND before OR) and evaluated to the set of licences
it needs: AND joins both sides, OR takes the side with the lower obligations
and keeps all labels as found, WITH lowers the obligation of its licence.

Defined cases: null text counts as empty; a text without matches has null
positions, empty labels and score 0; repeated rows are scanned one by one; an
unbalanced or empty expression adds the labels of its known identifiers only;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_slices

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notice phrases of the method's own.
NOTICES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd",
    "mozilla public license": "mpl", "lesser general public license": "lgpl",
    "affero general public license": "agpl", "eclipse public license": "epl",
    "isc license": "isc", "boost software license": "bsl", "the unlicense": "unlicense",
    "creative commons attribution": "cc-by", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd", "cc0": "cc0", "public domain": "public-domain",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAG = "spdx license identifier"
# How far each label binds whoever uses the text, from 0 (free) to 1 (reserved).
OBLIGATION = {
    "cc0": 0.0, "public-domain": 0.0, "unlicense": 0.0, "mit": 0.1, "isc": 0.1, "bsd": 0.1,
    "bsl": 0.1, "apache": 0.15, "cc-by": 0.2, "mpl": 0.4, "epl": 0.4, "lgpl": 0.5,
    "cc-by-sa": 0.5, "gpl": 0.7, "agpl": 0.8, "cc-by-nd": 0.8, "cc-by-nc": 0.9, "reserved": 1.0,
}
# Identifiers start with these, longest first.
_FAMILIES = ("cc-by-nc", "cc-by-nd", "cc-by-sa", "cc-by", "cc0", "agpl", "lgpl", "gpl", "apache", "mit",
             "bsd", "bsl", "mpl", "epl", "isc", "unlicense")
_TAG = re.compile(r"spdx[\W_]*license[\W_]*identifier[ \t]*:?[ \t]*([^\n\r]*)", re.I)
_TOKENS = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+\-]*")
_BINDS = {"or": 1, "and": 2, "with": 3}
_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_WORD_BYTES = bytes.maketrans(
    _SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)))


def label_of(identifier: str) -> str | None:
    low = identifier.lower()
    return next((f for f in _FAMILIES if low == f or low.startswith((f + "-", f + "+", f + "."))), None)


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operators wait on a stack until a weaker one, a closing
    bracket or the end comes.  Raises ValueError on unbalanced brackets."""
    out, stack = [], []
    for tok in tokens:
        low = tok.lower()
        if low in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[low]:
                out.append(stack.pop())
            stack.append(low)
        elif tok == "(":
            stack.append(tok)
        elif tok == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise ValueError("unbalanced")
            stack.pop()
        else:
            out.append(tok)
    while stack:
        if stack[-1] == "(":
            raise ValueError("unbalanced")
        out.append(stack.pop())
    return out


def evaluate(expression: str) -> tuple[set[str], float]:
    """(labels named in the expression, obligation of the choice it leaves)."""
    tokens = _expression_tokens(expression)
    labels = {x for x in map(label_of, tokens) if x}
    stack: list[float] = []
    try:
        for tok in to_postfix(tokens):
            if tok in _BINDS:
                right, left = stack.pop(), stack.pop()
                stack.append(max(left, right) if tok == "and" else
                             min(left, right) if tok == "or" else left * 0.8)
            else:
                stack.append(OBLIGATION.get(label_of(tok), 0.5))
        if len(stack) != 1:
            raise ValueError("operands left over")
        return labels, stack[0]
    except (ValueError, IndexError):
        return labels, max((OBLIGATION[x] for x in labels), default=0.0)


def _expression_tokens(text: str) -> list[str]:
    """The longest start of ``text`` that alternates operands and operators."""
    out, operand_next = [], True
    for tok in _TOKENS.findall(text):
        low = tok.lower()
        if tok == "(" and operand_next or tok == ")" and not operand_next:
            out.append(tok)
        elif low in _BINDS and not operand_next:
            out.append(tok)
            operand_next = True
        elif low not in _BINDS and tok not in "()" and operand_next:
            out.append(tok.rstrip(".") or tok)
            operand_next = False
        else:
            break
    while out and out[-1].lower() in _BINDS:
        out.pop()
    return out


_AUTOMATA: dict[str, object] = {}


def automaton():
    """All phrases, each between spaces, with the number of its words."""
    if "all" not in _AUTOMATA:
        import ahocorasick

        made = ahocorasick.Automaton()
        for phrase in {*BASE, *NOTICES, TAG}:
            made.add_word(f" {phrase} ", phrase)
        made.make_automaton()
        _AUTOMATA["all"] = made
    return _AUTOMATA["all"]


def scan(text: str) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = text.encode().translate(_WORD_BYTES).split()
    # One letter per byte keeps the automaton on plain strings.
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    n_base, first, last = 0, None, None
    base: set[str] = set()
    more: set[str] = set()
    tagged = False
    word, seen = 0, 0
    for end, phrase in automaton().iter(line):
        tagged |= phrase == TAG
        if phrase in NOTICES:
            more.add(NOTICES[phrase])
        if phrase in BASE:
            n_base += 1
            base.add(BASE[phrase])
            word += line.count(" ", seen, end + 1)        # spaces so far: words so far plus one
            seen = end + 1
            start = word - 1 - len(phrase.split())
            first = start if first is None else min(first, start)
            last = start if last is None else max(last, start)
    score = max((OBLIGATION[x] for x in base | more), default=0.0)
    if tagged:
        for found in _TAG.finditer(text):
            labels, obligation = evaluate(found[1])
            more |= labels
            score = max(score, obligation)
    return (len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | more)), score)


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: word count, base places, labels and obligation."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            got = [scan(t) for t in part.column(1).to_pylist()]
            cols = list(zip(*got)) if got else [[]] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                ["key", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind}, n_words long, n_base long, first_word long, last_word long, "
                             "base_labels string, labels string, score double")
            .withColumnRenamed("key", key))
