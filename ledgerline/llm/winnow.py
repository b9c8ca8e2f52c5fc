"""Document fingerprints by winnowing, in DataFrame functions only (operator 2).

The white space of a text is left out.  Every run of ``CHARS`` characters (code
points) has a hash, so a passage has the same hashes at whatever offset it stands; of every ``CHAR_WINDOW`` neighbouring
hashes the smallest is selected, the rightmost of equal ones.  A hash (33 bits) and
its position share one long, so that the minimum of longs is the winnowing rule and
positions are kept.  Two texts that share CHARS + CHAR_WINDOW - 1 characters in a row share
a selected hash; runs of fewer than CHARS characters never match.

A text is worked through in pieces of pieces that overlap by the reach of a window,
so the boxed arrays of one piece are all that stands in memory beside the text and its
selection (some nine characters to an entry).

An edited text begins as its document and ends as the next one begins.  Windows that lie within one
of the two select there what they select here (at another position), so only the windows
around the seam, and the last ones, are hashed again.

Defined cases: null text counts as empty; a text of white space
selects nothing, and two such texts are alike (1.0); fewer than CHARS
characters make one hash of them all, fewer than CHAR_WINDOW hashes one window;
repeated rows are neighbours
of each other (ordered by a hash of the text); a null doc_id comes last; a
single document is its own successor; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import order_buckets, written

CHARS = CHAR_WINDOW = 16              # the window is halved to single entries, see _selected
REACH = CHARS + CHAR_WINDOW - 1       # characters of a window
PIECES = (1 << 18, 1 << 12)           # of a text, and of such a piece
STRETCH = 64
_LAST = (1 << 31) - 1
_SPACE = " \t\n\x0b\f\r"
_NONE = "array<bigint>"


def without_space(text: Column) -> Column:
    return F.translate(text, _SPACE, "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _halves(values: Column, step: int) -> Column:
    """The smaller of each entry and the one at ``step`` behind it."""
    n = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, 1, n), F.slice(values, step + 1, n), lambda x, y: F.least(x, y))


def _packed(run: Column, from_end: Column) -> Column:
    """The upper 33 bits of a run's hash, and its place counted down from the largest."""
    return F.xxhash64(run).bitwiseAND(F.lit(~_LAST)) + from_end


def _starts(n: Column, step: int) -> Column:
    """0, step, 2 step ... below n (0 alone when there is nothing)."""
    last = F.floor(F.greatest(n - 1, F.lit(0)) / step).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: k * step)


def _hashed(chars: Column, at: Column) -> Column:
    """The hashes of all runs of a piece, by short stretches: a run is found by counting from the
    start of its string."""
    def by_stretch(grams):
        def stretch(s):
            return _let(F.substr(chars, s + 1, F.lit(STRETCH + CHARS - 1)), lambda short: _let(
                F.lit(_LAST + 1).cast("long") - s - at, lambda top: F.transform(
                    F.sequence(F.lit(1), F.least(F.lit(STRETCH), grams - s)),
                    lambda i: _packed(F.substr(short, i, F.lit(CHARS)), top - i))))

        return F.flatten(F.transform(_starts(grams, STRETCH), stretch))

    # Counted once, not for every run: expressions in a lambda are worked out for every entry.
    return _let(F.length(chars) - (CHARS - 1), by_stretch)


def _selected(chars: Column, at: Column) -> Column:
    """The selected entries of a piece of text without space that begins at character ``at``."""
    def minima(keys):
        return F.when(F.size(keys) < CHAR_WINDOW, F.array(F.array_min(keys))).otherwise(
            _let(_halves(keys, 1), lambda a: _let(_halves(a, 2), lambda b: _let(_halves(b, 4), lambda c: F.array_distinct(_halves(c, 8))))))

    return (F.when(F.length(chars) == 0, F.array().cast(_NONE))
            .when(F.length(chars) < CHARS, F.array(_packed(chars, F.lit(_LAST).cast("long") - at)))
            .otherwise(_let(_hashed(chars, at), minima)))


def selection(chars: Column, pieces: tuple[int, ...] = PIECES) -> Column:
    """The selected (hash, position) entries of a text without space as longs, in order."""
    def within(text, at, sizes):
        if not sizes:
            return _selected(text, at)
        windows = F.length(text) - (REACH - 1)
        return F.array_distinct(F.flatten(F.transform(_starts(windows, sizes[0]), lambda s: _let(
            F.substr(text, s + 1, F.lit(sizes[0] + REACH - 1)), lambda part: within(part, s + at, sizes[1:])))))

    return within(chars, F.lit(0), pieces)


def position(entry: Column) -> Column:
    return F.lit(_LAST) - entry.bitwiseAND(F.lit(_LAST))


def seam_selection(own: Column, head: Column, after: Column, tail: Column) -> Column:
    """The selection of ``head`` and ``tail`` one after the other (both without space), ``own`` being the
    selection of a text that begins with ``head``, ``after`` of one that begins with ``tail``.

    With a and b characters in them: of ``own``, what stands at least a window before the seam; the windows that
    touch the seam, begun a window's reach of hashes early, to decide on what only those select that
    end before it; of ``after`` what stands a window before its end, moved by a; and the last windows.
    A tail of up to two reaches is hashed as a whole.
    """
    early = REACH + CHAR_WINDOW - 1                # characters before an edge that are hashed again

    def joined(a, b):
        long_tail = b > 2 * REACH
        none = F.array().cast(_NONE)
        kept = F.filter(own, lambda e: position(e) <= a - REACH)
        short = F.concat(F.right(head, F.lit(early)), F.left(tail, F.when(long_tail, REACH - 1).otherwise(b)))
        seam = F.when((a == 0) & long_tail, none).otherwise(_let(short, lambda x: _selected(x, F.greatest(a - early, F.lit(0)))))
        moved = F.transform(F.filter(after, lambda e: position(e) <= b - REACH), lambda e: e - a)
        last = _let(F.right(tail, F.lit(early)), lambda x: _selected(x, a + b - early))
        return F.array_distinct(F.concat(kept, seam, F.when(long_tail, F.concat(moved, last)).otherwise(none)))

    return _let(F.length(head), lambda a: _let(F.length(tail), lambda b: joined(a, b)))


def entries(selection: str) -> Column:
    """The selection as structs of hash and position (in characters without space)."""
    return F.transform(selection, lambda k: F.struct(
        F.shiftright(k, 31).alias("hash"),
        position(k).cast("int").alias("position")))


def hashes(selection: str) -> Column:
    """The distinct hashes of a selection."""
    return F.array_distinct(F.transform(selection, lambda k: F.shiftright(k, 31)))


def digest(selection: str) -> Column:
    """128 bits over hashes and positions, as hexadecimal text."""
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(selection)), 16, "0"),
                            F.lpad(F.hex(F.xxhash64(F.lit(1), selection)), 16, "0")))


def likeness(a: str, b: str) -> Column:
    """Shared share of two hash sets, 0 to 1."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def neighbours(docs: DataFrame, docs_per_bucket: int) -> tuple[DataFrame, Window]:
    """``docs`` (doc_id, text) dealt by ranges of doc_id, and the window that
    puts them in descending order.

    The first document of the next range below is added to every range as a
    ghost (the first of all to the lowest), so that no document lacks its
    successor.  Only one summary row per range is ever ordered globally.
    """
    docs = docs.withColumn("bucket", order_buckets(docs, docs_per_bucket))
    tops = docs.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    over = Window.orderBy("bucket")
    tops = written(tops.select("bucket", "top", F.coalesce(
        F.lead("bucket").over(over), F.min("bucket").over(Window.partitionBy())).alias("to")), "ranges")
    ghosts = (docs.join(tops, (docs["bucket"] == tops["bucket"]) & docs["doc_id"].eqNullSafe(tops["top"]))
              .groupBy(F.col("to").alias("bucket"), "doc_id").agg(F.max_by("text", F.xxhash64("text")).alias("text"))
              .select("doc_id", "text", "bucket", F.lit(1).alias("ghost")))
    rows = docs.withColumn("ghost", F.lit(0)).unionByName(ghosts)
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return rows.withColumn("tie", F.xxhash64("text")), order


def fingerprints(docs: DataFrame, docs_per_bucket: int = 512, pieces: tuple[int, ...] = PIECES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and likenesses to the
    edited text and to the next document (descending doc_id, cyclic).

    The text is shuffled once; selections are made where it arrives.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows, order = neighbours(docs, docs_per_bucket)
    rows = (rows.repartition("bucket").sortWithinPartitions("bucket", "ghost", F.desc_nulls_last("doc_id"), F.desc("tie"))
            .withColumn("chars", without_space(F.col("text"))).withColumn("own", selection(F.col("chars"), pieces)).drop("chars"))
    rows = rows.withColumn("next", F.lead("text").over(order)).withColumn("after", F.lead("own").over(order))
    rows = rows.where("ghost = 0").withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("head", F.left("text", (F.col("n_chars") - half).cast("int")))
    rows = rows.withColumn("tail", F.left(F.coalesce("next", F.lit("")), half)).drop("next", "text")
    rows = rows.withColumn("edited_sha256", F.sha2(F.concat("head", "tail"), 256))
    rows = rows.withColumn("head", without_space(F.col("head"))).withColumn("tail", without_space(F.col("tail")))
    none = F.array().cast(_NONE)
    rows = rows.withColumn("new", seam_selection(F.col("own"), F.col("head"), F.coalesce("after", none), F.col("tail")))
    rows = rows.select("doc_id", "n_chars", "edited_sha256", digest("own").alias("fingerprint"),
                       digest("new").alias("edited_fingerprint"), hashes("own").alias("own"), hashes("new").alias("new"),
                       hashes("after").alias("after"))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness("own", "new").alias("near_edited"), likeness("own", "after").alias("near_next"))
