"""Document fingerprints from closed syncmers, in DataFrame operations only.

The alphabet are pieces of words: each word is cut from its start into pieces of
up to four code points, blanks only separate. A k-mer is ``K`` pieces in a row, an
s-mer ``S`` of them. A k-mer is a closed syncmer if the smallest hash of its s-mers
is that of its first or its last one. Whether it is chosen depends on its own
pieces alone, so equal passages of two texts choose equal anchors wherever they
stand (a minimizer depends on its neighbours).

A fingerprint is the bottom sketch of a text's distinct anchors: the ``SKETCH``
smallest of their 32-bit hashes (signed), as hex in ascending order; a text with fewer
anchors has them all. The likeness of two fingerprints is the share of common
hashes among the ``SKETCH`` smallest of both together, an unbiased estimate of the
Jaccard similarity of the anchors (exact if both are complete; standard
deviation at most 0.5 / sqrt(SKETCH) = 0.044 otherwise). Anchors with positions
serve positional matching (``leading_anchors``).

Everything is an expression over arrays: the pieces come from one regular
expression, minima of windows from shifted arrays, so no step looks at a text's
pieces more often than a fixed number of times.

Defined cases: a null text is empty; an empty or blank text has no anchor and the
fingerprint ''; another text without a closed syncmer (such as one of fewer than
``K`` pieces) has one anchor, all its pieces, at 0; two empty fingerprints are alike
(1.0), an empty and another one are not (0.0). Texts that differ in blanks only
have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from .common import let, save_shared, table, text_of

#: A letter of the alphabet.
PIECE = r"[^\x20\x09-\x0D]{1,4}"
#: Pieces of an s-mer (two), and s-mers of a k-mer (a power of two).
S, WINDOW = 2, 4
#: Pieces of a k-mer.
K = S + WINDOW - 1
#: Anchors of a fingerprint.
SKETCH = 128


def _smers(pieces: Column) -> Column:
    """Hashes of all s-mers, by the number of their first piece."""
    pairs = F.zip_with(pieces, F.slice(pieces, F.lit(2), F.size(pieces)), lambda a, b: F.xxhash64(a, b))
    return F.slice(pairs, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))


def _chosen(h: Column) -> Column:
    """(pos, hash) of the closed syncmers, given the hashes of a text's s-mers."""
    def narrow(low: Column, width: int) -> Column:
        """From the minima over ``width`` s-mers to those over WINDOW of them, and from there to the anchors."""
        if width < WINDOW:
            wider = F.zip_with(low, F.slice(low, F.lit(width + 1), F.size(low)), lambda a, b: F.least(a, b))
            return let(wider, lambda x: narrow(x, 2 * width))
        places = F.filter(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: (
            (F.get(low, i) == F.get(h, i)) | (F.get(low, i) == F.get(h, i + WINDOW - 1))))
        return F.transform(places, lambda i: F.struct(i.alias("pos"), F.hash(F.get(h, i), F.get(h, i + S), F.get(h, i + WINDOW - 1)).alias("hash")))
    return F.when(F.size(h) >= WINDOW, narrow(h, 1))


def anchors(text: Column) -> Column:
    """The anchors of a text: array of (pos, hash) in the order of the text; ``pos`` numbers the pieces from 0."""
    def of(pieces: Column) -> Column:
        whole = F.when(F.size(pieces) > 0, F.array(F.struct(F.lit(0).alias("pos"), F.hash(pieces).alias("hash")))).otherwise(
            F.array().cast("array<struct<pos:int,hash:int>>"))
        return let(let(_smers(pieces), _chosen), lambda a: F.when(F.size(a) > 0, a).otherwise(whole))
    hashed = F.transform(F.regexp_extract_all(text_of(text), F.lit(PIECE), F.lit(0)), lambda p: F.xxhash64(p))
    return let(hashed, of)


def sketch(found: Column) -> Column:
    """The ``SKETCH`` smallest hashes of anchors (as signed numbers), ascending."""
    return F.slice(F.sort_array(F.array_distinct(F.transform(found, lambda a: a["hash"]))), 1, SKETCH)


def spelled(values: Column) -> Column:
    """A sketch as text: eight hex digits per anchor."""
    return F.array_join(F.transform(values, lambda v: F.lpad(F.lower(F.hex(v.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text."""
    return spelled(sketch(anchors(text)))


def likeness(a: Column, b: Column) -> Column:
    """The likeness (0 to 1) of two sketches."""
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    return let(both, lambda u: F.when(F.size(u) == 0, 1.0).otherwise(
        F.size(F.array_intersect(F.array_intersect(a, b), u)) / F.size(u)))


def leading_anchors(a: Column, b: Column) -> Column:
    """How many anchors two texts share from their start on, at equal positions."""
    differs = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    return let(F.array_position(differs, F.lit(True)), lambda p: F.when(p > 0, p - 1).otherwise(F.size(a)))


def with_next(docs: DataFrame, take_of: Callable[[Column], Column], carry_of: Callable[[Column], Column],
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, carried, next_text, next_carried): every document and the one after it, by descending id.

    The last one is followed by the first; null ids come last; documents of one
    id follow in the order of a digest of their text; equal rows are one place.
    ``take_of`` a text is how many code points of the next one its document
    needs; ``carry_of`` a text is computed once and comes along.

    Texts are shuffled once: both joins read the same exchange, and of the next
    text only what is taken moves a second time. Places are numbered on ids and
    digests alone.
    """
    text, id_ = text_of(text_col), F.col(id_col)
    row = F.unhex(F.md5(F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("")), text).cast("binary")))
    places, n = number_rows(docs.select(row.alias("row"), id_.alias("id"), F.md5(text.cast("binary")).alias("digest"), take_of(text).cast("int").alias("take")).distinct(),
                            [F.col("id").desc_nulls_last(), F.col("digest")], "place")
    places = save_shared(places.drop("digest"), "places")
    links = places.select("id", F.col("row").alias("to"), "take", F.pmod(F.col("place") + 1, F.lit(max(n, 1))).alias("place"))
    links = links.join(places.select("place", "row"), "place").drop("place")
    rows = docs.select(row.alias("row"), text.alias("text"), carry_of(text).alias("carried"))
    given = rows.join(links, "row").groupBy("to").agg(
        F.first("id").alias("id"), F.first(F.left("text", F.col("take"))).alias("next_text"), F.first("carried").alias("next_carried"))
    return rows.join(given, F.col("row") == F.col("to")).select("id", "text", "carried", "next_text", "next_carried")


def op11_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = lambda text: F.floor(F.length(text) / 3).cast("int")
    both = with_next(table(spark, sf_dir, "documents"), third, lambda text: sketch(anchors(text)))
    n = F.length("text")
    edited = F.concat(F.left("text", n - third(F.col("text"))), "next_text")
    both = both.select(F.col("id").alias("doc_id"), n.cast("bigint").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
                       "carried", sketch(anchors(edited)).alias("edited"), "next_carried")
    return both.select("doc_id", "n_chars", "edited_sha256", spelled(F.col("carried")).alias("fingerprint"),
                       spelled(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("carried"), F.col("edited")).alias("near_edited"),
                       likeness(F.col("carried"), F.col("next_carried")).alias("near_next"))
