"""Quality rules on repetition, from suffix arrays of words.

The words of a text are sorted as suffixes by prefix doubling; neighbours in
that order give the longest-common-prefix (LCP) intervals. The longest interval
that holds a suffix is the longest repeat that starts there, so the union of
all maximal repeats of at least ``MIN_REPEAT`` words is the union of those spans
over the suffixes. Two limits follow: the share of the text's characters under
the union, and the length of the longest repeat.

Many texts are sorted in one array: the first rank of a suffix holds the number
of its text, so that suffixes of different texts never meet. Only suffixes that
are still tied are sorted again, so a text without repeats costs few passes.

Defined cases: a null or blank text has no words (and fails the base rule of
``min_words``); texts of any length are read whole; repeated rows are judged one
by one; other columns of the input pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, table, text_of

#: Shortest repeat that counts, in words.
MIN_REPEAT = 8
#: Base rule: least words of a text, most percent of its words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: The method's limits: share of the characters under repeats, words of the longest one.
MAX_COVERED, MAX_LONGEST = 0.3, 256
#: Words that are sorted together.
BLOCK_WORDS = 400_000

OUT_FIELDS = [("n_words", pa.int64()), ("n_repeat_words", pa.int64()), ("covered_chars", pa.int64()),
              ("longest_repeat", pa.int64()), ("n_repeat_starts", pa.int64())]


def _group_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """For each place of a sorted array the first place with the same key."""
    first = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def _tied(starts: np.ndarray) -> np.ndarray:
    """Whether the group of each place has more than one member."""
    same = starts[1:] == starts[:-1]
    return np.concatenate((same, [False])) | np.concatenate(([False], same))


def longest_repeats(ids: np.ndarray, ends: np.ndarray, least: int = MIN_REPEAT) -> np.ndarray:
    """For each word the length of the longest repeat (of ``least`` words or more) that starts there, else 0.

    ``ids`` are word numbers of several texts in a row, ``ends`` for each word
    the place behind the last word of its text.
    """
    n = len(ids)
    longest = np.zeros(n, dtype=np.int64)
    if n == 0:
        return longest
    keys = ends * (int(ids.max()) + 1) + ids
    order = np.argsort(keys, kind="stable")
    starts = _group_starts(keys[order])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = starts
    active = order[_tied(starts)]
    levels, width = [rank], 1
    repeated = active if least <= 1 else None
    while len(active):
        rank, after = levels[-1], active + width
        inside = after < ends[active]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        keys = rank[active] * (n + 1) + second
        order = np.argsort(keys, kind="stable")
        active, keys = active[order], keys[order]
        starts, old = _group_starts(keys), _group_starts(keys // (n + 1))
        refined = rank.copy()
        refined[active] = rank[active] + starts - old
        width *= 2
        levels.append(refined)
        active = active[_tied(starts)]
        if repeated is None and width * 2 > least:    # the last level that is not above ``least``
            repeated = active
    if repeated is None or not len(repeated):
        return longest
    # neighbours in suffix order, and their common prefix from the levels
    order = repeated[np.argsort(levels[-1][repeated])]
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + lcp, b + lcp
        inside = (i < n) & (j < n)
        same = inside & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        lcp += np.where(same, 1 << k, 0)
    lcp[lcp < least] = 0
    np.maximum.at(longest, a, lcp)
    np.maximum.at(longest, b, lcp)
    return longest


def _measure(texts: list) -> dict[str, np.ndarray]:
    split = [t.encode().split() if t else [] for t in texts]    # bytes split at exactly the six blanks
    counts = np.array([len(w) for w in split], dtype=np.int64)
    out = {name: np.zeros(len(texts), dtype=np.int64) for name, _ in OUT_FIELDS}
    out["n_words"] = counts
    begin = 0
    while begin < len(split):
        stop, total = begin + 1, int(counts[begin])
        while stop < len(split) and total + counts[stop] <= BLOCK_WORDS:
            total += int(counts[stop])
            stop += 1
        if total:
            flat = [w for text in split[begin:stop] for w in text]
            numbers: dict[bytes, int] = {}
            ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in flat), dtype=np.int64, count=total)
            n = counts[begin:stop]
            doc = np.repeat(np.arange(stop - begin), n)
            longest = longest_repeats(ids, np.repeat(np.cumsum(n), n))
            at = np.flatnonzero(longest)
            if len(at):
                depth = np.zeros(total + 1, dtype=np.int64)
                np.add.at(depth, at, 1)
                np.add.at(depth, at + longest[at], -1)
                under = np.flatnonzero(np.cumsum(depth[:-1]) > 0)
                chars = np.array([len(flat[i].decode()) for i in under], dtype=np.int64)
                out["n_repeat_words"][begin:stop] = np.bincount(doc[under], minlength=stop - begin)
                out["covered_chars"][begin:stop] = np.bincount(doc[under], weights=chars, minlength=stop - begin)
                out["n_repeat_starts"][begin:stop] = np.bincount(doc[at], minlength=stop - begin)
                np.maximum.at(out["longest_repeat"], doc[at] + begin, longest[at])
        begin = stop
    return out


def repetition(df: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` plus n_words, n_repeat_words, covered_chars, longest_repeat, n_repeat_starts.

    ``keep_text=False`` drops the text itself from the output. Where ``df`` has a
    column of one of these names, underscores are put before the new one.
    """
    kept = [f for f in df.schema.fields if keep_text or f.name != text_col]
    schema = df.select(*[F.col(f"`{f.name}`") for f in kept]).schema
    names, new = [f.name for f in kept], fresh(df, *[name for name, _ in OUT_FIELDS])
    for name in new:
        schema = schema.add(name, T.LongType(), False)

    def run(batches):
        for batch in batches:
            found = _measure(batch.column(batch.schema.names.index(text_col)).to_pylist())
            columns = [batch.column(batch.schema.names.index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(found[c]) for c, _ in OUT_FIELDS],
                                             names=names + new)

    return df.mapInArrow(run, schema)


def line_and_symbol_counts(text: Column) -> dict[str, Column]:
    """word_chars, n_symbols and n_dup_lines of a text, as JVM-side expressions."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    blanks, symbols = " \t\n\x0b\x0c\r", "#*$%&|<>"
    return {"word_chars": F.length(F.translate(text, blanks, "")).cast("bigint"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, symbols, ""))).cast("bigint"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")}


def judge(df: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
          measured: DataFrame | None = None, word_chars: str = "word_chars") -> DataFrame:
    """Adds covered_share, base_failed and kept to a table of ``repetition`` that has a column ``word_chars``.

    ``measured`` is the table that was given to ``repetition``, needed only if it had columns named like the
    results: those are then read under the names that they got. Where ``df`` has a column of one of the three
    names, underscores are put before the new one.
    """
    names = [name for name, _ in OUT_FIELDS]
    at = {n: F.col(f"`{c}`") for n, c in zip(names, names if measured is None else fresh(measured, *names))}
    chars, added = F.col(f"`{word_chars}`"), fresh(df, "covered_share", "base_failed", "kept")
    share = F.when(chars > 0, at["covered_chars"] / chars).otherwise(0.0)
    base = (at["n_words"] < MIN_WORDS) | (100 * at["n_repeat_words"] > MAX_REPEAT_PERCENT * at["n_words"])
    kept = ~base & (share <= max_covered) & (at["longest_repeat"] <= max_longest)
    return df.select("*", *[c.alias(n) for c, n in zip((share, base, kept), added)])


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_of("text")
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), *[
        c.alias(name) for name, c in line_and_symbol_counts(text).items()])
    return judge(repetition(docs, keep_text=False)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_chars", "covered_share", "longest_repeat")
