"""Corpus jobs over token arrays.

Shape of every job: a projection that tokenizes (no shuffle), a generator
(``explode``), and one hash aggregation with map-side partial aggregation, so
a hot token or a hot group is pre-aggregated inside each task before the
shuffle. Top-k is a ``row_number`` filter, which Spark plans as a per-task
group limit before the shuffle and a final limit after it.
"""

from __future__ import annotations

import functools

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import save_shared


def token_table(df: DataFrame, id_cols: Sequence[str], tokens: Column) -> DataFrame:
    """One row per token occurrence: ids, ``pos`` (0-based), ``token``."""
    return df.select(*id_cols, F.posexplode(tokens).alias("pos", "token")) \
             .withColumn("pos", F.col("pos").cast("bigint"))


def stream_table(df: DataFrame, id_cols: Sequence[str], stream: Column) -> DataFrame:
    """One row per token of a stream: ids, ``pos``, ``token``, ``start``, ``end``, ``type``."""
    x = df.select(*id_cols, F.explode(stream).alias("_x"))
    return x.select(*id_cols, F.col("_x.position").cast("bigint").alias("pos"), "_x.token", F.col("_x.start").cast("bigint").alias("start"),
                    F.col("_x.end").cast("bigint").alias("end"), "_x.type")


def term_counts(df: DataFrame, tokens: Column, group_cols: Sequence[str] = (),
                out: str = "n") -> DataFrame:
    """Occurrences per (group, token)."""
    return (df.select(*group_cols, F.explode(tokens).alias("token"))
              .groupBy(*group_cols, "token")
              .agg(F.count(F.lit(1)).alias(out)))


def term_counts_by_piece(df: DataFrame, text: str, tokens: Column, group_cols: Sequence[str] = (), out: str = "n") -> DataFrame:
    """``term_counts`` of tokens that hold no white space: the pieces between white space are counted first.

    ``tokens`` is an expression over the column ``text``; it is evaluated once per distinct (group, piece), and
    those grow far slower than the corpus. Not for tokens that look beyond a blank (n-grams of texts, shingles).
    """
    from ..functions.tokenizers import pieces
    counted = df.select(*group_cols, F.explode(pieces(F.col(text))).alias(text)).groupBy(*group_cols, text).agg(F.count(F.lit(1)).alias("_n"))
    return (counted.select(*group_cols, "_n", F.explode(tokens).alias("token"))
                   .groupBy(*group_cols, "token").agg(F.sum("_n").alias(out)))


def ngram_counts(df: DataFrame, text: Column, group_cols: Sequence[str] = ()) -> DataFrame:
    """Counts of the 1- and 2-grams of whole texts (the `ngram` tokenizer), exactly.

    The pieces between blanks are counted first, each with the blanks around it, so
    two neighbours share a blank and every bigram of a text lies in one of them: the
    bigrams of each distinct piece are generated once, however often it occurs. Every
    character but the last of a text starts exactly one bigram, so the unigram
    counts are the bigram counts summed by first character, plus one per text for
    its last character; the bigram aggregate is read twice from one shuffle.
    """
    from ..functions.tokenizers import characters
    blank = F.lit(" ")
    cut = df.select(*group_cols, F.split(text, " ").alias("_p"), F.substring(text, -1, 1).alias("_last"))
    n = F.size("_p")
    inner = F.transform(F.slice("_p", F.lit(2), F.greatest(n - 2, F.lit(0))), lambda p: F.concat(blank, p, blank))
    edges = F.array(F.concat(F.get("_p", F.lit(0)), blank), F.concat(blank, F.element_at("_p", -1)))
    pieces = F.when(n < 2, F.col("_p")).otherwise(F.concat(edges, inner))
    counted = cut.select(*group_cols, F.explode(pieces).alias("_piece")).groupBy(*group_cols, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    chars = counted.select(*group_cols, "_n", characters(F.col("_piece")).alias("_c"))
    bigrams = F.zip_with(F.slice("_c", 1, F.greatest(F.size("_c") - 1, F.lit(0))),
                         F.slice("_c", 2, F.greatest(F.size("_c") - 1, F.lit(0))), lambda a, b: F.concat(a, b))
    big = (chars.select(*group_cols, "_n", F.explode(bigrams).alias("token"))
                .groupBy(*group_cols, "token").agg(F.sum("_n").alias("n")))
    last = cut.filter(F.length("_last") > 0).select(*group_cols, F.col("_last").alias("token"),
                                                    F.lit(1).cast("bigint").alias("n"))
    uni = (big.select(*group_cols, F.substring("token", 1, 1).alias("token"), "n")
              .unionByName(last)
              .groupBy(*group_cols, "token").agg(F.sum("n").alias("n")))
    return big.unionByName(uni).withColumn("n", F.col("n").cast("bigint"))


def term_freqs(df: DataFrame, tokens: Column, group_cols: Sequence[str] = ()) -> DataFrame:
    """Term frequency ``tf`` and document frequency ``df`` per (group, token), one shuffle.

    Each row emits (token, 1, 0) per occurrence and (token, 0, 1) per distinct
    token of the row; a single sum aggregation gives both counts. The token
    array is projected once (a common projection is not inlined twice).
    """
    tok = df.select(*group_cols, tokens.alias("_toks"))
    pairs = F.concat(
        F.transform("_toks", lambda x: F.struct(x.alias("token"), F.lit(1).alias("o"), F.lit(0).alias("d"))),
        F.transform(F.array_distinct("_toks"),
                    lambda x: F.struct(x.alias("token"), F.lit(0).alias("o"), F.lit(1).alias("d"))))
    return (tok.select(*group_cols, F.explode(pairs).alias("p"))
               .groupBy(*group_cols, F.col("p.token").alias("token"))
               .agg(F.sum("p.o").cast("bigint").alias("tf"), F.sum("p.d").cast("bigint").alias("df")))


def top_k(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each partition under ``order`` (ties broken by the caller)."""
    w = Window.partitionBy(*partition_cols).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) <= k)
              .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def term_stats(df: DataFrame, tokens: Column, group_cols: Sequence[str] = ("lang",),
               k: int = 20) -> DataFrame:
    """Per group, the ``k`` terms with the highest document frequency."""
    stats = term_freqs(df, tokens, group_cols)
    return top_k(stats, group_cols, [F.col("df").desc(), F.col("tf").desc(), F.col("token")], k)


def fingerprint_clusters(df: DataFrame, id_col: str, fingerprint: Column,
                         max_hot_keys: int = 100_000, min_hot_size: int = 100_000) -> DataFrame:
    """Documents whose fingerprints are equal, in clusters of two or more.

    Output: ``doc_id``, ``cluster_id`` (smallest id of the cluster),
    ``cluster_size``. The fingerprint is reduced to a SHA-256 key first, so the
    shuffle moves 32 bytes per row, not the whole fingerprint. A cluster is
    never collected: an aggregate gives (key -> min id, size), pre-aggregated
    map-side, and is joined back on the key.

    Hot clusters are split off explicitly: a cluster of at least
    ``max(min_hot_size, ceil(n / max_hot_keys))`` documents is hot, and there
    can be at most ``max_hot_keys`` of those, so their (key, id, size) rows
    have a proven bound and are broadcast; their documents join map-side,
    without a shuffle. The remaining clusters are each smaller than the
    threshold and join by a shuffle without skew.
    """
    keyed = df.select(F.col(id_col).alias("doc_id"), F.sha2(fingerprint, 256).alias("_fp"))
    # Both the aggregate and the join-back read the keys: write them once
    # (small rows) instead of analysing every text twice; a filter on the
    # computed key would otherwise also be pushed below the projection and
    # repeat the analysis there.
    keyed = materialize(keyed).filter(F.col("_fp").isNotNull())
    sizes = (keyed.groupBy("_fp")
                  .agg(F.min("doc_id").alias("cluster_id"), F.count(F.lit(1)).alias("cluster_size"))
                  .filter(F.col("cluster_size") > 1))
    joined = join_hot_split(keyed, sizes, ["_fp"], "cluster_size", keyed.count(),
                            max_hot_keys, min_hot_size)
    return joined.select("doc_id", "cluster_id", F.col("cluster_size").cast("bigint"))


def join_hot_split(big: DataFrame, small: DataFrame, on: Sequence[str], weight_col: str, n_big: int,
                   max_hot_keys: int = 100_000, min_hot_size: int = 100_000) -> DataFrame:
    """Inner join of ``big`` with ``small`` (unique on ``on``) that splits hot keys off.

    ``small[weight_col]`` is the number of ``big`` rows of each key. Keys with
    at least ``max(min_hot_size, ceil(n_big / max_hot_keys))`` rows are hot;
    there can be at most ``max_hot_keys`` of them, a proven bound, so their
    ``small`` rows are broadcast and their ``big`` rows join map-side. Every
    other key has fewer rows than the threshold and joins by a shuffle without
    skew.
    """
    on = list(on)
    threshold = max(min_hot_size, -(-n_big // max_hot_keys), 1)
    hot = F.broadcast(small.filter(F.col(weight_col) >= threshold))
    cold = small.filter(F.col(weight_col) < threshold)
    def null_safe(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        # equality on names would lose the rows whose group is null
        right = right.withColumnsRenamed({c: f"__{c}" for c in on})
        cond = functools.reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"__{c}"]) for c in on])
        return left.join(right, cond, how).drop(*[f"__{c}" for c in on])
    hot_rows = null_safe(big, hot, "inner")
    cold_rows = null_safe(null_safe(big, hot.select(*on), "left_anti"), cold, "inner")
    return hot_rows.unionByName(cold_rows)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and read it back, as Parquet.

    The files survive the loss of the executor that wrote them, the lineage above
    is cut, and readers keep column pruning and filter pushdown.
    """
    return save_shared(df, "written")


def vocabulary(df: DataFrame, tokens: Column, group_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct (group, token) with occurrence counts ``n``."""
    return term_counts(df, tokens, group_cols)


def apply_word_steps(vocab: DataFrame, steps: Sequence[Callable[[Column], Column]],
                     src: str = "token", dst: str = "stem") -> DataFrame:
    """Run a per-word chain on a vocabulary, one projection per step.

    A step refers to its input several times; applied directly, the chain of
    steps would be expanded by the optimizer into an expression that grows
    exponentially with the number of steps. Each step is therefore applied as
    a lambda over a one-element array, ``transform(array(w), step)[1]``, which
    refers to the previous column exactly once: the plan grows linearly.
    """
    return vocab.withColumn(dst, chain(F.col(src), steps))


def chain(value: Column, steps: Sequence[Callable[[Column], Column]]) -> Column:
    """All steps as one nested expression (one projection, analysed once);
    ``once`` keeps it linear in the number of steps."""
    for step in steps:
        value = once(value, step)
    return value


def once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` referenced once (see ``apply_word_steps``)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def stem_counts(df: DataFrame, tokens: Column, language: str = "english",
                group_cols: Sequence[str] = (), text: str | None = None) -> DataFrame:
    """F16: occurrences per (group, stem), as counting ``filters.stemmer`` gives them; each distinct token is stemmed once.

    With ``text``, the column of ``tokens``, its pieces are counted first (``term_counts_by_piece``).
    """
    from ..functions import filters as flt
    counts = term_counts(df, tokens, group_cols) if text is None else term_counts_by_piece(df, text, tokens, group_cols)
    stems = apply_word_steps(counts, flt.stem_steps(language))
    return stems.groupBy(*group_cols, F.col("stem").alias("token")).agg(F.sum("n").cast("bigint").alias("n"))


def stems_by_language(df: DataFrame, tokens: Column, languages: Sequence[str], text: str | None = None) -> DataFrame:
    """Occurrences and distinct forms per (language, stem): every language's stemmer over one vocabulary.

    A row of the vocabulary is stemmed ``len(languages)`` times where it lies. With ``text``, the column of
    ``tokens``, its pieces are counted first (``term_counts_by_piece``).
    """
    from ..functions import filters as flt
    stems = F.array(*[F.struct(F.lit(name).alias("language"), chain(F.col("token"), flt.stem_steps(name)).alias("stem"))
                      for name in languages])
    counts = term_counts(df, tokens) if text is None else term_counts_by_piece(df, text, tokens)
    return (counts.select("n", F.explode(stems).alias("s")).groupBy("s.language", "s.stem")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_forms"), F.sum("n").cast("bigint").alias("n")))


def terms_by_lang(df: DataFrame, text, lang: str, languages: Sequence[str] | None = None) -> DataFrame:
    """(lang, token, n), the counts of ``analyze.analyze_by_lang``; each distinct token is stemmed once.

    The filters before the stemmers run per distinct (lang, piece between blanks), one ``CASE`` branch per
    language; the stemmers run on the distinct (lang, token). Rows without a language, or of another one, count under it with the default analyzer.
    """
    from ..functions import filters as flt
    from . import analyze as an
    codes = list(an.LANG_ANALYZER) if languages is None else list(languages)
    named = df.select(F.col(lang).alias("lang"), (F.col(text) if isinstance(text, str) else text).alias("_text"))
    # one CASE over the languages; inside the lambda the token is a variable, so the nesting stays linear
    stem = once(F.col("token"), lambda x: an.by_language(
        F.col("lang"), {c: chain(x, flt.stem_steps(an.LANG_ANALYZER[c])) for c in codes}, x))
    counts = term_counts_by_piece(named, "_text", an.before_stems("_text", "lang", codes), ["lang"]).withColumn("_stem", stem)
    return counts.groupBy("lang", F.col("_stem").alias("token")).agg(F.sum("n").cast("bigint").alias("n"))


def shingle_counts(df: DataFrame, tokens: Column, group_cols: Sequence[str] = ()) -> DataFrame:
    """occurrences of unigrams and 2-token shingles (the multiset ``filters.shingle`` emits)."""
    from ..functions import filters as flt
    once_named = df.select(*group_cols, tokens.alias("_t"))
    return term_counts(once_named, F.concat(F.col("_t"), flt.bigram_shingles(F.col("_t"))), group_cols)


def stem_groups(df: DataFrame, tokens: Column, steps, id_col: str,
                group_cols: Sequence[str] = (), max_hot_keys: int = 100_000,
                min_hot_size: int = 1_000, text: str | None = None) -> DataFrame:
    """Forms per stem: stem the distinct vocabulary once, join back for the documents.

    Output per (group, stem): ``n_forms`` distinct surface forms, ``tf``
    occurrences, ``df`` documents holding any form (distinct (doc, stem),
    not a sum over forms). With ``text``, the column of ``tokens``, the units
    are the pieces between white space and each distinct one is tokenized
    once; else they are the tokens.
    """
    from ..functions.tokenizers import pieces
    units, own = (tokens, F.array("_unit")) if text is None else (pieces(F.col(text)), tokens)
    unit = "_unit" if text is None else text
    named = df.select(*group_cols, F.col(id_col).alias("_id"), units.alias("_units"))
    counted = materialize(named.select(*group_cols, F.explode("_units").alias(unit)).groupBy(*group_cols, unit).agg(F.count(F.lit(1)).alias("n")))
    made = counted.select(*group_cols, unit, "n", own.alias("_tokens"))
    vocab = made.select(*group_cols, "n", F.explode("_tokens").alias("token")).groupBy(*group_cols, "token").agg(F.sum("n").alias("n"))
    stems = materialize(apply_word_steps(vocab, steps))     # the vocabulary is stemmed once
    per_stem = stems.groupBy(*group_cols, "stem").agg(F.sum("n").cast("bigint").alias("tf"), F.count(F.lit(1)).cast("bigint").alias("n_forms"))
    # the stems of a unit, one row each
    forms = made.select(*group_cols, F.col(unit).alias("_unit"), F.col("n").alias("_rows"), F.explode(F.array_distinct("_tokens")).alias("token"))
    of_unit = materialize(_join_null_safe(forms, stems.select(*group_cols, "token", "stem"), [*group_cols, "token"])
                          .groupBy(*group_cols, "_unit", "_rows").agg(F.collect_set("stem").alias("_stems")))
    # A common unit ("the") is in nearly every document, and most rows are of common ones: split hot units off.
    per_doc = named.select(*group_cols, "_id", F.explode(F.array_distinct("_units")).alias("_unit"))
    joined = join_hot_split(per_doc, of_unit, [*group_cols, "_unit"], "_rows", counted.agg(F.sum("n")).first()[0] or 0,
                            max_hot_keys, min_hot_size)
    docs = (joined.select(*group_cols, "_id", F.explode("_stems").alias("stem")).groupBy(*group_cols, "stem", "_id").agg(F.lit(1).alias("_one"))
                  .groupBy(*group_cols, "stem").agg(F.count(F.lit(1)).cast("bigint").alias("df")))
    return _join_null_safe(per_stem, docs, [*group_cols, "stem"]).select(*group_cols, "stem", "tf", "df", "n_forms")


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which null groups meet, by the columns ``on`` of both sides."""
    right = right.withColumnsRenamed({c: f"__{c}" for c in on})
    same = functools.reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"__{c}"]) for c in on])
    return left.join(right, same).drop(*[f"__{c}" for c in on])
