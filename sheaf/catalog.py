"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or DataFrames derived from them) in
whole; the DuckDB oracle for each lives in ``sheaf.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import filters as flt
from .functions import tokenizers as tok
from .plans import jobs
from .session import spread
from .sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def docs(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """`documents`, pruned to ``cols`` and spread over the cores for text work."""
    df = read_table(spark, sf_dir, "documents")
    if cols:
        df = df.select(*cols)
    return spread(df)


def letter_lower(text="text"):
    """Letter runs of the lower-cased text (the `lowercase` tokenizer): one
    case mapping per text instead of one per token."""
    return tok.lowercase(F.col(text))


@query("term_stats")
def q_term_stats(spark, sf_dir):
    """T7 (flagship): every lowercase-tokenizer term per language with tf and df."""
    d = docs(spark, sf_dir, "doc_id", "lang", "text")
    stats = jobs.term_freqs(d, letter_lower(), ["lang"])
    return stats.select("lang", "token", F.col("tf").cast("bigint").alias("tf"), F.col("df").cast("bigint").alias("df"))


@query("top_terms")
def q_top_terms(spark, sf_dir):
    """T7, report: the 20 terms of each language with the highest document frequency."""
    d = docs(spark, sf_dir, "doc_id", "lang", "text")
    return jobs.term_stats(d, letter_lower(), ["lang"], 20)


# ---------------------------------------------------------------------------
# Text: tokenizers, analyzers and token filters as corpus jobs on `documents`.
# Each is "tokens per row -> explode -> count per (lang, token)".
# ---------------------------------------------------------------------------
from .functions import porter, stopwords, stream  # noqa: E402
from .plans import analyze as an  # noqa: E402


def std_lower(text="text"):
    return flt.lowercase(tok.standard(F.col(text)))


#: Filters for scripts that the tables do not hold: the texts get such letters by a stated substitution.
SUBSTITUTED = {
    "f_cjk_width": "translate(text, 'abcdefg', 'ａｂｃｄｅｆｇ')",
    "f_decimal_digit": "translate(text, 'aeio', '٣४５๗')",
    "f_arabic": "translate(text, 'aehiotn', 'أآةىإـً')",
    "f_persian": "translate(text, 'aehio', 'یێۀکہ')",
    "f_serbian": "translate(text, 'abcdefghijklmnoprstuvz', 'абцдефгхијклмнопрстувз')",
    "f_elision": "replace(replace(text, ' t', ' l''t'), ' o', ' Qu’o')",
    "f_cjk_bigram": "translate(text, 'aeiou', '中文字单日')", "an_cjk": "translate(text, 'aeioubcd', '中文字单日ｂｃｄ')",
    "an_stemmed": "concat_ws(' ', replace(replace(replace(replace(replace(replace(text, ' t', 'amente t'), ' a', 'hetene a'), ' s', 'ssa s'), "
                  "' o', 'lerden o'), ' i', 'oknak i'), ' b', 'igheden b'), "
                  "translate(replace(text, 'ing', 'ая'), 'abcdefghijklmnoprstuvzy', 'абцдефгхиклмнопарстувзы'))",
}


#: Tokens that may hold white space, or that hang on the whole text; those of the other jobs lie between two blanks.
WHOLE_TEXT = ("tok_edge_ngram", "f_trim")


def _counts(name, tokens_fn):
    def run(spark, sf_dir):
        d = docs(spark, sf_dir, "doc_id", "lang", "text")
        if name in SUBSTITUTED:
            d = d.withColumn("text", F.expr(SUBSTITUTED[name]))
        counts = jobs.term_counts(d, tokens_fn(), ["lang"]) if name in WHOLE_TEXT else jobs.term_counts_by_piece(d, "text", tokens_fn(), ["lang"])
        return counts.withColumn("n", F.col("n").cast("bigint"))
    return run


TERM_COUNT_JOBS = {
    # Z1-Z8 tokenizers
    "tok_standard": lambda: tok.standard(F.col("text")),
    "tok_letter": lambda: tok.letter(F.col("text")),
    "tok_lowercase": lambda: tok.lowercase(F.col("text")),
    "tok_whitespace": lambda: tok.whitespace(F.col("text")),
    "tok_url_email": lambda: tok.uax_url_email(F.col("text")),
    "tok_classic": lambda: tok.classic(F.col("text")),
    "tok_edge_ngram": lambda: tok.edge_ngram(F.col("text")),
    # N1-N5, N12 analyzers
    "an_standard": lambda: an.analyze("text", "standard"),
    "an_simple": lambda: an.analyze("text", "simple"),
    "an_whitespace": lambda: an.analyze("text", "whitespace"),
    "an_stop": lambda: an.analyze("text", "stop"),
    "an_pattern": lambda: an.analyze("text", "pattern"),
    "an_cjk": lambda: an.analyze("text", "cjk"),
    # F* filters after standard + lowercase
    "f_lowercase": lambda: std_lower(),
    "f_uppercase": lambda: flt.uppercase(tok.standard(F.col("text"))),
    "f_asciifolding": lambda: flt.FILTERS["asciifolding"](std_lower()),
    "f_cjk_width": lambda: flt.FILTERS["cjk_width"](std_lower()),
    "f_decimal_digit": lambda: flt.FILTERS["decimal_digit"](std_lower()),
    "f_scand_norm": lambda: flt.FILTERS["scandinavian_normalization"](std_lower()),
    "f_scand_fold": lambda: flt.FILTERS["scandinavian_folding"](std_lower()),
    "f_arabic": lambda: flt.FILTERS["arabic_normalization"](std_lower()),
    "f_persian": lambda: flt.FILTERS["persian_normalization"](std_lower()),
    "f_serbian": lambda: flt.FILTERS["serbian_normalization"](std_lower()),
    "f_cjk_bigram": lambda: an.tokenize("text", "standard", ["lowercase", "cjk_bigram"]),
    "f_classic": lambda: flt.classic(tok.classic(F.col("text"))),
    "f_edge_ngram": lambda: flt.edge_ngram(std_lower()),
    "f_ngram": lambda: flt.ngram(std_lower()),
    "f_reverse": lambda: flt.reverse(std_lower()),
    "f_stop": lambda: flt.stop(std_lower()),
    "f_truncate": lambda: flt.truncate(std_lower()),
    "f_word_delimiter": lambda: flt.word_delimiter(tok.whitespace(F.col("text"))),
    "f_trim": lambda: flt.trim(F.split(F.col("text"), "[.!?]")),
    # filters made for one language, over every document as any other filter
    "f_german": lambda: flt.FILTERS["german_normalization"](std_lower()),
    "f_elision": lambda: flt.elision(std_lower()),
}

for _name, _fn in TERM_COUNT_JOBS.items():
    QUERIES[_name] = _counts(_name, _fn)


@query("scan_documents")
def q_scan_documents(spark, sf_dir):
    """The whole table, every column (match-all)."""
    return read_table(spark, sf_dir, "documents")


@query("doc_count")
def q_doc_count(spark, sf_dir):
    """A4."""
    from .sources.tables import doc_count
    return doc_count(read_table(spark, sf_dir, "documents"))


@query("tokenize_documents")
def q_tokenize_documents(spark, sf_dir):
    """T1 + T5 + D5: standard tokenizer, lowercase and asciifolding; joined per row."""
    d = docs(spark, sf_dir, "doc_id", "text")
    return an.with_tokenized(d, "text", "standard", ["lowercase", "asciifolding"]).drop("text")


@query("analyze_documents")
def q_analyze_documents(spark, sf_dir):
    """The `standard` analyzer; joined per row."""
    d = docs(spark, sf_dir, "doc_id", "text")
    return an.with_analyzed(d, "text", "standard").drop("text")


@query("custom_analyzer")
def q_custom_analyzer(spark, sf_dir):
    """T4: a registered pipeline by name (standard, lowercase, asciifolding, unique)."""
    d = docs(spark, sf_dir, "doc_id", "text")
    return an.with_analyzed(d, "text", "folded_words").drop("text")


@query("token_table")
def q_token_table(spark, sf_dir):
    """(doc_id, pos, token, start, end, type) for the `standard` analyzer."""
    d = docs(spark, sf_dir, "doc_id", "text")
    return jobs.stream_table(d, ["doc_id"], an.token_stream("text", "standard", ["lowercase"]))


@query("shingle_gaps")
def q_shingle_gaps(spark, sf_dir):
    """F15 behind F17: 2-token shingles per document with a filler where a stop word stood, with their places."""
    d = docs(spark, sf_dir, "doc_id", "text")
    shingles = an.token_stream("text", "standard", ["lowercase", "stop", lambda s: stream.shingle(s, unigrams=False)], typed=False)
    return jobs.stream_table(d, ["doc_id"], shingles).drop("type")


@query("html_strip_pages")
def q_html_strip_pages(spark, sf_dir):
    """html_strip of every page; the text stays one piece."""
    p = spread(read_table(spark, sf_dir, "pages").select("page_id", "html"))
    return an.with_stripped(p, "html").drop("html")


@query("fingerprint_clusters")
def q_fingerprint_clusters(spark, sf_dir):
    """Documents with equal fingerprints (no output size cap), clusters of 2+."""
    d = docs(spark, sf_dir, "doc_id", "text")
    fp = F.get(an.analyze("text", "fingerprint"), F.lit(0))      # null for a text without tokens
    return jobs.fingerprint_clusters(d, "doc_id", fp)


@query("f_fingerprint")
def q_f_fingerprint(spark, sf_dir):
    """F9 with its default cap of 255 characters: the token or nothing, per document."""
    d = docs(spark, sf_dir, "doc_id", "text")
    t = flt.fingerprint(std_lower())
    return d.select("doc_id", F.size(t).cast("bigint").alias("n_tokens"),
                    F.array_join(t, " ").alias("fingerprint"))


@query("f_limit")
def q_f_limit(spark, sf_dir):
    """first token only, per document."""
    d = docs(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", F.array_join(flt.limit(std_lower()), " ").alias("first_token"))


@query("f_unique")
def q_f_unique(spark, sf_dir):
    """tokens and distinct tokens per source (unique never grows an array)."""
    d = docs(spark, sf_dir, "doc_id", "source", "text")
    t = d.select("source", std_lower().alias("t"))
    return (t.groupBy("source")
             .agg(F.sum(F.size("t")).cast("bigint").alias("n_tokens"),
                  F.sum(F.size(flt.unique(F.col("t")))).cast("bigint").alias("n_unique")))


@query("f_delimited_payload")
def q_f_delimited_payload(spark, sf_dir):
    """F6 on tokens `event_type|value` derived from `events`: token part and payload."""
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "event_type", "value"))
    toks = F.array(F.concat_ws("|", "event_type", F.floor("value").cast("string")))
    return (ev.select(F.explode(F.arrays_zip(flt.delimited_payload(toks).alias("token"),
                                            flt.payloads(toks).alias("payload"))).alias("z"))
              .groupBy(F.col("z.token").alias("token"))
              .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                   F.sum(F.col("z.payload").cast("bigint")).cast("bigint").alias("payload_sum")))


# ---------------------------------------------------------------------------
# Stemming and per-language analysis: stem the distinct vocabulary, not every
# token occurrence (the vocabulary grows far slower than the corpus).
# ---------------------------------------------------------------------------
@query("f_porter_stem")
def q_f_porter_stem(spark, sf_dir):
    """forms per language and Porter stem: forms, occurrences, documents."""
    d = docs(spark, sf_dir, "doc_id", "lang", "text")
    return jobs.stem_groups(d, std_lower(), porter.porter_steps(), "doc_id", ["lang"], text="text")


@query("f_stemmer")
def q_f_stemmer(spark, sf_dir):
    """F16: the `stemmer` filter (default language English) -> stem counts."""
    d = docs(spark, sf_dir, "doc_id", "lang", "text")
    return jobs.stem_counts(d, std_lower(), "english", ["lang"], text="text")


@query("an_by_lang")
def q_an_by_lang(spark, sf_dir):
    """Each document analysed by its language's analyzer; term counts per language."""
    return jobs.terms_by_lang(docs(spark, sf_dir, "doc_id", "lang", "text"), "text", "lang")


@query("an_stemmed")
def q_an_stemmed(spark, sf_dir):
    """The stemmers of the ten languages over the words of all documents, with endings of those languages."""
    d = docs(spark, sf_dir, "text").withColumn("text", F.expr(SUBSTITUTED["an_stemmed"]))
    return jobs.stems_by_language(d, std_lower(), an.STOP_ONLY_LANGUAGES, text="text")


@query("an_stop_lists")
def q_an_stop_lists(spark, sf_dir):
    """The ten stop-list-only analyzers over all documents: tokens kept by each."""
    d = docs(spark, sf_dir, "doc_id", "text").select(std_lower().alias("t"))
    sums = [F.sum(F.size(flt.stop(F.col("t"), lang))).cast("bigint").alias(lang)
            for lang in an.STOP_ONLY_LANGUAGES]
    wide = d.agg(*sums)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(l).alias("analyzer"), F.col(l).alias("n_tokens"))
                                         for l in an.STOP_ONLY_LANGUAGES])).alias("r")).select("r.*")


# ---------------------------------------------------------------------------
# Scans, catalogue, filters.
# ---------------------------------------------------------------------------
from .operators import keys as keyops  # noqa: E402
from .operators import shape, upsert as ups  # noqa: E402
from .sources import tables as tbl  # noqa: E402


@query("read_many_union")
def q_read_many_union(spark, sf_dir):
    """A2: every table whose name starts with 'c', as one tagged union by column name."""
    return tbl.read_many(spark, tbl.catalog(sf_dir), prefix="c")


@query("table_inventory")
def q_table_inventory(spark, sf_dir):
    """A3: every table with its row count, by name."""
    return tbl.table_inventory(spark, tbl.catalog(sf_dir))


@query("unwrap_source")
def q_unwrap_source(spark, sf_dir):
    """A5: hits with metadata and `_source`, unwrapped to the body."""
    return tbl.unwrap_source(tbl.hits(read_table(spark, sf_dir, "documents"), "documents", "doc_id"))


@query("discover_columns")
def q_discover_columns(spark, sf_dir):
    """Keys found in `events.props`, rows holding each, non-null ones."""
    return tbl.discover_columns(read_table(spark, sf_dir, "events"), "props", "event_id")


#: Schemaless texts derived from `events`: nested keys, some in part of the rows, of mixed types; some texts are no objects.
SCHEMALESS = """CASE WHEN event_id % 10 = 0 THEN '[1]' WHEN event_id % 100 = 51 THEN '{broken' ELSE concat('{"p":', props,
 ',"who":{"id":', user_id, ',"kind":"', event_type, '"', CASE event_id % 3 WHEN 0 THEN ',"score":0.5' WHEN 1 THEN ',"score":7' ELSE '' END, '}',
 CASE event_id % 4 WHEN 0 THEN ',"tag":"x"' WHEN 1 THEN ',"tag":5' WHEN 2 THEN ',"flags":[true]' ELSE '' END, '}') END"""


def _schemaless(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("event_id", F.expr(SCHEMALESS).alias("js"))


@query("merged_schema")
def q_merged_schema(spark, sf_dir):
    """The leaves of the one schema that holds all objects, with the kind of their type."""
    schema, _ = tbl.merged_schema(_schemaless(spark, sf_dir), "js")
    kinds = {"bigint": "integer", "string": "text", "boolean": "boolean", "variant": "mixed", "double": "fraction", "decimal": "fraction", "array<boolean>": "list"}
    rows = [(p, kinds[t.split("(")[0]]) for p, t in tbl.schema_rows(schema)]
    return spark.createDataFrame(rows, "path string, kind string")


@query("typed_rows")
def q_typed_rows(spark, sf_dir):
    """Every event with one typed column per key of the merged schema; a missing key is null."""
    out = tbl.typed_rows(_schemaless(spark, sf_dir), "js", ["event_id"])
    return out.select("event_id", F.col("p.k").alias("k"), F.col("who.id").alias("id"), F.col("who.kind").alias("kind"),
                      F.col("who.score").cast("double").alias("score"), F.to_json("tag").alias("tag"), F.to_json("flags").alias("flags"))


@query("prefix_filter")
def q_prefix_filter(spark, sf_dir):
    """Documents whose source starts with 'src1' (pushed to the Parquet scan)."""
    return tbl.prefix_filter(read_table(spark, sf_dir, "documents"), "source", "src1") \
              .select("doc_id", "source")


@query("selection_filter")
def q_selection_filter(spark, sf_dir):
    """Documents named by the selection table `labels` (semi join)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return tbl.selection_filter(d, read_table(spark, sf_dir, "labels"), "doc_id")


@query("geo_point")
def q_geo_point(spark, sf_dir):
    """D3: 'lat,lon' from integer-valued coordinates derived from `customer`."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.col("c_custkey") % 181 - 90).cast("double").alias("lat"),
        ((F.col("c_nationkey") * 7) % 361 - 180).cast("double").alias("lon"))
    return shape.geo_point(c).select("geo_point", "c_custkey")


# ---------------------------------------------------------------------------
# Keyed writes (B1-B5) and keys (K1-K3).
# ---------------------------------------------------------------------------
def _order_updates(spark, sf_dir):
    """A batch of order updates derived from `lineitem`: one candidate row per line."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"),
        # line numbers repeat inside an order: the order value is a struct that is unique
        F.struct("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("_line"))


@query("upsert_orders")
def q_upsert_orders(spark, sf_dir):
    """B1: orders upserted by key with lineitem-derived rows; the last line of an order wins."""
    return ups.upsert(read_table(spark, sf_dir, "orders"), _order_updates(spark, sf_dir),
                      "o_orderkey", "_line", drop_order=["_line"])


@query("bulk_write_separate")
def q_bulk_write_separate(spark, sf_dir):
    """B2: three batches, each into the table of its own name (one exists, two are new)."""
    out = ups.bulk_write(
        {"orders": (_order_updates(spark, sf_dir), "o_orderkey", "_line", ["_line"]),
         "customer": (read_table(spark, sf_dir, "customer"), "c_custkey", "c_custkey"),
         "supplier": (read_table(spark, sf_dir, "supplier"), "s_suppkey", "s_suppkey")},
        existing={"orders": read_table(spark, sf_dir, "orders")})
    shown = {"orders": ("o_orderkey", "o_orderstatus", "o_totalprice"), "customer": ("c_custkey", "c_name", "c_acctbal"),
             "supplier": ("s_suppkey", "s_name", "s_acctbal")}
    parts = [out[name].select(F.lit(name).alias("index"), F.col(k).cast("bigint").alias("_id"), F.col(t).alias("text"),
                              F.col(v).alias("amount")) for name, (k, t, v) in shown.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("bulk_write_merged")
def q_bulk_write_merged(spark, sf_dir):
    """Customer, supplier, part merged into one table on their own keys; later wins."""
    return ups.merge_tables([
        ("customer", read_table(spark, sf_dir, "customer"), "c_custkey", "c_custkey"),
        ("supplier", read_table(spark, sf_dir, "supplier"), "s_suppkey", "s_suppkey"),
        ("part", read_table(spark, sf_dir, "part"), "p_partkey", "p_partkey")], target="merged")


@query("apply_mapping")
def q_apply_mapping(spark, sf_dir):
    """`events` as text, mapping inferred from the values, applied with try_cast."""
    ev = shape.stringify(read_table(spark, sf_dir, "events"))
    return ups.apply_mapping(ev, shape.infer_mappings(ev))


#: Texts derived from `events` that an explicit mapping keeps in part.
MISFITS = {
    "user_id": ("integer", "CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN concat(user_id, '.5') "
                           "WHEN 2 THEN concat(user_id, '00000000000000000000') ELSE concat(user_id, '') END"),
    "amount": ("float", "CASE event_id % 4 WHEN 0 THEN concat(event_id, '.12345678901234567') WHEN 1 THEN '1e999' ELSE concat(event_id, '.5') END"),
    "day": ("date", "CASE event_id % 3 WHEN 0 THEN '2024-99-99' WHEN 1 THEN props ELSE '2024-01-31' END"),
    "place": ("geo_point", "CASE event_id % 6 WHEN 0 THEN '999.5,999.5' WHEN 1 THEN 'nowhere' WHEN 2 THEN NULL ELSE '1.5,2' END"),
    "price": ("decimal(5,2)", "CASE event_id % 7 WHEN 0 THEN '12.345' WHEN 1 THEN '123456789' ELSE '12.30' END"),
}


def _split_misfits(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", *[F.expr(e).alias(c) for c, (_, e) in MISFITS.items()])
    return ups.split_by_mapping(ev, {c: t for c, (t, _) in MISFITS.items()}, ["event_id"])


@query("mapping_accepted")
def q_mapping_accepted(spark, sf_dir):
    """Rows derived from `events` whose every value an explicit mapping keeps."""
    accepted, _, _ = _split_misfits(spark, sf_dir)
    return accepted.withColumn("price", F.col("price").cast("double"))


@query("mapping_rejects")
def q_mapping_rejects(spark, sf_dir):
    """The dead-letter table of the same write: one row per refused value, with the reason."""
    _, rejects, _ = _split_misfits(spark, sf_dir)
    return rejects


@query("keyword_subfield")
def q_keyword_subfield(spark, sf_dir):
    """`text.keyword` kept only for texts of at most 256 characters."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ups.keyword_subfield(d, "text").select("doc_id", "`text.keyword`")


@query("key_profile")
def q_key_profile(spark, sf_dir):
    """K1: the common columns of `documents` and `labels`, judged as keys."""
    return keyops.key_profile({"documents": read_table(spark, sf_dir, "documents"),
                               "labels": read_table(spark, sf_dir, "labels")})


@query("add_key")
def q_add_key(spark, sf_dir):
    """K2: one key 0.. over supplier then customer, each in key order."""
    s, c = keyops.add_key([read_table(spark, sf_dir, "supplier"), read_table(spark, sf_dir, "customer")],
                          [["s_suppkey"], ["c_custkey"]], name="_key")
    return (s.select(F.lit("supplier").alias("_table"), F.col("s_suppkey").alias("id"), "_key")
             .unionByName(c.select(F.lit("customer").alias("_table"), F.col("c_custkey").alias("id"), "_key")))


@query("add_key_offset")
def q_add_key_offset(spark, sf_dir):
    """K3: keys from 100 over orders by (o_orderdate, o_orderkey)."""
    (o,) = keyops.add_key([read_table(spark, sf_dir, "orders")], [["o_orderdate", "o_orderkey"]],
                          name="_key", offset="100")
    return o


# ---------------------------------------------------------------------------
# Schema shaping.
# ---------------------------------------------------------------------------
def _nested_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id",
                     F.struct("user_id", F.struct("event_type", "value").alias("detail")).alias("who"),
                     F.from_json("props", "k bigint").alias("props"))


@query("flatten_struct")
def q_flatten_struct(spark, sf_dir):
    """Nested event records flattened to dotted columns."""
    return shape.flatten_struct(_nested_events(spark, sf_dir))


@query("flatten_json_rows")
def q_flatten_json_rows(spark, sf_dir):
    """One (event_id, key, value) row per leaf of `events.props`."""
    return shape.flatten_json_rows(read_table(spark, sf_dir, "events"), "props", ["event_id"])


@query("nest_columns")
def q_nest_columns(spark, sf_dir):
    """Flattened columns nested back into structs; each struct is shown as JSON."""
    nested = shape.nest_columns(shape.flatten_struct(_nested_events(spark, sf_dir)), keep=["event_id"])
    return nested.select("event_id", *[F.to_json(c, {"ignoreNullFields": "false"}).alias(c) for c in ("who", "props")])


@query("nest_to_json")
def q_nest_to_json(spark, sf_dir):
    """Inferred mapping rows of `events` -> nested JSON -> leaves read back."""
    m = shape.infer_mappings(shape.stringify(read_table(spark, sf_dir, "events")))
    js = shape.dot_expand(m.withColumn("_t", F.lit("events")), group_cols=["_t"])
    return shape.flatten_json_rows(js, "mapping_json", ["_t"]).select("key", "value")


@query("infer_mappings")
def q_infer_mappings(spark, sf_dir):
    """E5: mapping rows for `events` seen as text, types inferred from values."""
    return shape.infer_mappings(shape.stringify(read_table(spark, sf_dir, "events")))


@query("infer_types")
def q_infer_types(spark, sf_dir):
    """Kinds of the columns of `lineitem` seen as text."""
    return shape.infer_types(shape.stringify(spread(read_table(spark, sf_dir, "lineitem"))))


#: Texts derived from `lineitem`, a column for each step of the type lattice.
LATTICE = {
    "whole": "concat(l_partkey, '')", "long": "concat('9007199254', l_orderkey + 1000000)",
    "fraction": "concat(l_linenumber, '.', l_suppkey)", "exact": "concat(l_linenumber, '.0123456789012345', l_suppkey)",
    "long_or_fraction": "CASE WHEN l_linenumber = 1 THEN '0.5' ELSE concat('9007199254', l_orderkey + 1000000) END",
    "expo": "concat(l_linenumber, '.5e', l_suppkey % 100)", "huge": "concat('1e', 300 + l_linenumber * 10)",
    "big": "concat(l_orderkey, '00000000000000000001')", "too_big": "concat(l_orderkey, repeat('7', 39))",
    "exact_or_expo": "CASE WHEN l_linenumber = 1 THEN '1e5' ELSE concat('0.', repeat('3', 20)) END",
    "day": "concat(2000 + l_linenumber, '-0', l_linenumber, '-28 10:0', l_linenumber)", "bad_day": "concat('2023-0', l_linenumber, '-30')",
    "point": "concat(l_linenumber, '.5,', l_suppkey % 180)", "off_point": "concat(l_suppkey % 91, ',200')",
    "flag": "CASE WHEN l_returnflag <> 'A' THEN l_returnflag END", "nothing": "CASE WHEN l_linenumber > 100 THEN 'x' END",
    "mixed": "CASE WHEN l_linenumber = 1 THEN 'x' ELSE '5' END",
}


@query("infer_exact_types")
def q_infer_exact_types(spark, sf_dir):
    """Kinds of texts derived from `lineitem` that only some types keep."""
    return shape.infer_types(spread(read_table(spark, sf_dir, "lineitem")).select(*[F.expr(e).alias(c) for c, e in LATTICE.items()]))


@query("table_mappings")
def q_table_mappings(spark, sf_dir):
    """Mapping rows of customer, supplier and part (as text), tagged by table."""
    return shape.table_mappings({n: shape.stringify(read_table(spark, sf_dir, n))
                                 for n in ("customer", "supplier", "part")})


@query("field_stats")
def q_field_stats(spark, sf_dir):
    """Per column of `lineitem`: non-nulls, exact distinct values, longest text."""
    return shape.field_stats(read_table(spark, sf_dir, "lineitem"))


#: Columns of the sketched tables, by their name without the table's prefix (custkey and orderkey are in two).
SKETCHED = {"customer": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
            "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
            "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")}
#: What a merged estimate may be off: over five standard deviations of a sketch.
SKETCH_ERROR = 0.05


@query("field_sketches")
def q_field_sketches(spark, sf_dir):
    """Sketches of three tables, stored, then merged without a rescan; the distinct estimate held against the exact count."""
    from .operators import sketches as sk
    from .operators.ranking import save_shared
    tables = [read_table(spark, sf_dir, t).select(*[F.col(c).alias(c[2:]) for c in columns]) for t, columns in SKETCHED.items()]
    merged = sk.read_fields(sk.merge_fields(*[save_shared(sk.sketch_fields(t), "sketch") for t in tables]))
    values = [t.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
                                           for c in t.columns])).alias("p")).select("p.*") for t in tables]
    exact = values[0].unionByName(values[1]).unionByName(values[2]).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    exact = exact.groupBy("column").agg(F.count("v").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), F.lit(SKETCH_ERROR) * F.col("exact"))
    return merged.join(exact, "column").select("column", "n_rows", "n_nonnull", "max_len", F.col("exact").alias("n_distinct"),
                                               off.alias("within_bound"))


# ---------------------------------------------------------------------------
# Repeated keyed load as a stream.
# ---------------------------------------------------------------------------
@query("stream_upsert_events")
def q_stream_upsert_events(spark, sf_dir):
    """`events` streamed into a table keyed by user_id; per user the latest
    event by (ts, event_id) wins whatever micro-batch it arrives in."""
    import os
    import uuid

    from .session import checkpoint_dir
    from .streaming import incremental as inc
    name = f"stream_upsert_events_{uuid.uuid4().hex}"
    run = os.path.join(checkpoint_dir(spark), name)
    schema = read_table(spark, sf_dir, "events").schema
    inc.stream_upsert(spark, os.path.join(sf_dir, "events*.parquet"), schema, name, "user_id",
                      ["ts", "event_id"], os.path.join(run, "table"), checkpoint=os.path.join(run, "stream"))
    return inc.read_upserted(spark, name)


@query("tok_ngram")
def q_tok_ngram(spark, sf_dir):
    """Counts of the 1..2-grams of whole texts (position-major tokenizer ``tok.ngram``)."""
    d = docs(spark, sf_dir, "lang", "text")
    return jobs.ngram_counts(d, F.col("text"), ["lang"])


@query("f_shingle")
def q_f_shingle(spark, sf_dir):
    """counts of unigrams and 2-token shingles (the multiset ``flt.shingle`` emits)."""
    return jobs.shingle_counts(docs(spark, sf_dir, "lang", "text"), std_lower(), ["lang"])


@query("stream_analyze_documents")
def q_stream_analyze_documents(spark, sf_dir):
    """T2 on a stream: `documents` read as a file stream, analysed (standard), written to a sink."""
    import os
    import uuid

    from .session import checkpoint_dir
    from .streaming import incremental as inc
    run = os.path.join(checkpoint_dir(spark), f"stream_analyze-{uuid.uuid4().hex}")
    schema = read_table(spark, sf_dir, "documents").schema
    inc.stream_analyze(spark, os.path.join(sf_dir, "documents*.parquet"), schema, os.path.join(run, "out"),
                       "doc_id", "text", "standard", checkpoint=os.path.join(run, "stream"))
    return spark.read.parquet(os.path.join(run, "out"))
