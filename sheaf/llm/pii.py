"""Information-theoretic sanitisation, in DataFrame operations only.

Base. E-mail addresses, IP addresses, payment cards and phone numbers are found
by their patterns and checks; they are the protected entities.

Method. What a term reveals about an entity e is measured by pointwise mutual
information over the corpus: PMI(e; t) = log2 p(e, t) / (p(e) p(t)), where e and
t occur together if t stands within ``CONTEXT`` characters of e. A term that
appears nowhere else reveals e completely: PMI(e; t) = IC(e) = -log2 p(e). What
remains unknown is IC(e) - PMI(e; t) = log2 n(t) / n(e, t) bits, with n(t) the
occurrences of t in all documents and n(e, t) those near e. A term whose rest is
at most ``MAX_BITS`` discloses e, once the pair was seen in ``MIN_TEXTS``
different texts (an estimate from fewer is no estimate). A disclosing term is
generalised to its class, the words with the same first ``CLASS_LETTERS``
letters, if the class itself leaves more than ``MAX_BITS`` open and is shorter than
the term, and removed otherwise; where entities differ in that, it is removed. Every
occurrence of a disclosing term goes, near an entity or not, in every document.

A term is a run of letters, marks and digits of any length, also across single
hyphens and apostrophes. Base entities are read as blanks: their parts are no terms.

All counts cover all documents. Terms are counted with partial aggregation, so
frequent ones cost one row per task; only (entity, term) pairs with enough
support are looked up in them. The disclosing terms, few against the vocabulary, are
broadcast to all occurrences if they are within ``BROADCAST_TERMS``. Windows and
spans of exact copies are kept once per text.

Positions come from splitting a text at a pattern and adding up lengths, in
blocks, so that a text with very many matches stays cheap.

Defined cases: a null text is empty; texts of any length are read whole; repeated
rows count as often as they occur; other columns, whatever their names, pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, broadcast_within, fresh, let, save_shared, table, text_of

#: Kinds of spans in the order that breaks ties; the last two come from the method.
KINDS = ("email", "ip", "card", "phone", "term", "broad")
#: The base patterns. They accept what the plain patterns
#:   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+        [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#:   [0-9]([\x20-]?[0-9])+                                    \+[0-9][\x20().0-9-]+[0-9]
#: accept; possessive repeats and the look-behinds only keep long runs from being tried again
#: from each of their characters (a later start in a run fails like the first one).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Characters on either side of an entity in which terms count as its context.
CONTEXT = 100
#: A term discloses an entity if at most so many bits remain, seen in so many different texts.
MAX_BITS, MIN_TEXTS = 2.0, 3
#: Letters that the words of a class share.
CLASS_LETTERS = 3

_BLOCK = 256
#: Characters of the pieces that contexts are cut from.
_CUT = 1024
#: A term.
_TERM = r"[\p{L}\p{M}\p{N}]++(?:['\u2019\u2010\u2011-][\p{L}\p{M}\p{N}]++)*+"
#: Beyond ``CONTEXT``, so many characters show whether a term goes on there.
_MORE = 2
#: Up to so many disclosing terms are broadcast; beyond, they are joined by shuffle.
BROADCAST_TERMS = 200_000


def _running(values: Column, zero: Column, op: Callable[[Column, Column], Column],
             fn: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``fn(before)``, where ``before(i)`` folds the first i of ``values``; in blocks, so a long array costs
    about ``_BLOCK`` steps per element, not as many as it has elements."""
    n_blocks = F.ceil(F.size(values) / F.lit(_BLOCK)).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.greatest(n_blocks, F.lit(1)) - 1),
                       lambda b: F.aggregate(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)), zero, op))

    def heads(blocks: Column) -> Column:
        head = F.transform(blocks, lambda _, b: F.aggregate(F.slice(blocks, F.lit(1), b), zero, op))
        return let(head, lambda h: fn(lambda i: F.aggregate(
            F.slice(values, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK),
            F.get(h, F.floor(i / _BLOCK).cast("int")), op)))
    return let(each, heads)


def _luhn(digits: Column) -> Column:
    def weighted(total, i):
        d = F.substring(digits, -i, F.lit(1)).cast("int") * (2 - i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), weighted) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    return {"email": F.lit(True),
            "ip": found.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"),
            "card": F.when(n.between(12, 19), let(digits, _luhn)).otherwise(False),
            "phone": n.between(9, 15)}[kind]


def _entity(kind: str, found: Column) -> Column:
    value = F.lower(found) if kind == "email" else found if kind == "ip" else F.regexp_replace(found, "[^0-9]", "")
    return F.concat(F.lit(f"{kind}:"), value)


_FOUND = "array<struct<start:int,kind:int,end:int,entity:string>>"


def _of_kind(text: Column, kind: str) -> Column:
    pattern = PATTERNS[kind]

    def spans(found: Column) -> Column:
        def placed(pieces: Column) -> Column:
            lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, f: F.length(p) + F.length(f))

            def at(before):
                every = F.transform(found, lambda f, i: let(
                    before(i) + F.length(F.get(pieces, i)), lambda start: F.struct(
                        start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                        (start + F.length(f)).alias("end"), F.when(_valid(kind, f), _entity(kind, f)).alias("entity"))))
                return F.filter(every, lambda s: s["entity"].isNotNull())
            return let(lengths, lambda ls: _running(ls, F.lit(0), lambda a, b: a + b, at))
        return F.when(F.exists(found, lambda f: _valid(kind, f)), let(F.split(text, pattern, -1), placed))
    may = text.contains("@") if kind == "email" else text.contains("+") if kind == "phone" else text.rlike("[0-9]")
    none = F.array().cast(_FOUND)
    return F.coalesce(F.when(may, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)).cast(_FOUND), none)


def _with_contexts(text: Column, spans: Column) -> Column:
    """``spans`` with the text on either side, ``_MORE`` characters longer than ``CONTEXT`` where the text goes on."""
    def add(blocks: Column) -> Column:
        def cut(begin: Column, end: Column) -> Column:
            b = F.floor(begin / _CUT).cast("int")
            return F.substring(F.concat(F.get(blocks, b), F.coalesce(F.get(blocks, b + 1), F.lit(""))), begin % _CUT + 1, end - begin)
        left = lambda s: cut(F.greatest(s["start"] - (CONTEXT + _MORE), F.lit(0)), s["start"])
        right = lambda s: F.coalesce(cut(s["end"], s["end"] + CONTEXT + _MORE), F.lit(""))
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["entity"].alias("entity"),
            left(s).alias("left"), right(s).alias("right")))
    # in pieces of equal length, so that a context costs the same wherever it stands in a long text
    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CUT}}}"), F.lit(0)), add)


def _base(text: Column) -> Column:
    return F.array_sort(F.concat(*[_of_kind(text, k) for k in PATTERNS]))


def _marked(texts: DataFrame) -> DataFrame:
    """``texts`` (text) plus (base, blank): base findings by start and kind, and the text with as many blanks in their place.

    In steps, as the analyser passes over an expression once per level of nested lambdas, 100 times at most.
    """
    marked = texts.withColumn("base", _base(F.col("text")))
    return marked.withColumn("blank", F.when(F.size("base") > 0, _blanked(F.col("text"), F.col("base"))).otherwise(F.col("text")))


def _terms(text: Column) -> Column:
    """Lower-case terms of a whole text."""
    return F.transform(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), F.lower)


def _placed_terms(text: Column, origin: Column | int = 0) -> Column:
    """(term, start, end) of the terms of a text that starts at ``origin``."""
    def terms(found: Column) -> Column:
        def placed(pieces: Column) -> Column:
            lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, f: F.length(p) + F.length(f))
            return let(lengths, lambda ls: _ends(ls, lambda end: F.transform(found, lambda f, i: let(
                end(i) + origin, lambda e: F.struct(F.lower(f).alias("term"), (e - F.length(f)).alias("start"), e.alias("end"))))))
        return let(F.split(text, _TERM, -1), placed)
    return let(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), terms)


def _ends(lengths: Column, fn: Callable[[Callable[[Column], Column]], Column], width: int = 32) -> Column:
    """``fn(end)``, where ``end(i)`` sums the first i + 1 of ``lengths``; blocks of blocks, about ``width`` steps per element."""
    add = lambda a, b: a + b
    total = lambda values: F.aggregate(values, F.lit(0), add)

    def sums(values: Column) -> Column:
        n = F.greatest(F.ceil(F.size(values) / F.lit(width)).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), n - 1), lambda b: total(F.slice(values, b * width + 1, F.lit(width))))

    def heads(large: Column) -> Column:
        return F.transform(large, lambda _, b: total(F.slice(large, F.lit(1), b)))

    def by_block(blocks: Column) -> Column:
        def starts(head: Column) -> Column:
            at = lambda i: F.floor(i / width).cast("int")
            start = F.transform(blocks, lambda _, b: F.get(head, at(b)) + total(F.slice(blocks, at(b) * width + 1, b % width)))
            return let(start, lambda st: fn(lambda i: F.get(st, at(i)) + total(F.slice(lengths, at(i) * width + 1, i % width + 1))))
        return let(let(sums(blocks), heads), starts)
    return let(sums(lengths), by_block)


def find(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` without its text, plus ``entities`` (base findings with the contexts on either side) and ``text_key``."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    none = F.array().cast("array<struct<start:int,kind:int,end:int,entity:string,left:string,right:string>>")
    marked = _marked(df.select(*([F.struct(*kept).alias("row")] if kept else []), text_of(F.col(f"`{text_col}`")).alias("text")))
    return marked.select(*(["row.*"] if kept else []),
                         F.coalesce(F.when(F.size("base") > 0, _with_contexts(F.col("blank"), F.col("base"))), none).alias("entities"),
                         F.unhex(F.md5("text")).alias("text_key"))


def disclosing_terms(found: DataFrame, texts: DataFrame, scratch: Scratch, max_bits: float = MAX_BITS,
                     min_texts: int = MIN_TEXTS) -> tuple[DataFrame, DataFrame]:
    """Windows (text_key, entity, term, start, end) and disclosing pairs (entity, term, n, total, bits, kind).

    ``found`` is the result of ``find``, ``texts`` a table with the one column
    ``text`` of all documents. Windows hold the terms that lie wholly within ``CONTEXT``.
    """
    some = (found.filter(F.size("entities") > 0).groupBy("text_key")
                 .agg(F.first("entities").alias("entities"), F.count(F.lit(1)).alias("copies")))
    around = F.filter(F.concat(
        _placed_terms(F.col("e.left"), F.col("e.start") - F.length("e.left")), _placed_terms(F.col("e.right"), F.col("e.end"))),
        lambda t: (t["start"] >= F.col("e.start") - CONTEXT) & (t["end"] <= F.col("e.end") + CONTEXT))
    windows = scratch.save(
        some.select("text_key", "copies", F.explode("entities").alias("e"))
            .select("text_key", "copies", F.col("e.entity").alias("entity"), F.explode(around).alias("t"))
            .select("text_key", "copies", "entity", "t.term", "t.start", "t.end").distinct(), "windows")
    pairs = windows.groupBy("entity", "term", "text_key").agg(F.sum("copies").alias("n"))
    pairs = scratch.save(pairs.groupBy("entity", "term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
                             .withColumn("class", F.substring("term", 1, CLASS_LETTERS)), "pairs")
    totals = (_marked(texts).select(F.explode(_terms(F.col("blank"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("total"))
                   .withColumn("class", F.substring("term", 1, CLASS_LETTERS)))
    totals = scratch.save(totals, "totals")
    bits = lambda total, n: F.log2(F.col(total) / F.col(n))
    told = (pairs.filter(F.col("texts") >= min_texts).join(totals.drop("class"), "term")
                 .withColumn("bits", bits("total", "n")).filter(F.col("bits") <= max_bits))
    class_pairs = pairs.groupBy("entity", "class").agg(F.sum("n").alias("class_n"))
    class_totals = totals.groupBy("class").agg(F.sum("total").alias("class_total"))
    told = (told.join(class_pairs, ["entity", "class"]).join(class_totals, "class")
                .withColumn("kind", F.when((bits("class_total", "class_n") > max_bits) & (F.length("term") > CLASS_LETTERS), F.lit(KINDS.index("broad")))
                                     .otherwise(F.lit(KINDS.index("term")))))
    return windows, told.select("entity", "term", "n", "total", "bits", "kind")


def spans_of(found: DataFrame, texts: DataFrame, scratch: Scratch, max_bits: float = MAX_BITS,
             min_texts: int = MIN_TEXTS) -> DataFrame:
    """(text_key, all_spans) of the distinct texts that hold an entity or a disclosing term.

    ``all_spans``: base spans and those of all occurrences of disclosing terms, as (start, kind, end).
    """
    _, told = disclosing_terms(found, texts, scratch, max_bits, min_texts)
    # "term", removed, is the smaller kind and goes before "broad"
    told = scratch.save(told.groupBy("term").agg(F.min("kind").alias("kind")), "told")
    placed = (_marked(texts).select(F.unhex(F.md5("text")).alias("text_key"), F.explode(_placed_terms(F.col("blank"))).alias("t"))
                   .select("text_key", "t.term", "t.start", "t.end"))
    more = (placed.join(broadcast_within(told, BROADCAST_TERMS), "term")
                  .groupBy("text_key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more")))
    base = F.transform("entities", lambda e: F.struct(e["start"], e["kind"], e["end"]))
    some = found.filter(F.size("entities") > 0).groupBy("text_key").agg(F.first("entities").alias("entities"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return some.join(more, "text_key", "full").select(
        "text_key", F.array_sort(F.concat(F.coalesce(base, none), F.coalesce("more", none))).alias("all_spans"))


def with_spans(docs: DataFrame, text_col: str = "text", max_bits: float = MAX_BITS, min_texts: int = MIN_TEXTS) -> DataFrame:
    """``docs`` without the text, plus (entities, text_key, all_spans)."""
    found = save_shared(find(docs, text_col), "entities")
    with Scratch(docs.sparkSession) as scratch:
        spans = save_shared(spans_of(found, docs.select(text_of(text_col).alias("text")), scratch, max_bits, min_texts), "spans")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return found.join(spans, "text_key", "left").withColumn("all_spans", F.coalesce("all_spans", none))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _replaced(text: Column, spans: Column, label: Callable[[Column, Column], Column]) -> Column:
    """The text with ``label(span, end)`` for every span that ends after ``end``, where the spans before it ended."""
    def build(before):
        def piece(s: Column, i: Column) -> Column:
            return let(before(i), lambda end: F.concat(
                F.when(s["start"] > end, F.substring(text, end + 1, s["start"] - end)).otherwise(""), label(s, end)))
        tail = let(before(F.size(spans)), lambda end: F.substring(text, end + 1, F.length(text)))
        return F.concat(F.array_join(F.transform(spans, piece), ""), tail)
    ends = F.transform(spans, lambda s: s["end"])
    return F.when(F.size(spans) > 0, let(ends, lambda e: _running(e, F.lit(0), lambda a, b: F.greatest(a, b), build))).otherwise(text)


def _blanked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by as many blanks."""
    return _replaced(text, spans, lambda s, end: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], end), F.lit(0))))


def _redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced; spans that overlap are replaced together, as the first of them."""
    labels = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def label(s: Column, end: Column) -> Column:
        broad = F.concat(F.substring(text, s["start"] + 1, F.lit(CLASS_LETTERS)), F.lit("*"))
        return F.when(s["start"] >= end, F.when(s["kind"] == KINDS.index("broad"), broad).otherwise(F.get(labels, s["kind"]))).otherwise("")
    return _replaced(text, spans, label)


def sanitise(docs: DataFrame, text_col: str = "text", max_bits: float = MAX_BITS, min_texts: int = MIN_TEXTS) -> DataFrame:
    """``docs`` with entities replaced by their kind and disclosing terms generalised or removed.

    A document without either keeps its text (also a null one) unchanged.
    """
    key, spans = fresh(docs, "__text_key", "__spans")
    plain = docs.select(text_of(F.col(f"`{text_col}`")).alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        found = scratch.save(find(plain), "entities")
        known = save_shared(spans_of(found, plain, scratch, max_bits, min_texts), "spans")
    known = known.select(F.col("text_key").alias(key), F.col("all_spans").alias(spans))
    text = F.col(f"`{text_col}`")
    joined = docs.withColumn(key, F.unhex(F.md5(text))).join(known, key, "left")
    done = joined.withColumn(text_col, F.when(F.col(spans).isNotNull(), _redacted(text, F.col(spans))).otherwise(text))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = with_spans(docs)
    count = lambda k: F.size(F.filter("entities", lambda e: e["kind"] == KINDS.index(k))).cast("bigint")
    return done.select("doc_id", *[count(k).alias(f"n_{k}") for k in PATTERNS],
                       F.sha2(_listed(F.col("entities")), 256).alias("base_sha256"),
                       _listed(F.col("all_spans")).alias("spans"))
