"""Edit-aware token counts: a segment tree over each document's pre-tokens.

A byte-pair tokenizer first cuts a text into pre-tokens by a pattern and merges
only inside them, so the tokens of a text are the sum over its pre-tokens. ``build``
counts every document once and keeps its tree: the leaves are runs of
``LEAF`` pre-tokens with their characters and tokens, and each inner node holds the
sum of its two children, so any stretch of a document is counted from a few nodes.

``recount`` applies edits (start, end, replacement) to documents with a tree. An
edit can only change pre-tokens from the last boundary that the pattern found
without looking at an edited character, and only until the new text's boundaries
meet an old one behind the edit: from there on the same text is cut in the same way.
Only that region is cut and counted again; its leaves and the nodes above them are
updated, and the root is the new count.

Trees are columns of a DataFrame, so they can be written and edited again later.
Documents are independent of each other: no shuffle anywhere, and a lost task is
simply run again.

Defined cases: a null text is empty and has 0 tokens; edits are clipped to the text,
applied in order of their start, and one that overlaps an earlier one is ignored;
null edits, and edits without a replacement, delete; repeated rows are counted one by
one; other columns pass.
"""

from __future__ import annotations

import base64
import bisect

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, let, table, text_of
from .pii import _running

#: Rank file of a public byte-level BPE, on every executor; a parameter of every function here.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that cuts a text before the merges of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens of a leaf, and different pre-tokens whose counts a task remembers.
LEAF, REMEMBERED = 64, 500_000
#: Characters in front of an edit that the end of an unaffected pre-token may not reach: the
#: pattern looks one character beyond a match, and a run of blanks gives one back.
LOOK = 2

TREE = T.StructType([T.StructField("chars", T.ArrayType(T.IntegerType())), T.StructField("sums", T.ArrayType(T.IntegerType()))])
EDITS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("replacement", T.StringType())]))

class Counter:
    """Token counts of pre-tokens, remembered."""

    def __init__(self, ranks: str):
        import tiktoken
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        self.cut, self.known = regex.compile(PATTERN), {}

    def __call__(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            n = self.known[piece] = len(self.bpe.encode_ordinary(piece))
        return n


def counter(ranks: str) -> Counter:
    """The counter of a rank file, made once per Python worker."""
    import sys
    made = sys.modules.setdefault("_pretoken_counters", type(sys)("_pretoken_counters")).__dict__
    if ranks not in made:
        made[ranks] = Counter(ranks)
    return made[ranks]


def tree_of(leaves: list[int]) -> list[int]:
    """A segment tree as an array: the children of node i are 2 i and 2 i + 1, the leaves are the second half."""
    n = len(leaves)
    sums = [0] * n + leaves
    for i in range(n - 1, 0, -1):
        sums[i] = sums[2 * i] + sums[2 * i + 1]
    return sums


def set_leaf(sums: list[int], leaf: int, value: int) -> None:
    """Change a leaf and the sums above it."""
    i = len(sums) // 2 + leaf
    sums[i], i = value, i // 2
    while i:
        sums[i] = sums[2 * i] + sums[2 * i + 1]
        i //= 2


def root(sums: list[int]) -> int:
    return sums[1] if len(sums) > 1 else 0


def build_tree(text: str, count: Counter) -> tuple[list[int], list[int]]:
    """(characters of each leaf, segment tree of the leaves' tokens)."""
    pieces = count.cut.findall(text)
    known, chars, tokens = count.known, [], []
    for i in range(0, len(pieces), LEAF):
        part = pieces[i:i + LEAF]
        chars.append(sum(map(len, part)))
        tokens.append(sum([known.get(p) or count(p) for p in part]))
    return chars, tree_of(tokens)


def normal_edits(edits: list | None, length: int) -> list[tuple[int, int, str]]:
    """Edits clipped to a text of ``length`` characters, by start, without those that overlap an earlier one."""
    out, end = [], 0
    for start, stop, new in sorted((max(0, min(e["start"] or 0, length)), max(0, min(e["end"] or 0, length)), e["replacement"] or "")
                                   for e in edits or () if e is not None):
        stop = max(start, stop)
        if start >= end and (stop > start or new):
            out.append((start, stop, new))
            end = stop
    return out


def apply_edits(text: str, edits: list[tuple[int, int, str]]) -> str:
    out, end = [], 0
    for start, stop, new in edits:
        out += [text[end:start], new]
        end = stop
    return "".join(out) + text[end:]


def edit_tree(text: str, chars: list[int], sums: list[int], edits: list[tuple[int, int, str]],
              count: Counter) -> tuple[str, list[int], list[int], int]:
    """(new text, characters, tree, characters that were cut again) after normal edits."""
    new_text = apply_edits(text, edits)
    if not edits:
        return text, chars, sums, 0
    if not chars:                                       # nothing known to start from
        chars, sums = build_tree(new_text, count)
        return new_text, chars, sums, len(new_text)
    chars, sums = list(chars), list(sums)
    ends, at = [], 0                                    # old ends of the leaves
    for c in chars:
        at += c
        ends.append(at)
    redone, k, shift = 0, 0, 0                          # shift: new minus old position left of edit k
    while k < len(edits):
        # the first leaf that may change: the first whose end is not clear of the edit
        first = min(bisect.bisect_right(ends, edits[k][0] - LOOK), len(ends) - 1)
        begin = ends[first - 1] if first else 0
        pos, tokens, last, here = begin + shift, 0, first, k
        after = shift                                   # shift right of the edits taken in so far
        while True:
            # take in every edit whose region starts before the leaf in question ends
            while here < len(edits) and edits[here][0] - LOOK < ends[last]:
                after += len(edits[here][2]) - (edits[here][1] - edits[here][0])
                here += 1
            behind = max(edits[here - 1][1], ends[last - 1] if last else 0)
            while last < len(ends) - 1 and ends[last] < behind:
                last += 1
            if here < len(edits) and edits[here][0] - LOOK < ends[last]:
                continue
            target = ends[last] + after                 # where an old boundary stands in the new text
            while pos < target:
                m = count.cut.match(new_text, pos)
                tokens, pos = tokens + count(m.group()), m.end()
            if pos == target and ends[last] >= edits[here - 1][1] or last == len(ends) - 1 and pos >= len(new_text):
                break
            last += 1                                   # the boundaries have not met yet: go on into the next leaf
        start = begin + shift
        chars[first] = pos - start
        set_leaf(sums, first, tokens)
        for leaf in range(first + 1, last + 1):         # its neighbours are part of it now
            chars[leaf] = 0
            set_leaf(sums, leaf, 0)
        redone += pos - start
        k, shift = here, after
    return new_text, chars, sums, redone


def build(docs: DataFrame, text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """``docs`` plus (tree, n_tokens)."""
    tree, n = fresh(docs, "tree", "n_tokens")
    schema = T.StructType([*docs.schema.fields, T.StructField(tree, TREE), T.StructField(n, T.LongType())])

    def run(batches):
        count = counter(ranks)
        for batch in batches:
            made = [build_tree(t or "", count) for t in batch.column(batch.schema.names.index(text_col)).to_pylist()]
            trees = pa.array([{"chars": c, "sums": s} for c, s in made], pa.struct([("chars", pa.list_(pa.int32())), ("sums", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([*batch.columns, trees, pa.array([root(s) for _, s in made], pa.int64())], names=schema.names)
    return docs.mapInArrow(run, schema)


def recount(docs: DataFrame, text_col: str = "text", tree_col: str = "tree", edits_col: str = "edits", ranks: str = RANKS) -> DataFrame:
    """``docs`` with the edits applied to text and tree, plus (n_edits, n_tokens_after, n_chars_recounted)."""
    n_edits, n_after, n_again = fresh(docs, "n_edits", "n_tokens_after", "n_chars_recounted")
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in (n_edits, n_after, n_again)]])

    def run(batches):
        count = counter(ranks)
        for batch in batches:
            names = batch.schema.names
            at = {c: names.index(c) for c in (text_col, tree_col, edits_col)}
            texts, trees, counts, numbers, again = [], [], [], [], []
            for text, tree, edits in zip(*[batch.column(at[c]).to_pylist() for c in (text_col, tree_col, edits_col)]):
                normal = normal_edits(edits, len(text or ""))
                new, chars, sums, redone = edit_tree(text or "", (tree or {}).get("chars") or [], (tree or {}).get("sums") or [], normal, count)
                texts.append(new if normal else text)
                trees.append({"chars": chars, "sums": sums})
                counts.append(len(normal))
                numbers.append(root(sums))
                again.append(redone)
            columns = list(batch.columns)
            columns[at[text_col]] = pa.array(texts, columns[at[text_col]].type)
            columns[at[tree_col]] = pa.array(trees, columns[at[tree_col]].type)
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(c, pa.int64()) for c in (counts, numbers, again)]], names=schema.names)
    return docs.mapInArrow(run, schema)


def redaction_edits(text: Column) -> Column:
    """Edits that a later cleaning step makes: every e-mail address, IP address and run of ten or more digits or
    separators becomes a mark. Positions come from the pieces between the matches."""
    pattern = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]++|(?<![0-9])[0-9]++(?:\.[0-9]++){3}|(?<![0-9])[0-9](?:[ ().-]?[0-9]){9,}+"

    def placed(found):
        def with_pieces(pieces):
            lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, f: F.length(p) + F.length(f))
            return let(lengths, lambda ls: _running(ls, F.lit(0), lambda a, b: a + b, lambda before: F.transform(
                found, lambda f, i: let(before(i) + F.length(F.get(pieces, i)), lambda start: F.struct(
                    start.alias("start"), (start + F.length(f)).alias("end"), F.lit("<PRIVATE>").alias("replacement"))))))
        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), with_pieces))
    return F.coalesce(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed), F.array().cast(EDITS)).cast(EDITS)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after the redaction of contact data, recounted where it touched them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of("text").alias("text"))
    counted = build(docs).withColumn("edits", redaction_edits(F.col("text")))
    return recount(counted).select("doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars_recounted",
                                   F.length("text").cast("bigint").alias("n_chars_after"))
