"""Runs of repeated words, found on a grammar of the texts.

The word ids of many texts stand in one array and are compressed by Re-Pair: in
each round every pair of neighbouring symbols that is more frequent than the
pairs it overlaps becomes a nonterminal, until no pair repeats; what is left of
each text is then paired up as a balanced tree. A run of words with period ``q``
either lies inside one symbol of the derivation tree or crosses the boundary of
exactly one smallest node that holds all of it. So the runs that cross the
boundary of a nonterminal are computed *once* per nonterminal, on its first
place in the texts, and are copied to all places that derive it (the places at
which the rounds have put it); nested intervals of one period are then merged.

At a boundary, a run of four periods or more has two of them on one side. Its
period is therefore the distance to an equal pair of words on that side, and two
adjacent equal blocks end or begin at the boundary; both are looked up, and the
extents follow from prefix hashes by binary search. Every run is compared word
by word at last, so hashes decide nothing alone.

The work is one projection: no shuffle, no group. A task holds the words of
``BLOCK_WORDS`` words, or of one longer text.

Defined cases: a null or blank text has no words and no runs; texts of any
length are read whole; repeated rows are measured one by one (in one block their
grammar is shared); other columns pass, and new columns step aside for theirs
with leading underscores; a null id leaves ``looped`` texts as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, let, table, text_of, words
from .shingles import mix

#: Least words of a run, and least number of its periods.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Words that are compressed together, and candidate periods that are tested together.
BLOCK_WORDS, BLOCK_CANDIDATES = 300_000, 2_000_000

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False)


class Grammar:
    """Nodes of the derivation (``lo``, ``mid``, ``hi`` of their first place) and all their places."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray):
        self.lo, self.mid, self.hi, self.places, self.place_nodes, self.n = [], [], [], [], [], 0
        sym, at, size, terminals = ids, np.arange(len(ids)), np.ones(len(ids), dtype=np.int64), int(ids.max()) + 1
        live, repeats = np.ones(len(ids), dtype=bool), True
        while len(sym) > 1 and (doc[1:] == doc[:-1]).any():
            site, rule, live = self._frequent(sym, doc, terminals + self.n, live) if repeats else (None, None, live)
            if site is None:
                repeats = False
                first = np.concatenate(([True], doc[1:] != doc[:-1]))
                number = np.arange(len(doc)) - np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
                site = np.flatnonzero((number[:-1] % 2 == 0) & (doc[1:] == doc[:-1]))
                rule = np.arange(len(site))
            self._add(at[site], at[site + 1], at[site + 1] + size[site + 1], rule)
            sym, size = sym.copy(), size.copy()
            sym[site] = terminals + self.n + rule
            size[site] += size[site + 1]
            self.n += int(rule.max()) + 1
            live[site] = True                         # pairs with a new symbol
            live[site[site > 0] - 1] = True
            left = np.ones(len(sym), dtype=bool)
            left[site + 1] = False
            sym, at, size, doc, live = sym[left], at[left], size[left], doc[left], live[left]

    @staticmethod
    def _frequent(sym: np.ndarray, doc: np.ndarray, bound: int, live: np.ndarray) -> tuple:
        """(sites, rule numbers, live) of one round; (None, None, live) if no pair of one text repeats.

        ``live`` marks the symbols whose pair with the next one may repeat: a
        pair that occurs once does so until one of its symbols is replaced.
        """
        inside = np.flatnonzero(live[:-1] & (doc[1:] == doc[:-1]))
        live = np.zeros(len(sym), dtype=bool)
        if not len(inside):
            return None, None, live
        pairs, inverse, count = np.unique(sym[inside] * bound + sym[inside + 1], return_inverse=True, return_counts=True)
        if count.max() < 2:
            return None, None, live
        rank = np.empty(len(pairs), dtype=np.int64)
        rank[np.lexsort((mix(pairs.astype(np.uint64)), count))] = np.arange(1, len(pairs) + 1)
        rank[count < 2] = 0
        value = np.zeros(len(sym) - 1, dtype=np.int64)
        value[inside] = rank[inverse]
        live[:-1] = value > 0
        # stretches of one pair (a a a); a stretch above both neighbours is replaced at every second place
        start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        top = value[start]
        higher = (top > np.concatenate(([0], top[:-1]))) & (top > np.concatenate((top[1:], [0])))
        length = np.diff(np.concatenate((start, [len(value)])))
        number = np.arange(len(value)) - np.repeat(start, length)
        site = np.flatnonzero(np.repeat(higher, length) & (number % 2 == 0))
        return site, np.unique(value[site], return_inverse=True)[1], live

    def _add(self, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray, rule: np.ndarray) -> None:
        _, first = np.unique(rule, return_index=True)
        for name, values in (("lo", lo), ("mid", mid), ("hi", hi)):
            getattr(self, name).append(values[first])
        self.places.append(lo)
        self.place_nodes.append(rule + self.n)

    def arrays(self) -> tuple[np.ndarray, ...]:
        parts = self.lo, self.mid, self.hi, self.places, self.place_nodes
        return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in parts)


class Hashes:
    """Prefix hashes of a word array: equal stretches have equal hashes."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.power = np.full(n + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
        self.power[0] = 1
        self.power = np.cumprod(self.power)
        self.prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * self.power[:n])))

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from ``a`` and from ``b`` (a <= b) seem equal."""
        return (self.prefix[a + n] - self.prefix[a]) * self.power[b - a] == self.prefix[b + n] - self.prefix[b]

    def longest(self, limit: np.ndarray, same) -> np.ndarray:
        """The greatest k up to ``limit`` for which ``same(k)`` holds; it holds for 0 and for all below."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            k = (low + high + 1) // 2
            ok = same(k)
            low, high = np.where(ok, k, low), np.where(ok, high, k - 1)
        return low


def _candidates(ids: np.ndarray, hashes: Hashes, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray, times: int):
    """(node, base, period): equal blocks of one period that end or begin at the boundary of a node."""
    pair = ids[:-1] * (int(ids.max()) + 1) + ids[1:]
    pair = np.unique(pair, return_inverse=True)[1]
    n = len(ids)
    order = np.argsort(pair, kind="stable")
    keys, where = pair[order] * n + order, np.empty(len(order), dtype=np.int64)
    where[order] = np.arange(len(order))
    here = mid - 1
    for left in (True, False):
        limit = np.minimum((mid - lo if left else hi - mid) // 2, (hi - lo) // times)
        if left:
            begin, stop = np.searchsorted(keys, pair[here] * n + here - limit), where[here]
        else:
            begin, stop = where[here] + 1, np.searchsorted(keys, pair[here] * n + np.minimum(here + limit, n - 1), side="right")
        many = np.maximum(stop - begin, 0)
        total = np.cumsum(many)
        a = 0
        while a < len(many):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + BLOCK_CANDIDATES, side="right")))
            node = np.repeat(np.arange(a, b), many[a:b])
            number = np.arange(len(node)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
            q = np.abs(order[begin[node] + number] - here[node])
            base = mid[node] - q if left else mid[node]
            other = mid[node] - 2 * q if left else mid[node]
            ok = hashes.equal(other, other + q, q)
            yield node[ok], base[ok], q[ok]
            a = b


def word_runs(ids: np.ndarray, doc: np.ndarray, least: int = MIN_WORDS, times: int = MIN_PERIODS) -> tuple[np.ndarray, ...]:
    """(start, end, period) of every maximal run, sorted by start, then period; ``doc`` numbers the texts in a row."""
    none = (np.zeros(0, dtype=np.int64),) * 3
    if len(ids) < least:
        return none
    lo, mid, hi, places, place_nodes = Grammar(ids, doc).arrays()
    big = np.flatnonzero(hi - lo >= least)
    if not len(big):
        return none
    hashes = Hashes(ids)
    parts = list(_candidates(ids, hashes, lo[big], mid[big], hi[big], times))
    node, base, q = (np.concatenate(x) for x in zip(*parts))
    node = big[node]
    right = hashes.longest(hi[node] - base - q, lambda k: hashes.equal(base, base + q, k))
    left = hashes.longest(base - lo[node], lambda k: hashes.equal(base - k, base + q - k, k))
    s, e = base - left, base + q + right
    ok = e - s >= np.maximum(least, times * q)
    node, s, e, q = node[ok], s[ok], e[ok], q[ok]
    for i in range(len(s)):                           # word by word: a hash that lied is corrected
        if not np.array_equal(ids[s[i]:e[i] - q[i]], ids[s[i] + q[i]:e[i]]):
            wrong = np.flatnonzero(ids[lo[node[i]]:hi[node[i]] - q[i]] != ids[lo[node[i]] + q[i]:hi[node[i]]]) + lo[node[i]]
            at = base[ok][i]
            s[i] = max(wrong[wrong < at], default=lo[node[i]] - 1) + 1
            e[i] = min(wrong[wrong >= at], default=hi[node[i]] - q[i]) + q[i]
    # one interval of a node has one smallest period
    order = np.lexsort((q, e, s, node))
    node, s, e, q = node[order], s[order], e[order], q[order]
    first = np.ones(len(node), dtype=bool)
    first[1:] = (node[1:] != node[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    ok = first & (e - s >= np.maximum(least, times * q))
    node, s, e, q = node[ok], s[ok], e[ok], q[ok]
    # to all places of the node
    by_node = np.argsort(place_nodes, kind="stable")
    begin, stop = (np.searchsorted(place_nodes[by_node], node, side=x) for x in ("left", "right"))
    many = stop - begin
    number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    shift = places[by_node[np.repeat(begin, many) + number]] - np.repeat(lo[node], many)
    s, e, q = np.repeat(s, many) + shift, np.repeat(e, many) + shift, np.repeat(q, many)
    # what lies inside another interval of its period is a part of it
    order = np.lexsort((-e, s, q))
    s, e, q = s[order], e[order], q[order]
    level = q * (len(ids) + 1)
    before = np.concatenate(([-1], np.maximum.accumulate(level + e)[:-1]))
    whole = level + e > before
    s, e, q = s[whole], e[whole], q[whole]
    order = np.lexsort((q, s))
    return s[order], e[order], q[order]


def _measure(texts: list, collapse: bool) -> tuple[list, list]:
    """Runs of each text as (start, length, period), and the text of the words that no later period holds."""
    runs: list = [[] for _ in texts]
    split = [t.encode().split() if t else [] for t in texts]    # bytes split at exactly the six blanks
    counts, begin = np.array([len(w) for w in split], dtype=np.int64), 0
    kept = [None] * len(texts)
    while begin < len(split):
        stop, total = begin + 1, int(counts[begin])
        while stop < len(split) and total + counts[stop] <= BLOCK_WORDS:
            total += int(counts[stop])
            stop += 1
        if total:
            ids = pa.array([w for text in split[begin:stop] for w in text], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
            n = counts[begin:stop]
            doc, first = np.repeat(np.arange(begin, stop), n), np.cumsum(n) - n
            s, e, q = word_runs(ids, doc)
            gone = np.zeros(total + 1, dtype=np.int64)
            np.add.at(gone, s + q, 1)
            np.add.at(gone, e, -1)
            gone = np.cumsum(gone[:-1]) > 0
            for x, y, z in zip(s.tolist(), e.tolist(), q.tolist()):
                d = int(doc[x])
                runs[d].append({"start": x - int(first[d - begin]), "length": y - x, "period": z})
            if collapse:
                for d in {int(doc[x]) for x in s.tolist()}:
                    out = gone[first[d - begin]:first[d - begin] + counts[d]].tolist()
                    kept[d] = b" ".join([w for w, g in zip(split[d], out) if not g])
        begin = stop
    if collapse:
        kept = [(b" ".join(w) if k is None else k).decode() for k, w in zip(kept, split)]
    return runs, kept


def periodic_runs(df: DataFrame, text_col: str = "text", keep_text: bool = True, collapse: bool = True) -> DataFrame:
    """``df`` plus ``runs`` (array of start, length, period, in words) and ``collapsed``, the text with one period of each run.

    ``collapse=False`` leaves the collapsed text out, ``keep_text=False`` the text itself.
    """
    kept = [f for f in df.schema.fields if keep_text or f.name != text_col]
    schema, names = df.select(*[F.col(f"`{f.name}`") for f in kept]).schema, [f.name for f in kept]
    new = fresh(df, "runs", "collapsed")[:1 + collapse]
    for name, kind in zip(new, (RUNS, T.StringType())):
        schema = schema.add(name, kind, False)
    runs_type = pa.list_(pa.struct([pa.field(f.name, pa.int64(), False) for f in RUNS.elementType.fields]))

    def run(batches):
        for batch in batches:
            runs, texts = _measure(batch.column(batch.schema.names.index(text_col)).to_pylist(), collapse)
            out = [pa.array(runs, runs_type), pa.array(texts, pa.string())][:len(new)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index(c)) for c in names] + out, names=names + new)

    return df.mapInArrow(run, schema)


def looped(doc_id: Column, text: Column) -> Column:
    """The text; for one id in ten its words, from one of them on, repeated with a period (both follow from the id)."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def loop(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
        tail = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(w, a + i % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), tail), " ")).otherwise(text)
    return F.when(h % 10 == 0, let(words(text), loop)).otherwise(text)


def digests(runs: Column) -> dict[str, Column]:
    """n_runs, the longest run (ties: first start, then period) and the digest of all runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return {"n_runs": F.size(runs).cast("bigint"), "start": -best["s"], "length": best["l"], "period": -best["p"],
            "exponent_milli": F.floor(1000 * best["l"] / -best["p"]).cast("bigint"),
            "runs_sha256": F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256)}


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", looped(F.col("doc_id"), text_of("text")).alias("text"))
    found = periodic_runs(docs, keep_text=False)
    return found.select("doc_id", *[c.alias(k) for k, c in digests(F.col("runs")).items()],
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
