"""Quality classifier by co-training of two views.

Views. The *text* view sees the content only: hashed byte pairs, character
classes, and shares of repeated lines and words. The *metadata* view sees the
rest of the row only: source, language, recorded length, and what the URL of a
page of the same document says, if the caller joins one. Each view has a
logistic regression of its own.

Co-training. Both start from the labelled documents. In every round each view
scores all documents without a label and hands its most confident ones, with the
label that it believes in, to the *other* view's training set; then both are
fitted again. At the end each view's score is calibrated on labelled documents that
neither was fitted on, a second small regression weighs the two calibrated
scores by how reliable they proved there, and every document is scored.

Toxicity. Insults are a few words in a long text, which neither view shows. Words that
labelled documents prove to mark toxic ones are learned, and a document that holds
one is rejected whatever its quality.

Scale. Texts are read once, by tasks, into a table of ``N_TEXT + N_META`` numbers per
document in the shared folder; each round is a scan of that table. Models are fitted
on samples bounded (in expectation) by ``MAX_LABELLED`` and ``MAX_PSEUDO`` rows, picked by hash from
*all* rows that qualify, so the choice does not depend on order or partitioning.

Defined cases: null texts are empty, null metadata is a value of its own; a label of
a document that occurs twice counts once (the smaller); labels without a document and
null labels are ignored; with labels of one class only every document is scored with
that class's share and kept if it is good; without labels all are kept with a score of
1; repeated rows are scored one by one; other columns pass.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, fresh, table

#: Numbers per document: hashed byte pairs plus shares; hashed metadata plus lengths.
N_PAIRS, N_SHARES, N_META = 96, 14, 48
N_TEXT = N_PAIRS + N_SHARES
#: Bounds of the training samples (rows): labelled ones, and pseudo-labels per view, class and round.
MAX_LABELLED, MAX_PSEUDO = 20_000, 1_000
ROUNDS = 3
VIEWS = ("text_view", "meta_view")
#: A pseudo-label is given from this probability of either class.
CONFIDENT = 0.97
#: Part of the labelled sample that is kept for calibration, and the score from which a document is kept.
HELD_OUT, KEEP = 0.25, 0.5
#: A word marks toxic documents from this share of them and this test value; so many words are kept at most.
TOXIC_SHARE, TOXIC_G2, MAX_TOXIC = 0.8, 24.0, 2000

_CLASSES = ((b"\x00", b" "), (b"!", b"/"), (b"0", b"9"), (b":", b"@"), (b"A", b"Z"), (b"[", b"`"), (b"a", b"z"),
            (b"{", b"\x7f"), (b"\x80", b"\xff"))


def text_features(text: str | None) -> np.ndarray:
    """The text view of one document."""
    raw = (text or "").encode()
    out = np.zeros(N_TEXT, dtype=np.float32)
    if not raw:
        return out
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    pairs = ((b[:-1] * np.uint32(2654435761) + b[1:] * np.uint32(40503)) >> np.uint32(7)) % np.uint32(N_PAIRS)
    out[:N_PAIRS] = np.sqrt(np.bincount(pairs, minlength=N_PAIRS) / len(b))
    counts = np.bincount(b, minlength=256)
    shares = [counts[lo[0]:hi[0] + 1].sum() / len(b) for lo, hi in _CLASSES]
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = max(len(words), 1)
    same = sum(a == c for a, c in zip(words, words[1:]))
    shares += [len(set(words)) / n, same / n, len(set(lines)) / max(len(lines), 1), sum(map(len, words)) / n / 16,
               np.log1p(len(words)) / 10]
    out[N_PAIRS:] = shares
    return out


def meta_features(values: list, numbers: list) -> np.ndarray:
    """The metadata view of one document: hashed values, and logarithms of numbers."""
    out = np.zeros(N_META, dtype=np.float32)
    for k, v in enumerate(values):
        out[zlib.crc32(f"{k}={v}".encode()) % (N_META - 2 * len(numbers))] += 1
    for k, v in enumerate(numbers):
        at = N_META - 2 * len(numbers) + 2 * k
        out[at], out[at + 1] = np.log1p(max(v or 0, 0)) / 12, v is None
    return out


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Logistic regression with an intercept by Newton's method; ridge penalty on the other weights."""
    a = np.column_stack((x, np.ones(len(x)))).astype(np.float64)
    w, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], penalty * len(x) / 100)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge + 1e-9), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Log odds."""
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def _matrix(rows: list, name: str) -> np.ndarray:
    return np.array([np.frombuffer(r[name], dtype=np.float32) for r in rows], dtype=np.float64)


def _scores(batch, models: list[np.ndarray]) -> list[np.ndarray]:
    out = []
    for name, w in zip(VIEWS, models):
        column = batch.column(batch.schema.names.index(name))
        x = np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(len(column), len(w) - 1)
        out.append(score(x.astype(np.float64), w))
    return out


def _inputs(docs: DataFrame, id_col: str, text_col: str, meta_cols: tuple[str, ...], number_cols: tuple[str, ...],
            carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, values, numbers) and the columns ``carry`` as c0, c1, ..."""
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"),
                       F.array(*[F.col(c).cast("string") for c in meta_cols]).alias("values"),
                       F.array(*[F.col(c).cast("double") for c in number_cols]).alias("numbers"),
                       *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)])


def _both_views(batch) -> list[np.ndarray]:
    get = lambda c: batch.column(batch.schema.names.index(c)).to_pylist()
    text = [text_features(t) for t in get("text")]
    meta = [meta_features(v, n) for v, n in zip(get("values"), get("numbers"))]
    return [np.array(x, dtype=np.float32).reshape(len(x), n) for x, n in ((text, N_TEXT), (meta, N_META))]


def featurise(inputs: DataFrame, seed: int = 11) -> DataFrame:
    """(id, text_view, meta_view, h) of ``_inputs``, one row per document; ``h`` is a hash that picks samples."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text_view", T.BinaryType()),
                           T.StructField("meta_view", T.BinaryType())])

    def run(batches):
        for batch in batches:
            views = [pa.array([r.tobytes() for r in x], pa.binary()) for x in _both_views(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index("id")), *views], names=schema.names)
    views = inputs.select("id", "text", "values", "numbers").mapInArrow(run, schema)
    return views.withColumn("h", F.xxhash64(F.lit(seed), "id", "text_view", "meta_view"))


def _part(h: str, share: float):
    """Whether a row belongs to a random share of all rows, by its hash."""
    return (F.col(h) / F.lit(2.0 ** 64) + 0.5) < share


def train(views: DataFrame, labels: DataFrame, scratch: Scratch, rounds: int = ROUNDS, seed: int = 11) -> dict:
    """The two models, their calibrations and the final combination; {"share": s} where there is nothing to learn.

    Labels beyond a random ``MAX_LABELLED`` of them are not used.
    """
    one = labels.filter(F.col("y").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.min("y").alias("y"))
    one = scratch.save(one.withColumn("hid", F.xxhash64(F.lit(seed), "id")), "labels")
    n = one.count()
    picked = F.broadcast(one.filter(_part("hid", MAX_LABELLED / max(n, 1))).select("id", "y"))    # its size is the bound
    known, seen = [], set()
    for r in views.join(picked, "id").orderBy("h").collect():
        if r["id"] not in seen:                                         # a repeated document counts once
            seen.add(r["id"])
            known.append(r)
    y = np.array([r["y"] for r in known], dtype=np.float64)
    if len(set(y)) < 2:
        return {"share": float(y.mean()) if len(y) else 1.0}
    held = np.array([zlib.crc32(f"{seed}:{r['id']}".encode()) % 1000 < 1000 * HELD_OUT for r in known])
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    x = [_matrix(known, n) for n in VIEWS]
    sets = [[(x[v][~held], y[~held])] for v in (0, 1)]
    models = [fit(*map(np.concatenate, zip(*sets[v]))) for v in (0, 1)]
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("z0", T.DoubleType()), T.StructField("z1", T.DoubleType())])
    least = float(np.log(CONFIDENT / (1 - CONFIDENT)))
    for turn in range(rounds):
        fixed = list(models)

        def run(batches, fixed=fixed):
            for batch in batches:
                z = _scores(batch, fixed)
                sure = pa.array((np.abs(z[0]) >= least) | (np.abs(z[1]) >= least))
                h = batch.column(batch.schema.names.index("h"))
                yield pa.RecordBatch.from_arrays([h, pa.array(z[0]), pa.array(z[1])], names=schema.names).filter(sure)
        free = views.join(picked.select("id"), "id", "left_anti")
        sure = scratch.save(free.mapInArrow(run, schema), f"confident{turn}")
        # what each view is sure of, counted over all documents; then a random part of each kind
        kinds = [(t, y_, (F.col(f"z{t}") >= least) if y_ else (F.col(f"z{t}") <= -least)) for t in (0, 1) for y_ in (0, 1)]
        counts = sure.agg(*[F.count(F.when(c, 1)).alias(f"n{t}{y_}") for t, y_, c in kinds]).first()
        mark = lambda t, y_, c: F.when(c & _part("h", MAX_PSEUDO / max(counts[f"n{t}{y_}"], 1)), y_)  # noqa: E731, B023
        marked = sure.select("h", *[F.coalesce(*[mark(*k) for k in kinds if k[0] == t]).alias(f"y{t}") for t in (0, 1)])
        chosen = F.broadcast(marked.filter(F.col("y0").isNotNull() | F.col("y1").isNotNull()).dropDuplicates(["h"]))  # 4 MAX_PSEUDO
        rows = {r["h"]: r for r in views.join(chosen, "h").collect()}
        rows = [rows[h] for h in sorted(rows)]
        for teacher, learner in ((0, 1), (1, 0)):
            told = [r for r in rows if r[f"y{teacher}"] is not None]
            if told:
                sets[learner].append((_matrix(told, VIEWS[learner]), np.array([r[f"y{teacher}"] for r in told], dtype=np.float64)))
        models = [fit(*map(np.concatenate, zip(*sets[v]))) for v in (0, 1)]
    check = held if held.any() else ~held
    z = [score(x[v][check], models[v]) for v in (0, 1)]
    calibrations = [fit(z[v][:, None], y[check]) for v in (0, 1)]
    calibrated = np.column_stack([score(z[v][:, None], calibrations[v]) for v in (0, 1)])
    return {"models": models, "calibrations": calibrations, "final": fit(calibrated, y[check])}


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             meta_cols: tuple[str, ...] = ("source", "lang"), number_cols: tuple[str, ...] = ("n_chars",),
             carry: tuple[str, ...] = (), rounds: int = ROUNDS) -> DataFrame:
    """The columns ``carry`` of ``docs`` plus (text_score, meta_score, score): calibrated probabilities of being good.

    ``labels``: (id, y) with y 1 for good documents and 0 for others. Where a carried column has one of the new
    names, underscores are put before the new one. The models are all that is kept from training: the final scan
    reads the documents themselves.
    """
    inputs = _inputs(docs, id_col, text_col, meta_cols, number_cols, carry)
    with Scratch(docs.sparkSession) as scratch:
        model = train(scratch.save(featurise(inputs), "views"), labels, scratch, rounds)
    kept = [f"c{i}" for i in range(len(carry))]
    schema = T.StructType([*[inputs.schema[c] for c in kept], *[T.StructField(n, T.DoubleType()) for n in ("z0", "z1", "z")]])

    def run(batches):
        logistic = lambda z: pa.array(1 / (1 + np.exp(-z)))
        for batch in batches:
            if "share" in model:
                z = [pa.array(np.full(len(batch), model["share"]))] * 3
            else:
                raw = [score(x.astype(np.float64), w) for x, w in zip(_both_views(batch), model["models"])]
                cal = [score(r[:, None], c) for r, c in zip(raw, model["calibrations"])]
                z = [logistic(cal[0]), logistic(cal[1]), logistic(score(np.column_stack(cal), model["final"]))]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.names.index(c)) for c in kept], *z], names=schema.names)
    out = inputs.mapInArrow(run, schema)
    s1, s2, s3 = fresh(docs.select(*[F.col(f"`{c}`") for c in carry]), "text_score", "meta_score", "score")
    return out.select(*[F.col(c).alias(carry[i]) for i, c in enumerate(kept)],
                      F.col("z0").alias(s1), F.col("z1").alias(s2), F.col("z").alias(s3))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("y"))


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("toxic").alias("y"))


def _vocabulary(text) -> Column:
    """The words of a text, each once, in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{M}]+"), F.lit(0)))


def toxic_words(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 11) -> list[str]:
    """Words that mark toxic documents, learned from ``labels`` (id, y with y 1 for toxic).

    A word counts if ``TOXIC_SHARE`` of the labelled documents that hold it are toxic and that is no chance: twice the
    log likelihood ratio against the share of toxic documents is ``TOXIC_G2`` or more. The ``MAX_TOXIC`` surest are kept.
    """
    one = labels.filter(F.col("y").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.max("y").alias("y"))
    n = one.count()
    picked = one.withColumn("hid", F.xxhash64(F.lit(seed), "id")).filter(_part("hid", MAX_LABELLED / max(n, 1))).select("id", "y")
    known = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(picked), "id")
    share = known.agg(F.avg("y")).first()[0]
    if not share or share == 1:
        return []
    counts = (known.select("y", F.explode(_vocabulary(F.col("text"))).alias("word")).groupBy("word")
                   .agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("n")))
    part = lambda k, p: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (F.col("n") * p))).otherwise(0.0)
    g2 = 2 * (part("a", share) + part("b", 1 - share))
    sure = (counts.withColumn("b", F.col("n") - F.col("a")).withColumn("g2", g2)
                  .filter((F.col("a") >= TOXIC_SHARE * F.col("n")) & (F.col("a") > share * F.col("n")) & (F.col("g2") >= TOXIC_G2)))
    return [r["word"] for r in sure.orderBy(F.desc("g2"), "word").limit(MAX_TOXIC).collect()]


def is_toxic(text: Column, listed: list[str]) -> Column:
    """Whether a text holds one of the listed words."""
    return F.arrays_overlap(_vocabulary(text), F.array(*[F.lit(w) for w in listed])) if listed else F.lit(False)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = KEEP, toxic: DataFrame | None = None) -> DataFrame:
    """``docs`` without the documents that the classifier rejects and, with labels ``toxic``, without toxic ones."""
    listed = [] if toxic is None else toxic_words(docs, toxic)
    scored = classify(docs, labels, carry=tuple(docs.columns))
    good = (F.col(scored.columns[-1]) >= least) & ~is_toxic(F.col("text"), listed)
    return scored.filter(good).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bad = is_toxic(F.col("text"), toxic_words(docs, toxic_labels(spark, sf_dir)))
    return (classify(docs.withColumn("toxic", bad), quality_labels(spark, sf_dir), carry=("doc_id", "toxic"))
            .withColumn("kept", (F.col("score") >= KEEP) & ~F.col("toxic")).drop("toxic"))
