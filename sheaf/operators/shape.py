"""Schema shaping.

Flatten / nest work on the schema (driver side, bounded by the schema width)
and produce one projection; JSON leaves come from ``variant_explode``; type
inference is in ``kinds``, mappings join its result to a template table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kinds import infer_types  # noqa: F401  (E6, re-exported)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ---- E1: flatten struct columns ---------------------------------------------

def _leaves(dtype: T.DataType, path: list[str]):
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _leaves(f.dataType, path + [f.name])
    else:
        yield path


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields become columns named ``a.b.c``; arrays stay whole;
    an empty struct vanishes."""
    cols = []
    for f in df.schema.fields:
        for path in _leaves(f.dataType, [f.name]):
            c = F.col(_q(path[0]))
            for p in path[1:]:
                c = c.getField(p)
            cols.append(c.alias(sep.join(path)))
    names = [c for c in (sep.join(p) for f in df.schema.fields for p in _leaves(f.dataType, [f.name]))]
    lower = {}
    for n in names:
        if n.lower() in lower and lower[n.lower()] != n:
            raise ValueError(f"names differ only by case: {lower[n.lower()]!r} and {n!r}")
        lower[n.lower()] = n
    return df.select(*cols)


# ---- E3 / E4: nest dotted names ---------------------------------------------

def _tree(names: Sequence[str], sep: str):
    tree: dict = {}
    for n in names:
        parts = n.split(sep)
        node = tree
        for i, p in enumerate(parts[:-1]):
            child = node.get(p)
            if child is not None and not isinstance(child, dict):
                raise ValueError(f"{sep.join(parts[:i + 1])!r} is both a leaf and a prefix of {n!r}")
            node = node.setdefault(p, {})
        leaf = parts[-1]
        if isinstance(node.get(leaf), dict):
            raise ValueError(f"{n!r} is both a leaf and a prefix")
        node[leaf] = n          # a repeated name: the last one wins
    return tree


def _build(node: dict) -> list[Column]:
    out = []
    for k, v in node.items():
        if isinstance(v, dict):
            out.append(F.struct(*_build(v)).alias(k))
        else:
            out.append(F.col(_q(v)).alias(k))
    return out


def nest_columns(df: DataFrame, sep: str = ".", keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``a.b.c`` become a struct ``a`` holding ``b.c``; other columns pass.

    A name that is both a leaf and a prefix (``a`` and ``a.b``) raises.
    """
    names = [c for c in df.columns if c not in keep]
    return df.select(*[F.col(_q(k)) for k in keep], *_build(_tree(names, sep)))


def nest_to_json(df: DataFrame, id_cols: Sequence[str] = (), sep: str = ".",
                 root: str | None = None, out: str = "doc") -> DataFrame:
    """One JSON text per row of the nested document (optionally under ``root``)."""
    nested = nest_columns(df, sep, keep=id_cols)
    body = F.struct(*[F.col(_q(c)) for c in nested.columns if c not in id_cols])
    if root:
        body = F.struct(body.alias(root))
    return nested.select(*id_cols, F.to_json(body, {"ignoreNullFields": "false"}).alias(out))


def dot_expand(mapping: DataFrame, group_cols: Sequence[str] = (), root: str = "properties",
               out: str = "mapping_json", order: str | None = None) -> DataFrame:
    """E4 on mapping rows: (key 'a.b.c', value JSON) -> one nested JSON text per group.

    Of a repeated key the last row by the ``order`` column wins (ties and no
    order: the greatest text, so never chance).

    The keys of a mapping are its field paths, bounded by the schema width:
    they are pivoted into columns (one row per group), nested, and written as
    JSON with the values kept as JSON (numbers and booleans unquoted).
    """
    keys = sorted(r[0] for r in mapping.select("key").distinct().collect())
    _tree(keys, ".")     # leaf/prefix clash check before any job
    wide = (mapping.groupBy(*group_cols).pivot("key", keys)
                   .agg(F.parse_json(F.max("value") if order is None else F.max_by("value", F.struct(order, "value")))))
    return nest_to_json(wide, id_cols=group_cols, root=root, out=out)


# ---- E2 / A7: JSON text -> key/value leaf rows --------------------------------

#: Levels of objects that the plan itself unfolds; deeper objects are walked inside their task.
PLAN_LEVELS = 6
#: Texts nested deeper than this never become variants: the JVM parses and types them by recursion.
VARIANT_LEVELS = 60
_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s"{}\[\],:]+')


def nesting(text: Column) -> Column:
    """Deepest nesting of brackets in a JSON text (brackets inside strings do not count)."""
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', "")
    step = lambda a, c: F.struct(
        (a["at"] + F.when(c.isin("{", "["), 1).otherwise(-1)).alias("at"),
        F.greatest(a["most"], a["at"] + F.when(c.isin("{", "["), 1).otherwise(-1)).alias("most"))
    return F.aggregate(F.regexp_extract_all(bare, F.lit(r"[{}\[\]]"), F.lit(0)),
                       F.struct(F.lit(0).alias("at"), F.lit(0).alias("most")), step, lambda a: a["most"])


def is_deep(text: Column) -> Column:
    """Whether a text is nested deeper than VARIANT_LEVELS; only texts with so many brackets are looked at closely."""
    brackets = F.length(text) - F.length(F.translate(text, "{[", ""))
    return F.when(brackets > VARIANT_LEVELS, nesting(text) > VARIANT_LEVELS).otherwise(False)


def _deep_leaves(text: str, prefix: str | None):
    """{path: JSON} of the leaves of a valid JSON object, with a stack of its own; of a repeated key the last one stays."""
    out, path, seen, at, arrays, begin = {}, [(prefix,)] if prefix is not None else [()], [], "value", 0, 0
    key, opened = None, False
    for m in _JSON_TOKEN.finditer(text):
        t = m.group()
        if arrays:                                    # inside an array: only its end matters
            arrays += (t in "[{") - (t in "]}")
            if not arrays:
                out[path[-1] + (key,)] = text[begin:m.end()]
                at = "next"
        elif t == "{":
            if opened:
                path.append(path[-1] + (key,))
            opened = True
            seen.append(set())
            at = "key"
        elif t == "}":
            path.pop()
            seen.pop()
            at = "next"
        elif t == "[":
            arrays, begin = 1, m.start()
        elif t == ",":
            at = "key"
        elif t == ":":
            at = "value"
        elif at == "key":
            key = json.loads(t)
            if key in seen[-1]:
                gone = path[-1] + (key,)
                out = {p: v for p, v in out.items() if p[:len(gone)] != gone}
            seen[-1].add(key)
        else:
            out[path[-1] + (key,)] = t
            at = "next"
    return {".".join(p): v for p, v in out.items()}


def _walk_deep(df: DataFrame) -> DataFrame:
    """Rows (..., key, value) with a JSON object as value -> a row per leaf below it.

    Rows with a null key hold a whole text: one that is an array gives an empty
    key, one that is not JSON stays as it is.
    """
    import pyarrow as pa

    n = len(df.columns)

    def leaves_of(key, value):
        if key is None:
            try:
                json.loads(value)
            except (ValueError, RecursionError):
                return [(None, value)]
            if not value.lstrip().startswith("{"):
                return [("", value)]
        return [(k, None if v == "null" else v) for k, v in _deep_leaves(value, key).items()]

    def run(batches):
        for batch in batches:
            for row, (key, value) in enumerate(zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist())):
                leaves = leaves_of(key, value)
                if leaves:
                    same = [batch.column(i).take(pa.array([row] * len(leaves))) for i in range(n - 2)]
                    yield pa.RecordBatch.from_arrays(same + [pa.array(list(c), pa.string()) for c in zip(*leaves)], names=batch.schema.names)
    return df.mapInArrow(run, df.schema)


def flatten_json_rows(df: DataFrame, json_col: str, id_cols: Sequence[str] = (),
                      max_depth: int | None = None) -> DataFrame:
    """One row per leaf of each JSON object: ids, ``key`` (dotted path), ``value`` (JSON).

    One pass and a plan of fixed size: ``PLAN_LEVELS`` lateral
    ``variant_explode`` generators, each over the object values of the level
    above, so the work is linear in the number of leaves; an object below the
    last of them is walked by a stack inside its task. A text nested deeper than
    ``VARIANT_LEVELS`` is walked so from its root, whatever its depth; its leaves
    are spelled as in the text. With ``max_depth`` an object at that level stays
    whole. Arrays and scalars are leaves; a JSON null
    gives a row with a null value; an empty object gives no row. A text whose
    root is an array or a scalar gives one row with an empty key and the whole
    value; a text that is not JSON gives one row with a null key and the text
    itself. An object that repeats a key keeps the last value: the session
    setting for that is switched on here where it is off, so the result does not
    depend on who built the session.
    """
    if not id_cols:
        raise ValueError("give the id columns that identify a row")
    spark = df.sparkSession
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    levels = PLAN_LEVELS if max_depth is None else max_depth
    text = F.col(json_col)
    deep = is_deep(text) if max_depth is None else F.lit(False)
    parsed = df.select(*id_cols, text.alias("_text"), F.coalesce(deep, F.lit(False)).alias("_deep"))
    base = parsed.filter(~F.col("_deep")).select(*id_cols, "_text", F.try_parse_json("_text").alias("_v0"))
    ids = ", ".join(f"b.{_q(c)}" for c in id_cols)
    laterals, keys, vals = [], [], []
    prev = "b._v0"
    for k in range(1, levels + 1):
        laterals.append(f"LATERAL variant_explode_outer({prev}) AS e{k}")
        keys.append(f"e{k}.key")
        vals.append(f"e{k}.value")
        prev = f"CASE WHEN schema_of_variant(e{k}.value) LIKE 'OBJECT%' THEN e{k}.value END"
    deepest = "coalesce(" + ", ".join(reversed(vals)) + ")"
    objects = base.filter(F.schema_of_variant("_v0").startswith("OBJECT"))
    rows = spark.sql(
        f"SELECT {ids}, concat_ws('.', {', '.join(keys)}) AS key, {deepest} AS _v, "
        f"e{levels}.value IS NOT NULL AS _at_limit "
        f"FROM {{b}} AS b, {', '.join(laterals)} WHERE e1.key IS NOT NULL", b=objects)
    is_obj = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    null = F.lit(None).cast("string")
    whole = is_obj & F.col("_at_limit") if max_depth is not None else F.lit(False)
    leaves = rows.filter(~is_obj | whole).select(
        *id_cols, "key", F.when(F.col("_v").isNull() | F.expr("is_variant_null(_v)"), null).otherwise(F.to_json("_v")).alias("value"))
    if max_depth is None:
        below = rows.filter(is_obj & F.col("_at_limit")).select(*id_cols, "key", F.to_json("_v").alias("value"))
        whole_texts = parsed.filter("_deep").select(*id_cols, null.alias("key"), F.col("_text").alias("value"))
        leaves = leaves.unionByName(_walk_deep(below.unionByName(whole_texts)))
    other = base.filter(F.col("_text").isNotNull() & ~F.coalesce(F.schema_of_variant("_v0").startswith("OBJECT"), F.lit(False)))
    text = F.when(F.expr("is_variant_null(_v0)"), null).otherwise(F.to_json("_v0"))
    return leaves.unionByName(other.select(
        *id_cols, F.when(F.col("_v0").isNotNull(), "").alias("key"),
        F.when(F.col("_v0").isNull(), F.col("_text")).otherwise(text).alias("value")))


# ---- E5 / E7: mapping templates ------------------------------------------------

# Mapping rows per kind, as (suffix, JSON value).
TEMPLATES = {
    "anytype": [("type", '"text"'), ("fields.keyword.type", '"keyword"'),
                ("fields.keyword.ignore_above", "256")],
    "str": [("type", '"text"'), ("index", "true"), ("store", "true"), ("norms", "true"),
            ("fielddata", "true"), ("index_phrases", "true"), ("eager_global_ordinals", "false")],
    "int": [("type", '"integer"')],
    "float": [("type", '"float"')],
    "date": [("type", '"date"')],
    "geo_point": [("type", '"geo_point"')],
    "decimal": [("type", None)],            # the type itself: decimal(p,s)
}


def templates_df(spark) -> DataFrame:
    rows = [(k, s, v) for k, lst in TEMPLATES.items() for s, v in lst]
    return spark.createDataFrame(rows, "type string, suffix string, value string")


def infer_mappings(df: DataFrame) -> DataFrame:
    """E5: mapping rows (key ``<column>.<suffix>``, value JSON) from the inferred types."""
    return _template_rows(infer_types(df)).select("key", "value").orderBy("key")


def _template_rows(kinds: DataFrame) -> DataFrame:
    """``kinds`` joined to its template rows; the 17 rows of the template table are broadcast."""
    t = F.broadcast(templates_df(kinds.sparkSession).withColumnRenamed("type", "kind"))
    own = F.concat(F.lit('"'), F.col("type"), F.lit('"'))
    return (kinds.withColumn("kind", F.substring_index("type", "(", 1)).join(t, "kind")
                 .withColumn("key", F.concat_ws(".", "column", "suffix")).withColumn("value", F.coalesce("value", own)))


def table_mappings(tables: Mapping[str, DataFrame]) -> DataFrame:
    """E5 for several tables, tagged with ``_table``: one aggregate per table, then one join and one sort."""
    kinds = None
    for name, df in tables.items():
        own = infer_types(df).withColumn("_table", F.lit(name))
        kinds = own if kinds is None else kinds.unionByName(own)
    return _template_rows(kinds).select("_table", "key", "value").orderBy("_table", "key")


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text: the schemaless view a spreadsheet has of a table."""
    return df.select(*[F.col(_q(c)).cast("string").alias(c) for c in df.columns])


# ---- E8: field statistics ---------------------------------------------------------

def field_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: non-null values, distinct values, longest text form.

    Distinct counts unpivot to (column, 128-bit digest of the value), group on it
    (a hot value is pre-aggregated map-side, with its length) and count per column:
    the shuffle carries 16 bytes per distinct value, however long it is.
    ``approx=True`` uses
    HyperLogLog sketches in one aggregation pass instead.
    """
    if approx:
        aggs = []
        for c in df.columns:
            s = F.col(_q(c)).cast("string")
            aggs.append(F.struct(F.lit(c).alias("column"), F.count(s).cast("bigint").alias("n_nonnull"),
                                 F.approx_count_distinct(s).cast("bigint").alias("n_distinct"),
                                 F.max(F.length(s)).cast("bigint").alias("max_len")))
        return df.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("r")).select("r.*")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(_q(c)).cast("string").alias("v"))
                                for c in df.columns]))
    per_value = (df.select(pairs.alias("p"))
                   .select("p.column", F.unhex(F.md5("p.v")).alias("v"), F.length("p.v").alias("len"))
                   .groupBy("column", "v").agg(F.count(F.lit(1)).alias("cnt"), F.max("len").alias("len")))
    return (per_value.groupBy("column")
            .agg(F.sum(F.when(F.col("v").isNotNull(), F.col("cnt")).otherwise(0)).cast("bigint").alias("n_nonnull"),
                 F.count("v").cast("bigint").alias("n_distinct"),
                 F.max("len").cast("bigint").alias("max_len")))


# ---- D3: geo point -------------------------------------------------------------

def geo_point(df: DataFrame, lat: str = "lat", lon: str = "lon", long: str = "long",
              out: str = "geo_point") -> DataFrame:
    """D3: ``'lat,lon'`` as the first column; ``long`` stands in only when ``lon``
    is null (0 is a valid longitude); a null coordinate gives null."""
    lon_c = F.col(lon)
    if long in df.columns:
        lon_c = F.coalesce(lon_c, F.col(long))
    g = F.concat(F.col(lat).cast("string"), F.lit(","), lon_c.cast("string"))
    return df.select(g.alias(out), *[F.col(_q(c)) for c in df.columns])
