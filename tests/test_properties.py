"""Properties and the semantics of the keyed and shaping operators."""
from pyspark.sql import functions as F

from sheaf.functions import filters as flt
from sheaf.functions import tokenizers as tok
from sheaf.operators import keys, shape, upsert
from sheaf.sources.tables import read_table
from sheaf.streaming import incremental as inc


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def keyed_target(spark):
    return spark.createDataFrame([(1, 0, "a"), (2, 0, "b"), (3, 0, "c")], "k bigint, ord bigint, v string")


def keyed_batch(spark):
    # in-batch duplicates (k=2 twice), a new column, a new key
    return spark.createDataFrame([(2, 5, "B1", "x"), (2, 7, "B2", "y"), (4, 1, "D", None)],
                                 "k bigint, ord bigint, v string, extra string")


def test_upsert_full_replace_and_last_wins(spark):
    out = upsert.upsert(keyed_target(spark), keyed_batch(spark), "k", "ord")
    assert rows(out, "k") == [(1, 0, "a", None), (2, 7, "B2", "y"), (3, 0, "c", None), (4, 1, "D", None)]


def test_upsert_twice_is_upsert_once(spark):
    once = upsert.upsert(keyed_target(spark), keyed_batch(spark), "k", "ord")
    twice = upsert.upsert(once, keyed_batch(spark), "k", "ord")
    assert rows(once, "k") == rows(twice, "k")


def test_empty_batch_is_noop(spark):
    empty = spark.createDataFrame([], "k bigint, ord bigint, v string")
    assert rows(upsert.upsert(keyed_target(spark), empty, "k", "ord"), "k") == rows(keyed_target(spark), "k")


def test_merged_count_is_distinct_ids(spark):
    left = spark.createDataFrame([(1, "l1"), (2, "l2")], "k_left bigint, v string")
    right = spark.createDataFrame([(2, "r2"), (3, "r3")], "k_right bigint, v string")
    m = upsert.merge_tables([("left", left, "k_left", "k_left"), ("right", right, "k_right", "k_right")])
    got = {r["_id"]: (r["_table"], r["v"]) for r in m.collect()}
    assert got == {"1": ("left", "l1"), "2": ("right", "r2"), "3": ("right", "r3")}


def test_apply_mapping_and_keyword(spark):
    df = spark.createDataFrame([("1", "2.5", "x" * 257), ("x", "3", "short")], "a string, b string, t string")
    m = spark.createDataFrame([("a.type", '"integer"'), ("b.type", '"float"')], "key string, value string")
    out = upsert.apply_mapping(df, m)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double", "string"]
    assert rows(out.select("a", "b"), "b") == [(1, 2.5), (None, 3.0)]
    kw = upsert.keyword_subfield(df, "t")
    assert [r["t.keyword"] for r in kw.orderBy("a").collect()] == [None, "short"]


def test_replace_table_switches_the_entry(spark, tmp_path):
    root = str(tmp_path)
    upsert.upsert_into("t_switch", keyed_target(spark), "k", "ord", root)
    upsert.upsert_into("t_switch", keyed_batch(spark), "k", "ord", root)
    want = [(1, 0, "a", None), (2, 7, "B2", "y"), (3, 0, "c", None), (4, 1, "D", None)]
    assert rows(spark.table("t_switch"), "k") == want
    upsert.drop_old_versions(spark, "t_switch", root)
    assert rows(spark.table("t_switch"), "k") == want and len(list((tmp_path / "t_switch").iterdir())) == 1


def test_failing_write_leaves_the_old_table(spark, tmp_path):
    import pytest as _pt
    root = str(tmp_path)
    upsert.upsert_into("t_fail", keyed_target(spark), "k", "ord", root)
    bad = keyed_batch(spark).withColumn("v", F.when(F.col("k") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with _pt.raises(Exception):
        upsert.upsert_into("t_fail", bad, "k", "ord", root)
    null_key = spark.createDataFrame([(None, 1, "x")], "k bigint, ord bigint, v string")
    with _pt.raises(Exception):
        upsert.upsert_into("t_fail", null_key, "k", "ord", root)
    assert rows(spark.table("t_fail"), "k") == rows(keyed_target(spark), "k")


def test_null_order_value_keeps_its_row(spark):
    batch = spark.createDataFrame([(1, None, "only"), (2, None, "no"), (2, 3, "yes")], "k bigint, ord bigint, v string")
    assert rows(upsert.latest_per_key(batch, "k", "ord"), "k") == [(1, None, "only"), (2, 3, "yes")]


def test_add_key_is_gap_free_and_runs_on(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    ko, kc = keys.add_key([o, c], [["o_orderdate", "o_orderkey"], ["c_custkey"]], offset=7)
    n_o, n_c = o.count(), c.count()
    assert ko.columns == [*o.columns, "_key"] and kc.columns == [*c.columns, "_key"]
    whole = [r.asDict() for r in ko.orderBy("_key").collect()]             # every column, not the order columns only
    assert [r["_key"] for r in whole] == list(range(7, 7 + n_o))
    assert [r["o_orderkey"] for r in whole] == [r["o_orderkey"] for r in o.orderBy("o_orderdate", "o_orderkey").collect()]
    vals = sorted(r[0] for r in ko.select("_key").collect())
    assert vals == list(range(7, 7 + n_o))
    assert sorted(r[0] for r in kc.select("_key").collect()) == list(range(7 + n_o, 7 + n_o + n_c))
    first = ko.orderBy("_key").first()
    assert first["o_orderkey"] == o.orderBy("o_orderdate", "o_orderkey").first()["o_orderkey"]


def test_key_profile_counts(spark):
    a = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id bigint")
    p = keys.key_profile({"a": a})
    assert rows(p, "table") == [("a", "id", 4, 1, 2, 1)]


def test_nest_flatten_roundtrip(spark):
    df = spark.createDataFrame([(1, (2, [3, 4]), "d"), (2, None, None)],
                               "id bigint, a struct<b: int, c: array<int>>, `d` string")
    flat = shape.flatten_struct(df)
    assert flat.columns == ["id", "a.b", "a.c", "d"]
    back = shape.nest_columns(flat, keep=["id"])
    assert rows(back.select("id", "a.b", "a.c", "d"), "id") == [(1, 2, [3, 4], "d"), (2, None, None, None)]


def test_flatten_json_rows_semantics(spark):
    js = spark.createDataFrame([
        (1, '{"a": {"b": {"c": 1}}, "x": [1, 2]}'), (2, '{"n": null, "e": {}}'), (3, "{}"), (4, "not json"),
        (5, '{"A": 1, "a": 2}')], "id bigint, js string")
    got = sorted((tuple(r) for r in shape.flatten_json_rows(js, "js", ["id"]).collect()), key=repr)
    assert got == [(1, "a.b.c", "1"), (1, "x", "[1,2]"), (2, "n", None), (4, None, "not json"), (5, "A", "1"), (5, "a", "2")]


def test_dot_expand(spark):
    m = spark.createDataFrame([("a.type", '"text"'), ("a.fields.keyword.ignore_above", "256"),
                               ("b.type", '"integer"')], "key string, value string")
    js = shape.dot_expand(m).first()["mapping_json"]
    assert js == ('{"properties":{"a":{"fields":{"keyword":{"ignore_above":256}},"type":"text"},'
                  '"b":{"type":"integer"}}}')


def test_infer_types_mixed(spark):
    df = spark.createDataFrame([("1", "1.5", "2024-01-01", "1.5,2", "abc", "1", None),
                                ("2", "3", "2024-01-02 10:00:00", "-3,4.25", "d e", "x", None)],
                               "s_int string, s_float string, s_date string, s_geo string, s_text string, "
                               "s_mixed string, s_null string")
    got = {r["column"]: r["type"] for r in shape.infer_types(df).collect()}
    assert got == {"s_int": "int", "s_float": "float", "s_date": "date", "s_geo": "geo_point",
                   "s_text": "str", "s_mixed": "anytype", "s_null": "anytype"}


def test_geo_point_rules(spark):
    df = spark.createDataFrame([(1, 10.0, 0.0, 5.0), (2, None, 1.0, None), (3, 1.0, None, 7.0)],
                               "id bigint, lat double, lon double, long double")
    out = shape.geo_point(df)
    assert out.columns[0] == "geo_point"
    assert [r[0] for r in out.orderBy("id").collect()] == ["10.0,0.0", None, "1.0,7.0"]


def test_unique_never_grows(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    t = flt.lowercase(tok.standard(F.col("text")))
    bad = d.select(t.alias("t")).filter(F.size(flt.unique(F.col("t"))) > F.size("t")).count()
    assert bad == 0


def test_stream_upsert_independent_of_batching(spark, sf_dir, tmp_path):
    """Guarded B6 = latest per key of the whole input, for two different batch splits."""
    ev = read_table(spark, sf_dir, "events")
    src = str(tmp_path / "src")
    ev.repartition(4, "event_id").write.parquet(src)        # several files -> several micro-batches
    results = []
    for i, per_trigger in enumerate((1, 3)):
        target = f"keyed_{i}"
        inc.stream_upsert(spark, src, ev.schema, target, "user_id", ["ts", "event_id"], str(tmp_path / f"t{i}"),
                          buckets=8, checkpoint=str(tmp_path / f"ck{i}"), max_files_per_trigger=per_trigger)
        results.append(rows(inc.read_upserted(spark, target).select(*ev.columns), "user_id"))
    expected = rows(upsert.latest_per_key(ev, "user_id", ["ts", "event_id"]).select(*ev.columns), "user_id")
    assert results[0] == results[1] == expected


def test_bulk_write_to_and_merged_table(spark, tmp_path):
    import pytest as _pt
    root = str(tmp_path / "idx")
    upsert.bulk_write_to(root, {"t_bulk": (keyed_target(spark), "k", "ord")})
    upsert.bulk_write_to(root, {"t_bulk": (keyed_batch(spark), "k", "ord")})
    assert rows(spark.table("t_bulk"), "k")[1] == (2, 7, "B2", "y")
    upsert.write_merged("t_merged", [("a", keyed_target(spark), "k", "ord")], root)
    with _pt.raises(upsert.KeyError_):
        upsert.write_merged("t_merged", [("a", keyed_target(spark), "k", "ord")], root)


def test_choose_key(spark):
    a = spark.createDataFrame([(1, 1), (2, 1)], "id bigint, g bigint")
    b = spark.createDataFrame([(1, 5), (3, 6)], "id bigint, g bigint")
    assert keys.choose_key(keys.key_profile({"a": a, "b": b})) == "id"


def test_merge_in_table_order_is_typed(spark):
    t = spark.createDataFrame([(1, 9, "old"), (1, 10, "new")], "k bigint, ord bigint, v string")
    m = upsert.merge_tables([("t", t, "k", "ord")])
    assert [r["v"] for r in m.collect()] == ["new"]


def test_json_duplicate_key_last_wins(spark):
    js = spark.createDataFrame([(1, '{"a": 1, "a": 2}')], "id bigint, js string")
    assert [tuple(r) for r in shape.flatten_json_rows(js, "js", ["id"]).collect()] == [(1, "a", "2")]


def test_stream_analyze_equals_batch(spark, sf_dir, tmp_path):
    from sheaf.plans import analyze as an
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    src = str(tmp_path / "docs")
    d.repartition(3).write.parquet(src)
    out = str(tmp_path / "out")
    inc.stream_analyze(spark, src, d.schema, out, "doc_id", "text", "standard",
                       checkpoint=str(tmp_path / "ck"), max_files_per_trigger=1)
    got = rows(spark.read.parquet(out), "doc_id")
    want = rows(an.with_analyzed(d, "text", "standard").drop("text"), "doc_id")
    assert got == want


def test_json_rows_of_any_depth_and_root(spark):
    deep = "1"
    for k in range(12, 0, -1):
        deep = '{"l%d": %s, "x": "}{"}' % (k, deep)
    data = [(1, deep), (2, '[1,{"a":2}]'), (3, "5"), (4, "{bad"), (5, "null"), (6, None), (7, "{}"), (8, '{"a":{"b":null}}')]
    out = shape.flatten_json_rows(spark.createDataFrame(data, "id bigint, js string"), "js", ["id"]).collect()
    got = {}
    for r in out:
        got.setdefault(r.id, []).append((r.key, r.value))
    path = ".".join(f"l{k}" for k in range(1, 13))
    assert (path, "1") in got[1] and len(got[1]) == 13
    assert got[2] == [("", '[1,{"a":2}]')] and got[3] == [("", "5")] and got[4] == [(None, "{bad")] and got[5] == [("", None)]
    assert 6 not in got and 7 not in got and got[8] == [("a.b", None)]


def test_long_integers_keep_every_digit(spark):
    df = spark.createDataFrame([("1234567890123456789", "12345678901234567890", "7")], "a string, b string, c string")
    kinds = {r["column"]: r["type"] for r in shape.infer_types(df).collect()}
    assert kinds == {"a": "int", "b": "decimal(20,0)", "c": "int"}
    out = upsert.apply_mapping(df, shape.infer_mappings(df)).first()
    assert (out.a, int(out.b), out.c) == (1234567890123456789, 12345678901234567890, 7)


def test_null_leaves_and_repeated_mapping_keys(spark):
    df = spark.createDataFrame([(1, None, 2)], "id bigint, `a.b` bigint, `a.c` bigint")
    assert shape.nest_to_json(df, id_cols=["id"]).first()["doc"] == '{"a":{"b":null,"c":2}}'
    m = spark.createDataFrame([("a.type", '"float"'), ("a.type", '"text"')], "key string, value string").repartition(3)
    assert {shape.dot_expand(m).first()[0] for _ in range(3)} == {'{"properties":{"a":{"type":"text"}}}'}


def test_fingerprint_clusters_with_texts_without_tokens(spark):
    from sheaf.plans import analyze as an
    from sheaf.plans import jobs
    df = spark.createDataFrame([(1, ""), (2, "!!!"), (3, None), (4, "b a"), (5, "A, b")], "doc_id bigint, text string")
    out = jobs.fingerprint_clusters(df, "doc_id", F.get(an.analyze("text", "fingerprint"), F.lit(0)))
    assert rows(out, "doc_id") == [(4, 4, 2), (5, 4, 2)]


def test_stem_groups_keep_a_null_group(spark):
    from sheaf.functions import porter
    from sheaf.plans import jobs
    df = spark.createDataFrame([(1, None, "cats cat"), (2, "en", "cat")], "doc_id bigint, lang string, text string")
    out = jobs.stem_groups(df, tok.lowercase(F.col("text")), porter.porter_steps(), "doc_id", ["lang"])
    assert sorted(map(tuple, out.select("lang", "stem", "tf", "df", "n_forms").collect()), key=repr) == [
        ("en", "cat", 1, 1, 1), (None, "cat", 2, 1, 2)]
