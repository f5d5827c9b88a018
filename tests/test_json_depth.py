"""JSON leaves at any depth, and strings that end in a backslash or hold escaped quotes."""
import json
import time

from sheaf.operators import shape


def leaves(value, path=()):
    if isinstance(value, dict):
        for k, v in value.items():
            yield from leaves(v, path + (k,))
    else:
        yield ".".join(path), value


def flat(spark, rows):
    df = spark.createDataFrame(rows, "id int, j string")
    return [(r.id, r.key, r.value) for r in shape.flatten_json_rows(df, "j", ["id"]).collect()]


def nested(depth, inner):
    for k in reversed(range(depth)):
        inner = {f"l{k}": inner, "x": "}{\\"}
    return inner


def test_leaves_behind_escaped_strings(spark):
    rows = [(1, json.dumps({"p": "c:\\", "q": {"r": {"s": 1}}})), (2, json.dumps({"p": 'a"}{"', "q": {"r": 2}})),
            (3, json.dumps({"p": '\\"{', "q": "{{{{"}))]
    got = {(i, k): v for i, k, v in flat(spark, rows)}
    assert got[1, "q.r.s"] == "1" and got[2, "q.r"] == "2" and got[3, "q"] == '"{{{{"' and len(got) == 6


def test_below_the_levels_of_the_plan(spark):
    inner = {"a": [1, {"b": [2, {}]}, "]}"], "n": None, "e": {}, "f": {"g": {"h": {"é.k\\": "\\"}}}, "t": True, "s": "a\\\"b", "z": []}
    docs = [nested(d, inner) for d in (0, 1, 4, 5, 6, 7, 8, 20)]
    got = flat(spark, [(i, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)])
    read = lambda v: None if v is None else json.loads(v)
    assert sorted(((i, k, read(v)) for i, k, v in got), key=repr) == sorted(((i, k, v) for i, d in enumerate(docs) for k, v in leaves(d) if v != {}), key=repr)


def test_depth_of_a_thousand_in_one_plan(spark):
    depth = 1000
    text = "".join('{"l%d":' % k for k in range(depth)) + "1" + ',"x":2}' * depth
    df = spark.createDataFrame([(1, text), (2, '{"a":1}'), (3, "[" * 90 + "]" * 90), (4, text[:-1]), (5, None)], "id int, j string")
    out = shape.flatten_json_rows(df, "j", ["id"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_explode") <= 2 * shape.PLAN_LEVELS
    begin = time.time()
    got = {(r.id, r.key): r.value for r in out.collect()}
    assert got.pop((3, "")) == "[" * 90 + "]" * 90 and got.pop((4, None)) == text[:-1]
    assert len(got) == depth + 2 and got[1, ".".join(f"l{k}" for k in range(depth))] == "1" and got[2, "a"] == "1"
    assert time.time() - begin < 60


def test_repeated_keys_below_the_plan(spark):
    text = '{"a":{"x":1,"y":{"z":2}},"a":{"y":3,"y":4}}'
    for levels in (0, 4, 8, 70):
        wrapped = '{"w":' * levels + text + "}" * levels
        assert [(k.replace("w.", ""), v) for _, k, v in flat(spark, [(1, wrapped)])] == [("a.y", "4")]


def test_a_stated_depth_keeps_objects_whole(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": {"c": 1}}}')], "id int, j string")
    assert [tuple(r) for r in shape.flatten_json_rows(df, "j", ["id"], max_depth=2).collect()] == [(1, "a.b", '{"c":1}')]


def test_repeated_mapping_key_follows_the_order(spark):
    m = spark.createDataFrame([("a.type", '"x"', 1), ("a.type", '"b"', 2), ("c", "5", 1)], "key string, value string, at int").repartition(3)
    assert shape.dot_expand(m, order="at").first()[0] == '{"properties":{"a":{"type":"b"},"c":5}}'
    assert shape.dot_expand(m.drop("at")).first()[0] == '{"properties":{"a":{"type":"x"},"c":5}}'
