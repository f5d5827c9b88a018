"""One schema for schemaless rows, and the rows in it."""
import json

import pytest

from sheaf.sources import tables


def rows(spark):
    docs = [{"a": 1, "b": {"c": "x", "d": [1, 2]}}, {"a": 2.5, "b": {"e": None}}, {"b": {"c": "y", "e": {"f": True}}, "g h": "z"},
            {"m": 1}, {"m": "text"}, {}]
    texts = [json.dumps(d) for d in docs] + ["[1]", "5", "{bad", None, "null"]
    return spark.createDataFrame(list(enumerate(texts)), "id int, js string")


def test_schema_and_counts(spark):
    schema, counts = tables.merged_schema(rows(spark), "js")
    assert counts == {"objects": 6, "not_objects": 3, "not_json": 1, "nulls": 1}
    got = dict(tables.schema_rows(schema))
    assert got["b.c"] == "string" and got["b.d"] == "array<bigint>" and got["b.e.f"] == "boolean" and got["g h"] == "string" and got["m"] == "variant"
    assert set(got) == {"a", "b.c", "b.d", "b.e.f", "g h", "m"}


def test_typed_rows(spark):
    out = tables.typed_rows(rows(spark), "js", ["id"])
    got = {r.id: r for r in out.collect()}
    assert len(got) == 11 and out.columns == ["id", "a", "b", "g h", "m"]
    assert float(got[0].a) == 1 and float(got[1].a) == 2.5 and got[0].b.c == "x" and list(got[0].b.d) == [1, 2] and got[2].b.e.f is True
    assert got[2]["g h"] == "z" and got[3].a is None and got[4].m.toPython() == "text" and got[9].b is None


def test_odd_tables(spark):
    none = rows(spark).limit(0)
    assert tables.merged_schema(none, "js")[0].fields == [] and tables.typed_rows(none, "js", ["id"]).columns == ["id"]
    with pytest.raises(ValueError):
        tables.typed_rows(rows(spark).withColumnRenamed("id", "A"), "js", ["A"])
