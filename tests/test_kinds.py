"""Types that keep every value, and the values that an explicit mapping refuses."""
import random
from decimal import Decimal

import pytest

from sheaf.operators import kinds, shape, upsert


def kinds_of(spark, **columns):
    n = max(map(len, columns.values()))
    rows = [tuple(c[i] if i < len(c) else None for c in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    return df, {r["column"]: r["type"] for r in shape.infer_types(df).collect()}


def test_least_upper_bounds(spark):
    df, got = kinds_of(
        spark, day=["2024-02-29", "2024-01-01 10:00"], bad_day=["2024-99-99"], feb=["2023-02-29", "2023-02-28"], nanos=["2024-01-01 10:00:00.1234567"],
        places=["0.1234567890123456789", "1"], huge=["1e999", "1"], tiny=["1e-999", "1"], zero=["0e-999", "-0.0"], expo=["1e5", "2.5"],
        printed=["0.30000000000000004", "1.5"], far=["999.5,999.5"], near=["90,-180"], padded=[" 12"], blank=["", "1"], long=["9007199254740993", "5"],
        long_half=["9007199254740993", "0.5"], wide=["1" * 30, "0." + "3" * 20], big=["7" * 39], plus=["+7", "007", "-1"], dot=["5.", ".5"],
        text=["a", "b"], none=[None], exact_expo=["1e5", "0." + "3" * 20], text_huge=["x", "1e999"])
    assert got == {"day": "date", "bad_day": "str", "feb": "anytype", "nanos": "str", "places": "decimal(20,19)", "huge": "str", "tiny": "str", "zero": "float",
                   "expo": "float", "printed": "float", "far": "str", "near": "geo_point", "padded": "str", "blank": "anytype", "long": "int",
                   "long_half": "decimal(17,1)", "wide": "str", "big": "str", "plus": "int", "dot": "float", "text": "str", "none": "anytype",
                   "exact_expo": "str", "text_huge": "str"}


def test_an_inferred_mapping_changes_no_value(spark):
    rng = random.Random(2)
    number = lambda: rng.choice(["", "-", "+"]) + "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 24))) + rng.choice(
        ["", ".", "." + "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 18)))]) + rng.choice(["", "", "", "e5", "E-7", "e400"])
    columns = {f"c{k}": [number() for _ in range(rng.randint(1, 3))] for k in range(60)}
    columns |= {f"d{k}": [f"{rng.randint(1, 9999):04d}-{rng.randint(1, 13):02d}-{rng.randint(1, 31):02d}"] for k in range(20)}
    df, got = kinds_of(spark, **columns)
    out = upsert.apply_mapping(df, shape.infer_mappings(df))
    seen = set()
    for before, after in zip(df.collect(), out.collect()):
        for c in df.columns:
            seen.add(got[c].split("(")[0])
            if before[c] is None:
                assert after[c] is None
            elif got[c] in ("int", "float") or got[c].startswith("decimal"):
                assert Decimal(repr(after[c]) if isinstance(after[c], float) else str(after[c])) == Decimal(before[c]), (c, got[c])
            else:
                assert str(after[c]).startswith(before[c])
    assert {"int", "float", "decimal", "str", "date"} <= seen


def test_typed_columns_keep_their_kind(spark):
    df = spark.sql("SELECT 1 a, 1.50BD b, 2D c, DATE'2024-01-01' d, true e, CAST(NULL AS INT) f, 'x' `g.h`")
    assert {r["column"]: r["type"] for r in shape.infer_types(df).collect()} == {
        "a": "int", "b": "decimal(3,2)", "c": "float", "d": "date", "e": "str", "f": "anytype", "g.h": "str"}
    empty = {r["column"]: (r["type"], r["n_nonnull"], r["max_len"]) for r in shape.infer_types(df.limit(0)).collect()}
    assert set(empty.values()) == {("anytype", 0, None)}


def test_split_by_mapping_loses_nothing(spark):
    rows = [(1, "7", "0.5", "2024-01-01", "1,2", "1.25"), (2, "7.5", "1e999", "2024-13-01", "91,0", "1.255"), (3, None, None, None, None, None),
            (4, "x", "0.1234567890123456789", "soon", "here", "1e1"), (4, "9" * 20, "nan", "2024-01-01", "1,2", "12345")]
    df = spark.createDataFrame(rows, "id int, n string, f string, d string, g string, p string").withColumnRenamed("id", "_refused")
    mapping = {"n": "integer", "f": "float", "d": "date", "g": "geo_point", "p": "decimal(5,2)"}
    accepted, rejects, counts = upsert.split_by_mapping(df, mapping, ["_refused"])
    assert [r[0] for r in accepted.orderBy("_refused").collect()] == [1, 3] and counts == {"rows": 5, "rejected": 3}
    assert [f.dataType.simpleString() for f in accepted.schema.fields] == ["int", "bigint", "double", "timestamp_ntz", "string", "decimal(5,2)"]
    assert sorted(map(tuple, rejects.collect())) == sorted([
        (2, "n", "7.5", "loses digits"), (2, "f", "1e999", "out of range"), (2, "d", "2024-13-01", "not in the calendar"), (2, "g", "91,0", "out of range"),
        (2, "p", "1.255", "loses digits"), (4, "n", "x", "not a number"), (4, "f", "0.1234567890123456789", "loses digits"), (4, "d", "soon", "not a date"),
        (4, "g", "here", "not a point"), (4, "p", "1e1", "loses digits"), (4, "n", "9" * 20, "out of range"), (4, "f", "nan", "not a number"),
        (4, "p", "12345", "out of range")])
    empty, none, counts = upsert.split_by_mapping(df.limit(0), mapping, ["_refused"])
    assert empty.count() == none.count() == 0 and counts == {"rows": 0, "rejected": 0}
    with pytest.raises(ValueError):
        upsert.split_by_mapping(df.withColumnRenamed("n", "value"), mapping, ["value"])


def test_the_plan_does_not_grow_with_the_columns(spark):
    plans = [kinds.infer_types(spark.range(1).selectExpr(*[f"cast(id as string) c{i}" for i in range(n)]))._jdf.queryExecution().optimizedPlan().toString()
             for n in (2, 60)]
    assert plans[0].count("regexp") == plans[1].count("regexp") and plans[1].count("RLIKE") == plans[0].count("RLIKE")


def test_a_shape_is_matched_once_per_value(spark):
    """Classifying a text matches the pattern of numbers once, however many parts of the result hang on it."""
    df = spark.createDataFrame([("1",), ("2.5",), (None,)], "a string")
    plan = kinds.infer_types(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(kinds.FLOAT_RE) == 1 and kinds.INT_RE not in plan
