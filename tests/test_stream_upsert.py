"""The streaming upsert killed at each of its steps, and replayed."""
import pytest

from sheaf.operators.upsert import KeyError_
from sheaf.streaming import incremental as inc

FIRST = [(k, 1, f"a{k}") for k in range(40)]
SECOND = [(k, 2 if k % 3 else 0, f"b{k}") for k in range(20, 60)]
WANT = {k: v for k, _, v in FIRST} | {k: v for k, o, v in SECOND if o or k >= 40}


class Killed(Exception):
    pass


def batch(spark, data):
    return spark.createDataFrame(data, "k bigint, ord bigint, v string")


def held(spark, table):
    got = inc.read_upserted(spark, table).collect()
    assert len({r.k for r in got}) == len(got)              # a key once, whatever happened
    return {r.k: r.v for r in got}


@pytest.mark.parametrize("step", ["_write", "written", "_point", "_mark"] + [f"point{i}" for i in (1, 4)])
def test_killed_and_replayed(spark, tmp_path, monkeypatch, step):
    table, root = f"kill_{step}", str(tmp_path / "t")
    inc.merge_batch(batch(spark, FIRST), 0, table, "k", "ord", 8, root, "s")
    before, calls = held(spark, table), []
    assert before == {k: v for k, _, v in FIRST}
    whole = {n: getattr(inc, n) for n in ("_write", "_point", "_mark")}

    def die_after(n, name):
        def run(*a):
            if len(calls) >= n:
                raise Killed
            calls.append(1)
            return whole[name](*a)
        return run
    if step == "written":                                   # the files are there, no entry points to them
        monkeypatch.setattr(inc, "_known", lambda *a: (_ for _ in ()).throw(Killed()))
    elif step.startswith("point"):
        monkeypatch.setattr(inc, "_point", die_after(int(step[5:]), "_point"))
    else:
        monkeypatch.setattr(inc, step, die_after(0, step))
    with pytest.raises(Killed):
        inc.merge_batch(batch(spark, SECOND), 1, table, "k", "ord", 8, root, "s")
    monkeypatch.undo()
    between = held(spark, table)
    # every key shows its row before or after the epoch; none of the earlier ones is lost
    assert set(before) <= set(between) and all(v in (before.get(k), WANT[k]) for k, v in between.items())
    assert inc._epoch(spark, table, "s") == 0
    inc.merge_batch(batch(spark, SECOND), 1, table, "k", "ord", 8, root, "s")
    assert held(spark, table) == WANT and inc._epoch(spark, table, "s") == 1
    assert inc.drop_unused(spark, table, root) > 0 and held(spark, table) == WANT
    inc.merge_batch(batch(spark, [(1, 9, "late")]), 1, table, "k", "ord", 8, root, "s")     # an epoch it holds
    assert held(spark, table) == WANT
    inc.merge_batch(batch(spark, [(1, 9, "late")]), 0, table, "k", "ord", 8, root, "other")  # another stream's
    assert held(spark, table)[1] == "late"


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    inc.merge_batch(batch(spark, FIRST), 0, "few", "k", "ord", 8, str(tmp_path), "s")
    files = set(spark.table("few").inputFiles())
    inc.merge_batch(batch(spark, [(3, 5, "new")]), 1, "few", "k", "ord", 8, str(tmp_path), "s")
    assert len(files - set(spark.table("few").inputFiles())) == 1 and held(spark, "few")[3] == "new"


def test_empty_batch_and_other_columns(spark, tmp_path):
    inc.merge_batch(batch(spark, []), 0, "none", "k", "ord", 8, str(tmp_path), "s")
    assert held(spark, "none") == {} and inc._epoch(spark, "none", "s") == 0
    with pytest.raises(KeyError_):
        inc.merge_batch(spark.createDataFrame([(1, 2)], "k bigint, w bigint"), 1, "none", "k", "w", 8, str(tmp_path), "s")
    with pytest.raises(Exception):
        inc.merge_batch(batch(spark, [(None, 1, "x")]), 1, "none", "k", "ord", 8, str(tmp_path), "s")
