"""Registered queries of this subpackage against their DuckDB oracles, and that all are registered."""
import duckdb
import pytest

import __spark_entry__ as entry
from sheaf.llm import catalog

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = entry.queries()
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")] == [
        "op1_pii", "op2_repetition", "op3_decontamination", "op4_url_rules", "op5_licenses", "op6_near_dedup", "op7_warc",
        "op8_token_counts", "op9_mixing", "op10_quality", "op11_syncmer_fingerprints", "op12_spelling_variants", "op13_periodic_runs"]
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.sql(catalog.ORACLES[name])
    df = catalog.QUERIES[name](spark, SF).select(*res.columns)
    assert sorted(map(tuple, df.collect())) == sorted(res.fetchall())
