"""Plan checks: no Python evaluation in text plans, no global
window over data rows in add_key, an anti join in upsert, pushdown and pruning."""
import pytest

from sheaf import catalog
from sheaf.operators import keys
from sheaf.sources.tables import read_table

from .conftest import SF_SMALL

TEXT = [q for q in catalog.QUERIES if q.startswith(("tok_", "an_", "f_", "term_", "token_", "html_",
                                                    "tokenize_", "analyze_", "custom_", "fingerprint_"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TEXT)
def test_no_python_in_text_plans(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_add_key_windows_only_within_partitions(spark, sf_dir):
    (o,) = keys.add_key([read_table(spark, sf_dir, "orders")], [["o_orderkey"]])
    logical = o._jdf.queryExecution().optimizedPlan().toString()
    # the only window without a partition is over the per-partition counts
    for line in logical.splitlines():
        if "Window [" in line:
            assert "__n" in line or "[__part" in line
    assert "Exchange SinglePartition" not in plan(o).split("BroadcastExchange")[0]


def test_upsert_has_anti_join(spark):
    p = plan(catalog.QUERIES["upsert_orders"](spark, SF_SMALL))
    assert "LeftAnti" in p


def test_prefix_filter_pushed_and_pruned(spark):
    p = plan(catalog.QUERIES["prefix_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(source), StringStartsWith(source,src1)" in p
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in p


def test_term_counts_prune_columns(spark):
    p = plan(catalog.QUERIES["tok_letter"](spark, SF_SMALL))
    assert "ReadSchema: struct<text:string,lang:string>" in p
    assert "partial_count" in p
