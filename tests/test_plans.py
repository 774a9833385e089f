"""Plan assertions: no cartesian products, no row-at-a-time Python, pushdown reaches the scan."""

import pytest

from conftest import SF001
from queryscope.registry import QUERIES

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_or_row_udf(spark, key):
    p = plan_text(QUERIES[key](spark, SF001))
    for bad in FORBIDDEN:
        assert bad not in p, f"{key}: {bad}"
    if key != "detect_typos":
        assert "ArrowEvalPython" not in p and "MapInPandas" not in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    from queryscope.operators import zero as Z
    from queryscope.params import REPORT_END, REPORT_START
    from queryscope.sources import fixtures as fx
    df = Z.load_zero_result_searches(fx.canonical_events(spark, SF001), REPORT_START, REPORT_END)
    p = plan_text(df)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in p
    assert "PushedFilters: [IsNotNull(p_partkey)]" in p  # every part is read


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_global_window(spark, key):
    import re
    p = plan_text(QUERIES[key](spark, SF001))
    assert not re.search(r"Window \[[^\n]*\], \[\], \[", p), f"{key}: window without PARTITION BY"
