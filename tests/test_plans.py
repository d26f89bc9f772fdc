"""Plan-shape guards: pruning at the scan, map-side aggregation, group limits."""

import os
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")


def final_plan(df) -> str:
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    return p.split("== Initial Plan ==")[0]


def test_summary_prunes_and_preaggregates(spark):
    p = final_plan(E.queries()["service_success_summary"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("event_type" not in s and "value" not in s for s in schemas)
    assert "partial_count" in p and "partial_sum" in p


def test_sample_by_batch_limits_groups_map_side(spark):
    from loglens.operators.sample import batch_candidates
    from loglens.sources.views import load_log_view

    p = final_plan(batch_candidates(load_log_view(spark, SF, dirty=True, late=True), k=10))
    assert re.search(r"WindowGroupLimit .* Partial", p)


def test_bloom_probe_is_a_projection(spark):
    p = final_plan(E.queries()["bloom_documents"](spark, SF))
    assert "Join" not in p and "Exchange" not in p


def test_windowed_aggregates_map_side(spark):
    p = final_plan(E.queries()["hopping_success_rate"](spark, SF))
    assert "partial_count" in p and "Expand" in p
