"""Plan properties of the catalogue (the scale rules, checked on sf0.001)."""

import os
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

BOUNDED_TOP = {"skip_records"}  # the first rows of an order, merged from each task's first rows
SMALL_LISTS = {"subject_crosswalk", "review_queue", "upload_batches", "error_report_indexed"}  # example rule tables of the catalogue; a row a partition
PYTHON = {"best_line_ratio", "best_line_ratio_short", "ratio_scores", "title_validation_ratio", "contains_automaton"}  # one Arrow pass
NO_SHUFFLE = {"iso_date", "subject_crosswalk_array", "exact_map_with_escape", "doc_type", "embargo_date",
              "person_names", "rights_holder", "field_lookup", "upsert_field", "set_field", "replace_chain",
              "record_keys", "title_normalise", "title_case", "keyword_split"}


def _plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.QUERY_NAMES) - {"crosswalk_roundtrip", "error_report_csv", "authority_csv"}))
def test_plan_rules(spark, name):
    plan = _plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "SinglePartition" not in plan or name in BOUNDED_TOP
    assert not re.search(r"BatchEvalPython", plan)
    assert not re.search(r"ArrowEvalPython|PythonUDF", plan) or name in PYTHON
    assert not re.search(r"LocalTableScan|Literal.{0,20}array<struct", plan) or name in SMALL_LISTS  # no collected list in a plan
    if name in NO_SHUFFLE:
        assert "Exchange" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(spark, "record_keys")
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan
