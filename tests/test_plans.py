"""Physical plans: no product of tables, Python only where it is meant, and pruned scans."""

import re

import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
#: Queries that run Python on the executors: fuzzy scores, pixels, per-run state.
PYTHON = {"block_separation", "complete_map_workbooks", "document_run", "contain_check_score", "image_steps", "line_angles"}
STREAMS = {"stream_dedup", "file_arrival", "stream_state_machine", "exactly_once_intake", "run_state_moves", "page_intake", "page_intake_stream", "transactional_insert", "translation_with_hook", "archived_documents"}
CORE = [k for k in __spark_entry__.queries() if not k.startswith("op") and k != "pipeline" and k not in STREAMS]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CORE)
def test_plan(spark, name):
    text = plan(__spark_entry__.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert name in PYTHON or not re.search("Python|Pandas|Arrow", text)


def test_scan_is_pruned_and_filters_are_pushed(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(__spark_entry__.queries()["list_filter_optional"](spark, SF))
    assert "l_comment" not in text and re.search(r"PushedFilters: .*GreaterThan\(o_totalprice,1000", text)
    assert re.search(r"ReadSchema: struct<l_returnflag:string,l_linestatus:string>", plan(__spark_entry__.queries()["grouping_sets_cube"](spark, SF)))
