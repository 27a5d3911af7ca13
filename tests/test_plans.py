"""Plan shape: pruned scans, no shuffle where none is needed, broadcast catalogue joins."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    plan = E.queries()["url_location"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    read = [line for line in plan.split("\n") if "ReadSchema" in line][0]
    assert "struct<page_id:bigint,url:string>" in read
    assert "html" not in read


def test_array_feature_has_no_exchange(spark):
    plan = _executed(E.queries()["tc3_array"](spark, SF))
    assert "Exchange" not in plan


def test_catalogue_joins_are_broadcast(spark):
    plan = _executed(E.queries()["resolve_distribution"](spark, SF))
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_cross_joins_anywhere(spark):
    for name in ("access_filter", "config_merge", "param_sweep", "group_widths", "supports_list",
                 "input_id_precedence", "flatten_hierarchy"):
        plan = _executed(E.queries()[name](spark, SF))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_requests_are_read_once_and_answers_not_broadcast(spark):
    plan = _executed(E.queries()["resolve_all_or_fail"](spark, SF)).split("Initial Plan")[0]
    assert sum("FileScan" in line and "l_orderkey" in line for line in plan.split("\n")) == 1
    assert "ShuffledHashJoin" in plan
