"""The plans are the ones that hold at scale."""

import pytest

import cdcframe as c
from cdcframe.workspace import work_folder
from checks import inputs as i
from checks.queries import QUERIES
from tests.inspect_plan import plan

SF = "/root/testdata/sf0.001"
LAZY = [name for name in QUERIES if not name.startswith("stream") and not name.startswith(("apply_", "replicate_"))] + ["apply_change_log"]


def test_snapshot_bounds_and_columns_reach_the_scan(spark):
    lines = i.table(spark, SF, "lineitem")
    text = plan(c.snapshot(lines, "l_orderkey", 500, 100, ["l_orderkey", "l_tax"]))
    assert "GreaterThan(l_orderkey,100)" in text and "LessThanOrEqual(l_orderkey,500)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in text


def test_a_page_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(c.snapshot_page(i.table(spark, SF, "customer"), "c_custkey", 10))


def test_compaction_combines_before_its_only_shuffle(spark):
    text = plan(c.compact(i.event_batch(spark, SF), "id"))
    assert text.count("Exchange") == 1 and "Window" not in text
    assert text.index("max_by") < text.index("Exchange") < text.index("partial_max_by")


def test_net_changes_combine_before_the_shuffle_and_do_not_join_the_versions(spark):
    text = plan(c.net_changes(*i.order_versions(spark, SF), "o_orderkey"))
    assert "FullOuter" not in text and "Cartesian" not in text and "NestedLoop" not in text
    assert text.rindex("Exchange") < text.rindex("partial_sum")


def test_merge_moves_only_the_target(spark):
    changes = i.order_changes(spark, SF, {"2-HIGH": "update"}, {})
    alone = plan(changes).count("Exchange hashpartitioning")
    # The changes are laid out by key already, by their compaction.
    text = plan(c.merge(i.order_target(spark, SF), changes, "o_orderkey"))
    assert text.count("Exchange hashpartitioning") == alone + 1 == 2 and "FullOuter" in text


@pytest.mark.parametrize("name", LAZY)
def test_no_query_runs_python_or_one_task_over_the_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("Python", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node
    # A single partition is for global aggregates only.
    for line in text.split("Exchange SinglePartition")[1:]:
        assert "Aggregate" in line.split("\n")[1], line[:300]


def test_work_folder_is_in_the_shared_folder(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    folder = work_folder(spark, "x")
    assert folder.startswith(shared) if shared else "cdcframe-x" in folder
