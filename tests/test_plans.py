"""Shape of physical plans: what must hold for large inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from auditloom.operators import rank as W
from auditloom.workload import load
from auditloom.workload.binding import Tables

REGISTRY = load()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they look when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_pairwise_joins(name, spark, folder, no_broadcast):
    text = plan(REGISTRY[name].build(Tables(spark, folder)))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_top_k_per_group_cuts_before_the_shuffle(spark, folder):
    orders = Tables(spark, folder).orders
    text = plan(W.top_k_per_group(orders, ["o_orderstatus"], [F.col("o_totalprice").desc()], 5))
    # Printed from the result down: the final limit, the exchange, then the limit of each task.
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_global_top_k_has_no_global_sort(spark, folder):
    text = plan(REGISTRY["topk_owners_value"].build(Tables(spark, folder)))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_filters_and_columns_reach_the_scan(spark, folder):
    text = plan(REGISTRY["preset_scaled_filter"].build(Tables(spark, folder)))
    # The printed list is cut, so only its parts are looked for.
    pushed = text[text.index("PushedFilters"):]
    assert "IsNotNull(o_totalprice)" in pushed and "o_totalprice,400000.0)" in pushed and "EqualTo(o" in pushed
    scan = text[text.index("ReadSchema"):]
    assert "o_orderpriority" not in scan and "o_custkey" not in scan


def test_line_items_fold_before_the_dimension_join(spark, folder, no_broadcast):
    text = plan(REGISTRY["entity_breakdown"].build(Tables(spark, folder)))
    join = text.index("SortMergeJoin")
    assert "HashAggregate(keys=[l_partkey" in text[join:]
    # The join reuses the partitioning of the fold: one exchange per side, none in between.
    assert text[join:].count("Exchange hashpartitioning") == 2


def test_global_rank_has_one_range_shuffle(spark, folder):
    text = plan(REGISTRY["global_order_rank"].build(Tables(spark, folder)))
    assert "SortMergeJoin" not in text and "Window" in text


@pytest.mark.parametrize("strict", [False, True])
def test_patterns_of_records_stay_out_of_joins_and_filters(spark, tmp_path, strict):
    from auditloom.plans import ingest
    path = tmp_path / "2020.txt"
    path.write_text("12A- -2- 63\nDOE JOHN\nLot 3B\n10 20 9,999 1.00 1,000 2,000 3,000 18.00 ACCT- 77\n")
    rows = ingest.tax_books(spark, str(path), strict)
    steps = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [s for s in steps if ("Join " in s or "Filter " in s) and "regexp_extract" in s]
    got = rows.first()
    assert (got.account_number, got.total_value, got.land_value, float(got.tax_amount)) == ("77", 3000, 1000, 18.0)


def test_lines_of_books_are_not_shuffled(spark, tmp_path):
    """A block's lines become pieces where they are read; only counts of chunks and the few broken records move."""
    from auditloom.operators import extract as X
    from auditloom.sources.text import read_lines
    path = tmp_path / "2020.txt"
    path.write_text("".join(f"{k}A- -2- 63\nDOE JOHN\n1,000 2,000 3,000 18.00 ACCT- {k}\n" for k in range(3000)))
    tracker, jobs = spark.sparkContext.statusTracker(), f"pieces-{tmp_path}"
    spark.sparkContext.setJobGroup(jobs, jobs)
    pieces = X.record_pieces(read_lines(spark, str(path)), ["path"], F.col("block"), ["block", "row"], placed=True)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # The first job writes the pieces: it reads lines and has no stage before it.
    assert len(tracker.getJobInfo(min(tracker.getJobIdsForGroup(jobs))).stageIds) == 1
    text = plan(pieces)
    assert "Window" not in text and "Sort" not in text and pieces.filter("whole").count() >= 2999
