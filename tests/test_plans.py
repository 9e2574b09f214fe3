"""The physical plans the reports are meant to have."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from millrace.plans.catalog import reports
from millrace.operators.members import without_listed

NO_PLAN_YET = {
    "best_days_stream",
    "best_days_csv_stream",
    "daily_totals_stream",
    "checked_csv_stream",
    "daily_totals_kept",
}
PYTHON = {"part_factors", "factor_histogram"}
MODELS = {
    "cluster_means_2d",
    "cluster_means_3d",
    "cluster_means_3d_refit",
    "labelled_means",
    "elbow",
    "group_centres_2d",
    "group_centres_3d",
    "group_centres_refit",
    "labelled_groups",
    "group_cost",
}


def plan(spark, name):
    return reports()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(reports()) - NO_PLAN_YET - MODELS))
def test_no_cross_join_and_python_only_for_factors(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert ("ArrowEvalPython" in text) == (name in PYTHON)


@pytest.mark.parametrize("name", ["best_days", "best_year", "first_lines"])
def test_top_k_is_a_heap(spark, name):
    text = plan(spark, name)
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def columns_read(text):
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    return [set(re.findall(r"(\w+):", scan)) for scan in scans]


@pytest.mark.parametrize(
    "name, wanted",
    [
        ("best_days", {"l_quantity", "l_extendedprice", "l_shipdate"}),
        ("year_extremes", {"o_totalprice", "o_orderdate"}),
        ("word_count", {"text"}),
        ("drop_values", {"c_mktsegment"}),
        ("nearest_centre", {"p_partkey", "p_size", "p_retailprice"}),
        ("factor_histogram", {"o_custkey"}),
    ],
)
def test_scans_read_only_what_is_used(spark, name, wanted):
    assert columns_read(plan(spark, name)) == [wanted]


def test_listed_values_reach_the_scan(spark):
    assert re.search(r"PushedFilters: \[[^\]]*In\(c_mktsegment", plan(spark, "drop_values"))


def test_one_year_is_filtered_before_the_shuffle(spark):
    text = plan(spark, "one_year")
    assert text.index("Filter") > text.index("Exchange")


def test_word_count_adds_up_before_the_shuffle(spark):
    assert "partial_count" in plan(spark, "word_count")


def test_hot_values_are_split_in_a_merge_join(spark):
    """A third of the rows hold one value and the list is too large to broadcast."""
    small = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        n = 300_000
        cold = F.concat(F.lit("k"), F.col("id") % 50_000)
        line = F.when(F.col("id") % 3 == 0, "hot").otherwise(cold)
        pad = F.md5(F.col("id").cast("string"))
        df = spark.range(0, n, 1, 16).select(line.alias("line"), pad.alias("pad"))
        listed = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("v"))
        kept = without_listed(df, "line", listed)
        kept = kept.groupBy(F.substring("pad", 1, 1).alias("first")).count()
        found = sum(row["count"] for row in kept.collect())
        text = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert found == sum(1 for i in range(n) if i % 3 == 0 or i % 50_000 >= 20_000)
    assert "SortMergeJoin(skew=true)" in text


@pytest.mark.parametrize("name", ["word_count", "group_members", "token_hits", "text_sizes"])
def test_one_exchange(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == text.count("Exchange ") == 1
    assert "partial_" in text


def test_the_costly_step_of_word_count_stands_once(spark):
    """Two nested replacements, in one column."""
    text = plan(spark, "word_count")
    assert text.count("regexp_replace(") == 2
