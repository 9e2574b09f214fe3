"""Tables of centres against the same centres as literals and against plain loops."""

from __future__ import annotations

import random
from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import centres, clustering


def cloud(spark, n, k, seed=3):
    """Points on a coarse grid, so that many stand on one place and many distances are equal."""
    draw = random.Random(seed)
    place = lambda: tuple(float(draw.randint(0, 12)) for _ in range(3))
    points = [(i, *place()) for i in range(n)]
    # A third of the points on one place.
    points += [(n + i, 1.0, 1.0, 1.0) for i in range(n // 2)]
    middles = [(3 * i, *place()) for i in range(k)]
    df = spark.createDataFrame(points, "id long, x double, y double, z double").repartition(6)
    table = spark.createDataFrame(middles, "cluster long, x double, y double, z double").repartition(3)
    return df, table, points, middles


def plain(points, middles):
    found = {}
    for i, *point in points:
        # Axis by axis; ``sum`` would carry the rounding along.
        gaps = [
            (reduce(add, ((a - b) * (a - b) for a, b in zip(point, middle))), k)
            for k, *middle in middles
        ]
        found[i] = min(gaps)[::-1]
    return found


@pytest.mark.parametrize("most_numbers", [centres.MOST_NUMBERS, 400, 40])
def test_the_nearest_of_many_and_ties(spark, most_numbers):
    df, table, points, middles = cloud(spark, 600, 150)
    rows = centres.assign_from(df, ["x", "y", "z"], table, most_numbers)
    assert rows.columns == ["id", "x", "y", "z", "cluster", "gap"]
    found = {r.id: (r.cluster, r.gap) for r in rows.collect()}
    assert len(found) == len(points) and found == plain(points, middles)


def test_two_thousand_centres_in_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(centres, "POINTS_OF_PART", 200)
    monkeypatch.setattr(centres, "HELD", 5_000)
    monkeypatch.setattr(centres, "ACROSS", 64)
    draw = random.Random(8)
    middles = [(i, *(draw.random() for _ in range(3))) for i in range(2_000)]
    points = [(i, *(draw.random() for _ in range(3))) for i in range(900)]
    df = spark.createDataFrame(points, "id long, x double, y double, z double")
    table = spark.createDataFrame(middles, "cluster long, x double, y double, z double")
    wanted = plain(points, middles)
    for most_numbers in (centres.MOST_NUMBERS, 1_000):
        rows = centres.assign_from(df, ["x", "y", "z"], table, most_numbers).collect()
        assert {r.id: (r.cluster, r.gap) for r in rows} == wanted


@pytest.mark.parametrize("most_numbers", [centres.MOST_NUMBERS, 4])
def test_what_is_no_number(spark, most_numbers):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0.0), (2, nan, 0.0), (3, inf, 0.0), (4, 1.0, 0.0), (4, 1.0, 0.0), (None, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "cluster long, a double, b double").withColumn("gap", F.lit("x"))
    middles = [(7, 1.0, 1.0), (5, 8.0, 8.0), (2, None, 0.0), (None, 1.0, 0.0), (6, nan, 1.0), (9, inf, 0.0)]
    table = spark.createDataFrame(middles, "cluster long, a double, b double")
    found = centres.assign_from(df.withColumn("id", F.col("cluster")), ["a", "b"], table, most_numbers)
    assert found.columns == ["a", "b", "id", "cluster", "gap"]
    assert sorted(((r.id, r.cluster, r.gap) for r in found.collect()), key=repr) == sorted(
        [(1, None, None), (2, None, None), (3, None, None), (4, 7, 1.0), (4, 7, 1.0), (None, 5, 2.0)],
        key=repr,
    )
    none = centres.assign_from(df, ["a", "b"], table.limit(0), most_numbers)
    assert none.filter("cluster is not null or gap is not null").count() == 0 and none.count() == 6
    assert centres.assign_from(df.limit(0), ["a", "b"], table, most_numbers).count() == 0


def test_equal_to_centres_as_literals(spark):
    df, table, _, middles = cloud(spark, 500, 40)
    axes = ["x", "y", "z"]
    literals = [tuple(m) for _, *m in middles]
    ours = centres.step_from(df, axes, table).withColumn("cluster", (F.col("cluster") / 3).cast("int"))
    theirs = clustering.centre_step(df, axes, literals)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    assert centres.cost_from(df, axes, table).first() == clustering.cost(df, axes, literals).first()


def test_a_small_table_moves_no_point(spark):
    df, table, _, _ = cloud(spark, 50, 10)
    scan = df.select("x", "y", "z")
    plan = centres.assign_from(scan, ["x", "y", "z"], table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == scan._jdf.queryExecution().executedPlan().toString().count("Exchange")
    wide = centres.assign_from(scan, ["x", "y", "z"], table, 8)
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("seed", range(20))
def test_blocks_are_left_out_only_if_they_are_farther(seed, monkeypatch):
    monkeypatch.setattr(centres, "ACROSS", 5)
    monkeypatch.setattr(centres, "HELD", 20)
    draw = np.random.default_rng(seed)
    spread = 3 if seed % 2 else 1e6
    points = np.round(draw.normal(size=(60, 2)) * spread, 0 if seed % 2 else 12)
    middles = np.round(draw.normal(size=(70, 2)) * spread, 0 if seed % 2 else 12)
    names = draw.permutation(70)
    number, gap = centres.nearest_rows(points, names, middles)
    for point, n, g in zip(points.tolist(), number, gap):
        gaps = [(reduce(add, ((a - b) * (a - b) for a, b in zip(point, m))), k) for m, k in zip(middles.tolist(), names)]
        assert (g, n) == min(gaps)


@pytest.mark.parametrize("level", [False, True])
def test_points_meet_the_cells_and_leaves_that_may_be_nearest(spark, monkeypatch, level):
    draw = np.random.default_rng(5)
    places = draw.random((3_000, 3)) * [50, 100, 5]
    spots = draw.random((2_000, 3)) * [30, 900, 5]
    # A hundred blocks, and on a level no axis that tells them apart.
    places[:, 1] = 7.0 if level else places[:, 1]
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(places.tolist())], "cluster long, x double, y double, z double")
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(spots.tolist())], "id long, x double, y double, z double")
    met, find = spark.sparkContext.accumulator(0), centres._nearest_in

    def counted(points, tree):
        met.add(len(points))
        return find(points, tree)

    monkeypatch.setattr(centres, "_nearest_in", counted)
    rows = centres.assign_from(df, ["x", "y", "z"], table, 120).collect()
    number, gap = centres.nearest_rows(spots, np.arange(3_000), places)
    assert {r.id: (r.cluster, r.gap) for r in rows} == {i: (number[i], gap[i]) for i in range(2_000)}
    assert met.value < 2_000 * 40
    boxes = centres._tree_of(np.arange(3_000), places)[3]
    assert sum(len(those) for those, _ in centres._near_boxes(spots, gap, boxes)) < 2_000 * 10


def test_centres_on_one_place_count_once(spark):
    copies = spark.range(4_000).select(F.col("id").alias("cluster"), (F.col("id") % 20).cast("double").alias("x"))
    df = spark.range(40).select("id", (F.col("id") / 2).alias("x"))
    found = centres.assign_from(df, ["x"], copies, 100)
    assert "CoGroup" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.cluster for r in found.collect()} == {i: min(i // 2, 19) for i in range(40)}


def test_distances_beyond_all_numbers(spark):
    table = spark.createDataFrame([(i, 1e200 + i * 1e190, 0.0) for i in range(50)], "cluster long, x double, y double")
    df = spark.createDataFrame([(1, -1e200, 0.0), (2, 1e200, 3.0)], "id long, x double, y double")
    for most_numbers in (centres.MOST_NUMBERS, 12):
        rows = centres.assign_from(df, ["x", "y"], table, most_numbers).collect()
        assert {r.id: (r.cluster, r.gap) for r in rows} == {1: (None, None), 2: (0, 9.0)}
