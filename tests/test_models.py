from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import clustering, regression, scaling
from millrace.session import shared_folder

BLOBS = [
    (-0.8, 1.0, 100.0),
    (-0.4, 9.0, 900.0),
    (0.0, 5.0, 500.0),
    (0.5, 1.5, 850.0),
    (0.9, 8.0, 50.0),
]


def blobs(spark, copies=60, seed=4):
    draw = random.Random(seed)
    rows = []
    for i, (a, b, c) in enumerate(BLOBS):
        for _ in range(copies):
            label = " Fatal" if i in (1, 3) else " Ok"
            rows.append(
                (a + draw.gauss(0, 0.01), b + draw.gauss(0, 0.05), c + draw.gauss(0, 2.0), label)
            )
    return spark.createDataFrame(rows, "a double, b double, c double, LABEL string")


def close_to(found, wanted, gap):
    left = sorted(tuple(r) for r in found)
    return all(
        all(abs(x - y) < g for x, y, g in zip(p, q, gap)) for p, q in zip(left, sorted(wanted))
    ) and len(left) == len(wanted)


def test_two_axes(spark):
    found = clustering.cluster_means(blobs(spark), ["a", "b"], 5).drop("cluster").collect()
    assert close_to(found, [(a, b) for a, b, _ in BLOBS], (0.02, 0.1))


def test_three_axes_come_back_in_their_units(spark):
    df = blobs(spark)
    found = clustering.cluster_means(df, ["a", "b", "c"], 5, scale_columns=["c"])
    assert close_to(found.drop("cluster").collect(), BLOBS, (0.02, 0.1, 3.0))


def test_same_input_gives_the_same_centres(spark):
    draw = random.Random(1)
    points = [(draw.random(), draw.random()) for _ in range(3000)]
    df = spark.createDataFrame(points, "a double, b double").repartition(6)
    first = clustering.cluster_means(df, ["a", "b"], 4).collect()
    assert clustering.cluster_means(df, ["a", "b"], 4).collect() == first


def test_refit_stretches_the_outer_centres_to_the_limits(spark):
    df = blobs(spark)
    found = clustering.cluster_means(df, ["a", "b", "c"], 5, ["c"], unscale="refit")
    low, high = df.agg(F.min("c"), F.max("c")).first()
    reached = found.agg(F.min("c"), F.max("c")).first()
    assert reached[0] == pytest.approx(low) and reached[1] == pytest.approx(high)
    with pytest.raises(ValueError):
        clustering.cluster_means(df, ["a"], 2, unscale="other")


def test_labelled_centres(spark):
    df = blobs(spark)
    gaps = spark.createDataFrame([(0.1, 1.0, 1.0, None), (None, 1.0, 1.0, " Ok")], df.schema)
    found = clustering.labelled_cluster_means(df.union(gaps), ["a", "b"], "LABEL", "Ok", 5)
    assert close_to(found.collect(), [BLOBS[1][:2], BLOBS[3][:2]], (0.02, 0.1))


def test_elbow(spark):
    df = blobs(spark)
    found = [tuple(r) for r in clustering.elbow(df, ["a", "b"], 2, 10).collect()]
    assert [k for k, _ in found] == list(range(2, 11))
    costs = dict(found)
    assert costs[5] < 0.05 * costs[4]
    rows = df.select("a", "b").collect()
    centres = [tuple(r)[1:] for r in clustering.cluster_means(df, ["a", "b"], 5).collect()]
    by_hand = sum(min((r.a - a) ** 2 + (r.b - b) ** 2 for a, b in centres) for r in rows)
    assert costs[5] == pytest.approx(by_hand, rel=1e-6)
    assert spark.catalog is not None and not spark.sparkContext._jsc.getPersistentRDDs()


def test_an_elbow_reads_the_rows_once_a_step(spark):
    """All k together take one job a step, and the start and the cleaning a few."""
    df, context = blobs(spark), spark.sparkContext
    with clustering.stored_rows(df.select("a", "b").na.drop().distinct()) as rows:
        context.setJobGroup("elbow-scans", "fits for nine k")
        try:
            fitted = clustering.fit_all(rows, range(2, 11), max_iter=7)
            jobs = len(context.statusTracker().getJobIdsForGroup("elbow-scans"))
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
    # With adaptive execution an aggregate is two jobs: the scan and the sum.
    assert sorted(fitted) == list(range(2, 11)) and jobs <= 2 * (7 + 1) + 3
    assert all(len(centres) == k for k, (centres, _) in fitted.items())


def test_an_elbow_finds_groups_that_lie_apart(spark):
    """The same centres as plain averages, whatever the partitions."""
    draw = random.Random(6)
    groups = [(i * 100.0, (i % 3) * 70.0) for i in range(6)]
    points = [(x + draw.random(), y + draw.random()) for x, y in groups for _ in range(200)]
    # A third of the rows in one group.
    points += [(300 + draw.random(), draw.random()) for _ in range(600)]
    df = spark.createDataFrame(points, "a double, b double")
    wanted = sorted(
        (sum(x for x, _ in held) / len(held), sum(y for _, y in held) / len(held))
        for held in (
            [p for p in points if round(p[0] // 100) == i] for i in range(6)
        )
    )
    for parts in (1, 4, 7):
        fitted = clustering.fit_all(df.repartition(parts), [5, 6, 7])
        centres, cost = fitted[6]
        assert [tuple(c) for c in centres[centres[:, 0].argsort()]] == pytest.approx(
            [pytest.approx(c) for c in wanted]
        )
        by_hand = sum(min((a - x) ** 2 + (b - y) ** 2 for x, y in wanted) for a, b in points)
        assert cost == pytest.approx(by_hand) and fitted[5][1] > 10 * cost > 10 * fitted[7][1] * 0.9


def test_partitions_follow_the_size(spark, monkeypatch):
    assert clustering.parts_of(spark.range(100)) == clustering.PARTS
    monkeypatch.setattr(clustering, "ROWS_OF_PART", 10)
    assert clustering.parts_of(spark.range(101)) == 11
    df = blobs(spark).select("a", "b").na.drop()
    found = sorted(map(tuple, clustering.cluster_means(df, ["a", "b"], 5).drop("cluster").collect()))
    monkeypatch.undo()
    few = sorted(map(tuple, clustering.cluster_means(df, ["a", "b"], 5).drop("cluster").collect()))
    assert found == [pytest.approx(centre) for centre in few]


def test_an_elbow_of_few_or_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (5.0, None), (9.0, 2.0)], "a double, b double")
    assert [tuple(r) for r in clustering.elbow(df, ["a", "b"], 1, 3).collect()] == [
        (1, 32.0),
        (2, 0.0),
        (3, 0.0),
    ]
    assert clustering.elbow(df.limit(0), ["a", "b"], 1, 3).count() == 0


def plane_rows(n=400, seed=2):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = draw.gauss(5, 2), draw.uniform(-1, 1) * 100, draw.gauss(0, 0.01)
        rows.append((a, b, c + a / 300, 4.0, 3 * a - 0.05 * b + 200 * c + 7 + draw.gauss(0, 1)))
    return rows + [(None, 1.0, 1.0, 4.0, 1.0), (1.0, 1.0, 1.0, 4.0, None), (1.0, float("nan"), 1.0, 4.0, 0.0)]


@pytest.mark.parametrize("reg, mix", [(0.0, 0.0), (0.3, 0.8), (0.3, 0.0), (1.0, 1.0), (2.0, 0.5)])
def test_a_plane_is_the_librarys(spark, reg, mix):
    names = ["a", "b", "c"]
    df = spark.createDataFrame(plane_rows(), "a double, b double, c double, d double, y double")
    plane = regression.fit_plane(df, names, "y", reg, mix)
    model = regression.fit_line(df, names, "y", reg, mix, max_iter=500)
    assert plane.slopes == pytest.approx(list(model.coefficients), abs=2e-6, rel=1e-6)
    assert plane.intercept == pytest.approx(model.intercept, abs=2e-6, rel=1e-6)
    assert plane.rows == 400
    complete = df.na.drop("any")
    ours = regression.score_plane(complete, plane).orderBy("a").collect()
    theirs = regression.score(complete, names, model).orderBy("a").collect()
    assert [r.prediction for r in ours] == pytest.approx([r.prediction for r in theirs], abs=1e-4)


def test_a_plane_of_one_feature_is_the_line(spark):
    df = spark.createDataFrame(plane_rows(), "a double, b double, c double, d double, y double")
    slope, intercept = regression.fit_by_moments(df, "a", "y")
    plane = regression.fit_plane(df, ["a"], "y")
    assert (*plane.slopes, plane.intercept) == pytest.approx((slope, intercept))


def test_planes_at_the_edges(spark):
    df = spark.createDataFrame(plane_rows(), "a double, b double, c double, d double, y double")
    constant = regression.fit_plane(df, ["a", "d"], "y")
    assert constant.slopes[1] == 0.0
    assert constant.slopes[0] == pytest.approx(regression.fit_plane(df, ["a"], "y").slopes[0])
    flat = regression.fit_plane(df, ["a", "b"], "d")
    assert flat.slopes == (0.0, 0.0) and flat.intercept == 4.0
    twins = df.withColumn("e", F.col("a"))
    assert sum(regression.fit_plane(twins, ["a", "e"], "y").slopes) > 0
    with pytest.raises(ValueError):
        regression.fit_plane(df.limit(0), ["a"], "y")
    with pytest.raises(ValueError):
        regression.fit_plane(df, ["a"] * 31, "y")


def test_a_plane_reads_the_table_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame(plane_rows(), "a double, b double, c double, d double, y double").write.parquet(path)
    spark.sparkContext.setJobGroup("plane", "one aggregate")
    try:
        regression.fit_plane(spark.read.parquet(path), ["a", "b", "c"], "y")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("plane")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Scan and sum of one aggregate.
    assert len(jobs) <= 3


def test_fits_leave_nothing_in_the_shared_folder(spark):
    before = set(Path(shared_folder(spark)).iterdir())
    df = blobs(spark)
    clustering.cluster_means(df, ["a", "b", "c"], 3, ["c"]).collect()
    clustering.labelled_cluster_means(df, ["a", "b"], "LABEL", "Ok", 3).collect()
    clustering.elbow(df, ["a"], 2, 3).collect()
    assert set(Path(shared_folder(spark)).iterdir()) == before


def test_centres_do_not_depend_on_the_session(spark):
    draw = random.Random(1)
    points = [(draw.random(), draw.random()) for _ in range(3000)]
    df = spark.createDataFrame(points, "a double, b double")
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before = {name: spark.conf.get(name) for name in names}
    found = []
    try:
        for parts, adaptive in ((1, "true"), (4, "true"), (7, "false")):
            spark.conf.set(names[0], parts)
            spark.conf.set(names[1], adaptive)
            rows = clustering.cluster_means(df.repartition(parts), ["a", "b"], 6).collect()
            found.append([tuple(round(v, 6) for v in row) for row in rows])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found[0] == found[1] == found[2]


def test_a_fitted_clustering_assigns_new_rows(spark):
    fitted = clustering.cluster(blobs(spark), ["a", "b", "c"], 5, scale_columns=["c"])
    centres = {r["cluster"]: tuple(r)[1:] for r in fitted.centres(blobs(spark)).collect()}
    new = spark.createDataFrame(
        [("x", "-0.8", 1.0, 100.0), ("y", "0.5", 1.5, 850.0), ("z", None, 1.0, 1.0)],
        "name string, a string, b double, c double",
    )
    rows = {r["name"]: r for r in fitted.assign(new).collect()}
    assert sorted(rows) == ["x", "y"]
    for name, blob in (("x", BLOBS[0]), ("y", BLOBS[3])):
        assert close_to([centres[rows[name]["cluster"]]], [blob], (0.02, 0.1, 3.0))
    at_centres = spark.createDataFrame(list(centres.values()), "a double, b double, c double")
    assert fitted.cost(at_centres).first()["cost"] == pytest.approx(0, abs=1e-12)


def test_many_centres(spark):
    draw = random.Random(2)
    df = spark.createDataFrame([(draw.random(), draw.random()) for _ in range(5000)], "a double, b double")
    fitted = clustering.cluster(df, ["a", "b"], 200)
    assert 0 < fitted.cost(df).first()["cost"] < 10
    assert fitted.assign(df).select("cluster").distinct().count() == 200
    with pytest.raises(ValueError):
        clustering.assign(df, ["a", "b"], [(0.0, 0.0)] * 300)


def test_text_input_and_dirty_rows(spark):
    df = blobs(spark).selectExpr("string(a) a", "concat(' ', b) b")
    extra = spark.createDataFrame([("x", "1"), (None, "2")], df.schema)
    found = clustering.cluster_means(df.union(extra), ["a", "b"], 5).drop("cluster").collect()
    assert close_to(found, [(a, b) for a, b, _ in BLOBS], (0.02, 0.1))


def test_steps_match_plain_arithmetic(spark):
    df = blobs(spark).repartition(3)
    rows = [(r.a, r.b) for r in df.select("a", "b").collect()]
    centres = [(-1.0, 0.0), (1.0, 10.0), (0.0, 5.0), (50.0, 50.0)]
    moved = clustering.move_centres(df, ["a", "b"], centres, 2)
    current = centres
    for _ in range(2):
        groups = {}
        for a, b in rows:
            gaps = [(a - x) ** 2 + (b - y) ** 2 for x, y in current]
            groups.setdefault(gaps.index(min(gaps)), []).append((a, b))
        current = [
            tuple(sum(v) / len(v) for v in zip(*groups[i])) if i in groups else c
            for i, c in enumerate(current)
        ]
    for ours, theirs in zip(moved, current):
        assert ours == pytest.approx(theirs)
    assert moved[3] == (50.0, 50.0)
    total = sum(min((a - x) ** 2 + (b - y) ** 2 for x, y in current) for a, b in rows)
    assert clustering.cost(df, ["a", "b"], moved).first()[0] == pytest.approx(total)


def test_ties_go_to_the_lower_cluster(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    found = clustering.assign(df, ["x"], [(0.0,), (2.0,), (4.0,)]).orderBy("x").collect()
    assert [r["cluster"] for r in found] == [0, 1]
    table = clustering.centre_table(df, ["x"], [(1.0,), (5.0,), (5.0,)])
    assert [r["cluster"] for r in clustering.leading_centres(table, "x", 2).collect()] == [1, 2]


def test_scaling_equals_the_library_scaler(spark):
    df = blobs(spark).withColumn("fixed", F.lit(3.0))
    ours = scaling.minmax_scale(df, ["c", "fixed"])
    assembled = VectorAssembler(inputCols=["c", "fixed"], outputCol="v").transform(ours)
    scaler = MinMaxScaler(min=-1, max=1, inputCol="v", outputCol="s").fit(assembled)
    theirs = scaler.transform(assembled).withColumn("s", vector_to_array("s"))
    worst = theirs.agg(
        F.max(F.abs(F.col("s")[0] - F.col("c_scaled"))),
        F.max(F.abs(F.col("s")[1] - F.col("fixed_scaled"))),
    ).first()
    assert worst[0] < 1e-12 and worst[1] == 0.0
    bounds = scaling.fit_bounds(df, ["c"])["c"]
    back = scaling.unscaled(F.col("c_scaled"), bounds, -1.0, 1.0)
    assert ours.agg(F.max(F.abs(back - F.col("c")))).first()[0] < 1e-9


def own_points(n=40, seed=9):
    """A noisy rising line."""
    draw = random.Random(seed)
    return [(x / 4, 1.5 * x / 4 - 2 + draw.gauss(0, 0.3)) for x in range(n)]


def closed_form(points, reg=0.3, mix=0.8):
    n = len(points)
    mx, my = (sum(p[i] for p in points) / n for i in (0, 1))
    sx, sy = (sum((p[i] - m) ** 2 for p in points) ** 0.5 / n**0.5 for i, m in ((0, mx), (1, my)))
    r = sum((x - mx) * (y - my) for x, y in points) / n / sx / sy
    slope = (r - reg * mix / sy) / (1 + reg * (1 - mix) / sy) * sy / sx
    return slope, my - slope * mx


def test_line(spark):
    points = own_points()
    df = spark.createDataFrame(points + [(None, 1.0)], "X double, label double")
    model = regression.fit_line(df, ["X"], "label")
    slope, intercept = regression.line_parameters(df, model).first()
    assert (slope, intercept) == pytest.approx(closed_form(points), abs=1e-8)
    assert tuple(regression.fit_one(df, "X", "label").first()) == pytest.approx(
        (slope, intercept), abs=1e-8
    )
    by_moments = regression.fit_by_moments(df, "X", "label")
    assert by_moments == pytest.approx((slope, intercept), abs=1e-8)
    assert model.summary.predictions.count() == len(points)
    new = spark.createDataFrame([(-1.25,), (2.5,), (11.0,)], "X double")
    scored = regression.score(new, ["X"], model).collect()
    assert [r["prediction"] for r in scored] == pytest.approx(
        [slope * x + intercept for x in (-1.25, 2.5, 11.0)]
    )
    plain = regression.score_line(new, "X", slope, intercept).collect()
    assert [r["prediction"] for r in plain] == pytest.approx([r["prediction"] for r in scored])


def test_moments_at_the_edges(spark):
    flat = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "x double, y double")
    assert regression.fit_by_moments(flat, "x", "y") == (0.0, 5.0)
    with pytest.raises(ValueError):
        regression.fit_by_moments(flat.filter("x > 9"), "x", "y")
    falling = spark.createDataFrame([(1.0, 9.0), (2.0, 5.0), (4.0, 1.0)], "x double, y double")
    model = regression.fit_line(falling, ["x"], "y")
    wanted = (model.coefficients[0], model.intercept)
    assert regression.fit_by_moments(falling, "x", "y") == pytest.approx(wanted, abs=1e-6)


def test_a_fit_deals_its_rows_once(spark, monkeypatch):
    seen, lay = spark.sparkContext.accumulator(0), clustering.fixed_layout
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def laid(rows, columns, parts):
        dealt = lay(rows, columns, parts)
        return dealt.mapInArrow(counted, dealt.schema)

    df = spark.range(600).select((F.col("id") % 3 * 100 + F.col("id") / 600).alias("a"), F.col("id").cast("double").alias("b"))
    plain = clustering.cluster(df, ["a", "b"], 3, scale_columns=["b"])
    monkeypatch.setattr(clustering, "fixed_layout", laid)
    found = clustering.cluster(df, ["a", "b"], 3, scale_columns=["b"])
    assert seen.value == 600
    assert found.bounds == plain.bounds == {"b": (0.0, 599.0)} and found.raw_centres() == plain.raw_centres()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= kept
