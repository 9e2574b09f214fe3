"""Scaling, clustering and line fitting over the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import centres, clustering, regression
from millrace.operators.cleaning import keyed_split, split_side
from millrace.operators.scaling import fit_bounds, minmax_scale, unscaled
from millrace.sources.tables import inline, table

# Starting centres on (p_size, p_retailprice) for the fixed-start queries.
START = [(5.0, 910.0), (25.0, 950.0), (45.0, 990.0)]
AXES = ["p_size", "p_retailprice"]
STEPS = 3


def minmax_scaled(spark: SparkSession, folder: str) -> DataFrame:
    rows = minmax_scale(table(spark, folder, "orders"), ["o_totalprice"])
    return rows.select("o_orderkey", F.round("o_totalprice_scaled", 6).alias("scaled"))


def unscaled_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    bounds = fit_bounds(orders, ["o_totalprice"])
    rows = minmax_scale(orders, ["o_totalprice"], bounds=bounds)
    back = unscaled(F.col("o_totalprice_scaled"), bounds["o_totalprice"], -1.0, 1.0)
    back = F.round(back, 2)
    return rows.select("o_orderkey", back.alias("price"))


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part")


def lloyd_step(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster sizes and means after three steps from fixed centres."""
    parts = _parts(spark, folder)
    before_last = clustering.move_centres(parts, AXES, START, STEPS - 1)
    return clustering.centre_step(parts, AXES, before_last).select(
        "cluster", "n", *[F.round(c, 4).alias(c) for c in AXES]
    )


def wssse(spark: SparkSession, folder: str) -> DataFrame:
    parts = _parts(spark, folder)
    centres = clustering.move_centres(parts, AXES, START, STEPS)
    return clustering.cost(parts, AXES, centres).select(F.round("cost", 2).alias("cost"))


def nearest_centre(spark: SparkSession, folder: str) -> DataFrame:
    """Every part with the starting centre it is nearest to."""
    return clustering.assign(_parts(spark, folder), AXES, START).select("p_partkey", "cluster")


def leading_centres(spark: SparkSession, folder: str) -> DataFrame:
    """The two of the moved centres with the highest mean price."""
    parts = _parts(spark, folder)
    centres = clustering.move_centres(parts, AXES, START, STEPS)
    moved = clustering.centre_table(parts, AXES, centres)
    return clustering.leading_centres(moved, "p_retailprice", 2).select(
        "cluster", *[F.round(c, 4).alias(c) for c in AXES]
    )


def stretched_centres(spark: SparkSession, folder: str) -> DataFrame:
    """The moved centres with their prices stretched to the prices' limits."""
    parts = _parts(spark, folder)
    centres = clustering.move_centres(parts, AXES, START, STEPS)
    table_of_centres = clustering.centre_table(parts, AXES, centres)
    bounds = fit_bounds(parts, ["p_retailprice"])
    return clustering.stretch(table_of_centres, bounds).select(
        "cluster", *[F.round(c, 4).alias(c) for c in AXES]
    )


# Every part is a centre, every order a point.
def _many_centres(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.dayofmonth("o_orderdate").alias("a"),
        (F.col("o_totalprice") / 300).alias("b"),
        (F.month("o_orderdate") * 4).alias("c"),
    )
    parts = _parts(spark, folder).select(
        F.col("p_partkey").alias("cluster"),
        F.col("p_size").alias("a"),
        F.col("p_retailprice").alias("b"),
        F.length("p_name").alias("c"),
    )
    return orders, parts


def centre_table_assigned(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with the part it is nearest to."""
    orders, parts = _many_centres(spark, folder)
    return centres.assign_from(orders, ["a", "b", "c"], parts).select("o_orderkey", "cluster")


def centre_blocks_assigned(spark: SparkSession, folder: str) -> DataFrame:
    """The same with parts in cells of about five hundred, as a table too large for every task is."""
    orders, parts = _many_centres(spark, folder)
    found = centres.assign_from(orders, ["a", "b", "c"], parts, most_numbers=2_000)
    return found.select("o_orderkey", "cluster")


def centre_table_cost(spark: SparkSession, folder: str) -> DataFrame:
    orders, parts = _many_centres(spark, folder)
    cost = centres.cost_from(orders, ["a", "b", "c"], parts)
    return cost.select(F.round("cost", 2).alias("cost"))


def cluster_means_2d(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster_means(_parts(spark, folder), AXES, 5)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_discount").alias("a"),
        F.col("l_tax").alias("b"),
        F.col("l_extendedprice").alias("c"),
    )


def cluster_means_3d(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster_means(_lines(spark, folder), ["a", "b", "c"], 5, scale_columns=["c"])


def cluster_means_3d_refit(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster_means(
        _lines(spark, folder), ["a", "b", "c"], 5, scale_columns=["c"], unscale="refit"
    )


def labelled_means(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.labelled_cluster_means(
        _parts(spark, folder), AXES, "p_type", good="ECONOMY", k=5
    )


def elbow(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.elbow(_parts(spark, folder), AXES, 2, 10)


# Orders fall into five groups that lie far apart, by the number of their
# priority. A clustering then has to find the groups, and its centres are plain
# averages.
def _grouped_orders(spark: SparkSession, folder: str) -> DataFrame:
    number = F.substring("o_orderpriority", 1, 1).cast("double")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        number.alias("number"),
        (number * 1000 + F.col("o_totalprice") / 100_000).alias("a"),
        ((number % 3) * 500 + F.col("o_custkey") % 10).cast("double").alias("b"),
        (number * number * 70 + F.col("o_orderkey") % 7).cast("double").alias("c"),
    )


def _sorted_out(centres: DataFrame, columns: list[str]) -> DataFrame:
    """Centres without their numbers, which are arbitrary."""
    return centres.select(*[F.round(c, 4).alias(c) for c in columns])


def group_centres_2d(spark: SparkSession, folder: str) -> DataFrame:
    orders = _grouped_orders(spark, folder)
    return _sorted_out(clustering.cluster_means(orders, ["a", "b"], 5), ["a", "b"])


def group_centres_3d(spark: SparkSession, folder: str) -> DataFrame:
    orders, axes = _grouped_orders(spark, folder), ["a", "b", "c"]
    return _sorted_out(clustering.cluster_means(orders, axes, 5, scale_columns=["c"]), axes)


def group_centres_refit(spark: SparkSession, folder: str) -> DataFrame:
    orders, axes = _grouped_orders(spark, folder), ["a", "b", "c"]
    refit = clustering.cluster_means(orders, axes, 5, scale_columns=["c"], unscale="refit")
    return _sorted_out(refit, axes)


def labelled_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The centres of the two groups whose label does not say so: 2-HIGH and 1-URGENT are bad."""
    orders = _grouped_orders(spark, folder).withColumn(
        "label", F.when(F.col("number") <= 2, "bad").otherwise("fine")
    )
    best = clustering.labelled_cluster_means(orders, ["a", "b"], "label", good="fine", k=5)
    return _sorted_out(best, ["a", "b"])


def assigned_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by the fitted clustering's choice: one priority each."""
    orders = _grouped_orders(spark, folder)
    fitted = clustering.cluster(orders, ["a", "b"], 5)
    return (
        fitted.assign(orders)
        .groupBy("cluster")
        .agg(
            F.min("o_orderpriority").alias("lowest"),
            F.max("o_orderpriority").alias("highest"),
            F.count("*").alias("n"),
        )
        .drop("cluster")
    )


def group_cost(spark: SparkSession, folder: str) -> DataFrame:
    """The elbow where its bend is known: the cost falls to the spread within the groups."""
    costs = clustering.elbow(_grouped_orders(spark, folder), ["a", "b"], 4, 6)
    low, bend, after = (F.max(F.when(F.col("k") == k, F.col("cost"))) for k in (4, 5, 6))
    return costs.agg(
        F.round(bend, 2).alias("cost"),
        (low > 10 * bend).alias("falls_before"),
        (after > 0.2 * bend).alias("flat_after"),
    )


def _priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y")
    )


def _rounded(line: DataFrame) -> DataFrame:
    return line.select(*[F.round(c, 3).alias(c) for c in ("slope", "intercept")])


def linear_fit(spark: SparkSession, folder: str) -> DataFrame:
    rows = _priced_lines(spark, folder)
    return _rounded(regression.fit_one(rows, "x", "y"))


def linear_fit_moments(spark: SparkSession, folder: str) -> DataFrame:
    rows = _priced_lines(spark, folder)
    return _rounded(inline(spark, [regression.fit_by_moments(rows, "x", "y")], regression.LINE))


def holdout_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on 70 % of the orders, then the error on both sides of the split."""
    rows = _priced_lines(spark, folder)
    training, _ = keyed_split(rows, ["l_orderkey"], 0.7)
    slope, intercept = regression.fit_by_moments(training, "x", "y")
    part = F.when(split_side(["l_orderkey"], 0.7), "training").otherwise("test")
    gap = F.col("prediction") - F.col("y")
    return (
        regression.score_line(rows.withColumn("part", part), "x", slope, intercept)
        .groupBy("part")
        .agg(F.count("*").alias("n"), F.round(F.sqrt(F.avg(gap * gap)), 3).alias("rmse"))
    )


def linear_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Prediction and sum of the label for every quantity."""
    rows = _priced_lines(spark, folder)
    line = regression.fit_by_moments(rows, "x", "y")
    return (
        regression.score_line(rows, "x", *line)
        .groupBy("x")
        .agg(
            F.count("*").alias("n"),
            F.round(F.sum("y"), 2).alias("total_y"),
            F.round(F.avg("prediction"), 3).alias("prediction"),
        )
    )


def in_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Count and sums over the fit's own predictions for its training rows."""
    model = regression.fit_line(_priced_lines(spark, folder), ["x"], "y")
    predictions = model.summary.predictions
    return predictions.agg(
        F.count("*").alias("n"),
        F.round(F.avg("label"), 3).alias("mean_label"),
        F.round(F.avg("prediction"), 3).alias("mean_prediction"),
    )


def new_points(spark: SparkSession, folder: str) -> DataFrame:
    """The fitted line at quantities that no row has."""
    line = regression.fit_by_moments(_priced_lines(spark, folder), "x", "y")
    points = inline(spark, [(0.25,), (17.5,), (120.0,)], "x double")
    scored = regression.score_line(points, "x", *line)
    return scored.select("x", F.round("prediction", 3).alias("prediction"))


# What a line brings in after its discount, by price and discount.
REVENUE = ["x1", "x2"]


def _revenues(spark: SparkSession, folder: str) -> DataFrame:
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, folder, "lineitem").select(
        price.alias("x1"), discount.alias("x2"), (price * (1 - discount)).alias("y")
    )


def plane_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Slopes and intercept of a fit with two features."""
    plane = regression.fit_plane(_revenues(spark, folder), REVENUE, "y")
    row = (*plane.slopes, plane.intercept)
    found = inline(spark, [row], "slope_1 double, slope_2 double, intercept double")
    return found.select(
        F.round("slope_1", 6).alias("slope_1"), *[F.round(c, 3).alias(c) for c in found.columns[1:]]
    )


def plane_error(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and error of that fit over its own rows."""
    rows = _revenues(spark, folder)
    scored = regression.score_plane(rows, regression.fit_plane(rows, REVENUE, "y"))
    gap = F.col("prediction") - F.col("y")
    return scored.agg(F.count("*").alias("n"), F.round(F.sqrt(F.avg(gap * gap)), 3).alias("rmse"))


SCALED = """
SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo) * 2 - 1, 6) AS scaled
FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
"""


def _nearest(centres: str) -> str:
    distance = "(p_size - a) * (p_size - a) + (p_retailprice - b) * (p_retailprice - b)"
    return f"""
SELECT p_partkey, p_size, p_retailprice, cluster, d FROM (
  SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY d, cluster) AS place
  FROM (SELECT *, {distance} AS d FROM part, {centres})
) WHERE place = 1
"""


_START = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(START))
STEPPED = f"WITH c0(cluster, a, b) AS (VALUES {_START})" + "".join(
    f""", m{i} AS (
  SELECT cluster, avg(p_size) AS a, avg(p_retailprice) AS b, count(*) AS n
  FROM ({_nearest(f"c{i - 1}")}) GROUP BY 1
), c{i} AS (
  SELECT cluster, coalesce(m{i}.a, c{i - 1}.a) AS a, coalesce(m{i}.b, c{i - 1}.b) AS b
  FROM c{i - 1} LEFT JOIN m{i} USING (cluster)
)"""
    for i in range(1, STEPS + 1)
)

LLOYD = (
    STEPPED
    + f"""
SELECT cluster, n, round(a, 4) AS p_size, round(b, 4) AS p_retailprice FROM m{STEPS}
"""
)
WSSSE = STEPPED + f"SELECT round(sum(d), 2) AS cost FROM ({_nearest(f'c{STEPS}')})"
NEAREST = STEPPED + f"SELECT p_partkey, cluster FROM ({_nearest('c0')})"
MANY_CENTRES = """
WITH best AS (
  SELECT o_orderkey, min({'gap': (a - x) * (a - x) + (b - y) * (b - y) + (c - z) * (c - z),
                          'cluster': p_partkey}) AS best
  FROM (SELECT o_orderkey, day(o_orderdate) AS a, o_totalprice / 300 AS b,
               month(o_orderdate) * 4 AS c FROM orders),
       (SELECT p_partkey, p_size AS x, p_retailprice AS y, length(p_name) AS z FROM part)
  GROUP BY o_orderkey
)
"""
MANY_ASSIGNED = MANY_CENTRES + "SELECT o_orderkey, CAST(best.cluster AS BIGINT) AS cluster FROM best"
MANY_COST = MANY_CENTRES + "SELECT round(sum(best.gap), 2) AS cost FROM best"
LEADING = (
    STEPPED
    + f"""
SELECT cluster, round(a, 4) AS p_size, round(b, 4) AS p_retailprice
FROM c{STEPS} ORDER BY b DESC, cluster LIMIT 2
"""
)

STRETCHED = (
    STEPPED
    + f"""
SELECT cluster, round(a, 4) AS p_size,
       round((b - lowest) / (highest - lowest) * (most - least) + least, 4) AS p_retailprice
FROM c{STEPS}, (SELECT min(b) AS lowest, max(b) AS highest FROM c{STEPS}),
     (SELECT min(p_retailprice) AS least, max(p_retailprice) AS most FROM part)
"""
)

# The elastic net with one feature has a closed form: the correlation, pulled
# towards zero by the first penalty and shrunk by the second.
LINE = """
WITH rows AS (SELECT l_orderkey, l_quantity AS x, l_extendedprice AS y FROM lineitem),
chosen AS (SELECT * FROM rows {where}),
stats AS (
  SELECT corr(x, y) AS r, stddev_pop(x) AS sx, stddev_pop(y) AS sy,
         avg(x) AS mx, avg(y) AS my, 0.3 AS reg, 0.8 AS mix
  FROM chosen
), line AS (
  SELECT slope, my - slope * mx AS intercept FROM (
    SELECT *, sign(r) * greatest(abs(r) - reg * mix / sy, 0)
              / (1 + reg * (1 - mix) / sy) * sy / sx AS slope
    FROM stats
  )
)
"""
ALL_LINE = LINE.format(where="")
TRAINING = "md5('0|' || CAST(l_orderkey AS VARCHAR)) < 'b3333333'"

GROUPED = """
WITH numbered AS (
  SELECT *, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS number FROM orders
), grouped AS (
  SELECT o_orderpriority, number, number * 1000 + o_totalprice / 100000 AS a,
         CAST(number % 3 * 500 + o_custkey % 10 AS DOUBLE) AS b,
         CAST(number * number * 70 + o_orderkey % 7 AS DOUBLE) AS c
  FROM numbered
)
"""
# Repeated rows count once in a clustering.
CENTRES_2D = GROUPED + """
SELECT round(avg(a), 4) AS a, round(avg(b), 4) AS b
FROM (SELECT DISTINCT number, a, b FROM grouped) {where} GROUP BY number
"""
CENTRES_3D = GROUPED + """
SELECT round(avg(a), 4) AS a, round(avg(b), 4) AS b, round(avg(c), 4) AS c
FROM (SELECT DISTINCT number, a, b, c FROM grouped) GROUP BY number
"""
CENTRES_REFIT = GROUPED + """
, centres AS (
  SELECT avg(a) AS a, avg(b) AS b, avg(c) AS c
  FROM (SELECT DISTINCT number, a, b, c FROM grouped) GROUP BY number
)
SELECT round(a, 4) AS a, round(b, 4) AS b,
       round((c - lowest) / (highest - lowest) * (most - least) + least, 4) AS c
FROM centres, (SELECT min(c) AS lowest, max(c) AS highest FROM centres),
     (SELECT min(c) AS least, max(c) AS most FROM grouped)
"""
ASSIGNED = GROUPED + """
SELECT o_orderpriority AS lowest, o_orderpriority AS highest, count(*) AS n
FROM grouped GROUP BY o_orderpriority
"""
GROUP_COST = GROUPED + """
, points AS (SELECT DISTINCT number, a, b FROM grouped)
SELECT round(sum((a - ma) * (a - ma) + (b - mb) * (b - mb)), 2) AS cost,
       true AS falls_before, true AS flat_after
FROM points JOIN (SELECT number, avg(a) AS ma, avg(b) AS mb FROM points GROUP BY 1) USING (number)
"""

FIT = ALL_LINE + "SELECT round(slope, 3) AS slope, round(intercept, 3) AS intercept FROM line"

HOLDOUT = (
    LINE.format(where=f"WHERE {TRAINING}")
    + f"""
SELECT CASE WHEN {TRAINING} THEN 'training' ELSE 'test' END AS part, count(*) AS n,
       round(sqrt(avg((slope * x + intercept - y) * (slope * x + intercept - y))), 3) AS rmse
FROM rows, line GROUP BY 1
"""
)

SCORES = (
    ALL_LINE
    + """
SELECT x, count(*) AS n, round(sum(y), 2) AS total_y,
       round(avg(slope * x + intercept), 3) AS prediction
FROM rows, line GROUP BY x
"""
)

IN_SAMPLE = (
    ALL_LINE
    + """
SELECT count(*) AS n, round(avg(y), 3) AS mean_label,
       round(avg(slope * x + intercept), 3) AS mean_prediction
FROM rows, line
"""
)

POINTS = (
    ALL_LINE
    + """
SELECT CAST(p AS DOUBLE) AS x, round(slope * p + intercept, 3) AS prediction
FROM line, (VALUES (0.25), (17.5), (120.0)) AS points(p)
"""
)

# Both slopes are far from zero, so the signs of the correlations are theirs, and
# the fit solves two linear equations.
PLANE = """
WITH rows AS (
  SELECT l_extendedprice AS x1, l_discount AS x2, l_extendedprice * (1 - l_discount) AS y FROM lineitem
), stats AS (
  SELECT corr(x1, y) AS r1, corr(x2, y) AS r2, corr(x1, x2) AS r, stddev_pop(x1) AS s1,
         stddev_pop(x2) AS s2, stddev_pop(y) AS sy, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my
  FROM rows
), pulls AS (
  SELECT *, r1 - sign(r1) * 0.24 / sy AS t1, r2 - sign(r2) * 0.24 / sy AS t2,
         1 + 0.3 * (1 - 0.8) / sy AS d
  FROM stats
), plane AS (
  SELECT *, (d * t1 - r * t2) / (d * d - r * r) * sy / s1 AS slope_1,
         (d * t2 - r * t1) / (d * d - r * r) * sy / s2 AS slope_2
  FROM pulls
), whole AS (SELECT slope_1, slope_2, my - slope_1 * m1 - slope_2 * m2 AS intercept FROM plane)
"""
PLANE_FIT = PLANE + """
SELECT round(slope_1, 6) AS slope_1, round(slope_2, 3) AS slope_2, round(intercept, 3) AS intercept
FROM whole
"""
PLANE_ERROR = PLANE + """
SELECT count(*) AS n, round(sqrt(avg(pow(slope_1 * x1 + slope_2 * x2 + intercept - y, 2))), 3) AS rmse
FROM rows, whole
"""

QUERIES = {
    "minmax_scaled": (minmax_scaled, SCALED),
    "unscaled_roundtrip": (
        unscaled_roundtrip,
        "SELECT o_orderkey, o_totalprice AS price FROM orders",
    ),
    "lloyd_step": (lloyd_step, LLOYD),
    "wssse": (wssse, WSSSE),
    "nearest_centre": (nearest_centre, NEAREST),
    "stretched_centres": (stretched_centres, STRETCHED),
    "leading_centres": (leading_centres, LEADING),
    "centre_table_assigned": (centre_table_assigned, MANY_ASSIGNED),
    "centre_blocks_assigned": (centre_blocks_assigned, MANY_ASSIGNED),
    "centre_table_cost": (centre_table_cost, MANY_COST),
    "cluster_means_2d": (cluster_means_2d, None),
    "cluster_means_3d": (cluster_means_3d, None),
    "cluster_means_3d_refit": (cluster_means_3d_refit, None),
    "labelled_means": (labelled_means, None),
    "elbow": (elbow, None),
    "group_centres_2d": (group_centres_2d, CENTRES_2D.format(where="")),
    "group_centres_3d": (group_centres_3d, CENTRES_3D),
    "group_centres_refit": (group_centres_refit, CENTRES_REFIT),
    "labelled_groups": (labelled_groups, CENTRES_2D.format(where="WHERE number <= 2")),
    "assigned_groups": (assigned_groups, ASSIGNED),
    "group_cost": (group_cost, GROUP_COST),
    "linear_fit": (linear_fit, FIT),
    "linear_fit_moments": (linear_fit_moments, FIT),
    "plane_fit": (plane_fit, PLANE_FIT),
    "plane_error": (plane_error, PLANE_ERROR),
    "holdout_fit": (holdout_fit, HOLDOUT),
    "linear_scores": (linear_scores, SCORES),
    "linear_in_sample": (in_sample, IN_SAMPLE),
    "linear_new_points": (new_points, POINTS),
}
