"""K-means jobs: fitted clusterings, centres, labelled centres, costs, elbow, fixed-start steps.

Fits read their rows many times, so the cleaned rows are written once to the
shared folder and deleted after the fit; a lost executor costs a re-read, not a
second cleaning. The random start of k-means depends on how rows lie in
partitions, so every fit deals them anew by their values over a fixed number of
partitions and sorts them there: equal rows give equal centres whatever the
cluster and its shuffle settings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import label_flag, to_double
from millrace.operators.centres import nearest_rows
from millrace.operators.cleaning import clean_numeric
from millrace.operators.scaling import Bounds, fit_bounds, scaled, unscaled
from millrace.session import fresh_path, remove_path

Centre = tuple[float, ...]

# Partitions of a fit: so many at least, and one for so many rows of a large table.
# They depend on the rows alone; other numbers start elsewhere.
PARTS = 8
ROWS_OF_PART = 500_000
# Centres times axes that may travel as literals of an expression.
MOST_LITERALS = 512
# Rows on which the centres of an elbow start, those among them that seeds are drawn
# from, and draws and steps.
START_ROWS = 10_000
START_DRAWN = 2_000
START_DRAWS = 4
START_STEPS = 20


@contextmanager
def stored_rows(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows as a table in the shared folder, deleted at the end.

    Everything that reads them has to run inside.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, "features")
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        remove_path(spark, path)


def parts_of(rows: DataFrame) -> int:
    """Partitions for a stored table, whose rows its files' footers count."""
    return max(PARTS, math.ceil(rows.count() / ROWS_OF_PART))


def fixed_layout(rows: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """Rows dealt by value over ``parts`` partitions, sorted in each."""
    return rows.repartition(parts, *columns).sortWithinPartitions(*columns)


@dataclass
class Clustering:
    """A fitted clustering: scaler, assembler and k-means in one pipeline."""

    columns: list[str]
    bounds: Bounds
    model: PipelineModel

    @property
    def axes(self) -> list[str]:
        """The columns in the order of the feature vector, scaled ones last."""
        return [c for c in self.columns if c not in self.bounds] + list(self.bounds)

    def raw_centres(self) -> list[Centre]:
        """Centres in feature space: k rows on the driver."""
        return [tuple(map(float, c)) for c in self.model.stages[-1].clusterCenters()]

    def centres(self, df: DataFrame, unscale: str = "inverse") -> DataFrame:
        """Cluster number and centre, in the units of the columns.

        A scaled column is brought back by the inverse of its scaling. With
        ``unscale="refit"`` the centres are instead stretched so that the
        smallest and the largest one land on the column's minimum and maximum.
        ``df`` only names the session.
        """
        table = centre_table(df, self.axes, self.raw_centres())
        if unscale == "refit":
            table = stretch(table, self.bounds)
        else:
            back = {c: unscaled(F.col(c), b, -1.0, 1.0) for c, b in self.bounds.items()}
            table = table.withColumns(back) if back else table
        return table.select("cluster", *self.columns)

    def assign(self, df: DataFrame) -> DataFrame:
        """The rows with the ``cluster`` each belongs to.

        The columns are read as numbers, as in the fit; rows where one is
        missing or no number are left out. Any table that has them will do.
        """
        return self._transformed(df).select(*df.columns, "cluster")

    def cost(self, df: DataFrame) -> DataFrame:
        """One row: the sum of squared distances to the own centre, in feature space."""
        centres = F.lit([list(c) for c in self.raw_centres()])
        own = F.element_at(centres, F.col("cluster") + 1)
        gaps = F.zip_with(vector_to_array("features"), own, lambda x, y: (x - y) * (x - y))
        squared = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)
        return self._transformed(df).agg(F.sum(squared).alias("cost"))

    def _transformed(self, df: DataFrame) -> DataFrame:
        numbers = {f"axis_{i}": to_double(F.col(c)) for i, c in enumerate(self.columns)}
        rows = df.withColumns(numbers).na.drop("any", subset=list(numbers))
        return self.model.transform(rows)


def fit_clustering(
    rows: DataFrame,
    columns: list[str],
    k: int,
    scale_columns: Sequence[str] = (),
    seed: int = 1,
    parts: int | None = None,
) -> Clustering:
    """Fit k-means to rows whose columns are complete numbers.

    ``scale_columns`` are mapped to [-1, 1] first. The rows are read as often as
    the fit needs them; give it a stored table. ``parts`` follows its size by
    default (``parts_of``).
    """
    name = {c: f"axis_{i}" for i, c in enumerate(columns)}
    laid = fixed_layout(rows, columns, parts or parts_of(rows)).withColumns(
        {axis: F.col(c).cast("double") for c, axis in name.items()}
    )
    stages = []
    inputs = [name[c] for c in columns if c not in scale_columns]
    if scale_columns:
        unscaled_axes = [name[c] for c in scale_columns]
        assembler = VectorAssembler(inputCols=unscaled_axes, outputCol="unscaled")
        scaler = MinMaxScaler(min=-1.0, max=1.0, inputCol="unscaled", outputCol="scaled")
        # Bounds depend on no layout, so they are read off the rows before these are dealt.
        read = rows.select(*[F.col(c).cast("double").alias(name[c]) for c in scale_columns])
        stages = [assembler, scaler.fit(assembler.transform(read))]
        inputs.append("scaled")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    stages.append(KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster"))
    # The library reads them several times before and after it holds its own copy;
    # kept on disk they are dealt and sorted once.
    laid.persist(StorageLevel.DISK_ONLY)
    try:
        model = Pipeline(stages=stages).fit(laid)
    finally:
        laid.unpersist()
    bounds: Bounds = {}
    if scale_columns:
        scaler = model.stages[1]
        bounds = dict(zip(scale_columns, zip(scaler.originalMin, scaler.originalMax)))
    return Clustering(list(columns), bounds, model)


def cluster(
    df: DataFrame,
    columns: list[str],
    k: int,
    scale_columns: Sequence[str] = (),
    seed: int = 1,
    parts: int | None = None,
) -> Clustering:
    """Clean the columns and cluster them; repeated rows count once."""
    with stored_rows(clean_numeric(df.select(*columns), columns)) as rows:
        return fit_clustering(rows, columns, k, scale_columns, seed, parts)


def centre_table(df: DataFrame, columns: Sequence[str], centres: Sequence[Centre]) -> DataFrame:
    schema = "cluster int, " + ", ".join(f"`{c}` double" for c in columns)
    rows = [(i, *centre) for i, centre in enumerate(centres)]
    return df.sparkSession.createDataFrame(rows, schema)


def cluster_means(
    df: DataFrame,
    columns: list[str],
    k: int,
    scale_columns: Sequence[str] = (),
    seed: int = 1,
    unscale: str = "inverse",
    parts: int | None = None,
) -> DataFrame:
    """Clean the columns, cluster them and return the centres in their own units.

    ``unscale`` as in ``Clustering.centres``.
    """
    if unscale not in ("inverse", "refit"):
        raise ValueError("unscale is 'inverse' or 'refit'")
    return cluster(df, columns, k, scale_columns, seed, parts).centres(df, unscale)


def stretch(centres: DataFrame, bounds: Bounds) -> DataFrame:
    """Map the range the centres span on each column onto the given bounds."""
    if not bounds:
        return centres
    spans = fit_bounds(centres, list(bounds))
    return centres.withColumns({c: scaled(F.col(c), spans[c], *b) for c, b in bounds.items()})


def labelled_cluster_means(
    df: DataFrame,
    columns: list[str],
    label: str,
    good: str,
    k: int,
    top: int = 2,
    seed: int = 1,
    parts: int | None = None,
) -> DataFrame:
    """Cluster on the columns and a 0/1 label; the centres with most 1-labels.

    Rows without a label are dropped with the other incomplete rows.
    """
    flagged = df.select(*columns, label).withColumn("flag", label_flag(F.col(label), good))
    axes = [*columns, "flag"]
    with stored_rows(clean_numeric(flagged, axes)) as rows:
        fitted = fit_clustering(rows, axes, k, seed=seed, parts=parts)
    return leading_centres(fitted.centres(df), "flag", top).select(*columns)


def leading_centres(centres: DataFrame, axis: str, n: int) -> DataFrame:
    """The ``n`` centres largest on one axis, equal ones in cluster order."""
    return centres.orderBy(F.desc(axis), "cluster").limit(n)


def _starts(rows: DataFrame, ks: Sequence[int], seed: int) -> dict[int, np.ndarray]:
    """Centres to start from for every k, found on ``START_ROWS`` rows.

    They are the rows with the least digests, so the choice depends on the values
    alone. Seeds are drawn far from each other, and the best of a few draws, each
    improved on these rows, is taken.
    """
    digest = F.xxhash64(F.lit(seed), *rows.columns)
    drawn = rows.orderBy(digest, *rows.columns).limit(START_ROWS).toArrow()
    points = np.column_stack([drawn.column(c).to_numpy() for c in rows.columns])
    few, draw = points[:START_DRAWN], np.random.default_rng(seed)
    starts: dict[int, tuple[float, np.ndarray]] = {}
    for _ in range(START_DRAWS):
        seeds = _seeds(few, max(ks), draw)
        for k in ks:
            centres = _settled(few, seeds[:k])
            cost = _partial_sums(few, centres)[:, 1].sum()
            if k not in starts or cost < starts[k][0]:
                starts[k] = cost, centres
    return {k: _settled(points, centres) for k, (_, centres) in starts.items()}


def _settled(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The centres after some steps over these points."""
    for _ in range(START_STEPS):
        found = _partial_sums(points, centres)
        moved = _moved(centres, found[:, 0], found[:, 2:])
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def _seeds(points: np.ndarray, count: int, draw: np.random.Generator) -> np.ndarray:
    """Different rows, each drawn by its squared distance to those drawn before."""
    chosen = [int(draw.integers(len(points)))]
    gaps = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < count and gaps.sum() > 0:
        tries = draw.choice(len(points), size=4, p=gaps / gaps.sum())
        offers = [np.minimum(gaps, ((points - points[i]) ** 2).sum(axis=1)) for i in tries]
        best = min(range(len(tries)), key=lambda i: offers[i].sum())
        chosen.append(int(tries[best]))
        gaps = offers[best]
    return points[chosen]


def _summing():
    """The function that tasks call; a nested one travels by value."""
    find = nearest_rows

    def partial_sums(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """For each centre the points nearest to it, their cost and the sums of their axes."""
        number, gap = find(points, np.arange(len(centres)), centres)
        weights = [np.ones(len(points)), gap, *points.T]
        return np.column_stack([np.bincount(number, w, len(centres)) for w in weights])

    return partial_sums


_partial_sums = _summing()


def _moved(centres: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The means; a centre without points stays."""
    held = counts > 0
    means = sums / np.where(held, counts, 1)[:, None]
    return np.where(held[:, None], means, centres)


def _sums_for_all(rows: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """``_partial_sums`` of the whole table for every k, from one scan.

    Each task sends one row for each centre of each k; so many rows in the end.
    """
    names = ["n", "cost", *[f"axis_{i}" for i in range(len(rows.columns))]]
    columns, partial_sums = rows.columns, _partial_sums

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros((len(held), len(names))) for k, held in centres.items()}
        for batch in batches:
            points = np.column_stack([batch.column(c).to_numpy() for c in columns])
            for k, held in centres.items():
                totals[k] += partial_sums(points, held)
        sizes = [len(total) for total in totals.values()]
        whole = np.concatenate(list(totals.values()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(list(totals), sizes), pa.int64()),
                pa.array(np.concatenate([np.arange(size) for size in sizes]), pa.int64()),
                *[pa.array(column) for column in whole.T],
            ],
            names=["k", "cluster", *names],
        )

    schema = "k bigint, cluster bigint, " + ", ".join(f"{name} double" for name in names)
    partial = rows.mapInArrow(add_up, schema)
    added = partial.groupBy("k", "cluster").agg(*[F.sum(name).alias(name) for name in names])
    result = {k: np.zeros((len(held), len(names))) for k, held in centres.items()}
    for row in added.collect():
        result[row["k"]][row["cluster"]] = [row[name] for name in names]
    return result


def fit_all(
    rows: DataFrame, ks: Sequence[int], seed: int = 1, max_iter: int = 20, tol: float = 1e-4
) -> dict[int, tuple[np.ndarray, float]]:
    """Centres and cost for every k, all moved by the same scans of the rows.

    ``rows`` are complete doubles, best a stored table. A scan measures the centres
    of every k that is still moving and gives their means; a k comes to rest when
    the cost has fallen by no more than the share ``tol`` since the scan before.
    With fewer different rows than k there are as many centres as rows.
    """
    centres = _starts(rows, ks, seed)
    found: dict[int, tuple[np.ndarray, float]] = {}
    before = dict.fromkeys(ks, math.inf)
    for step in range(max_iter + 1):
        moving = {k: held for k, held in centres.items() if k not in found}
        if not moving:
            break
        for k, sums in _sums_for_all(rows, moving).items():
            cost = float(sums[:, 1].sum())
            if step == max_iter or cost >= (1 - tol) * before[k]:
                found[k] = centres[k], cost
            else:
                before[k] = cost
                centres[k] = _moved(centres[k], sums[:, 0], sums[:, 2:])
    return found


def elbow(
    df: DataFrame,
    columns: list[str],
    low: int,
    high: int,
    seed: int = 1,
    max_iter: int = 20,
    tol: float = 1e-4,
) -> DataFrame:
    """Cost of the k-means fit for every k from ``low`` to ``high``.

    All of them share one stored table and its scans. Without a complete row there
    is no cost and no row.
    """
    with stored_rows(clean_numeric(df.select(*columns), columns)) as rows:
        ks = list(range(low, high + 1)) if rows.head(1) else []
        fitted = fit_all(rows, ks, seed, max_iter, tol) if ks else {}
    costs = [(k, fitted[k][1]) for k in ks]
    return df.sparkSession.createDataFrame(costs, "k int, cost double")


def distances(columns: Sequence[str], centres: Sequence[Centre]) -> list[Column]:
    """Squared distance to each centre, as plain arithmetic over the columns.

    The centres travel as literals, so assigning rows joins nothing. The
    expression grows with centres times axes, which may be ``MOST_LITERALS`` at
    most; ``Clustering`` has no such bound.
    """
    if len(centres) * len(columns) > MOST_LITERALS:
        raise ValueError(f"more than {MOST_LITERALS} numbers as literals; use a fitted clustering")
    result = []
    for centre in centres:
        terms = [(F.col(c) - F.lit(v)) * (F.col(c) - F.lit(v)) for c, v in zip(columns, centre)]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        result.append(total)
    return result


def least_distance(columns: Sequence[str], centres: Sequence[Centre]) -> Column:
    found = distances(columns, centres)
    return F.least(*found) if len(found) > 1 else found[0]


def nearest(columns: Sequence[str], centres: Sequence[Centre]) -> Column:
    """Index of the nearest centre, the lower one on a tie."""
    ranked = [
        F.struct(gap.alias("gap"), F.lit(i).alias("cluster"))
        for i, gap in enumerate(distances(columns, centres))
    ]
    return (F.least(*ranked) if len(ranked) > 1 else ranked[0])["cluster"]


def assign(df: DataFrame, columns: Sequence[str], centres: Sequence[Centre]) -> DataFrame:
    return df.withColumn("cluster", nearest(columns, centres))


def centre_step(df: DataFrame, columns: Sequence[str], centres: Sequence[Centre]) -> DataFrame:
    """Size and mean of the rows nearest to each centre."""
    return (
        assign(df, columns, centres)
        .groupBy("cluster")
        .agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in columns])
    )


def move_centres(
    df: DataFrame, columns: Sequence[str], centres: Sequence[Centre], steps: int
) -> list[Centre]:
    """Repeat ``centre_step``; each step brings back one row per centre.

    A centre that no row is nearest to stays where it is.
    """
    current = [tuple(map(float, c)) for c in centres]
    for _ in range(steps):
        step = centre_step(df, columns, current).collect()
        moved = {row["cluster"]: tuple(row[c] for c in columns) for row in step}
        current = [moved.get(i, c) for i, c in enumerate(current)]
    return current


def cost(df: DataFrame, columns: Sequence[str], centres: Sequence[Centre]) -> DataFrame:
    """One row: the sum of squared distances to the nearest centre."""
    return df.agg(F.sum(least_distance(columns, centres)).alias("cost"))
