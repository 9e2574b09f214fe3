"""Points against a table of centres, however many there are.

Centres that stand on one place count once, under their lowest number. If the
places are few, which is measured before anything else, they travel to every task
once and the points are not shuffled. Otherwise the places are dealt to cells, by
cuts through a bounded sample of them. The sample tells every point a distance that
its nearest centre cannot exceed, and the point meets the cells that reach so near,
one or a few; the least of their distances is its nearest centre. Points that stand
on the same place are looked up once.

Within a task the centres lie in a tree of boxes, halved along the widest axis, and
a point meets only the leaves that are no farther than its nearest centre so far.

Distances are added up axis by axis in double precision, so they equal those of
``clustering.distances`` to the last bit; of equally near centres the lower number
wins. Rounding keeps the order of differences, squares and sums, so a box is never
farther than a centre in it, and leaving boxes out is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Numbers of a table of centres that may travel to every task (8 bytes each).
MOST_NUMBERS = 1_000_000
# Points that meet one cell in a task, centres of one leaf, and distances computed at once.
POINTS_OF_PART = 200_000
ACROSS = 32
HELD = 1 << 16
# Cells at most (beyond, they hold more centres each), and sampled centres of a cell.
MOST_CELLS = 1 << 14
SAMPLED = 16
# Points by which the crowding of cells is estimated.
COUNTED = 100_000


def _task_functions() -> tuple:
    """What tasks call. Nested functions travel by value, so executors need no copy of this package."""

    def tree_of(numbers: np.ndarray, centres: np.ndarray, across: int = 0) -> tuple:
        """Numbers and centres by leaves of ``across`` at most, where leaves start, and the boxes of all levels.

        A level has twice the boxes of the one above; box i lies over boxes 2i and
        2i + 1. Centres with an infinite axis or none are left out.
        """
        known = np.isfinite(centres).all(axis=1)
        numbers, centres = numbers[known], centres[known]
        order = np.lexsort((numbers, *centres.T))
        numbers, centres = numbers[order], centres[order]
        fresh = np.ones(len(numbers), dtype=bool)
        fresh[1:] = (centres[1:] != centres[:-1]).any(axis=1)
        numbers, centres = numbers[fresh], centres[fresh]
        count, depth = len(numbers), 0
        if not count:
            return numbers, centres, np.zeros(1, dtype=np.int64), []
        while count > (across or ACROSS) << depth:
            depth += 1
        starts = [(np.arange(1 << level) * count) >> level for level in range(depth + 1)]
        node = np.zeros(count, dtype=np.int64)
        for level in range(depth):
            with np.errstate(over="ignore"):
                wide = np.maximum.reduceat(centres, starts[level]) - np.minimum.reduceat(centres, starts[level])
            order = np.lexsort((centres[np.arange(count), wide.argmax(axis=1)[node]], node))
            numbers, centres = numbers[order], centres[order]
            node = np.repeat(np.arange(2 << level), np.diff(starts[level + 1], append=count))
        order = np.lexsort((numbers, node))
        numbers, centres = numbers[order], centres[order]
        boxes = [(np.minimum.reduceat(centres, s), np.maximum.reduceat(centres, s)) for s in starts]
        return numbers, centres, starts[-1], boxes

    def box_gaps(points: np.ndarray, box: tuple[np.ndarray, np.ndarray], nodes: np.ndarray) -> np.ndarray:
        """Squared distance of each point to its box; the box of no centre is infinitely far."""
        low, high = box
        gaps = np.zeros(len(points))
        with np.errstate(over="ignore"):
            for i in range(points.shape[1]):
                line = points[:, i]
                apart = np.maximum(np.maximum(low[nodes, i] - line, line - high[nodes, i]), 0.0)
                gaps += apart * apart
        return gaps

    def nearest_boxes(points: np.ndarray, boxes: list) -> np.ndarray:
        """Number of a near box of the last level for each point: the nearer half at each level."""
        nodes = np.zeros(len(points), dtype=np.int64)
        for box in boxes[1:]:
            left = 2 * nodes
            nodes = left + (box_gaps(points, box, left + 1) < box_gaps(points, box, left))
        return nodes

    def near_boxes(points: np.ndarray, least: np.ndarray, boxes: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Points and boxes of the last level that are no farther than ``least``, a piece at a time.

        The caller may lower ``least`` in between.
        """
        pieces = [(0, np.arange(len(points)), np.zeros(len(points), dtype=np.int64))] if boxes else []
        while pieces:
            level, rows, nodes = pieces.pop()
            if len(rows) > HELD:
                half = len(rows) // 2
                pieces += [(level, rows[half:], nodes[half:]), (level, rows[:half], nodes[:half])]
                continue
            near = box_gaps(points[rows], boxes[level], nodes) <= least[rows]
            rows, nodes = rows[near], nodes[near]
            if not len(rows):
                continue
            if level + 1 == len(boxes):
                yield rows, nodes
            else:
                pieces.append((level + 1, np.concatenate([rows, rows]), np.concatenate([2 * nodes, 2 * nodes + 1])))

    def nearest_in(points: np.ndarray, tree: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centre of a tree and its squared distance for each point.

        Without a centre at a finite distance the number is -1 and the distance
        infinite.
        """
        numbers, centres, starts, boxes = tree
        best = np.full(len(points), np.inf)
        number = np.full(len(points), -1, dtype=np.int64)
        rows = np.flatnonzero(np.isfinite(points).all(axis=1))
        if not boxes or not len(rows):
            return number, best
        size = int(np.diff(starts, append=len(numbers)).max())
        down = max(1, HELD // size)
        chunk, least, winner = points[rows], best[rows], number[rows]

        def measure(rows: np.ndarray, leaves: np.ndarray) -> None:
            for start in range(0, len(rows), down):
                chosen, first = rows[start : start + down], starts[leaves[start : start + down]]
                if len(starts) == 1:
                    first = first[:1]
                # A short leaf is filled up with centres of the next one.
                at = np.minimum(first[:, None] + np.arange(size), len(numbers) - 1)
                gaps = np.zeros((len(chosen), size))
                with np.errstate(over="ignore"):
                    for i in range(chunk.shape[1]):
                        step = chunk[chosen, i, None] - centres[at, i]
                        gaps += step * step
                column = gaps.argmin(axis=1)
                gap = gaps[np.arange(len(gaps)), column]
                name = numbers[np.minimum(starts[leaves[start : start + down]] + column, len(numbers) - 1)]
                order = np.lexsort((name, gap, chosen))
                order = order[np.diff(chosen[order], prepend=-1) > 0]
                chosen, gap, name = chosen[order], gap[order], name[order]
                better = (gap < least[chosen]) | ((gap == least[chosen]) & (name < winner[chosen]))
                least[chosen[better]], winner[chosen[better]] = gap[better], name[better]

        seen = nearest_boxes(chunk, boxes)
        measure(np.arange(len(chunk)), seen)
        if len(starts) > 1:
            for those, leaves in near_boxes(chunk, least, boxes):
                other = leaves != seen[those]
                measure(those[other], leaves[other])
        best[rows], number[rows] = least, winner
        return number, best

    def nearest_rows(points: np.ndarray, numbers: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``nearest_in`` for centres that are no tree yet."""
        return nearest_in(points, tree_of(numbers, centres))

    def matrix(batch: pa.RecordBatch | pa.Table, axes: Sequence[str]) -> np.ndarray:
        """The axes as columns; null is no number."""
        columns = [np.asarray(batch.column(axis).to_pandas(), dtype=np.float64) for axis in axes]
        return np.column_stack(columns)

    def centres_of(table: pa.Table, axes: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        return table.column("number").to_numpy(), matrix(table, axes)

    return nearest_rows, matrix, centres_of, tree_of, nearest_in, nearest_boxes, near_boxes


nearest_rows, _matrix, _centres_of, _tree_of, _nearest_in, _nearest_boxes, _near_boxes = _task_functions()


def _numbers(df: DataFrame, columns: Sequence[str], axes: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("double").alias(axis) for c, axis in zip(columns, axes)]


def assign_from(
    df: DataFrame, columns: Sequence[str], centres: DataFrame, most_numbers: int = MOST_NUMBERS
) -> DataFrame:
    """The rows with ``cluster``, the number of the nearest centre, and ``gap``, its squared distance.

    ``centres`` has a column ``cluster`` with whole numbers of zero or more, and the
    axes under the same names as ``df``; centres with a null are left out. The new
    columns take the place of any with their names. Both are null for a row whose
    axes are not all finite numbers, and for all rows if there is no centre.

    Up to ``most_numbers`` numbers of centres (axes and number times places) go to
    every task; beyond, points are shuffled to cells of about that size.
    """
    axes = [f"axis_{i}" for i in range(len(columns))]
    rows = df.drop("cluster", "gap")
    numbered = centres.select(
        F.col("cluster").cast("bigint").alias("number"), *_numbers(centres, columns, axes)
    ).na.drop("any")
    numbered = numbered.groupBy(*axes).agg(F.min("number").alias("number"))
    most = max(1, most_numbers // (len(columns) + 1))
    first = numbered.limit(most + 1).toArrow()
    if first.num_rows > most:
        return _assign_in_cells(rows, columns, axes, numbered, most)
    known = df.sparkSession.sparkContext.broadcast(_tree_of(*_centres_of(first, axes)))
    find, matrix = _nearest_in, _matrix

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, gap = find(matrix(batch, axes), known.value)
            none = number < 0
            found = [pa.array(number, mask=none), pa.array(gap, mask=none)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *found], names=["row", "cluster", "gap"]
            )

    schema = StructType().add("row", rows.schema).add("cluster", "long").add("gap", "double")
    packed = rows.select(*_numbers(rows, columns, axes), F.struct(*rows.columns).alias("row"))
    return packed.mapInArrow(look_up, schema).select("row.*", "cluster", "gap")


def _one_in(rows: DataFrame, axes: list[str], times: int) -> DataFrame:
    """Rows of one in so many places, chosen by their digests."""
    return rows.where(F.pmod(F.xxhash64(*axes), F.lit(times)) == 0)


def _cell_boxes(dealt: DataFrame, axes: list[str], levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The boxes of the centres in each cell, and of two, four and more cells above."""
    ends = [edge(axis) for edge in (F.min, F.max) for axis in axes]
    low = np.full((1 << (levels - 1), len(axes)), np.inf)
    high = -low
    for cell, *edges in dealt.groupBy("cell").agg(*ends).collect():
        low[cell], high[cell] = edges[: len(axes)], edges[len(axes) :]
    boxes = [(low, high)]
    while len(boxes[0][0]) > 1:
        low, high = (edge.reshape(-1, 2, len(axes)) for edge in boxes[0])
        boxes.insert(0, (low.min(axis=1), high.max(axis=1)))
    return boxes


def _assign_in_cells(
    rows: DataFrame, columns: Sequence[str], axes: list[str], numbered: DataFrame, most: int
) -> DataFrame:
    """Each point against the cells of centres that may hold its nearest, least distances first."""
    context = rows.sparkSession.sparkContext
    finite = [F.abs(axis) < math.inf for axis in axes]
    for one in finite:
        numbered = numbered.where(one)
    count = numbered.count()
    # The cells fill unevenly, so there are at least one and a half times as many as needed.
    level = math.ceil(math.log2(min(MOST_CELLS, max(1.0, 1.5 * count / most))))
    sampled = min(MOST_NUMBERS // (len(axes) + 1), max(SAMPLED << level, count // 32))
    sample = _centres_of(_one_in(numbered, axes, max(1, count // sampled)).toArrow(), axes)
    level = min(level, max(1, len(sample[0])).bit_length() - 1)
    tree = _tree_of(*sample, across=max(1, min(ACROSS, len(sample[0]) >> level)))
    cuts = tree[3][: level + 1]
    home, near, find = _nearest_boxes, _near_boxes, _nearest_in
    matrix, ordered, tree_of = _matrix, _centres_of, _tree_of

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = home(matrix(batch, axes), known.value[1])
            yield batch.select(["number", *axes]).append_column("cell", pa.array(cell))

    place = ", ".join(f"{axis} double" for axis in axes)
    known = context.broadcast((tree, cuts))
    dealt = numbered.mapInArrow(deal, f"number bigint, {place}, cell bigint")
    reach = context.broadcast((tree, _cell_boxes(dealt, axes, max(1, len(cuts)))))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, boxes = reach.value
        for batch in batches:
            points = matrix(batch, axes)
            for those, cells in near(points, find(points, tree)[1], boxes):
                pairs = batch.take(pa.array(those))
                yield pairs.append_column("cell", pa.array(cells))

    # Crowded cells are met by several tasks, so many by a sample of the points.
    points = rows.select(*_numbers(rows, columns, axes)).na.drop("any")
    for one in finite:
        points = points.where(one)
    times = max(1, rows.count() // COUNTED)
    met = _one_in(points, axes, times).distinct().mapInArrow(meet, f"{place}, cell bigint")
    crowd = {cell: n * times for cell, n in met.groupBy("cell").count().collect()}
    parts = np.ones(1 << max(0, len(cuts) - 1), dtype=np.int64)
    for cell, n in crowd.items():
        parts[cell] = max(1, math.ceil(n / POINTS_OF_PART))
    shared = context.broadcast(parts)

    def with_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("parts", pa.array(shared.value[batch.column("cell").to_numpy()]))

    def dealt_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return with_parts(meet(batches))

    def dealt_centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return with_parts(deal(batches))

    meeting = points.distinct().mapInArrow(dealt_points, f"{place}, cell bigint, parts bigint")
    meeting = meeting.withColumn("part", F.pmod(F.xxhash64(*axes), F.col("parts")))
    spread = numbered.mapInArrow(dealt_centres, f"number bigint, {place}, cell bigint, parts bigint")
    spread = spread.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))

    def compare(points: pa.Table, centres: pa.Table) -> pa.Table:
        number, gap = find(matrix(points, axes), tree_of(*ordered(centres, axes)))
        found = points.select(axes).append_column("number", pa.array(number))
        found = found.append_column("gap", pa.array(gap))
        return found.filter(pa.array(number >= 0))

    schema = f"{place}, number bigint, gap double"
    meeting = meeting.drop("parts").groupBy("part", "cell").cogroup(spread.drop("parts").groupBy("part", "cell"))
    partial = meeting.applyInArrow(compare, schema)
    best = partial.groupBy(*axes).agg(F.min(F.struct("gap", "number")).alias("best"))
    # Joined by place: a place that many rows share is split by adaptive execution.
    names = [f"place_{i}" for i in range(len(axes))]
    best = best.select(*[F.col(a).alias(n) for a, n in zip(axes, names)], "best")
    same = [F.col(c).cast("double") == F.col(n) for c, n in zip(columns, names)]
    joined = rows.join(best, same, "left")
    return joined.select(
        *rows.columns, F.col("best.number").alias("cluster"), F.col("best.gap").alias("gap")
    )


def step_from(
    df: DataFrame, columns: Sequence[str], centres: DataFrame, most_numbers: int = MOST_NUMBERS
) -> DataFrame:
    """Size and mean of the rows nearest to each centre that has any."""
    placed = assign_from(df.select(*columns), columns, centres, most_numbers)
    means = [F.avg(c).alias(c) for c in columns]
    return placed.na.drop(subset=["cluster"]).groupBy("cluster").agg(F.count("*").alias("n"), *means)


def cost_from(
    df: DataFrame, columns: Sequence[str], centres: DataFrame, most_numbers: int = MOST_NUMBERS
) -> DataFrame:
    """One row: the sum of squared distances to the nearest centre."""
    placed = assign_from(df.select(*columns), columns, centres, most_numbers)
    return placed.agg(F.sum("gap").alias("cost"))
