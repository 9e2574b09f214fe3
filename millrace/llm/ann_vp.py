"""Nearest neighbours by cosine with a vantage-point tree for each shard.

Rows are dealt evenly over shards, queries over blocks; a task searches one
shard for one block of queries, so its memory is bounded however large the
table. On unit vectors the Euclidean distance orders like the cosine and obeys
the triangle inequality: a half of a tree is passed over when its least possible
distance, times ``factor``, is beyond the k-th best so far. Factor 1 is exact;
larger factors pass over more and may miss neighbours.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import let_workers_import, stored, with_row_keys

SHARD_ROWS = 8192
QUERY_ROWS = 4096
LEAF = 128
SLACK = 1e-9


class Tree:
    """Halves by the distance to a vantage point, with the distances' range in each."""

    def __init__(self, units: np.ndarray, rows: np.ndarray):
        self.rows, self.children = rows, None
        if len(rows) <= LEAF:
            return
        self.vantage = units[rows[len(rows) // 2]]
        far = np.linalg.norm(units[rows] - self.vantage, axis=1)
        order = np.argsort(far, kind="stable")
        half = len(rows) // 2
        self.middle = far[order[half]]
        self.children = [
            (Tree(units, rows[part]), far[part].min(), far[part].max())
            for part in (order[:half], order[half:])
        ]


class Search:
    """The k nearest rows of one shard for a block of queries."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int, factor: float):
        self.vectors, self.norms = vectors, np.sqrt((vectors * vectors).sum(axis=1))
        self.units = vectors / self.norms[:, None]
        self.ids, self.keys, self.k, self.factor = ids, keys, k, factor
        self.tree = Tree(self.units, np.arange(len(ids)))

    def run(self, queries: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """Positions of queries and of rows, and cosines."""
        self.asked, self.asked_keys = queries, keys
        self.asked_norms = np.sqrt((queries * queries).sum(axis=1))
        self.asked_units = queries / self.asked_norms[:, None]
        n = len(queries)
        self.best = np.full((n, self.k), -np.inf)
        self.found = np.full((n, self.k), -1)
        self.visit(self.tree, np.arange(n))
        q, place = np.nonzero(self.found >= 0)
        return q, self.found[q, place], self.best[q, place]

    def visit(self, node: Tree, asking: np.ndarray) -> None:
        if not len(asking):
            return
        if node.children is None:
            self.leaf(node.rows, asking)
            return
        far = np.linalg.norm(self.asked_units[asking] - node.vantage, axis=1)
        inner = far < node.middle
        near, rest = node.children
        self.visit(near[0], asking[inner])
        self.visit(rest[0], asking[~inner])
        for (child, low, high), others in ((rest, inner), (near, ~inner)):
            least = np.maximum(low - far[others], far[others] - high)
            self.visit(child, asking[others][self.in_reach(least, asking[others])])

    def in_reach(self, least: np.ndarray, asking: np.ndarray) -> np.ndarray:
        """Whether a distance of ``least`` could still be among the best."""
        worst = np.sqrt(np.maximum(0.0, 2 - 2 * np.maximum(self.best[asking, -1], -1.0)))
        return least * self.factor <= worst + SLACK

    def leaf(self, rows: np.ndarray, asking: np.ndarray) -> None:
        rough = self.asked_units[asking] @ self.units[rows].T
        # The own row counts as a candidate here and is taken out below.
        i, j = np.nonzero(rough >= self.best[asking, -1][:, None] - SLACK)
        q, r = asking[i], rows[j]
        other = self.keys[r] != self.asked_keys[q]
        q, r = q[other], r[other]
        if not len(q):
            return
        exact = (self.asked[q] * self.vectors[r]).sum(axis=1)
        exact /= self.asked_norms[q] * self.norms[r]
        touched = np.unique(q)
        old = self.found[touched]
        kept = old >= 0
        q = np.concatenate([q, np.repeat(touched, kept.sum(axis=1))])
        r = np.concatenate([r, old[kept]])
        exact = np.concatenate([exact, self.best[touched][kept]])
        order = np.lexsort((self.ids[r], -exact, q))
        q, r, exact = q[order], r[order], exact[order]
        starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(q)]])))
        top = rank < self.k
        self.found[q[top], rank[top]] = r[top]
        self.best[q[top], rank[top]] = exact[top]


def usable(vector: str) -> Column:
    """Vectors that take part: no null or non-finite component, not all zero."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = F.forall(vector, real) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(vector).isNotNull() & whole, F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows in double precision, each scaled by a power of two: no cosine changes."""
    rows = len(column)
    flat = pc.list_flatten(column).to_numpy().astype(np.float64).reshape(rows, -1)
    _, exponent = np.frexp(np.abs(flat).max(axis=1))
    return np.ldexp(flat, -exponent[:, None])


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    factor: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, the neighbour's id and its cosine for every query row.

    Candidates are all rows but the query's own; equal cosines go to the smaller
    id. Rows that share an id are different rows. Vectors are compared with
    those of the same length. Null ids, and vectors that are null, empty, zero
    or hold null or non-finite components, take no part. Fewer candidates than
    ``k`` all come back; an empty table gives no rows.
    """
    if factor < 1:
        raise ValueError("factor must be at least 1")
    keyed, keys = with_row_keys(vectors, "vectors")
    keyed = keyed.filter(F.col(id_col).isNotNull() & usable(vector_col))
    rows = stored(
        keyed.select(
            F.col(id_col).cast("bigint").alias("id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
            F.size(vector_col).alias("length"),
            F.xxhash64(*keys).alias("row"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ),
        "vectors-usable",
    )
    total, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, math.ceil(total / shard_rows)), max(1, math.ceil(asking / query_rows))

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return df.withColumn(own, F.pmod("row", F.lit(parts)).cast("int")).select("*", every)

    task = ["length", "shard", "block"]
    held = dealt(rows.drop("asks"), "shard", shards, "block", blocks).groupBy(task)
    asked = dealt(rows.filter("asks").drop("asks"), "block", blocks, "shard", shards).groupBy(task)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [pa.array([], pa.int64())] * 3 + [pa.array([], pa.float64())]
        if left.num_rows and right.num_rows:
            number = lambda table, name: table.column(name).to_numpy()
            ids, asked_ids = number(left, "id"), number(right, "id")
            shard = Search(_matrix(left.column("vector")), ids, number(left, "row"), k, factor)
            q, r, cosine = shard.run(_matrix(right.column("vector")), number(right, "row"))
            columns = [asked_ids[q], number(right, "row")[q], ids[r], cosine]
            columns = [pa.array(column) for column in columns]
        return pa.Table.from_arrays(columns, names=["query_id", "query_row", "id", "score"])

    let_workers_import(vectors)
    found = held.cogroup(asked).applyInArrow(
        search, "query_id bigint, query_row bigint, id bigint, score double"
    )
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
