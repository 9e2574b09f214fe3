"""Mixing sources to target weights by balanced sampling (cube method).

A source's target over its size is the expected number of copies of each of
its documents: a whole part that all get, and a fraction that is sampled. The
flight phase of the cube method moves the fractions of three documents at a
time along the null space of the constraints "number of documents" and "number
of words", so that both totals stay as they are, until one of the three is 0 or
1. It runs over blocks of each source; at most two documents of a block stay
fractional, and these meet in larger blocks round by round. The last block of a
source holds a few documents back; they and what stays fractional are the
landing problem, solved by the combination whose words come nearest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import product
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import fresh_names, map_arrow, stored, with_row_keys

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 2048
HELD_BACK = 10
NEAR = 1e-9


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """One row a source: source, source_rows, source_size, target.

    Sources by code point, null last, take the weights in turn. They share
    ``share`` times the size of everything; no target passes ``most`` times its
    source's size, and the excess goes to the others by weight. The sources with
    the least room for their weight fill up first, so a running sum over them
    finds the level at which the rest is shared out. ``share`` above ``most``
    fills all. Windows over all rows: one row a source.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)

    def rest(column: str, whole: Column) -> Column:
        return whole - F.coalesce(F.sum(column).over(before), F.lit(0.0))

    weighed = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
        .withColumn("most", F.col("source_size") * most)
        .withColumn("room", F.col("most") / F.col("weight"))
    )
    levelled = weighed.withColumn(
        "level",
        rest("most", F.sum("source_size").over(everything) * share)
        / rest("weight", F.sum("weight").over(everything)),
    ).withColumn("place", F.row_number().over(by_room))
    first_open = F.when(F.col("level") < F.col("room"), F.struct("place", "level"))
    level = F.min(first_open).over(everything)["level"]
    target = F.least(F.col("most"), F.coalesce(level * F.col("weight"), F.col("most")))
    return levelled.select("source", "source_rows", "source_size", target.alias("target"))


def _fly(held: list[list], random: Random) -> list[list]:
    """Move the fractions of three units until one is settled; the settled ones.

    A unit is [fraction, size, row].
    """
    (_, a, _), (_, b, _), (_, c, _) = held
    direction = [c - b, a - c, b - a]
    if not any(direction):
        direction = [1, -1, 0]
    up = down = math.inf
    for (fraction, _, _), d in zip(held, direction):
        if d > 0:
            up, down = min(up, (1 - fraction) / d), min(down, fraction / d)
        elif d < 0:
            up, down = min(up, fraction / -d), min(down, (1 - fraction) / -d)
    step = up if random.random() * (up + down) < down else -down
    for unit, d in zip(held, direction):
        unit[0] += step * d
    settled = [unit for unit in held if not NEAR < unit[0] < 1 - NEAR]
    held[:] = [unit for unit in held if NEAR < unit[0] < 1 - NEAR]
    return settled


def _land(units: list[list]) -> list[list]:
    """Settle the last units so that their words come nearest, then their number."""
    if units:
        picks = np.array(list(product((0, 1), repeat=len(units))))
        fractions, sizes = (np.array([u[i] for u in units], dtype=float) for i in (0, 1))
        moved = picks - fractions
        number = abs(moved.sum(axis=1)) * sizes.mean()
        best = np.argmin(np.round(abs(moved @ sizes) + 0.01 * number, 9))
        for unit, x in zip(units, picks[best].tolist()):
            unit[0] = x
    return units


def _flight(seed: int, names: list[str]):
    """Runs of (source_no, block), sorted; ``blocks`` 1 lands a source."""

    def fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, back, random, last = None, [], [], None, False
        at = {name: i for i, name in enumerate(names)}

        def close() -> list[list]:
            return _land(held + back) if last else held

        for batch in batches:
            done = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                run = row[at["source_no"]], row[at["block"]]
                if run != key:
                    done += close()
                    key, held, back, last = run, [], [], row[at["blocks"]] == 1
                    random = Random(f"{seed}/{run[0]}/{row[at['blocks']]}/{run[1]}")
                unit = [row[at["fraction"]], row[at["size"]], row]
                if last:
                    back.append(unit)
                    unit = back.pop(0) if len(back) > HELD_BACK else None
                if unit:
                    held.append(unit)
                while len(held) >= 3:
                    done += _fly(held, random)
            yield from _pack(done, batch.schema, at)
        if key is not None:
            yield from _pack(close(), batch.schema, at)

    return fly


def _pack(units: list[list], schema: pa.Schema, at: dict[str, int]) -> Iterator[pa.RecordBatch]:
    if not units:
        return
    columns = list(zip(*(row for _, _, row in units)))
    fractions = [fraction for fraction, _, _ in units]
    columns[at["fraction"]] = [0.0 if f < NEAR else 1.0 if f > 1 - NEAR else f for f in fractions]
    yield pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
    )


def mix(
    rows: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The rows (doc_id, source, size and others) with source_size, target and copies.

    Works on a stored table of narrow rows. Blocks and the order in them come
    from doc_id, size and, for rows that agree in both, the other columns, so
    reruns agree however the input is dealt. A source whose documents are all
    empty has target 0 and no copies. An empty table gives no rows.
    """
    targets = stored(source_targets(rows, weights, share, most), "mix-targets")
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    numbered = targets.select(
        F.col("source").alias("source_key"),
        "source_rows",
        "source_size",
        "target",
        number.alias("source_no"),
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    others = sorted(set(rows.columns) - {"doc_id", "source", "size"})
    current = (
        rows.join(numbered, F.col("source").eqNullSafe(F.col("source_key")))
        .drop("source_key")
        .withColumn("whole", F.floor(rate + NEAR))
        .withColumn("fraction", F.greatest(F.lit(0.0), rate - F.col("whole")))
        .withColumn("blocks", F.ceil(F.col("source_rows") / block_rows))
        .drop("source_rows")
    )
    largest = targets.agg(F.max("source_rows")).first()[0] or 0
    blocks, parts = max(1, math.ceil(largest / block_rows)), []
    while True:
        unsettled = (F.col("fraction") > 0) & (F.col("fraction") < 1)
        dealt = (
            current.filter(unsettled)
            .withColumn("digest", F.xxhash64("doc_id", "size", *others))
            .withColumn("block", F.pmod("digest", "blocks"))
            .repartition("source_no", "block")
            .sortWithinPartitions("source_no", "block", "digest", "doc_id", "size", *others)
        )
        flown = stored(
            map_arrow(dealt, _flight(seed, dealt.columns), dealt.schema).drop("block", "digest"),
            "mix-flight",
        )
        parts += [current.filter(~unsettled)]
        current = flown.withColumn("blocks", F.ceil(2 * F.col("blocks") / block_rows))
        if blocks == 1:
            break
        blocks = math.ceil(2 * blocks / block_rows)
    for part in [*parts[1:], current]:
        parts[0] = parts[0].unionByName(part)
    copies = (F.col("whole") + F.col("fraction")).cast("bigint").alias("copies")
    return parts[0].select(*rows.columns, "source_size", "target", copies)


def mixture(docs: DataFrame, **how) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words) of every document.

    Repeated rows count each on its own; a null text has size 0, a null source
    comes last. Other columns are ignored.
    """
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
    )
    mixed = mix(stored(narrow, "mix-sizes"), **how)
    return mixed.withColumn("taken", F.col("size") * F.col("copies")).drop("copies")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents as often as the mixture takes them, with their own columns only."""
    keyed, keys = with_row_keys(docs, "mix-docs")
    narrow = keyed.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        *[F.col(key).alias(f"key_{i}") for i, key in enumerate(keys)],
    )
    (copy,) = fresh_names(keyed, "copy_of_row")
    taken = (
        mix(stored(narrow, "mix-sizes"), **how)
        .filter(F.col("copies") > 0)
        .select(
            *[F.col(f"key_{i}").alias(key) for i, key in enumerate(keys)],
            F.sequence(F.lit(1), F.col("copies")).alias(copy),
        )
    )
    joined = keyed.join(taken, keys)
    return joined.withColumn(copy, F.explode(copy)).select(*docs.columns)
