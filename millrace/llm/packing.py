"""Packing documents into sequences of fixed length by cutting stock.

A document is cut at multiples of the sequence length, and its rest once more
at the last multiple of a unit, so that every piece is a whole number of units
or shorter than one unit. There are then few lengths, and the linear program
"fewest sequences that hold all pieces" is small whatever the number of
documents: column generation solves it over the histogram of lengths. Each
column is a pattern, the number of pieces of each length in one sequence, and a
knapsack over the dual prices finds the next one. Patterns are used a whole
number of times; the few pieces left by rounding, less than one sequence for
each pattern, are placed largest first. Pieces are ranked within their length,
and a piece's rank decides its sequence.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, stored, text_slices
from millrace.llm.tokens import END_ID, SLICE_BYTES, TOKENIZER, encoder

LENGTH = 4096
UNIT = 64
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "task bigint, rank_in_task bigint"
)
KEPT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
NAMES = [*KEPT, "task", "rank_in_task"]
PLACED = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, slot bigint"
)


@dataclass
class Plan:
    """Where the pieces of each length go, by rank: intervals of ranks, in order.

    For length ``c``, ``first[c]`` holds the first rank of each interval;
    ``sequence``, ``copies`` and ``slot`` say from which sequence on, how many
    pieces of that length a sequence takes, and the place of the first of them.
    """

    first: dict[int, np.ndarray]
    sequence: dict[int, np.ndarray]
    copies: dict[int, np.ndarray]
    slot: dict[int, np.ndarray]
    sequences: int

    def place(self, size: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.first[size], ranks, side="right") - 1
        within, copies = ranks - self.first[size][at], self.copies[size][at]
        return self.sequence[size][at] + within // copies, self.slot[size][at] + within % copies


def best_pattern(sizes: np.ndarray, prices: np.ndarray, length: int) -> tuple[np.ndarray, float]:
    """The most valuable pattern, by dynamic programming over the filled length."""
    value = np.zeros(length + 1)
    taken: list[tuple[int, int, np.ndarray]] = []
    for i in np.flatnonzero(prices > 1e-12):
        copies = 1
        while copies * sizes[i] <= length:
            width, worth = int(copies * sizes[i]), copies * prices[i]
            offer = value[:-width] + worth
            better = offer > value[width:] + 1e-12
            taken.append((i, copies, better))
            value[width:] = np.where(better, offer, value[width:])
            copies *= 2
    pattern = np.zeros(len(sizes), dtype=np.int64)
    room = length
    for i, copies, better in reversed(taken):
        width = int(copies * sizes[i])
        if room >= width and better[room - width]:
            pattern[i] += copies
            room -= width
    return pattern, float(prices @ pattern)


def generate_columns(
    sizes: np.ndarray, demand: np.ndarray, length: int, gap: float = 1e-3, rounds: int = 4000
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (as columns) and their fractional uses; within ``gap`` of the optimum."""
    m = len(sizes)
    basis = np.diag(length // sizes).astype(float)
    inverse = np.diag(1.0 / (length // sizes))
    uses = inverse @ demand
    for step in range(rounds):
        if step % 200 == 199:
            inverse = np.linalg.inv(basis)
            uses = np.maximum(inverse @ demand, 0)
        prices = inverse.sum(axis=0)
        pattern, worth = best_pattern(sizes, prices, length)
        if worth <= 1 + gap:
            break
        direction = inverse @ pattern
        entering = direction > 1e-9
        if not entering.any():
            break
        ratio = np.full(m, np.inf)
        ratio[entering] = uses[entering] / direction[entering]
        out = int(np.argmin(ratio))
        uses = np.maximum(uses - ratio[out] * direction, 0)
        uses[out] = ratio[out]
        basis[:, out] = pattern
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
    return basis.astype(np.int64), uses


def make_plan(counts: dict[int, int], length: int = LENGTH) -> Plan:
    """Sequences for ``counts`` pieces of each length."""
    sizes = np.array(sorted(counts), dtype=np.int64)
    left = np.array([counts[int(s)] for s in sizes], dtype=np.int64)
    used: list[tuple[np.ndarray, int]] = []

    def use(pattern: np.ndarray, times: int) -> None:
        if times > 0:
            used.append((pattern, times))
            left[:] -= pattern * times

    if len(sizes):
        patterns, uses = generate_columns(sizes, left.astype(float), length)
        for pattern, times in zip(patterns.T, np.floor(uses + 1e-6).astype(np.int64)):
            taking = pattern > 0
            use(pattern.copy(), int(min(times, (left[taking] // pattern[taking]).min())))
    while left.any():
        pattern, room = np.zeros_like(sizes), length
        for i in np.flatnonzero(left)[::-1]:
            pattern[i] = min(left[i], room // sizes[i])
            room -= int(pattern[i] * sizes[i])
        taking = pattern > 0
        use(pattern, int((left[taking] // pattern[taking]).min()))

    plan = Plan({}, {}, {}, {}, 0)
    rows: dict[int, list[tuple[int, int, int, int]]] = {int(s): [] for s in sizes}
    rank = dict.fromkeys(rows, 0)
    for pattern, times in used:
        slot = 0
        for i in np.flatnonzero(pattern)[::-1]:
            size, copies = int(sizes[i]), int(pattern[i])
            rows[size].append((rank[size], plan.sequences, copies, slot))
            rank[size] += copies * times
            slot += copies
        plan.sequences += times
    for size, held in rows.items():
        for target, column in zip((plan.first, plan.sequence, plan.copies, plan.slot), zip(*held)):
            target[size] = np.array(column, dtype=np.int64)
    return plan


def cut_points(total: int, length: int, unit: int) -> list[int]:
    """Where the pieces of ``total`` ids begin and end."""
    points = [*range(0, total, length), total]
    last = total // unit * unit
    if points[-2] < last < total:
        points.insert(-1, last)
    return points


def cut_pieces(
    docs: DataFrame,
    length: int = LENGTH,
    unit: int = UNIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """Pieces of each document's ids, with the rank among the task's pieces as long."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    end = END_ID.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(path).encode
        task = TaskContext.get().partitionId()
        seen: Counter = Counter()
        for batch, texts in text_slices(batches, limit=SLICE_BYTES):
            rows = []
            for doc, ids in enumerate(encode_texts(texts)):
                ids += end
                held, total = memoryview(ids), len(ids) // 4
                points = cut_points(total, length, unit)
                for start, stop in zip(points, points[1:]):
                    checksum = zlib.crc32(held[4 * start : 4 * stop])
                    size = stop - start
                    rows.append((doc, start, size, checksum, total, task, seen[size]))
                    seen[size] += 1
            doc, *columns = (pa.array(column, pa.int64()) for column in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(doc), *columns], names=NAMES
            )

    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")
    )
    return map_arrow(narrow, cut, PIECES)


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    unit: int = UNIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """One row a piece: where it starts in its document and where it lies.

    A null text counts as empty and has the end id alone, so every row has a
    piece; repeated rows are packed each on its own, null document ids too. A very
    long text is encoded on its own and cut into as many pieces as it takes.
    Other columns are ignored. An empty table gives no rows.
    """
    if not 1 <= unit <= length or length % unit:
        raise ValueError("the sequence length must be a multiple of the unit")
    pieces = stored(cut_pieces(docs, length, unit, id_col, text_col, tokenizer), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("pieces"))
    # At most length / unit + unit rows.
    counts = by_task.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()
    plan = make_plan({row["length"]: row["pieces"] for row in counts}, length)

    before = Window.partitionBy("length").orderBy("task")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select(
        "length", "task", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("base")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranks = (batch.column(n).to_numpy() for n in ("length", "rank"))
            sequence, slot = np.empty_like(ranks), np.empty_like(ranks)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                sequence[at], slot[at] = plan.place(size, ranks[at])
            columns = [batch.column(name) for name in KEPT] + [pa.array(sequence), pa.array(slot)]
            yield pa.RecordBatch.from_arrays(columns, names=[*KEPT, "sequence_id", "slot"])

    ranked = pieces.join(bases, ["length", "task"]).select(
        *KEPT, (F.col("base") + F.col("rank_in_task")).alias("rank")
    )
    placed = map_arrow(ranked, place, PLACED)
    ahead = Window.partitionBy("sequence_id").orderBy("slot")
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(ahead), F.lit(0))
    return placed.select(*KEPT, "sequence_id", offset.alias("offset"))
