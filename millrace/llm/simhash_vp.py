"""Near-duplicate documents by SimHash and vantage-point trees.

Equal fingerprints are one point. Points are cut into shards by Hamming
distance to a vantage point, field by field (two bits each): the vector of
distances over some fields is the path in a tree of vantage points. The
triangle inequality bounds the sum of the differences along the path by the
radius, so of ``radius + clean`` groups of fields at least ``clean`` have equal
paths for any pair within the radius. Every choice of ``clean`` groups is one
tree, and its shards are the leaves a point can share with a partner: the
boundary-overlapping shards are exactly the point's shards in the other trees.
Within a shard an ordinary vantage-point tree over whole fingerprints finds all
pairs within the radius. A shard gives the links that connect its points, one
for each point at most, not all pairs.

A shard of more than ``SHARD`` points is put aside as it streams by, and dealt
anew by one more vantage point: its rings are cut into blocks of half that size,
and every two blocks whose rings lie within the radius are a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, stored, text_chunks, with_row_keys
from millrace.llm.components import component_roots

SEED = 42
FIELDS = 32
EVEN_BITS = 0x5555555555555555
VANTAGE = 0x2545F4914F6CDD1D
SECOND_SEED = 7
SHARD = 1 << 14
LEAF = 192
WIDE = 1 << 14
VOTE_ROWS = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the lower-cased words' shingles, unsigned; 0 without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([digest(joined, SEED)], dtype=np.uint64)
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes + 1) - 1
        pairs = zip((ends - sizes)[: 1 - shingle or None].tolist(), ends[shingle - 1 :].tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), dtype=np.uint64)
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), VOTE_ROWS):
        part = hashes[start : start + VOTE_ROWS]
        votes += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes)).view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, keep: list[str], shingle: int, text: str) -> DataFrame:
    """The kept columns with ``fp``, the fingerprint as a signed 64-bit integer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "fingerprinted_text"):
            prints = [fingerprint(t.encode(), shingle) for t in texts]
            column = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            columns = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, column], names=[*keep, "fp"])

    narrow = docs.select(*keep, F.col(text).alias("fingerprinted_text"))
    schema = narrow.select(*keep, F.lit(0).cast("bigint").alias("fp")).schema
    return map_arrow(narrow, work, schema)


def hex_print(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def shards(points: DataFrame, radius: int, clean: int) -> DataFrame:
    """(shard, fp): a row for each tree, by the path of the point in it."""
    groups = radius + clean
    edges = [FIELDS * i // groups * 2 for i in range(groups + 1)]
    masks = [((1 << hi) - (1 << lo)) for lo, hi in zip(edges, edges[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    apart = F.col("fp").bitwiseXOR(F.lit(signed(VANTAGE)))
    low = apart.bitwiseAND(F.lit(EVEN_BITS))
    high = F.shiftrightunsigned(apart, 1).bitwiseAND(F.lit(EVEN_BITS))
    # The distance of each field, 0 to 2, in the field's own two bits.
    rings = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    paths = [
        F.xxhash64(F.lit(i), F.col("rings").bitwiseAND(F.lit(signed(sum(chosen)))))
        for i, chosen in enumerate(combinations(masks, clean))
    ]
    return points.select("fp", rings.alias("rings")).select(
        F.explode(F.array(*paths)).alias("shard"), "fp"
    )


class _Links:
    """Which points of a batch hang together: the least index of each part."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        self.part = np.arange(len(prints))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        part = self.part
        while len(a):
            x, y = part[a], part[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            np.minimum.at(part, high, low)
            while not np.array_equal(jumped := part[part], part):
                part[:] = jumped
            open_ = part[a] != part[b]
            a, b = a[open_], b[open_]

    def compare(self, a: np.ndarray, b: np.ndarray) -> None:
        """Link all pairs within the radius, unless all hang together already."""
        parts = self.part[a]
        if (parts == parts[0]).all() and (self.part[b] == parts[0]).all():
            return
        for start in range(0, len(a), LEAF):
            rows = a[start : start + LEAF]
            for at in range(0, len(b), WIDE):
                others = b[at : at + WIDE]
                far = np.bitwise_count(self.prints[rows][:, None] ^ self.prints[others][None, :])
                i, j = np.nonzero(far <= self.radius)
                self.add(rows[i], others[j])

    def within(self, points: np.ndarray) -> None:
        """The vantage-point tree over ``points``: near half, far half, their boundary."""
        if len(points) <= LEAF:
            self.compare(points, points)
            return
        vantage = self.prints[points[len(points) // 2]]
        far = np.bitwise_count(self.prints[points] ^ vantage).astype(int)
        middle = int(np.median(far))
        near = far <= middle
        if near.all():
            near = far < middle
        if not near.any():
            self.compare(points, points)
            return
        self.within(points[near])
        self.within(points[~near])
        reach = near & (far >= far[~near].min() - self.radius)
        self.between(points[reach], points[~near & (far <= far[near].max() + self.radius)])

    def between(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs of one point of ``a`` and one of ``b``."""
        if not len(a) or not len(b):
            return
        if len(a) < len(b):
            a, b = b, a
        if len(a) <= 2 * LEAF:
            self.compare(a, b)
            return
        vantage = self.prints[a[len(a) // 2]]
        of_a = np.bitwise_count(self.prints[a] ^ vantage).astype(int)
        of_b = np.bitwise_count(self.prints[b] ^ vantage).astype(int)
        middle = int(np.median(of_a))
        near = of_a <= middle
        if near.all() or not near.any():
            self.compare(a, b)
            return
        self.between(a[near], b[of_b <= middle + self.radius])
        self.between(a[~near], b[of_b > middle - self.radius])


def _links_of_shards(radius: int, most: int | None):
    """Links of sorted shards; the points of one above ``most`` come back with its key."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
        crowded = None
        for batch in batches:
            if not batch.num_rows:
                continue
            more = batch.column("fp").to_numpy().view(np.uint64)
            keys = np.concatenate([keys, batch.column("shard").to_numpy()])
            prints = np.concatenate([prints, more])
            if keys[0] == crowded:
                end = np.searchsorted(keys, crowded, side="right")
                yield _put_aside(keys[:end], prints[:end])
                keys, prints = keys[end:], prints[end:]
            # The last shard may go on in the next batch.
            whole = np.searchsorted(keys, keys[-1]) if len(keys) else 0
            yield from _link_sorted(keys[:whole], prints[:whole], radius, most)
            keys, prints = keys[whole:], prints[whole:]
            if most is not None and len(keys) > most:
                crowded = keys[0]
                yield _put_aside(keys, prints)
                keys, prints = keys[:0], prints[:0]
        yield from _link_sorted(keys, prints, radius, most)

    return link


def _put_aside(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(prints.view(np.int64)), pa.nulls(len(keys), pa.int64()), pa.array(keys)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "shard"])


def _link_sorted(
    keys: np.ndarray, prints: np.ndarray, radius: int, most: int | None
) -> Iterator[pa.RecordBatch]:
    if len(keys) < 2:
        return
    links = _Links(prints, radius)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    over = sizes > most if most is not None else np.zeros(len(sizes), dtype=bool)
    for start, size in zip(starts[over].tolist(), sizes[over].tolist()):
        yield _put_aside(keys[start : start + size], prints[start : start + size])
    # Small shards at once: each point with the next, the one after, and so on.
    small = np.repeat(sizes <= LEAF, sizes)
    for ahead in range(1, int(min(sizes.max(), LEAF))):
        a = np.flatnonzero(small[:-ahead] & (keys[ahead:] == keys[:-ahead]))
        if not len(a):
            break
        a = a[np.bitwise_count(prints[a] ^ prints[a + ahead]) <= radius]
        links.add(a, a + ahead)
    large = (sizes > LEAF) & ~over
    for start, size in zip(starts[large].tolist(), sizes[large].tolist()):
        links.within(np.arange(start, start + size))
    linked = np.flatnonzero(links.part != np.arange(len(prints)))
    if len(linked):
        ends = prints.view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ends[linked]),
                pa.array(ends[links.part[linked]]),
                pa.nulls(len(linked), pa.int64()),
            ],
            names=["a", "b", "shard"],
        )


def _block(ring: Column, part: Column) -> Column:
    return F.shiftleft(ring.cast("bigint"), 32) + part


def block_pairs(crowded: DataFrame, radius: int) -> DataFrame:
    """(shard, fp): the points of crowded shards, dealt so that none has many.

    A point's ring is its distance to a vantage point of its shard. Rings are cut
    into blocks, and a point goes with each block that may hold a partner: by the
    triangle inequality, one whose ring is at most ``radius`` from its own. The two
    blocks together are the new shard. A shard has 65 rings at most.
    """
    apart = F.col("fp").bitwiseXOR(F.xxhash64(F.lit(SECOND_SEED), "shard"))
    points = crowded.select("shard", "fp", F.bit_count(apart).alias("ring"))
    counts = points.groupBy("shard", "ring").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / F.lit(SHARD // 2)).cast("int")
    rings = counts.groupBy("shard").agg(
        F.collect_list(F.struct("ring", blocks.alias("blocks"))).alias("rings")
    )
    meets = F.flatten(
        F.transform(
            F.filter("rings", lambda x: F.abs(x["ring"] - F.col("own")["ring"]) <= radius),
            lambda x: F.transform(
                F.sequence(F.lit(0), x["blocks"] - 1),
                lambda part: _block(x["ring"], part),
            ),
        )
    )
    plan = rings.select("shard", "rings", F.explode("rings").alias("own")).select(
        "shard", "own.ring", "own.blocks", meets.alias("meets")
    )
    own = _block(F.col("ring"), F.pmod(F.xxhash64("fp"), "blocks"))
    dealt = points.join(plan, ["shard", "ring"]).select(
        "shard", "fp", own.alias("own"), F.size("meets").alias("n"), F.explode("meets").alias("met")
    )
    # A block meets itself in any task where it meets another.
    dealt = dealt.filter((F.col("n") == 1) | (F.col("own") != F.col("met")))
    pair = F.xxhash64("shard", F.least("own", "met"), F.greatest("own", "met"))
    return dealt.select(pair.alias("shard"), "fp")


def linked_prints(points: DataFrame, radius: int, clean: int = 2) -> DataFrame:
    """(a, b): links that connect all distinct ``fp`` within ``radius`` of each other."""
    if not 0 <= radius or radius + clean > FIELDS:
        raise ValueError("radius and clean groups must fit the fields of a fingerprint")
    found = stored(_linked(shards(points, radius, clean), radius, SHARD), "simhash-links")
    links = found.filter(F.col("shard").isNull()).select("a", "b")
    crowded = found.filter(F.col("shard").isNotNull()).select("shard", F.col("a").alias("fp"))
    if crowded.isEmpty():
        return links
    within = _linked(block_pairs(crowded, radius), radius, None).select("a", "b")
    return links.unionByName(stored(within, "simhash-crowded"))


def _linked(dealt: DataFrame, radius: int, most: int | None) -> DataFrame:
    ordered = dealt.repartition("shard").sortWithinPartitions("shard")
    return map_arrow(ordered, _links_of_shards(radius, most), "a bigint, b bigint, shard bigint")


def _classes(docs: DataFrame, shingle: int, radius: int, keep: list[str], text: str) -> DataFrame:
    """The kept columns with fp, the root of its class and the class's least doc_id."""
    prints = stored(with_fingerprints(docs, keep, shingle, text), "simhash")
    points = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-points")
    roots = component_roots(linked_prints(points.select("fp"), radius))
    rooted = points.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select(*keep, "fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    radius: int = 4,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """doc_id (and other kept columns), fp and component_id of every row.

    ``component_id`` is the smallest document id that links of at most
    ``radius`` bits reach, the row's own included; null ids are passed over and
    it is null only where a component has no other. Texts without words, null
    texts too, have fingerprint 0 and link like any other. Repeated rows all
    come back. An empty table gives no rows.
    """
    return _classes(docs, shingle, radius, list(keep), text_col).drop("root")


def without_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each group stays: the smallest document id, its own columns only.

    Among rows with that id the first in the table's files stays; a null id
    stays only where the group has no other.
    """
    keyed, keys = with_row_keys(docs, "dedup-docs")
    found = _classes(keyed, shingle, radius, ["doc_id", *keys], "text")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *keys)
    firsts = found.groupBy("root").agg(F.min(order).alias("first"))
    kept = firsts.select(*[F.col("first")[key].alias(key) for key in keys])
    return keyed.join(kept, keys, "left_semi").select(*docs.columns)
