"""Token ids of documents in ORC files, in ascending order of document ids.

Each file holds a range of ids, sorted, with the number of its range. ORC stores the ids run-length encoded,
keeps minima and maxima for every stripe and row group, and a Bloom filter on
the document id; stripes are read in parallel, and a lookup of a few documents
skips the stripes and row groups that cannot hold them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, text_slices
from millrace.llm.tokens import END_ID, SLICE_BYTES, TOKENIZER, encoder

FILE_SCHEMA = "doc_id bigint, part bigint, first bigint, n_tokens bigint, ids array<int>"
END_BYTES = END_ID.to_bytes(4, "little")


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    stripe_bytes: int = 64 * 1024 * 1024,
    row_index_stride: int = 10_000,
    bloom_fpp: float = 0.01,
) -> None:
    """Write the ids of every whole text, an end id after each, as ORC.

    A null text has the end id alone. A null document id sorts first. Rows with
    the same document id are all kept, ordered by a digest of their text.
    Very long texts are encoded one at a time. Other columns are ignored. An empty
    table gives readable files without rows.
    """
    path_of_tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    ordered = (
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
        .withColumn("digest", F.xxhash64("text"))
        .repartitionByRange("doc_id", "digest")
        .sortWithinPartitions("doc_id", "digest")
        .select("doc_id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(path_of_tokenizer).encode
        # Ranges are numbered in the order of the ids; names of files are in no number's order.
        part, first = TaskContext.get().partitionId(), 0
        for batch, texts in text_slices(batches, limit=SLICE_BYTES):
            held = [part + END_BYTES for part in encode_texts(texts)]
            counts = np.fromiter((len(x) // 4 for x in held), dtype=np.int64, count=len(held))
            stops = np.cumsum(counts)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], stops]), pa.int32()),
                pa.array(np.frombuffer(b"".join(held), dtype="<i4")),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(counts), part)),
                    pa.array(first + stops - counts),
                    pa.array(counts),
                    ids,
                ],
                names=["doc_id", "part", "first", "n_tokens", "ids"],
            )
            first += int(stops[-1])

    (
        map_arrow(ordered, encode, FILE_SCHEMA)
        .write.option("orc.create.index", "true")
        .option("orc.row.index.stride", row_index_stride)
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", bloom_fpp)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", 0)
        .orc(path)
    )


def read_ids(
    spark: SparkSession,
    path: str,
    doc_ids: Iterable[int] | None = None,
    checksum: bool = False,
) -> DataFrame:
    """Columns doc_id, start, n_tokens, ids of the files under ``path``.

    ``start`` is the number of ids of all documents before. ``doc_ids`` of a few
    documents becomes a filter that the files' statistics and Bloom filters
    see; a start then still counts all documents. ``checksum`` gives ids_crc32,
    the crc32 of the ids as little-endian unsigned 32-bit integers, in place of
    the ids, which then stay in the task that reads them.
    """
    files = spark.read.schema(FILE_SCHEMA).orc(path)
    rows = files if doc_ids is None else files.filter(F.col("doc_id").isin(list(doc_ids)))
    rows, last = rows.select("doc_id", "part", "first", "n_tokens", "ids"), "ids"
    if checksum:
        schema = "doc_id bigint, part bigint, first bigint, n_tokens bigint, ids_crc32 bigint"
        rows, last = map_arrow(rows, _checksums, schema), "ids_crc32"
    start = (F.col("base") + F.col("first")).alias("start")
    return rows.join(range_starts(files), "part").select("doc_id", start, "n_tokens", last)


def range_starts(files: DataFrame) -> DataFrame:
    """The number of ids before each range, ``base``, whatever files the range lies in."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range.
    return (
        files.groupBy("part")
        .agg(F.sum("n_tokens").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    )


# Arrow holds the ids as 32-bit numbers, little-endian on all machines Spark runs on.
def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        held = memoryview(lists.values.to_numpy()).cast("B")
        sums = [zlib.crc32(held[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(sums, pa.int64())],
            names=[*batch.schema.names[:4], "ids_crc32"],
        )
