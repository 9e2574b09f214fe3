"""Fill-in-the-middle: documents cut in three and put in another order, by secondary sort.

Every document becomes pieces of some thousand characters, keyed by its row and
the place they have in the output. Rows are dealt to partitions by the key and
sorted there by key and place (``repartition`` and ``sortWithinPartitions``, the
DataFrame form of ``repartitionAndSortWithinPartitions``), so the pieces of a
document stream by in the order of the output and a digest takes them one at a
time: no document is ever held whole after it is cut. The original comes back the
same way: the stream of output pieces is read for its marks, which gives each
piece its place in the document, and a second sort within the same partitions,
without a second shuffle, puts them in that order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import as_scan, map_arrow, text_slices

MARKS = ("<P>", "<S>", "<M>")
# Order of the sections in the output, by form: prefix 0, suffix 1, middle 2.
ORDERS = {"psm": (0, 1, 2), "spm": (1, 0, 2)}
# Place of a section in the document.
IN_TEXT = (0, 2, 1)
CHUNK = 2048
SLICE_BYTES = 1_000_000

HEAD = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
PIECES = f"document bigint, place bigint, piece string, {HEAD}"
RESTORED = "document bigint, section int, place bigint, piece string, output_sha256 string, " + HEAD
DIGESTS = HEAD + ", output_sha256 string, restored_sha256 string"
TEXTS = HEAD + ", output string"


@dataclass(frozen=True)
class Shares:
    """Of a hundred documents, those left plain and, of the rest, those in order spm."""

    plain: int = 10
    spm: int = 20
    seed: str = "1"


def draws(doc_id: int | None, seed: str) -> tuple[int, int, int, int]:
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def plan(text: str, doc_id: int | None, shares: Shares) -> tuple[str, int, int]:
    """The form, and where prefix and middle end."""
    h1, h2, h3, h4 = draws(doc_id, shares.seed)
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= 100 - shares.plain:
        return "plain", 0, 0
    first, second = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return ("spm" if h4 % 100 < shares.spm else "psm"), first, second


def output_pieces(text: str, form: str, first: int, second: int, chunk: int) -> Iterator[tuple[int, str]]:
    """Place and text of each piece of the output; a mark is never divided."""
    if form == "plain":
        spans = [("", 0, len(text))]
    else:
        sections = [(0, first), (second, len(text)), (first, second)]
        spans = [(MARKS[i], *sections[i]) for i in ORDERS[form]]
    place = 0
    for mark, start, stop in spans:
        begin = start
        while begin == start or begin < stop:
            piece = mark + text[begin : min(begin + chunk, stop)]
            yield place, piece
            place += len(piece)
            mark, begin = "", begin + chunk


def cut(
    docs: DataFrame,
    shares: Shares = Shares(),
    chunk: int = CHUNK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The output of every document in pieces; the first one carries what is known of it."""
    scan = as_scan(docs, "middles-docs")
    narrow = scan.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A scan gives a partition the same rows in the same order whenever it is read.
        document = TaskContext.get().partitionId() << 40
        for batch, texts in text_slices(batches, limit=SLICE_BYTES):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts.to_pylist()):
                form, first, second = plan(text, doc_id, shares)
                sizes = (None, None) if form == "plain" else (first, second - first)
                head, later = (doc_id, len(text), form, *sizes), (None,) * 5
                rows += [
                    (document, place, piece, *(later if place else head))
                    for place, piece in output_pieces(text, form, first, second, chunk)
                ]
                document += 1
            yield _batch(rows, PIECES)

    return map_arrow(narrow, pieces, PIECES)


def in_output_order(pieces: DataFrame) -> DataFrame:
    """The pieces of a document behind each other in one partition: the only shuffle."""
    return pieces.repartition("document").sortWithinPartitions("document", "place")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns))


class Output:
    """One document's output as it streams by: its digest, and where its pieces belong."""

    def __init__(self, document: int, head: tuple):
        self.document, self.head = document, head
        self.digest = hashlib.sha256()
        form = head[2]
        self.coming = list(ORDERS.get(form, ()))
        self.section, self.place = 0, 0

    def take(self, piece: str) -> Iterator[tuple[int, int, str]]:
        """Section in the document, place in it, and text of what the piece holds."""
        self.digest.update(piece.encode())
        while self.coming and (at := piece.find(MARKS[self.coming[0]])) >= 0:
            if at:
                yield IN_TEXT[self.section], self.place, piece[:at]
            piece = piece[at + len(MARKS[self.coming[0]]) :]
            self.section, self.place = self.coming.pop(0), 0
        if piece:
            yield IN_TEXT[self.section], self.place, piece
            self.place += len(piece)

    def row(self) -> tuple:
        return (self.document, -1, 0, "", self.digest.hexdigest(), *self.head)


def _read_output(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the outputs, and their pieces with the place they have in the document."""
    now: Output | None = None
    nothing = (None,) * 6
    for batch in batches:
        rows = []
        for document, _, piece, *head in _rows(batch):
            if now is None or now.document != document:
                if now:
                    rows.append(now.row())
                now = Output(document, tuple(head))
            rows += [(document, *found, *nothing) for found in now.take(piece)]
        yield _batch(rows, RESTORED)
    if now:
        yield _batch([now.row()], RESTORED)


def _digest_restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document; its head comes before its pieces."""
    known, digest, current = None, None, None
    for batch in batches:
        rows = []
        for document, _, _, piece, output_sha256, *head in _rows(batch):
            if document != current:
                if known:
                    rows.append((*known, digest.hexdigest()))
                current, known, digest = document, (*head, output_sha256), hashlib.sha256()
            digest.update(piece.encode())
        yield _batch(rows, DIGESTS)
    if known:
        yield _batch([(*known, digest.hexdigest())], DIGESTS)


def digests(docs: DataFrame, **how) -> DataFrame:
    """One row a document: its form, the sizes of its sections, digests of output and restored text.

    ``output_sha256`` is the digest of the output, ``restored_sha256`` that of the
    text put together from the output and the form alone. A null text is empty and
    plain; a null id draws like the empty name; repeated rows come back each on its
    own; a text of any length passes in pieces; other columns are ignored; an empty
    table gives no rows.
    """
    output = in_output_order(cut(docs, **how))
    read = map_arrow(output, _read_output, RESTORED)
    # Still one partition a document, so this sorts without a shuffle.
    back = read.sortWithinPartitions("document", "section", "place")
    return map_arrow(back, _digest_restored, DIGESTS)


def _join_output(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, known, parts = None, None, []
    for batch in batches:
        rows = []
        for document, _, piece, *head in _rows(batch):
            if document != current:
                if known:
                    rows.append((*known, "".join(parts)))
                current, known, parts = document, tuple(head), []
            parts.append(piece)
        yield _batch(rows, TEXTS)
    if known:
        yield _batch([(*known, "".join(parts))], TEXTS)


def transformed(docs: DataFrame, **how) -> DataFrame:
    """The same rows with the output itself; a worker holds one document's at a time."""
    return map_arrow(in_output_order(cut(docs, **how)), _join_output, TEXTS)


def restored(output: str, form: str) -> str:
    """The text of an output, for a single one."""
    if form == "plain":
        return output
    sections = Output(0, (None, None, form, None, None)).take(output)
    return "".join(piece for *_, piece in sorted(sections))
