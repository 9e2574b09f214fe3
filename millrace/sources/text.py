"""Plain text files, one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One column ``value``; lines end at \\n, \\r\\n or \\r. Globs are allowed."""
    return spark.read.text(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.text(path)


SPLIT = ["file", "start", "length"]


def _in_splits(lines: DataFrame) -> DataFrame:
    """Lines with the piece of the file they were read in and a number that grows in it."""
    known = F.col("_metadata")
    return lines.select(
        known["file_path"].alias("file"),
        known["file_block_start"].alias("start"),
        known["file_block_length"].alias("length"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _split_starts(lines: DataFrame) -> DataFrame:
    """One row for each piece of a file: the lines ahead of it, and ahead of its file."""
    counted = lines.groupBy(*SPLIT).agg(F.count("*").alias("lines"), F.min("place").alias("first"))
    # One row for each piece: some hundred thousand for 100 TB.
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counted.select("*", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("ahead"))
    of_file = F.min("ahead").over(Window.partitionBy("file"))
    return ahead.select("*", of_file.alias("file_ahead"))


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of files with their ``file``, ``line_no`` in it and ``number`` over all files, from 0.

    Files count in the order of their paths. A file may be read in several pieces:
    the first pass counts the lines of each piece, whose sums up to it are the
    numbers its lines start from, and the second pass adds the place of the line in
    its piece. No line is shuffled or sorted. A task that is run again gives the
    same numbers. Should the files have changed or have been cut otherwise between
    the passes, the second one fails rather than number lines wrongly.
    """
    lines = _in_splits(read_lines(spark, path))
    return _numbered(lines, _split_starts(lines.drop("value")))


def _numbered(lines: DataFrame, starts: DataFrame) -> DataFrame:
    renamed = starts.select(
        *[F.col(c).alias(f"of_{c}") for c in SPLIT], "lines", "first", "ahead", "file_ahead"
    )
    same = [F.col(c) == F.col(f"of_{c}") for c in SPLIT]
    # As many rows as pieces of files; Spark measures them and broadcasts if they are few.
    joined = lines.join(renamed, same, "left")
    place = F.col("place") - F.col("first")
    fits = (place >= 0) & (place < F.col("lines"))
    changed = F.raise_error(F.concat(F.lit("files changed between the passes: "), "file"))
    number = F.col("ahead") + F.when(fits, place).otherwise(changed.cast("bigint"))
    numbered = joined.select("file", "file_ahead", number.alias("number"), "value")
    line_no = (F.col("number") - F.col("file_ahead")).alias("line_no")
    return numbered.select("file", line_no, "number", "value")


def first_lines_of_files(spark: SparkSession, path: str | list[str], n: int = 10) -> DataFrame:
    """The first ``n`` lines in the order of the files, with the same columns.

    Files are taken one, two, four at a time in the order of their paths until they
    have enough lines, and no other file is read.
    """
    paths = sorted(read_lines(spark, path).inputFiles())
    taken = 1
    while taken < len(paths) and read_lines(spark, paths[:taken]).limit(n).count() < n:
        taken *= 2
    return numbered_lines(spark, paths[:taken]).filter(F.col("number") < n).orderBy("number").limit(n)
