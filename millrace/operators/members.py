"""Removing listed values and gathering the members of groups."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A filter of listed values: its most words of 64 bits (8 MB), the values a word
# takes on average, and the bits a value sets in its word.
MOST_WORDS = 1 << 20
VALUES_OF_WORD = 4
BITS = 5


def without_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose ``column`` is none of a few given values; other rows keep all copies.

    The list becomes a filter, so nothing is joined and the scan can use it.
    A null row goes only if the list holds a null.
    """
    listed = [v for v in values if v is not None]
    kept: Column = F.col(column).isNull() | ~F.col(column).isin(listed)
    if len(listed) < len(values):
        kept = kept & F.col(column).isNotNull()
    return df.filter(kept)


def without_listed(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose ``column`` does not occur in the one-column frame ``values``.

    Null counts as a value. No broadcast is forced: the list may be as large
    as the data, so Spark measures it and, failing that, sorts and merges,
    splitting any partition that a frequent value makes too large.
    """
    listed = values.toDF("listed").distinct()
    return df.join(listed, F.col(column).eqNullSafe(F.col("listed")), "left_anti")


def _word(column: Column, words: int) -> Column:
    """The word of the filter that a value belongs to; ``words`` is a power of two."""
    return F.xxhash64(column).bitwiseAND(F.lit(words - 1).cast("bigint"))


def _bits(column: Column) -> Column:
    """The bits that a value sets in its word, by six bits of another hash each."""
    digest, one = F.xxhash64(F.lit("bits"), column), F.lit(1).cast("bigint")
    found = None
    for i in range(BITS):
        place = F.shiftrightunsigned(digest, 6 * i).bitwiseAND(F.lit(63).cast("bigint"))
        bit = F.call_function("shiftleft", one, place.cast("int"))
        found = bit if found is None else found.bitwiseOR(bit)
    return found


def value_filter(values: DataFrame, words: int) -> DataFrame:
    """One row, ``filter``: a Bloom filter of the values in an array of ``words`` words.

    Words are added up within the tasks first; the last step gathers ``words`` rows
    at most, which the caller bounds.
    """
    listed = values.toDF("listed")
    own = listed.select(_word(F.col("listed"), words).alias("word"), _bits(F.col("listed")).alias("bits"))
    every = values.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    summed = own.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    rows = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return summed.agg(rows["bits"].alias("filter"))


def may_be_listed(column: Column, filter_: Column, words: int) -> Column:
    """False for a value that is surely not in the filter; true for all that are."""
    word = F.element_at(filter_, (_word(column, words) + 1).cast("int"))
    bits = _bits(column)
    return word.bitwiseAND(bits) == bits


def without_many_listed(
    df: DataFrame, column: str, values: DataFrame, most_words: int = MOST_WORDS
) -> DataFrame:
    """The same rows as ``without_listed``, where the list is long and few rows are on it.

    A Bloom filter of the list goes to every task: rows outside it are kept where
    they are, and only the others, those on the list and about a hundredth of the
    rest, are shuffled to the list and joined. The table is read twice, so give a
    scan or a stored table. The filter has a word for every ``VALUES_OF_WORD``
    values and ``most_words`` at most; a list too long for that is joined as a
    whole, since a crowded filter would let every row through.
    """
    listed = values.toDF("listed").distinct()
    count = values.count()
    words = 1 << max(0, math.ceil(math.log2(max(count, 1) / VALUES_OF_WORD)))
    if words > most_words:
        return without_listed(df, column, values)
    # Computed once, on the driver's side of the plan.
    known = value_filter(values, words).scalar()
    maybe = may_be_listed(F.col(column), known, words)
    return df.filter(~maybe).unionByName(without_listed(df.filter(maybe), column, listed))


def group_members(df: DataFrame, key: str, member: str) -> DataFrame:
    """The members of each group: one row for each (key, member), with its copies.

    Copies are added up before the shuffle, and no row depends on how many
    others its group has. Null is a key and a member like any other.
    """
    return df.groupBy(key, member).agg(F.count("*").alias("copies"))


def member_lists(df: DataFrame, key: str, member: str, buckets: int) -> DataFrame:
    """The same as lists, ``buckets`` of them for every group, by a digest of the member.

    A row put in changes only the list its member belongs to. The caller says
    how far the largest group has to be divided; a list holds about the
    group's distinct members by ``buckets``. Lists without members are left out.
    """
    if buckets < 1:
        raise ValueError("buckets is at least 1")
    entry = F.struct(F.col(member).alias("member"), "copies")
    return (
        group_members(df, key, member)
        .select(key, F.pmod(F.xxhash64(member), F.lit(buckets)).cast("int").alias("bucket"), entry.alias("entry"))
        .groupBy(key, "bucket")
        .agg(F.sort_array(F.collect_list("entry")).alias("members"))
    )
