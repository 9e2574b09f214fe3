"""How far the sources of a language differ in their words, from bitmaps of counts.

Terms that enough documents of a language have are kept. Each group (language and
source) and each count it has for a term gives a bitmap of the terms with just that
count, in words of 64 bits. For two groups, AND and the number of set bits give the
joint cells: how many terms have count a in the one and count b in the other. The
divergence of a pair is a sum over all kept terms, so each cell counts with the
value of one term. Cells in which a count is zero are complements: the terms of a
level less those in its cells with the other group, and the kept terms less both.
With ``f(a, b)`` the value of a cell and V kept terms, that sum is

    sum n(a, b) * (f(a, b) - f(a, 0) - f(0, b) + f(0, 0))
    + sum n(a) * (f(a, 0) - f(0, 0)) + sum n(b) * (f(0, b) - f(0, 0)) + V * f(0, 0)

over positive counts a and b, so no row is made for a term that a group lacks.
DataFrame functions only; all numbers are integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

SCALE = 1_000_000_000
BETWEEN_TERMS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GROUP = ["lang", "source"]


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences ``n`` and documents ``df`` of every term in each group.

    Each group has a row with the empty term too, so that groups without terms
    are known. A text gives its terms once as they stand and once each; both are
    added up within the task before anything is shuffled.
    """
    filled = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in GROUP],
        F.translate(F.coalesce(F.col(text), F.lit("")), CAPITALS, CAPITALS.lower()).alias("small"),
    )
    cut = filled.select(*GROUP, F.split("small", BETWEEN_TERMS).alias("terms"))
    # An empty string before the first or after the last term marks the group.
    cut = cut.select(*GROUP, F.array_append("terms", F.lit("")).alias("terms"))
    both = F.posexplode(F.array("terms", F.array_distinct("terms"))).alias("once", "terms")
    each = cut.select(*GROUP, both).select(*GROUP, "once", F.explode("terms").alias("term"))
    return each.groupBy(*GROUP, "term").agg(
        F.sum(F.lit(1) - F.col("once")).alias("n"), F.sum("once").alias("df")
    )


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """Terms in ``least_docs`` documents of their language, numbered for the bitmaps.

    Terms of a partition are numbered by falling count, so that those that share a
    word of a bitmap have few different counts. Numbers need no order over the
    whole table, so none is made.
    """
    kept = (
        counts.filter(F.col("term") != "")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
        .filter(F.col("df") >= least_docs)
        .sortWithinPartitions("lang", F.desc("lang_n"), "term")
    )
    return kept.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("number"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """The smoothed share of a term in billionths, an integer of at least one."""
    wide = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", wide, (total + 2 * kept).cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def bitmaps(cells: DataFrame) -> DataFrame:
    """For each group and count the set of its terms: 64 bits a row, empty words left out."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("number").bitwiseAND(63).cast("int"))
    return cells.groupBy(*GROUP, "n", F.shiftright("number", 6).alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )


def group_totals(counts: DataFrame, kept: DataFrame, cells: DataFrame) -> DataFrame:
    """Every group with its total of kept terms, and its language's V and total."""
    languages = kept.groupBy("lang").agg(F.count("*").alias("V"), F.sum("lang_n").alias("lang_total"))
    return (
        counts.groupBy(*GROUP)
        .agg(F.lit(0).alias("seen"))
        .join(cells.groupBy(*GROUP).agg(F.sum("n").alias("total")), GROUP, "left")
        .join(languages, "lang", "left")
        .na.fill(0, ["total", "V", "lang_total"])
        .select(*GROUP, "total", "V", "lang_total")
    )


def pair_values(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """The divergence of every two sources of a language, both ways round."""
    # The share of a term that the group lacks; without kept terms there is none.
    lacking = F.when(F.col("V") > 0, share(F.lit(0), F.col("total"), F.col("V")))
    known = groups.select(*GROUP, "total", "V", lacking.alias("zero"))
    shared = levels.join(known, GROUP).select(
        *GROUP, "word", "bits", share(F.col("n"), F.col("total"), F.col("V")).alias("p"), "zero"
    )
    left, right = (
        shared.select("lang", "word", *[F.col(c).alias(f"{c}_{side}") for c in ("source", "bits", "p", "zero")])
        for side in ("l", "r")
    )
    both = F.col("bits_l").bitwiseAND(F.col("bits_r"))
    meeting = (F.col("source_l") < F.col("source_r")) & (both != 0)
    excess = (
        gap(F.col("p_l"), F.col("p_r"))
        - gap(F.col("p_l"), F.col("zero_r"))
        - gap(F.col("zero_l"), F.col("p_r"))
        + gap(F.col("zero_l"), F.col("zero_r"))
    )
    joint = (
        left.join(right, ["lang", "word"])
        .filter(meeting)
        .groupBy("lang", "source_l", "source_r")
        .agg(F.sum(F.bit_count(both) * excess).alias("joint"))
    )
    # The same cell for both orders of a pair.
    joint = joint.union(joint.select("lang", F.col("source_r"), F.col("source_l"), "joint"))
    sizes = shared.groupBy(*GROUP, "p", "zero").agg(F.sum(F.bit_count("bits")).alias("terms"))
    one, other = (
        known.select("lang", "V", *[F.col(c).alias(f"{c}_{side}") for c in ("source", "zero")])
        for side in ("l", "r")
    )
    pairs = one.join(other.drop("V"), "lang").filter(F.col("source_l") != F.col("source_r"))
    nothing = gap(F.col("zero_l"), F.col("zero_r"))
    alone = (
        sizes.withColumnRenamed("source", "source_l")
        .withColumnRenamed("zero", "zero_l")
        .join(other.drop("V"), "lang")
        .filter(F.col("source_l") != F.col("source_r"))
        .groupBy("lang", "source_l", "source_r")
        .agg(F.sum(F.col("terms") * (gap(F.col("p"), F.col("zero_r")) - nothing)).alias("alone"))
    )
    ends = ["lang", "source_l", "source_r"]
    turned = alone.select("lang", F.col("source_r").alias("source_l"), F.col("source_l").alias("source_r"), F.col("alone").alias("turned"))
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in ("joint", "alone", "turned")]
    empty = F.coalesce(F.col("V") * nothing, F.lit(0))
    return (
        pairs.join(joint, ends, "left")
        .join(alone, ends, "left")
        .join(turned, ends, "left")
        .select(
            "lang",
            F.col("source_l").alias("source"),
            F.lit("pair").alias("part"),
            F.col("source_r").alias("item"),
            (parts[0] + parts[1] + parts[2] + empty).cast("bigint").alias("value"),
        )
    )


def marked_terms(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """The terms of a group that are more frequent there than in its language."""
    p = share(F.col("n"), F.col("total"), F.col("V"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("V"))
    return (
        cells.join(groups, GROUP)
        .select(*GROUP, "term", p.alias("p"), q.alias("q"))
        .filter(F.col("p") > F.col("q"))
        .select(
            *GROUP,
            F.lit("term").alias("part"),
            F.col("term").alias("item"),
            gap(F.col("p"), F.col("q")).alias("value"),
        )
    )


def divergence(
    docs: DataFrame, text: str = "text", least_docs: int = 10, top: int = 10
) -> DataFrame:
    """For each language and source its distance to the others and its marked terms.

    Part ``pair`` has a row for each other source of the language, part ``term``
    the ``top`` terms that are more frequent in the source than in the language;
    ranks go from 1, equal values in the order of the items. Null in any of the
    three columns is the empty text; a source whose texts are empty is a group like
    any other; repeated rows count as often as they stand; very long texts are
    whole; other columns are ignored; an empty table gives no rows.
    """
    counts = stored(term_counts(docs, text), "divergence-counts")
    kept = stored(kept_terms(counts, least_docs), "divergence-terms")
    found = counts.filter(F.col("term") != "").join(kept, ["lang", "term"])
    cells = stored(found.select(*GROUP, "term", "n", "lang_n", "number"), "divergence-cells")
    groups = stored(group_totals(counts, kept, cells), "divergence-groups")
    levels = stored(bitmaps(cells), "divergence-bitmaps")
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    pairs = pair_values(levels, groups).select("*", rank)
    # Ranks up to a limit are cut within the tasks first.
    terms = marked_terms(cells, groups).select("*", rank).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)
