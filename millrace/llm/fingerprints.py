"""SimHash fingerprints of documents, and permuted block tables to search them.

A text's terms are its pairs of neighbouring words. Each term's hash votes on 64
bits with the term's weight: for a bit that is set, against one that is not.
Longer words weigh more, since they are rarer. Votes are counted three bits to a
number, so the sums of one term take 22 additions in compiled code and nothing
but a few numbers for each text is shuffled. DataFrame functions only.
"""

from __future__ import annotations

import json
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

BITS = 64
# Three counters of 21 bits in one number.
FIELD = 21
SPREAD = 1 + (1 << (FIELD - 1)) + (1 << 2 * (FIELD - 1))
ONES = 1 + (1 << FIELD) + (1 << 2 * FIELD)
HEAVIEST = 16
# So many terms of the heaviest weight fit a counter.
PART_TERMS = (1 << FIELD) // HEAVIEST // 2
# Fingerprints of one key of a block table that a task compares with others of it.
MOST_OF_KEY = 2_000
RADIUS = 3


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """The keys, which name a row, with ``fp`` of its text (a signed 64-bit number).

    Words are lower-cased and separated by white space. A text without words,
    or null, has the fingerprint of the empty word; equal texts have equal ones.
    """
    spaced = F.translate(F.lower(F.coalesce(F.col(text), F.lit(""))), "\t\n\x0b\f\r", " " * 5)
    words = F.filter(F.split(F.trim(spaced), " "), lambda w: w != "")
    words = F.when(F.size(words) > 0, words).otherwise(F.array(F.lit("")))
    listed = texts.select(*keys, words.alias("words"))
    pairs = F.arrays_zip(
        F.col("words").alias("word"),
        F.slice("words", F.lit(2), F.size("words")).alias("after"),
    )
    exploded = listed.select(*keys, F.posexplode(pairs).alias("term_place", "pair"))
    word, after = F.col("pair.word"), F.col("pair.after")
    weight = F.least(F.length(word) + F.coalesce(F.length(after), F.lit(0)) + 1, F.lit(HEAVIEST))
    terms = exploded.select(
        *keys,
        F.shiftright("term_place", PART_TERMS.bit_length() - 1).alias("term_part"),
        F.xxhash64(word, after).alias("h"),
        weight.cast("bigint").alias("w"),
    )
    groups = range(0, BITS, 3)
    three = lambda b: F.shiftrightunsigned("h", b).bitwiseAND(F.lit(7))
    votes = [
        F.sum((three(b) * F.lit(SPREAD)).bitwiseAND(F.lit(ONES)) * F.col("w")).alias(f"v{b}")
        for b in groups
    ]
    counted = terms.groupBy(*keys, "term_part").agg(F.sum("w").alias("w"), *votes)
    field = lambda b: F.shiftright(f"v{b - b % 3}", b % 3 * FIELD).bitwiseAND(
        F.lit((1 << FIELD) - 1)
    )
    # Very long texts come in several parts.
    whole = counted.groupBy(*keys).agg(
        F.sum("w").alias("w"), *[F.sum(field(b)).alias(f"b{b}") for b in range(BITS)]
    )
    fp: Column = F.lit(0).cast("bigint")
    for b in range(BITS):
        bit = (1 << b) - (1 << BITS if b == BITS - 1 else 0)
        fp = fp.bitwiseOR(F.when(F.col(f"b{b}") * 2 > F.col("w"), F.lit(bit)).otherwise(F.lit(0)))
    return whole.select(*keys, fp.alias("fp"))


def hex_print(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def near_prints(
    queries: DataFrame, prints: DataFrame, radius: int, clean: int = 2
) -> DataFrame:
    """(query_fp, fp, distance) of all distinct fingerprints within ``radius`` bits.

    The bits are cut into ``radius + clean`` blocks; of any such pair at least
    ``clean`` blocks agree. For each choice of blocks there is one table, in
    which the chosen blocks come first and are looked up as a key. A pair comes
    out once, from the first table whose blocks agree. Null fingerprints find
    and are found by nothing.
    """
    blocks = radius + clean
    if not 0 <= radius or blocks > BITS:
        raise ValueError("radius and clean blocks must fit the bits of a fingerprint")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    signed = lambda x: x - (1 << BITS) if x >> (BITS - 1) else x
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    choices = [signed(sum(chosen)) for chosen in combinations(masks, clean)]

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = [
            F.struct(F.lit(i).alias("n"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key"))
            for i, mask in enumerate(choices)
        ]
        distinct = df.select("fp").filter(F.col("fp").isNotNull()).distinct()
        return distinct.select(F.col("fp").alias(name), F.inline(F.array(*keys)))

    apart = F.col("query_fp").bitwiseXOR(F.col("fp"))
    first = F.coalesce(
        *[F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(choices)]
    )
    held = tables(prints, "fp")
    # Keys with many fingerprints, of which there are few: they are dealt to several tasks.
    crowded = (
        held.groupBy("n", "key")
        .agg(F.ceil(F.count("*") / MOST_OF_KEY).cast("int").alias("shares"))
        .filter(F.col("shares") > 1)
    )
    shares = F.coalesce("shares", F.lit(1))
    dealt = held.join(crowded, ["n", "key"], "left").withColumn(
        "share", F.pmod(F.xxhash64("fp"), shares).cast("int")
    )
    asked = tables(queries, "query_fp").join(crowded, ["n", "key"], "left")
    asked = asked.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))
    return (
        asked.drop("shares")
        .join(dealt.drop("shares"), ["n", "key", "share"])
        .withColumn("distance", F.bit_count(apart))
        .filter((F.col("distance") <= radius) & (F.col("n") == first))
        .select("query_fp", "fp", "distance")
    )


def neighbours(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, near_prints): how many other fingerprints lie within ``radius`` bits, if any do.

    Pairs are counted where they are found; a group of m fingerprints that are all
    near each other takes m * m comparisons, dealt to tasks, and no more rows than m.
    """
    pairs = near_prints(prints, prints, radius).filter("distance > 0")
    counts = pairs.groupBy("query_fp").agg(F.count("*").alias("near_prints"))
    return counts.withColumnRenamed("query_fp", "fp")


def _below(bounds: list[int], value: Column) -> Column:
    """How many of the ascending bounds are below a value, found by halving."""
    held = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def halve(found: Column, step: Column) -> Column:
        return F.when(F.get(held, found + step - 1) < value, found + step).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, steps)).cast("array<int>"), F.lit(0), halve)


def in_ranges(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text, digest and ``part``, a number for each range of document ids."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    shares = [i / parts for i in range(1, parts)]
    # As many numbers as parts.
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0] or []
    part = _below(sorted(set(bounds)), F.col("doc_id"))
    part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(part)
    return rows.withColumn("part", part).withColumn("digest", F.xxhash64("text"))


ORDER = ["doc_id", "digest", "text"]


def document_fingerprints(
    docs: DataFrame, parts: int | None = None, radius: int = RADIUS
) -> DataFrame:
    """Fingerprints of every text and of the text with its last quarter replaced.

    ``near_prints`` is the number of other fingerprints of texts within ``radius``
    bits of the text's, found in permuted block tables.

    The last floor(n_chars / 4) code points give way to the first as many (or
    all) of the next document's, in ascending doc_id, the first after the last.
    Null ids come first, rows with equal ids go by a digest of the text; a
    single document is its own next. A null text is empty. Other columns are
    ignored; an empty table gives no rows.

    The order comes from ranges of ids, each sorted on its own; the first
    document of each range is looked up as the next of the range before.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = in_ranges(docs, parts)
    within = Window.partitionBy("part").orderBy(*ORDER)
    # One short row for each range, then their first texts.
    firsts = stored(
        rows.groupBy("part").agg(F.min(F.struct("doc_id", "digest")).alias("first")),
        "fingerprint-firsts",
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(
        F.lead("part").over(Window.orderBy("part")), F.min("part").over(everything)
    )
    next_part = stored(
        firsts.select("part", following.alias("next_part")), "fingerprint-next"
    )
    head = (
        rows.join(firsts.select("part", "first"), "part")
        .filter(
            F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
            & (F.col("digest") == F.col("first.digest"))
        )
        .groupBy(F.col("part").alias("next_part"))
        .agg(F.min("text").alias("head_text"))
    )
    heads = next_part.join(head, "next_part").select("part", "head_text")

    placed = rows.select(
        "part",
        "doc_id",
        "text",
        F.row_number().over(within).alias("place"),
        F.lead("text").over(within).alias("after"),
    )
    length = F.char_length("text")
    quarter = F.floor(length / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), length - quarter),
        F.substring(F.coalesce("after", "head_text"), F.lit(1), quarter),
    )
    names = ["part", "place", "doc_id", "n_chars", "edited_sha256"]
    sides = (
        placed.join(heads, "part")
        .withColumn("edited", edited)
        .withColumn("n_chars", length.cast("bigint"))
        .select(
            *names[:4],
            F.sha2(F.col("edited"), 256).alias("edited_sha256"),
            F.inline(
                F.array(
                    F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("side")),
                    F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("side")),
                )
            ),
        )
    )
    found = fingerprints(sides, [*names, "is_edited"], "side")
    both = stored(
        found.groupBy(*names).agg(
            F.max(F.when(~F.col("is_edited"), F.col("fp"))).alias("fp"),
            F.max(F.when(F.col("is_edited"), F.col("fp"))).alias("edited_fp"),
        ),
        "fingerprints",
    )
    first_prints = both.filter(F.col("place") == 1).select(
        F.col("part").alias("next_part"), F.col("fp").alias("head_fp")
    )
    ahead = Window.partitionBy("part").orderBy("place")
    after = both.withColumn("after_fp", F.lead("fp").over(ahead))
    near = stored(neighbours(both.select("fp"), radius), "fingerprint-neighbours")
    return (
        after.join(next_part.join(first_prints, "next_part").drop("next_part"), "part")
        .withColumn("next_fp", F.coalesce("after_fp", "head_fp"))
        .join(near, "fp", "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            hex_print("fp").alias("fingerprint"),
            hex_print("edited_fp").alias("edited_fingerprint"),
            likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
            likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
            F.coalesce("near_prints", F.lit(0).cast("bigint")).alias("near_prints"),
        )
    )
