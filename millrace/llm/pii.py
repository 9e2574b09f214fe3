"""Personal data by fixed forms and by bootstrapped contexts.

Four forms (email, ip, card, phone) are found by rule; they are the seeds. The
one and the two words before an instance, and the words on both sides of it, are its
lexical patterns. Every token that looks like an identifier (5 characters or more, with 4
digits or an at sign) is an instance of the patterns around it, whether a rule
knows it or not; groups of digits joined by single spaces, dots, hyphens or
brackets are one instance. Patterns are whole words, as far as the line and the
next instance go.

Patterns and instances form a graph that is scored in rounds: a pattern is as good
as the share of its occurrences, with any word there, that are believed instances of
one kind; an instance is believed as far as its accepted patterns are, and what is
believed in one place is believed wherever it stands. So instances that one round
discovers are the seeds of the patterns of the next. Believed instances that no
rule knows are added to the spans, in all their places.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    fresh_names,
    map_arrow,
    stored,
    text_chunks,
    text_slices,
    with_row_keys,
)

KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind:string,start:bigint,stop:bigint>>"
HINT = (
    "array<struct<patterns:array<string>,kind:string,instance:string,"
    "start:bigint,stop:bigint>>"
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its first digit only: a later start fails alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile("[^0-9]")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"\S+")
_EDGES = "\"'`.,;:!?()[]{}<>|*#&$%=“”‘’«»"
# A token that is groups of digits, without the punctuation around it.
_GROUPS = re.compile(
    rf"[{re.escape(_EDGES)}]*?(\+?\(?[0-9]++(?:\)?[.-]?\(?[0-9]++)*+\)?)[{re.escape(_EDGES)}]*"
)
SLICE_BYTES = 1_000_000
_OPENING = " \t\"'`([{<|*“‘«"
_CLOSING = " \t\"'`.,;:!?)]}>|*”’»"
# Stands for the instance in patterns on both sides; no word holds white space.
HOLE = "\t"
LONGEST_INSTANCE = 200
LONGEST_WORD = 40
FILTER_BITS = 24
MOST_COUNTED = 200_000


def emails(text: str) -> list[tuple[int, int]]:
    spans, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            spans.append((start, found.end()))
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    return spans


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if place % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by rule: leftmost, not overlapping within a kind, by kind and start."""
    spans = [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return spans
    for found in _IP.finditer(text):
        parts = found.group().split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            spans.append(("ip", found.start(), found.end()))
    for found in _CARD.finditer(text):
        if len(found.group()) >= 13:
            digits = _NO_DIGIT.sub("", found.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", found.start(), found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", found.group())) <= 15:
                spans.append(("phone", found.start(), found.end()))
    return spans


def looks_like_identifier(token: str) -> bool:
    digits = len(token) - len(_DIGIT.sub("", token))
    return len(token) >= 5 and (digits >= 4 or ("@" in token and len(token.strip("@")) >= 5))


def without_edges(text: str, start: int, stop: int) -> tuple[int, int]:
    part = text[start:stop]
    return stop - len(part.lstrip(_EDGES)), start + len(part.rstrip(_EDGES))


def joined_groups(text: str, tokens: list[tuple]) -> Iterator[tuple[int, int]]:
    """The places of the tokens; groups of digits with one space between are one place.

    An opening bracket before the first group belongs to it if it is closed within.
    """
    first = last = None
    for token, start, stop in [*tokens, (None, 0, 0)]:
        groups = token and _GROUPS.fullmatch(text, token.start(), token.end())
        begin, end = groups.span(1) if groups else (start, stop)
        if last is not None:
            if groups and begin == token.start() == last + 1 and text[last] == " " and text[begin] != "+":
                last = end
                if end < token.end():
                    yield run_place(text, first, last)
                    first = last = None
                continue
            yield run_place(text, first, last)
            first = last = None
        if groups and end == token.end():
            first, last = begin, end
        elif groups:
            yield run_place(text, begin, end)
        elif token:
            yield start, stop


def run_place(text: str, start: int, stop: int) -> tuple[int, int]:
    inner, stop = without_edges(text, start, stop)
    part = text[start:stop]
    return (start if part.count("(") == part.count(")") else inner), stop


def instance_key(instance: str) -> str:
    """The instance, a digest of the whole if it is long; no instance holds a line break."""
    return short_or_digest(instance, LONGEST_INSTANCE)


def word_key(word: str) -> str:
    return short_or_digest(word, LONGEST_WORD)


def short_or_digest(text: str, longest: int) -> str:
    return text if len(text) <= longest else "\n" + hashlib.sha256(text.encode()).hexdigest()


def patterns_between(before: str, after: str) -> list[str]:
    """The last word of ``before``, its last two, and the words on both sides."""
    ahead = before.rsplit("\n", 1)[-1].lower().rstrip(_OPENING).rsplit(None, 2)[-2:]
    behind = after.split("\n", 1)[0].lower().lstrip(_CLOSING).split(None, 1)[:1]
    ahead = [word_key(word) for word in ahead]
    patterns = ahead[-1:]
    if len(ahead) == 2:
        patterns.append(" ".join(ahead))
    if ahead and behind:
        patterns.append(ahead[-1] + HOLE + word_key(behind[0]))
    return patterns


def hints(text: str, base: list[tuple[str, int, int]]) -> list[tuple]:
    """(patterns, kind or null, instance, start, stop) for seeds and other instances.

    Spans that overlap have the same patterns, those around all of them. Each gap
    between instances is looked at twice, so a text takes linear time.
    """
    found = [(kind, start, stop) for kind, start, stop in base]
    taken = sorted((start, stop) for _, start, stop in base)
    starts = [start for start, _ in taken]
    reach, furthest = [], 0
    for _, stop in taken:
        furthest = max(furthest, stop)
        reach.append(furthest)
    if "@" in text or _DIGIT.search(text):
        free = []
        for token in _TOKEN.finditer(text):
            if not ("@" in token.group() or _DIGIT.search(token.group())):
                continue
            start, stop = without_edges(text, token.start(), token.end())
            place = bisect_right(starts, stop - 1) - 1
            if stop > start and not (place >= 0 and reach[place] > start):
                free.append((token, start, stop))
        for start, stop in joined_groups(text, free):
            if looks_like_identifier(text[start:stop]):
                found.append((None, start, stop))
    found.sort(key=lambda span: span[1:])
    groups: list[list] = []
    for span in found:
        if groups and span[1] < groups[-1][1]:
            groups[-1][1] = max(groups[-1][1], span[2])
            groups[-1][2].append(span)
        else:
            groups.append([span[1], span[2], [span]])
    rows = []
    ends = [0, *(stop for _, stop, _ in groups)]
    nexts = [*(start for start, _, _ in groups[1:]), len(text)]
    for (start, stop, spans), end, following in zip(groups, ends, nexts):
        patterns = patterns_between(text[end:start], text[stop:following])
        rows += [(patterns, k, instance_key(text[a:b]), a, b) for k, a, b in spans]
    return rows


def found_in(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The kept columns with the base spans and the hints of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "searched_text"):
            base = [base_spans(text) for text in texts]
            context = [hints(text, spans) for text, spans in zip(texts, base)]
            columns = [batch.column(name) for name in keep]
            names = ("kind", "start", "stop"), ("patterns", "kind", "instance", "start", "stop")
            for rows, fields, types in zip((base, context), names, (_SPANS, _HINTS)):
                dicts = [[dict(zip(fields, row)) for row in each] for each in rows]
                columns.append(pa.array(dicts, types))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "base", "hints"])

    narrow = docs.select(*keep, F.col(text).alias("searched_text"))
    schema = narrow.select(
        *keep, F.lit(None).cast(SPAN).alias("base"), F.lit(None).cast(HINT).alias("hints")
    ).schema
    return map_arrow(narrow, work, schema)


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
)
_HINTS = pa.list_(
    pa.struct(
        [
            ("patterns", pa.list_(pa.string())),
            ("kind", pa.string()),
            ("instance", pa.string()),
            ("start", pa.int64()),
            ("stop", pa.int64()),
        ]
    )
)


def pattern_bits(patterns: DataFrame) -> np.ndarray:
    """A bit for each CRC of a pattern, cut to its size; always 2**FILTER_BITS / 8 bytes.

    The word right before the instance, which every pattern has, has its bit too.
    """
    nearest = F.substring_index(F.substring_index("pattern", " ", -1), HOLE, 1)
    marked = patterns.select(F.explode(F.array("pattern", nearest)).alias("marked"))
    place = F.crc32(F.col("marked").cast("binary")).bitwiseAND((1 << FILTER_BITS) - 1) + 1
    parts = (
        marked.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    # Spark counts places and buckets of 32768 of them from 1.
    bits = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for row in parts.collect():
        stop = row["bucket"] * 4096
        bits[stop - 4096 : stop] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits


def maybe_pattern(bits: np.ndarray, text: str) -> bool:
    place = zlib.crc32(text.encode()) & ((1 << FILTER_BITS) - 1)
    return bool(bits[place >> 3] >> (place & 7) & 1)


def occurrences(docs: DataFrame, patterns: DataFrame, text: str) -> DataFrame:
    """(pattern, uses): how often the patterns occur, with any word at the instance's place.

    The words and pairs of words are counted within tasks and joined to the
    patterns, however many there are. A bit table of fixed size leaves out most
    words that are none before that; those that it lets through find no partner.
    """
    bits = pattern_bits(patterns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: Counter = Counter()
        met: set[str] = set()
        likely: set[str] = set()

        def counted() -> pa.RecordBatch:
            names, values = pa.array(list(uses), pa.string()), pa.array(list(uses.values()), pa.int64())
            return pa.RecordBatch.from_arrays([names, values], names=["pattern", "uses"])

        for _, texts in text_chunks(batches, "searched_text"):
            for text in texts:
                words = [word_key(word) for word in text.lower().split()]
                new = set(words) - met
                met |= new
                likely.update(word for word in new if maybe_pattern(bits, word))
                if not likely.isdisjoint(words):
                    uses.update(filter(likely.__contains__, words[:-1]))
                    pairs = (pair for pair in zip(words, words[1:-1]) if pair[1] in likely)
                    sides = (side for side in zip(words, words[2:]) if side[0] in likely)
                    uses.update(filter(longer_met, map(" ".join, pairs)))
                    uses.update(filter(longer_met, map(HOLE.join, sides)))
                if len(uses) > MOST_COUNTED:
                    yield counted()
                    uses.clear()
                if len(met) > MOST_COUNTED:
                    met.clear()
                    likely.clear()
        yield counted()

    def longer_met(pattern: str) -> bool:
        return maybe_pattern(bits, pattern)

    texts = docs.select(F.col(text).alias("searched_text"))
    counted = map_arrow(texts, work, "pattern string, uses bigint")
    return (
        counted.groupBy("pattern")
        .agg(F.sum("uses").alias("uses"))
        .join(patterns, "pattern", "left_semi")
    )


def discovered(
    docs: DataFrame,
    found: DataFrame,
    keep: list[str],
    text: str = "text",
    rounds: int = 3,
    least_seeds: int = 5,
    belief: float = 0.6,
) -> DataFrame:
    """The kept columns with ``more``, the spans added to a row; rows with any only.

    A pattern needs ``least_seeds`` different believed instances, however large the
    corpus, so documents that do not use a pattern have no say in it. Its uses are
    counted once, in the round in which it could first be accepted; a round without
    such patterns reads no text. ``rounds`` bounds the chain from one context to the
    next; it ends before if a round changes no belief.
    """
    graph = stored(
        found.select(F.explode("hints").alias("hint"))
        .select(F.explode("hint.patterns").alias("pattern"), "hint.kind", "hint.instance")
        .groupBy("pattern", "kind", "instance")
        .agg(F.count("*").alias("times")),
        "pii-graph",
    )
    unknown = graph.filter(F.col("kind").isNull()).select("pattern", "instance", "times")
    sums = F.sum("weight").alias("weight"), F.sum("support").alias("support")
    seeds = (
        graph.filter(F.col("kind").isNotNull())
        .groupBy("pattern", "kind")
        .agg(F.sum("times").cast("double").alias("weight"), F.count("*").alias("support"))
    )
    totals = graph.groupBy("pattern").agg(F.sum("times").alias("total"))
    counted = believed = None
    all_belief = 0.0
    for _ in range(rounds):
        # The weight of a pattern in a kind: believed instances, seeds count fully.
        weights = seeds
        if believed is not None:
            sure = F.count_if(F.col("believed") >= belief)
            weights = seeds.unionByName(
                unknown.join(believed, "instance")
                .groupBy("pattern", "kind")
                .agg(
                    F.sum(F.col("believed") * F.col("times")).alias("weight"),
                    sure.alias("support"),
                )
            )
        weights = (
            weights.groupBy("pattern", "kind")
            .agg(*sums)
            .filter(F.col("support") >= least_seeds)
            .join(totals, "pattern")
            .filter(F.col("weight") / (F.col("total") + 1) >= belief)
        )
        weights = stored(weights, "pii-weights")
        # Only patterns that the other instances leave a chance are counted in the texts.
        new = weights.select("pattern").distinct()
        if counted is not None:
            new = new.join(counted, "pattern", "left_anti")
        new = stored(new, "pii-patterns")
        if not new.isEmpty():
            # A pattern glued to its instances is no word of its own and counts them alone.
            uses = F.coalesce("uses", F.lit(0)).cast("bigint").alias("uses")
            more = new.join(occurrences(docs, new, text), "pattern", "left").select("pattern", uses)
            more = stored(more, "pii-uses")
            counted = more if counted is None else counted.unionByName(more)
        if counted is None:
            break
        good = F.col("weight") / (F.greatest("uses", "total") + 1)
        accepted = weights.join(counted, "pattern").withColumn("good", good)
        accepted = accepted.filter(F.col("good") >= belief).select("pattern", "kind", "good")
        unlike = F.exp(F.sum(F.log(F.greatest(1 - F.col("good"), F.lit(1e-9)))))
        believed = stored(
            unknown.join(accepted, "pattern")
            .groupBy("instance", "kind")
            .agg((1 - unlike).alias("believed")),
            "pii-beliefs",
        )
        before = all_belief
        all_belief = believed.agg(F.coalesce(F.sum("believed"), F.lit(0.0))).first()[0]
        if abs(all_belief - before) <= 1e-9 * all_belief:
            break
    if believed is None:
        return found.filter(F.lit(False)).select(*keep, F.array().cast(SPAN).alias("more"))
    # Of the kinds that fit an instance, the one believed most, then by name.
    best = F.max_by("kind", F.struct("believed", "kind")).alias("kind")
    chosen = believed.filter(F.col("believed") >= belief).groupBy("instance").agg(best)
    here = found.select(*keep, F.explode("hints").alias("hint")).filter("hint.kind is null")
    return (
        here.select(*keep, "hint.instance", "hint.start", "hint.stop")
        .join(chosen, "instance")
        .groupBy(*keep)
        .agg(F.collect_list(F.struct("kind", "start", "stop")).alias("more"))
    )


def of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda span: span["kind"] == kind)


def listed(spans: str) -> Column:
    """kind:start:stop by kind as in KINDS, then start, joined by commas."""
    place = lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))

    def shown(kind: str) -> Column:
        sorted_places = F.array_sort(F.transform(of_kind(spans, kind), place))
        return F.transform(
            sorted_places, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["stop"])
        )

    return F.concat_ws(",", F.concat(*map(shown, KINDS)))


def with_spans(docs: DataFrame, **how) -> tuple[DataFrame, list[str], DataFrame]:
    """The documents with row keys, the keys, and a row for each with base and more spans."""
    keyed, keys = with_row_keys(docs, "pii-docs")
    found = stored(found_in(keyed, ["doc_id", *keys], "text"), "pii-found")
    more = discovered(keyed, found, keys, **how)
    joined = found.join(more, keys, "left").select(
        "doc_id", *keys, "base", F.coalesce("more", F.array().cast(SPAN)).alias("more")
    )
    return keyed, keys, joined


def personal_data(docs: DataFrame, **how) -> DataFrame:
    """doc_id, the number of spans of each kind by rule, a digest of them, and all spans.

    Spans count code points, the end is exclusive; added spans never replace
    those by rule. A null text is empty and has none; repeated rows come back
    each on its own; an empty table gives no rows.
    """
    _, _, spans = with_spans(docs, **how)
    counts = [F.size(of_kind("base", k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"),
        F.concat("base", "more").alias("all_spans"),
    ).select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", listed("all_spans").alias("spans"))


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Each span gives way to its kind in brackets; spans that overlap to the first's."""
    parts, done, last = [], 0, -1
    for start, stop, kind in sorted(spans):
        if start >= last:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = last = max(last, stop)
    return "".join([*parts, text[done:]])


def without_personal_data(docs: DataFrame, **how) -> DataFrame:
    """The documents, all of them, with spans masked; n_chars follows the text.

    A null text stays null. Texts are masked some at a time, a very long one alone.
    """
    keyed, keys, spans = with_spans(docs, **how)
    (column,) = fresh_names(keyed, "masked_spans")
    some = spans.select(*keys, F.concat("base", "more").alias(column)).filter(F.size(column) > 0)
    rows = keyed.join(some, keys, "left").select(*docs.columns, column)
    names = docs.columns

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in text_slices(batches, limit=SLICE_BYTES):
            texts = batch.column("text")
            found = batch.column(column).to_pylist()
            new = [
                t if not spans else masked(t, [(s["start"], s["stop"], s["kind"]) for s in spans])
                for t, spans in zip(texts.to_pylist(), found)
            ]
            columns = {name: batch.column(name) for name in names}
            columns["text"] = pa.array(new, texts.type)
            yield pa.RecordBatch.from_pydict(columns)

    result = map_arrow(rows, mask, docs.schema)
    if "n_chars" not in names:
        return result
    kind = docs.schema["n_chars"].dataType
    length = F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))
    return result.withColumn("n_chars", length)
