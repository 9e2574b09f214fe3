"""Token ids, their ORC files, packing and counts, against the tokenizers library."""

from __future__ import annotations

import re
import subprocess
import sys
import zlib
from array import array
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import orc_ids, packing, viterbi
from millrace.llm.queries import QUERIES
from millrace.llm.tokens import Encoder
from millrace.session import fresh_path
from odd_corpus import ids_of, nothing, odd, odd_rows, tokenizer  # noqa: F401

SMALL = "/root/testdata/sf0.001"
TEXT = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n.,'\"sStTdD0123é’½İß<|\x1c´ａ")), max_size=60)


def checksum(ids):
    return zlib.crc32(array("I", ids).tobytes())


@pytest.fixture(scope="module")
def encoder():
    return Encoder(public_tokenizers.path("word_bpe_49k.json"), store_bytes=20_000)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_ids_are_the_librarys(encoder, tokenizer, texts):
    found = encoder.encode(pa.array(texts, pa.string()))
    for text, ids in zip(texts, found):
        assert list(np.frombuffer(ids, "<u4")) == tokenizer.encode(text, add_special_tokens=False).ids


def test_slices_of_columns(encoder, tokenizer):
    texts = ["alpha beta", "", "it's 12", "gamma"]
    found = encoder.encode(pa.array(texts).slice(1, 2))
    assert [list(np.frombuffer(x, "<u4")) for x in found] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts[1:3]
    ]


def test_the_store_is_bounded_by_bytes(tokenizer):
    small = Encoder(public_tokenizers.path("word_bpe_49k.json"), store_bytes=100_000)
    for turn in range(20):
        texts = [f"word{turn}x{i} " + "y" * (i % 300) for i in range(200)]
        found = small.encode(pa.array(texts))
        assert list(np.frombuffer(found[7], "<u4")) == tokenizer.encode(texts[7]).ids
        held = {**small.known, **small.older}
        assert sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in held.items()) <= 100_000
    assert small.older and small.known


def test_the_encoder_takes_little_memory():
    """A worker of its own meets 40 MB of new words and long texts."""
    program = """
import resource, random, pyarrow as pa, public_tokenizers
from millrace.llm.common import text_slices
from millrace.llm.tokens import SLICE_BYTES, Encoder
encode = Encoder(public_tokenizers.path("word_bpe_49k.json")).encode
start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
draw = random.Random(1)
for _ in range(20):
    texts = [" ".join("%x" % draw.getrandbits(40) for _ in range(200)) for _ in range(1000)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    for _, column in text_slices(iter([batch]), limit=SLICE_BYTES):
        encode(column)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start) // 1024)
"""
    root = str(Path(__file__).resolve().parents[2])
    done = subprocess.run(
        [sys.executable, "-c", program], cwd=root, capture_output=True, text=True, check=True
    )
    assert int(done.stdout.split()[-1]) < 250


def expected_ids(rows, ids_of):
    """(doc_id, start, n_tokens, checksum) in order; equal ids in any order."""
    by_id = defaultdict(list)
    for row in rows:
        by_id[row[0]].append(ids_of(row[1]))
    return by_id


def test_orc_round_trip(spark, odd, odd_rows, ids_of):
    path = fresh_path(spark, "ids")
    orc_ids.write_ids(odd, path)
    rows = orc_ids.read_ids(spark, path).collect()
    by_id = expected_ids(odd_rows, ids_of)
    found = defaultdict(list)
    for row in rows:
        found[row.doc_id].append(row.ids)
        assert row.n_tokens == len(row.ids)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in by_id.items()}
    ordered = sorted(rows, key=lambda row: row.start)
    assert [row.start for row in ordered] == list(
        np.cumsum([0] + [row.n_tokens for row in ordered[:-1]])
    )
    ids = [row.doc_id for row in ordered]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    checked = orc_ids.read_ids(spark, path, checksum=True).collect()
    assert sorted((r.start, r.ids_crc32) for r in checked) == sorted(
        (r.start, checksum(r.ids)) for r in rows
    )


def test_orc_lookup_reaches_the_files(spark, odd, ids_of, odd_rows, capsys):
    path = fresh_path(spark, "ids")
    orc_ids.write_ids(odd, path, row_index_stride=1000, stripe_bytes=1 << 20)
    found = orc_ids.read_ids(spark, path, doc_ids=[4, 100])
    found.explain("formatted")
    assert re.search(r"PushedFilters: \[.*In\(doc_id", capsys.readouterr().out)
    assert sorted(r.doc_id for r in found.collect()) == [4, 100]
    whole = {r.doc_id: r.start for r in orc_ids.read_ids(spark, path).collect()}
    assert all(r.start == whole[r.doc_id] for r in found.collect())


def test_orc_starts_hold_whatever_files_a_range_takes(spark, odd_rows, ids_of):
    docs = spark.createDataFrame([(i, "word " * (i % 50)) for i in range(500)], "doc_id long, text string")
    path = fresh_path(spark, "ids")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 20)
    try:
        orc_ids.write_ids(docs, path)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    rows = sorted(orc_ids.read_ids(spark, path).collect(), key=lambda r: r.doc_id)
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows[:-1]]))


def test_ranges_follow_their_numbers(spark):
    """More ranges than names of files have digits for, each in several files."""
    parts = [9, 10, 99_998, 99_999, 100_000, 100_001, 1_000_000]
    files = spark.createDataFrame([(p, 1) for p in parts for _ in range(3)], "part long, n_tokens long")
    found = {r.part: r.base for r in orc_ids.range_starts(files).collect()}
    assert found == {p: 3 * i for i, p in enumerate(parts)}


def test_orc_of_nothing(spark, nothing):
    path = fresh_path(spark, "ids")
    orc_ids.write_ids(nothing, path)
    assert orc_ids.read_ids(spark, path, checksum=True).count() == 0


def check_packing(rows, docs, ids_of, length):
    """Every id once, sequences gapless and not too long; the share of padding."""
    wanted = Counter()
    for doc in docs:
        ids = ids_of(doc[1])
        wanted[(doc[0], len(ids))] += len(ids)
    got, sequences = Counter(), defaultdict(list)
    for row in rows:
        got[(row.doc_id, row.doc_tokens)] += row.length
        sequences[row.sequence_id].append((row.offset, row.length))
    assert got == wanted
    filled = 0
    for pieces in sequences.values():
        end = 0
        for offset, size in sorted(pieces):
            assert offset == end and size > 0
            end += size
        assert end <= length
        filled += end
    assert sorted(sequences) == list(range(len(sequences)))
    return 1 - filled / (length * len(sequences))


def test_packing_odd_documents(odd, odd_rows, ids_of):
    rows = packing.pack(odd).collect()
    check_packing(rows, odd_rows, ids_of, 4096)
    ids = {row[0]: ids_of(row[1]) for row in odd_rows if row[0] not in (None, 1)}
    for row in rows:
        if row.doc_id in ids:
            piece = ids[row.doc_id][row.start : row.start + row.length]
            assert row.ids_crc32 == checksum(piece)


def test_packing_query(spark, ids_of):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op1_packing"][0](spark, SMALL).collect()
    padding = check_packing(rows, docs, ids_of, 4096)
    total = sum(row.length for row in rows)
    assert len({row.sequence_id for row in rows}) <= -(-total // 4096) + 1
    assert padding < 0.03


def test_packing_of_nothing(nothing):
    assert packing.pack(nothing).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), min_size=1, max_size=20))
def test_plan_places_every_piece_once(counts):
    plan = packing.make_plan(dict(counts), 64)
    room = Counter()
    slots = set()
    for size, count in counts.items():
        sequence, slot = plan.place(size, np.arange(count))
        for s, at in zip(sequence.tolist(), slot.tolist()):
            assert (s, at) not in slots and 0 <= s < plan.sequences
            slots.add((s, at))
            room[s] += size
    assert max(room.values()) <= 64


def test_column_generation_beats_first_fit_where_it_can():
    # Pairs of 22 and 42 fill 64; largest first would pair 42 with 22 too, but
    # three of 21 fill 63 while 33 pairs with 31 alone.
    plan = packing.make_plan({42: 300, 22: 300, 33: 200, 31: 200}, 64)
    assert plan.sequences == 500


def test_orc_query(spark, ids_of):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    start, wanted = 0, []
    for doc in sorted(docs, key=lambda d: d.doc_id):
        ids = ids_of(doc.text)
        wanted.append((doc.doc_id, start, len(ids), checksum(ids)))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op4_orc_ids"][0](spark, SMALL).collect())) == wanted


@pytest.fixture(scope="module")
def pieces():
    return viterbi.unigram(public_tokenizers.path(viterbi.PIECES))


def library(pieces):
    from tokenizers import Tokenizer, models, pre_tokenizers

    made = Tokenizer(models.Unigram(list(pieces), 0, True))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always"),
        ]
    )
    return made


@settings(max_examples=120, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeiost  ▁\x1d\n")), max_size=40))
def test_counts_are_the_librarys(pieces, text):
    found = counter_of(pieces).texts([text])[0][0]
    assert found == len(library_of(pieces).encode(text, add_special_tokens=False).ids)


_made = {}


def counter_of(pieces):
    return _made.setdefault("counter", viterbi.Counter(pieces))


def library_of(pieces):
    return _made.setdefault("library", library(pieces))


def test_ties_go_to_the_piece_that_begins_first():
    # Equal sums: the library has aab + b, not a + abb.
    pieces = (("<unk>", 0.0), *((p, -1.0) for p in ("▁", "a", "b", "aab", "abb", "▁a", "▁aa", "bb")))
    made, counter = library(pieces), viterbi.Counter(pieces)
    for word in ("aabb", "aab", "abab", "aaabbb", "bbaabba"):
        assert counter.texts([word])[0][0] == len(made.encode(word, add_special_tokens=False).ids)


def test_token_counts(odd, odd_rows, nothing, pieces):
    rows = viterbi.token_counts(odd).collect()
    made = library_of(pieces)
    wanted = Counter(
        (r[0], len(made.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows
    )
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == wanted
    assert viterbi.token_counts(nothing).count() == 0


def test_token_count_query(spark, pieces):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    made = library_of(pieces)
    wanted = {d.doc_id: len(made.encode(d.text, add_special_tokens=False).ids) for d in docs}
    rows = QUERIES["op9_token_counts"][0](spark, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == wanted
