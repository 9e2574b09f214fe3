"""The stages one after another, each against plain versions of what it decides."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import corpus_pipeline
from millrace.llm import pii, toxicity
from millrace.llm.common import stored
from millrace.session import fresh_path, shared_folder
from odd_corpus import ids_of, nothing, odd, odd_rows, tokenizer  # noqa: F401
from test_mixing import plain_targets, words
from test_prints import plain_components, plain_print
from test_tokens import check_packing

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, ids_of):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, [docs.collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "near duplicates",
        "personal data",
        "mixing",
        "packing",
    ]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), "stage")
        seen.append(docs.collect())
        assert name == "packing" or docs.columns == columns
    start, clean, distinct, masked, mixed, packed = seen

    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    frame = spark.createDataFrame(start, spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    kept = {r.doc_id for r in toxicity.toxicity(frame, labels).collect() if not r.predicted}
    assert sorted(clean) == sorted(r for r in start if r.doc_id in kept)
    assert len(clean) >= 0.8 * len(start)

    prints = [plain_print(r.text) for r in clean]
    components, _ = plain_components(prints, [r.doc_id for r in clean])
    assert {r.doc_id for r in distinct} == set(components)

    texts = {r.doc_id: r.text for r in distinct}
    assert {r.doc_id for r in masked} == texts.keys()
    for row in masked:
        spans = [(a, b, k) for k, a, b in pii.base_spans(texts[row.doc_id])]
        assert row.text == pii.masked(texts[row.doc_id], spans)
        assert row.n_chars == len(row.text)

    known = {r: words(r.text) for r in masked}
    copies = Counter(mixed)
    assert copies.keys() <= known.keys() and max(copies.values()) <= 2
    sizes, taken = Counter(), Counter()
    for row, size in known.items():
        sizes[row.source] += size
        taken[row.source] += size * copies[row]
    targets = plain_targets(sizes)
    for source, size in sizes.items():
        most = max(s for r, s in known.items() if r.source == source)
        assert abs(taken[source] - targets[source]) <= max(20, 0.5 * most)

    check_packing(packed, [(r.doc_id, r.text) for r in mixed], ids_of, 4096)


def test_run(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.columns[:3] == ["doc_id", "start", "length"]
    assert found.count() > 0


def tables(spark, docs):
    """A folder with these documents and a few labels of them."""
    folder = fresh_path(spark, "odd-tables")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(15)] + [(None, 1, 1), (3, None, None)]
    kind = "doc_id bigint, quality int, toxic int"
    spark.createDataFrame(labels, kind).write.parquet(f"{folder}/labels.parquet")
    return folder


def test_odd_documents_as_a_whole(spark, odd, odd_rows, ids_of):  # noqa: F811
    """Nulls, empty and very long texts, repeated rows and names that clash."""
    folder = tables(spark, odd)
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in found} <= {row[0] for row in odd_rows}
    kept = Counter()
    for r in found:
        kept[r.doc_id, r.doc_tokens] += r.length
    assert kept and all(total % tokens == 0 for (_, tokens), total in kept.items())


def test_a_run_leaves_its_result_alone(spark, nothing):  # noqa: F811
    folder = tables(spark, nothing)
    there = lambda: {p.name for p in Path(shared_folder(spark).removeprefix("file:")).iterdir()}
    before = there()
    assert corpus_pipeline.run(spark, folder).count() == 0
    left = [name for name in there() - before if Path(shared_folder(spark).removeprefix("file:"), name).is_dir()]
    assert [name.rsplit("-", 1)[0] for name in left if name.count("-") < 4] == ["pipeline-packing"]
