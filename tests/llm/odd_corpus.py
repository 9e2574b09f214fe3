"""Small frames with everything that may turn up in a corpus."""

from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size string, target string, score string, fp string, row_file string, part int, label string"
)
SYLLABLES = "ka lo mi ren tas vu zel por nid esh qua bri".split()


def prose(random_, words: int) -> str:
    return " ".join(
        "".join(random_.choices(SYLLABLES, k=random_.randint(1, 3))) for _ in range(words)
    )


def with_extras(rows):
    """Columns whose names an operator may want to use itself."""
    return [(*row, "a", "b", "c", "d", "e", 1, "f") for row in rows]


@pytest.fixture(scope="session")
def odd_rows():
    random_ = random.Random(5)
    texts = [prose(random_, n) for n in (40, 60, 300, 1, 3, 4, 5)]
    mixed = "Don't  pay   4111 1111 1111 1111 or a.b@c.example,\r\n\tcall +1 (555) 123-4567!"
    texts += [
        "",
        " \t\n",
        "Ünïcödé ﬁ İstanbul é 日本語 😀😀 <|endoftext|> x\x1cy",
        mixed,
        " ".join([prose(random_, 50)] * 2000),
        "x" * 20_000,
        "1" * 5_000,
        "a@" * 2_000,
    ]
    rows = [(i, text, "en", f"s{i % 4}", len(text)) for i, text in enumerate(texts)]
    rows += [(100, None, None, None, None), (None, texts[2], "en", None, 1), (None, None, None, "s1", 0)]
    rows += [rows[1], rows[1], (1, texts[2], "en", "s9", 3), (101, texts[0].upper(), "en", "s0", 5)]
    return with_extras(rows)


@pytest.fixture(scope="session")
def odd(spark, odd_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "odd.parquet")
    spark.createDataFrame(odd_rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="session")
def ids_of(tokenizer):
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
