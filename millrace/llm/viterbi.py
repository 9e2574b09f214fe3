"""Token counts of a unigram tokenizer without building its tokens.

The best segmentation of a word maximises the sum of its pieces' scores. An
Aho-Corasick automaton lists the pieces that end at each character, and a
dynamic program carries the best score and the number of pieces of the best
segmentation up to each character. Ties go as the tokenizers library has them:
the piece that begins first wins. A character that is no piece itself may stand
as unknown, ten below the lowest score, and counts as its UTF-8 bytes.

No unigram vocabulary is supplied. The pieces and scores are those of a BPE model,
whose scores are negative merge ranks and not log probabilities, so the counts
are those of no tokenizer in use.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, text_chunks

PIECES = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
STORE_WORDS = 300_000
# Python splits on these, the tokenizer does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")


@lru_cache(maxsize=4)
def unigram(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a sentencepiece file, in the order of their ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(len(model)))


class Counter:
    """Piece counts and best scores of words, each kept once found."""

    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.singles = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        # Words met lately, and those met before them.
        self.known: dict[str, tuple[int, float]] = {}
        self.older: dict[str, tuple[int, float]] = {}

    def best(self, part: str) -> tuple[int, float]:
        """Number of pieces and score of the best segmentation."""
        if not self.singles.issuperset(part):
            return self._best_with_unknown(part)
        # Matches come by their end, the longest first: among equal sums the
        # piece that begins first stays.
        scores, counts = [0.0] + [-math.inf] * len(part), [0] * (len(part) + 1)
        for last, (length, own) in self.automaton.iter(part):
            end = last + 1
            offer = scores[end - length] + own
            if offer > scores[end]:
                scores[end], counts[end] = offer, counts[end - length] + 1
        return counts[-1], scores[-1]

    def _best_with_unknown(self, part: str) -> tuple[int, float]:
        """The same where a character may have to stand as unknown."""
        counts, scores = [0], [0.0]
        matches = self.automaton.iter(part)
        at, match = -1, None
        for end, char in enumerate(part):
            score = count = None
            while True:
                if at == end:
                    length, own = match
                    start = end + 1 - length
                    offer = scores[start] + own
                    if score is None or offer > score:
                        score, count = offer, counts[start] + 1
                elif at > end:
                    break
                at, match = next(matches, (len(part), None))
            if char not in self.singles:
                offer = scores[end] + self.unknown
                if score is None or offer > score:
                    score, count = offer, counts[end] + len(char.encode())
            scores.append(score)
            counts.append(count)
        return counts[-1], scores[-1]

    def word(self, word: str) -> tuple[int, float]:
        marked = word if word.startswith(MARK) else MARK + word
        if MARK not in marked[1:]:
            return self.best(marked)
        parts = [self.best(part) for part in re.split(f"(?={MARK})", marked) if part]
        return sum(n for n, _ in parts), sum(s for _, s in parts)

    def texts(self, texts: list[str]) -> list[tuple[int, float]]:
        words = [
            [w for w in _SPACE.split(t) if w] if _SEPARATORS.search(t) else t.split()
            for t in texts
        ]
        if len(self.known) > STORE_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        for word in set(chain.from_iterable(words)).difference(known):
            known[word] = older.get(word) or self.word(word)
        found = []
        for each in words:
            if not each:
                found.append((0, 0.0))
                continue
            counts, scores = zip(*map(known.__getitem__, each))
            found.append((sum(counts), float(sum(scores))))
        return found


@lru_cache(maxsize=2)
def _counter(pieces: tuple[tuple[str, float], ...]) -> Counter:
    """One for each worker, so that words met in one task are known in the next."""
    return Counter(pieces)


def token_counts(
    docs: DataFrame,
    pieces: tuple[tuple[str, float], ...] | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """The kept columns with n_tokens and the sum of the pieces' scores.

    White space separates words and is dropped; each word starts with the
    word mark. Null and empty texts have 0 tokens. Repeated rows count each on
    its own; an empty table gives no rows.
    """
    vocabulary = pieces or unigram(public_tokenizers.path(PIECES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch, texts in text_chunks(batches, "counted_text"):
            numbers, scores = zip(*counter.texts(texts))
            columns = [batch.column(name) for name in keep]
            columns += [pa.array(numbers, pa.int64()), pa.array(np.array(scores))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_tokens", "score"])

    narrow = docs.select(*keep, F.col(text_col).alias("counted_text"))
    zero = F.lit(0).cast("bigint").alias("n_tokens")
    schema = narrow.select(*keep, zero, F.lit(0.0).alias("score")).schema
    return map_arrow(narrow, count, schema)
