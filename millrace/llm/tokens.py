"""Token ids of whole texts, by a public tokenizer file.

The tokenizer drops white space, and cuts the rest into runs of letters, single
digits, runs of other signs and a few endings such as ``'s`` before it looks up
anything. Words and runs repeat far more often than they are new, so each worker
keeps the ids of those it has met lately, ``STORE_BYTES`` of them, and calls the
tokenizer for others only; what it keeps costs time but never changes a result.
Texts with characters for which cutting first could differ (combining marks,
scripts beyond Latin, names of special tokens) go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
# What a worker keeps of words met lately, and what an entry takes beside its characters.
STORE_BYTES = 64_000_000
ENTRY_BYTES = 200
# Characters of text encoded at once; the arrays beside them are many times as wide.
SLICE_BYTES = 1_000_000
ASK_RUNS = 32

_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼½¾"
_SPACES = "\t-\r \x85\xa0"
_RUNS = re.compile(
    "'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])"
    f"|[{_LETTERS}]+|[{_DIGITS}]|[^{_SPACES}{_LETTERS}{_DIGITS}]+"
)
# Latin letters and common signs are safe to cut; the capital I with a dot,
# whose small form is two characters, is not.
_WHOLE_ONLY = re.compile("[^\x00-įı-ɏ‐-‧€]")
# Python takes the control signs for white space, the tokenizer does not.
_SPECIAL = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")


def _safe_to_cut(text: str) -> bool:
    if any(sign in text for sign in _SPECIAL):
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not _WHOLE_ONLY.search(text)
    return True


_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[b for b in range(256) if b >= 0x80 or chr(b).isalpha()]] = _LETTER
_CLASS[list(b"0123456789")] = _DIGIT
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_LOOK = np.zeros(256, dtype=bool)
_LOOK[[0x27, 0xC2, *range(0xCA, 256)]] = True
_ODD = (b"<|", b"\x1c", b"\x1d", b"\x1e", b"\x1f", "İ".encode())
_TIMES = ("×".encode(), "÷".encode())


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, in bytes."""

    def __init__(self, path: str, store_bytes: int = STORE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Words met lately, and those met before them; each generation takes half the store.
        self.most = store_bytes // 2
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_run = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_run[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", each.ids).tobytes() for each in done]

    def _ask(self, runs: list[str]) -> list[bytes]:
        """Ids of single runs, asked for many at a time: each ends with a word-end piece."""
        lines = ["\n".join(runs[i : i + ASK_RUNS]) for i in range(0, len(runs), ASK_RUNS)]
        done = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(each.ids for each in done), dtype="<u4")
        stops = (np.flatnonzero(self.ends_run[ids]) + 1) * 4
        if len(stops) != len(runs):
            return self._whole(runs)
        held = ids.tobytes()
        stops = stops.tolist()
        return [held[a:b] for a, b in zip([0, *stops], stops)]

    def _keep(self, pieces: list[str], ids: list[bytes]) -> None:
        """Store the ids of pieces; a full generation takes the place of the one before."""
        for piece, each in zip(pieces, ids):
            size = ENTRY_BYTES + len(piece) + len(each)
            if self.held + size > self.most:
                self.known, self.older, self.held = {}, self.known, 0
            if size <= self.most:
                self.known[piece] = each
                self.held += size

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces: a run each, or a word that needs a look."""
        found = list(map(self.known.get, pieces))
        absent = [i for i, ids in enumerate(found) if ids is None]
        for i in absent:
            found[i] = self.older.get(pieces[i])
        missing = [i for i in absent if found[i] is None]
        # Letters alone are one run.
        runs = [i for i in missing if pieces[i].isalpha()]
        words = [i for i in missing if not pieces[i].isalpha()]
        cut = [_RUNS.findall(pieces[i]) for i in words]
        parts = list(set(chain.from_iterable(cut)))
        asked = [pieces[i] for i in runs] + parts
        answers = self._ask(asked)
        for i, ids in zip(runs, answers):
            found[i] = ids
        ids_of_part = dict(zip(parts, answers[len(runs) :]))
        for i, each in zip(words, cut):
            found[i] = b"".join([ids_of_part[part] for part in each])
        self._keep([pieces[i] for i in absent], [found[i] for i in absent])
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a string column without nulls."""
        texts = texts.cast(pa.large_string())
        held = np.frombuffer(texts.buffers()[1], dtype=np.int64)
        held = held[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[held[0] : held[-1]]
        starts = held - held[0]
        whole = [i for i in _suspects(data, starts) if not _safe_to_cut(texts[i].as_py())]
        # The tokenizer does the same to all letters; here it saves meeting words twice.
        data = _SMALL[data]

        cuts = np.flatnonzero(_first_of_piece(data, starts))
        spans = np.searchsorted(cuts, starts)
        pieces = pa.LargeStringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)
        )
        kept = _CLASS[data[cuts[:-1]]] != _SPACE
        for i in whole:
            kept[spans[i] : spans[i + 1]] = False
        coded = pieces.filter(pa.array(kept)).dictionary_encode()
        found = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())

        # Lay the ids of the pieces behind each other, in the order of the texts.
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        lengths = np.zeros(len(pieces), dtype=np.int64)
        lengths[kept] = sizes[codes]
        stops = np.concatenate([[0], np.cumsum(lengths)])
        shift = np.repeat(begins[codes] - stops[:-1][kept], lengths[kept])
        ids = np.frombuffer(b"".join(found), dtype="<u4")[shift + np.arange(stops[-1])]
        flat, bounds = ids.tobytes(), (stops[spans] * 4).tolist()
        encoded = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        for i in whole:
            encoded[i] = self._whole([texts[i].as_py()])[0]
        return encoded


def _suspects(data: np.ndarray, starts: np.ndarray) -> list[int]:
    """Texts with bytes that may stand for signs that are not safe to cut."""
    held = data.tobytes()
    if not len(data) or (data.max() < 0xC9 and not any(sign in held for sign in _ODD)):
        return []
    after = np.append(data[1:], 0)
    odd = (data >= 0xC4) & ((data >= 0xC9) | ((data == 0xC4) & (after == 0xB0)))
    odd |= (data >= 0x1C) & (data <= 0x1F)
    odd |= (data == ord("<")) & (after == ord("|"))
    return np.unique(np.searchsorted(starts, np.flatnonzero(odd), side="right") - 1).tolist()


def _first_of_piece(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where to cut: at runs, but a word with a sign that needs a look stays whole.

    Those are the apostrophe, signs of two bytes that are no letters, and longer ones.
    """
    kind = _CLASS[data]
    first = np.ones(len(data) + 1, dtype=bool)
    first[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    look = _LOOK[data]
    held = data.tobytes()
    if any(sign in held for sign in _TIMES):
        after = np.append(data[1:], 0)
        look |= (data == 0xC3) & ((after == 0x97) | (after == 0xB7))
    if look.any():
        space = kind == _SPACE
        word = np.zeros(len(data) + 1, dtype=bool)
        word[1:-1] = space[1:] != space[:-1]
        word[starts] = True
        number = np.cumsum(word[:-1], dtype=np.int32)
        keep_whole = np.zeros(int(number[-1]) + 1, dtype=bool)
        keep_whole[number[look]] = True
        first[:-1] &= word[:-1] | ~keep_whole[number]
    first[starts] = True
    return first


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker, so that words met in one task are known in the next."""
    return Encoder(path)
