"""Token ids of texts, with the tokenizers library, inside Arrow batches.

The two public tokenizers never join characters across the start of a space that follows a character
other than white space, nor a letter and a mark after it, so the bytes of a text are cut there. Arrow numbers the
distinct words of a run of texts; only words that are new to the worker are encoded, and the ids of the texts are
put together by the numbers. What is not certain to be cut rightly is encoded whole.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_WORDS = 1 << 20  # in a Python worker's cache
LONGEST = 256  # bytes of a word that is kept in it
TAKEN = 1 << 21  # bytes that are split at a time
ENCODED = 1 << 24  # the same, where distinct words are numbered
TOGETHER = 100  # words that are encoded as one text
#: One run of letters after a space for every tokenizer's split, also in lower case.
LETTERS = "^ [A-Za-zÀ-ÖØ-öø-įı-ſ]+$"
#: Bytes that end a run of letters and are in no special token.
MARKS = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~", np.uint8))
LETTER = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
#: Words without white space, special tokens and the digit that parts them in a text of many.
SAFE = re.compile("[ \n]?[!-68-;=-~À-ÖØ-öø-įı-ſ]+")


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The places where texts can be cut: texts' own starts, spaces, line ends, and marks after letters of one or two bytes."""
    starts = (data == 32) | (data == 10)
    marks = np.flatnonzero(MARKS[data[2:]]) + 2
    lead, last = data[marks - 2], data[marks - 1]
    wide = (lead >= 0xC3) & (lead <= 0xC5) & (last >= 0x80)
    for odd in (b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0"):  # two signs, and a letter whose lower case ends with a mark
        wide &= (lead != odd[0]) | (last != odd[1])
    starts[marks[LETTER[last] | wide]] = True
    starts[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(starts)


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case where a byte of ASCII follows, so that no character is composed in another way."""
    upper = (data >= 65) & (data <= 90)
    upper[:-1] &= data[1:] < 128
    return np.where(upper, data | 32, data) if b"<|" not in data.tobytes() else data  # special tokens keep their case


def binary_array(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


class WordEncoder:
    """``ids(texts)``: the little-endian ids of each text as bytes.

    ``spaced``: a word's ids depend on the space before it, and a single line end is a token (byte-level
    tokenizers); a line or word that is empty or has other white space at an end is never cut off, its
    text is encoded whole. Otherwise white space only separates words, and case is of no matter.

    Words are known by their bytes, with the space or line end before them; of too many, those used last stay.
    """

    def __init__(self, path: str, spaced: bool, width: int = 4) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced, self.width, self.code = spaced, width, {2: "H", 4: "I"}[width]
        self.words, self.made = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())
        self.used, self.run = np.zeros(0, np.int64), 0  # each word's last run of texts
        # between words that are encoded together, and the one token that it gives and no word does
        self.parting = "\n" if spaced else " 7 "
        self.parted = self.tokenizer.encode(self.parting, add_special_tokens=False).ids[0]
        self.line_end = self._bytes(["\n"])[0] if spaced else b""
        vocab = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocab.values()) + 1, bool)  # tokens that begin (or else end) a word
        mark = (lambda t: t.startswith("Ġ")) if spaced else (lambda t: t.endswith("</w>"))
        self.edge[[i for t, i in vocab.items() if mark(t)]] = True

    def _bytes(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in encoded]

    def _together(self, texts: list[str]) -> np.ndarray:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.concatenate([np.array(e.ids, np.int64) for e in encoded])

    def _letters(self, words: pa.Array) -> pa.Array:
        """The ids of ``LETTERS``, encoded many at a time and cut apart where tokens say so."""
        if not len(words):
            return words
        data, ends = text_bytes(words)
        cuts = np.append(ends[:-1:TOGETHER], ends[-1]).tolist()
        ids = self._together([data[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:])])
        at = np.flatnonzero(self.edge[ids])
        at = np.append(at, len(ids)) if self.spaced else np.append(0, at + 1)
        if len(at) != len(words) + 1:
            return pa.array(self._bytes([w.decode() for w in words.to_pylist()]), pa.large_binary())
        return binary_array(at * self.width, ids.astype(f"<u{self.width}").view(np.uint8))

    def _safe(self, words: list[str]) -> list[bytes]:
        """The ids of ``SAFE`` words, encoded many at a time with tokens between them that are none of theirs."""
        if not words:
            return []
        ids = self._together([self.parting.join([*words[k : k + TOGETHER], ""]) for k in range(0, len(words), TOGETHER)])
        ends = np.flatnonzero(ids == self.parted)
        if len(ends) != len(words):
            return self._bytes(words)
        raw = ids.astype(f"<u{self.width}").tobytes()
        starts = (np.append(0, ends[:-1] + 1) * self.width).tolist()
        return [raw[a:b] for a, b in zip(starts, (ends * self.width).tolist())]

    def _can_be_cut(self, word: str) -> bool:
        """Whether a word, with what is before it, has the same ids alone and within a text."""
        if not self.spaced:
            return True
        core = word[1:] if word[0] in " \n" else word
        return bool(core) and not core[-1].isspace() and (word[0] == " " or not core[0].isspace())

    def _others(self, words: list[str]) -> list[bytes | None]:
        """The ids of any words, None for those that can't be cut off."""
        safe = [w for w in words if SAFE.fullmatch(w)]
        line = [self.spaced and w[0] == "\n" for w in safe]  # a line end is a token before a word, and what parts words
        ids = self._safe([w[1:] if first else w for w, first in zip(safe, line)])
        found = {w: self.line_end + i if first else i for w, first, i in zip(safe, line, ids)}
        rest = [w for w in words if w not in found and self._can_be_cut(w)]
        found.update(zip(rest, self._bytes(rest)))
        return [found.get(w) for w in words]

    def _known(self, words: pa.Array) -> np.ndarray:
        """Each distinct word's place in the cache, null ids there where it can't be cut off."""
        place = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.run += 1
        self.used[place[place >= 0]] = self.run
        missing = np.flatnonzero(place < 0)
        new = words.take(pa.array(missing))
        plain = pc.match_substring_regex(new.cast(pa.large_string()), LETTERS)
        letters, others = new.filter(plain), new.filter(pc.invert(plain))
        ids = pa.array(self._others([w.decode() for w in others.to_pylist()]), pa.large_binary())
        plain, first = plain.to_numpy(zero_copy_only=False), len(self.words)
        place[missing[plain]] = first + np.arange(len(letters))
        place[missing[~plain]] = first + len(letters) + np.arange(len(others))
        self.words = pa.concat_arrays([self.words, letters, others])
        self.made = pa.concat_arrays([self.made, self._letters(letters), ids])
        self.used = np.append(self.used, np.full(len(new), self.run))
        return place

    def _forget(self) -> None:
        """Lets go of very long words and, of too many, of those not used for the longest time."""
        stay = np.flatnonzero(pc.binary_length(self.words).to_numpy() <= LONGEST)
        if len(stay) > CACHED_WORDS:
            stay = stay[np.argsort(-self.used[stay], kind="stable")[: CACHED_WORDS // 2]]
        if len(stay) < len(self.words):
            self.words, self.made, self.used = self.words.take(pa.array(stay)), self.made.take(pa.array(stay)), self.used[stay]

    def ids(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """The ids of each text in order, null as empty; texts are taken about ``ENCODED`` bytes at a time."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        for _, _, data, offsets in pieces(*text_bytes(column), ENCODED):
            yield from self._some(data, offsets)

    def _some(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        if not self.spaced:
            data = lowered(np.where(data == 10, np.uint8(32), data))
        at = np.append(word_starts(data, offsets), len(data))
        words = binary_array(at, data).dictionary_encode()
        place = self._known(words.dictionary)
        made = self.made.take(pa.array(place[words.indices.to_numpy()]))
        self._forget()
        first = np.searchsorted(at, offsets)  # each text's words
        ends = np.frombuffer(made.buffers()[1], np.int64, len(made) + 1)[first].tolist()
        whole = np.zeros(len(offsets) - 1, bool)  # texts with something that can't be cut off
        if made.null_count:
            lost = np.flatnonzero(made.is_null().to_numpy(zero_copy_only=False))
            whole[np.searchsorted(first, lost, "right") - 1] = True
        raw = memoryview(made.buffers()[2] or b"")
        for k, (a, b) in enumerate(zip(ends, ends[1:])):
            if whole[k]:
                yield self._bytes([data[offsets[k] : offsets[k + 1]].tobytes().decode()])[0]
            else:
                yield raw[a:b].tobytes()


def worker_cache() -> dict:
    """What a Python worker keeps from task to task. The module's own names are made anew for each task, as
    functions travel by value; an entry in ``sys.modules`` lasts as long as the worker."""
    return sys.modules.setdefault("_intentloom_worker", types.ModuleType("_intentloom_worker")).__dict__


def encoder(path: str, spaced: bool, width: int = 4) -> WordEncoder:
    """One encoder for each Python worker, kept between its batches and tasks."""
    key = f"{path} {spaced} {width}"
    if key not in worker_cache():
        worker_cache()[key] = WordEncoder(path, spaced, width)
    return worker_cache()[key]


def texts_of(column) -> list[str]:
    """A batch's texts, null as empty."""
    return [t or "" for t in column.to_pylist()]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a batch's texts, one after the other, and where each starts and ends; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = TAKEN) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, bytes, offsets) of runs of texts of about ``size`` bytes; a longer text comes by itself."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
