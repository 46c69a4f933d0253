"""N-grams of token lists in Arrow batches: coded as integers, counted by sorting, texts made once per distinct gram."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_TOKENS = 1 << 21  # tokens taken at a time, so that memory is bounded however long the texts are
SLICE_BYTES = 1 << 24  # bytes of text taken at a time
SPLIT_BYTES = 1 << 19  # bytes split into tokens at a time, near the processor


def _cuts(lengths: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of about ``size`` together (one row at least)."""
    ends = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield at, upto - at
        at = upto


def slices(tokens: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """The rows of a list array in turn, about ``size`` tokens at a time (one row at least)."""
    for at, n in _cuts(pc.list_value_length(tokens), size or SLICE_TOKENS):
        yield tokens.slice(at, n)


def _in_words(data: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each byte of a UTF-8 text is of a ``known`` character."""
    inside = np.r_[known[:128], np.zeros(128, bool)][data]
    lead = np.flatnonzero(data >= 0xC0)
    byte = data[lead].astype(np.int64)
    size = 2 + (byte >= 0xE0) + (byte >= 0xF0)
    point = byte & (0x7F >> size)
    for k in range(1, 4):
        more = size > k
        point[more] = point[more] << 6 | (data[lead[more] + k] & 0x3F)
    for k in range(4):
        more = size > k
        inside[lead[more] + k] = known[point[more]]
    return inside


def token_lists(texts: pa.Array, letters: np.ndarray) -> pa.Array:
    """The runs of two or more characters of ``letters``, ranges of code points (first, last), in every text; none in a null one."""
    known = np.zeros(0x110000, bool)
    for first, last in letters:
        known[first : last + 1] = True
    made = [_split(texts.slice(at, n), known) for at, n in _cuts(pc.binary_length(texts), SPLIT_BYTES)]
    return pa.concat_arrays(made) if made else pa.array([], pa.list_(pa.string()))


def _split(texts: pa.Array, known: np.ndarray) -> pa.Array:
    texts = texts.fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = _in_words(data, known)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = ends[:-1][ends[:-1] < len(data)]
    first[starts] = inside[starts]
    at, kept = np.flatnonzero(first), data[inside]
    lengths = np.diff(np.r_[np.flatnonzero(first[inside]), len(kept)])
    before = np.r_[0, np.cumsum((kept & 0xC0) != 0x80)]  # characters
    upto = np.cumsum(lengths)
    long = before[upto] - before[upto - lengths] > 1
    kept, at, lengths = kept[np.repeat(long, lengths)], at[long], lengths[long]
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    words = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(kept))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(at, ends), pa.int32()), words)


def token_batches(batches: Iterator[pa.RecordBatch], letters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The batches, about ``SLICE_BYTES`` of text at a time, with token lists in place of the text, their first column."""
    for batch in batches:
        for at, n in _cuts(pc.binary_length(batch.column(0)), SLICE_BYTES):
            part = batch.slice(at, n)
            yield pa.RecordBatch.from_arrays([token_lists(part.column(0), letters), *part.columns[1:]], part.schema.names)


def _coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the distinct values, and these values in that order."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def grams(tokens: pa.Array, sizes: tuple[int, int], words: pa.Array | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """For each size of n-gram: the row and the number of every occurrence, and the texts of the numbers.

    With ``words``, grams of other words may be left out.
    """
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(tokens)), lengths)
    word, names = _coded(tokens.flatten())
    known = np.ones(len(names), bool) if words is None else pc.is_in(names, value_set=words).to_numpy(zero_copy_only=False)
    known = known[word]
    start, gram, texts = np.flatnonzero(known), word[known], names
    for n in range(1, sizes[1] + 1):
        if n > 1:  # longer by the word that follows, if it is of the same row
            last = start + (n - 1)
            going = last < len(row)
            going[going] = (row[last[going]] == row[start[going]]) & known[last[going]]
            start, last = start[going], last[going]
            gram, pairs = _coded(pa.array(gram[going] * len(names) + word[last]))
            pairs = pairs.to_numpy(zero_copy_only=False)
            texts = pc.binary_join_element_wise(texts.take(pa.array(pairs // len(names))), names.take(pa.array(pairs % len(names))), " ")
        if n >= sizes[0]:
            yield row[start], gram, texts


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how often each comes."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)])


def total_counts(batches: Iterator[pa.RecordBatch], sizes: tuple[int, int], words: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
    """(term, tf, df) of the token lists of each slice: occurrences and rows."""
    for batch in batches:
        for part in slices(batch.column(0)):
            for row, gram, texts in grams(part, sizes, words):
                n = max(1, len(texts))
                held, _ = _runs(row * n + gram)
                tf, df = np.bincount(gram, minlength=n), np.bincount(held % n, minlength=n)
                seen = tf > 0
                yield pa.RecordBatch.from_arrays(
                    [texts.filter(pa.array(seen[: len(texts)])), pa.array(tf[seen], pa.int64()), pa.array(df[seen], pa.int64())], ["term", "tf", "df"]
                )


def group_counts(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """(group, term, tf) of each batch of token lists and groups: occurrences of the single words."""
    for batch in batches:
        group = batch.column(1).dictionary_encode(null_encoding="encode")
        of_row = group.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for row, word, texts in grams(batch.column(0), (1, 1)):
            n = max(1, len(texts))
            held, tf = _runs(of_row[row] * n + word)
            yield pa.RecordBatch.from_arrays([group.dictionary.take(pa.array(held // n)), texts.take(pa.array(held % n)), pa.array(tf, pa.int64())], names)


CELLS = "array<struct<idx:bigint,tf:bigint,idf:double>>"
ARROW_CELLS = pa.struct([("idx", pa.int64()), ("tf", pa.int64()), ("idf", pa.float64())])


def row_terms(
    texts: pa.Array, letters: np.ndarray, sizes: tuple[int, int], terms: pa.Array, words: pa.Array, idx: np.ndarray, idf: np.ndarray
) -> pa.Array:
    """Per row its known terms as (idx, tf, idf), by idx. ``idx`` ascends."""
    made = []
    for at, n in _cuts(pc.binary_length(texts), SLICE_BYTES):
        part = token_lists(texts.slice(at, n), letters)
        keys = []
        for row, gram, names in grams(part, sizes, words):
            at = pc.fill_null(pc.index_in(names, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)[gram]
            keys.append(row[at >= 0] * len(terms) + at[at >= 0])
        held, tf = _runs(np.concatenate(keys))
        row, at = held // len(terms), held % len(terms)
        offsets = np.searchsorted(row, np.arange(len(part) + 1))
        cells = pa.StructArray.from_arrays([pa.array(idx[at], pa.int64()), pa.array(tf, pa.int64()), pa.array(idf[at])], fields=list(ARROW_CELLS))
        made.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells))
    return pa.concat_arrays(made) if made else pa.array([], pa.list_(ARROW_CELLS))
