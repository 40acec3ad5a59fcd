"""Words of many texts as flat arrays, for the operators that work on Arrow batches.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z counts as a-z. All words of a slice of texts are hashed
with a few array operations, without a Python object for each word. Slices are cut between texts by their size in
bytes, so memory follows the slice and not the batch; a text larger than a slice makes a slice of its own.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 & ~7 | 5       # odd, 5 modulo 8
_SEED = 20240607
_SPACES = [9, 10, 11, 12, 13, 32]
_U64 = np.uint64


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(_SEED)).integers(1, 1 << 63, 256, dtype=_U64)
    if lower:
        values[65:91] = values[97:123]
    values[_SPACES] = 0
    return values


_LOWER = _byte_values(True)
_IS_WORD = np.ones(256, bool)
_IS_WORD[_SPACES] = False
_factors = np.zeros(0, _U64)


def _place_factors(n: int) -> np.ndarray:
    """Random odd factors for the first n places in a word.

    Unlike powers of one number they leave no words that are built to collide, such as a Thue-Morse word and its complement.
    """
    global _factors
    if len(_factors) < n:
        size = max(256, 1 << (n - 1).bit_length())
        _factors = np.random.Generator(np.random.PCG64(_SEED + 1)).integers(0, 1 << 63, size, dtype=_U64) * _U64(2) + _U64(1)
    return _factors


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of MurmurHash3)."""
    values = values ^ (values >> _U64(33))
    values = values * _U64(0xFF51AFD7ED558CCD)
    values ^= values >> _U64(33)
    values *= _U64(0xC4CEB9FE1A85EC53)
    values ^= values >> _U64(33)
    return values


def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES):
    """(first row, bytes, offsets) of successive runs of whole texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    begin = 0
    while begin < len(column):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + slice_bytes, "right")) - 1)
        yield begin, data[offsets[begin]:offsets[end]], offsets[begin:end + 1] - offsets[begin]
        begin = end


@dataclass
class Words:
    """Words of one slice in order: hash, first byte, and for each text the range first[i]:first[i + 1]."""
    hashes: np.ndarray
    starts: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, size: int) -> np.ndarray:
        """Places of the words at which a window of ``size`` words of one text begins."""
        place = np.arange(len(self.hashes))
        return place[place + size <= np.repeat(self.first[1:], np.diff(self.first))]


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    is_word = _IS_WORD[data]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = is_word[edges]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.zeros(0, _U64), starts, first)
    values = _LOWER[data]
    bounds = np.concatenate(([0], starts, [len(data)]))         # white space goes with the word before it and counts nothing
    lengths = np.diff(bounds)
    place = np.arange(len(data)) - np.repeat(bounds[:-1], lengths)
    values *= _place_factors(int(lengths.max())).take(place, mode="clip")
    return Words(mix(np.add.reduceat(values, starts)), starts, first)


def window_hashes(hashes: np.ndarray, places: np.ndarray, offsets) -> np.ndarray:
    """Hash of the words at ``places + offset`` for each offset in turn; the order of the words matters."""
    total = np.full(len(places), len(offsets), _U64)
    for number, offset in enumerate(offsets):
        total += hashes[places + offset] * _U64((_MULTIPLIER * (2 * number + 1)) & (1 << 64) - 1)
        total = mix(total)
    return total


def shingle_sets(words: Words, size: int):
    """For each text the sorted distinct hashes of its windows of ``size`` words; a shorter text is one window."""
    places = words.windows(size)
    hashes = window_hashes(words.hashes, places, range(size))
    bounds = np.searchsorted(places, words.first)
    for text, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if end > begin:
            yield np.unique(hashes[begin:end])
        else:
            first, last = words.first[text:text + 2]
            yield window_hashes(words.hashes, np.array([first]), range(last - first)) if last > first else hashes[:0]
