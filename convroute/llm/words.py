"""Words of a batch of texts as arrays: where they begin and end, and hashes of runs of them.

A whole Arrow batch is split at once: a byte table maps every byte to what it counts as, with the blank for
everything that separates words.  UTF-8 makes this exact, since the bytes of a multi-byte character never equal
an ASCII byte.  The words are laid out again with exactly one blank after each, so that a run of words is one
slice and equal runs are equal bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text handled at once; one longer text is handled alone.
SLICE_BYTES = 1 << 19

BLANK = 0x20


def blank_separated(lower: bool) -> np.ndarray:
    """Byte table for words between U+0020 and U+0009 to U+000D; ``lower`` lower-cases A-Z."""
    table = np.arange(256, dtype=np.uint8)
    table[0x09:0x0E] = BLANK
    if lower:
        table[0x41:0x5B] += 0x20
    return table


def alphanumeric() -> np.ndarray:
    """Byte table for lower-cased words of 0-9, a-z and everything beyond ASCII."""
    table = blank_separated(lower=True)
    ascii_bytes = np.arange(256) < 0x80
    digit = (table >= 0x30) & (table <= 0x39)
    letter = (table >= 0x61) & (table <= 0x7A)
    table[ascii_bytes & ~digit & ~letter] = BLANK
    return table


@dataclass
class Words:
    """Words of several texts. ``data`` holds all words, each followed by one blank."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: First word of each text, and one more entry for the end.
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        """For every word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array, and where each text begins (nulls are empty)."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if raw is None else np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split_words(texts: pa.Array, table: np.ndarray) -> Words:
    raw, offsets = utf8(texts)
    return split_mapped(table[raw], offsets)


def split_shapes(texts: pa.Array) -> Words:
    """Words by shape: A for a run of capitals, a for other letters, 0 for digits; other signs once per run."""
    table = blank_separated(lower=False)
    table[0x41:0x5B], table[0x61:0x7B], table[0x30:0x3A], table[0x80:] = 0x41, 0x61, 0x30, 0x61
    raw, offsets = utf8(texts)
    mapped = table[raw]
    keep = np.ones(len(mapped), bool)
    keep[1:] = mapped[1:] != mapped[:-1]
    keep[offsets[:-1][offsets[:-1] < len(mapped)]] = True
    return split_mapped(mapped[keep], np.concatenate([[0], np.cumsum(keep)])[offsets])


def split_mapped(mapped: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of texts whose bytes are mapped already; text ``i`` is between offsets ``i`` and ``i + 1``."""
    solid = mapped != BLANK
    before, after = np.zeros_like(solid), np.zeros_like(solid)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    bounds = offsets[1:-1]
    before[bounds[bounds < len(mapped)]] = False
    after[bounds[bounds > 0] - 1] = False
    begins = solid & ~before
    starts, ends = np.flatnonzero(begins), np.flatnonzero(solid & ~after) + 1
    first = np.searchsorted(starts, offsets)
    lengths = ends - starts
    out_start = np.cumsum(lengths + 1) - (lengths + 1)
    data = np.full(int(lengths.sum()) + len(starts), BLANK, np.uint8)
    shift = np.repeat(out_start - (np.cumsum(lengths) - lengths), lengths)
    data[np.arange(len(shift)) + shift] = mapped[solid]
    return Words(data, out_start, out_start + lengths, first)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``most`` bytes of text each, or a single longer text."""
    if batch.num_rows == 0:
        return
    lengths = np.diff(utf8(batch.column(column))[1])
    total, begin = np.cumsum(lengths), 0
    while begin < batch.num_rows:
        limit = (total[begin - 1] if begin else 0) + most
        end = max(begin + 1, int(np.searchsorted(total, limit, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


# --- Hashes ---------------------------------------------------------------------------------------

_U64 = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(base)
    if have is None or len(have[0]) < size:
        size = max(size, SLICE_BYTES * 2)
        tables = []
        for factor in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, factor, _U64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=_U64))
        have = tables[0], tables[1]
        if size <= SLICE_BYTES * 4:
            _powers[base] = have
    return have


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser of a multiply-xorshift hash)."""
    x = values.astype(_U64, copy=True)
    x ^= x >> _U64(33)
    x *= _U64(0xFF51AFD7ED558CCD)
    x ^= x >> _U64(33)
    x *= _U64(0xC4CEB9FE1A85EC53)
    x ^= x >> _U64(33)
    return x


class RunHashes:
    """64-bit hashes of slices of ``data`` in constant time each, from one running polynomial sum."""

    def __init__(self, data: np.ndarray, which: int = 0):
        power, self._inverse = _power_tables(_BASES[which], len(data) + 1)
        self._sums = np.zeros(len(data) + 1, _U64)
        np.cumsum((data.astype(_U64) + _U64(1)) * power[: len(data)], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._inverse[start])


#: Longer words are hashed one by one.
_LONG_WORD = 64
_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344)


def word_hashes(words: Words, which: int = 0) -> np.ndarray:
    """64-bit hashes of whole words; two values of ``which`` give independent ones.

    Eight bytes at a time are mixed in by a finaliser, which is not linear: unlike the polynomial of ``RunHashes``,
    there are no families of words that are known to be equal under every base.
    """
    seed = _SEEDS[which]
    size = words.end - words.start
    held = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(words.data) + 1, "<u8", held.data, strides=(1,))
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], _U64)
    out = mixed(size.astype(_U64) ^ _U64(seed))
    live = np.flatnonzero(size <= _LONG_WORD)
    for done in range(0, _LONG_WORD, 8):
        live = live[size[live] > done]
        if not len(live):
            break
        bytes_left = np.minimum(size[live] - done, 8)
        out[live] = mixed(out[live] ^ (eight[words.start[live] + done] & masks[bytes_left])) + _U64(seed >> 1)
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(words.data[words.start[i] : words.end[i]], seed=seed)
    return out


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, from the words' hashes: halves are mixed together, pair by pair."""

    def together(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return mixed(left * _U64(0x9E3779B97F4A7C15) ^ mixed(right + _U64(0xC2B2AE3D27D4EB4F)))

    whole, size, power, have = None, 0, hashes, 1
    while True:
        if length & have:
            count = len(hashes) - size - have + 1
            piece = power[size : size + count] if count > 0 else power[:0]
            whole = piece if whole is None else together(whole[: len(piece)], piece)
            size += have
        if size == length:
            return whole
        power = together(power[:-have], power[have:]) if len(power) > have else power[:0]
        have *= 2
