"""Words, hashes and batches for the operators whose tasks run Python.

Texts travel as UTF-8 bytes: both kinds of words can be cut from bytes, as every separator is one ASCII byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

# A-Z become a-z, separators become blanks, digits, letters and all bytes of other scripts stay
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
MEMO_WORDS = 200_000


def folded_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(_FOLD).split()


def plain_words(text: bytes) -> list[bytes]:
    """Runs without blank, tab and line breaks (U+0009 to U+000D), unchanged."""
    return text.split()


class WordHashes(dict):
    """Word -> 64-bit hash, remembering up to ``MEMO_WORDS`` words (a memo: the hash of others is computed again)."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each ``k`` consecutive words; empty if there are fewer words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= _MULTIPLIER
        out += hashes[i:n + i]
    return mixed(out)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def span_hashes(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of ``lengths`` words from each of ``starts``."""
    if len(_powers[0]) < len(hashes):
        inverse = np.uint64(pow(int(_MULTIPLIER), -1, 2**64))
        for i, factor in enumerate((_MULTIPLIER, inverse)):
            _powers[i] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(hashes) * 5 // 4, factor)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * _powers[0][:len(hashes)])])
    return mixed((sums[starts + lengths] - sums[starts]) * _powers[1][starts] + lengths.astype(np.uint64))


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    out = values ^ (values >> np.uint64(30))
    out *= _MIX
    out ^= out >> np.uint64(31)
    return out


def minimiser_positions(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions that hold the smallest (leftmost on ties) of some ``w`` consecutive hashes, ascending.

    Depends on content only, and every ``w`` consecutive positions hold at least one. Fewer hashes than
    ``w`` are one window.
    """
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.int64)
    if n <= w:
        return np.array([int(hashes.argmin())])
    windows = np.lib.stride_tricks.sliding_window_view(hashes, w)
    return np.unique(windows.argmin(axis=1) + np.arange(n - w + 1))


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window of ``length`` that begins at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, n), -1)
    return np.cumsum(steps[:n]) > 0


def utf8(column: pa.Array) -> list[bytes | None]:
    """A text column as bytes."""
    return column.cast(pa.large_binary()).to_pylist()


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, np.uint64).view(np.int64)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` of a task's rows, which must come sorted by it, one table each."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            part = table.slice(start, end - start)
            if held and held[-1].column(key)[-1] != part.column(key)[0]:
                yield pa.concat_tables(held)
                held = []
            held.append(part)
    if held:
        yield pa.concat_tables(held)
