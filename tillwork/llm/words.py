"""Words of whole texts and their hashes, for use inside tasks.

A word is a run of characters other than space and tab to carriage return. On UTF-8
bytes that is exactly ``bytes.split()``, and ``bytes.lower()`` lowers A-Z alone.
"""

from __future__ import annotations

import numpy as np
import xxhash

WORD = r"[^\x20\x09-\x0D]+"
_CACHED_WORDS = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text as UTF-8; none of a missing text."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class WordHashes(dict):
    """64-bit hashes of words. It keeps a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        self[word] = value
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which close inputs give unlike outputs."""
    z = values.copy()
    z ^= z >> np.uint64(30)
    z *= _MIX[0]
    z ^= z >> np.uint64(27)
    z *= _MIX[1]
    z ^= z >> np.uint64(31)
    return z


class Rolling:
    """Hashes of all windows of some number of consecutive words.

    A window's hash is the polynomial of its word hashes in an odd base, modulo 2^64,
    taken from one running sum; another ``seed`` gives an independent hash.
    """

    def __init__(self, seed: int = 0):
        self.base = mixed(np.array([seed + 1], np.uint64) * _ODD)[0] | np.uint64(1)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers))
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, self.base)])
            self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, self.inverse)])

    def sums(self, hashes: np.ndarray) -> np.ndarray:
        self._reach(len(hashes) + 1)
        running = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.powers[: len(hashes)], out=running[1:])
        return running

    def windows(self, hashes: np.ndarray, length: int, sums: np.ndarray | None = None):
        """One hash for each start, in order; none if the text is shorter."""
        n = len(hashes) - length + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        running = self.sums(hashes) if sums is None else sums
        return mixed((running[length:] - running[:n]) * self.inverses[:n])


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)


def minimizers(values: np.ndarray, span: int) -> np.ndarray:
    """Positions that hold the least value of some ``span`` consecutive ones.

    Two texts that share ``span`` consecutive values pick at least one of the shared
    positions alike. Of equal least values the first counts. With fewer values than
    ``span``, none is picked.
    """
    if len(values) < span:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(values, span)
    return np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
