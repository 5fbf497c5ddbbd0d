"""Word and shingle hashes of whole Arrow batches in numpy.

A word is a run of ASCII letters, digits, underscores and non-ASCII characters, in lower case. Its hash is polynomial over its
UTF-8 bytes: with S the running sums of byte * B^i (mod 2^64), a word from s to e has (S[e] - S[s]) * B^-s, so that all words
of a batch take a few passes over its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE_WORDS = 5
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD6E8FEB86659FD93
BACK = pow(BASE, -1, 1 << 64)

IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


class Powers:
    """BASE^i and BASE^-i mod 2^64, grown as needed."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(BACK, k, 1 << 64))])
        return self.up, self.down


POWERS = Powers()


def mixed(x: np.ndarray, seed: np.uint64 = MIX) -> np.ndarray:
    x = (x ^ seed) * MIX
    x ^= x >> np.uint64(32)
    x *= seed
    return x ^ (x >> np.uint64(29))


def _words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words in lower-case UTF-8 bytes; no word runs over a text's begin."""
    n = len(data)
    inside = IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = begins[(begins > 0) & (begins < n)]
    first[begins] = inside[begins]
    last[begins - 1] = inside[begins - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = POWERS.get(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts]), starts


def word_hashes(texts: pa.Array) -> list[np.ndarray]:
    """One array for each text, in the words' order; empty for null."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    texts = pa.concat_arrays([texts])  # so that it starts at its buffers' start
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):  # half a MB at a time, which stays in the cache
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 19), side="right")) - 1)
        part = data[offsets[at] : offsets[end]]
        begins = offsets[at:end] - offsets[at]
        hashes, starts = _words(part, begins)
        out += np.split(hashes, np.searchsorted(starts, begins[1:]))
        at = end
    return out


def shingles_of_words(h: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """One hash for each n-word window in order; one to n - 1 words are one window."""
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for j in range(n):
        out ^= h[j : j + len(out)]
        out *= MIX
        out ^= out >> np.uint64(29)
    return out


def shingles(texts: pa.Array) -> list[np.ndarray]:
    """The five-word shingle hashes of each text in order."""
    return [shingles_of_words(h) for h in word_hashes(texts)]


def shingles_of(text: str | None) -> np.ndarray:
    return shingles(pa.array([text], pa.string()))[0]
