"""Hashes of many spans of one byte string at a time (numpy, for use inside tasks).

``span_hashes``: each byte is replaced by a fixed 64-bit value and multiplied by a power of an odd base; with
running sums modulo 2**64, the hash of any span takes one subtraction and one product. Modulo a power of
two there are regular strings of 1,024 bytes and more (Thue-Morse words) that agree for every base, so this one
only names short strings or strings that are compared afterwards.

``word_windows``: every word by xxh3 (64 bits), the words of a window then mixed one after the other, so that
a window's hash depends on each word through a permutation of 64 bits and no structure of the text cancels.
"""

from __future__ import annotations

import numpy as np
import xxhash

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of BASE and of its inverse, grown on demand


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.cumprod(row, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``data[s:e]`` for each s, e of ``starts``, ``ends``."""
    raw = np.frombuffer(data, np.uint8)
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[raw] * up[: len(raw)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(BASE))


def word_hashes(text: bytes, piece: int = 1 << 20) -> np.ndarray:
    """Hash of each word (ASCII blanks separate). Long texts are split piece by piece, at blanks."""
    found, at = [], 0
    while at < len(text):
        end = at + piece
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = text[at:end].split()
        found.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, np.uint64), *found])


def windows_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words, given the words' hashes; empty when there are fewer."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = mix(hashes[:n] + np.uint64(size))
    for k in range(1, size):
        out = mix(out * np.uint64(BASE) + hashes[k:n + k])
    return out


def word_windows(words: list[bytes], size: int) -> np.ndarray:
    return windows_of(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), size)
