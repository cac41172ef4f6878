"""Word shingles of texts as sorted 64-bit hashes, and minimum-hash signatures over them (numpy, inside tasks)."""

from __future__ import annotations

import hashlib

import numpy as np

#: Words a worker remembers the hash of; the table starts anew when full, so memory stays bounded.
REMEMBERED = 200_000

_known: dict[bytes, int] = {}


def _hash(word: bytes) -> int:
    if len(_known) >= REMEMBERED:
        _known.clear()
    h = _known[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words, A-Z lower-cased.

    A text of fewer words is one shingle; a text without words, or none, gives an empty set. ``bytes.lower`` changes
    A-Z only, and ``bytes.split`` cuts at exactly the six white-space bytes that end a word.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    get = _known.get
    h = np.array([get(w) or _hash(w) for w in words], np.uint64)
    n = max(1, len(words) - width + 1)
    out = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for i in range(min(width, len(words))):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(out)


def set_key(hashes: np.ndarray) -> bytes | None:
    """Sixteen bytes that name a set; none for the empty set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def coefficients(k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**32, k, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, k, dtype=np.uint32)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 256) -> np.ndarray:
    """For each of k permutations of 32-bit numbers the smallest value over the set."""
    k = len(a)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(k, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(short), block):
        mixed = short[i:i + block, None] ^ b
        mixed *= a
        np.minimum(low, mixed.min(axis=0), out=low)
    return low


def tagged(values: np.ndarray) -> np.ndarray:
    """Coordinate-value pairs of a signature as longs."""
    return (np.arange(len(values), dtype=np.int64) << 32) | values.astype(np.int64)


def sketch(values: np.ndarray) -> bytes:
    """One byte per coordinate: equal values have equal bytes, different ones in 255 of 256 cases not."""
    return ((values * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()
