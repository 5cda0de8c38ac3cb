"""Hashed word shingles of texts, in numpy over whole chunks of texts."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd

_P = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fold_hash(words: np.ndarray) -> np.uint64:
    """One hash of a short sequence of word hashes; its length counts."""
    h = np.uint64(len(words))
    with np.errstate(over="ignore"):
        for w in words:
            h = mix(np.asarray(h * _P + w))[()]
    return h


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, with A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Per text its sorted distinct 64-bit hashes of k-word shingles; a text with
    fewer words has its whole sequence as one shingle, one without words none."""
    lists = [words_of(t) for t in texts]
    ends = np.cumsum([len(x) for x in lists])
    flat = np.empty(ends[-1] if len(ends) else 0, dtype=object)
    at = 0
    for x in lists:
        flat[at : at + len(x)] = x
        at += len(x)
    words = pd.util.hash_array(flat, categorize=False).astype(np.uint64) if len(flat) else np.zeros(0, np.uint64)
    rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            rolled = rolled * _P + words[j : j + len(rolled)]
    rolled = mix(rolled)
    out = []
    for x, end in zip(lists, ends):
        start = end - len(x)
        if len(x) >= k:
            out.append(np.unique(rolled[start : end - k + 1]))
        else:
            out.append(np.array([fold_hash(words[start:end])], np.uint64) if len(x) else np.zeros(0, np.uint64))
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


class MinHash:
    """Minima of ``bands * rows`` universal hashes ``a * x + b`` modulo 2**32 (odd a)."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 256):  # blocks that stay in the processor's cache
            block = x[i : i + 256, None] * self.a
            block += self.b
            np.minimum(out, block.min(axis=0), out=out)
        return out

    def band_keys(self, signatures: np.ndarray) -> np.ndarray:
        """Per row of signatures one 64-bit key for each band; the band's number counts."""
        parts = signatures.reshape(len(signatures), self.bands, self.rows).astype(np.uint64)
        keys = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
        with np.errstate(over="ignore"):
            for j in range(self.rows):
                keys = mix(keys * _P + parts[:, :, j])
        return keys.astype(np.int64)
