"""N-grams of text chunks as numpy arrays: word numbers, hashed keys in key
order, and compact bytes for them. Used by LM scoring and phrase mining."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Numbers(dict):
    """Numbers words in the order they come; ``names`` may be shared by several."""

    def __init__(self, names: list | None = None):
        super().__init__()
        self.names = [] if names is None else names

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def mix(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit key of an n-gram from that of its first n-1 words and its last word."""
    x = history * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(raw: bytes) -> bytes:
    """Zstandard, with the size in front."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def to_planes(a: np.ndarray) -> bytes:
    """64-bit numbers as packed byte planes; the high ones compress to nothing."""
    return packed(np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T.tobytes())


def from_planes(raw: bytes, dtype=np.int64) -> np.ndarray:
    planes = np.frombuffer(unpacked(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def to_deltas(ordered: np.ndarray) -> bytes:
    return to_planes(np.diff(ordered, prepend=np.uint64(0)))


def from_deltas(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(raw, np.uint64), dtype=np.uint64)


def bucket_slices(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2^bits buckets (by high bits) begins in ordered keys, and the end."""
    if not bits:
        return np.array([0, len(keys)])
    borders = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])


def bucket_bits(tokens: int, per_bucket: int) -> int:
    """Bits of the key that number enough buckets for ``per_bucket`` tokens each."""
    return max(0, int(np.ceil(np.log2(max(1.0, tokens / per_bucket)))))
