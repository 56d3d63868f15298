"""Byte n-grams of many strings at once, as bucket numbers."""

from __future__ import annotations

import numpy as np


def grams(parts: list[bytes], orders: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, bucket) of every n-gram of every part; an n-gram never leaves its part."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    owner = np.repeat(np.arange(len(parts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # bytes to the end of the part
    owners, found = [], []
    code = np.zeros(len(data), np.uint64)
    at = 0
    for n in sorted(orders):
        while at < n:
            code = code * np.uint64(0x100000001B3)
            if at < len(data):
                code[:len(data) - at] += data[at:].astype(np.uint64) + np.uint64(1)
            at += 1
        inside = left >= n
        mixed = (code[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        owners.append(owner[inside])
        found.append(((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(found)
