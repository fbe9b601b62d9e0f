"""MD5 of many short texts at a time, as the hash keys of SQL have it."""

from __future__ import annotations

import hashlib
import math

import numpy as np

#: Longest text that is one block of MD5.
ONE_BLOCK = 55
#: Texts that are hashed together, few enough to stay in a core's cache.
TOGETHER = 16_384
SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
ORDERS = ((1, 0), (5, 1), (3, 5), (7, 0))  # word of step i: a * i + b


def md5_heads(head: bytes, texts: np.ndarray) -> np.ndarray:
    """The first 16 hexadecimal digits of md5(head + text) as a number, of texts of
    one length (a row of bytes each)."""
    n, length = texts.shape
    if len(head) + length > ONE_BLOCK:
        digests = [hashlib.md5(head + t.tobytes()).digest()[:8] for t in texts]
        return np.frombuffer(b"".join(digests), dtype=">u8").astype(np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for lo in range(0, n, TOGETHER):
        out[lo : lo + TOGETHER] = _one_block(head, texts[lo : lo + TOGETHER])
    return out


def _one_block(head: bytes, texts: np.ndarray) -> np.ndarray:
    n, length = texts.shape
    size = len(head) + length
    block = np.zeros((n, 64), dtype=np.uint8)
    block[:, : len(head)] = np.frombuffer(head, dtype=np.uint8)
    block[:, len(head) : size] = texts
    block[:, size] = 0x80
    block[:, 56:] = np.frombuffer((8 * size).to_bytes(8, "little"), dtype=np.uint8)
    used = size // 4 + 1  # words that differ between texts; all others are the same
    words = [*np.ascontiguousarray(block.view("<u4")[:, :used].T), *(int(w) for w in block.view("<u4")[0, used:])]
    a, b, c, d = (np.full(n, s, dtype=np.uint32) for s in START)
    mixed, high = np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.uint32)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            np.bitwise_xor(c, d, out=mixed)
            mixed &= b
            mixed ^= d
        elif kind == 1:
            np.bitwise_xor(b, c, out=mixed)
            mixed &= d
            mixed ^= c
        elif kind == 2:
            np.bitwise_xor(b, c, out=mixed)
            mixed ^= d
        else:
            np.invert(d, out=mixed)
            mixed |= b
            mixed ^= c
        times, first = ORDERS[kind]
        word, constant = words[(times * i + first) % 16], SINES[i]
        if isinstance(word, int):
            constant = (constant + word) & 0xFFFFFFFF
        else:
            mixed += word
        mixed += a
        mixed += np.uint32(constant)
        shift = SHIFTS[kind][i % 4]
        np.left_shift(mixed, np.uint32(shift), out=high)
        mixed >>= np.uint32(32 - shift)
        mixed |= high
        mixed += b
        a, b, c, d, mixed = d, mixed, b, c, a
    a += np.uint32(START[0])
    b += np.uint32(START[1])
    return (a.byteswap().astype(np.uint64) << np.uint64(32)) | b.byteswap()
