"""The beginnings of many MD5 digests at once in numpy, for short pieces of one byte array."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np

#: Bytes of a message that fit one block beside its end mark and its length.
FITS = 55
BLOCK = 64


def md5_heads() -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """A function to the first four bytes, big-endian, of the digest of each piece of ``data`` (RFC 1321).

    Pieces have a start and at most ``FITS`` bytes; ``data`` goes on for a block after the last
    start. The helper is built here, so it travels to the executors by value.
    """
    at, sizes = np.arange(BLOCK), np.arange(FITS + 1)[:, None]
    inside = np.where(at < sizes, 255, 0).astype(np.uint8)
    ending = np.where(at == sizes, 128, 0).astype(np.uint8)
    ending.view("<u8")[:, 7] = sizes[:, 0] * 8
    block = BLOCK
    sines = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
    turns = [np.uint32(t) for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in four * 4]
    word_of = [(k * i + j) % 16 for k, j in ((1, 0), (5, 1), (3, 5), (7, 0)) for i in range(16)]
    state = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]

    def heads(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        blocks = np.lib.stride_tricks.sliding_window_view(data, block)[starts]
        blocks &= inside[sizes]
        blocks |= ending[sizes]
        words = np.ascontiguousarray(blocks.view("<u4").T)
        a, b, c, d = (np.full(len(starts), x, np.uint32) for x in state)
        for i in range(64):
            if i < 16:
                mixed = d ^ (b & (c ^ d))
            elif i < 32:
                mixed = c ^ (d & (b ^ c))
            elif i < 48:
                mixed = b ^ c ^ d
            else:
                mixed = c ^ (b | ~d)
            mixed += a
            mixed += words[word_of[i]]
            mixed += sines[i]
            high = mixed << turns[i]
            mixed >>= np.uint32(32) - turns[i]
            mixed |= high
            mixed += b
            a, b, c, d = d, mixed, b, c
        return (a + state[0]).byteswap()

    return heads
