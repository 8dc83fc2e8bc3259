"""SHA-256 of whole blocks, with states that can be kept, stored and resumed.

The hash objects of Python cannot leave their process, so the states of a tree
that spans tasks are kept as the eight words between two blocks.  All functions
work on many messages at once: a state or digest is an array (8, n), a block of
64 bytes an array (16, n), both of 32-bit words.  The hexadecimal text of a
digest is one block exactly.
"""

from __future__ import annotations

import numpy as np


def _primes(count: int) -> list[int]:
    found: list[int] = []
    number = 2
    while len(found) < count:
        if all(number % p for p in found):
            found.append(number)
        number += 1
    return found


def _root_bits(number: int, degree: int) -> int:
    """The first 32 bits after the point of the ``degree``-th root of ``number``."""
    scaled, root = number << (32 * degree), 0
    for bit in reversed(range(40)):
        if (root | 1 << bit) ** degree <= scaled:
            root |= 1 << bit
    return root & 0xFFFFFFFF


#: The standard's constants, by its rule.
_ROUNDS = np.array([_root_bits(p, 3) for p in _primes(64)], np.uint32)
INITIAL = np.array([_root_bits(p, 2) for p in _primes(8)], np.uint32)
_HEX = np.frombuffer(b"".join(b"%02x" % n for n in range(256)), np.uint16)


def _rotated(words: np.ndarray, by: int) -> np.ndarray:
    return (words >> np.uint32(by)) | (words << np.uint32(32 - by))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block each."""
    schedule = np.empty((64, block.shape[1]), np.uint32)
    schedule[:16] = block
    for t in range(16, 64):
        early, late = schedule[t - 15], schedule[t - 2]
        schedule[t] = schedule[t - 16] + schedule[t - 7]
        schedule[t] += _rotated(early, 7) ^ _rotated(early, 18) ^ (early >> np.uint32(3))
        schedule[t] += _rotated(late, 17) ^ _rotated(late, 19) ^ (late >> np.uint32(10))
    schedule += _ROUNDS[:, None]
    a, b, c, d, e, f, g, h = state
    for word in schedule:
        mixed = h + (_rotated(e, 6) ^ _rotated(e, 11) ^ _rotated(e, 25)) + (g ^ (e & (f ^ g))) + word
        majority = (a & b) | (c & (a | b))
        spread = _rotated(a, 2) ^ _rotated(a, 13) ^ _rotated(a, 22)
        a, b, c, d, e, f, g, h = mixed + spread + majority, a, b, c, d + mixed, e, f, g
    return np.stack([a, b, c, d, e, f, g, h]) + state


def closed(state: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    """The digests of messages of so many whole blocks."""
    padding = np.zeros((16, state.shape[1]), np.uint32)
    padding[0] = 0x80000000
    bits = np.asarray(blocks, np.uint64) * np.uint64(512)
    padding[14], padding[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return compress(state, padding)


def fresh(count: int) -> np.ndarray:
    return np.repeat(INITIAL[:, None], count, axis=1)


def from_bytes(joined: bytes) -> np.ndarray:
    """States or digests that follow each other, 32 bytes each."""
    return np.frombuffer(joined, ">u4").reshape(-1, 8).T.astype(np.uint32)


def to_bytes(words: np.ndarray) -> np.ndarray:
    """An array (n, 32) of bytes."""
    return np.ascontiguousarray(words.T).astype(">u4").view(np.uint8).reshape(-1, 32)


def texts(words: np.ndarray) -> np.ndarray:
    """Lower-case hexadecimal digests, an array (n, 64) of bytes."""
    return _HEX[to_bytes(words)].view(np.uint8).reshape(-1, 64)


def text_blocks(words: np.ndarray) -> np.ndarray:
    return texts(words).view(">u4").reshape(-1, 16).T.astype(np.uint32)
