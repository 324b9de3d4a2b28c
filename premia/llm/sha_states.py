"""SHA-256 with states that can be stored: the state after whole 64-byte blocks, for many messages at once (numpy).

``hashlib`` can copy a state within a process but not hand it out. A digest as lower-case hex text is exactly one block,
so the state between two such inputs is eight 32-bit words and nothing else.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

_MASK = 0xFFFFFFFF
#: Messages handled in step; their working set stays in the cache.
_STEP = 4096


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid - 1)
    return low


# By the standard: the first 32 bits of the fractions of the roots of the first primes.
START = np.array([isqrt(p << 64) & _MASK for p in _primes(8)], np.uint32)
_ROUND = np.array([_cube_root(p << 96) & _MASK for p in _primes(64)], np.uint32)
_HEX = np.frombuffer(b"".join(b"%02x" % i for i in range(256)), np.uint16)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def _absorbed(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = list(block.T.copy())
    for t in range(16, 64):
        a, b = w[t - 15], w[t - 2]
        low = _turn(a, 7) ^ _turn(a, 18) ^ (a >> np.uint32(3))
        high = _turn(b, 17) ^ _turn(b, 19) ^ (b >> np.uint32(10))
        w.append(w[t - 16] + low + w[t - 7] + high)
    a, b, c, d, e, f, g, h = state.T.copy()
    for t in range(64):
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[t] + w[t]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h], axis=1)


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n x 8) after one more block each (n x 16 big-endian words)."""
    if not len(states):
        return states
    return np.concatenate([_absorbed(states[i : i + _STEP], blocks[i : i + _STEP]) for i in range(0, len(states), _STEP)])


def hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests (n x 8 words) as their lower-case hex text, one block each."""
    raw = digests.astype(">u4").view(np.uint8).reshape(-1, 32)
    return np.ascontiguousarray(_HEX[raw]).view(np.uint8).reshape(-1, 64).view(">u4").astype(np.uint32)


def finish(states: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Digests of messages of ``n_blocks`` whole blocks."""
    last = np.zeros((len(states), 16), np.uint32)
    last[:, 0] = 0x80000000
    bits = n_blocks.astype(np.uint64) * np.uint64(512)
    last[:, 14], last[:, 15] = bits >> np.uint64(32), bits & np.uint64(_MASK)
    return absorb(states, last)


def words(raw: bytes | np.ndarray) -> np.ndarray:
    """Concatenated 32-byte values as n x 8 words."""
    return np.frombuffer(raw, ">u4").reshape(-1, 8).astype(np.uint32)


def raw_bytes(values: np.ndarray) -> bytes:
    return values.astype(">u4").tobytes()
