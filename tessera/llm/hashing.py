"""Hash functions shared by the training-data operators: mixing, prefix powers, word shingles."""

from __future__ import annotations

import numpy as np

#: A-Z become a-z; what ends a word becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
#: Texts are hashed together up to about so many bytes.
AT_ONCE = 1 << 20
_powers: dict[int, np.ndarray] = {}


def mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """A bijective mix of 64-bit hashes."""
    h = h + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    if len(_powers.get(base, ())) < n:
        full = np.full(1 << max(n, 1).bit_length(), base, np.uint64)
        full[0] = 1
        _powers[base] = np.cumprod(full)
    return _powers[base][:n]


def shingle_hashes(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """The hash of each shingle of each text, in order, repeats included."""
    buf = np.frombuffer(b" ".join([*texts, b""]).translate(FOLD), np.uint8)
    at = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    letter = np.concatenate(([0], (buf != 32).view(np.int8), [0]))
    edge = np.flatnonzero(np.diff(letter))
    a, b = edge[::2], edge[1::2]
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(buf)))))
    word = mixed((prefix[b] - prefix[a]) * powers(INVERSE, len(buf) + 1)[a] + (b - a).astype(np.uint64), 1)
    weights = mixed(np.arange(1, size + 1, dtype=np.uint64), 3) | np.uint64(1)
    n = max(0, len(word) - size + 1)
    full = np.zeros(n, np.uint64)
    for j in range(size):
        full += word[j : j + n] * weights[j]
    full = mixed(full, 2)
    ends = np.searchsorted(a, at)
    starts = np.concatenate(([0], ends[:-1]))
    out = []
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        if e - s >= size:
            out.append(full[s : e - size + 1])
        elif e > s:
            out.append(mixed((word[s:e] * weights[: e - s]).sum(keepdims=True, dtype=np.uint64) + np.uint64(e - s), 4))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
