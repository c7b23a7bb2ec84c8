"""Words, shingles and windows of whole texts as 64-bit fingerprints.

Words are ``[^\\x20\\x09-\\x0D]+``.  A word's fingerprint is a polynomial over
table values of its bytes modulo 2**64 (odd base, so prefix sums can be
shifted back by the inverse base), followed by a bijective mix.  Everything is
vectorised over blocks of about a megabyte, whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
MASK = (1 << 64) - 1
BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the published splitmix64 constants)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers that follow from ``seed``."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


def inverse(odd: int) -> int:
    """Inverse of an odd number modulo 2**64 (Newton)."""
    y = odd
    for _ in range(6):
        y = y * (2 - odd * y) & MASK
    return y


_VALUES = numbers(11, 256)
_BASE = int(numbers(12, 1)[0])
_SPREAD = numbers(13, 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64, kept up to one block."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 12)
        size = 1 << (size - 1).bit_length()
        with np.errstate(over="ignore"):
            have = np.full(size, base, U)
            have[0] = 1
            np.multiply.accumulate(have, out=have)
        if size <= 4 * BLOCK:
            _POWERS[base] = have
    return have[:n]


def _fold(b: np.ndarray) -> np.ndarray:
    upper = (b >= 65) & (b <= 90)
    return b + (upper.view(np.uint8) << 5)


def spans(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words in ``b``."""
    white = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).view(np.int8)))
    return edge[::2], edge[1::2]


def hash_spans(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprint of the bytes [start, end) of ``b``, for each span."""
    if not len(start):
        return np.empty(0, U)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(b) + 1, U)
        np.cumsum(_VALUES[b] * powers(_BASE, len(b)), out=sums[1:])
        back = powers(inverse(_BASE), len(b))
        size = (end - start).astype(U)
        return mix((sums[end] - sums[start]) * back[start] + size * _SPREAD[63])


def _block(data: bytes, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(data, np.uint8)
    start, end = spans(b)
    return hash_spans(_fold(b) if fold else b, start, end), start


def cut_blocks(data: bytes) -> Iterator[bytes]:
    """``data`` in blocks cut at white space; a longer word stays whole."""
    at = 0
    while len(data) - at > BLOCK:
        to = at + BLOCK
        cut = max(data.rfind(c, at, to) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= at:
            after = [i for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (i := data.find(c, to)) >= 0]
            cut = min(after, default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def word_hashes(rows: list[bytes | None], fold: bool = False) -> Iterator[np.ndarray]:
    """The fingerprints of each text's words, in order; null counts as empty."""
    group: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        if len(group) == 1 and len(group[0]) > BLOCK:
            yield np.concatenate([_block(x, fold)[0] for x in cut_blocks(group[0])])
            return
        hashes, start = _block(b" ".join(group), fold)
        ends = np.cumsum([len(x) + 1 for x in group])
        at = 0
        for to in np.searchsorted(start, ends):
            yield hashes[at:to]
            at = to

    for row in rows:
        row = row or b""
        if group and size + len(row) > BLOCK:
            yield from flush()
            group, size = [], 0
        group.append(row)
        size += len(row)
    if group:
        yield from flush()


def window_hashes(w: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Fingerprint of every ``k`` consecutive words of ``w`` (64 bits)."""
    n = len(w) - k + 1
    if n <= 0:
        return np.empty(0, U)
    base = int(numbers(seed, 1)[0])
    with np.errstate(over="ignore"):
        sums = np.zeros(len(w) + 1, U)
        np.cumsum(mix(w ^ U(seed)) * powers(base, len(w)), out=sums[1:])
        return mix((sums[k:] - sums[:n]) * powers(inverse(base), n))


def shingles(w: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct ``k``-word shingles; fewer words make one shingle."""
    if not len(w):
        return w
    with np.errstate(over="ignore"):
        if len(w) < k:
            one = (w * _SPREAD[: len(w)]).sum(dtype=U) + U(len(w)) * _SPREAD[62]
            return mix(np.array([one], U))
        total = w[: len(w) - k + 1] * _SPREAD[0]
        for i in range(1, k):
            total = total + w[i : len(w) - k + 1 + i] * _SPREAD[i]
        return np.unique(mix(total))


def sequence_key(w: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit fingerprints of a sequence (order matters)."""
    out = []
    with np.errstate(over="ignore"):
        for seed in (21, 22):
            base = int(numbers(seed, 1)[0])
            total = (mix(w ^ U(seed)) * powers(base, len(w))).sum(dtype=U) + U(len(w)) * U(base)
            out.append(int(mix(np.array([total], U)).view(np.int64)[0]))
    return out[0], out[1]


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit fingerprints of a set of fingerprints."""
    return sequence_key(s)
