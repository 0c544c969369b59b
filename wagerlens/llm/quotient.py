"""Counting quotient filters over packed word-id n-grams.

The word ids of an n-gram are packed into limbs of up to 64 bits, which an invertible permutation
spreads evenly. The sorted permuted keys are cut into ranges; within a range the high bits of a key
(quotient) are told by its place and only the low bits (remainder) are stored, with a bit per slot
in use and a bit per end of a run. The remainder is kept whole, so a filter is lossless: it gives back
its n-grams and their exact counts. Filters of one range are merged in order, whatever their slots.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U = np.uint64
# Odd multipliers of a 64-bit mix.
ODD = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
FULL = (1 << 64) - 1


def _spread(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix; needs no inverse, as it is only exclusive-ored onto another limb."""
    x = (x ^ (x >> U(30))) * U(ODD[0])
    x = (x ^ (x >> U(27))) * U(ODD[1])
    return x ^ (x >> U(31))


@dataclass(frozen=True)
class Layout:
    """How n-grams of `words` word ids of `bits` bits each are packed and dealt into ranges."""

    words: int
    bits: int
    ranges: int

    @property
    def per_limb(self) -> int:
        return 64 // self.bits

    @property
    def sizes(self) -> list[int]:
        """Bits of each limb; the first is the fullest."""
        whole, left = divmod(self.words, self.per_limb)
        counts = [self.per_limb] * whole + ([left] if left else [])
        return [c * self.bits for c in counts]

    def pack(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        """One array of word ids per place of the n-gram, as permuted limbs."""
        limbs = []
        for first in range(0, self.words, self.per_limb):
            limb = np.zeros(len(columns[0]), dtype=U)
            for c in columns[first : first + self.per_limb]:
                limb = (limb << U(self.bits)) | c.astype(U)
            limbs.append(limb)
        return self._permuted(limbs)

    def unpack(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs = self._restored(limbs)
        mask, columns = U((1 << self.bits) - 1), []
        for limb, size in zip(limbs, self.sizes, strict=True):
            for shift in range(size - self.bits, -1, -self.bits):
                columns.append(((limb >> U(shift)) & mask).astype(np.int64))
        return columns

    def _masks(self) -> list[np.uint64]:
        return [U(FULL >> (64 - s)) for s in self.sizes]

    def _permuted(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs, masks = list(limbs), self._masks()
        n = len(limbs)
        for i in range(n if n > 1 else 0):  # the first limb comes first and sees the changed ones at the end
            limbs[i] = limbs[i] ^ (_spread(limbs[(i + 1) % n] + U(i)) & masks[i])
        limbs[0] = self._own(limbs[0])
        for i in range(1, n):
            limbs[0] = limbs[0] ^ (_spread(limbs[i] + U(7 + i)) & masks[0])
        return limbs

    def _restored(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs, masks = list(limbs), self._masks()
        n = len(limbs)
        for i in range(n - 1, 0, -1):
            limbs[0] = limbs[0] ^ (_spread(limbs[i] + U(7 + i)) & masks[0])
        limbs[0] = self._own_inverse(limbs[0])
        for i in range(n - 1 if n > 1 else -1, -1, -1):
            limbs[i] = limbs[i] ^ (_spread(limbs[(i + 1) % n] + U(i)) & masks[i])
        return limbs

    def _own(self, x: np.ndarray) -> np.ndarray:
        """A bijection of the numbers below 2 ** size of the first limb."""
        size, mask = self.sizes[0], self._masks()[0]
        half = U((size + 1) // 2)
        for odd in ODD:
            x = (x * U(odd)) & mask
            x = x ^ (x >> half)
        return x

    def _own_inverse(self, x: np.ndarray) -> np.ndarray:
        size, mask = self.sizes[0], self._masks()[0]
        half = U((size + 1) // 2)
        for odd in reversed(ODD):
            x = x ^ (x >> half)  # a shift of half the bits or more undoes itself
            x = (x * U(pow(odd, -1, 1 << 64))) & mask
        return x

    def floors(self) -> np.ndarray:
        return _floors(self.sizes[0], self.ranges)


@lru_cache(maxsize=8)
def _floors(size: int, ranges: int) -> np.ndarray:
    """The least first limb of each range, and the greatest of all."""
    coarse = min(size, 32)
    starts = [-(-r * (1 << coarse) // ranges) << (size - coarse) for r in range(ranges)]
    return np.array([*starts, (1 << size) - 1], dtype=U)


def counted(limbs: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order and how often each is there."""
    if not len(limbs[0]):
        return limbs, np.zeros(0, dtype=np.int64)
    if len(limbs) == 1:
        limbs = [np.sort(limbs[0])]
    else:
        order = np.lexsort(limbs[::-1])
        limbs = [x[order] for x in limbs]
    at = np.flatnonzero(_changes(limbs))
    return [x[at] for x in limbs], np.diff(np.r_[at, len(limbs[0])])


def _changes(limbs: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(limbs[0]), dtype=bool)
    if len(new):
        new[1:] = limbs[0][1:] != limbs[0][:-1]
        for x in limbs[1:]:
            new[1:] |= x[1:] != x[:-1]
    return new


def _low_bytes(x: np.ndarray, bits: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _from_low_bytes(raw: memoryview, n: int, bits: int) -> tuple[np.ndarray, memoryview]:
    width = -(-bits // 8)
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :width] = np.frombuffer(raw[: n * width], dtype=np.uint8).reshape(n, width)
    return wide.reshape(-1).view("<u8").astype(U), raw[n * width :]


def write_filter(layout: Layout, number: int, limbs: list[np.ndarray], counts: np.ndarray) -> bytes:
    """The filter of one range; keys are distinct and in order."""
    floors = layout.floors()
    least, width = int(floors[number]), int(floors[number + 1]) - int(floors[number])
    n = len(counts)
    shift = max(0, width.bit_length() - max(1, n.bit_length()))
    local = limbs[0] - U(least)
    quotient = (local >> U(shift)).astype(np.int64)
    used = np.zeros((width >> shift) + 1, dtype=bool)
    used[quotient] = True
    last = np.ones(n, dtype=bool)
    last[:-1] = quotient[1:] != quotient[:-1]
    parts = [
        np.array([n, shift, len(used)], dtype="<i8").tobytes(),
        np.packbits(used).tobytes(),
        np.packbits(last).tobytes(),
        _low_bytes(local & U((1 << shift) - 1), shift) if shift else b"",
    ]
    parts += [_low_bytes(x, size) for x, size in zip(limbs[1:], layout.sizes[1:], strict=True)]
    # Counters of one byte; larger counts follow in full.
    parts.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
    parts.append(counts[counts >= 255].astype("<i8").tobytes())
    return b"".join(parts)


def read_filter(layout: Layout, number: int, raw: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    n, shift, slots = np.frombuffer(raw[:24], dtype="<i8").tolist()
    rest = memoryview(raw)[24:]
    used = np.unpackbits(np.frombuffer(rest[: -(-slots // 8)], dtype=np.uint8), count=slots)
    rest = rest[-(-slots // 8) :]
    last = np.unpackbits(np.frombuffer(rest[: -(-n // 8)], dtype=np.uint8), count=n).astype(np.int64)
    rest = rest[-(-n // 8) :]
    quotient = np.flatnonzero(used)[np.cumsum(last) - last].astype(U)
    local = quotient << U(shift)
    if shift:
        low, rest = _from_low_bytes(rest, n, shift)
        local |= low
    limbs = [local + layout.floors()[number]]
    for size in layout.sizes[1:]:
        limb, rest = _from_low_bytes(rest, n, size)
        limbs.append(limb)
    counts = np.frombuffer(rest[:n], dtype=np.uint8).astype(np.int64)
    large = np.frombuffer(rest[n:], dtype="<i8")
    counts[counts == 255] = large
    return limbs, counts


def filters(layout: Layout, limbs: list[np.ndarray], counts: np.ndarray) -> list[tuple[int, bytes]]:
    """The ranges that hold keys and the filter of each."""
    cuts = np.searchsorted(limbs[0], layout.floors()[:-1])
    cuts = [*cuts.tolist(), len(counts)]
    return [
        (r, write_filter(layout, r, [x[a:b] for x in limbs], counts[a:b]))
        for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
        if b > a
    ]


def merge(
    layout: Layout, number: int, raws: list[bytes]
) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """Distinct keys of several filters of a range, their summed counts, and for each filter the
    places of its keys among them."""
    read = [read_filter(layout, number, raw) for raw in raws]
    sizes = [len(c) for _, c in read]
    limbs = [np.concatenate(x) for x in zip(*(part for part, _ in read), strict=True)]
    counts = np.concatenate([c for _, c in read])
    if len(limbs) == 1:
        order = np.argsort(limbs[0], kind="stable")  # runs in order: merged, not sorted anew
    else:
        order = np.lexsort(limbs[::-1])
    limbs = [x[order] for x in limbs]
    new = _changes(limbs)
    at = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], at) if len(at) else counts
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    ends = np.cumsum(sizes)
    return [x[at] for x in limbs], total, [place[e - s : e] for s, e in zip(sizes, ends, strict=True)]
