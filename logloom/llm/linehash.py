"""A minimal perfect hash over 128-bit keys, in flat numpy arrays.

Cascade of bit arrays: in every level a key takes the bit of its hash if no
other key wants it, and goes on to the next level if one does.  The rank of a
key's bit among all set bits is its number, 0 to n - 1.  Keys left after the
last level are numbered by a short sorted list.
"""

from __future__ import annotations

import numpy as np

LEVELS, ROOM = 24, 2.0


def _mixed(low: np.ndarray, high: np.ndarray, level: int) -> np.ndarray:
    """A hash of both halves for one level (finalizer of splitmix64)."""
    x = low + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = x ^ (high * np.uint64(0xD6E8FEB86659FD93))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Built from distinct keys (two uint64 arrays); ``index`` numbers them."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        set_bits = np.unpackbits(bits)
        self.flags = set_bits
        self.ranks = np.cumsum(set_bits, dtype=np.int64) - set_bits
        self.taken = int(set_bits.sum())

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray) -> PerfectHash:
        sizes, parts = [], []
        for level in range(LEVELS):
            if not len(low):
                break
            size = max(8, int(len(low) * ROOM))
            at = _mixed(low, high, level) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            parts.append(alone)
            lost = ~alone[at.astype(np.int64)]
            low, high = low[lost], high[lost]
        bits = np.packbits(np.concatenate(parts)) if parts else np.zeros(0, np.uint8)
        rest = np.empty(len(low), dtype=[("low", "<u8"), ("high", "<u8")])
        rest["low"], rest["high"] = low, high
        return cls(np.array(sizes, dtype=np.int64), bits, np.sort(rest, order=["low", "high"]))

    def index(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Number of each key; keys that were not built in get any number, or -1."""
        out = np.full(len(low), -1, dtype=np.int64)
        open_ = np.arange(len(low))
        start = 0
        for level, size in enumerate(self.sizes):
            at = start + (_mixed(low[open_], high[open_], level) % np.uint64(size)).astype(np.int64)
            found = self.flags[at] == 1
            out[open_[found]] = self.ranks[at[found]]
            open_ = open_[~found]
            start += int(size)
        if len(self.rest) and len(open_):
            keys = np.empty(len(open_), dtype=self.rest.dtype)
            keys["low"], keys["high"] = low[open_], high[open_]
            at = np.searchsorted(self.rest, keys)
            there = at < len(self.rest)
            there[there] = self.rest[at[there]] == keys[there]
            out[open_[there]] = self.taken + at[there]
        return out

    def dump(self) -> dict[str, bytes]:
        return {"sizes": self.sizes.tobytes(), "bits": self.bits.tobytes(), "rest": self.rest.tobytes()}

    @classmethod
    def load(cls, sizes: bytes, bits: bytes, rest: bytes) -> PerfectHash:
        kind = [("low", "<u8"), ("high", "<u8")]
        return cls(np.frombuffer(sizes, np.int64), np.frombuffer(bits, np.uint8), np.frombuffer(rest, kind))
