"""Hashed character n-grams of whole texts, as numpy arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class CharacterGrams:
    """Slots in [0, 2 ** bits) of a text's lower-case n-grams, each slot once.

    White space counts as one space and the text stands between two spaces, so
    words at its ends look like words elsewhere. Long texts are hashed in
    windows; what is kept per text is bounded by the number of slots.
    """

    WINDOW = 1 << 18

    def __init__(self, sizes: Sequence[int], bits: int) -> None:
        self.sizes, self.bits = sorted(sizes), bits
        self.seen_at = np.zeros(1 << bits, np.int32)

    def slots(self, text: str | None) -> np.ndarray:
        codes = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le", "replace"), "<u4")
        if len(codes) <= self.WINDOW:
            return self._distinct(self._hashed(codes))
        step = self.WINDOW - self.sizes[-1] + 1
        parts = [self._distinct(self._hashed(codes[a : a + self.WINDOW])) for a in range(0, len(codes), step)]
        return np.unique(np.concatenate(parts))

    def _hashed(self, codes: np.ndarray) -> np.ndarray:
        codes = codes.astype(np.uint64)
        found, value = [], codes
        for n in range(2, self.sizes[-1] + 1):
            if len(codes) < n:
                break
            value = value[:-1] * _STEP + codes[n - 1 :]
            if n in self.sizes:
                mixed = (value ^ (value >> np.uint64(29))) * _MIX
                found.append((mixed >> np.uint64(64 - self.bits)).astype(np.int64))
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def _distinct(self, slots: np.ndarray) -> np.ndarray:
        """Each slot at the place where it occurs last."""
        places = np.arange(len(slots), dtype=np.int32)  # of one window, so they fit
        self.seen_at[slots] = places
        return slots[self.seen_at[slots] == places]
