"""Words of many texts at once, as numbers."""

from __future__ import annotations

import numpy as np

from tenantry.llm.common import WHITE, ramps

_WHITE = np.zeros(256, bool)
_WHITE[list(WHITE.encode())] = True
#: An odd multiplier of polynomial hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


class Words:
    """Where the words of texts that lie one after the other begin and end, and a hash of each."""

    def __init__(self, raw: bytes, text_starts: np.ndarray, text_ends: np.ndarray):
        text = np.frombuffer(raw, np.uint8)
        dark = ~_WHITE[text]
        edge = np.zeros(len(text) + 1, bool)
        edge[text_starts] = True
        edge[-1] = True
        open_ = dark.copy()
        open_[1:] &= ~dark[:-1] | edge[1:-1]
        close = dark.copy()
        close[:-1] &= ~dark[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(open_), np.flatnonzero(close) + 1
        lengths = self.ends - self.starts
        self.first = np.searchsorted(self.starts, text_starts)  # of each text
        self.last = np.searchsorted(self.starts, text_ends)
        if not len(lengths):
            self.hashes = np.empty(0, np.uint64)
            return
        powers = np.cumprod(np.full(int(lengths.max()), BASE))
        values = (text[dark].astype(np.uint64) + np.uint64(1)) * powers[ramps(lengths)]
        self.hashes = mixed(np.add.reduceat(values, np.cumsum(lengths) - lengths))
