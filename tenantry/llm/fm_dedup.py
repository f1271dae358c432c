"""Removal of repeated word windows by FM-indexes.

A word goes if it is covered by a window of ``length`` words whose word sequence
also starts anywhere else, in the same document too.  Windows are judged on the
input.  ``repeats`` brings windows that could be equal into shards.  Each shard
keeps its different segments in an FM-index: the Burrows-Wheeler transform of
their word numbers in a bit-packed wavelet matrix.  Segments are then streamed
through it: a backward search from a window's last word counts how often what
has been read so far occurs.  Its matching statistic, the longest end of the
window that occurs twice, either spans the window, which is reported, or tells
how many of the following windows cannot occur twice either.

A null text has no words.  Texts shorter than a window lose nothing.  Repeated
rows are further places of the same windows.  An empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tenantry.llm import repeats
from tenantry.llm.common import ramps
from tenantry.llm.repeats import Chunk, Runs
from tenantry.llm.word_hashes import BASE, Words, mixed

LENGTH = 35
#: Words of the grams that keys are made of.
GRAM = 10
#: Windows of a segment that one reader goes through.
PART = 32


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes of a number sequence in order, by doubling what is compared."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    padded = np.concatenate([text, [0, 0]]).astype(np.int64)
    known = 3 if 3 * bits <= 62 else 1
    key = (padded[:-2] << 2 * bits | padded[1:-1] << bits | padded[2:]) if known == 3 else padded[:-2]
    while True:
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(True, sorted_[1:] != sorted_[:-1]))
        if rank[order[-1]] == n:
            return order
        after = np.zeros(n, np.int64)
        after[: n - known] = rank[known:]
        key = rank * (n + 1) + after
        known *= 2


class FMIndex:
    """Counts of patterns in a sequence of numbers from 0 on; 0 ends a segment and is no pattern."""

    def __init__(self, text: np.ndarray):
        self.text = text
        order = suffix_order(text)
        sequence = text[order - 1]
        symbols = int(text.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.levels = max(1, (symbols - 1).bit_length())
        self.bits, self.ranks, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            one = ((sequence >> level) & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.frombuffer(packed.tobytes() + bytes(16 - len(packed) % 8), np.uint64)
            self.bits.append(words)
            self.ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(len(one) - int(one.sum()))
            sequence = np.concatenate([sequence[~one], sequence[one]])
        self.origin = np.zeros(symbols, np.int64)
        self.origin = self.walked(np.arange(symbols), np.zeros(symbols, np.int64))

    def walked(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Down the wavelet matrix: how many of each symbol stand before a place, and a constant of the symbol."""
        for depth in range(self.levels):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            below = self.bits[depth][word] & ((np.uint64(1) << bit) - np.uint64(1))
            ones = self.ranks[depth][word] + np.bitwise_count(below)
            up = (symbols >> (self.levels - 1 - depth)) & 1 == 1
            at = np.where(up, self.zeros[depth] + ones, at - ones)
        return at

    def extended(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one more symbol before them."""
        both = self.walked(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        base = self.before[symbols] - self.origin[symbols]
        return base + both[: len(symbols)], base + both[len(symbols) :]

    def repeated_windows(self, starts: np.ndarray, lengths: np.ndarray, window: int) -> np.ndarray:
        """For segments of the text, the places of their windows that occur twice or more; all are read side by side."""
        found = []
        end = np.full(len(starts), window - 1)
        active = np.arange(len(starts))
        while len(active):
            live = active
            symbols = self.text[starts[live] + end[live]]
            low, high = self.before[symbols], self.before[symbols + 1]
            following = np.empty(len(starts), np.int64)
            for step in range(window):
                if step:
                    low, high = self.extended(self.text[starts[live] + end[live] - step], low, high)
                twice = high - low > 1
                # what was read occurs once, and so does every window around it
                following[live[~twice]] = end[live[~twice]] - step + window
                live, low, high = live[twice], low[twice], high[twice]
                if not len(live):
                    break
            found.append(starts[live] + end[live] - window + 1)
            following[live] = end[live] + 1
            end[active] = following[active]
            active = active[end[active] < lengths[active]]
        return np.concatenate(found) if found else np.empty(0, np.int64)


class WordWindows:
    """Windows of a fixed number of words that occur more than once anywhere."""

    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept string, kept_sha256 string"

    def __init__(self, length: int = LENGTH, outputs: bool = True):
        if length < GRAM:
            raise ValueError(f"windows must have at least {GRAM} words")
        self.length, self.outputs = length, outputs

    def words(self, chunk: Chunk) -> Words:
        if not hasattr(chunk, "words"):
            chunk.words = Words(chunk.raw, chunk.starts, chunk.ends)
        return chunk.words

    def windows(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hash of the gram from each word on, the key of the window from there, and whether it ends in its document."""
        words = self.words(chunk)
        hashes = words.hashes
        if len(hashes) < self.length:
            return (np.empty(0, np.uint64),) * 2 + (np.empty(0, bool),)
        grams = np.zeros(len(hashes) - GRAM + 1, np.uint64)
        for i in range(GRAM):
            grams = grams * BASE + hashes[i : i + len(grams)]
        grams = mixed(grams)
        keys = repeats.sliding(np.minimum, grams, self.length - GRAM + 1)
        edges = np.zeros(len(hashes) + 1, np.int32)
        np.add.at(edges, np.maximum(words.first, words.last - self.length + 1), 1)
        np.add.at(edges, words.last, -1)
        return grams, keys, np.cumsum(edges)[: len(keys)] == 0

    def runs(self, chunk: Chunk) -> Runs:
        _, keys, valid = self.windows(chunk)
        words = self.words(chunk)
        first, last = repeats.runs_of(keys, valid, words.first)
        keys = repeats.spread(keys[first])
        return Runs(keys, np.searchsorted(words.last, first, side="right"), first, last)

    def keys(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        grams, keys, valid = self.windows(chunk)
        if not valid.any():
            return np.empty(0, np.uint64), np.empty(0, bool)
        # grams that are the least of a window: two of them with one key may be two places of one window
        width = self.length - GRAM + 1
        around = np.zeros(len(keys) + 2 * (width - 1), np.uint64)
        around[width - 1 : width - 1 + len(keys)] = np.where(valid, keys, 0)
        least = repeats.spread(grams[grams == repeats.sliding(np.maximum, around, width)]) & ~np.uint64(1)
        least.sort()
        return repeats.different(least, np.append(False, least[1:] == least[:-1])[: len(least)])

    def segment(self, chunk: Chunk, first: int, last: int) -> bytes:
        words = self.words(chunk)
        return b" ".join(chunk.raw[words.starts[first] : words.ends[last + self.length - 2]].split())

    def value(self, chunk: Chunk, doc: int) -> int:
        return 1

    def merged(self, a: int, b: int) -> int:
        return a + b

    def judged(self, segments: list[bytes], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the words of each window occur twice; a segment that occurs twice needs no search."""
        coded = pc.split_pattern(pa.array(segments, pa.large_binary()), b" ")
        sizes = np.diff(coded.offsets.to_numpy()).astype(np.int64)
        numbers = coded.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(int((sizes + 1).sum()), np.int64)
        text[np.repeat(starts, sizes) + ramps(sizes)] = numbers + 1
        counts = sizes - self.length + 1
        verdicts = np.repeat(values > 1, counts)
        once = np.flatnonzero(values == 1)
        if len(once):
            # long segments are read in parts, so that all are done at about the same time
            parts = -(-counts[once] // PART)
            shift = ramps(parts) * PART
            sizes_of = np.minimum(np.repeat(sizes[once], parts) - shift, PART + self.length - 1)
            twice = FMIndex(text).repeated_windows(np.repeat(starts[once], parts) + shift, sizes_of, self.length)
            owner = np.searchsorted(starts, twice, side="right") - 1
            verdicts[(np.cumsum(counts) - counts)[owner] + twice - starts[owner]] = True
        return counts, verdicts

    def flagged(self, judged: np.ndarray, own: np.ndarray) -> np.ndarray:
        return judged

    def result(self, chunk: Chunk, runs: Runs, mine: np.ndarray, which: np.ndarray, values: np.ndarray, begins: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
        words = self.words(chunk)
        windows, place, _ = repeats.windows_of(runs, mine, which, begins)
        covered = repeats.covered(len(words.starts), windows[flags[place]], self.length)
        rows = []
        for doc, text, a, b in zip(chunk.ids.tolist(), chunk.documents(), words.first.tolist(), words.last.tolist(), strict=True):
            gone = covered[a:b]
            kept = text.split()
            if gone.any():
                kept = [kept[i] for i in np.flatnonzero(~gone).tolist()]
            joined = b" ".join(kept)
            more = (repeats.spans_of(gone), joined.decode()) if self.outputs else (None, None)
            rows.append((doc, b - a, b - a - len(kept), *more, hashlib.sha256(joined).hexdigest()))
        kinds = [pa.int64()] * 3 + [repeats.SPANS, pa.string(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        names = ["doc_id", "n_words", "n_removed", "spans", "kept", "kept_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def remove_repeated_windows(docs: DataFrame, length: int = LENGTH, outputs: bool = True, carry: tuple[str, ...] = (), **sizes: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, on request the ``spans`` of words that went and the ``kept`` text, and the columns ``carry`` of ``docs``."""
    return repeats.remove_repeats(docs, WordWindows(length, outputs), carry, **sizes)
