"""Exact removal of repeated byte strings by suffix arrays.

A byte goes if it is covered by a string of ``length`` bytes that also starts in
a document with a smaller id.  Strings are judged on the input, overlaps count
and matches never cross documents.  ``repeats`` brings the strings that could be
equal into shards; each shard sorts its suffixes in two stages:

1. suffixes smaller than their successors are sorted directly;
2. every other suffix is placed by one scan over the buckets of first bytes, from
   the least one up: when a suffix is reached, its predecessor takes the next
   free place of its own bucket.

Common prefixes of neighbours in that order then show which strings are equal,
and the least document id of each group decides.

A null text is empty.  Texts shorter than ``length`` lose nothing.  Rows with the
same id count as one document: they never remove each other's text.  An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantry.llm import repeats
from tenantry.llm.common import WHITE
from tenantry.llm.repeats import Chunk, Runs

LENGTH = 50
#: Bytes of the grams that keys are made of.
GRAM = 16
#: Bytes that are hashed at once, so that they stay in the cache.
BLOCK = 1 << 18
#: Ends a segment in a shard's text; no UTF-8 text has it.
END = 255


def words_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that compares like them; ``text`` must go on for as long."""
    return np.ndarray(len(text) - 7, np.uint64, text, strides=1)[at].byteswap()


def gram_hashes(text: np.ndarray, count: int) -> np.ndarray:
    """A hash of the 16 bytes from each of the first ``count`` places on."""
    words = np.lib.stride_tricks.as_strided(text, (count + 8, 8), (1, 1)).copy().view(np.uint64).ravel()
    mixed = (words[:count] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[8 : count + 8] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one is not."""
    change = np.flatnonzero(text[1:] != text[:-1])
    up = np.zeros(len(text), bool)
    if len(change):
        lengths = np.diff(np.append(-1, change))
        up[: change[-1] + 1] = np.repeat(text[change + 1] > text[change], lengths)
    return up


def sort_directly(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of their suffixes' first ``depth`` bytes or a few more; ``text`` must go on for as long."""
    key = words_at(text, places)
    order = np.argsort(key)
    places, key = places[order], key[order]
    group = np.cumsum(np.append(True, key[1:] != key[:-1])) if len(key) else key
    done = 8
    while done < depth and len(places):
        tied = np.zeros(len(places), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        open_ = np.flatnonzero(tied)
        if not len(open_):
            break
        key = words_at(text, places[open_] + done)
        order = np.lexsort((key, group[open_]))
        places[open_] = places[open_[order]]
        new = key[order]
        parts = np.zeros(len(places), bool)
        parts[open_[1:]] = new[1:] != new[:-1]
        parts[1:] |= group[1:] != group[:-1]
        group = np.cumsum(parts)
        done += 8
    return places


def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Places marked in ``wanted`` in the order of their suffixes, to at least ``depth`` bytes.

    A wanted place that is not smaller than its successor needs that successor to be wanted too.
    ``text`` must go on for ``depth`` bytes after the last of them.
    """
    up = smaller_than_next(text)
    direct = sort_directly(text, np.flatnonzero(wanted & up), depth)
    induced = wanted & ~up
    heads = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def place_before(scanned: np.ndarray) -> None:
        before = scanned[scanned > 0] - 1
        before = before[induced[before]]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cuts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(first)], strict=True):
                waiting[first[a]].append(before[a:b])

    for byte in range(256):
        queue, at = waiting[byte], 0
        while at < len(queue):  # the bucket grows while it is scanned
            out.append(queue[at])
            place_before(queue[at])
            at += 1
        own = direct[heads[byte] : heads[byte + 1]]
        if len(own):
            out.append(own)
            place_before(own)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """For each place but the first: the bytes it has in common with the one before, counted up to ``cap``."""
    common = np.zeros(max(0, len(order) - 1), np.int64)
    open_ = np.arange(len(common))
    done = 0
    while len(open_) and done < cap:
        differ = words_at(text, order[open_] + done) ^ words_at(text, order[open_ + 1] + done)
        same = differ == 0
        rest = differ[~same]
        equal = np.zeros(len(rest), np.int64)
        for byte in range(1, 8):
            equal += rest < np.uint64(1) << np.uint64(64 - 8 * byte)
        common[open_[~same]] = done + equal
        done += 8
        common[open_[same]] = done
        open_ = open_[same]
    return np.minimum(common, cap)


class ByteStrings:
    """Byte strings of a fixed length; those of smaller documents win."""

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>, kept string, kept_sha256 string"

    def __init__(self, length: int = LENGTH, outputs: bool = True):
        if length < 2 * GRAM:
            raise ValueError(f"strings must have at least {2 * GRAM} bytes")
        self.length, self.outputs = length, outputs

    def windows(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The key of the string from each byte on, and whether the string ends inside its document."""
        count = max(0, len(chunk.raw) - self.length + 1)
        text = np.frombuffer(chunk.raw + bytes(GRAM + 8), np.uint8)
        width = self.length - GRAM + 1
        keys = np.empty(count, np.uint64)
        for a in range(0, count, BLOCK):
            b = min(count, a + BLOCK)
            keys[a:b] = repeats.sliding(np.minimum, gram_hashes(text[a:], b - a + width - 1), width)
        keys = repeats.spread(keys)
        edges = np.zeros(len(chunk.raw) + 1, np.int32)
        np.add.at(edges, np.maximum(chunk.starts, chunk.ends - self.length + 1), 1)
        np.add.at(edges, chunk.ends, -1)
        return keys, np.cumsum(edges, dtype=np.int32)[:count] == 0

    def runs(self, chunk: Chunk) -> Runs:
        keys, valid = self.windows(chunk)
        first, last = repeats.runs_of(keys, valid, chunk.starts)
        return Runs(keys[first], np.searchsorted(chunk.ends, first, side="right"), first, last)

    def keys(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        runs = self.runs(chunk)
        bare = runs.keys & ~np.uint64(1)
        order = np.lexsort((chunk.ids[runs.docs], bare))
        bare, ids = bare[order], chunk.ids[runs.docs][order]
        return repeats.different(bare, np.append(False, (bare[1:] == bare[:-1]) & (ids[1:] != ids[:-1]))[: len(bare)])

    def segment(self, chunk: Chunk, first: int, last: int) -> bytes:
        return chunk.raw[first : last + self.length - 1]

    def value(self, chunk: Chunk, doc: int) -> int:
        return int(chunk.ids[doc])

    def merged(self, a: int, b: int) -> int:
        return min(a, b)

    def judged(self, segments: list[bytes], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least document id that has the string of each window."""
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        counts = sizes - self.length + 1
        mark = bytes([END])
        text = np.frombuffer(mark.join([*segments, bytes(self.length + 64)]), np.uint8)
        starts = np.cumsum(sizes + 1) - sizes - 1
        # windows, and what follows them up to the next place whose suffix is smaller than its successor
        up = np.flatnonzero(smaller_than_next(text))
        stops = up[np.searchsorted(up, starts + counts - 1)] + 1
        edges = np.zeros(len(text) + 1, np.int32)
        np.add.at(edges, starts, 1)
        np.add.at(edges, stops, -1)
        order = two_stage_order(text, np.cumsum(edges, dtype=np.int32)[:-1] > 0, self.length)
        owner = np.searchsorted(starts, order, side="right") - 1
        whole = order < starts[owner] + counts[owner]
        order, owner = order[whole], owner[whole]
        heads = np.flatnonzero(np.append(True, common_prefixes(text, order, self.length) < self.length))
        least = np.minimum.reduceat(values[owner], heads)
        verdicts = np.empty(int(counts.sum()), np.int64)
        verdicts[(np.cumsum(counts) - counts)[owner] + order - starts[owner]] = np.repeat(least, np.diff(np.append(heads, len(order))))
        return counts, verdicts

    def flagged(self, judged: np.ndarray, own: np.ndarray) -> np.ndarray:
        return judged < own

    def result(self, chunk: Chunk, runs: Runs, mine: np.ndarray, which: np.ndarray, values: np.ndarray, begins: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
        windows, place, run = repeats.windows_of(runs, mine, which, begins)
        # a segment's flags are those of its least document here; others have it from that one
        later = chunk.ids[runs.docs[mine]] > values[which] if len(mine) else np.empty(0, bool)
        covered = repeats.covered(len(chunk.raw), windows[flags[place] | later[run]], self.length)
        rows = []
        bytes_ = np.frombuffer(chunk.raw, np.uint8)
        for doc, a, b in zip(chunk.ids.tolist(), chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
            gone = covered[a:b]
            spans, kept = (repeats.spans_of(gone), bytes_[a:b][~gone].tobytes()) if gone.any() else ([], chunk.raw[a:b])
            more = (spans, kept.decode("utf-8", "ignore")) if self.outputs else (None, None)
            rows.append((doc, b - a, b - a - len(kept), len(spans), *more, hashlib.sha256(kept).hexdigest()))
        kinds = [pa.int64()] * 4 + [repeats.SPANS, pa.string(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def remove_repeated_strings(docs: DataFrame, length: int = LENGTH, outputs: bool = True, carry: tuple[str, ...] = (), **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, on request ``spans`` and the ``kept`` text, and the columns ``carry`` of ``docs``.

    Where a removal cuts through a character, ``kept`` has nothing of it; the digest is of all bytes that stay.
    """
    return repeats.remove_repeats(docs, ByteStrings(length, outputs), carry, **sizes)


def without_repeats(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """``docs`` with what is left of each text, in the same columns.

    ``n_chars`` becomes the number of its characters.  A document that loses text and has no word left goes.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    left = remove_repeated_strings(docs, length, carry=others, **sizes)
    left = left.filter((F.col("n_removed") == 0) | (F.btrim("kept", F.lit(WHITE)) != ""))
    made = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return left.select(*[made.get(c, F.col(c)).alias(c) for c in docs.columns])
