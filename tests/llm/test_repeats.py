"""Removal of repeated byte strings and word windows, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tenantry.llm import fm_dedup, repeats, suffix_dedup

SMALL = {"chunk_bytes": 60_000, "shard_bytes": 40_000}


def covered(size: int, places, length: int) -> np.ndarray:
    gone = np.zeros(size, bool)
    for p in places:
        gone[p : p + length] = True
    return gone


def expected_strings(rows, length=50):
    first: dict[bytes, int] = {}
    for i, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = covered(len(raw), [p for p in range(len(raw) - length + 1) if first[raw[p : p + length]] < i], length)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((i, len(raw), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def expected_windows(rows, length=35):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in rows]
    seen = Counter(tuple(w[p : p + length]) for _, w in split for p in range(len(w) - length + 1))
    out = []
    for i, w in split:
        gone = covered(len(w), [p for p in range(len(w) - length + 1) if seen[tuple(w[p : p + length])] > 1], length)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("sizes", [SMALL, {}])
def test_strings(documents, sample, rows, sizes):
    got = rows(suffix_dedup.remove_repeated_strings(documents(sample), outputs=False, **sizes), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == expected_strings(sample)


@pytest.mark.parametrize("sizes", [SMALL, {}])
def test_windows(documents, sample, rows, sizes):
    got = rows(fm_dedup.remove_repeated_windows(documents(sample), outputs=False, **sizes), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == expected_windows(sample)


def test_nothing_to_do(documents, rows):
    empty = documents([])
    assert rows(suffix_dedup.remove_repeated_strings(empty)) == []
    assert rows(fm_dedup.remove_repeated_windows(empty)) == []
    few = documents([(1, None), (2, ""), (3, "a b c")])
    assert rows(suffix_dedup.remove_repeated_strings(few), "doc_id", "n_removed", "kept") == [(1, 0, ""), (2, 0, ""), (3, 0, "a b c")]
    assert rows(fm_dedup.remove_repeated_windows(few), "doc_id", "n_words", "kept") == [(1, 0, ""), (2, 0, ""), (3, 3, "a b c")]


def test_outputs_and_carried_columns(documents, rows):
    passage = "".join(random.Random(1).choices("abcdefgh ", k=80))
    docs = documents([(1, "one " + passage), (2, passage + " two"), (3, passage)])
    got = rows(suffix_dedup.remove_repeated_strings(docs, carry=("lang",)), "doc_id", "kept", "spans", "lang")
    assert got == [(1, "one " + passage, [], "en"), (2, " two", [(0, 80)], "en"), (3, "", [(0, 80)], "en")]
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    assert rows(left, "doc_id", "text", "n_chars") == [(1, "one " + passage, 84), (2, " two", 4)]


def test_cut_character_is_dropped(documents, rows):
    shared = "é" * 30
    got = rows(suffix_dedup.remove_repeated_strings(documents([(1, "a" + shared), (2, "b" + shared)])), "doc_id", "kept", "n_removed")
    assert got == [(1, "a" + shared, 0), (2, "b", 60)]


@pytest.mark.parametrize("seed", range(40))
def test_two_stage_order(seed):
    rng = random.Random(seed)
    text = bytes(rng.choices(rng.choice([b"a", b"ab", b"abc", b"abcdefgh"]), k=rng.randint(1, 300)))
    padded = np.frombuffer(text + bytes([suffix_dedup.END]) + bytes(400), np.uint8)
    wanted = np.zeros(len(padded), bool)
    wanted[: len(text)] = True
    order = suffix_dedup.two_stage_order(padded, wanted, 320)
    raw = padded.tobytes()
    assert sorted(order.tolist()) == list(range(len(text)))
    assert [raw[i : i + 320] for i in order] == sorted(raw[i : i + 320] for i in range(len(text)))
    for a, b, n in zip(order, order[1:], suffix_dedup.common_prefixes(padded, order, 30), strict=False):
        assert n == next((k for k in range(30) if raw[a + k] != raw[b + k]), 30)


@pytest.mark.parametrize("seed", range(40))
def test_backward_search(seed):
    rng = random.Random(seed)
    words = rng.choice(["a", "a b", "a b c", "ab c d ef g"]).split()
    segments = list({" ".join(rng.choices(words, k=rng.randint(12, 120))).encode(): 0 for _ in range(rng.randint(1, 6))})
    seen = Counter(tuple(w[p : p + 12]) for s in segments for w in [s.split()] for p in range(len(w) - 11))
    expected = [seen[tuple(w[p : p + 12])] > 1 for s in segments for w in [s.split()] for p in range(len(w) - 11)]
    counts, verdicts = fm_dedup.WordWindows(12).judged(segments, np.ones(len(segments), np.int64))
    assert verdicts.tolist() == expected and int(counts.sum()) == len(expected)


def test_index_counts_patterns():
    rng = random.Random(3)
    text = np.asarray([rng.randint(1, 5) for _ in range(400)] + [0])
    index = fm_dedup.FMIndex(text)
    for _ in range(50):
        pattern = [rng.randint(1, 5) for _ in range(rng.randint(1, 4))]
        low, high = np.asarray([index.before[pattern[-1]]]), np.asarray([index.before[pattern[-1] + 1]])
        for symbol in reversed(pattern[:-1]):
            low, high = index.extended(np.asarray([symbol]), low, high)
        found = sum(text[i : i + len(pattern)].tolist() == pattern for i in range(len(text)))
        assert max(0, int(high[0] - low[0])) == found


def test_sliding():
    values = np.asarray([3, 1, 4, 1, 5, 9, 2, 6], np.uint64)
    for width in range(1, 9):
        assert repeats.sliding(np.minimum, values, width).tolist() == [min(values[i : i + width]) for i in range(9 - width)]


def test_null_ids(documents):
    line = "one line of more than fifty bytes that three of the documents have"
    got = Counter(tuple(r) for r in suffix_dedup.remove_repeated_strings(documents([(None, line), (None, line), (4, line), (5, "other")]), outputs=False).select("doc_id", "n_bytes", "n_removed").collect())
    size = len(line)
    assert got == Counter([(None, size, 0), (None, size, 0), (4, size, size), (5, 5, 0)])
    words = " ".join(f"w{i}" for i in range(40))
    got = Counter(tuple(r) for r in fm_dedup.remove_repeated_windows(documents([(None, words), (3, words)]), outputs=False).select("doc_id", "n_words", "n_removed").collect())
    assert got == Counter([(None, 40, 40), (3, 40, 40)])
