"""Near-duplicate classes against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tenantry.llm import near_dedup
from tenantry.llm.components import connected


def probability_jaccard(a: Counter, b: Counter) -> float:
    keys = set(a) | set(b)
    if set(a.values()) == {1} == set(b.values()):
        return len(set(a) & set(b)) / len(keys)
    return sum(1 / sum(max(a[k] / a[i], b[k] / b[i]) for k in keys) for i in set(a) & set(b))


def expected_classes(rows, least=0.8):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().split()
        sets[i] = Counter(tuple(words[p : p + 5]) for p in range(max(1, len(words) - 4))) if words else Counter()
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for k in s:
            where[k].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for k in s for j in where[k] if j < i).items():
            if n >= 0.4 * min(len(s), len(sets[j])) and probability_jaccard(s, sets[j]) >= least:
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    wordless = [i for i in sets if not sets[i]]
    return {i: min(wordless) if i in wordless else find(i) for i in sets}


def test_classes(documents, sample):
    sample = sample[:150] + sample[-8:]
    got = {r.doc_id: r.class_id for r in near_dedup.classes(documents(sample)).collect()}
    assert got == expected_classes(sample)


def test_many_near_copies_of_one_text(documents):
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 260):  # more than two blocks, most pairs below the limit
        own = base[:]
        for _ in range(rng.randint(0, 8)):
            own[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: r.class_id for r in near_dedup.classes(documents(rows)).collect()}
    assert got == expected_classes(rows)


def test_no_and_equal_rows(documents, rows):
    assert rows(near_dedup.classes(documents([]))) == []
    docs = documents([(5, None), (3, ""), (4, " \n"), (2, "a b"), (9, "a  b"), (7, "a c"), (2, "a b")])
    assert rows(near_dedup.classes(docs)) == [(2, 2), (3, 3), (4, 3), (5, 3), (7, 7), (9, 2)]
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == [(2,), (3,), (7,)]


@pytest.mark.parametrize("seed", range(30))
def test_similarity_and_its_bound(seed):
    rng = random.Random(seed)
    a, b = (Counter(rng.choices(range(1, 12), k=rng.randint(1, 20))) for _ in range(2))
    as_arrays = [(np.asarray(sorted(c), np.uint64), np.asarray([c[k] for k in sorted(c)])) for c in (a, b)]
    value = near_dedup.similarity(*as_arrays)
    assert value == pytest.approx(probability_jaccard(a, b))
    if value > 0:
        assert near_dedup.possible_pairs(as_arrays, value) == [(0, 1)]


def test_registers_estimate_the_similarity():
    rng = random.Random(2)
    words = [f"w{rng.randrange(200)}" for _ in range(500)]
    other = [w if rng.random() > 0.02 else "x" for w in words] + words[:100]
    shingles = near_dedup.Shingles([" ".join(words).encode(), " ".join(other).encode()])
    first = near_dedup.registers(shingles, 2, 5000)
    assert (first[0] == first[1]).mean() == pytest.approx(near_dedup.similarity(shingles.of(0), shingles.of(1)), abs=0.03)


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(5, 1), (5, 9), (9, 3), (7, 7), (1, 5)] + [(200, i) for i in range(201, 240)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 131)} | {1: 1, 5: 1, 9: 1, 3: 1} | {i: 200 for i in range(200, 240)}


def test_null_and_repeated_ids(documents, rows):
    docs = documents([(None, "a b"), (None, "c d"), (None, "c d"), (1, "e f"), (1, "g h"), (2, "g  h"), (3, "a b")])
    assert rows(near_dedup.classes(docs)) == rows(near_dedup.classes(docs).distinct())
    got = Counter(tuple(r) for r in near_dedup.classes(docs).collect())
    assert got == Counter([(None, None), (None, 3), (1, 1), (2, 1), (3, 3)])
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(None, "c d"), (1, "e f"), (1, "g h"), (3, "a b")])


def test_columns_of_names_used_inside(documents):
    docs = documents([(1, "a b"), (2, "a b")]).selectExpr("*", "3 AS kept_id", "4 AS row_of_id", "5 AS same", "6 AS doc", "7 AS first")
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns and [tuple(r)[-5:] for r in kept.collect()] == [(3, 4, 5, 6, 7)]


def test_second_round_is_linear_in_the_largest_class(spark):
    rows = [("k", i, 1) for i in range(2000)] + [("k", 5000 + i, 2 + i % 3) for i in range(20)] + [("l", 1, 1), ("l", 2, 1)]
    placed = near_dedup._across(spark.createDataFrame(rows, "key string, doc long, class long"), block=100).collect()
    groups = defaultdict(list)
    for r in placed:
        groups[r.grp].append((r.doc, r["class"]))
    met = {(a, b) for g in groups.values() for a, x in g for b, y in g if x != y}
    docs = {d: c for k, d, c in rows if k == "k"}
    assert met == {(a, b) for a in docs for b in docs if docs[a] != docs[b]}
    assert len(placed) < 2000 + 20 * 22 + 1
