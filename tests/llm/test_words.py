"""Languages against held-out labels, and spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tenantry.llm import language, queries, spelling

# 12: language


def test_held_out_languages(spark, folder):
    got = {r.doc_id: r for r in queries.QUERIES["op12_word_first_backoff"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert set(got) == {d.doc_id for d in docs}
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r.held_out} == {d.doc_id for d in held}
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3).selectExpr("*", "1 AS score", "'x' AS kind", "2 AS h", "3 AS turn")


def learnable(count):
    return [i for i in range(3 * count + 9) if zlib.crc32(str(i).encode()) % 3 != 1][:count]


def test_edges_of_languages(spark):
    ids = learnable(6)
    rows = [(ids[0], "en", "the cat and the dog"), (ids[1], "en", "The bird"), (ids[2], "fr", "le chat et le chien"), (ids[3], None, "le zzz"), (ids[4], "fr", None), (ids[5], "fr", "12 !?")]
    more = [(None, None, "the thes"), (None, "en", "the thes"), (10**6, "fr", ""), (10**6 + 1, None, None), (10**6 + 2, "fr", "chats " * 50_000), (10**6 + 3, "en", "ж"), (10**6 + 3, "en", "ж")]
    got = sorted(((-1 if r.doc_id is None else r.doc_id, r.lang_pred, r.held_out) for r in language.identify(labelled(spark, rows + more)).collect()), key=str)
    expected = {ids[0]: "en", ids[1]: "en", ids[2]: "fr", ids[3]: "fr", ids[4]: "und", ids[5]: "und", -1: "en", 10**6: "und", 10**6 + 1: "und", 10**6 + 2: "fr"}
    assert [(i, lang) for i, lang, _ in got if i in expected and lang != expected[i]] == [] and len(got) == 13
    assert len({lang for i, lang, _ in got if i == 10**6 + 3}) == 1
    assert language.identify(labelled(spark, [])).collect() == []
    alone = language.identify(labelled(spark, [(ids[0], None, "word"), (ids[1], None, "")])).collect()
    assert {(r.lang_pred, r.score) for r in alone} == {("und", 0.0)}


def test_words_first_then_longer_grams():
    entries = [pa.array(["cat"]), pa.array(["c", "q"]), pa.array(["_c", "ca"])]
    logs = [np.log([[0.9, 0.1]]), np.log([[0.5, 0.5], [0.1, 0.9]]), np.log([[0.2, 0.8], [0.4, 0.6]])]
    model = language.Model(["a", "b"], entries, logs)
    scores, known = model.word_scores(pa.array(["cat", "cab", "qx", "zz"]))
    assert known.tolist() == [True, True, True, False]
    assert scores[0] == pytest.approx(logs[0][0]) and scores[1] == pytest.approx((logs[2][0] + logs[2][1]) / 2)
    assert scores[2] == pytest.approx(logs[1][1]) and scores[3] == pytest.approx([0, 0])
    assert model.predict(pa.array(["cat zz", "qx", None, "--"]))[0] == ["a", "b", "und", "und"]


def test_sample_is_bounded_and_even(spark):
    docs = labelled(spark, [(i, "en" if i % 10 else "fr", "same text") for i in range(3000)])
    assert {r.lang: r["count"] for r in language.chosen(docs, 100).groupBy("lang").count().collect()} == {"en": 50, "fr": 50}


# 13: spelling variants


def one_off(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def expected_variants(n):
    """By words that agree after a deletion at most."""
    by = defaultdict(set)
    for w in n:
        for v in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            by[v].add(w)
    near = {w: {x for v in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))} for x in by[v] if x != w and one_off(w, x)} for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: f for w, f in best.items() if n[f] >= 10 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root(w)) for w in n)


def variants(docs):
    return sorted(tuple(r) for r in spelling.variants(docs).select("word", "n", "n_near", "form", "form_n", "root").collect())


def test_variants_of_a_table(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op13_search_schemes"](spark, folder).select("word", "n", "n_near", "form", "form_n", "root").collect())
    assert got == expected_variants(counted(docs))


def test_edges_and_chains_of_forms(documents):
    chain = "recieve " * 3 + "receive " * 40 + "receives " * 500 + "ÀÉÎõüñß ÀÉÎõüñß àÉÎõüñß " * 2 + "aaaaaaa aaaaaaaa " * 30
    rows = [(1, chain), (2, None), (3, ""), (None, "Receive RECEIVE short"), (5, "x" * 100_000), (6, "x" * 100_000), (1, chain), (7, "x" * 99_999 + " " + "x" * 99_999)]
    assert variants(documents(rows)) == expected_variants(counted(rows))
    assert variants(documents([])) == []


def test_divided_groups_find_the_same(spark):
    rng = random.Random(5)
    words = {"prefix" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) + "suffix" for _ in range(400)}
    n = {w: rng.randint(2, 50) for w in words}
    table = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.n_near, r.near, r.near_n) for r in spelling.near_words(table, group_rows=40, shard_rows=300).collect()}
    near = {w: [x for x in n if x != w and one_off(w, x)] for w in n}
    best = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in near.items() if xs}
    assert got == {w: (len(near[w]), b, n[b]) for w, b in best.items()}


@pytest.mark.parametrize("letters, low, high", [("ab", 2, 6), ("abé", 2, 7)])
def test_index(letters, low, high):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(120)})
    index, every = spelling.Index(words), np.arange(len(words))
    half, whole = index.lengths // 2, index.lengths
    found = [p for exact, right in ((half, True), (whole - half, False)) for p in zip(*(x.tolist() for x in index.near(every, exact, whole, right)), strict=True)]
    assert sorted(found) == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if a != b and one_off(a, b)]
