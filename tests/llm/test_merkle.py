"""Manifest and proofs against a plain tree, and the query against its SQL."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from tenantry.llm import merkle, queries
from tests.oracle import compare, connect


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, n_chars):
    values = [row.doc_id, row.source, row.lang, n_chars, row.text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, at):
    """The root, and the siblings of one leaf from below."""
    way = []
    while len(nodes) > 1:
        way.append((at % 2, nodes[at ^ 1] if at ^ 1 < len(nodes) else None))
        nodes, at = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], at // 2
    return nodes[0], way


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.n_chars), r))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    for t in trees:
        trees[t].sort(key=lambda x: x[:3])
    subroots = [climb([x[2] for x in trees[t]], 0)[0] for t in order]
    out = []
    for k, t in enumerate(order):
        for i, (_, _, own, r) in enumerate(trees[t]):
            (subroot, low), (root, high) = climb([x[2] for x in trees[t]], i), climb(subroots, k)
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
            at = leaf(r, r.n_chars + 1) if hit else own
            for right, other in low + high:
                at = digest(at) if other is None else digest(other, at) if right else digest(at, other)
            out.append((r.doc_id, own, subroot, root, digest(*[s for _, s in low + high if s]), at, at == root))
    return sorted(out, key=str)


def proven(docs):
    made = merkle.verify(docs, merkle.tampered())
    return sorted((tuple(r) for r in made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


ROWS = [
    *[(i, "s", "en", 5, f"text {i}") for i in range(40)], (7, "s", "en", 5, "text 7"), (7, "s", "en", 9, "other"), (None, "s", "en", 1, "x"), (90, None, None, None, None),
    (91, "", "", 0, ""), (14, "é", "fr", 2, "éé"), (10**12, "s", "fr", 1, "z" * 100_000),
]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], [ROWS[0], ROWS[0]], []])
def test_verify(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3).selectExpr("*", "1 AS pos", "2 AS digest", "3 AS tree", "4 AS block")
    assert proven(docs) == expected(docs.collect())


def test_several_tiers_and_part_of_the_leaves(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "id AS n_chars", "string(id) AS text")
    made = merkle.build(docs)
    some = merkle.proven(made.leaves.filter("pos IN (0, 1, 5, 1023, 1024, 2999)"), made.leaves, made.nodes, made.trees).collect()
    rows = docs.collect()
    leaves = [leaf(r, r.n_chars) for r in rows]
    for r in some:
        root, way = climb(leaves, r.pos)
        assert r.root == root == r.folded_root and r.siblings == [s for _, s in way]
    assert len(some) == 6
    changed = made.leaves.filter("pos = 5").selectExpr("* EXCEPT (claimed)", "'x' AS claimed")
    assert merkle.proven(changed, made.leaves, made.nodes, made.trees).filter("folded_root = root").isEmpty()


@pytest.mark.parametrize("positions, n", [([3], 10), ([0, 1, 2], 7), ([6], 7), (range(8), 8), ([0], 1)])
def test_least_set_of_nodes(positions, n):
    wanted = merkle.lacking(list(positions), n)
    nodes, level, full = [f"{i}" for i in range(n)], 0, {}
    while True:
        full |= {(level, i): d for i, d in enumerate(nodes)}
        if len(nodes) == 1:
            break
        nodes, level = [merkle.join_digests(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], level + 1
    filled = merkle.filled({p: full[0, p] for p in positions}, n, {k: full[k] for k in wanted})
    assert filled[-1] == {0: nodes[0]} and len(set(wanted)) == len(wanted)
    for k in range(len(wanted)):  # none can be left out
        with pytest.raises(KeyError):
            merkle.filled({p: full[0, p] for p in positions}, n, {w: full[w] for w in wanted if w != wanted[k]})


def test_query_agrees_with_sql(spark, folder):
    assert compare(connect(folder), queries.QUERIES["op11_octopus_multiproof"](spark, folder), queries.SQL["op11_octopus_multiproof"]) is None
