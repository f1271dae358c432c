"""A Merkle manifest of a table, and proofs of many rows at once by octopus multiproofs.

Every row is a leaf.  The rows of one tree (one language, say) stand in a fixed
order; two neighbours become a node, the last one alone if it has no neighbour,
until one is left.  The roots of the trees are the leaves of one more tree, whose
root stands for the whole table.

Leaves are dealt in blocks of 1024 neighbours, so a tree of any size is spread
over many tasks, and a tier of ten levels costs one shuffle of its lowest level.
A proof is made per block and not per row: the block works out which nodes it
lacks (the least set, as two rows side by side need nothing for each other),
gets them in one join, derives the nodes between its own rows itself, and hands
each row its own proof from that.  A node near the top is wanted by very many
blocks; it is repeated so that no join key has more than 1024 takers.

A null field counts as ``-``, so null and empty text differ.  Null tree values
form a tree of their own, which comes first; null order values come first in
their tree.  Repeated rows are leaves of their own, side by side; rows with one
order value and different contents stand in the order of their digests.  An empty table has
no tree and gives empty results.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantry.operators.ranking import number_rows
from tenantry.skew import look_up
from tenantry.state import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a tree that one task builds, and the logarithm of a block's leaves.
BITS = 10
#: The tree of all trees' roots.
TOP = "top"

_NODE = "tree string, level int, idx long, digest string, n long, is_top boolean"
_WANTED = "tree string, block long, level int, idx long"
_MARK = -1


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def join_digests(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n leaves."""
    return (n - 1).bit_length()


@dataclass(frozen=True)
class Manifest:
    """``leaves``: tree, pos, n, digest and what the caller keeps; ``nodes``: all inner nodes; ``trees``: one row per
    tree with its subroot, its place among the trees, what its subroot lacks on the way to the root, and the root."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def build(docs: DataFrame, tree: str = "lang", order: str = "doc_id", fields: Sequence[str] = FIELDS, keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of a table.  ``keep`` are expressions on its rows that are carried along with the leaves."""
    kept = {"claimed": leaf([F.col(c) for c in fields])} | (keep or {})
    rows = docs.select(
        encoded(F.col(tree)).alias("tree"), F.col(tree).alias("tree_value"), F.col(order).alias("key"), leaf([F.col(c) for c in fields]).alias("digest"), *[e.alias(c) for c, e in kept.items()]
    )
    rows = materialize(rows.withColumn("copy", F.monotonically_increasing_id()), "leaves")  # written, so that copies keep their numbers
    placed = number_rows(rows, ["key", "digest", "copy"], ["tree_value"], "pos", start=0)
    sizes = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.min("tree_value").alias("tree_value"))
    leaves = materialize(look_up(placed.drop("tree_value", "copy"), sizes.select(F.col("tree").alias("size_of"), "n"), [("tree", "size_of")]), "placed")
    nodes = grown(leaves)
    subroots = leaves.filter("n = 1").select("tree", "digest").unionByName(nodes.filter("is_top").select("tree", "digest"))
    subroots = subroots.join(sizes, "tree")
    roots = number_rows(subroots, ["tree_value"], (), "pos", start=0).select(
        F.lit(TOP).alias("tree"), "pos", F.lit(sizes.count()).cast("long").alias("n"), "digest", F.col("digest").alias("claimed"), F.col("tree").alias("of_tree")
    )
    roots = materialize(roots, "subroots")
    crown = grown(roots)
    root = roots.filter("n = 1").select("digest").union(crown.filter("is_top").select("digest")).first()
    trees = proven(roots, roots, crown, None).select(
        F.col("of_tree").alias("tree"), F.col("pos").alias("tree_pos"), F.col("digest").alias("subroot"), F.col("siblings").alias("above"), F.lit(root and root.digest).alias("root")
    )
    return Manifest(leaves, nodes, materialize(trees, "trees"))


def grown(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """All nodes above the leaves, ten levels with each shuffle."""
    largest = leaves.agg(F.max("n")).first()[0] or 1
    tiers, low = [], leaves.select("tree", F.col("pos").alias("idx"), "digest", "n")
    for base in range(0, max(1, height(largest)), bits):

        def raised(group: pa.Table) -> pa.Table:  # written before the next turn, so that it may close over base
            tree, n = group["tree"][0].as_py(), group["n"][0].as_py()
            group = group.sort_by("idx")
            digests, first = group["digest"].to_pylist(), group["idx"][0].as_py()
            level, idx, out = [], [], []
            for up in range(base + 1, min(base + bits, height(n)) + 1):
                digests = [join_digests(*digests[i : i + 2]) for i in range(0, len(digests), 2)]
                first >>= 1
                level += [up] * len(digests)
                idx += range(first, first + len(digests))
                out += digests
            return pa.table({"tree": pa.array([tree] * len(out), pa.string()), "level": pa.array(level, pa.int32()), "idx": pa.array(idx, pa.int64()), "digest": pa.array(out, pa.string()),
                             "n": pa.array([n] * len(out), pa.int64()), "is_top": pa.array([x == height(n) for x in level], pa.bool_())})

        above = low.filter(F.col("n") > 2**base).withColumn("block", F.shiftright("idx", bits))
        tiers.append(materialize(above.groupBy("tree", "block").applyInArrow(raised, _NODE), "nodes"))
        low = tiers[-1].filter(F.col("level") == base + bits).select("tree", "idx", "digest", "n")
    nodes = tiers[0]
    for tier in tiers[1:]:
        nodes = nodes.unionByName(tier)
    return nodes


def lacking(positions: Sequence[int], n: int) -> list[tuple[int, int]]:
    """The least set of (level, index) that, with the leaves at ``positions``, gives the root."""
    known, wanted = sorted(set(positions)), []
    for level in range(height(n)):
        width = (n + (1 << level) - 1) >> level
        have = set(known)
        wanted += [(level, i ^ 1) for i in known if i ^ 1 not in have and i ^ 1 < width]
        known = sorted({i >> 1 for i in known})
    return wanted


def filled(own: dict[int, str], n: int, fetched: dict[tuple[int, int], str]) -> list[dict[int, str]]:
    """Per level the digests of all nodes that proofs of the own leaves need: fetched ones and those derived from them."""
    levels, known = [], dict(own)
    for level in range(height(n)):
        width = (n + (1 << level) - 1) >> level
        for i in list(known):
            if i ^ 1 < width and i ^ 1 not in known:
                known[i ^ 1] = fetched[level, i ^ 1]
        levels.append(known)
        known = {i >> 1: join_digests(*[known[j] for j in (i & ~1, i | 1) if j in known]) for i in known}
    levels.append(known)
    return levels


def path(levels: list[dict[int, str]], position: int, n: int) -> list[str | None]:
    """The siblings of a leaf from below; None where it has none."""
    return [levels[level].get((position >> level) ^ 1) for level in range(height(n))]


def folded(digest: str, position: int, siblings: Sequence[str | None]) -> str:
    """The root that follows from a leaf and its siblings."""
    for level, other in enumerate(siblings):
        if other is None:
            digest = join_digests(digest)
        elif position >> level & 1:
            digest = join_digests(other, digest)
        else:
            digest = join_digests(digest, other)
    return digest


def proven(claims: DataFrame, leaves: DataFrame, nodes: DataFrame, trees: DataFrame | None, bits: int = BITS) -> DataFrame:
    """Each claim (a row of ``leaves`` with its own ``claimed`` digest) with its proof and the root that follows from it.

    Any set of leaves may be given.  With ``trees`` proofs go on to the root of all; ``siblings`` are null at levels
    where a node has none.  Comes with subroot, root, folded_root and proof_sha256; without ``trees`` with siblings only.
    """
    claims = claims.withColumn("block", F.shiftright("pos", bits))

    def wanted(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        places = lacking(group["pos"].to_pylist(), group["n"][0].as_py()) + [(_MARK, 0)]
        tree, block = (k.as_py() for k in key)
        return pa.table({"tree": pa.array([tree] * len(places), pa.string()), "block": pa.array([block] * len(places), pa.int64()),
                         "level": pa.array([p[0] for p in places], pa.int32()), "idx": pa.array([p[1] for p in places], pa.int64())})

    places = materialize(claims.select("tree", "block", "pos", "n").groupBy("tree", "block").applyInArrow(wanted, _WANTED), "wanted")
    fetched = _fetched(places, leaves, nodes, bits)
    none = F.lit(None)
    fetched = fetched.select("tree", "block", "level", "idx", "digest", none.cast("array<string>").alias("above"), none.cast("string").alias("root"))
    if trees is not None:
        marks = look_up(places.filter(F.col("level") == _MARK), trees.withColumnRenamed("tree", "of"), [("tree", "of")])
        fetched = fetched.unionByName(marks.select("tree", "block", "level", F.col("tree_pos").alias("idx"), F.col("subroot").alias("digest"), "above", "root"))
    carried = [c for c in claims.columns if c != "block"]
    more = ", siblings array<string>, folded_root string" + (", subroot string, root string, proof_sha256 string" if trees is not None else "")
    schema = ", ".join(f"`{c}` {claims.schema[c].dataType.simpleString()}" for c in carried) + more

    def expanded(rows: pa.Table, parts: pa.Table) -> pa.Table:
        n, positions = rows["n"][0].as_py(), rows["pos"].to_pylist()
        mark, known = None, {}
        for row in parts.to_pylist():
            if row["level"] == _MARK:
                mark = row
            else:
                known[row["level"], row["idx"]] = row["digest"]
        levels = filled(dict(zip(positions, rows["digest"].to_pylist(), strict=True)), n, known)
        siblings, roots = [], []
        for position, claimed in zip(positions, rows["claimed"].to_pylist(), strict=True):
            way = path(levels, position, n)
            root = folded(claimed, position, way)
            if mark is not None:
                root = folded(root, mark["idx"], mark["above"])
                way = way + mark["above"]
            siblings.append(way)
            roots.append(root)
        out = rows.select(carried).append_column("siblings", pa.array(siblings, pa.list_(pa.string()))).append_column("folded_root", pa.array(roots, pa.string()))
        if mark is not None:
            proofs = [join_digests(*[s for s in way if s is not None]) for way in siblings]
            for name, values in (("subroot", [mark["digest"]] * len(proofs)), ("root", [mark["root"]] * len(proofs)), ("proof_sha256", proofs)):
                out = out.append_column(name, pa.array(values, pa.string()))
        return out

    return claims.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(expanded, schema)


def _fetched(places: DataFrame, leaves: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """The digests of the wanted nodes, for each block that wants them.

    Blocks are taken 1024 at a time.  A node is wanted only by blocks below its sibling, which tells for which of
    these sets it has to be repeated: one for the lower levels, more towards the top, where there are few nodes.
    """
    lowest = places.filter(F.col("level") != _MARK).agg(F.min("level")).first()[0]
    if lowest is None:  # every block has all it needs
        return places.select("*", F.lit("").alias("digest")).limit(0)
    stored = nodes.filter(F.col("level") >= lowest).select("tree", "level", "idx", "digest", "n")
    if lowest == 0:
        stored = stored.unionByName(leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest", "n"))
    last = F.col("n") - 1
    first_leaf = F.expr("shiftleft(idx ^ 1, level)")
    last_leaf = F.least(F.expr("shiftleft((idx ^ 1) + 1, level) - 1"), last)
    sets = F.sequence(F.shiftright(first_leaf, 2 * bits), F.shiftright(last_leaf, 2 * bits))
    stored = stored.filter(first_leaf <= last).select("tree", "level", "idx", "digest", F.explode(sets).alias("set"))
    return places.filter(F.col("level") != _MARK).withColumn("set", F.shiftright("block", bits)).join(stored, ["tree", "level", "idx", "set"]).drop("set")


def verify(docs: DataFrame, claims: Sequence[Column], tree: str = "lang", order: str = "doc_id", fields: Sequence[str] = FIELDS) -> DataFrame:
    """Each row of a table with its proof against the table's manifest, where ``claims`` are the values it is said to have."""
    made = build(docs, tree, order, fields, {"claimed": leaf(claims)})
    out = proven(made.leaves, made.leaves, made.nodes, made.trees).withColumn("verified", F.col("folded_root") == F.col("root"))
    return out.select(F.col("key").alias(order), F.col("digest").alias("leaf"), "subroot", "root", "siblings", "proof_sha256", "folded_root", "verified")


def tampered(divisor: int = 7, field: str = "n_chars", fields: Sequence[str] = FIELDS) -> list[Column]:
    """The fields of a row, with one added to a number of every few rows."""
    hit = F.crc32(F.col("doc_id").cast("string")) % divisor == 0
    return [F.when(hit, F.col(c) + 1).otherwise(F.col(c)) if c == field else F.col(c) for c in fields]
