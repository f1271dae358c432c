"""Near-duplicate classes by ProbMinHash.

The similarity of two documents is the probability Jaccard index of their
five-word shingles, weighted by how often a document has them.

1. Every shingle is a Poisson process whose rate is its weight.  Each arrival
   goes to one of ``m`` registers at random; a register keeps the shingle that
   arrives first.  Arrivals depend on the shingle alone, so two documents agree
   in a register with the probability of their similarity.  A shingle is left as
   soon as its next arrival is later than all of its document's registers.
2. Bands of registers bring documents together.  Equal word sequences have been
   merged before, and only one document of each takes part.
3. Links are verified on the shingles of the whole texts.  First, members of a
   bucket are compared with the bucket's first document, in blocks.  Links make
   classes.  Of a bucket that then still has several classes, all documents in
   different classes are compared, so that no link between candidates is lost,
   whatever the first document was like; the largest class is not compared with
   itself.  A block's pairs never leave the task:
   one matrix product gives the shares they have in common, which bound the
   similarity; what passes is computed in full, and links are all that is returned.

A document of fewer than five words has one shingle, all its words; without
words it is equal to all such documents (null and empty texts).  The class id is
the least doc_id of the class, null if it has no id.  Each text is compared, also if
ids are null or repeated: an id with texts in several classes has a row for each.
Equal rows are one.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenantry.llm.common import WHITE_RUN, slices, texts
from tenantry.llm.components import connected
from tenantry.llm.word_hashes import BASE, Words, mixed
from tenantry.state import materialize

SHINGLE, SIMILARITY = 5, 0.8
#: At similarity 0.8 all bands of a pair differ with a probability of 3e-6.
BANDS, ROWS = 32, 5
SLICE_BYTES = 2 << 20
#: Documents of a block that are compared at once, shingles that are held at once, rows of one call.
BLOCK, COLUMNS, GROUPED_ROWS = 512, 4096, 2000


class Shingles:
    """The different shingles of each text in order of text and hash, with how often it has them."""

    def __init__(self, raws: list[bytes], width: int = SHINGLE):
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        ends = np.cumsum(sizes)
        words = Words(b"".join(raws), ends - sizes, ends)
        counts = words.last - words.first
        starts = np.maximum(0, counts - width + 1)
        hashes = np.zeros(max(0, len(words.hashes) - width + 1), np.uint64)
        for i in range(width):
            hashes = hashes * BASE + words.hashes[i : i + len(hashes)]
        text = np.repeat(np.arange(len(raws)), counts)[: len(hashes)]
        whole = np.arange(len(hashes)) - words.first[text] < starts[text] if len(hashes) else np.empty(0, bool)
        hashes, text = hashes[whole], text[whole]
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            own = [hash_of(words.hashes[words.first[t] : words.last[t]], counts[t]) for t in short.tolist()]
            hashes, text = np.concatenate([hashes, np.asarray(own, np.uint64)]), np.concatenate([text, short])
        hashes = mixed(hashes)
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        heads = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))) if len(hashes) else np.empty(0, np.int64)
        self.hashes, self.text = hashes[heads], text[heads]
        self.counts = np.diff(np.append(heads, len(hashes)))
        self.upto = np.searchsorted(self.text, np.arange(len(raws) + 1))

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.hashes[self.upto[i] : self.upto[i + 1]], self.counts[self.upto[i] : self.upto[i + 1]]


def hash_of(words: np.ndarray, count: int) -> int:
    value = np.uint64(count)
    for w in words:
        value = np.uint64((int(value) * int(BASE) + int(w)) & 0xFFFFFFFFFFFFFFFF)
    return int(value)


def registers(shingles: Shingles, texts: int, m: int) -> np.ndarray:
    """For each text and register the hash of the shingle that arrives there first; 0 without shingles."""
    times = np.full(texts * m, np.inf)
    first = np.zeros(texts * m, np.uint64)
    element, text = shingles.hashes, shingles.text
    weight, clock = shingles.counts.astype(np.float64), np.zeros(len(element))
    turn = 0
    while len(element):
        turn += 1
        random = mixed(element + np.uint64((turn * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF))
        clock = clock - np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0) / weight
        place = text * m + ((mixed(random ^ BASE) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        better = clock < times[place]
        at, when = place[better], clock[better]
        np.minimum.at(times, at, when)
        won = times[at] == when
        first[at[won]] = element[better][won]
        latest = times.reshape(texts, m).max(axis=1)
        on = clock < latest[text]  # later arrivals of the others can change nothing
        element, text, weight, clock = element[on], text[on], weight[on], clock[on]
    return first.reshape(texts, m)


def band_keys(first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = first.reshape(len(first), bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.zeros((len(first), 1), np.uint64)
    for r in range(rows):
        keys = mixed(keys * BASE + parts[:, :, r])
    return keys.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard index of two weighted sets, given as sorted hashes and counts.

    That is the sum over common i of 1 / sum over all k of max(v_k / v_i, w_k / w_i).
    """
    (x, v), (y, w) = a, b
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    common, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    both, left, right = v[i].astype(np.float64), v.sum() - v[i].sum(), w.sum() - w[j].sum()
    other = w[j].astype(np.float64)
    ratio = both / other
    total = 0.0
    for r in np.unique(ratio):  # all are 1 unless counts differ
        total += both[ratio == r].sum() / (left + r * right + np.maximum(both, r * other).sum())
    return float(total)


def close_pairs(sets: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links between different classes, enough to join all classes that any pair links."""
    top: dict[int, int] = {}

    def find(c: int) -> int:
        while c in top:
            c = top[c]
        return c

    links = []
    n = len(sets)
    if n > 8:
        candidates = possible_pairs(sets, least)
    else:
        candidates = ((i, j) for i in range(n) for j in range(i + 1, n))
    for i, j in candidates:
        a, b = find(int(classes[i])), find(int(classes[j]))
        if a != b and similarity(sets[i], sets[j]) >= least:
            top[max(a, b)] = min(a, b)
            links.append((i, j))
    return links


def possible_pairs(sets: list[tuple[np.ndarray, np.ndarray]], least: float) -> list[tuple[int, int]]:
    """Pairs whose common shares c and d allow the similarity, which is at most 2 / ((2 - c) / c + (2 - d) / d)."""
    n = len(sets)
    sizes = [len(x) for x, _ in sets]
    owner = np.repeat(np.arange(n), sizes)
    hashes = np.concatenate([x for x, _ in sets])
    shares = np.concatenate([v / max(1, v.sum()) for _, v in sets]).astype(np.float32)
    order = np.argsort(hashes, kind="stable")
    hashes, owner, shares = hashes[order], owner[order], shares[order]
    new = np.append(True, hashes[1:] != hashes[:-1]) if len(hashes) else np.empty(0, bool)
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1 if len(column) else new
    column, owner, shares = column[shared], owner[shared], shares[shared]
    _, column = np.unique(column, return_inverse=True)
    common = np.zeros((n, n), np.float32)
    cuts = np.searchsorted(column, np.arange(0, (int(column[-1]) + 1 if len(column) else 0) + COLUMNS, COLUMNS))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if a < b:
            part = np.zeros((n, COLUMNS), np.float32)
            part[owner[a:b], column[a:b] % COLUMNS] = shares[a:b]
            common += part @ (part > 0).astype(np.float32).T
    empty = np.asarray(sizes) == 0
    common[np.ix_(empty, empty)] = 1
    with np.errstate(divide="ignore"):
        bound = 1 / common + 1 / common.T <= 1 + 1 / least + 1e-4
    return list(zip(*(x.tolist() for x in np.nonzero(np.triu(bound, 1))), strict=True))


def _sketches(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, a 128-bit hash of the word sequence, and the band keys (none without words)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                raws = [x.as_buffer().to_pybytes() for x in some.column(1).cast(pa.binary())]
                shingles = Shingles(raws)
                keys = band_keys(registers(shingles, len(raws), bands * rows), bands, rows)
                with_words = (np.diff(shingles.upto) > 0).tolist()
                lists = [k if w else [] for k, w in zip(keys.tolist(), with_words, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(_same(raws), pa.binary()), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "same", "keys"])

    return texts(docs).mapInArrow(sketched, f"doc_id {kind}, same binary, keys array<long>")


def _same(raws: list[bytes]) -> list[bytes]:
    return [hashlib.md5(b" ".join(raw.split()), usedforsecurity=False).digest() for raw in raws]


def same_words(text: Column) -> Column:
    """The same hash as a column."""
    return F.unhex(F.md5(F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_RUN, " "))))


def _sets(docs: DataFrame) -> DataFrame:
    """The hash of each word sequence, and its shingles as hashes and counts."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                raws = [x.as_buffer().to_pybytes() for x in some.column(0).cast(pa.binary())]
                shingles = Shingles(raws)
                each = [shingles.of(i) for i in range(some.num_rows)]
                hashes = pa.array([h.tobytes() for h, _ in each], pa.binary())
                # counts are only kept where one is not 1
                counts = pa.array([c.astype(np.uint32).tobytes() if (c > 1).any() else b"" for _, c in each], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(_same(raws), pa.binary()), hashes, counts], names=["same", "hashes", "counts"])

    return texts(docs).select("text").mapInArrow(made, "same binary, hashes binary, counts binary")


def _links(groups: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Edges between documents of different classes that are close; ``groups`` has (grp, doc, class)."""

    def linked(table: pa.Table) -> pa.Table:
        table = table.sort_by([("grp", "ascending"), ("doc", "ascending")])
        grp, docs, classes = (table.column(c).to_numpy() for c in ("grp", "doc", "class"))
        hashes, counts = table.column("hashes").to_pylist(), table.column("counts").to_pylist()
        cuts = np.flatnonzero(np.append(True, grp[1:] != grp[:-1]))
        out = []
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(grp)], strict=True):
            if b - a > 1 and (classes[a:b] != classes[a]).any():
                sets = []
                for h, c in zip(hashes[a:b], counts[a:b], strict=True):
                    h = np.frombuffer(h, np.uint64)
                    sets.append((h, np.frombuffer(c, np.uint32).astype(np.int64) if c else np.ones(len(h), np.int64)))
                out += [(docs[a + i], docs[a + j]) for i, j in close_pairs(sets, classes[a:b], least)]
        return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([y for _, y in out], pa.int64())})

    groups = materialize(groups, "groups")
    calls = max(1, groups.count() // GROUPED_ROWS)
    together = groups.join(sets, "doc").select("grp", "doc", "class", "hashes", "counts", F.pmod(F.xxhash64("grp"), F.lit(calls)).alias("call"))
    return materialize(together.groupBy("call").applyInArrow(linked, "u long, v long").distinct(), "links")


def _grouped(docs: DataFrame, least: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """The sketches, and of each different word sequence the least id that has it and the class it is in.

    Word sequences are what is compared, under numbers of their own, so ids may be null or repeated.
    """
    sketches = materialize(_sketches(docs, bands, rows), "sketches")
    firsts = sketches.groupBy("same").agg(F.min("doc_id").alias("first"), F.max("keys").alias("keys"))
    firsts = materialize(firsts.withColumn("doc", F.monotonically_increasing_id()), "firsts")  # written, so that numbers stay
    buckets = firsts.select("doc", F.explode("keys").alias("key"))
    sized = buckets.groupBy("key").agg(F.min("doc").alias("leader"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(buckets.join(sized, "key"), "members")
    wanted = materialize(firsts.join(members.select("doc").distinct(), "doc", "left_semi").select("doc", "same", "first"), "wanted")
    ids = wanted.select("first").distinct()
    sets = _sets(docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("first")), "left_semi"))
    sets = sets.join(wanted.select("doc", "same"), "same").groupBy("doc").agg(F.max_by("hashes", "hashes").alias("hashes"), F.max_by("counts", "hashes").alias("counts"))
    sets = materialize(sets, "sets")

    # first round: each bucket's first document with those it was brought together with, in blocks
    pairs = members.filter("doc <> leader").select("leader", "doc").distinct()
    parts = pairs.groupBy(F.col("leader").alias("of")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = pairs.join(parts, F.col("leader") == F.col("of")).withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    blocks = placed.select("doc", F.xxhash64("leader", "block").alias("grp"))
    heads = placed.select(F.col("leader").alias("doc"), F.xxhash64("leader", "block").alias("grp")).distinct()
    found = _links(blocks.unionByName(heads).withColumn("class", F.col("doc")), sets, least)
    known = materialize(connected(found), "classes")

    now = members.join(known, F.col("doc") == F.col("node"), "left").select("key", "doc", F.coalesce("component", "doc").alias("class"))
    more = _links(_across(now), sets, least)
    final = connected(found.unionByName(more))
    return sketches, firsts.join(final, F.col("doc") == F.col("node"), "left").select("same", "first", F.coalesce("component", "doc").alias("component"))


def _across(now: DataFrame, block: int = BLOCK) -> DataFrame:
    """Second round: (grp, doc, class) so that any two documents of a bucket that are in different classes meet.

    A bucket's largest class is cut into blocks and the rest together into others.  Each block of the rest meets all
    blocks of both, but blocks of the largest class never meet each other.
    """
    sizes = now.groupBy("key", "class").agg(F.count(F.lit(1)).alias("many"))
    open_ = sizes.groupBy(F.col("key").alias("of")).agg(F.count(F.lit(1)).alias("classes"), F.sum("many").alias("all"), F.max(F.struct("many", "class")).alias("largest"))
    open_ = open_.filter("classes > 1").select(
        "of", F.col("largest.class").alias("large"), F.ceil(F.col("largest.many") / block).alias("parts"), F.ceil((F.col("all") - F.col("largest.many")) / block).alias("others")
    )
    placed = now.join(open_, F.col("key") == F.col("of")).withColumn("is_large", F.col("class") == F.col("large"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("doc"), F.when(F.col("is_large"), F.col("parts")).otherwise(F.col("others"))))
    meets_large = "transform(sequence(0L, parts - 1), p -> struct(true AS with_large, p AS x, own AS y))"
    meets_rest = "transform(sequence(0L, others - 1), p -> struct(false AS with_large, least(own, p) AS x, greatest(own, p) AS y))"
    from_large = "transform(sequence(0L, others - 1), p -> struct(true AS with_large, own AS x, p AS y))"
    where = F.explode(F.expr(f"CASE WHEN is_large THEN {from_large} ELSE concat({meets_large}, {meets_rest}) END"))
    return placed.select("key", "doc", "class", where.alias("at")).select("doc", "class", F.xxhash64("key", "at.with_large", "at.x", "at.y").alias("grp"))


def classes(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id and class_id: one row for each different doc_id, or for each class that an id's texts are in."""
    sketches, grouped = _grouped(docs, least, bands, rows)
    named = grouped.groupBy("component").agg(F.min("first").alias("class_id"))
    return sketches.select("doc_id", "same").join(grouped, "same").join(named, "component").select("doc_id", "class_id").distinct()


def keep_first(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` per class, with all its columns: that of the least id (null only if there is no other)."""
    _, grouped = _grouped(docs, least, BANDS, ROWS)
    best = grouped.groupBy("component").agg(F.min(F.struct(F.col("first").isNull().alias("none"), F.col("first").alias("id"), "same")).alias("best"))
    kept = materialize(best.select(F.col("best.id").alias("__id"), F.col("best.same").alias("__same")), "kept")
    columns = docs.columns

    def one_each(rows: DataFrame, *key: str) -> DataFrame:
        """The row of least text of each key."""
        turn = F.row_number().over(Window.partitionBy(*key).orderBy("text"))
        return rows.withColumn("__turn", turn).filter("__turn = 1").select(*columns)

    # an id has one text as a rule, so that it decides; repeated ids are told apart by the text
    by_id = kept.filter("__id IS NOT NULL").groupBy("__id").agg(F.collect_set("__same").alias("__sames"))
    named = docs.filter("doc_id IS NOT NULL").join(by_id, F.col("doc_id") == F.col("__id")).withColumn("__same", same_words(F.col("text")))
    nameless = docs.filter("doc_id IS NULL").withColumn("__word_hash", same_words(F.col("text")))
    nameless = nameless.join(kept.filter("__id IS NULL"), F.col("__word_hash") == F.col("__same"), "left_semi")
    return one_each(named.filter(F.array_contains("__sames", F.col("__same"))), "doc_id", "__same").unionByName(one_each(nameless, "__word_hash"))
