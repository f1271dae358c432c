"""Spelling variants: rare words next to a far more frequent one, by search schemes on a bidirectional FM-index.

Words are counted over all documents.  Two words are near if one inserted, deleted
or replaced code point makes one of the other.  An error leaves one half of a word
as it is, so a word and its near words share the first half or the second, and each
word is sent under both halves (for its own length and those one off, as halves
depend on the length) to where words with that half are.  Groups of a half that are
too large for a task are divided again: of the part that may hold the error, again
one half is untouched.  That ends, since at last all but one code point are fixed.

A shard of groups becomes one text of sorted words with delimiters, indexed in both
reading directions.  A search matches the untouched part exactly, then goes on over
the rest and allows one error; intervals of suffix ranks are kept for both directions.
All queries of a shard go side by side.  As the words are sorted, the rank of the
suffix that starts at a word's delimiter is the word's number.  An error is looked
for only at the end of the longest common prefix, so a pair is found once, by the one
search whose open part holds that place.

Null text has no words; a null doc_id counts as empty in the hash.  Repeated rows
count as often as they are there.  An empty table gives an empty result.  Ties
between forms go to the smaller word in code-point order.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantry.llm.common import ramps
from tenantry.llm.fm_dedup import suffix_order
from tenantry.skew import keep_matching
from tenantry.state import materialize

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: How many times as frequent a form is.
RATIO = 10
#: One in so many runs, by hash, loses a code point.
DAMAGED = 31
#: Rows of a group beyond which it is divided, and rows of a shard; a group that cannot be divided has at most
#: 1 + s + s * s words for s different code points, which is below the first for the letters used here.
GROUP_ROWS, SHARD_ROWS = 10_000, 30_000
#: Intervals up to this size are read symbol by symbol.
NARROW = 16

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damaged: int = DAMAGED) -> DataFrame:
    """word and n: the words of all texts, after one in ``damaged`` runs has lost a code point."""
    # shorter runs cannot become words, and this finds the others as they are
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(rf"[A-Za-z\x{{C0}}-\x{{FF}}]{{{least_length},}}"), F.lit(0))).alias("run"))
    lowered = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", _UPPER, _UPPER.lower()))
    runs = runs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), lowered.alias("run"))
    runs = runs.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"), F.length("run").alias("size"))
    shorter = F.expr("concat(substring(run, 1, int(h % size)), substring(run, int(h % size) + 2))")
    words = runs.select(F.when(F.col("h") % damaged == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Words of one key agree in the first ``i`` and the last ``j`` code points and are searched by words of length ``size``."""
    return rows.withColumn("key", F.expr("xxhash64(size, i, j, substring(word, 1, int(i)), right(word, int(j)))"))


def _groups(words: DataFrame, least_length: int, group_rows: int) -> DataFrame:
    """Each word under the keys where words near it look for it, and (``size`` is its length) where it looks for them."""
    size = F.explode(F.expr(f"sequence(greatest(length(word) - 1L, {least_length}L), length(word) + 1L)"))
    halves = F.explode(F.expr("array(struct(size div 2 as i, 0L as j), struct(0L as i, size - size div 2 as j))"))
    rows = words.select("word", "n", size.alias("size")).withColumn("half", halves).select("word", "n", "size", "half.i", "half.j")
    rows, small = materialize(_keyed(rows), "halves"), []
    while True:
        hot = rows.filter("size - i - j > 1").groupBy("key").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > group_rows)
        hot = materialize(hot.select("key"), "hot")
        if hot.isEmpty():
            break
        small.append(keep_matching(rows, hot, [("key", "key")], absent=True))
        middle = "i + (size - i - j) div 2"
        halves = F.explode(F.expr(f"array(struct({middle} as i, j as j), struct(i as i, size - ({middle}) as j))"))
        divided = keep_matching(rows, hot, [("key", "key")]).withColumn("half", halves).select("word", "n", "size", "half.i", "half.j")
        rows = materialize(_keyed(divided), "halves")
    for part in small:
        rows = rows.unionByName(part)
    return rows


class Side:
    """One reading direction: where in the order of suffixes a symbol precedes, and where a smaller one does."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text)
        self.before = text[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        width = len(text) // 64 + 1
        is_symbol = np.zeros((symbols, width * 64), bool)
        is_symbol[self.before, np.arange(len(text))] = True
        self.equal = self._ranked(is_symbol)
        smaller = np.cumsum(is_symbol, axis=0, dtype=np.int8).astype(bool)
        self.less = self._ranked(np.concatenate([np.zeros((1, width * 64), bool), smaller[:-1]]))

    @staticmethod
    def _ranked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = np.packbits(rows, axis=1, bitorder="little").view(np.uint64)
        ranks = np.zeros(words.shape, np.int32)
        np.cumsum(np.bitwise_count(words[:, :-1]), axis=1, out=ranks[:, 1:])
        return words, ranks

    @staticmethod
    def count(table: tuple[np.ndarray, np.ndarray], symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        words, ranks = table
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return ranks[symbols, word] + np.bitwise_count(words[symbols, word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def extended(self, symbols: np.ndarray, low: np.ndarray, other: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The intervals, here and in the other direction, of patterns with one more symbol in this direction; and their size."""
        start = self.count(self.equal, symbols, low)
        size_now = self.count(self.equal, symbols, low + size) - start
        skipped = self.count(self.less, symbols, low + size) - self.count(self.less, symbols, low)
        return self.first[symbols] + start, other + skipped, size_now

    def branches(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different symbols that may follow each interval: the interval's number, and a symbol other than the delimiter."""
        narrow = np.flatnonzero(size <= NARROW)
        owner = np.repeat(narrow, size[narrow])
        symbol = self.before[np.repeat(low[narrow], size[narrow]) + ramps(size[narrow])]
        symbols = len(self.first) - 1
        code = np.unique(owner * symbols + symbol)
        wide = np.flatnonzero(size > NARROW)
        every = np.arange(symbols)
        owner, symbol = np.repeat(wide, symbols), np.tile(every, len(wide))
        there = self.count(self.equal, symbol, (low + size)[owner]) > self.count(self.equal, symbol, low[owner])
        code = np.concatenate([code, owner[there] * symbols + symbol[there]])
        code = np.sort(code[code % symbols > 0])
        return code // symbols, code % symbols


class Index:
    """Sorted different words with delimiters, in both directions."""

    def __init__(self, words: list[str]):
        points = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), np.uint32)
        letters, text = np.unique(points, return_inverse=True)
        self.text = text.astype(np.int64)
        self.symbols = len(letters)
        at = np.flatnonzero(self.text == 0)
        self.starts, self.lengths = at[:-1] + 1, np.diff(at) - 1
        # going on to the right reads the reversed text backward
        self.left, self.right = Side(self.text, self.symbols), Side(self.text[::-1].copy(), self.symbols)

    def near(self, words: np.ndarray, exact: np.ndarray, stop: np.ndarray, rightward: bool) -> tuple[np.ndarray, np.ndarray]:
        """For each query (a word's number) the words with one error, as (query, word's number).

        Read in the given direction, the first ``exact`` symbols are as they are and from ``stop`` on as well.
        """
        side = self.right if rightward else self.left
        length = self.lengths[words]
        begin = self.starts[words] if rightward else self.starts[words] + length - 1
        step = 1 if rightward else -1

        def read(query: np.ndarray, at: np.ndarray) -> np.ndarray:
            """The symbol at a place, the delimiter outside of the word."""
            inside = (at >= 0) & (at < length[query])
            return np.where(inside, self.text[np.where(inside, begin[query] + step * at, 0)], 0)

        count, at = len(words), 0
        low, other, size = np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, self.left.first[1])
        live = np.arange(count)
        pool = tuple(np.empty(0, np.int64) for _ in range(5))  # query, next place, both intervals, size
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(live) or len(pool[0]):
            fresh = [pool]
            open_ = live[at >= exact[live]]
            if len(open_):
                fresh += self._errors(side, rightward, open_, at, exact, stop, length, read, low, other, size)
            if len(live):
                live = live[at < stop[live]]
                low[live], other[live], size[live] = side.extended(read(live, np.full(len(live), at)), low[live], other[live], size[live])
            query, place, a, b, n = (np.concatenate(column) for column in zip(*fresh, strict=True))
            if len(query):
                a, b, n = side.extended(read(query, place), a, b, n)
                done = (n > 0) & (place == length[query])
                rank = b if rightward else a
                found.append((query[done], rank[done] - 1))
                on = (n > 0) & ~done
                pool = (query[on], place[on] + 1, a[on], b[on], n[on])
            else:
                pool = (query, place, a, b, n)
            at += 1
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])

    @staticmethod
    def _errors(side: Side, rightward: bool, query: np.ndarray, at: int, exact, stop, length, read, low, other, size) -> Iterator[tuple[np.ndarray, ...]]:
        """States after an error at this place, where it is the end of the common prefix (read to the right)."""
        place = np.full(len(query), at)
        before, here, behind = read(query, place - 1), read(query, place), read(query, place + 1)
        within = at < stop[query]
        # a missing symbol: of a run of equal ones the last in the word
        gone = within & ((here != behind) if rightward else (here != before))
        q = query[gone]
        yield q, np.full(len(q), at + 1), low[q], other[q], size[q]
        # queries with one interval share what follows it
        code, owner = np.unique(low[query] * (len(side.before) + 1) + size[query], return_inverse=True)
        which, symbol = side.branches(code // (len(side.before) + 1), code % (len(side.before) + 1))
        upto = np.searchsorted(which, np.arange(len(code) + 1))
        many = (upto[1:] - upto[:-1])[owner]
        mine = np.repeat(np.arange(len(query)), many)
        c = symbol[np.repeat(upto[owner], many) + ramps(many)]
        replaced = within[mine] & (c != here[mine])
        if rightward:  # one more before this place, or behind the whole word
            added = (within[mine] & (c != here[mine])) | (at == length[query])[mine]
        else:
            added = (at > exact[query])[mine] & (c != before[mine])
        wanted = replaced | added
        mine, c, replaced, added = mine[wanted], c[wanted], replaced[wanted], added[wanted]
        q = query[mine]
        a, b, n = side.extended(c, low[q], other[q], size[q])
        for chosen, following in ((replaced, at + 1), (added, at)):
            yield q[chosen], np.full(int(chosen.sum()), following), a[chosen], b[chosen], n[chosen]


def _searched(table: pa.Table) -> pa.Table:
    """Of one shard: each word that has near words there, how many, and which of them is the most frequent."""
    names = table["word"].to_pylist()
    words = sorted(set(names))
    number = {w: k for k, w in enumerate(words)}
    own = np.fromiter(map(number.__getitem__, names), np.int64, len(names))
    n = np.zeros(len(words), np.int64)
    n[own] = table["n"].to_numpy()
    size, i, j = (table[c].to_numpy() for c in ("size", "i", "j"))
    index = Index(words)
    asks = index.lengths[own] == size
    queries, hits = [], []
    for rightward, mine in ((True, asks & (i >= j)), (False, asks & (i < j))):
        rows = np.flatnonzero(mine)
        start, end = (i, j) if rightward else (j, i)
        asked, hit = index.near(own[rows], start[rows], (size - end)[rows], rightward)
        queries.append(own[rows][asked])
        hits.append(hit)
    query, hit = np.concatenate(queries), np.concatenate(hits)
    order = np.lexsort((hit, -n[hit], query))
    query, hit = query[order], hit[order]
    heads = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.empty(0, np.int64)
    return pa.table({
        "word": pa.array([words[k] for k in query[heads].tolist()], pa.string()),
        "n_near": pa.array(np.diff(np.append(heads, len(query))), pa.int64()),
        "near": pa.array([words[k] for k in hit[heads].tolist()], pa.string()),
        "near_n": pa.array(n[hit[heads]], pa.int64()),
    })


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, group_rows: int = GROUP_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Each word of a table (word, n) that has near ones: n_near, and the most frequent near word with its n."""
    rows = _groups(words, least_length, group_rows)
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    found = dealt.groupBy("shard").applyInArrow(_searched, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root, from a table of words and their forms; each round doubles the steps that are followed."""
    known = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = known.select(F.col("word").alias("via"), F.col("root").alias("further"))
        known = materialize(known.join(onward, F.col("root") == F.col("via"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if known.filter("moved").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def variants(docs: DataFrame, ratio: int = RATIO, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damaged: int = DAMAGED) -> DataFrame:
    """word, n, n_near, form and form_n (null without one), and root: each word with what it is a variant of."""
    words = materialize(vocabulary(docs, least_length, least_count, damaged), "words")
    near = near_words(words, least_length)
    is_form = F.col("near_n") >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")
    )
    judged = materialize(judged, "forms")
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
