"""Benchmark items found in training text by BM25 with block-max WAND.

The items form an inverted index: per term the items that have it and the
impact, which is the BM25 weight divided by the item's score for itself, so that 1
means that the whole item is there.  Items are taken in blocks, and each term
knows its greatest impact per block and overall.  Every document is cut into
overlapping passages, twice as long as the longest item, so that an item is
always whole in one of them.  Each passage is a query and retrieves all items of
at least the threshold:

* for all passages of a slice at once, the greatest impacts of their terms are
  summed per block; a passage none of whose blocks can reach the threshold is done;
* for the others block-max WAND walks the posting lists: a pivot by the greatest
  impacts, a test by those of the pivot's block, and full scores for what passes.

A retrieved item counts if the passage has enough of its question's and of its
answer's word trigrams.  The last sentence of an item is its answer, what stands
before it the question; an item of one sentence is all question.

What may count need not reach half of the item's score, as a long answer can weigh
more than the question.  Each item's question is therefore an entry of its own in
a second index, by its trigrams with equal impacts, and the same walk retrieves
what has half of them, which everything that counts has.  A question of under
three words is entered by its answer's trigrams.  A question of fewer than
``min_words`` words says too little alone: it needs its answer, or the item's score.

Documents are read whole where they are scanned; only hits are shuffled.  The
index goes to every task, so the items' size is checked.  Null items and those of
fewer than ``min_words`` words are not searched for.  Null or empty documents
have no hits.  Equal items are found each under its own id; repeated rows of a
document give one hit per item.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantry.llm.common import ramps, slices, texts

K1, B = 1.2, 0.75
#: Part of an item's own score that a passage must reach, and parts of its trigrams.
THRESHOLD, OVERLAP, ALONE = 0.5, 0.5, 0.8
BLOCK, MIN_WORDS, LEAST_CELL = 2, 5, 32
SLICE_BYTES = 2 << 20
#: Sums of passages by block that are held at once.
CELLS_AT_ONCE = 1 << 22
#: All items' text; more is refused, as each task holds the index.
MAX_BYTES = 256 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[b for b in range(128) if not chr(b).isalnum()]] = 32


def word_lists(values: pa.Array) -> pa.ListArray:
    """Lower-cased words; whatever is ASCII and neither letter nor digit separates them."""
    lowered = pc.utf8_lower(values)
    sizes = pc.binary_length(lowered).to_numpy(zero_copy_only=False)
    raw = np.frombuffer(b"".join(x.as_buffer().to_pybytes() for x in lowered.cast(pa.binary())), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    folded = pa.StringArray.from_buffers(len(values), pa.py_buffer(offsets.tobytes()), pa.py_buffer(_FOLD[raw].tobytes()))
    return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(folded))


def words_of(text: str) -> list[str]:
    return [w for w in word_lists(pa.array([text], pa.string()))[0].as_py() if w]


def question_and_answer(text: str) -> tuple[str, str]:
    parts = [p for p in re.split(r"(?<=[.?!])\s+|\n+", text.strip()) if p.strip()]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def trigrams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(3, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class Postings:
    """Posting lists over numbered items, with the greatest impact of each term per block and overall."""

    def __init__(self, postings: dict, count: int, block: int, cell: int):
        self.count, self.block, self.cell = count, block, cell
        self.terms = sorted(postings)
        self.items = [[i for i, _ in postings[t]] for t in self.terms]
        self.impacts = [[w for _, w in postings[t]] for t in self.terms]
        self.greatest = np.asarray([max(w) for w in self.impacts], np.float64)
        self.in_block: list[dict[int, float]] = []
        for where, what in zip(self.items, self.impacts, strict=True):
            tops: dict[int, float] = {}
            for i, w in zip(where, what, strict=True):
                tops[i // block] = max(w, tops.get(i // block, 0.0))
            self.in_block.append(tops)
        self.blocks = -(-count // block)
        # terms of few blocks are listed, those of many are rows of a matrix
        many = [len(tops) > max(4, self.blocks // 8) for tops in self.in_block]
        self.column = np.where(many, np.cumsum(many) - 1, -1)
        self.wide_tops = np.zeros((sum(many), self.blocks), np.float32)
        listed: list[list[tuple[int, float]]] = []
        for dense, column, tops in zip(many, self.column.tolist(), self.in_block, strict=True):
            listed.append([] if dense else sorted(tops.items()))
            if dense:
                self.wide_tops[column, list(tops)] = list(tops.values())
        self.many = np.asarray([len(x) for x in listed], np.int64)
        self.begin = np.cumsum(self.many) - self.many
        self.block_of = np.asarray([b for x in listed for b, _ in x], np.int64)
        self.block_top = np.asarray([w for x in listed for _, w in x], np.float64)

    def score(self, item: int, terms: list[int]) -> float:
        """Sum of an item's impacts for the terms."""
        total = 0.0
        for t in terms:
            at = bisect_left(self.items[t], item)
            if at < len(self.items[t]) and self.items[t][at] == item:
                total += self.impacts[t][at]
        return total


class Index(Postings):
    """The items by their words, and their questions by their trigrams."""

    def __init__(self, items: list[tuple[int, str]], min_words: int = MIN_WORDS, block: int = BLOCK):
        split = [(i, text, words_of(text)) for i, text in sorted(items)]
        split = [(i, text, words) for i, text, words in split if len(words) >= min_words]
        self.ids = [i for i, _, _ in split]
        halves = [tuple(map(words_of, question_and_answer(text))) for _, text, _ in split]
        self.parts = [tuple(map(trigrams, own)) for own in halves]
        self.brief = [len(question) < min_words for question, _ in halves]
        counts = [Counter(words) for _, _, words in split]
        lengths = [len(words) for _, _, words in split]
        mean = sum(lengths) / max(1, len(lengths))
        df = Counter(t for c in counts for t in c)
        idf = {t: math.log(1 + (len(split) - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for item, (count, length) in enumerate(zip(counts, lengths, strict=True)):
            own = {t: idf[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * length / mean)) for t, n in count.items()}
            whole = sum(own.values())
            for t, impact in own.items():
                postings[t].append((item, impact / whole))
        super().__init__(postings, len(split), block, max([LEAST_CELL, *lengths]))
        # a trigram's number comes from its first two words' number and its last word's
        number = {t: n for n, t in enumerate(self.terms)}
        entries = [p[0] if len(own[0]) > 2 else p[1] for p, own in zip(self.parts, halves, strict=True)]
        entries = [[[number[w] for w in gram] for gram in part if len(gram) == 3] for part in entries]
        self.pairs = np.unique(np.asarray([a * len(number) + b for part in entries for a, b, _ in part], np.int64))
        pair = {code: n for n, code in enumerate(self.pairs.tolist())}
        by_gram: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for item, part in enumerate(entries):
            for a, b, c in part:
                by_gram[pair[a * len(number) + b] * len(number) + c].append((item, 1 / len(part)))
        self.grams = Postings(by_gram, len(split), block, self.cell)
        self.triples = np.asarray(self.grams.terms, np.int64)

    def gram_numbers(self, numbers: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """For each word the number of the trigram that begins with it, or -1."""
        found = np.full(len(numbers), -1, np.int64)
        inside = numbers >= 0
        ends = upto[1:]
        for back in (1, 2):  # nothing goes over the end of a text
            inside[ends[ends >= back] - back] = False
        at = np.flatnonzero(inside)
        for further, codes in ((1, self.pairs), (2, self.triples)):
            at = at[numbers[at + further] >= 0]
            code = (numbers if further == 1 else found)[at] * len(self.terms) + numbers[at + further]
            place = np.searchsorted(codes, code)
            hit = place < len(codes)
            hit[hit] = codes[place[hit]] == code[hit]
            at = at[hit]
            found[:] = -1
            found[at] = place[hit]
        return found


def block_max_wand(index: Postings, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All items whose impacts for the terms sum to the threshold or more."""
    lists = [(index.items[t], index.impacts[t], float(index.greatest[t]), index.in_block[t]) for t in terms]
    at = [0] * len(lists)
    found = []
    end = index.count

    def current(k: int) -> int:
        return lists[k][0][at[k]] if at[k] < len(lists[k][0]) else end

    def forward(k: int, item: int) -> None:
        own, i = lists[k][0], at[k]
        while i < len(own) and own[i] < item:
            i += 1
        at[k] = i

    live = list(range(len(lists)))
    while True:
        live = sorted((k for k in live if at[k] < len(lists[k][0])), key=current)
        bound, pivot = 0.0, -1
        for n, k in enumerate(live):
            bound += lists[k][2]
            if bound >= threshold - 1e-9:
                pivot = n
                break
        if pivot < 0:
            return found
        item = current(live[pivot])
        while pivot + 1 < len(live) and current(live[pivot + 1]) == item:
            pivot += 1
        before, block = live[: pivot + 1], item // index.block
        if sum(lists[k][3].get(block, 0.0) for k in before) < threshold - 1e-9:
            # nothing in this block: on to the next one, or to where another list begins
            target = (block + 1) * index.block
            if pivot + 1 < len(live):
                target = min(target, current(live[pivot + 1]))
            for k in before:
                forward(k, max(target, item + 1))
        elif current(live[0]) == item:
            score = sum(lists[k][1][at[k]] for k in before)
            if score >= threshold - 1e-9:
                found.append((item, score))
            for k in before:
                at[k] += 1
        else:
            for k in before:
                forward(k, item)


def passages_to_search(index: Postings, numbers: np.ndarray, upto: np.ndarray, threshold: float) -> np.ndarray:
    """Rows (text, first cell) of passages that may reach the threshold in some block.

    ``numbers`` are the terms of all words, -1 for others, ``upto`` where each text's words begin and end.
    """
    counts = np.diff(upto)
    cells = np.maximum(1, -(-counts // index.cell))
    first = np.cumsum(cells) - cells  # cells of all texts are numbered through
    total = int(cells.sum())
    text = np.repeat(np.arange(len(counts)), cells)
    # a passage is a cell and the next one of its text; the last cell of a longer text starts none
    followed = np.append(text[1:] == text[:-1], False)
    starts = followed | (cells[text] == 1)
    cell = np.repeat(first, counts) + ramps(counts) // index.cell
    known = numbers >= 0
    cell, numbers = cell[known], numbers[known]
    second = np.append(False, followed[:-1])[cell]  # the cell is the second one of a passage too
    passage = np.concatenate([cell, cell[second] - 1])
    keys = np.unique(passage * len(index.terms) + np.concatenate([numbers, numbers[second]]))
    passage, term = keys // len(index.terms), keys % len(index.terms)
    taken = starts[passage]
    passage, term = passage[taken], term[taken]
    present, passage = np.unique(passage, return_inverse=True)  # those without any term reach nothing
    total = len(present)
    wide = index.column[term] >= 0
    found = []
    step = max(1, CELLS_AT_ONCE // max(1, index.blocks))
    cuts = np.searchsorted(passage, np.arange(0, total + step, step))
    for at, a, b in zip(range(0, total, step), cuts[:-1].tolist(), cuts[1:].tolist(), strict=False):
        own, what, dense = passage[a:b] - at, term[a:b], wide[a:b]
        rows = min(step, total - at)
        has = np.zeros((rows, len(index.wide_tops)), np.float32)
        has[own[dense], index.column[what[dense]]] = 1
        own, what = own[~dense], what[~dense]
        many = index.many[what]
        entry = np.repeat(index.begin[what], many) + ramps(many)
        place = np.repeat(own, many) * index.blocks + index.block_of[entry]
        bounds = np.bincount(place, weights=index.block_top[entry], minlength=rows * index.blocks).reshape(rows, index.blocks)
        found.append(at + np.flatnonzero((bounds + has @ index.wide_tops).max(axis=1) >= threshold - 1e-5))
    taken = present[np.concatenate(found)] if found else np.empty(0, np.int64)
    return np.stack([text[taken], taken - first[text[taken]]], axis=1)


def shares(index: Index, item: int, seen: set[tuple[str, ...]], words: list[str]) -> tuple[float, float]:
    """How much of the question's and of the answer's trigrams a passage has; 1 for a part without words."""
    out = []
    for part in index.parts[item]:
        short = part and len(next(iter(part))) < 3
        have = {tuple(words[i : i + len(next(iter(part)))]) for i in range(len(words))} if short else seen
        out.append(len(part & have) / len(part) if part else 1.0)
    return out[0], out[1]


def numbered(terms: pa.Array, values: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words, where each text's words begin and end, and the words' term numbers."""
    lists = word_lists(pc.fill_null(values, ""))
    upto = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    return flat, upto - upto[0], pc.fill_null(pc.index_in(flat, terms), -1).to_numpy().astype(np.int64)


def span(index: Postings, upto: np.ndarray, row: int, cell: int) -> tuple[int, int]:
    """The words of a passage."""
    a = int(upto[row]) + cell * index.cell
    return a, min(int(upto[row + 1]), a + 2 * index.cell)


def retrieved(index: Postings, numbers: np.ndarray, upto: np.ndarray, threshold: float) -> dict[tuple[int, int], dict[int, float]]:
    """By row and cell of a passage, the items it retrieves and their scores."""
    found = {}
    for row, cell in passages_to_search(index, numbers, upto, threshold).tolist() if index.terms else ():
        a, b = span(index, upto, row, cell)
        asked = np.unique(numbers[a:b])
        if items := dict(block_max_wand(index, asked[asked >= 0].tolist(), threshold)):
            found[row, cell] = items
    return found


def verified(index: Index, flat: pa.Array, upto: np.ndarray, found: dict[tuple[int, int], dict[int, float]]) -> Iterator[tuple[int, int, int, float, float, float]]:
    """(row, item, start, score, question_share, answer_share) of what was retrieved."""
    for (row, cell), items in found.items():
        a, b = span(index, upto, row, cell)
        words = flat[a:b].to_pylist()
        seen = trigrams(words)
        for i, score in items.items():
            yield row, i, cell * index.cell, score, *shares(index, i, seen, words)


def hits_in(index: Index, terms: pa.Array, values: pa.Array, threshold: float) -> list[tuple[int, int, int, float, float, float]]:
    """(row, item_id, start, score, question_share, answer_share) of every passage and item it retrieves by the item's score."""
    flat, upto, numbers = numbered(terms, values)
    return [(row, index.ids[i], *more) for row, i, *more in verified(index, flat, upto, retrieved(index, numbers, upto, threshold))]


def candidates_in(index: Index, terms: pa.Array, values: pa.Array, threshold: float) -> list[tuple[int, int, int, float, float, float]]:
    """The same of every passage and item it retrieves by the item's score or by the question's trigrams."""
    flat, upto, numbers = numbered(terms, values)
    found = retrieved(index, numbers, upto, threshold)
    out = [(row, index.ids[i], *more) for row, i, *more in verified(index, flat, upto, found)]
    more: dict[tuple[int, int], dict[int, float]] = {}
    for place, items in retrieved(index.grams, index.gram_numbers(numbers, upto), upto, OVERLAP).items():
        if new := items.keys() - found.get(place, {}).keys():
            a, b = span(index, upto, *place)
            asked = np.unique(numbers[a:b])
            asked = asked[asked >= 0].tolist()
            more[place] = {i: index.score(i, asked) for i in sorted(new)}
    for row, i, start, score, question, answer in verified(index, flat, upto, more):
        if not index.brief[i] or (question >= OVERLAP and answer >= OVERLAP):
            out.append((row, index.ids[i], start, score, question, answer))
    return out


def is_leak(question: float, answer: float) -> bool:
    return (question >= OVERLAP and answer >= OVERLAP) or question >= ALONE


def build_index(items: DataFrame, min_words: int = MIN_WORDS, max_bytes: int = MAX_BYTES) -> Index:
    items = items.filter("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"the items have {size} bytes; search for at most {max_bytes} at a time")
    return Index([(r.item_id, r.text) for r in items.toLocalIterator()], min_words)


def search(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, **options: int) -> DataFrame:
    """doc_id, item_id, start (word the passage begins at), score, question_share, answer_share, leaked: every retrieved pair, best passage."""
    shared = docs.sparkSession.sparkContext.broadcast(build_index(items, **options))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        terms = pa.array(index.terms, pa.string())
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                row, *more = list(zip(*candidates_in(index, terms, some.column(1), threshold), strict=True)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                columns = [some.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, k) for c, k in zip(more, kinds, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "start", "score", "question_share", "answer_share"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = texts(docs).mapInArrow(hits, f"doc_id {kind}, item_id long, start long, score double, question_share double, answer_share double")
    question, answer = F.col("question_share"), F.col("answer_share")
    leaked = ((question >= OVERLAP) & (answer >= OVERLAP)) | (question >= ALONE)
    best = F.max(F.struct(leaked.alias("leaked"), "score", (-F.col("start")).alias("back"), question, answer))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", (-F.col("best.back")).alias("start"), "best.score", "best.question_share", "best.answer_share", "best.leaked"
    )


def leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The verified pairs."""
    return search(docs, items, **options).filter("leaked").drop("leaked")


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, **options: int) -> DataFrame:
    """Rows of ``docs``, with all their columns, that no item is found in; decided where they are scanned."""
    shared = docs.sparkSession.sparkContext.broadcast(build_index(items, **options))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        terms = pa.array(index.terms, pa.string())
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                keep = np.ones(some.num_rows, bool)
                values = some.column(some.schema.get_field_index("text"))
                keep[[row for row, _, _, _, q, a in candidates_in(index, terms, values, threshold) if is_leak(q, a)]] = False
                yield some.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)
