"""Best-two-fit packing of token sequences.

Documents become token ids, an end token is added, and what exceeds the capacity
is cut into full pieces (the first piece takes the remainder).  The pieces are
then packed into sequences:

* fill a sequence greedily with the longest piece that still fits;
* when nothing fits any more, take out its smallest piece and look for two
  unpacked pieces that fill the larger gap better.

Only lengths matter for that, so the decisions are made once, on the counts of
the at most ``capacity`` different lengths; equal fillings are decided together.
What comes out is a table of slots by length.  Each piece finds its slot by its
rank among the pieces of its length.  Neither the driver nor any task sees more
than the counts, and the result does not depend on how the input is partitioned,
beyond which of several equally long pieces takes which slot.

A text that holds an added token of the vocabulary file, such as <|endoftext|>, has
that token's id there.  Null text counts as empty (one end token).  An empty table gives an empty result.
Repeated rows are packed like any others.  Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tenantry.llm.common import ramps, slices, texts
from tenantry.state import materialize

CAPACITY = 2048
END_ID = 0
#: Bytes of text that are tokenized at once.
SLICE_BYTES = 1 << 20
#: Fixed: how a byte-level vocabulary cuts text before its merges.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space at an end of the text, or two side by side.
_SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LOOSE_SPACE = rf"\A{_SPACE}|{_SPACE}\z|{_SPACE}{{2}}"

PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, part int, nth long"


def byte_level_ranks(path: str) -> dict[bytes, int]:
    """Bytes and id of each token of a byte-level vocabulary file.

    Such files write a printable byte as itself and the others, in order, as characters from 256 on.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in content.get("added_tokens", ())}
    return {bytes(map(to_byte.__getitem__, token)): i for token, i in content["model"]["vocab"].items() if token not in special}


def added_tokens(path: str) -> list[str]:
    """The texts that a vocabulary file reads as one token each, wherever they stand."""
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file).get("added_tokens", ())]


class Encoder:
    """Token ids of many texts, with each different word of a batch encoded once; ``batch`` reads added tokens like other text.

    A byte-level vocabulary never joins what stands before a single space with
    what follows, so a text may be cut there, if no other white space is beside
    that space.  Texts with other white space are encoded whole.
    """

    def __init__(self, path: str):
        ranks = byte_level_ranks(path)
        self.encoding = tiktoken.Encoding(path, pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.path, self.added, self.reference = path, added_tokens(path), None

    def ids(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``batch``, but a text with an added token in it is read by the tokenizer itself, which gives that token its id."""
        marked = np.zeros(len(values), bool)
        for content in self.added:
            marked |= pc.match_substring(values, content).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self.batch(values)
        self.reference = self.reference or Tokenizer.from_file(self.path)
        lengths, parts = np.zeros(len(values), np.int64), [np.empty(0, np.uint32)] * len(values)
        others = np.flatnonzero(~marked)
        tokens, lengths[others] = self.batch(values.take(pa.array(others)))
        for i, own in zip(others.tolist(), np.split(tokens, np.cumsum(lengths[others])[:-1]), strict=False):
            parts[i] = own
        for i in np.flatnonzero(marked).tolist():
            parts[i] = np.asarray(self.reference.encode(values[i].as_py(), add_special_tokens=False).ids, np.uint32)
            lengths[i] = len(parts[i])
        return np.concatenate(parts), lengths

    def plain(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_to_numpy(text, disallowed_special=()), np.uint32)

    def batch(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of each text."""
        loose = pc.match_substring_regex(values, LOOSE_SPACE).to_numpy(zero_copy_only=False)
        whole = loose | (pc.binary_length(values).to_numpy(zero_copy_only=False) == 0)
        if whole.any():
            lengths, parts = np.zeros(len(values), np.int64), [np.empty(0, np.uint32)] * len(values)
            tight = np.flatnonzero(~whole)
            tokens, sizes = self.spaced_words(values.take(pa.array(tight)))
            lengths[tight] = sizes
            for i, own in zip(tight.tolist(), np.split(tokens, np.cumsum(sizes)[:-1]), strict=False):
                parts[i] = own
            for i in np.flatnonzero(whole).tolist():
                parts[i] = self.plain(values[i].as_py())
                lengths[i] = len(parts[i])
            return np.concatenate([*parts, np.empty(0, np.uint32)]), lengths
        return self.spaced_words(values)

    def spaced_words(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts whose spaces stand alone between words."""
        if not len(values):
            return np.empty(0, np.uint32), np.zeros(0, np.int64)
        split = pc.split_pattern(values, " ")
        upto = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        place, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(names)], names), " ")[0].as_py()
        flat = self.plain(" " + joined)
        begin = np.flatnonzero(self.spaced[flat])  # each word brings its space
        # the first word of a text has no space before it
        starts = upto[:-1]
        firsts, turned = np.unique(place[starts], return_inverse=True)
        bare = [self.plain(names[i].as_py()) for i in firsts.tolist()]
        sizes = np.concatenate([np.diff(np.append(begin, len(flat))), np.fromiter(map(len, bare), np.int64, len(bare))])
        flat = np.concatenate([flat, *bare])
        begin = np.cumsum(sizes) - sizes
        place[starts] = len(names) + turned
        taken = sizes[place]
        tokens = flat[np.repeat(begin[place], taken) + ramps(taken)]
        ends = np.concatenate([[0], np.cumsum(taken)])
        return tokens, ends[upto[1:]] - ends[upto[:-1]]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """The pieces of all documents; ``ids``, little-endian unsigned 32-bit numbers, only on request.

    ``part`` and ``nth`` number the pieces of one length within one task.  They
    are only meaningful in a written table, where they cannot change any more.
    """

    schema = PIECES if with_ids else PIECES.replace("ids binary, ", "")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, used = Encoder(tokenizer), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                tokens, lengths = encoder.ids(some.column(1))
                lengths = lengths + 1
                ends = np.cumsum(lengths)
                closed = np.full(int(ends[-1]), end_id, "<u4")
                closed[np.arange(len(tokens)) + np.repeat(np.arange(len(lengths)), lengths - 1)] = tokens
                del tokens
                raw = memoryview(closed.view(np.uint8))
                number = -(-lengths // capacity)
                row, piece = np.repeat(np.arange(len(lengths)), number), ramps(number)
                first = lengths - (number - 1) * capacity
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[row], capacity)
                at = (ends - lengths)[row] + start
                spans = [(4 * a, 4 * (a + n)) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                checks = pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64())
                ids = [pa.array([raw[a:b].tobytes() for a, b in spans], pa.binary())] if with_ids else []
                del raw, closed
                nth = np.empty(len(length), np.int64)
                order = np.argsort(length, kind="stable")
                _, head, many = np.unique(length[order], return_index=True, return_counts=True)
                nth[order] = np.arange(len(order)) - np.repeat(head, many) + used[length[order]]
                used += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).cast(pa.int64()).take(pa.array(row)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        *ids,
                        checks,
                        pa.array(np.full(len(row), part), pa.int32()),
                        pa.array(nth, pa.int64()),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return texts(docs).mapInArrow(pieces, schema)


def fillings(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """How many sequences take which (length, number) pairs; every piece is in exactly one."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    made = []

    def greedy(gap: int, taken: dict[int, int]) -> int:
        at = bisect_right(lengths, gap) - 1
        while at >= 0:
            n = lengths[at]
            some = min(gap // n, left[n] - taken.get(n, 0))
            if some:
                taken[n] = taken.get(n, 0) + some
                gap -= some * n
            at = min(at - 1, bisect_right(lengths, gap) - 1)
        return gap

    def free(taken: dict[int, int], n: int) -> int:
        return left.get(n, 0) - taken.get(n, 0)

    def two(wide: int, least: int, taken: dict[int, int]) -> tuple[int, int] | None:
        """Two free pieces of together more than ``least`` and at most ``wide``, as long as possible."""
        open_ = [n for n in lengths if n < wide and free(taken, n) > 0]
        best, pair, high = least, None, len(open_) - 1
        for low, a in enumerate(open_):
            while high >= low and a + open_[high] > wide:
                high -= 1
            if high < low:
                break
            b = high if high > low or free(taken, a) > 1 else -1
            if b >= 0 and a + open_[b] > best:
                best, pair = a + open_[b], (a, open_[b])
        return pair

    while lengths:
        taken: dict[int, int] = {}
        gap = greedy(capacity, taken)
        if gap:
            smallest = min(taken)
            if pair := two(gap + smallest, smallest, taken):
                taken[smallest] -= 1
                for n in pair:
                    taken[n] = taken.get(n, 0) + 1
        taken = {n: c for n, c in taken.items() if c}
        times = min(left[n] // c for n, c in taken.items())
        made.append((times, sorted(taken.items(), reverse=True)))
        for n, c in taken.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
                lengths.remove(n)
    return made


def slot_table(made: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length: rows of first rank, first sequence, place in the sequence, pieces of that length in each sequence."""
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, lengths in made:
        place = 0
        for n, c in lengths:
            slots.setdefault(n, []).append((ranks.get(n, 0), sequence, place, c))
            ranks[n] = ranks.get(n, 0) + c * times
            place += n * c
        sequence += times
    return {n: np.asarray(rows, np.int64) for n, rows in slots.items()}


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with length, part and nth) with sequence_id and offset."""
    sizes = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("many"))
    before = F.sum("many").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(F.col("part").alias("p"), F.col("length").alias("l"), F.coalesce(before, F.lit(0)).alias("before"))
    # at most ``capacity`` rows, whatever the input
    counts = {r.length: r.many for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("many")).collect()}
    slots = slot_table(fillings(counts, capacity))
    ranked = pieces.join(offsets, (F.col("part") == F.col("p")) & (F.col("length") == F.col("l"))).withColumn("rank", F.col("nth") + F.col("before"))
    columns = [c for c in pieces.columns if c not in ("part", "nth")]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for n in np.unique(length).tolist():
                mine = np.flatnonzero(length == n)
                rows = slots[n]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], side="right") - 1]
                inside = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 1] + inside // row[:, 3]
                offset[mine] = row[:, 2] + inside % row[:, 3] * n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in columns)
    return ranked.select(*columns, "rank").mapInArrow(placed, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset: one row per piece; ``ids`` only on request."""
    return place_pieces(materialize(token_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces"), capacity)
