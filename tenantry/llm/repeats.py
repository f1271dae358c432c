"""What removing repeated passages needs in common, whatever a passage's unit is.

Documents are packed into chunks, and four passes find the windows that occur
more than once without comparing documents:

1. every window has a key, the least hash of the short grams inside it.  Equal
   windows have equal keys, and neighbours mostly share theirs.  Each chunk
   reports its different keys once, however often it has them;
2. keys that two chunks (or one chunk twice) report come back to those chunks;
3. a chunk cuts out the runs of neighbouring windows that share such a key, as
   segments, each different segment once.  Segments go to shards by key, so that
   equal windows meet in one shard, and there an exact index judges each window;
4. the verdicts come back to the chunk, which takes out what is covered.

A key that is everywhere costs one entry per chunk, not one per document, and
so does a segment.  Keys only bring windows together; nothing is decided by a
hash.  Chunks are written once, to the shared folder, so that their numbers stay
what they are if a task is run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantry.llm.common import ramps, slices, texts
from tenantry.state import materialize

#: Text bytes of a chunk, and text bytes per shard of keys and segments.
CHUNK_BYTES = 2 << 20
SHARD_BYTES = 2 << 20

#: Stands for a null id; real ids are greater.
NO_ID = -(1 << 63)


class Chunk:
    """Documents in a row: their ids, and their UTF-8 bytes one after the other."""

    def __init__(self, blob: bytes):
        batch = pa.ipc.open_stream(zstandard.decompress(blob)).read_next_batch()
        self.carried = {n: batch.column(n) for n in batch.schema.names[2:]}
        self.ids = batch.column(0).to_numpy(zero_copy_only=False)
        text = batch.column(1)
        offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 0)
        self.ends = (offsets - offsets[0])[1:]
        self.starts = (offsets - offsets[0])[:-1]
        self.raw = bytes(text.buffers()[2] or b"")[offsets[0] : offsets[-1]]

    @staticmethod
    def packed(batch: pa.RecordBatch) -> bytes:
        sink = pa.BufferOutputStream()
        own = [pa.concat_arrays([batch.column(0).cast(pa.int64())]), pa.concat_arrays([batch.column(1).cast(pa.large_string())]), *batch.columns[2:]]
        own = pa.RecordBatch.from_arrays(own, names=batch.schema.names)
        with pa.ipc.new_stream(sink, own.schema) as writer:
            writer.write_batch(own)
        return zstandard.ZstdCompressor(3).compress(sink.getvalue().to_pybytes())

    def documents(self) -> list[bytes]:
        return [self.raw[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]


class Runs:
    """Runs of neighbouring windows with one key: the key, the document, the first window and the one after the last."""

    def __init__(self, keys: np.ndarray, docs: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.keys, self.docs, self.first, self.last = keys, docs, first, last


class Method(Protocol):
    """What differs between units and indexes."""

    schema: str

    def runs(self, chunk: Chunk) -> Runs: ...

    def keys(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The chunk's different keys in order, and which of them it has in two places that matter."""

    def segment(self, chunk: Chunk, first: int, last: int) -> bytes: ...

    def value(self, chunk: Chunk, doc: int) -> int:
        """What a shard must know about an occurrence of a segment."""

    def merged(self, a: int, b: int) -> int: ...

    def judged(self, segments: list[bytes], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each segment the number of its windows, and one number per window."""

    def flagged(self, judged: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Which windows of an occurrence with its own value go."""

    def result(self, chunk: Chunk, runs: Runs, mine: np.ndarray, which: np.ndarray, values: np.ndarray, begins: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
        """A row per document.  Runs ``mine`` have the segments ``which``, whose window flags begin at ``begins``."""


def sliding(op: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every ``width`` neighbours."""
    out, step = values, 1
    while 2 * step <= width:
        out = op(out[:-step], out[step:])
        step *= 2
    return op(out[: len(out) - (width - step)], out[width - step :]) if width > step else out


def runs_of(keys: np.ndarray, valid: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and the one after the last of each run of valid windows with one key in one document."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    change = np.ones(len(keys), bool)
    change[1:] = (keys[1:] != keys[:-1]) | (valid[1:] != valid[:-1])
    change[doc_starts[doc_starts < len(keys)]] = True
    cuts = np.append(np.flatnonzero(change), len(keys))
    taken = valid[cuts[:-1]]
    return cuts[:-1][taken], cuts[1:][taken]


def windows_of(runs: Runs, mine: np.ndarray, which: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each window of the runs ``mine``: its place, the place of its flag, and which of those runs it is in."""
    sizes = (runs.last - runs.first)[mine]
    inside = ramps(sizes)
    return np.repeat(runs.first[mine], sizes) + inside, np.repeat(begins[which], sizes) + inside, np.repeat(np.arange(len(mine)), sizes)


def covered(total: int, windows: np.ndarray, length: int) -> np.ndarray:
    """Which of ``total`` places are inside a window."""
    edges = np.zeros(total + 1, np.int32)
    np.add.at(edges, windows, 1)
    np.add.at(edges, windows + length, -1)
    return np.cumsum(edges, dtype=np.int32)[:-1] > 0


def spans_of(gone: np.ndarray) -> list[dict[str, int]]:
    steps = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
    return [{"start": a, "stop": b} for a, b in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist(), strict=True)]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def spread(keys: np.ndarray) -> np.ndarray:
    """Other numbers for the keys, one for one: the least of many hashes are small, and shards are ranges of keys."""
    return (keys ^ keys >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def different(keys: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order; a key is marked where ``twice`` marks one of its rows."""
    order = np.argsort(keys, kind="stable")
    keys, twice = keys[order], twice[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[heads], np.logical_or.reduceat(twice, heads) if len(heads) else np.empty(0, bool)


def shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards in the order of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def pack_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[pa.RecordBatch] = []
        size = 0

        def row() -> pa.RecordBatch:
            blob = Chunk.packed(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), pa.array([blob], pa.binary())], names=["chunk", "bytes", "blob"])

        for batch in batches:
            for some in slices(batch, "text", chunk_bytes // 4):
                waiting.append(some)
                size += some.nbytes
                if size >= chunk_bytes:
                    yield row()
                    waiting, size, number = [], 0, number + 1
        if waiting:
            yield row()

    return materialize(texts(docs, *carry).mapInArrow(packed, "chunk long, bytes long, blob binary"), "chunks")


def _table(names: str, columns: list, kinds: list) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names.split())


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """For keys in order: each shard and its part of them."""
    of = shards_of(keys, shards)
    if not len(of):
        return
    heads = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(of)], strict=True):
        yield int(of[a]), slice(a, b)


def chunk_keys(chunks: DataFrame, method: Method, shards: int) -> DataFrame:
    """Pass 1: shard, chunk, and the chunk's keys there; the lowest bit of a key says whether the chunk has it twice."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys, twice = method.keys(Chunk(blob.as_buffer().to_pybytes()))
                marked = (keys & ~np.uint64(1)) | twice
                rows = [(s, number, marked[part].tobytes()) for s, part in _by_shard(keys, shards)]
                if rows:
                    yield _table("shard chunk keys", list(zip(*rows, strict=True)), [pa.int32(), pa.int64(), pa.binary()]).to_batches()[0]

    return chunks.select("chunk", "blob").mapInArrow(keyed, "shard int, chunk long, keys binary")


def shared_keys(keys: DataFrame) -> DataFrame:
    """Pass 2: for each chunk those of its keys that occur elsewhere too."""

    def shared(group: pa.Table) -> pa.Table:
        numbers, blobs = group.column("chunk").to_pylist(), group.column("keys").to_pylist()
        each = [np.frombuffer(b, np.uint64) for b in blobs]
        marked = np.concatenate(each)
        bare = marked & ~np.uint64(1)
        order = np.argsort(bare, kind="stable")
        ordered = bare[order]
        same = ordered[1:] == ordered[:-1]
        again = np.zeros(len(bare), bool)
        again[order] = np.append(same, False) | np.append(False, same)
        again |= (marked & np.uint64(1)).astype(bool)
        ends = np.cumsum([len(e) for e in each])
        rows = [(n, bare[b - len(e) : b][again[b - len(e) : b]].tobytes()) for n, e, b in zip(numbers, each, ends.tolist(), strict=True)]
        rows = [r for r in rows if r[1]]
        return _table("chunk keys", list(zip(*rows, strict=True)) or [[], []], [pa.int64(), pa.binary()])

    return keys.groupBy("shard").applyInArrow(shared, "chunk long, keys binary")


def _segments(method: Method, chunk: Chunk, shared: np.ndarray) -> tuple[Runs, np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """The chunk's runs whose key is shared, and its different segments in the order of their keys, with their values."""
    runs = method.runs(chunk)
    at = np.searchsorted(shared, runs.keys & ~np.uint64(1))
    mine = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == (runs.keys & ~np.uint64(1))) if len(shared) else np.empty(0, np.int64)
    mine = mine[np.argsort(runs.keys[mine], kind="stable")]
    known: dict[bytes, int] = {}
    which, values, keys = np.empty(len(mine), np.int64), [], []
    for i, (run, first, last, doc) in enumerate(zip(mine.tolist(), runs.first[mine].tolist(), runs.last[mine].tolist(), runs.docs[mine].tolist(), strict=True)):
        segment = method.segment(chunk, first, last)
        n = known.setdefault(segment, len(known))
        own = method.value(chunk, doc)
        if n == len(values):
            values.append(own)
            keys.append(run)
        else:
            values[n] = method.merged(values[n], own)
        which[i] = n
    return runs, mine, which, list(known), np.asarray(values, np.int64), runs.keys[np.asarray(keys, np.int64)]


def _joined(blobs: list[bytes]) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(blobs), np.uint64))


def chunk_segments(chunks: DataFrame, shared: DataFrame, method: Method, shards: int) -> DataFrame:
    """Pass 3: shard, chunk, and the chunk's different segments there."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        squeezer = zstandard.ZstdCompressor(1)
        for number, blob in zip(left.column("chunk").to_pylist(), left.column("blob").to_pylist(), strict=True):
            *_, segments, values, keys = _segments(method, Chunk(blob), _joined(right.column("keys").to_pylist()))
            for s, part in _by_shard(keys, shards):
                own = segments[part]
                rows.append((s, number, np.fromiter(map(len, own), np.uint32, len(own)).tobytes(), values[part].tobytes(), squeezer.compress(b"".join(own))))
        return _table("shard chunk lengths data_values data", list(zip(*rows, strict=True)) or [[]] * 5, [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])

    pairs = chunks.select("chunk", "blob").groupBy("chunk").cogroup(shared.groupBy("chunk"))
    return pairs.applyInArrow(cut, "shard int, chunk long, lengths binary, data_values binary, data binary")


def judge_segments(segments: DataFrame, method: Method) -> DataFrame:
    """Pass 3, in the shards: for each chunk the windows of its segments that go, as bits."""

    def judged(group: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        values: list[int] = []
        rows = []
        for number, lengths, own, data in zip(*(group.column(c).to_pylist() for c in ("chunk", "lengths", "data_values", "data")), strict=True):
            ends = np.cumsum(np.frombuffer(lengths, np.uint32), dtype=np.int64).tolist()
            own = np.frombuffer(own, np.int64)
            data = zstandard.decompress(data)
            places, a = [], 0
            for b, value in zip(ends, own.tolist(), strict=True):
                n = known.setdefault(data[a:b], len(known))
                if n == len(values):
                    values.append(value)
                else:
                    values[n] = method.merged(values[n], value)
                places.append(n)
                a = b
            rows.append((number, own, np.asarray(places, np.int64)))
        counts, verdicts = method.judged(list(known), np.asarray(values, np.int64))
        ends = np.cumsum(counts)
        out = []
        for number, own, places in rows:
            n = counts[places]
            picked = np.repeat(ends[places] - n, n) + ramps(n)
            flags = method.flagged(verdicts[picked], np.repeat(own, n))
            out.append((number, int(group.column("shard")[0].as_py()), np.packbits(flags).tobytes()))
        return _table("chunk shard flags", list(zip(*out, strict=True)), [pa.int64(), pa.int32(), pa.binary()])

    return segments.groupBy("shard").applyInArrow(judged, "chunk long, shard int, flags binary")


def remove_repeats(docs: DataFrame, method: Method, carry: tuple[str, ...] = (), chunk_bytes: int = CHUNK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document, as ``method.result`` makes it, and the columns ``carry`` of ``docs``.

    Null ids are one id that is smaller than all others; documents that share an id do not take from each other.
    """
    docs = docs.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    chunks = pack_chunks(docs, chunk_bytes, carry)
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    shared = materialize(shared_keys(chunk_keys(chunks, method, shards)), "shared")
    flags = judge_segments(chunk_segments(chunks, shared, method, shards), method)
    schema = ", ".join([method.schema, *(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in carry)])
    back = shared.select("chunk", "keys", F.lit(-1).alias("shard"), F.lit(None).cast("binary").alias("flags")).unionByName(
        flags.select("chunk", F.lit(None).cast("binary").alias("keys"), "shard", "flags")
    )

    def finished(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = _joined([k for k in right.column("keys").to_pylist() if k is not None])
        bits = {s: f for s, f in zip(right.column("shard").to_pylist(), right.column("flags").to_pylist(), strict=True) if f is not None}
        out = []
        for blob in left.column("blob").to_pylist():
            chunk = Chunk(blob)
            runs, mine, which, segments, values, seg_keys = _segments(method, chunk, keys)
            first_run = np.full(len(segments), -1, np.int64)
            first_run[which[::-1]] = mine[::-1]
            sizes = (runs.last - runs.first)[first_run] if len(segments) else np.empty(0, np.int64)
            flags = np.zeros(int(sizes.sum()), bool)
            ends = np.cumsum(sizes)
            for s, part in _by_shard(seg_keys, shards):
                a, b = int(ends[part.start] - sizes[part.start]), int(ends[part.stop - 1])
                flags[a:b] = np.unpackbits(np.frombuffer(bits[s], np.uint8), count=b - a)
            made = pa.Table.from_batches([method.result(chunk, runs, mine, which, values, ends - sizes, flags)])
            for name, column in chunk.carried.items():
                made = made.append_column(name, column)
            out.append(made)
        return pa.concat_tables(out)

    done = chunks.select("chunk", "blob").groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(finished, schema)
    return done.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
