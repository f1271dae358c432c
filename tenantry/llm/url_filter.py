"""URL rules and block lists probed in a sorted digest array.

The entries of all lists become one array: 64-bit xxhash digests in ascending
order, and beside it the entries' full strings.  The array is written to files
once, ``addFile`` brings them to every executor (also to one that starts
later), and tasks map them into memory, so that workers of one machine share the
pages and only what is probed is read.  A batch of URLs is probed by a
vectorised binary search; a digest that is found counts only if one of the
strings stored under it is the string asked for.

An entry is a host, or a host and the beginning of a path.  It fits that host
and its subdomains.  The longest rule that fits decides; without one, an entry of
the block list does; else the URL is allowed.

Null URLs, and those without ``://``, have empty host and path and are allowed.
Empty tables, repeated rows and extra columns need nothing special: rows are
judged one by one.  If a rule and a list entry are equal, the rule counts; of two
equal rules, ``block`` does.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (rule, verdict)
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Host labels of the block list.
SPAM_LABELS = ("ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x")
LISTED, ALLOWING, BLOCKING = 0, 1, 2
#: Spark's xxhash64 starts from this seed.
SEED = 42
#: The array goes to every executor's disk; a list beyond this is refused.
MAX_BYTES = 4 << 30


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


class DigestArray:
    """Sorted digests, the ends of the strings they stand for, one code per string, and the strings, in one file."""

    def __init__(self, path: str, digest: Callable[[bytes], int] | None = None):
        size = int(np.fromfile(path, np.int64, 1)[0])
        whole = np.memmap(path, np.uint8, "r")
        self.keys, self.ends = whole[8 : 8 + 8 * size].view(np.int64), whole[8 + 8 * size : 8 + 16 * size].view(np.int64)
        self.codes, self.strings = whole[8 + 16 * size : 8 + 17 * size], whole[8 + 17 * size :]
        self.digest = digest or digest64

    def string(self, at: int) -> bytes:
        return self.strings[self.ends[at - 1] if at else 0 : self.ends[at]].tobytes()

    def find(self, wanted: list[bytes]) -> np.ndarray:
        """The code of each string, or -1."""
        asked = np.fromiter(map(self.digest, wanted), np.int64, len(wanted))
        first, last = np.searchsorted(self.keys, asked, "left"), np.searchsorted(self.keys, asked, "right")
        found = np.full(len(wanted), -1, np.int16)
        for i in np.flatnonzero(first < last).tolist():
            for at in range(first[i], last[i]):  # several strings may share a digest
                if self.string(at) == wanted[i]:
                    found[i] = max(found[i], self.codes[at])
        return found


def digest64(value: bytes) -> int:
    got = xxhash.xxh64_intdigest(value, SEED)
    return got - (1 << 64) if got >> 63 else got


def write_array(rows: Iterator[tuple[int, str, int]], path: str, max_bytes: int = MAX_BYTES) -> None:
    """The file of a DigestArray from (digest, string, code) rows in order; one row at a time is in memory."""
    end = size = 0
    with contextlib.ExitStack() as open_files:
        keys, ends, codes, strings = (open_files.enter_context(tempfile.TemporaryFile(dir=os.path.dirname(path))) for _ in range(4))
        for digest, string, code in rows:
            raw = string.encode()
            end, size = end + len(raw), size + 1
            keys.write(np.int64(digest).tobytes())
            ends.write(np.int64(end).tobytes())
            codes.write(bytes([code]))
            strings.write(raw)
            if end > max_bytes:
                raise ValueError(f"the list has more than {max_bytes} bytes; split the URLs' job by host first")
        with open(path, "wb") as out:
            out.write(np.int64(size).tobytes())
            for part in (keys, ends, codes, strings):
                part.seek(0)
                shutil.copyfileobj(part, out)


def publish(spark: SparkSession, entries: DataFrame, max_bytes: int = MAX_BYTES) -> str:
    """The array of ``entries`` (entry, code) on every executor; returns the name tasks find it by.

    The driver keeps its copy until it ends, for executors that start later.
    """
    name = f"digests-{uuid.uuid4().hex}"
    folder = tempfile.mkdtemp(prefix="digests-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    ordered = entries.distinct().select(F.xxhash64("entry").alias("digest"), "entry", "code").orderBy("digest", "entry", "code")
    write_array((tuple(r) for r in ordered.toLocalIterator()), f"{folder}/{name}", max_bytes)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Everything that could fit: the host and its parents, each with beginnings of the path."""
    found, labels = [], host
    while labels:
        found += [labels + path[:n] for n in lengths if n <= len(path)]
        _, _, labels = labels.partition(".")
    return found


def filter_urls(pages: DataFrame, blocked_hosts: DataFrame, rules=RULES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, url, host, path, rule, verdict and whether the host is ``listed``.

    ``blocked_hosts`` has one column ``host``.
    """
    spark = pages.sparkSession
    named = spark.createDataFrame([(r, BLOCKING if v == "block" else ALLOWING) for r, v in rules] or [], "entry string, code int")
    listed = blocked_hosts.select(F.col("host").alias("entry"), F.lit(LISTED).alias("code")).filter("entry <> ''")
    name = publish(spark, named.unionByName(listed), max_bytes)
    lengths = sorted({0, *(len(r) - len(r.partition("/")[0]) for r, _ in rules)})
    verdicts = {ALLOWING: "allow", BLOCKING: "block"}

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            longest = max(lengths)
            seen: dict[tuple[str, str], int] = {}
            turn = [seen.setdefault((h, p[:longest]), len(seen)) for h, p in zip(hosts, paths, strict=True)]
            asked = [candidates(h, p, lengths) for h, p in seen]
            codes = iter(array.find([c.encode() for some in asked for c in some]).tolist())
            rule, verdict, is_listed = [], [], []
            for some in asked:
                hits = [(c, code) for c in some if (code := next(codes)) >= 0]
                ruling = max(((len(c), c, code) for c, code in hits if code != LISTED), default=None)
                is_listed.append(any(code == LISTED for _, code in hits))
                rule.append(ruling[1] if ruling else None)
                verdict.append(verdicts[ruling[2]] if ruling else "block" if is_listed[-1] else "allow")
            place = pa.array(turn, pa.int64())
            more = [pa.array(x, k).take(place) for x, k in ((rule, pa.string()), (verdict, pa.string()), (is_listed, pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "rule", "verdict", "listed"])

    url = F.col("url")
    parts = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return parts.mapInArrow(judged, f"page_id {kind}, url string, host string, path string, rule string, verdict string, listed boolean")


def spam_hosts(pages: DataFrame, labels=SPAM_LABELS) -> DataFrame:
    """The hosts of ``pages`` with one of the labels."""
    host = host_of(F.col("url"))
    return pages.select(host.alias("host")).filter(F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, labels)))).distinct()
