"""Language identification that looks up words first and backs off to shorter and shorter character n-grams.

A word that training has seen scores its log frequency in each language.  A word it
has not seen is read as ``_word_``; the longest n-grams of which at least one is known
score in its place, as the mean over the known ones, and if none of any length is known
the word says nothing.  A text's language is the one with the highest mean over all its
words; the score is that language's share if the means are taken as evidence of one
word, exp(mean) of the best over the sum.  An entry that a language lacks has the same low
frequency in all languages.

The model is fitted on a bounded number of labelled texts (``sample_rows``), dealt out
evenly over the languages, all of which are read whole; counting is a distributed
aggregation.  It keeps the most frequent ``cells / languages`` entries of each kind, so
that it never exceeds a size that can be sent to all tasks.  Texts are scored where they
are scanned, without a shuffle, and each different word of a slice is looked up once.

Text that is null or has no letter is ``und`` with score 0, as is any text if nothing can be
learned.  A null doc_id is not held out.  Ties go to the first language in order.  Repeated rows
are scored alike, each by itself.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantry.llm.common import ramps, slices
from tenantry.state import materialize

UNKNOWN = "und"
#: The longest n-grams.
N = 5
#: Labelled texts that a model is fitted on, and cells (entries times languages) of each kind that it has at most.
SAMPLE_ROWS, CELLS = 20_000, 800_000
#: Longer words are not kept; their n-grams are.
WORD_BYTES = 64
#: Times that an entry counts in a language without it, out of the entries of the language with most of them, so that
#: languages with little text gain nothing.
UNSEEN = 0.1
SLICE_BYTES = 2 << 20

_NO_LETTERS = r"[^\p{L}\p{M}]+"


def held_out(doc_id: Column) -> Column:
    """One in three documents, by a hash of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def words_of(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts in small letters, one after the other, and the text of each."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(values, "")), _NO_LETTERS)
    words, text = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    real = pc.greater(pc.binary_length(words), 0)
    return words.filter(real), text[real.to_numpy(zero_copy_only=False)]


def grams_of(words: list[str], n: int) -> tuple[list[str], np.ndarray]:
    """The n-grams of each word with its ends marked, and which word each is from."""
    grams, owner = [], []
    for k, word in enumerate(words):
        marked = f"_{word}_"
        own = [marked[i : i + n] for i in range(len(marked) - n + 1)]
        grams += own
        owner += [k] * len(own)
    return grams, np.asarray(owner, np.int64)


def chosen(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """lang and text of at most ``sample_rows`` labelled texts that are not held out, the same number of each language.

    A draw by hash thins out each language to about twice its number before rows are ranked, so that no task gets
    all rows of a frequent one.  If there are more languages than rows, the most frequent ones are learned.
    """
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("doc_id"))).select(F.col("lang").cast("string").alias("lang"), "text")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(sample_rows).collect()
    if not sizes:
        return labelled.limit(0)
    each = sample_rows // len(sizes)
    shares = docs.sparkSession.createDataFrame([(r.lang, min(1.0, 2 * each / r.rows)) for r in sizes], "of string, share double")
    drawn = labelled.withColumn("h", F.xxhash64(F.monotonically_increasing_id(), "text"))  # copies of a text are drawn one by one
    drawn = drawn.join(F.broadcast(shares), F.col("lang") == F.col("of")).filter(F.pmod("h", F.lit(1_000_000)) < F.col("share") * 1_000_000)
    ranked = drawn.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    return ranked.filter(F.col("turn") <= each).select("lang", "text")


def counts(texts: DataFrame, n: int = N) -> DataFrame:
    """lang, kind (0 for words, else the length of n-grams), entry and how often it is there."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                langs = some.column(0).dictionary_encode()
                words, text = words_of(some.column(1))
                coded = words.dictionary_encode()
                language = langs.indices.to_numpy()[text]
                names, many = coded.dictionary.to_pylist(), len(coded.dictionary)
                pairs, number = np.unique(language.astype(np.int64) * many + coded.indices.to_numpy(), return_counts=True)
                lang, word = pairs // max(1, many), pairs % max(1, many)
                for kind in range(n + 1):
                    if kind:
                        entries, owner = grams_of(names, kind)
                    else:
                        entries, owner = names, np.arange(many)
                    grams = pa.array(entries, pa.string()).dictionary_encode()
                    place = grams.indices.to_numpy()
                    # the entries of every (language, word)
                    upto = np.searchsorted(owner, np.arange(many + 1))
                    sizes = (upto[1:] - upto[:-1])[word]
                    row = np.repeat(np.arange(len(word)), sizes)
                    cell = lang[row] * max(1, len(grams.dictionary)) + place[np.repeat(upto[word], sizes) + ramps(sizes)]
                    cells, back = np.unique(cell, return_inverse=True)
                    total = np.bincount(back, weights=number[row], minlength=len(cells)).astype(np.int64)
                    size = max(1, len(grams.dictionary))
                    yield pa.RecordBatch.from_arrays(
                        [langs.dictionary.take(pa.array(cells // size)), pa.array(np.full(len(cells), kind, np.int32)), grams.dictionary.take(pa.array(cells % size)), pa.array(total)],
                        names=["lang", "kind", "entry", "n"],
                    )

    return texts.mapInArrow(counted, "lang string, kind int, entry string, n long").groupBy("lang", "kind", "entry").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Per kind the known entries, and a row of log frequencies by language for each."""

    languages: list[str]
    entries: list[pa.Array]
    logs: list[np.ndarray]

    def look_up(self, kind: int, values: pa.Array) -> np.ndarray:
        """The place of each value among the entries, -1 for unknown ones."""
        return pc.fill_null(pc.index_in(values, value_set=self.entries[kind]), -1).to_numpy(zero_copy_only=False)

    def word_scores(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each word its log frequency by language, and whether it says anything."""
        place = self.look_up(0, words)
        scores = np.zeros((len(words), len(self.languages)))
        known = place >= 0
        scores[known] = self.logs[0][place[known]]
        for n in range(len(self.entries) - 1, 0, -1):
            open_ = np.flatnonzero(~known)
            if not len(open_):
                break
            grams, owner = grams_of(words.take(pa.array(open_)).to_pylist(), n)
            place = self.look_up(n, pa.array(grams, pa.string()))
            owner, place = owner[place >= 0], place[place >= 0]
            many = np.bincount(owner, minlength=len(open_))
            for column in range(len(self.languages)):
                sums = np.bincount(owner, weights=self.logs[n][place, column], minlength=len(open_))
                scores[open_, column] = sums / np.maximum(many, 1)
            known[open_] = many > 0
        return scores, known

    def predict(self, values: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language of each text and its score."""
        words, text = words_of(values)
        if not self.languages:
            return [UNKNOWN] * len(values), np.zeros(len(values))
        coded = words.dictionary_encode()
        scores, known = self.word_scores(coded.dictionary)
        index = coded.indices.to_numpy()
        telling = np.bincount(text, weights=known[index], minlength=len(values))
        means = np.stack([np.bincount(text, weights=scores[index, c], minlength=len(values)) for c in range(len(self.languages))], axis=1)
        means /= np.maximum(telling, 1)[:, None]
        best = means.argmax(axis=1)
        share = 1 / np.exp(means - means.max(axis=1, keepdims=True)).sum(axis=1)
        has_words = np.bincount(text, minlength=len(values)) > 0
        return [self.languages[b] if w else UNKNOWN for b, w in zip(best.tolist(), has_words.tolist(), strict=True)], np.where(has_words, share, 0.0)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, cells: int = CELLS, n: int = N) -> Model:
    """The model of the labelled documents that are not held out."""
    found = materialize(counts(chosen(docs, sample_rows), n), "entries")
    # at most one row for each language of the sample
    totals = {(r.kind, r.lang): r.total for r in found.groupBy("kind", "lang").agg(F.sum("n").alias("total")).collect()}
    languages = sorted({lang for _, lang in totals})
    model = Model(languages, [], [])
    for kind in range(n + 1):
        mine = found.filter(F.col("kind") == kind).filter(F.octet_length("entry") <= WORD_BYTES)
        each = mine.groupBy("entry").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
        kept = each.orderBy(F.desc("n"), "entry").limit(max(1, cells // max(1, len(languages)))).toArrow()
        column = {lang: c for c, lang in enumerate(languages)}
        number = np.zeros((kept.num_rows, len(languages)))
        for row, by in enumerate(kept["by"].to_pylist()):
            for lang, many in by:
                number[row, column[lang]] = many
        total = np.asarray([totals.get((kind, lang), 0) for lang in languages], np.float64)
        seen = np.log(np.maximum(number, 1) / np.maximum(total, 1))
        logs = np.where(number > 0, seen, np.log(UNSEEN / max(1.0, total.max(initial=0))))
        model.entries.append(kept["entry"].combine_chunks())
        model.logs.append(logs.astype(np.float32))
    return model


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document; only the text decides."""
    model = fit(docs) if model is None else model
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                languages, scores = sent.value.predict(some.column(2))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(judged, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
