"""Toxicity categories predicted by a classifier chain.

One logistic regression per category, in a given order.  Each uses counts of
hashed byte n-grams and the log-odds that the models of the earlier categories
give.  In training these log-odds come from models that have not seen the
document (out-of-fold), so a later model learns how far the earlier ones can be
trusted.  N-grams are chosen by their chi-square with the category, inside each
training set only.  The cutoff of a category is the one with the best F1 on
out-of-fold predictions.

Fitting uses at most ``sample_rows`` labelled documents, those with the least
hashes of their ids, in one task; the model has a bounded size.  Every document
is then scored where it is scanned, whole, without a shuffle.

A null text counts as empty; an empty text is never rejected.  Labels of null
are left out; of several labels of one document the greatest counts, as do its
rows with that id in ``docs``.  A category without both classes among the labels
is null everywhere and rejects nothing; so without labels nothing is rejected.
Repeated rows get equal scores.  Extra columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantry.llm.common import byte_ends, slices, texts

#: Labelled documents used to fit, n-grams per model, folds.
SAMPLE_ROWS, FEATURES, FOLDS = 8_000, 1024, 5
#: Bytes of the n-grams, and bits of their hashes.
ORDERS, BITS = (4, 6), 18
BUCKETS = len(ORDERS) << BITS
SLICE_BYTES = 2 << 20
#: Least number of documents of the sample that have an n-gram, and the weight of the penalty on squared weights.
LEAST_DOCS, PENALTY = 5, 0.1

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[:128] = [b if chr(b).isalpha() else 32 for b in range(128)]


def buckets(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram numbers of all texts, one order after the other, and the row each belongs to."""
    lowered = pc.utf8_lower(values)
    ends = byte_ends(lowered) + np.arange(1, len(lowered) + 1)
    raw = b" ".join(x.as_buffer().to_pybytes() for x in lowered.cast(pa.binary())) if len(lowered) else b""
    text = np.concatenate([_FOLDED[np.frombuffer(raw, np.uint8)], np.full(9, 32, np.uint8)])
    total = int(ends[-1]) if len(ends) else 0
    words = np.lib.stride_tricks.as_strided(text, (total, 8), (1, 1)).copy().view(np.uint64).ravel()
    rows = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))
    found = []
    for i, order in enumerate(ORDERS):
        gram = words & np.uint64((1 << 8 * order) - 1)
        gram = (gram ^ gram >> np.uint64(23)) * np.uint64(0x9E3779B97F4A7C15)
        found.append((gram >> np.uint64(64 - BITS)).astype(np.int64) + (i << BITS))
    return np.concatenate(found), np.tile(rows, len(ORDERS))


def figures(values: pa.Array, chosen: np.ndarray) -> np.ndarray:
    """A row per text and a column per chosen n-gram: the logarithm of 1 plus its count in 1,000 bytes."""
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    out = np.zeros((len(values), len(chosen)), np.float32)
    numbers, rows = buckets(values)
    column = place[numbers]
    taken = column >= 0
    counts = np.bincount(rows[taken] * len(chosen) + column[taken], minlength=out.size) if len(chosen) else np.zeros(0)
    sizes = np.maximum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), 1)
    out[:] = counts.reshape(out.shape)
    return np.log1p(out * (1000.0 / sizes[:, None]).astype(np.float32), out=out)


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 60) -> np.ndarray:
    """Weights and, last, the intercept of a penalised logistic regression, by limited-memory quasi-Newton steps."""

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x @ w[:-1].astype(np.float32) + np.float32(w[-1])
        loss = np.logaddexp(0, -np.where(y, z, -z).astype(np.float64)).sum() + penalty / 2 * (w[:-1] ** 2).sum()
        wrong = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y).astype(np.float32)
        return loss, np.append((wrong @ x).astype(np.float64) + penalty * w[:-1], wrong.sum(dtype=np.float64))

    w = np.zeros(x.shape[1] + 1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    w[-1] = np.log(share / (1 - share))
    loss, gradient = value(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        step, saved = gradient.copy(), []
        for s, g in reversed(past):
            a = s @ step / (s @ g)
            step -= a * g
            saved.append(a)
        step *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(gradient))
        for (s, g), a in zip(past, reversed(saved), strict=True):
            step += (a - g @ step / (s @ g)) * s
        size, slope = 1.0, gradient @ step
        while size > 1e-8:
            new, changed = value(w - size * step)
            if new <= loss - 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        moved, turned = -size * step, changed - gradient
        w, gained, loss, gradient = w + moved, loss - new, new, changed
        if moved @ turned > 1e-12:
            past = [*past[-9:], (moved, turned)]
        if gained < 1e-6 * max(1.0, loss):
            break
    return w


def chi_square(having: np.ndarray, positive: np.ndarray, docs: int, positives: int) -> np.ndarray:
    """Of each n-gram with a category, from the documents that have it and the positive ones among them."""
    a, b = positive, having - positive
    c, d = positives - a, docs - positives - b
    under = having * (docs - having) * float(positives) * (docs - positives)
    return np.where(under > 0, docs * (a * d - b * c) ** 2 / np.where(under > 0, under, 1), 0.0)


def odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def best_cutoff(p: np.ndarray, y: np.ndarray) -> float:
    """Halfway between neighbouring predictions, where F1 is best."""
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[:-1] == p[1:]] = 0
    i = int(np.argmax(f1))
    return float((p[i] + (p[i + 1] if i + 1 < len(p) else 0)) / 2)


class Chain:
    """Fitted models: the n-grams they use, and per category weights, links to earlier categories, intercept and cutoff."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray, links: np.ndarray, intercepts: np.ndarray, cutoffs: np.ndarray):
        self.chosen, self.weights, self.links, self.intercepts, self.cutoffs = chosen, weights, links, intercepts, cutoffs

    def dumps(self) -> bytes:
        sink = io.BytesIO()
        np.savez(sink, chosen=self.chosen, weights=self.weights, links=self.links, intercepts=self.intercepts, cutoffs=self.cutoffs)
        return sink.getvalue()

    @staticmethod
    def loads(raw: bytes) -> Chain:
        parts = np.load(io.BytesIO(raw))
        return Chain(*(parts[k] for k in ("chosen", "weights", "links", "intercepts", "cutoffs")))

    def probabilities(self, values: pa.Array) -> np.ndarray:
        """A column per category; not a number where there is no model."""
        x = figures(values, self.chosen)
        out = np.full((len(values), len(self.intercepts)), np.nan)
        logits = np.zeros_like(out)
        for c in range(out.shape[1]):
            if not np.isnan(self.intercepts[c]):
                # row by row, so that equal rows get equal values
                z = (x * self.weights[c].astype(np.float64)).sum(axis=1) + self.intercepts[c] + (logits[:, :c] * self.links[c, :c]).sum(axis=1)
                out[:, c] = np.round(1 / (1 + np.exp(-z)), 6)
                logits[:, c] = odds(out[:, c])
        return out


def fit_chain(values: pa.Array, labels: np.ndarray, features: int = FEATURES, folds: int = FOLDS) -> Chain:
    """``labels`` has a column of 0 and 1 per category."""
    count, categories = labels.shape
    fold = np.fromiter((xxhash.xxh64_intdigest(x.as_buffer()) % folds for x in values.cast(pa.binary())), np.int64, count)
    having = np.zeros((folds, BUCKETS), np.int32)
    positive = np.zeros((categories, folds, BUCKETS), np.int32)
    batch = pa.RecordBatch.from_arrays([values], names=["text"])
    start = 0
    for some in slices(batch, "text", SLICE_BYTES):
        numbers, rows = buckets(some.column(0))
        pairs = np.unique(rows * BUCKETS + numbers)
        rows, numbers = pairs // BUCKETS + start, pairs % BUCKETS
        np.add.at(having, (fold[rows], numbers), 1)
        for c in range(categories):
            mine = labels[rows, c] == 1
            np.add.at(positive[c], (fold[rows[mine]], numbers[mine]), 1)
        start += some.num_rows
    fits = [(c, k) for c in range(categories) for k in (*range(folds), -1) if 0 < labels[:, c].sum() < count]
    picked: dict[tuple[int, int], np.ndarray] = {}
    for c, k in fits:
        of = [f for f in range(folds) if f != k]
        has, pos = having[of].sum(axis=0, dtype=np.float64), positive[c][of].sum(axis=0, dtype=np.float64)
        in_ = fold != k
        value = np.where(has >= LEAST_DOCS, chi_square(has, pos, int(in_.sum()), int(labels[in_, c].sum())), 0)
        top = np.argsort(-value, kind="stable")[:features]
        picked[c, k] = np.sort(top[value[top] > 0])
    chosen = np.unique(np.concatenate([*picked.values(), np.empty(0, np.int64)])).astype(np.int64)
    x = np.concatenate([figures(some.column(0), chosen) for some in slices(batch, "text", SLICE_BYTES)]) if count else np.empty((0, len(chosen)), np.float32)
    weights, links = np.zeros((categories, len(chosen)), np.float32), np.zeros((categories, categories))
    intercepts, cutoffs = np.full(categories, np.nan), np.full(categories, np.nan)
    seen = np.zeros((count, categories), np.float32)  # out-of-fold log-odds
    for c in range(categories):
        if (c, -1) not in picked:
            continue
        y = labels[:, c] == 1
        out_of_fold = np.full(count, y.mean())
        for k in (*range(folds), -1):
            columns = np.searchsorted(chosen, picked[c, k])
            own = np.concatenate([x[:, columns], seen[:, :c]], axis=1)
            train = fold != k
            if k >= 0 and (not train.any() or train.all() or not 0 < y[train].sum() < train.sum()):
                continue
            w = fit_linear(own[train], y[train])
            if k >= 0:
                out_of_fold[~train] = 1 / (1 + np.exp(-(own[~train] @ w[:-1] + w[-1])))
            else:
                weights[c, columns] = w[: len(columns)]
                links[c, :c] = w[len(columns) : -1]
                intercepts[c] = w[-1]
        cutoffs[c] = best_cutoff(out_of_fold, y)
        seen[:, c] = odds(out_of_fold)
    used = np.flatnonzero((weights != 0).any(axis=0))
    return Chain(chosen[used], weights[:, used], links, intercepts, cutoffs)


def usual_categories() -> dict[str, Column]:
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Chain:
    """``categories``: by name, in the order of the chain, a column of ``labels`` that is true, false or null."""
    known = labels.select("doc_id", *[c.cast("int").alias(n) for n, c in categories.items()]).dropna()
    sample = known.groupBy("doc_id").agg(*[F.max(n).alias(n) for n in categories]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = texts(docs).join(sample, "doc_id").groupBy("doc_id", *categories).agg(F.max("text").alias("text"))
    names = list(categories)

    def fitted(group: pa.Table) -> pa.Table:
        group = group.sort_by("doc_id").combine_chunks()
        y = np.stack([group.column(n).to_numpy() for n in names], axis=1)
        model = fit_chain(group.column("text").combine_chunks(), y, features)
        return pa.table({"model": pa.array([model.dumps()], pa.binary())})

    # at most ``sample_rows`` rows meet in this one task
    got = rows.groupBy(F.lit(0).alias("all")).applyInArrow(fitted, "model binary").first()
    if got:
        return Chain.loads(got.model)
    n = len(categories)
    return Chain(np.empty(0, np.int64), np.zeros((n, 0), np.float32), np.zeros((n, n)), np.full(n, np.nan), np.full(n, np.nan))


def score(docs: DataFrame, chain: Chain, names: Sequence[str]) -> DataFrame:
    """doc_id, for each category p_<name> and <name>: its probability and whether that reaches the cutoff."""
    raw = chain.dumps()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Chain.loads(raw)
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                p = model.probabilities(some.column(1))
                full = pc.binary_length(some.column(1)).to_numpy(zero_copy_only=False) > 0
                columns = [some.column(0)]
                for c in range(len(names)):
                    columns += [pa.array(p[:, c], mask=np.isnan(p[:, c])), pa.array((p[:, c] >= model.cutoffs[c]) & full)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(x for n in names for x in (f"p_{n}", n))])

    kinds = ", ".join(f"p_{n} double, {n} boolean" for n in names)
    return texts(docs).mapInArrow(scored, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {kinds}")


def classify(docs: DataFrame, labels: DataFrame, categories: dict[str, Column] | None = None, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> DataFrame:
    """Scores of a chain fitted on ``labels``: by default text of low quality first, then toxic text."""
    categories = categories or usual_categories()
    return score(docs, train(docs, labels, categories, sample_rows, features), list(categories))


def without(docs: DataFrame, labels: DataFrame, category: str = "toxic", categories: dict[str, Column] | None = None, **options: int) -> DataFrame:
    """Rows of ``docs``, with all their columns, that are not of the category; decided where they are scanned."""
    categories = categories or usual_categories()
    raw, at = train(docs, labels, categories, **options).dumps(), list(categories).index(category)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Chain.loads(raw)
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                values = pc.fill_null(some.column(some.schema.get_field_index("text")), "")
                p = model.probabilities(values)[:, at]
                full = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0
                yield some.filter(pa.array(~((p >= model.cutoffs[at]) & full)))

    return docs.mapInArrow(kept, docs.schema)
