"""Quality rules whose cutoffs are proven on labelled documents.

Fixed base rules reject very short and very repetitive texts.  Beyond them a
document is rejected if one of its figures exceeds the cutoff of its stratum.
A cutoff is only used if labelled documents prove that it rejects few good ones:

* the good documents (quality 1) of a stratum that pass the base rules are its
  holdout, ``n`` of them;
* rules stand in a fixed order of levels, loosest first.  A level has a cutoff
  for every figure and rejects what exceeds any of them, ``k`` of the holdout,
  so that the tolerated rate holds for all figures together;
* the exact binomial tail P(X <= k), X of n trials with the tolerated rate, is
  the p-value of "this level rejects more than tolerated";
* levels are tested until the first one that is not proven; the one before it is
  used.  A fixed sequence needs no correction; strata share the error probability
  evenly (Bonferroni), but for those whose ``n`` is too small to prove anything
  even with all of it: they are not tested and use up nothing.

All of it is DataFrame operations.  Null text: no words, so the base rules
reject it.  A stratum without enough labelled documents has no cutoffs and only
the base rules apply; a null stratum is one of its own.  A document that is
labelled more than once counts as good only if all its labels say so; labels of
null are left out.  Repeated rows give repeated results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenantry.llm.common import WHITE, words_of
from tenantry.state import materialize

#: Tolerated share of good documents rejected per stratum, and the probability that any stratum exceeds it.
TOLERATED, RISK = 0.02, 0.1
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: By figure: its cutoff at each level, from loosest to strictest.
CUTOFFS = {
    "symbols_per_word": (4.0, 3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05),
    "repeat_share": (0.5, 0.48, 0.46, 0.44, 0.42, 0.4, 0.38, 0.36, 0.34, 0.3, 0.25, 0.2),
    "dup_lines_per_word": (1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05),
    "chars_per_word": (40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 10.0, 9.0, 8.0, 7.0),
    "shouts_per_word": (2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
}


def measured(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """The counts of each document, one row per row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", F.col(stratum).alias("stratum"), text.alias("text")).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    size = F.size("words")
    windows = F.when(size > 2, F.transform(F.sequence(F.lit(0), size - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    counted = split.select(
        "doc_id",
        "stratum",
        size.cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("!!")).cast("long").alias("n_shouts"),
        lines.alias("lines"),
        F.coalesce(windows, F.array().cast("array<bigint>")).alias("windows"),
    )
    ordered = counted.withColumns({"n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"), "ordered": F.sort_array("windows")})
    twice = F.exists(F.transform("ordered", lambda x, i: (i > 0) & (x == F.get("ordered", i - 1))), lambda x: x)
    placed = F.when(twice, F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("hash"), i.alias("at")))))
    sorted_ = ordered.withColumn("placed", placed)
    beside = F.filter("placed", lambda x, i: (x["hash"] == F.get("placed", i - 1)["hash"]) | (x["hash"] == F.get("placed", i + 1)["hash"]))
    repeated = sorted_.withColumn("repeated", F.sort_array(F.transform(beside, lambda x: x["at"])))
    # each repeated window adds the words that the one before it does not cover
    covered = F.aggregate(
        "repeated",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum")),
        lambda a, at: F.struct(at.alias("last"), (a["sum"] + F.least(F.lit(3), at - a["last"])).alias("sum")),
        lambda a: a["sum"],
    )
    done = repeated.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return done.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouts", failed.alias("base_failed"))


def figures() -> dict[str, Column]:
    words = F.col("n_words")
    return {
        "symbols_per_word": F.try_divide("n_symbols", words),
        "repeat_share": F.try_divide("n_repeat_words", words),
        "dup_lines_per_word": F.try_divide("n_dup_lines", words),
        "chars_per_word": F.try_divide("word_chars", words),
        "shouts_per_word": F.try_divide("n_shouts", words),
    }


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X of n trials with the rate, exact up to rounding; 1 where k is above n * rate, where it can prove nothing."""
    odds = math.log(rate) - math.log1p(-rate)
    first = n * math.log1p(-rate)

    def step(a: Column, j: Column) -> Column:
        term = a["term"] + F.log((n - j + 1) / j) + odds
        high, low = F.greatest(a["sum"], term), F.least(a["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    total = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.struct(first.alias("term"), first.alias("sum")), step, lambda a: F.exp(a["sum"]))
    return F.when(k > n * rate, 1.0).when(k == 0, F.exp(first)).otherwise(total)


def kept_by(cutoffs: dict[str, tuple[float, ...]]) -> Column:
    """The number of levels that keep the document: it is rejected from the next one on."""

    def passed(value: Column, chain: tuple[float, ...]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, chain)), lambda cutoff: value <= cutoff))

    values = figures()
    return F.least(*[passed(values[name], chain) for name, chain in cutoffs.items()])


def proven_levels(measures: DataFrame, labels: DataFrame, tolerated: float = TOLERATED, risk: float = RISK, cutoffs=CUTOFFS) -> DataFrame:
    """stratum, level (from 0), n, k, p: the strictest proven level of each stratum that has one."""
    levels = len(next(iter(cutoffs.values())))
    if any(len(chain) != levels or list(chain) != sorted(chain, reverse=True) for chain in cutoffs.values()):
        raise ValueError("every figure needs one cutoff for each level, none looser than the one before")
    good = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    held = measures.filter(~F.col("base_failed")).join(good.select("doc_id"), "doc_id", "left_semi")
    kept = held.select("stratum", kept_by(cutoffs).alias("kept_by"))
    counts = kept.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.count_if(F.col("kept_by") <= j) for j in range(levels)]).alias("rejected"))
    able = counts.filter(F.exp(F.col("n") * math.log1p(-tolerated)) <= risk)
    tests = able.withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy())).select("stratum", "n", "strata", F.posexplode("rejected").alias("level", "k"))
    judged = tests.withColumn("p", binomial_tail(F.col("k"), F.col("n"), tolerated))
    # k, and with it p, only grows from level to level: the proven levels are the first ones
    passing = judged.filter(F.col("p") <= risk / F.col("strata"))
    return passing.groupBy("stratum").agg(F.max(F.struct("level", "n", "k", "p")).alias("last")).select("stratum", "last.*")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", tolerated: float = TOLERATED, risk: float = RISK, cutoffs=CUTOFFS) -> DataFrame:
    """The counts of each document, ``base_failed`` and ``kept``."""
    measures = materialize(measured(docs, stratum), "quality")
    proven = proven_levels(measures, labels, tolerated, risk, cutoffs).select(F.col("stratum").alias("of"), "level")
    joined = measures.join(proven, F.col("stratum").eqNullSafe(F.col("of")), "left")
    over = F.coalesce(kept_by(cutoffs) <= F.col("level"), F.lit(False))
    columns = [c for c in measures.columns if c != "base_failed"]
    return joined.select(*columns, "base_failed", (~F.col("base_failed") & ~over).alias("kept"))
