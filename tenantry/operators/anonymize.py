"""Consistent replacement of personal data.

Which rule a column falls under depends on its name only.  Surrogates are pure
functions of (rule, value, salt), so a table is anonymized by one projection,
and equal values get equal surrogates in every table without a shared map.
Tokens are numbered, so they go through a token table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantry.functions import surrogates
from tenantry.model import AnonymizationRule, Tables
from tenantry.operators.ranking import number_rows
from tenantry.operators.target import Change, Target
from tenantry.skew import look_up

Rules = Sequence[AnonymizationRule]

#: The table of a map that outlives its run, and by what it is kept.
MAP = "consistency_map"
MAP_BY = {MAP: "rule"}
MAP_SCHEMA = "rule STRING, original STRING, surrogate STRING"

# What counts as personal data inside a text.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
}


def match_rule(column: str, rules: Rules) -> AnonymizationRule | None:
    """The first rule whose pattern occurs in the column name, ignoring case."""
    return next((rule for rule in rules if re.search(rule.pattern, column, re.IGNORECASE)), None)


def matched_columns(df: DataFrame, rules: Rules) -> list[tuple[str, AnonymizationRule]]:
    pairs = ((column, match_rule(column, rules)) for column in df.columns)
    return [(column, rule) for column, rule in pairs if rule is not None]


@dataclass(frozen=True)
class Anonymizer:
    """Rules with the secrets and tables they need.

    ``tokens`` holds a token table for each tokenizing rule; ``stored`` is a
    consistency map ``(rule, original, surrogate)`` whose entries win over
    computed surrogates.
    """

    rules: Rules
    salt: str
    as_of: str
    tokens: Mapping[str, DataFrame] | None = None
    stored: DataFrame | None = None

    def expression(self, rule: AnonymizationRule, value: Column, data_type: str) -> Column:
        """Replacement of a value under any rule but a tokenizing one."""
        if rule.strategy == "surrogate":
            return surrogates.surrogate(rule.kind, rule.name, value, self.salt, self.as_of, **rule.options)
        if rule.strategy == "format":
            return surrogates.format_preserving(rule.name, value, self.salt)
        if rule.strategy == "domain":
            return surrogates.domain_preserving_email(rule.name, value, self.salt)
        if rule.strategy == "hash":
            return surrogates.salted_hash(value, self.salt, rule.options.get("algorithm", "sha256"), data_type)
        if rule.strategy == "nullify":
            return F.lit(None).cast(data_type)
        return value

    def table(self, df: DataFrame) -> DataFrame:
        """The table with every matched column replaced; other columns stay."""
        types = {f.name: f.dataType.simpleString() for f in df.schema}
        replaced = {}
        order = df.columns
        for i, (column, rule) in enumerate(matched_columns(df, self.rules)):
            value = F.col(column)
            if rule.strategy == "tokenize":
                table = (self.tokens or {})[rule.name]
                df = _attach(df, column, table, f"__token{i}")
                replaced[column] = F.col(f"__token{i}")
                continue
            new = self.expression(rule, value, types[column])
            if self.stored is not None and rule.strategy == "surrogate":
                known = self.stored.filter(F.col("rule") == rule.name)
                df = _attach(df, column, known, f"__stored{i}")
                target = "date" if rule.kind == "date_of_birth" else "string"
                new = F.coalesce(F.col(f"__stored{i}").cast(target), new)
            replaced[column] = new
        return df.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in order])

    def dataset(self, tables: Tables) -> Tables:
        """Every table under the same rules; missing token tables are built first."""
        ready = self
        missing = [r for r in self.rules if r.strategy == "tokenize" and r.name not in (self.tokens or {})]
        if missing:
            built = {rule.name: build_tokens(rule_values(tables, self.rules, rule.name)) for rule in missing}
            ready = Anonymizer(self.rules, self.salt, self.as_of, {**(self.tokens or {}), **built}, self.stored)
        return {name: ready.table(df) for name, df in tables.items()}


def _attach(df: DataFrame, column: str, table: DataFrame, name: str) -> DataFrame:
    """Add the surrogate that a (original, surrogate) table holds for a column."""
    probe = df.withColumn(f"{name}_in", F.col(column).cast("string"))
    entries = table.select(F.col("original").alias(f"{name}_key"), F.col("surrogate").alias(name))
    return look_up(probe, entries, [(f"{name}_in", f"{name}_key")]).drop(f"{name}_in")


def rule_values(tables: Tables, rules: Rules, rule_name: str) -> DataFrame:
    """Distinct non-null values, as text, of all columns that fall under a rule."""
    parts = [
        df.select(F.col(column).cast("string").alias("original")).dropna().distinct()
        for df in tables.values()
        for column, rule in matched_columns(df, rules)
        if rule.name == rule_name
    ]
    if not parts:
        raise ValueError(f"no column falls under rule {rule_name}")
    return reduce(DataFrame.unionByName, parts).distinct()


def token_text(number: Column) -> Column:
    return F.format_string("TOKEN_%08d", number)


def build_tokens(values: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """``(original, surrogate)`` with one token per distinct value, numbered by value.

    Values in ``stored`` keep their token; new ones continue after the greatest number there.
    """
    fresh = values.select(F.col(values.columns[0]).cast("string").alias("original")).dropna().distinct()
    start = 1
    if stored is not None:
        fresh = fresh.join(stored, "original", "left_anti")
        number = F.regexp_extract("surrogate", r"([0-9]+)$", 1).try_cast("bigint")
        start = stored.agg(F.coalesce(F.max(number), F.lit(0)).alias("last")).first().last + 1
    numbered = number_rows(fresh, ["original"], name="number", start=start)
    tokens = numbered.select("original", token_text(F.col("number")).alias("surrogate"))
    return tokens if stored is None else stored.select("original", "surrogate").unionByName(tokens)


def tokenize(df: DataFrame, column: str, tokens: DataFrame) -> DataFrame:
    """Replace a column by its tokens."""
    order = df.columns
    return _attach(df, column, tokens, "__token").withColumn(column, F.col("__token")).select(*order)


def detokenize(df: DataFrame, column: str, tokens: DataFrame) -> DataFrame:
    """Put the original values, as text, back in place of the tokens."""
    turned = tokens.select(F.col("surrogate").alias("original"), F.col("original").alias("surrogate"))
    return tokenize(df, column, turned)


def consistency_map(tables: Tables, anonymizer: Anonymizer) -> DataFrame:
    """``(rule, original, surrogate)``, one row for each distinct value under a mapped rule."""
    parts = []
    for df in tables.values():
        for column, rule in matched_columns(df, anonymizer.rules):
            if rule.strategy != "surrogate":
                continue
            originals = df.select(F.col(column).alias("value")).dropna().distinct()
            new = anonymizer.expression(rule, F.col("value"), df.schema[column].dataType.simpleString())
            parts.append(
                originals.select(
                    F.lit(rule.name).alias("rule"),
                    F.col("value").cast("string").alias("original"),
                    new.cast("string").alias("surrogate"),
                )
            )
    if not parts:
        return next(iter(tables.values())).sparkSession.createDataFrame([], MAP_SCHEMA)
    return reduce(DataFrame.unionByName, parts).distinct()


def new_entries(tables: Tables, anonymizer: Anonymizer, stored: DataFrame) -> DataFrame:
    """``(rule, original, surrogate)`` of all values, tokens included, that a stored map lacks."""
    parts = [consistency_map(tables, anonymizer)]
    for rule in anonymizer.rules:
        if rule.strategy != "tokenize" or not any(r.name == rule.name for df in tables.values() for _, r in matched_columns(df, anonymizer.rules)):
            continue
        known = stored.filter(F.col("rule") == rule.name).select("original", "surrogate")
        given = (anonymizer.tokens or {}).get(rule.name)
        made = given if given is not None else build_tokens(rule_values(tables, anonymizer.rules, rule.name), known)
        parts.append(made.select(F.lit(rule.name).alias("rule"), "original", "surrogate"))
    return reduce(DataFrame.unionByName, parts).join(stored, ["rule", "original"], "left_anti")


def stored_entries(maps: Target, rule: str | None = None) -> DataFrame:
    """The map that runs have left, or what it has of one rule."""
    found = maps.read(only=[MAP], tenants=None if rule is None else [rule]).get(MAP)
    return maps.spark.createDataFrame([], MAP_SCHEMA) if found is None else found


def remember(maps: Target, tables: Tables, anonymizer: Anonymizer, note: str = "", keep: bool = True) -> Anonymizer:
    """The anonymizer that gives every value what earlier runs gave it, after the map got its new entries.

    ``maps`` is a target of its own, as it holds original values and is not for those who read the data; it is
    best kept by rule (``MAP_BY``).  The entries are there before the tables that use them, so that whatever is
    loaded can be resolved; tokens of a run that then fails stay taken.  Without ``keep`` nothing is written.
    Two runs must not add to one map at the same time.
    """
    stored = stored_entries(maps)
    new = new_entries(tables, anonymizer, stored)
    if keep:
        maps.commit({MAP: Change(new)}, note)
        stored = stored_entries(maps)
    else:
        stored = stored.unionByName(new)
    names = [rule.name for rule in anonymizer.rules if rule.strategy == "tokenize"]
    part = {n: (stored_entries(maps, n) if keep else stored).filter(F.col("rule") == n) for n in names}
    return Anonymizer(anonymizer.rules, anonymizer.salt, anonymizer.as_of, {n: df.select("original", "surrogate") for n, df in part.items()}, stored)


def resolve(df: DataFrame, rules: Rules, maps: Target) -> DataFrame:
    """A table of a finished run with the original values, as text, in place of its tokens."""
    for column, rule in matched_columns(df, rules):
        if rule.strategy == "tokenize":
            df = detokenize(df, column, stored_entries(maps, rule.name).filter(F.col("rule") == rule.name))
    return df


def merge_maps(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Add entries for values the stored map does not have yet."""
    return stored.unionByName(new.join(stored, ["rule", "original"], "left_anti"))


def inconsistent_values(observed: DataFrame) -> DataFrame:
    """Values of ``(rule, original, surrogate)`` rows that have more than one surrogate."""
    return (
        observed.select("rule", "original", "surrogate")
        .distinct()
        .groupBy("rule", "original")
        .agg(F.count(F.lit(1)).alias("surrogates"))
        .filter("surrogates > 1")
    )


def suspicious_values(df: DataFrame, rules: Rules) -> DataFrame:
    """Values that do not look anonymized, counted over all rows.

    An e-mail is suspicious if it has an @ but not a surrogate domain, a name if
    it has fewer than three characters.
    """
    tests = []
    for column, rule in matched_columns(df, rules):
        text = F.col(column).cast("string")
        if rule.strategy == "surrogate" and rule.kind == "email":
            tests.append((column, rule.name, text.contains("@") & ~text.endswith(".example.org")))
        elif rule.strategy == "surrogate" and "name" in rule.kind:
            tests.append((column, rule.name, F.length(text) < 3))
    if not tests:
        return df.sparkSession.createDataFrame([], "column_name STRING, rule STRING, suspicious BIGINT")
    counts = df.agg(*[F.count_if(test).alias(f"t{i}") for i, (_, _, test) in enumerate(tests)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col(f"t{i}").alias("suspicious"))
        for i, (c, r, _) in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*rows)))


def leaked_values(original: Tables, anonymized: Tables, rules: Rules) -> DataFrame:
    """Distinct anonymized values that equal an original value of the same rule."""
    result = None
    changed = {
        rule.name
        for df in original.values()
        for _, rule in matched_columns(df, rules)
        if rule.strategy not in ("preserve", "nullify")
    }
    for name in sorted(changed):
        after = rule_values(anonymized, rules, name)
        before = rule_values(original, rules, name)
        part = after.join(before, "original", "left_semi").select(F.lit(name).alias("rule"), F.col("original").alias("value"))
        result = part if result is None else result.unionByName(part)
    return result


def _hits(text: Column, kind: str) -> Column:
    count = F.regexp_count(text, F.lit(PII_PATTERNS[kind]))
    # the e-mail pattern is slow on long runs of letters, and useless without an @
    return F.when(text.contains("@"), count).otherwise(F.lit(0)) if kind == "email" else count


def pii_in_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with hits and number of hits per text column and kind of personal data."""
    kinds = [(column, kind, f"{column}_{kind}") for column in columns for kind in PII_PATTERNS]
    hits = df.select(*[F.coalesce(_hits(F.col(column), kind), F.lit(0)).cast("bigint").alias(name) for column, kind, name in kinds])
    figures = [f for _, _, n in kinds for f in (F.count_if(F.col(n) > 0).alias(f"{n}_rows"), F.sum(n).alias(f"{n}_hits"))]
    rows = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(kind).alias("kind"),
            F.col(f"{n}_rows").alias("rows"),
            F.coalesce(F.col(f"{n}_hits"), F.lit(0)).alias("hits"),
        )
        for column, kind, n in kinds
    ]
    return hits.agg(*figures).select(F.inline(F.array(*rows)))


def redact(text: Column) -> Column:
    """Replace every hit by its kind in brackets."""
    for kind, pattern in PII_PATTERNS.items():
        replaced = F.regexp_replace(text, pattern, f"[{kind.upper()}]")
        text = F.when(text.contains("@"), replaced).otherwise(text) if kind == "email" else replaced
    return text


def report(tables: Tables, rules: Rules) -> DataFrame:
    """Rows, matched columns and replaced values per table and rule; one pass per table."""
    result = None
    for name, df in tables.items():
        matched = matched_columns(df, rules)
        if not matched:
            continue
        by_rule: dict[str, list[str]] = {}
        for column, rule in matched:
            by_rule.setdefault(rule.name, []).append(column)
        counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"c_{c}") for c, _ in matched])
        rows = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.col("rows"),
                F.lit(len(df.columns)).alias("columns"),
                F.lit(len(columns)).alias("fields"),
                reduce(lambda a, b: a + b, [F.col(f"c_{c}") for c in columns]).alias("values"),
            )
            for rule, columns in sorted(by_rule.items())
        ]
        part = counts.select(F.inline(F.array(*rows)))
        result = part if result is None else result.unionByName(part)
    return result
