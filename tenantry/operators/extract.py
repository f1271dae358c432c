"""A referentially consistent subset of many tables for one tenant."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantry.model import ForeignKey, Tables
from tenantry.skew import keep_matching, look_up
from tenantry.sources.tables import matching
from tenantry.state import materialize


def extract_direct(df: DataFrame, where: Mapping[str, object]) -> DataFrame:
    """Rows that satisfy every equality; an empty filter keeps all rows."""
    return matching(df, where)


def extract_through_parent(
    child: DataFrame, parent: DataFrame, where: Mapping[str, object], fk: Sequence[str] | str, keys: Sequence[str] | str = "id"
) -> DataFrame:
    """Rows whose parent satisfies the filter; a repeated parent key repeats nothing."""
    fk, keys = ([x] if isinstance(x, str) else list(x) for x in (fk, keys))
    return keep_matching(child, matching(parent, where), list(zip(fk, keys, strict=True)))


def extract_through_chain(tables: Tables, chain: Sequence[ForeignKey], where: Mapping[str, object]) -> DataFrame:
    """Rows of the last child of a chain of foreign keys that starts at the filtered table."""
    current = matching(tables[chain[0].parent], where)
    for key in chain:
        current = keep_matching(tables[key.child], current, key.pairs)
    return current


def extract_bridge(
    bridge: DataFrame,
    left: DataFrame,
    left_on: Sequence[tuple[str, str]],
    right: DataFrame,
    right_on: Sequence[tuple[str, str]],
) -> DataFrame:
    """Rows of a many-to-many table whose two parents were both extracted."""
    return keep_matching(keep_matching(bridge, left, left_on), right, right_on)


def table_order(tables: Sequence[str], keys: Sequence[ForeignKey], broken: Sequence[ForeignKey] = ()) -> list[str]:
    """Tables with parents first; broken keys do not count."""
    sorter = TopologicalSorter({name: set() for name in sorted(tables)})
    for key in keys:
        if key not in broken and key.child != key.parent and {key.child, key.parent} <= set(tables):
            sorter.add(key.child, key.parent)
    return list(sorter.static_order())


def _with_all_parents(df: DataFrame, keys: Sequence[ForeignKey], extracted: Tables, more: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """Rows where every non-null foreign key was extracted, and at least one is non-null.

    Rows in ``more`` are there for others that refer to them: they may be referred to, but bring no rows of their own.
    """
    if len(keys) == 1:
        return keep_matching(df, extracted[keys[0].parent], keys[0].pairs)
    columns = df.columns
    fits, linked = F.lit(True), F.lit(False)
    for i, key in enumerate(keys):
        marks = extracted[key.parent].select(*key.keys).distinct().withColumn("__own", F.lit(True))
        for part in more.get(key.parent, ()):
            marks = marks.unionByName(part.select(*key.keys).distinct().withColumn("__own", F.lit(False)))
        if more.get(key.parent):
            marks = marks.groupBy(*key.keys).agg(F.max("__own").alias("__own"))
        marks = marks.toDF(*[f"__p{i}_{j}" for j in range(len(key.keys))], f"__own{i}")
        df = look_up(df, marks, [(c, f"__p{i}_{j}") for j, c in enumerate(key.columns)])
        empty = F.lit(False)
        for c in key.columns:
            empty = empty | F.col(c).isNull()
        fits, linked = fits & (F.col(f"__own{i}").isNotNull() | empty), linked | F.coalesce(F.col(f"__own{i}"), F.lit(False))
    return df.filter(fits & linked).select(*columns)


def _referred_in_turn(tables: Tables, own: Tables, more: dict[str, list[DataFrame]], name: str, keys: Sequence[ForeignKey]) -> None:
    """Adds to ``more`` what the rows of a table refer to in it, what those refer to, and so on, in any table that is there.

    Each round only follows the rows that are new, and only looks for keys that are not there yet.
    """
    known: dict[tuple[str, tuple[str, ...]], DataFrame] = {}
    new = {name: own[name]}
    first = True
    while new:
        wanted: dict[tuple[str, tuple[str, ...]], DataFrame] = {}
        for key in keys:
            # rows that were extracted have all they refer to in other tables
            if key.child not in new or key.parent not in own or (first and key.child != key.parent):
                continue
            values, at = new[key.child].select(*key.columns).dropna().toDF(*key.keys), (key.parent, key.keys)
            wanted[at] = wanted[at].unionByName(values) if at in wanted else values
        first, found = False, {}
        for (parent, columns), values in wanted.items():
            pairs = [(c, c) for c in columns]
            if (parent, columns) not in known:
                there = own[parent].select(*columns)
                for part in more.get(parent, ()):
                    there = there.unionByName(part.select(*columns))
                known[parent, columns] = materialize(there.dropna().distinct(), "known")
            lacking = materialize(keep_matching(values.distinct(), known[parent, columns], pairs, absent=True), "lacking")
            if lacking.isEmpty():
                continue
            known[parent, columns] = known[parent, columns].unionByName(lacking)
            rows = materialize(keep_matching(tables[parent], lacking, pairs), "referred")
            more.setdefault(parent, []).append(rows)
            found[parent] = found[parent].unionByName(rows) if parent in found else rows
        new = found


def extract_dataset(
    tables: Tables,
    keys: Sequence[ForeignKey],
    where: Mapping[str, object],
    *,
    tenant_columns: Mapping[str, Mapping[str, object]] | None = None,
    broken: Sequence[ForeignKey] = (),
    save: Callable[[str, DataFrame], DataFrame] | None = None,
) -> Tables:
    """The tenant's part of every table, parents first.

    A table that has all filter columns is filtered directly (``tenant_columns``
    gives the filter of tables that name the tenant differently).  A table below
    extracted tables keeps the rows whose foreign keys were all extracted.  A
    table that is neither, such as a shared code list, keeps the rows that
    extracted rows refer to, so that the subset is closed.  Where a table refers to
    itself, the rows that extracted ones refer to come too, with all that those refer
    to in turn, but nothing below them.  A broken key is not enforced.  ``save`` stores each table as it is done and returns a scan of it,
    so that later tables read the small result instead of computing it again.
    """
    own = dict(tenant_columns or {})
    order = table_order(list(tables), keys, broken)
    linked = [k for k in keys if k not in broken and {k.child, k.parent} <= set(tables)]
    live = [k for k in linked if k.child != k.parent]
    looped = {k.child for k in linked if k.child == k.parent} if where or own else set()
    # tables that may get rows later on are saved at the end
    open_ = set(looped)
    for name in reversed(order):
        if any(k.parent == name and k.child in open_ for k in live):
            open_.add(name)
    final = save or (lambda name, df: df)
    more: dict[str, list[DataFrame]] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        return materialize(df, "extracted") if name in open_ else final(name, df)

    def whole(name: str) -> DataFrame:
        df = done[name]
        for part in more.get(name, ()):
            df = df.unionByName(part)
        return df

    done: Tables = {}
    for name in order:
        df = tables[name]
        above = [k for k in live if k.child == name and k.parent in done]
        if name in own:
            done[name] = store(name, matching(df, own[name]))
        elif where and all(c in df.columns for c in where):
            done[name] = store(name, matching(df, where))
        elif not where and not own:
            done[name] = store(name, df)
        elif above:
            done[name] = store(name, _with_all_parents(df, above, done, more))
        if name in looped and name in done:
            _referred_in_turn(tables, done, more, name, linked)
    for name in reversed(order):
        if name in done:
            continue
        below = [k for k in live if k.parent == name and k.child in done]
        if below:
            done[name] = store(name, _referred(tables[name], below, {k.child: whole(k.child) for k in below}))
            if name in looped:
                _referred_in_turn(tables, done, more, name, linked)
    return {name: final(name, whole(name)) if name in open_ else done[name] for name in order if name in done}


def _referred(df: DataFrame, keys: Sequence[ForeignKey], extracted: Tables) -> DataFrame:
    """Parent rows that some extracted child row refers to; every key names the same columns."""
    wanted = None
    for key in keys:
        if key.keys != keys[0].keys:
            raise ValueError(f"{key.parent} is referred to by different keys")
        values = extracted[key.child].select(*key.columns).dropna().distinct().toDF(*key.keys)
        wanted = values if wanted is None else wanted.unionByName(values)
    return keep_matching(df, wanted, [(c, c) for c in keys[0].keys])


def manifest(tables: Tables, store_of: Callable[[str], str] = lambda name: name.split("_", 1)[0]) -> DataFrame:
    """Rows per table, with the store each table belongs to."""
    result = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(store_of(name)).alias("store"), F.lit(name).alias("table_name"), "rows"
        )
        result = row if result is None else result.unionByName(row)
    return result


def manifest_totals(counts: DataFrame) -> DataFrame:
    """Tables and rows per store, and over all stores in the row ``ALL``."""
    figures = [F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows")]
    per_store = counts.groupBy("store").agg(*figures)
    return per_store.unionByName(counts.agg(*figures).select(F.lit("ALL").alias("store"), "tables", "rows"))


def extraction_checks(counts: DataFrame, expected: Sequence[str], root: str) -> DataFrame:
    """Is the tenant present at its root, is every table there, is none empty."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame([(name,) for name in expected], "table_name STRING")
    found = wanted.join(counts.select("table_name", "rows"), "table_name", "left")
    check = (
        F.when(F.col("rows").isNull(), "missing_table")
        .when((F.col("rows") == 0) & (F.col("table_name") == root), "tenant_not_found")
        .when(F.col("rows") == 0, "empty_table")
        .otherwise("ok")
    )
    return found.select("table_name", F.coalesce("rows", F.lit(0)).alias("rows"), check.alias("result"))
