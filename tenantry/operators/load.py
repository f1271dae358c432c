"""Bringing new rows into a target, and taking a tenant out again; ``target`` has the versions and their folders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantry.model import ForeignKey, Tables
from tenantry.operators.extract import extract_dataset, table_order
from tenantry.operators.target import Change, Target
from tenantry.skew import keep_matching
from tenantry.sources.graph import ordered_entries
from tenantry.state import materialize


class KeyConflict(ValueError):
    """New rows have keys that must not occur, or not more than once."""


def conflicting_keys(target: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of new rows that the target has already, or that occur twice among the new rows.

    Only the new keys are moved, unless they are too many to be sent to the target's rows.
    """
    repeated = new.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1").select(*key)
    taken = keep_matching(target.select(*key), new.select(*key), [(c, c) for c in key])
    return repeated.unionByName(taken).distinct()


def insert(target: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target and new rows together; a single key conflict refuses all of them."""
    if not conflicting_keys(target, new, key).isEmpty():
        raise KeyConflict(f"key {','.join(key)} of a new row is not new")
    return target.unionByName(new)


def latest_rows(new: DataFrame, key: Sequence[str], order: Sequence[str] | None) -> DataFrame:
    """One row per key: the greatest by ``order``; without an order a repeated key is an error.

    The greatest row is an aggregate, so a frequent key is thinned out before the
    shuffle.  The other columns break ties, which makes the choice definite.
    """
    if order is None:
        repeated = new.groupBy(*key).count().filter("count > 1")
        if not repeated.isEmpty():
            raise KeyConflict(f"key {','.join(key)} is repeated among the new rows; name an order")
        return new
    rest = [c for c in new.columns if c not in key]
    ranked = [c for c in order if c in rest] + [c for c in rest if c not in order]
    best = new.groupBy(*key).agg(F.max(F.struct(*ranked)).alias("row"))
    return best.select(*[F.col(c) if c in key else F.col(f"row.{c}").alias(c) for c in new.columns])


def upsert(target: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """New rows replace target rows of the same key; other new rows are added."""
    fresh = latest_rows(new, key, order)
    return keep_matching(target, fresh, [(c, c) for c in key], absent=True).unionByName(fresh)


def merge(
    target: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    policies: Mapping[str, str] | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Row by row like ``upsert``, with a policy for columns where that is not wanted.

    ``coalesce`` takes the new value unless it is null, ``keep`` the old unless
    it is null, ``greatest`` the greater of both; any other column is replaced.
    """
    policies = policies or {}
    fresh = latest_rows(new, key, order)
    columns = [c for c in target.columns if c not in key]
    pairs = [(c, c) for c in key]  # rows that no new row touches never meet the others
    old = keep_matching(target, new, pairs).select(*key, F.struct(F.lit(True), *columns).alias("old"))
    add = fresh.select(*key, F.struct(F.lit(True), *columns).alias("new"))

    def value(c: str) -> Column:
        before, after = F.col(f"old.{c}"), F.col(f"new.{c}")
        chosen = {
            "coalesce": F.coalesce(after, before),
            "keep": F.coalesce(before, after),
            "greatest": F.greatest(before, after),
        }.get(policies.get(c, "replace"), after)
        return F.when(F.col("new").isNull(), before).otherwise(chosen).alias(c)

    joined = old.join(add, list(key), "full_outer")
    merged = joined.select(*[F.col(c) if c in key else value(c) for c in target.columns])
    return keep_matching(target, new, pairs, absent=True).unionByName(merged)


def choose_strategy(existing: Column, new: Column) -> Column:
    """insert into an empty target, upsert below half the new rows, else merge."""
    return F.when(existing == 0, "insert").when(existing < new * 0.5, "upsert").otherwise("merge")


def existing_rows(tables: Tables, tenant_column: str, tenant: object) -> DataFrame:
    """Rows the target holds for a tenant, per table that has the tenant column."""
    parts = [
        df.filter(F.col(tenant_column) == F.lit(tenant))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
        if tenant_column in df.columns
    ]
    return reduce(DataFrame.unionByName, parts)


def strategies(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Strategy per table from two frames ``(table_name, rows)``."""
    joined = new.select("table_name", F.col("rows").alias("new_rows")).join(
        existing.select("table_name", F.col("rows").alias("existing_rows")), "table_name", "left"
    )
    before = F.coalesce("existing_rows", F.lit(0))
    return joined.select(
        "table_name", before.alias("existing_rows"), "new_rows", choose_strategy(before, F.col("new_rows")).alias("strategy")
    )


# --- property graph -------------------------------------------------------------


def upsert_nodes(target: DataFrame, new: DataFrame) -> DataFrame:
    """New nodes replace nodes of the same id and labels; null and ``_`` properties are left out."""
    kept = F.map_filter("properties", lambda k, v: v.isNotNull() & ~k.startswith("_"))
    clean = new.withColumn("properties", kept)
    mark = lambda df: df.withColumn("__labels", F.array_sort("labels"))
    fresh = (
        mark(clean)
        .withColumn("properties", ordered_entries(F.col("properties")))
        .groupBy("node_id", "__labels")
        .agg(F.max(F.struct("properties", "labels")).alias("row"))
        .select("node_id", F.col("row.labels").alias("labels"), F.map_from_entries("row.properties").alias("properties"), "__labels")
    )
    old = keep_matching(mark(target), fresh, [("node_id", "node_id"), ("__labels", "__labels")], absent=True)
    return old.unionByName(fresh).drop("__labels")


def upsert_edges(target: DataFrame, new: DataFrame, nodes: DataFrame) -> DataFrame:
    """New relationships replace those of the same start, type and end; both ends must exist."""
    key = ["start_id", "type", "end_id"]
    ended = keep_matching(keep_matching(new, nodes, [("start_id", "node_id")]), nodes, [("end_id", "node_id")])
    fresh = (
        ended.groupBy(*key)
        .agg(F.max(ordered_entries(F.col("properties"))).alias("entries"))
        .select(*key, F.map_from_entries("entries").alias("properties"))
    )
    return keep_matching(target, fresh, [(c, c) for c in key], absent=True).unionByName(fresh)


# --- removal --------------------------------------------------------------------


def without_tenant(
    tables: Tables,
    keys: Sequence[ForeignKey],
    where: Mapping[str, object],
    *,
    tenant_columns: Mapping[str, Mapping[str, object]] | None = None,
    broken: Sequence[ForeignKey] = (),
) -> Tables:
    """The dataset after the tenant's rows, direct and through foreign keys, are taken out.

    A row goes with any parent that goes, also one in its own table.  Rows without a tenant stay.  Shared
    tables, which belong to no tenant, stay whole.  Doing it again changes nothing.
    """
    return _parted(tables, keys, where, tenant_columns=tenant_columns, broken=broken)[0]


def _parted(
    tables: Tables,
    keys: Sequence[ForeignKey],
    where: Mapping[str, object],
    *,
    tenant_columns: Mapping[str, Mapping[str, object]] | None = None,
    broken: Sequence[ForeignKey] = (),
) -> tuple[Tables, Tables]:
    """What stays of each table, and what goes of those that lose rows."""
    own = dict(tenant_columns or {})
    kept: Tables = {}
    doomed: Tables = {}
    for name in table_order(list(tables), keys, broken):
        df = tables[name]
        direct = own.get(name) or (dict(where) if where and all(c in df.columns for c in where) else None)
        if direct:
            match = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in direct.items()])
            theirs = F.coalesce(match, F.lit(False))
            kept[name], doomed[name] = df.filter(~theirs), df.filter(theirs)
        else:
            kept[name] = df
        above = [k for k in keys if k not in broken and k.child == name and k.parent in doomed and k.parent != name]
        for key in above if not direct else ():
            part = keep_matching(kept[name], doomed[key.parent], key.pairs)
            doomed[name] = doomed[name].unionByName(part) if name in doomed else part
            kept[name] = keep_matching(kept[name], doomed[key.parent], key.pairs, absent=True)
        loops = [k for k in keys if k not in broken and k.child == k.parent == name]
        if loops and name in doomed:
            kept[name], doomed[name] = _with_rows_below(kept[name], doomed[name], loops)
    return {name: kept[name] for name in tables}, doomed


def _with_rows_below(kept: DataFrame, doomed: DataFrame, loops: Sequence[ForeignKey]) -> tuple[DataFrame, DataFrame]:
    """What stays and what goes if rows go with the row of their own table that they refer to, and so on.

    Rounds carry keys only, and only those that are new.
    """
    ids = loops[0].keys
    if any(k.keys != ids for k in loops):
        raise ValueError(f"{loops[0].parent} is referred to by different keys")
    pairs = [(c, c) for c in ids]
    steps = materialize(kept.select(*{c: None for k in loops for c in (*ids, *k.columns)}), "steps")
    gone = new = materialize(doomed.select(*ids).dropna().distinct(), "gone")
    while not new.isEmpty():
        below = [keep_matching(steps, new, k.pairs).select(*ids).dropna() for k in loops]
        new = materialize(keep_matching(reduce(DataFrame.unionByName, below).distinct(), gone, pairs, absent=True), "gone")
        gone = gone.unionByName(new)
    for key in loops:
        doomed = doomed.unionByName(keep_matching(kept, gone, key.pairs))
        kept = keep_matching(kept, gone, key.pairs, absent=True)
    return kept, doomed


def residual(tables: Tables, keys: Sequence[ForeignKey], where: Mapping[str, object], **options) -> DataFrame:
    """Rows of the tenant that are still there, per table; all zero after a removal."""
    left = extract_dataset(tables, keys, where, **options)
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in left.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- loads into a versioned target ------------------------------------------------


def load_dataset(
    target: Target,
    new: Tables,
    primary_keys: Mapping[str, Sequence[str]],
    strategy: str = "insert",
    *,
    order: Sequence[str] | None = None,
    order_by: Mapping[str, Sequence[str]] | None = None,
    policies: Mapping[str, Mapping[str, str]] | None = None,
    note: str = "",
) -> list[str]:
    """Load several tables, all or none; missing and empty tables are skipped.

    An insert adds its rows; upsert and merge write the folders anew that hold a row of a loaded key.
    Returns the names of the tables that were loaded, in load order.
    """
    if strategy not in ("insert", "upsert", "merge"):
        raise ValueError(f"unknown strategy {strategy}")
    wanted = list(new) if order is None else [name for name in order if name in new]
    if not wanted:
        raise ValueError("there is nothing to load")
    current = target.read()
    changes: dict[str, Change] = {}
    for name in wanted:
        df = new[name]
        if df.isEmpty():
            continue
        key = list(primary_keys.get(name, ("id",)))
        sort = (order_by or {}).get(name)
        base = current[name] if name in current else df.limit(0)
        if strategy == "insert":
            insert(base, df, key)  # a conflict is an error
            changes[name] = Change(df)
            continue
        touched = target.tenants(name, keep_matching(base, df.select(*key), [(c, c) for c in key])) if name in current else []
        part = target.read(tenants=touched, only=[name])[name] if touched else base.limit(0)
        done = upsert(part, df, key, sort) if strategy == "upsert" else merge(part, df, key, (policies or {}).get(name), sort)
        changes[name] = Change(done, touched)
    if changes:
        target.commit(changes, note or strategy)
    return list(changes)


def _left_over(target: Target, name: str, kept: DataFrame, doomed: DataFrame, *more: DataFrame) -> Change:
    """The change that takes rows out of a table: only folders that hold one are written anew, if anything is left for them."""
    touched = target.tenants(name, doomed)
    if not touched and not more:
        return Change()
    return Change(reduce(DataFrame.unionByName, more, target.among(name, kept, touched)), touched)


def remove_tenant(target: Target, keys: Sequence[ForeignKey], where: Mapping[str, object], **options) -> int:
    """Publish the target without the tenant; the version before stays available."""
    kept, doomed = _parted(target.read(), keys, where, **options)
    return target.commit({name: _left_over(target, name, kept[name], df) for name, df in doomed.items()}, "remove")


def reload_tenant(
    target: Target,
    new: Tables,
    keys: Sequence[ForeignKey],
    where: Mapping[str, object],
    primary_keys: Mapping[str, Sequence[str]],
    **options,
) -> int:
    """Replace the tenant's rows by new ones in a single version.

    Rows of shared tables that are there already stay as they are.  So do rows that
    belong to another tenant as well, as long as all that they refer to is there.
    """
    current = target.read()
    kept, doomed = _parted(current, keys, where, **options)
    theirs = extract_dataset(current, keys, where, **options)
    broken = options.get("broken", ())
    staying: Tables = {}
    for name in table_order(list(current), keys, broken):
        above = [k for k in keys if k not in broken and k.child == name and k.parent in current]
        if name not in doomed or len(above) < 2:
            continue
        key = [(c, c) for c in primary_keys.get(name, ("id",))]
        foreign = keep_matching(doomed[name], theirs[name], key, absent=True) if name in theirs else doomed[name]
        if name in new:
            foreign = keep_matching(foreign, new[name], key, absent=True)
        for k in above:
            parents = kept[k.parent].select(*k.keys)
            for more in (staying, new):
                if k.parent in more:
                    parents = parents.unionByName(more[k.parent].select(*k.keys))
            lost = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in k.columns])
            foreign = keep_matching(foreign, parents, k.pairs).unionByName(foreign.filter(lost))
        staying[name] = foreign
    changes: dict[str, Change] = {}
    for name, df in new.items():
        key = list(primary_keys.get(name, ("id",)))
        if name not in kept:
            changes[name] = Change(df)
        elif name not in doomed:
            changes[name] = Change(keep_matching(df, kept[name], [(c, c) for c in key], absent=True))
        else:
            back = [staying[name]] if name in staying else []
            insert(reduce(DataFrame.unionByName, back, kept[name]), df, key)  # a conflict is an error
            changes[name] = _left_over(target, name, kept[name], doomed[name], df, *back)
    for name, df in doomed.items():
        if name not in changes:
            changes[name] = _left_over(target, name, kept[name], df, *([staying[name]] if name in staying else []))
    return target.commit(changes, "reload")
