"""Cycles in graphs where listing them is out of the question.

A graph of 25 nodes can have more cycles than any table has rows.  What a
migration needs of them is where they are and which edges to give up:

* ``strong_components`` tells which nodes are on cycles with each other;
* ``cycle_breaks`` gives the edges that would be given up if every single cycle
  were listed and broken at its member with the fewest children, without listing
  any of them.

Both work on edge tables by joins and pre-aggregated minima; the number of rounds
grows with the logarithm of a chain's length, not with the length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantry.operators.ranking import number_rows
from tenantry.skew import keep_matching, look_up
from tenantry.state import materialize


def strong_components(edges: DataFrame) -> DataFrame:
    """``(name, component, size)`` of every node that has an edge; the component is named by its least member."""
    links = edges.select("parent", "child").filter("parent IS NOT NULL AND child IS NOT NULL")
    labels = materialize(_common_cycles(links), "labels")
    named = labels.groupBy(F.col("label").alias("of")).agg(F.min("name").alias("component"), F.count(F.lit(1)).alias("size"))
    members = labels.join(named, F.col("label") == F.col("of")).select("name", "component", "size")
    nodes = links.select(F.col("parent").alias("name")).union(links.select("child")).distinct()
    alone = nodes.join(members, "name", "left_anti").select("name", F.col("name").alias("component"), F.lit(1).cast("long").alias("size"))
    return members.unionByName(alone)


def _common_cycles(links: DataFrame) -> DataFrame:
    """``(name, label)``: nodes on a common cycle have one label; nodes that are missing are on none with others.

    Every node learns the first of all nodes before it and of all behind it, in an
    order drawn by hash.  Where both are the same node, it is on a cycle with that
    node.  All others differ from other components in one of the two sooner or later:
    edges between nodes that learned different ones are dropped, and the rest goes on
    with another order.
    """
    left = materialize(links.filter("parent <> child").distinct(), "links")
    parts = [left.limit(0).select(F.col("parent").alias("name"), F.col("parent").alias("label"))]
    turn = 0
    while not left.isEmpty():
        turn += 1
        state = _first_neighbours(left, turn)
        parts.append(state.filter("before = behind").select("name", F.col("before").alias("label")))
        known = state.filter("before <> behind")
        sides = [known.select(*[F.col(c).alias(f"{c}_{end}") for c in ("name", "before", "behind")]) for end in ("parent", "child")]
        inside = left.join(sides[0], F.col("parent") == F.col("name_parent")).join(sides[1], F.col("child") == F.col("name_child"))
        left = materialize(inside.filter("before_parent = before_child AND behind_parent = behind_child").select("parent", "child"), "links")
    return reduce(DataFrame.unionByName, parts)


def _first_neighbours(links: DataFrame, turn: int) -> DataFrame:
    """(name, before, behind): of all nodes that reach a node, and of all that it reaches, the first in a drawn order.

    A node takes over what its neighbours know, and what the first node it knows of
    knows, so that news travels along a chain in ever longer steps.
    """

    def drawn(column: str) -> Column:
        return F.struct(F.xxhash64(F.lit(turn), column).alias("draw"), F.col(column).alias("name"))

    names = links.select(F.col("parent").alias("name")).union(links.select("child")).distinct()
    state = materialize(names.select("name", drawn("name").alias("before"), drawn("name").alias("behind"), F.lit(True).alias("moved")), "first")
    kind = state.schema["before"].dataType
    none = F.lit(None).cast(kind)
    while not state.filter("moved").isEmpty():
        of = state.select(F.col("name").alias("of"), F.col("before").alias("told_before"), F.col("behind").alias("told_behind"))
        onward = links.join(of, F.col("parent") == F.col("of")).select(F.col("child").alias("name"), F.col("told_before").alias("before"), none.alias("behind"))
        back = links.join(of, F.col("child") == F.col("of")).select(F.col("parent").alias("name"), none.alias("before"), F.col("told_behind").alias("behind"))
        far_onward = state.join(of, F.col("before.name") == F.col("of")).select("name", F.col("told_before").alias("before"), none.alias("behind"))
        far_back = state.join(of, F.col("behind.name") == F.col("of")).select("name", none.alias("before"), F.col("told_behind").alias("behind"))
        told = reduce(DataFrame.unionByName, (onward, back, far_onward, far_back)).withColumns({"was_before": none, "was_behind": none})
        own = state.select("name", "before", "behind", F.col("before").alias("was_before"), F.col("behind").alias("was_behind"))
        least = [F.min(c).alias(c) for c in ("before", "behind", "was_before", "was_behind")]
        now = own.unionByName(told).groupBy("name").agg(*least)
        state = materialize(now.select("name", "before", "behind", ((F.col("before") != F.col("was_before")) | (F.col("behind") != F.col("was_behind"))).alias("moved")), "first")
    return state.select("name", F.col("before.name").alias("before"), F.col("behind.name").alias("behind"))


def cycle_breaks(edges: DataFrame) -> DataFrame:
    """``(break_from, break_to, affected)``: for every cycle, the edge by which its member with the fewest children leaves for the next.

    Ties go to the smaller name.  ``affected`` is the number of children.  Without these edges the graph has no cycle.

    Let nodes come back one by one, those with most children first.  An edge that
    leaves a node for an earlier one closes a cycle whose least member is that node if
    and only if both are on a common cycle as soon as the node is there.  When an
    edge's ends first are is found by halving for all edges at once: one half of the
    nodes tells who is on a common cycle by then; edges among those go on with the first half,
    all others with the second, where what is on a common cycle is one node.  Chains of
    nodes with one edge in and one out count as a single edge from the start.
    """
    children = edges.groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("children"))
    groups = materialize(strong_components(edges), "components")
    links = edges.select("parent", "child").distinct()
    same = look_up(look_up(links, groups.select(F.col("name").alias("a"), F.col("component").alias("x")), [("parent", "a")]), groups.select(F.col("name").alias("b"), F.col("component").alias("y")), [("child", "b")])
    inner = materialize(same.filter("x = y").select("parent", "child"), "inner")
    members = inner.select(F.col("parent").alias("name")).distinct()
    ranked = look_up(members, children, [("name", "of")])
    times = number_rows(ranked, [F.desc("children"), F.desc("name")], name="at", start=0)
    times = materialize(times.select("name", "at"), "times")
    timed = look_up(look_up(inner, times.select(F.col("name").alias("a"), F.col("at").alias("from_at")), [("parent", "a")]), times.select(F.col("name").alias("b"), F.col("at").alias("to_at")), [("child", "b")])
    given_up = F.when(F.col("from_at") >= F.col("to_at"), F.struct("parent", "child"))
    spans = timed.select("parent", "child", F.greatest("from_at", "to_at").alias("at"), given_up.alias("cut"))
    spans = _without_chains(materialize(spans, "spans"), groups)
    total = times.count()
    # what is left of a question: the node that comes back last settles it between low and high
    asked = spans.select(F.lit(0).cast("long").alias("low"), F.lit(total).cast("long").alias("high"), "parent", "child", "at", "cut")
    asked, settled = asked.filter("parent <> child"), [spans.filter("parent = child").select("cut")]
    while not asked.isEmpty():
        half = F.expr("(low + high) div 2")
        early = asked.filter(F.col("at") <= half).select(F.struct("low", F.col("parent").alias("node")).alias("parent"), F.struct("low", F.col("child").alias("node")).alias("child"))
        groups = _common_cycles(early).select(F.col("name.low").alias("in"), F.col("name.node").alias("node"), F.col("label.node").alias("group"))
        both = asked
        for end in ("parent", "child"):
            one = groups.select(F.col("in").alias("in_" + end), F.col("node").alias("node_" + end), F.col("group").alias("group_" + end))
            both = both.join(one, (F.col("low") == F.col("in_" + end)) & (F.col(end) == F.col("node_" + end)), "left")
        group = {end: F.coalesce("group_" + end, end) for end in ("parent", "child")}
        first = (F.col("at") <= half) & (group["parent"] == group["child"])
        halved = both.select(
            F.when(first, F.col("low")).otherwise(half + 1).alias("low"), F.when(first, half).otherwise(F.col("high")).alias("high"),
            *[F.when(first, F.col(end)).otherwise(group[end]).alias(end) for end in ("parent", "child")], "at", "cut",
        )
        halved = materialize(halved, "halved")
        # ends that are one node by then were on a common cycle before the edge was there
        settled.append(halved.filter("parent = child OR (low = high AND low = at)").select("cut"))
        asked = halved.filter("parent <> child AND low < high")
    cuts = reduce(DataFrame.unionByName, settled).filter("cut IS NOT NULL").select(F.col("cut.parent").alias("break_from"), F.col("cut.child").alias("break_to"))
    return look_up(cuts, children.withColumnRenamed("children", "affected"), [("break_from", "of")]).select("break_from", "break_to", "affected")


def _without_chains(spans: DataFrame, groups: DataFrame) -> DataFrame:
    """Spans (parent, child, at, cut) where nodes with one span in and one out are passed over.

    A cycle goes through all of a chain or through none of it, so its least member
    and the edge to give up there stand for the chain.  Each component keeps one node.
    """
    ends = spans.select(F.col("parent").alias("name"), F.lit(1).alias("outs"), F.lit(0).alias("ins")).unionByName(spans.select(F.col("child").alias("name"), F.lit(0).alias("outs"), F.lit(1).alias("ins")))
    plain = ends.groupBy("name").agg(F.sum("outs").alias("outs"), F.sum("ins").alias("ins")).filter("outs = 1 AND ins = 1").select("name")
    plain = materialize(keep_matching(plain, groups, [("name", "component")], absent=True), "chain-nodes")
    if plain.isEmpty():
        return spans
    chains = materialize(keep_matching(spans, plain, [("parent", "name")]), "chains")
    while not keep_matching(chains, plain, [("child", "name")]).isEmpty():
        chains = materialize(_prolonged(chains, chains), "chains")
    return materialize(_prolonged(keep_matching(spans, plain, [("parent", "name")], absent=True), chains), "spans")


def _prolonged(spans: DataFrame, by: DataFrame) -> DataFrame:
    """Spans with what follows their end, where something does; of both parts that with the later node decides."""
    after = by.select(F.col("parent").alias("of"), F.struct(F.col("child"), F.col("at"), F.col("cut")).alias("then"))
    later = F.col("then").isNull() | (F.col("at") > F.col("then.at"))
    alike = F.col("at") == F.col("then.at")  # the node between both, or that at both ends
    return look_up(spans, after, [("child", "of")]).select(
        "parent", F.coalesce("then.child", "child").alias("child"), F.when(later, F.col("at")).otherwise(F.col("then.at")).alias("at"), F.when(later, F.col("cut")).when(alike, F.coalesce("cut", "then.cut")).otherwise(F.col("then.cut")).alias("cut")
    )
