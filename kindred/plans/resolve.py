"""Which leader does every identifier end up with?

Two ways to the same answer. ``loop_step`` rewrites the whole graph once, as the
step-by-step definition does; ``resolve`` first reduces the graph to its leaders,
numbers them in leader order and contracts that much smaller graph with
alternating large-star and small-star steps (Kiveris et al., SoCC 2014) on plain
longs. Only leaders may win, and the smallest (priority, id) of a component does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.skew import HOT_FLOOR, salted_join
from kindred.plans.config import CanonicalId
from kindred.plans.extract import follower_columns, table_id_array
from kindred.sources.scratch import Scratch

MAX_STEPS = 30
FOLLOWER = ["follower_id", "follower_ns"]
LEADER = ["leader_id", "leader_ns"]


class NotConverged(RuntimeError):
    """The step limit was reached while links still changed."""

    def __init__(self, metrics: list[dict]):
        super().__init__(f"no fixpoint after {len(metrics)} steps: {metrics}")
        self.metrics = metrics


@dataclass
class Resolution:
    """Final graph, one row per follower, and one metrics row per step.

    ``seen`` and ``followers``, where they are kept, have the tables of every link's follower by ``rank``
    of the leader, and of every follower, as bit sets.
    """

    graph: DataFrame
    metrics: list[dict] = field(default_factory=list)
    seen: DataFrame | None = None
    followers: DataFrame | None = None


def leader_priority(canonical: CanonicalId, ns: str = "leader_ns") -> Column:
    """Rank of a namespace; by default its own number."""
    if not canonical.key_priorities:
        return F.col(ns)
    ranks = [F.lit(p).cast("long") for p in canonical.key_priorities]
    return F.when(F.col(ns) > 0, F.element_at(F.array(*ranks), F.col(ns).cast("int"))).otherwise(F.col(ns))


# -- the definition, one whole-graph step at a time ---------------------------


def loop_step(graph: DataFrame, canonical: CanonicalId, as_of: int, floor: int = HOT_FLOOR, scratch: Scratch | None = None) -> DataFrame:
    """One step: every leader follows itself; each older leader is replaced by the
    smallest leader it shares a follower with.

    The links of the step are written to ``links`` of ``scratch``, since they are read several times.
    """
    scratch = scratch or Scratch(graph.sparkSession, "step")
    rows = graph.count()
    leaders = graph.select(*[F.col(c).alias(f) for c, f in zip(LEADER, FOLLOWER)]).distinct()
    # A leader follows itself in one row, however many links it has.
    followers = graph.groupBy(*FOLLOWER).agg(
        F.min("follower_first_seen_at").alias("follower_first_seen_at"),
        F.max("follower_last_seen_at").alias("follower_last_seen_at"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("follower_source_table_ids")))).alias("follower_source_table_ids"),
        F.max("follower_last_processed_at").alias("follower_last_processed_at"),
    )
    own = followers.join(leaders, FOLLOWER, "left_semi")
    own = own.withColumns({"leader_id": F.col("follower_id"), "leader_ns": F.col("follower_ns")})
    links = scratch.save(graph.unionByName(own), "links")
    leader = F.struct(leader_priority(canonical).alias("prio"), F.col("leader_id").alias("id"), F.col("leader_ns").alias("ns"))
    flat = links.select(*FOLLOWER, leader.alias("leader"))
    newest = flat.groupBy(*FOLLOWER).agg(F.min("leader").alias("newest"))
    moves = (
        salted_join(flat, newest, FOLLOWER, floor=floor, total=2 * rows)
        .filter(F.col("leader") > F.col("newest"))
        .groupBy("leader")
        .agg(F.min("newest").alias("newest"))
        .select(F.col("leader.id").alias("leader_id"), F.col("leader.ns").alias("leader_ns"), "newest")
    )
    moved = salted_join(links, moves, LEADER, "left", floor=floor, total=2 * rows)
    return (
        moved.withColumns(
            {
                "leader_id": F.coalesce("newest.id", "leader_id"),
                "leader_ns": F.coalesce("newest.ns", "leader_ns"),
                "follower_last_processed_at": F.when(F.col("newest").isNull(), F.col("follower_last_processed_at")).otherwise(
                    F.lit(as_of)
                ),
            }
        )
        .groupBy(*FOLLOWER, *LEADER)
        .agg(
            F.min("follower_first_seen_at").alias("follower_first_seen_at"),
            F.max("follower_last_seen_at").alias("follower_last_seen_at"),
            # Equal lists collapse while collecting: the set is bounded by the tables, not the rows.
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("follower_source_table_ids")))).alias(
                "follower_source_table_ids"
            ),
            F.max("follower_last_processed_at").alias("follower_last_processed_at"),
        )
    )


def changed_links(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """Links of ``curr`` that ``prev`` does not have."""
    ids = [*FOLLOWER, *LEADER]
    return curr.select(*ids).subtract(prev.select(*ids))


def loop_to_fixpoint(
    graph: DataFrame, canonical: CanonicalId, as_of: int, max_steps: int = MAX_STEPS, fixed_steps: int | None = None
) -> Resolution:
    """Repeat ``loop_step`` until no link changes. ``fixed_steps`` runs exactly that many."""
    scratch = Scratch(graph.sparkSession, "loop")
    prev, metrics = scratch.save(graph, "step0"), []
    for step in range(1, (fixed_steps or max_steps) + 1):
        curr = scratch.save(loop_step(prev, canonical, as_of, scratch=scratch), f"step{step}")
        scratch.drop("links")
        updated = changed_links(prev, curr).count()
        metrics.append({"iteration": step, "edge_count": curr.count(), "updated_count": updated})
        scratch.drop(f"step{step - 1}")
        prev = curr
        if updated == 0 and fixed_steps is None:
            return Resolution(curr, metrics)
    if fixed_steps is None:
        raise NotConverged(metrics)
    return Resolution(prev, metrics)


# -- the way it is run --------------------------------------------------------


def number_leaders(pairs: DataFrame, canonical: CanonicalId, seniority: DataFrame | None = None) -> DataFrame:
    """Distinct leaders with their number of links and a long ``rank`` that sorts like (priority, seniority, id).

    A global sort followed by partition-wise numbering keeps the order without
    a single-task window.
    """
    leaders = pairs.groupBy(*LEADER).agg(F.count(F.lit(1)).alias("links"))
    order = [leader_priority(canonical)]
    if seniority is not None:
        leaders = leaders.join(seniority, LEADER, "left")
        order.append(F.coalesce("seniority", F.lit(0)))
    ranked = leaders.orderBy(*order, "leader_id", "leader_ns")
    return ranked.select(*LEADER, "links", F.monotonically_increasing_id().alias("rank"))


def _node_state(graph: DataFrame) -> DataFrame:
    """Per node of an edge table (a > b): smallest neighbour and how many lie below and above."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = graph.select(F.col("a").alias("u"), F.col("b").alias("v"), one.alias("below"), zero.alias("above")).unionByName(
        graph.select(F.col("b").alias("u"), F.col("a").alias("v"), zero.alias("below"), one.alias("above"))
    )
    return both.groupBy("u").agg(F.min("v").alias("v"), F.sum("below").alias("below"), F.sum("above").alias("above"))


def _progress(graph: DataFrame) -> tuple[int, int, int]:
    """Edges, nodes that keep the graph from being a set of stars around smallest nodes, and the most neighbours of a node."""
    is_open = (F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0))
    count = lambda c: F.coalesce(c, F.lit(0))
    row = _node_state(graph).agg(
        count(F.sum("below")).alias("edges"), F.count_if(is_open).alias("open"), count(F.max(F.col("below") + F.col("above"))).alias("widest")
    ).first()
    return row["edges"], row["open"], row["widest"]


def both_stars(graph: DataFrame) -> DataFrame:
    """Large star and small star in one pass, for a graph whose nodes all have few neighbours.

    The neighbours of a node meet in one window instead of a join with their minimum. No
    window is larger than the neighbourhood of a node: the first star adds no edges to one.
    """
    both = graph.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(graph.select(F.col("b").alias("u"), F.col("a").alias("v")))
    around = both.withColumn("m", F.least("u", F.min("v").over(Window.partitionBy("u"))))
    wide = around.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return _small_ends(wide.withColumn("m", F.min("b").over(Window.partitionBy("a"))))


def large_star(graph: DataFrame, floor: int = HOT_FLOOR, total: int | None = None) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    lowest = _node_state(graph).filter(F.col("above") > 0).select(F.col("u").alias("b"), F.least("u", "v").alias("m"))
    return salted_join(graph, lowest, ["b"], floor=floor, total=total).select("a", F.col("m").alias("b")).distinct()


def small_star(graph: DataFrame, floor: int = HOT_FLOOR, total: int | None = None) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    lowest = graph.groupBy("a").agg(F.min("b").alias("m"))
    return _small_ends(salted_join(graph, lowest, ["a"], floor=floor, total=total))


def _small_ends(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with ``m``, the smallest neighbour of a: both ends are linked to it."""
    ends = F.array(
        F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
    )
    return edges.select(F.inline(ends)).filter(F.col("a") != F.col("b")).distinct()


def contract(graph: DataFrame, scratch: Scratch, max_steps: int = MAX_STEPS, floor: int = HOT_FLOOR) -> tuple[DataFrame, list[dict]]:
    """Component stars (node a, root b) of an edge table of longs with a > b; metrics, with the most neighbours of a node."""
    current, metrics = scratch.save(graph, "contract0"), []
    for step in range(1, max_steps + 1):
        edge_count, pending, widest = _progress(current)
        metrics.append({"iteration": step, "edge_count": edge_count, "updated_count": pending, "widest": widest})
        if pending == 0:
            return current, metrics
        if widest <= floor:
            current = scratch.save(both_stars(current), f"contract{step}")
        else:
            # The second half reads this twice.
            wide = scratch.save(large_star(current, floor, edge_count), f"large{step}")
            current = scratch.save(small_star(wide, floor, edge_count), f"contract{step}")
            scratch.drop(f"large{step}")
        scratch.drop(f"contract{step - 1}")
    raise NotConverged(metrics)


def resolve(
    pairs: DataFrame,
    canonical: CanonicalId,
    table_count: int,
    as_of: int,
    max_steps: int = MAX_STEPS,
    floor: int = HOT_FLOOR,
    seniority: DataFrame | None = None,
    saved: bool = False,
    written: bool = True,
) -> Resolution:
    """Final graph from the link table of ``extract.pair_table``; ``saved`` tells that it is a written table already.

    With ``written=False`` the graph is left for the caller to write, and the tables of links and followers are kept.
    """
    scratch = Scratch(pairs.sparkSession, "resolve")
    pairs = pairs if saved else scratch.save(pairs, "pairs")
    # No table below has more rows than there are links.
    total = pairs.count()
    leaders = scratch.save(number_leaders(pairs, canonical, seniority), "leaders")
    # Most links of a leader: no leader has more followers, whether it is their only or their smallest one.
    busiest = leaders.agg(F.coalesce(F.max("links"), F.lit(0))).first()[0]

    ranked = salted_join(pairs, leaders.select(*LEADER, "rank"), LEADER, floor=floor, total=total, largest=busiest)
    ranked = scratch.save(ranked.drop(*LEADER), "ranked")
    lowest = ranked.groupBy(*FOLLOWER).agg(
        F.min("rank").alias("low"), F.max("rank").alias("high"), F.count(F.lit(1)).alias("links"), *follower_columns(pairs)
    )
    lowest = scratch.save(lowest, "lowest")

    # Leaders that share a follower belong together; most followers have one leader only, and two need no second look.
    most = lowest.agg(F.coalesce(F.max("links"), F.lit(0))).first()[0]
    links = lowest.filter(F.col("links") == 2).select(F.col("high").alias("a"), F.col("low").alias("b"))
    words = [c for c in pairs.columns if c.startswith("_w")]
    seen = lowest.select(F.explode(F.when(F.col("links") > 1, F.array("low", "high")).otherwise(F.array("low"))).alias("rank"), *words)
    if most > 2:
        shared = lowest.filter(F.col("links") > 2).select(*FOLLOWER, "low", *words)
        joint = salted_join(ranked.select(*FOLLOWER, "rank"), shared, FOLLOWER, floor=floor, total=total, largest=most)
        seen = seen.unionByName(joint.select("rank", *words))
        links = links.unionByName(joint.filter(F.col("rank") > F.col("low")).select(F.col("rank").alias("a"), F.col("low").alias("b")))
    stars, metrics = contract(links.distinct(), scratch, max_steps, floor)

    winner = leaders.select(F.col("rank").alias("root"), *LEADER)
    roots = leaders.select("rank").join(stars.select(F.col("a").alias("rank"), F.col("b").alias("root")), "rank", "left")
    roots = scratch.save(roots.select("rank", F.coalesce("root", "rank").alias("root")), "roots")
    # The stars' nodes and the root itself.
    finals = salted_join(roots, winner, ["root"], floor=floor, total=total, largest=metrics[-1]["widest"] + 1)
    finals = finals.select(F.col("rank").alias("low"), *LEADER)

    graph = salted_join(lowest, finals, ["low"], floor=floor, total=total, largest=busiest).select(
        *FOLLOWER,
        *LEADER,
        F.col("first_at").alias("follower_first_seen_at"),
        F.col("last_at").alias("follower_last_seen_at"),
        table_id_array(table_count).alias("follower_source_table_ids"),
        F.lit(as_of).cast("long").alias("follower_last_processed_at"),
    )
    if written:
        graph = scratch.save(graph, "graph")
        for name in ("ranked", "lowest", "roots"):
            scratch.drop(name)
        return Resolution(graph, metrics)
    return Resolution(graph, metrics, seen, lowest.select("follower_ns", *words))
