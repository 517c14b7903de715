"""Components, communities and their measures.

Graph: nodes (node) and edges (l < r, weight, support). Communities are found inside each
connected component in one task; separate components never share a community, so this is
exact as long as the whole graph's weight is used. Components that no task can hold are first
made smaller by distributed local moves for the same modularity, whose groups become nodes.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import shared_table
from . import geo, kernels
from .edges import without_nodes
from .pairs import both_ways

#: A component with more edges is first contracted by distributed local moves, until one task can hold it.
MAX_KERNEL_EDGES = 2_000_000


def component_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, component: the smallest node of its component.

    Each round takes the least label of the neighbours and then that label's own; rounds are
    written to the shared folder, which cuts the lineage.
    """
    near = both_ways(edges)
    labels = shared_table(nodes.select("node", F.col("node").alias("component")), "labels")
    while True:
        low = near.join(labels.toDF("other", "near"), "other").groupBy("node").agg(F.min("near").alias("near"))
        step = labels.join(low, "node", "left").select("node", "component", F.least("component", F.coalesce("near", "component")).alias("next"))
        jump = labels.toDF("next", "further")
        step = step.join(jump, "next", "left").select("node", "component", F.least("next", F.coalesce("further", "next")).alias("now"))
        step = shared_table(step, "labels")
        labels = step.select("node", F.col("now").alias("component"))
        if step.where("now <> component").isEmpty():
            return labels


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, component_id: numbered by size, largest first, then smallest member."""
    return renumbered(component_labels(nodes, edges), "component").select("node", F.col("community_id").alias("component_id"))


def renumbered(partition: DataFrame, column: str) -> DataFrame:
    """node, community_id from any grouping: 0, 1, ... by size, largest first, then smallest member.

    The numbering runs over one row a group; its distributed sort and running count need no single task.
    """
    sizes = partition.groupBy(column).agg(F.count("*").alias("_size"), F.min("node").alias("_low"))
    return partition.join(numbered(sizes, [F.desc("_size"), F.asc("_low")], "community_id").select(column, "community_id"), column).select("node", "community_id")


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """df with 0, 1, ... in the given order: sorted in ranges, each range's start from the counts before it."""
    ranged = shared_table(df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), f"numbered{uuid.uuid4().hex[:6]}")
    before, upto = {}, 0
    for part, n in ranged.groupBy("_part").count().orderBy("_part").collect():  # one row a range
        before[part] = upto
        upto += n
    starts = df.sparkSession.createDataFrame([(p, s) for p, s in before.items()], "_part int, _start long")
    inner = F.row_number().over(Window.partitionBy("_part").orderBy("_at"))
    return ranged.withColumn("_in", inner).join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_in") - 1).drop("_part", "_at", "_in", "_start")


def _kernel(total: float, gamma: float, seed: int, refine: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["l", "r"], ignore_index=True)
        names = np.unique(np.concatenate([pdf["l"].to_numpy(object), pdf["r"].to_numpy(object)]))
        at = {x: i for i, x in enumerate(names)}
        l, r = pdf["l"].map(at).to_numpy(np.int64), pdf["r"].map(at).to_numpy(np.int64)
        w, loop = pdf["weight"].to_numpy(float), l == r
        own = np.bincount(l[loop], w[loop], len(names))
        label = kernels.communities(len(names), l[~loop], r[~loop], w[~loop], gamma, total, seed, refine, own)
        return pd.DataFrame({"node": names, "grp": [names[i] for i in _first_of(label)]})

    return run


def _first_of(label: np.ndarray) -> np.ndarray:
    """Each node's group named by its first member."""
    _, first, inv = np.unique(label, return_index=True, return_inverse=True)
    return first[inv]


def detect(nodes: DataFrame, edges: DataFrame, resolution: float = 1.0, seed: int = 42, refine: bool = True) -> DataFrame:
    """node, community_id: communities of connected nodes; nodes without edges are their own."""
    labels = component_labels(nodes, edges)
    total = edges.agg(F.sum("weight")).first()[0] or 0.0
    tagged = edges.select("l", "r", "weight").join(labels.toDF("l", "component"), "l").select("component", "l", "r", "weight")
    large = tagged.groupBy("component").count().where(F.col("count") > MAX_KERNEL_EDGES).select("component")
    inside = None
    if not large.isEmpty():
        inside, coarse = contracted(tagged.join(large, "component", "left_semi"), total, resolution, seed)
        tagged = tagged.join(large, "component", "left_anti").unionByName(coarse)
    kernel = _kernel(total, resolution, seed, refine)
    found = tagged.groupBy("component").applyInPandas(lambda pdf: kernel(pdf.drop(columns="component")), "node string, grp string")
    if inside is not None:
        low = inside.toDF("node", "super").join(found.toDF("super", "grp"), "super", "left")
        spread = low.select("node", F.coalesce("grp", "super").alias("grp"))
        found = found.join(spread.select("node"), "node", "left_anti").unionByName(spread)
    alone = nodes.select("node").join(both_ways(edges).select("node").distinct(), "node", "left_anti")
    every = shared_table(found.unionByName(alone.select("node", F.col("node").alias("grp"))), "groups")
    return shared_table(renumbered(every, "grp"), "partition")


def contracted(tagged: DataFrame, total: float, gamma: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(node, grp) and the graph of the groups (component, l, r, weight; l = r: weight inside).

    Levels of local moves and contraction go on while a component has more edges than the kernel
    holds and groups still merge. Groups are named by a member; they need not be connected inside.
    """
    graph, inside = tagged, None
    while True:
        groups = _local_moves(graph, total, gamma, seed)
        inside = groups if inside is None else inside.toDF("node", "mid").join(groups.toDF("mid", "grp"), "mid").select("node", "grp")
        inside = shared_table(inside, "inside")
        ends = graph.join(groups.toDF("l", "gl"), "l").join(groups.toDF("r", "gr"), "r")
        merged = ends.groupBy("component", F.least("gl", "gr").alias("l"), F.greatest("gl", "gr").alias("r")).agg(F.sum("weight").alias("weight"))
        merged = shared_table(merged, "contracted")
        same = groups.where("node <> grp").isEmpty()
        graph = merged
        if same or merged.groupBy("component").count().where(F.col("count") > MAX_KERNEL_EDGES).isEmpty():
            return inside, graph


def _local_moves(graph: DataFrame, total: float, gamma: float, seed: int, least: float = 1e-4, patience: int = 4) -> DataFrame:
    """node, grp: rounds in which half of the nodes, drawn by hash, go to the neighbouring group of largest gain.

    Ends when modularity has not risen by least for patience rounds, with the best round's groups.
    Of two single nodes only the larger name moves to the smaller, so that they don't swap.
    """
    m2 = 2.0 * total
    near = shared_table(both_ways(graph.where("l <> r"), "weight").select("node", "other", "weight"), "near")
    loops = graph.where("l = r").select(F.col("l").alias("node"), (2 * F.col("weight")).alias("own"))
    degree = near.groupBy("node").agg(F.sum("weight").alias("w")).join(loops, "node", "full")
    degree = shared_table(degree.select("node", F.coalesce("own", F.lit(0.0)).alias("own"), (F.coalesce("w", F.lit(0.0)) + F.coalesce("own", F.lit(0.0))).alias("k")), "degrees")
    now = degree.select("node", F.col("node").alias("grp"))
    best, top, idle, turn = now, -1.0, 0, 0
    while True:
        state = now.join(degree, "node")
        mass = state.groupBy("grp").agg(F.sum("k").alias("mass"), F.count("*").alias("size"))
        votes = near.join(now.toDF("other", "to"), "other").select("node", "to", "weight").unionByName(now.select("node", F.col("grp").alias("to"), F.lit(0.0).alias("weight")))
        votes = votes.groupBy("node", "to").agg(F.sum("weight").alias("w")).join(state, "node")
        votes = votes.join(mass.toDF("to", "mass", "size"), "to").join(mass.select("grp", F.col("size").alias("own_size")), "grp")
        here = F.col("to") == F.col("grp")
        gain = F.col("w") - gamma * F.col("k") * (F.col("mass") - F.when(here, F.col("k")).otherwise(0.0)) / m2
        open_ = here | (F.col("size") > 1) | (F.col("own_size") > 1) | (F.col("to") < F.col("grp"))
        x = votes.withColumn("gain", gain).where(open_).groupBy("node", "grp").agg(
            F.max(F.when(here, F.col("gain"))).alias("stay"),
            F.max("gain").alias("top"),
            F.max_by("to", F.struct("gain", "to")).alias("to"),
            F.max(F.when(here, F.col("w") + F.col("own"))).alias("inner"),
            F.max("k").alias("k"),
        )
        may = F.pmod(F.xxhash64("node", F.lit(seed), F.lit(turn)), F.lit(2)) == 0
        x = shared_table(x.withColumn("next", F.when(may & (F.col("top") > F.col("stay") + 1e-12), F.col("to")).otherwise(F.col("grp"))), "moves")
        sums = x.groupBy("grp").agg(F.sum("inner").alias("inner"), F.sum("k").alias("k")).agg(F.sum("inner"), F.sum(F.col("k") * F.col("k"))).first()
        value = sums[0] / m2 - gamma * sums[1] / m2**2
        if value > top + least:
            idle = 0
        else:
            idle += 1
        if value > top:
            best, top = x.select("node", "grp"), value
        if idle >= patience:
            return best
        now, turn = x.select("node", F.col("next").alias("grp")), turn + 1


def shares(edges: DataFrame, partition: DataFrame) -> DataFrame:
    """node, community_id, share of the node's edge weight that leads into the community; without weight: 1 in its own."""
    near = both_ways(edges, "weight").join(partition.select(F.col("node").alias("other"), "community_id"), "other")
    sums = near.groupBy("node", "community_id").agg(F.sum("weight").alias("w"))
    total = F.sum("w").over(Window.partitionBy("node"))
    out = sums.withColumn("t", total).where("t > 0").select("node", "community_id", (F.col("w") / F.col("t")).alias("share"))
    rest = partition.join(out.select("node").distinct(), "node", "left_anti").select("node", "community_id", F.lit(1.0).alias("share"))
    return out.join(partition.select("node"), "node", "left_semi").unionByName(rest)


def candidate_shares(candidates: DataFrame, partition: DataFrame) -> DataFrame:
    """The same over all candidate edges; the node itself need not be in the partition."""
    near = both_ways(candidates.where("weight > 0"), "weight").join(partition.select(F.col("node").alias("other"), "community_id"), "other")
    sums = near.groupBy("node", "community_id").agg(F.sum("weight").alias("w"))
    return sums.withColumn("t", F.sum("w").over(Window.partitionBy("node"))).select("node", "community_id", (F.col("w") / F.col("t")).alias("share"))


def participation(shared: DataFrame) -> DataFrame:
    """node, participation: 1 less the sum of squared shares."""
    return shared.groupBy("node").agg((1 - F.sum(F.col("share") * F.col("share"))).alias("participation"))


def weighted_degrees(edges: DataFrame) -> DataFrame:
    return both_ways(edges, "weight").groupBy("node").agg(F.count("*").alias("degree"), F.sum("weight").alias("weighted_degree"))


def pageranks(edges: DataFrame, partition: DataFrame) -> DataFrame:
    """node, pagerank inside its community; in communities without edges all nodes have the same."""
    p = partition.select("node", "community_id")
    inside = edges.join(p.toDF("l", "cl"), "l").join(p.toDF("r", "cr"), "r").where("cl = cr").select(F.col("cl").alias("community_id"), "l", "r", "weight")
    rows = p.select("community_id", F.col("node").alias("l"), F.lit(None).cast("string").alias("r"), F.lit(None).cast("double").alias("weight")).unionByName(inside)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names = np.sort(pdf.loc[pdf["r"].isna(), "l"].to_numpy(object))
        at = {x: i for i, x in enumerate(names)}
        e = pdf[pdf["r"].notna()].sort_values(["l", "r"])
        score = kernels.pagerank(len(names), e["l"].map(at).to_numpy(np.int64), e["r"].map(at).to_numpy(np.int64), e["weight"].to_numpy(float))
        return pd.DataFrame({"node": names, "pagerank": score})

    return rows.groupBy("community_id").applyInPandas(run, "node string, pagerank double")


def clean(nodes: DataFrame, edges: DataFrame, coords: DataFrame, resolution: float, seed: int, min_online: int, online_m: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Statuses (node, status), edges and partition without online merchants; statuses are those before removal."""
    linked = both_ways(edges).select("node").distinct().withColumn("_linked", F.lit(True))
    online = geo.suspect_online(edges, coords, min_online, online_m).select(F.col("merchant_id").alias("node"), F.lit(True).alias("_online"))
    statuses = nodes.select("node").join(linked, "node", "left").join(online, "node", "left")
    status = F.when(F.col("_online"), "suspect_online").when(F.col("_linked"), "active").otherwise("suspect_isolated")
    statuses = shared_table(statuses.select("node", status.alias("status")), "statuses")
    gone = statuses.where("status = 'suspect_online'").select("node")
    kept = shared_table(without_nodes(edges, gone), "edges")
    return statuses, kept, detect(nodes.select("node").join(gone, "node", "left_anti"), kept, resolution, seed)


def clean_hubs(nodes: DataFrame, edges: DataFrame, min_degree: int, min_participation: float, rounds: int, resolution: float = 1.0, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rounds of communities, in which nodes of high degree and participation are removed as suspect_online."""
    removed = nodes.select("node").limit(0)
    left, kept = nodes.select("node"), edges
    partition = detect(left, kept, resolution, seed)
    for _ in range(rounds):
        hubs = participation(shares(kept, partition)).where(F.col("participation") >= min_participation)
        hubs = shared_table(hubs.join(weighted_degrees(kept).where(F.col("degree") >= min_degree), "node").select("node"), "hubs")
        if hubs.isEmpty():
            break
        removed = removed.unionByName(hubs)
        left = shared_table(left.join(hubs, "node", "left_anti"), "nodes")
        kept = shared_table(without_nodes(kept, hubs), "edges")
        partition = detect(left, kept, resolution, seed)
    linked = both_ways(edges).select("node").distinct().withColumn("_linked", F.lit(True))
    marks = nodes.select("node").join(linked, "node", "left").join(removed.withColumn("_hub", F.lit(True)), "node", "left")
    statuses = marks.select("node", F.when(F.col("_hub"), "suspect_online").when(F.col("_linked"), "active").otherwise("suspect_isolated").alias("status"))
    return statuses, kept, partition


def quality(edges: DataFrame, partition: DataFrame) -> DataFrame:
    """One row: modularity, coverage, mean conductance, edges and weight within and between communities."""
    p = partition.select("node", "community_id")
    e = edges.join(p.toDF("l", "cl"), "l").join(p.toDF("r", "cr"), "r").withColumn("inside", F.col("cl") == F.col("cr"))
    sums = e.agg(F.sum("weight").alias("w"), F.sum(F.when(F.col("inside"), F.col("weight")).otherwise(0.0)).alias("intra_weight"), F.count_if("inside").alias("intra_edges"), F.count_if(~F.col("inside")).alias("inter_edges"))
    ends = e.select(F.explode(F.array(F.struct(F.col("cl").alias("c"), "weight", "inside"), F.struct(F.col("cr").alias("c"), "weight", "inside"))).alias("x")).select("x.*")
    vol = ends.groupBy("c").agg(F.sum("weight").alias("vol"), F.sum(F.when(F.col("inside"), 0.0).otherwise(F.col("weight"))).alias("cut"))
    total = F.broadcast(sums)
    per = vol.join(total.select("w")).withColumn("least", F.least(F.col("vol"), 2 * F.col("w") - F.col("vol")))
    tops = per.agg(F.sum(F.pow(F.col("vol") / (2 * F.col("w")), F.lit(2.0))).alias("expected"), F.avg(F.when(F.col("least") > 0, F.col("cut") / F.col("least")).otherwise(0.0)).alias("conductance"))
    return sums.join(F.broadcast(tops)).select((F.col("intra_weight") / F.col("w") - F.col("expected")).alias("modularity"), (F.col("intra_weight") / F.col("w")).alias("coverage"), "conductance", "intra_edges", "inter_edges", "intra_weight", (F.col("w") - F.col("intra_weight")).alias("inter_weight"))
