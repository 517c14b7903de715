"""The two batch jobs: initial clustering and incremental assignment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators import assign, clean, community, edges, pairs, results, visits
from ..sources.tables import shared_table


@dataclass
class Clustered:
    merchants: DataFrame
    communities: DataFrame
    business: DataFrame
    edges: DataFrame
    partition: DataFrame
    counts: DataFrame


def cluster(tx: DataFrame, config: JobConfig, update_time: str) -> Clustered:
    """Canonical transactions to merchant, community and business rows."""
    coords = clean.reliable_coordinates(clean.merchant_coordinates(tx), config.geo.max_merchants_per_coordinate)
    metadata = clean.latest_metadata(tx)
    v = shared_table(visits.build_visits(tx, config.visits), "visits")
    stats = shared_table(pairs.pair_statistics(v, config.pairs), "pairs")
    counts = shared_table(visits.visit_counts(v), "counts")
    cands = shared_table(edges.candidates(stats, config.graph, config.pairs.min_support), "candidates")
    graph = edges.mutual_top_k(cands, config.graph.top_k)
    threshold = edges.chain_threshold(counts, config.anchors.chain_quantile, config.anchors.chain_min_visits)
    chains = shared_table(edges.chain_merchants(counts, metadata, threshold), "chains")
    as_nodes = chains.select(F.col("merchant_id").alias("node"))
    nodes = counts.select(F.col("merchant_id").alias("node")).join(as_nodes, "node", "left_anti")
    graph = shared_table(edges.without_nodes(graph, as_nodes), "graph")
    c = config.community
    statuses, kept, partition = community.clean(nodes, graph, coords, c.resolution, c.seed, c.min_online_neighbours, c.online_distance_m)
    shares = community.candidate_shares(cands, partition)
    merchants = results.merchant_results(statuses, kept, partition, counts, shares, chains, threshold, config.anchors, config.city_code)
    merchants = shared_table(merchants, "merchants")
    kept_rows = results.of_size(merchants, config.min_community_size)
    return Clustered(merchants, results.community_rows(kept_rows, v, config.city_code), results.business_rows(merchants, metadata, update_time, config.min_community_size), kept, partition, counts)


def initial(raw: DataFrame, regions: dict[str, list[str]], dt: str, config: JobConfig, update_time: str) -> DataFrame:
    """Target rows of a first run: clusters, existing and directly assigned communities, cross-region stores."""
    included, cross = clean.split_by_region(raw, regions)
    outside = assign.cross_region_rows(cross, included, update_time, dt)
    if included.isEmpty():
        return outside
    tx = shared_table(clean.load_table(included, dt), "transactions")
    done = cluster(tx, config, update_time)
    target = results.target_rows(done.business, dt, config.min_community_size)
    existing = clean.existing_districts(tx)
    if not existing.isEmpty():
        existing = existing.withColumn("community_id", results.formatted_id(F.col("community_id")))
        cands = assign.candidates(tx, existing, dt)
        coords = clean.reliable_coordinates(clean.merchant_coordinates(tx, strict=False), config.geo.max_merchants_per_coordinate)
        v = visits.build_visits(tx, config.visits)
        graph = edges.mutual_top_k(edges.candidates(pairs.pair_statistics(v, config.pairs), config.graph, config.pairs.min_support), config.graph.top_k)
        found = assign.assigned(cands, coords, existing, shared_table(graph, "graph"), config.geo.radius_m)
        target = assign.merged_initial(target, assign.assigned_rows(found, update_time), existing, config.min_community_size)
    return assign.append_new(target, outside)


def incremental(raw: DataFrame, regions: dict[str, list[str]], dt: str, config: JobConfig, update_time: str) -> DataFrame:
    """Target rows of a daily run: new merchants by distance or strongest edge, existing ones as they are."""
    included, cross = clean.split_by_region(raw, regions)
    everything = included.unionByName(cross)
    excluded = None if everything.isEmpty() else assign.excluded_rows(clean.load_table(everything, dt), update_time, dt)
    included, cross = clean.exclude_statuses(included), clean.exclude_statuses(cross)
    included, cross = clean.keep_assigned(included, cross)
    outside = assign.cross_region_rows(cross, included, update_time, dt)
    tx = shared_table(clean.load_table(clean.drop_interfered(included), dt), "transactions")
    existing = clean.existing_districts(tx)
    assign.need_existing(existing)
    v = visits.build_visits(tx, config.visits)
    graph = edges.mutual_top_k(edges.candidates(pairs.pair_statistics(v, config.pairs), config.graph, config.pairs.min_support), config.graph.top_k)
    coords = clean.reliable_coordinates(clean.merchant_coordinates(tx, strict=False), config.geo.max_merchants_per_coordinate)
    found = assign.assigned(assign.candidates(tx, existing, dt), coords, existing, shared_table(graph, "graph"), config.geo.radius_m)
    out = assign.combined(assign.assigned_rows(found, update_time), assign.existing_rows(tx, existing, update_time, dt), tx)
    out = assign.append_new(out, outside)
    return out if excluded is None else assign.overlay(out, excluded)
