import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placeweave.config import AnchorConfig
from placeweave.operators import community, geo, kernels, regional, results


def graph(spark, rows, extra=()):
    e = spark.createDataFrame([(a, b, float(w), 1) for a, b, w in rows], "l string, r string, weight double, support long")
    names = sorted({x for a, b, _ in rows for x in (a, b)} | set(extra))
    return spark.createDataFrame([(n,) for n in names], "node string"), e


TRIANGLES = [("a", "b", 10), ("a", "c", 10), ("b", "c", 10), ("x", "y", 10), ("x", "z", 10), ("y", "z", 10), ("c", "x", 0.01)]


def test_two_triangles_and_a_single(spark):
    nodes, e = graph(spark, TRIANGLES, ["lone"])
    got = {r.node: r.community_id for r in community.detect(nodes, e).collect()}
    assert got == {"a": 0, "b": 0, "c": 0, "x": 1, "y": 1, "z": 1, "lone": 2}


def test_components(spark):
    nodes, e = graph(spark, [("a", "b", 1), ("b", "c", 1), ("c", "d", 1), ("x", "y", 1)], ["lone"])
    got = {r.node: r.component_id for r in community.components(nodes, e).collect()}
    assert got == {"a": 0, "b": 0, "c": 0, "d": 0, "x": 1, "y": 1, "lone": 2}


@settings(max_examples=40, deadline=None)
@given(st.integers(2, 14), st.integers(0, 10**6))
def test_kernel_covers_connects_and_does_not_lower_quality(n, seed):
    rng = np.random.default_rng(seed)
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.35]
    if not pairs:
        return
    l, r = (np.array(x) for x in zip(*pairs, strict=True))
    w = rng.uniform(0.1, 2, len(l))
    label = kernels.communities(n, l, r, w)
    assert len(label) == n
    assert kernels.modularity(n, l, r, w, label) >= kernels.modularity(n, l, r, w, np.arange(n)) - 1e-9
    for c in set(label.tolist()):
        inside = {i for i in range(n) if label[i] == c}
        seen, todo = set(), [min(inside)]
        while todo:
            i = todo.pop()
            if i not in seen:
                seen.add(i)
                todo += [b for a, b in [*pairs, *((b, a) for a, b in pairs)] if a == i and b in inside]
        assert seen == inside


def test_pagerank_sums_to_one_and_follows_weight():
    p = kernels.pagerank(3, np.array([0, 0]), np.array([1, 2]), np.array([3.0, 1.0]))
    assert abs(p.sum() - 1) < 1e-9 and p[0] > p[1] > p[2]
    assert kernels.pagerank(4, np.array([], int), np.array([], int), np.array([])).tolist() == [0.25] * 4


def test_shares_of_a_bridge(spark):
    nodes, e = graph(spark, [("a", "b", 1), ("b", "c", 1)])
    part = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "node string, community_id long")
    got = {(r.node, r.community_id): r.share for r in community.shares(e, part).collect()}
    assert got["b", 0] == got["b", 1] == 0.5
    rows = part.select(F.col("node").alias("merchant_id"), "community_id", F.lit(1).alias("is_anchor_candidate"), F.lit(0.7).alias("anchor_score"))
    b = {r.community_id: r for r in results.expanded(rows, community.shares(e, part)).where("merchant_id = 'b'").collect()}
    assert (b[0].is_anchor_candidate, b[0].anchor_score, b[1].is_anchor_candidate, b[1].anchor_score) == (1, 0.7, 0, 0.0)
    assert b[1].is_multi_community_member == 1 and b[1].is_primary_community == 0


def test_online_rule(spark):
    _, e = graph(spark, [("far", "a", 1), ("far", "b", 1), ("a", "b", 1)])
    coords = spark.createDataFrame([("a", 121.0, 31.0), ("b", 121.05, 31.0)], "merchant_id string, longitude double, latitude double")
    assert [r[0] for r in geo.suspect_online(e, coords, 2, 1000).collect()] == ["far"]
    assert geo.suspect_online(e, coords, 2, 9000).count() == 0 and geo.suspect_online(e, coords, 3, 1000).count() == 0


def test_chain_rows(spark):
    shares = spark.createDataFrame([("k", 0, 0.9), ("k", 1, 0.1)], "node string, community_id long, share double")
    chains = spark.createDataFrame([("k", "visit_count"), ("q", "merchant_category")], "merchant_id string, chain_reason string")
    counts = spark.createDataFrame([("k", 50)], "merchant_id string, visits long")
    got = {(r.merchant_id, r.community_id): r for r in results.chain_rows(chains, shares, counts, "c", 5).collect()}
    assert set(got) == {("k", 0), ("k", 1), ("q", -1)}
    assert got["k", 0].is_primary_community == 1 and got["k", 1].is_primary_community == 0 and abs(got["k", 0].participation - 0.18) < 1e-12
    assert got["q", -1].merchant_status == "suspect_isolated" and got["q", -1].visit_count == 0


def test_anchor_count(spark):
    rows = spark.createDataFrame([(f"m{i:02d}", 0, 0.0, float(i), 0.0, 1) for i in range(30)] + [("s", 1, 0.0, 1.0, 0.0, 1)], "merchant_id string, community_id long, participation double, anchor_score double, weighted_degree double, visit_count long")
    got = sorted(r[0] for r in results.anchors(rows, AnchorConfig(1, 10, 10, 2)).collect())
    assert got == ["m27", "m28", "m29"]


def test_agglomerative_and_trimming(spark):
    d = kernels.distances(np.array([121.0, 121.001, 121.1]), np.array([31.0, 31.0, 31.0]))
    assert kernels.agglomerative(d, 1500).tolist() == [0, 0, 1]
    assert kernels.agglomerative(d, float(d[0, 1])).tolist() == [0, 1, 2]  # not at the threshold itself
    assert np.allclose(kernels.distances_to(np.array([121.0, 121.1]), np.full(2, 31.0), 121.001, 31.0), d[1, [0, 2]])
    assert kernels.trimmed(np.array([121.0, 121.001, 121.5]), np.full(3, 31.0), 2500).tolist() == [True, True, False]
    pts = spark.createDataFrame([(0, 121.0, 31.0), (1, 121.01, 31.0), (2, 125.0, 31.0)], "community_id long, longitude double, latitude double")
    assert {r.community_id: r.geo_cluster for r in regional.merged_centres(pts, 1500).collect()} == {0: 0, 1: 0, 2: 2}


def test_hub_cleaning(spark):
    nodes, e = graph(spark, [*TRIANGLES[:6], ("a", "hub", 9), ("x", "hub", 9), ("b", "hub", 9), ("y", "hub", 9)])
    statuses, kept, part = community.clean_hubs(nodes, e, 4, 0.4, 3)
    assert {r.node for r in statuses.where("status = 'suspect_online'").collect()} == {"hub"}
    assert kept.count() == 6 and part.select("community_id").distinct().count() == 2


def test_local_update_keeps_ids(spark):
    nodes, e = graph(spark, [("a", "b", 5), ("b", "c", 1), ("c", "d", 5)], ["new"])
    part = spark.createDataFrame([(n, 7) for n in "abcd"], "node string, community_id long")
    touched = spark.createDataFrame([("d",), ("new",), ("unknown",)], "node string")
    got = {r.node: r.community_id for r in regional.local_update(nodes, e, part, touched).collect()}
    assert got == {"a": 7, "b": 7, "c": 7, "d": 7, "new": 8}
    two = spark.createDataFrame([("a", 3), ("b", 3), ("c", 3), ("d", 3), ("gone", 9)], "node string, community_id long")
    got = {r.node: r.community_id for r in regional.local_update(nodes, e, two, spark.createDataFrame([("a",), ("d",)], "node string"), resolution=2.0).collect()}
    # both pairs want 3 with the weight 11: the one with the smaller node has it
    assert got == {"a": 3, "b": 3, "c": 10, "d": 10}
    assert regional.local_update(nodes, e, part, touched.limit(0)).count() == 4
