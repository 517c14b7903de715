from pyspark.sql import functions as F

from placeweave.operators import community, fusion, regional, report

SCORES = "node string, community_id string, graph double, geo double, customers double, score double"


def test_decisions_cover_every_branch(spark):
    rows = [
        ("sure", "A", 0.9, 0.8, 0.0, 0.8), ("sure", "B", 0.1, 0.1, 0.0, 0.1),
        ("weak", "A", 0.2, 0.0, 0.0, 0.2),
        ("close", "A", 0.5, 0.5, 0.0, 0.5), ("close", "B", 0.4, 0.4, 0.0, 0.45),
        ("conflict", "A", 0.9, 0.0, 0.0, 0.7), ("conflict", "B", 0.0, 0.9, 0.0, 0.2),
        ("tie", "B", 0.5, 0.0, 0.0, 0.5), ("tie", "A", 0.5, 0.0, 0.0, 0.5),
        ("exact", "A", 0.4, 0.4, 0.0, 0.4), ("exact", "B", 0.2, 0.2, 0.0, 0.2),
    ]
    out = {r.node: (r.community_id, r.decision) for r in fusion.decisions(spark.createDataFrame(rows, SCORES), 0.4, 0.2).collect()}
    assert out == {"sure": ("A", "assign"), "weak": ("A", "watch"), "close": ("A", "review"), "conflict": ("A", "review"), "tie": ("A", "review"), "exact": ("A", "assign")}


def test_scores_of_nothing_are_empty(spark):
    edges = spark.createDataFrame([], "l string, r string, weight double")
    members = spark.createDataFrame([], "merchant_id string, community_id string")
    coords = spark.createDataFrame([], "merchant_id string, longitude double, latitude double")
    visits = spark.createDataFrame([], "card_id string, merchant_id string")
    fused = fusion.fused(fusion.graph_scores(edges, members, members, 3), fusion.geo_scores(coords, members, 100.0), fusion.customer_scores(visits, members), coords)
    assert fusion.decisions(fused, 0.4, 0.2).isEmpty()
    assert fusion.inferred_coordinates(edges, coords, 3).isEmpty()


def test_members_without_evidence_are_doubtful(spark):
    members = spark.createDataFrame([("a", "A"), ("b", "A")], "merchant_id string, community_id string")
    scores = spark.createDataFrame([("a", "A", 0.5, 0.5, 0.5, 0.5), ("b", "B", 0.9, 0.9, 0.9, 0.9)], SCORES)
    assert [tuple(r) for r in fusion.doubtful_members(scores, members, 0.5).collect()] == [("b", "A", 0.0)]


def test_large_components_keep_the_objective(spark, monkeypatch):
    cliques = [(f"n{8 * g + i}", f"n{8 * g + j}", 1.0) for g in range(4) for i in range(8) for j in range(i + 1, 8)]
    bridges = [(f"n{8 * g}", f"n{8 * g + 8}", 0.5) for g in range(3)]
    edges = spark.createDataFrame([(min(l, r), max(l, r), w) for l, r, w in cliques + bridges] + [("x", "y", 1.0)], "l string, r string, weight double")
    nodes = spark.createDataFrame([(f"n{i}",) for i in range(32)] + [("x",), ("y",), ("z",)], "node string")
    want = {r.node: r.community_id for r in community.detect(nodes, edges).collect()}
    monkeypatch.setattr(community, "MAX_KERNEL_EDGES", 50)
    got = {r.node: r.community_id for r in community.detect(nodes, edges).collect()}
    assert got == want
    assert len(set(got.values())) == 6


def test_top_communities_break_ties_by_id(spark):
    rows = [(1, "B"), (1, "A"), (1, None), (2, "B"), (2, "B"), (2, "A")]
    out = regional.top_communities(spark.createDataFrame(rows, "geo_cluster int, community_id string"))
    assert sorted(map(tuple, out.collect())) == [(1, "A"), (2, "B")]


def test_coverage_of_no_merchants_is_zero(spark):
    none = spark.createDataFrame([], "merchant_id string")
    assert tuple(report.merchant_coverage(none, none).first()) == (0, 0, 0.0)
    some = spark.createDataFrame([("a",), ("a",), ("b",)], "merchant_id string")
    assert tuple(report.merchant_coverage(some, none, some.where(F.col("merchant_id") == "a")).first()) == (2, 1, 0.5)
