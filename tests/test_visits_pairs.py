import math

import pytest
from pyspark.sql import functions as F

from placeweave.config import GraphConfig, PairConfig, VisitConfig
from placeweave.errors import ConfigError
from placeweave.operators import edges, pairs, visits


def tx(spark, rows):
    return spark.createDataFrame(rows, "card_id string, merchant_id string, t string").select("card_id", "merchant_id", F.to_timestamp("t").cast("timestamp_ntz").alias("timestamp"))


def test_gap_of_the_window_starts_a_visit(spark):
    d = tx(spark, [("c", "a", "2024-01-01 10:00:00"), ("c", "a", "2024-01-01 10:29:59"), ("c", "a", "2024-01-01 10:59:58"), ("c", "a", "2024-01-01 11:29:58")])
    got = [r.timestamp.strftime("%H:%M:%S") for r in visits.merged(d, 30).orderBy("timestamp").collect()]
    assert got == ["10:00:00", "11:29:58"]


def test_busy_days_go_and_others_stay(spark):
    d = tx(spark, [("c", m, f"2024-01-01 1{i}:00:00") for i, m in enumerate("abc")] + [("c", "a", "2024-01-02 10:00:00")])
    left = visits.build_visits(d, VisitConfig(30, 2)).collect()
    assert [(r.merchant_id, r.timestamp.day) for r in left] == [("a", 2)]


def test_one_vote_a_card_at_its_closest_visits(spark):
    d = tx(spark, [("c", "a", "2024-01-01 10:00:00"), ("c", "b", "2024-01-01 10:10:00"), ("c", "a", "2024-01-02 10:00:00"), ("c", "b", "2024-01-02 11:00:00")])
    (r,) = pairs.pair_statistics(d, PairConfig(120, 60.0, 1)).collect()
    assert (r.l, r.r, r.support) == ("a", "b", 1) and abs(r.strength - math.exp(-1 / 6)) < 1e-12


def test_window_edges_and_equal_times(spark):
    d = tx(spark, [("c", "a", "2024-01-01 10:00:00"), ("c", "b", "2024-01-01 12:00:00"), ("c", "z", "2024-01-01 12:00:01"), ("d", "a", "2024-01-01 23:59:59"), ("d", "b", "2024-01-01 23:59:59")])
    got = {(r.card_id, r.l, r.r): r.weight for r in pairs.evidence(d, 120, 60.0).collect()}
    assert set(got) == {("c", "a", "b"), ("c", "b", "z"), ("d", "a", "b")} and got["d", "a", "b"] == 1.0


def test_merged_statistics_equal_whole(spark):
    d = tx(spark, [(c, m, f"2024-01-01 10:{i:02d}:00") for c in "xyz" for i, m in enumerate("abc")])
    whole = {(r.l, r.r): (round(r.strength, 9), r.support) for r in pairs.pair_statistics(d).collect()}
    parts = pairs.merge_statistics(pairs.pair_statistics(d.where("card_id = 'x'")), pairs.pair_statistics(d.where("card_id <> 'x'")))
    assert {(r.l, r.r): (round(r.strength, 9), r.support) for r in parts.collect()} == whole and len(whole) == 3


def stats(spark, rows):
    return spark.createDataFrame(rows, "l string, r string, strength double, support long")


def test_unsmoothed_sppmi_is_plain_pmi(spark):
    p = stats(spark, [("a", "b", 8.0, 5), ("a", "c", 2.0, 5), ("b", "c", 2.0, 5), ("d", "e", 100.0, 5)])
    got = {(r.l, r.r): r.sppmi for r in edges.sppmi_metrics(p, 1.0, 1.0).collect()}
    assert abs(got["a", "b"] - math.log(8 * 112 / 100)) < 1e-12


def test_transaction_count_weight_is_strength(spark):
    p = stats(spark, [("a", "b", 8.5, 2), ("a", "c", 2.0, 1)])
    got = edges.candidates(p, GraphConfig(method="transaction_count"), 2).collect()
    assert [(r.l, r.r, r.weight, r.z_score) for r in got] == [("a", "b", 8.5, None)]
    with pytest.raises(ConfigError):
        GraphConfig(method="other")


def weighted(spark, rows):
    return spark.createDataFrame([(a, b, float(w), 1) for a, b, w in rows], "l string, r string, weight double, support long")


def test_degree_penalty(spark):
    e = weighted(spark, [("a", "b", 9), ("a", "c", 4), ("b", "c", 4), ("a", "d", 1)])
    got = {(r.l, r.r): r.weight for r in edges.degree_penalised(e, 0.5).collect()}
    assert abs(got["a", "b"] - 9 / math.sqrt(6)) < 1e-12


def test_jaccard_drops_the_pendant(spark):
    e = weighted(spark, [("a", "b", 1), ("a", "c", 1), ("b", "c", 1), ("a", "d", 1)])
    got = {(r.l, r.r): r.jaccard for r in edges.prepared(e, 0.0, 0.2).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")} and got["a", "b"] == 0.25


def test_mutual_top_k(spark):
    e = weighted(spark, [("a", "b", 3), ("a", "c", 2), ("b", "c", 1), ("c", "d", 5)])
    assert {(r.l, r.r) for r in edges.mutual_top_k(e, 1).collect()} == {("a", "b"), ("c", "d")}


def test_chain_threshold_is_nearest_rank(spark):
    for n in (7, 10, 101):
        c = spark.createDataFrame([(str(i), i) for i in range(1, n + 1)], "merchant_id string, visits long")
        for q in (0.07, 0.57, 0.9, 0.99):
            assert edges.chain_threshold(c, q, 1) == max(1, math.ceil(n * q))
    assert edges.chain_threshold(spark.createDataFrame([], "merchant_id string, visits long"), 0.9, 5) == 5
