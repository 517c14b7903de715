"""All queries over the trade-area operators, with their SQL.

Floating results are rounded to six places on both sides, since sums depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import AnchorConfig, GraphConfig, JobConfig, PairConfig, VisitConfig
from .functions import text
from .operators import assign, clean, community, edges, fusion, geo, keywords, pairs, regional, report, results, visits
from .plans import jobs
from .sources.tables import shared_table
from .plans.planted import COORDS_SQL, EDGES_SQL, PAIRS_SQL, TX_SQL, VISITS_SQL, table, transactions, with_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

GRAPH = GraphConfig(top_k=4)


def query(sql: str | None = None, *parts: str):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = with_sql(sql, *parts) if parts else sql
        return f

    return add


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


BASE = (TX_SQL, VISITS_SQL)
PAIRS = (*BASE, PAIRS_SQL)
EDGES = (*PAIRS, EDGES_SQL)


def _visits(spark, sf_dir):
    return visits.build_visits(transactions(spark, sf_dir), VisitConfig())


def _pairs(spark, sf_dir):
    return pairs.pair_statistics(_visits(spark, sf_dir), PairConfig())


def _candidates(spark, sf_dir):
    stats = shared_table(_pairs(spark, sf_dir), "pairs")  # read several times below
    return shared_table(edges.candidates(stats, GRAPH), "candidates")


def _edges(spark, sf_dir):
    c = _candidates(spark, sf_dir).withColumn("weight", F.round("weight", 9))
    return shared_table(edges.mutual_top_k(c, GRAPH.top_k), "edges")


def _nodes(spark, sf_dir):
    return visits.visit_counts(_visits(spark, sf_dir)).select(F.col("merchant_id").alias("node"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


# -- visits and pairs ----------------------------------------------------------------


@query("SELECT card_id, merchant_id, \"timestamp\" FROM visits", *BASE)
def w2_visits(spark, sf_dir):
    return _visits(spark, sf_dir)


@query("SELECT card_id, day, merchants FROM daily", *BASE)
def a1_daily_merchants(spark, sf_dir):
    return visits.daily_merchants(visits.merged(transactions(spark, sf_dir), 30))


@query('SELECT v1.* FROM v1 WHERE NOT EXISTS (SELECT 1 FROM daily d WHERE d.card_id = v1.card_id AND d.day = CAST(v1."timestamp" AS DATE) AND d.merchants > 1)', *BASE)
def p14_daily_cap(spark, sf_dir):
    return visits.without_busy_days(visits.merged(transactions(spark, sf_dir), 30), 1)


@query("SELECT card_id, l, r, round(weight, 6) AS weight FROM evidence", *PAIRS)
def j1_evidence(spark, sf_dir):
    return rounded(pairs.evidence(_visits(spark, sf_dir), 120, 60.0), "weight")


@query("SELECT card_id, l, r, round(weight, 6) AS weight FROM votes", *PAIRS)
def a3_card_votes(spark, sf_dir):
    return rounded(pairs.card_votes(pairs.evidence(_visits(spark, sf_dir), 120, 60.0)), "weight")


@query("SELECT l, r, round(strength, 6) AS strength, support FROM pairs", *PAIRS)
def a4_pairs(spark, sf_dir):
    return rounded(_pairs(spark, sf_dir), "strength")


@query("SELECT l, r, round(strength, 6) AS strength, support FROM pairs", *PAIRS)
def a5_merged_statistics(spark, sf_dir):
    v = _visits(spark, sf_dir)
    half = F.pmod(F.xxhash64("card_id"), F.lit(2))
    return rounded(pairs.merge_statistics(pairs.pair_statistics(v.where(half == 0)), pairs.pair_statistics(v.where(half == 1))), "strength")


@query("SELECT merchant_id, visits FROM counts", *BASE)
def a6_visit_counts(spark, sf_dir):
    return visits.visit_counts(_visits(spark, sf_dir))


@query("SELECT node, round(marginal, 6) AS marginal FROM margins", *EDGES)
def a7_marginals(spark, sf_dir):
    return rounded(edges.marginals(_pairs(spark, sf_dir)), "marginal")


@query("SELECT greatest(CAST(quantile_disc(visits, 0.9) AS BIGINT), 5) AS threshold FROM counts", *BASE)
def a8_chain_threshold(spark, sf_dir):
    n = edges.chain_threshold(visits.visit_counts(_visits(spark, sf_dir)), 0.9, 5)
    return spark.createDataFrame([(n,)], "threshold long")


# -- edges ---------------------------------------------------------------------------


@query("SELECT l, r, round(sppmi, 6) AS sppmi, round(z_score, 6) AS z_score, support FROM metrics", *EDGES)
def g1_sppmi(spark, sf_dir):
    return rounded(edges.sppmi_metrics(_pairs(spark, sf_dir)), "sppmi", "z_score").drop("strength")


@query("SELECT l, r, round(weight, 6) AS weight, support FROM candidates", *EDGES)
def g3_candidates(spark, sf_dir):
    return rounded(_candidates(spark, sf_dir), "weight").drop("z_score")


@query("SELECT l, r, round(strength, 6) AS weight, support FROM pairs WHERE support >= 2", *PAIRS)
def g2_transaction_count(spark, sf_dir):
    return rounded(edges.candidates(_pairs(spark, sf_dir), GraphConfig(method="transaction_count"), 2), "weight").drop("z_score")


@query("SELECT node, other FROM ranked WHERE n <= 4", *EDGES)
def w5_top_neighbours(spark, sf_dir):
    return edges.top_neighbours(_candidates(spark, sf_dir).withColumn("weight", F.round("weight", 9)), 4)


@query("SELECT l, r, round(weight, 6) AS weight, support FROM edges", *EDGES)
def g5_mutual_top_k(spark, sf_dir):
    return rounded(_edges(spark, sf_dir), "weight").drop("z_score")


JACCARD_SQL = """
nb AS (SELECT l AS node, r AS other FROM candidates UNION ALL SELECT r, l FROM candidates),
deg AS (SELECT node, count(*) AS d FROM nb GROUP BY 1),
common AS (SELECT c.l, c.r, count(*) AS n FROM candidates c JOIN nb a ON a.node = c.l JOIN nb b ON b.node = c.r AND b.other = a.other GROUP BY 1, 2),
jac AS (SELECT c.l, c.r, c.weight, x.d AS dl, y.d AS dr, coalesce(n, 0) / CAST(x.d + y.d - coalesce(n, 0) AS DOUBLE) AS jaccard
  FROM candidates c LEFT JOIN common USING (l, r) JOIN deg x ON x.node = c.l JOIN deg y ON y.node = c.r)"""


@query("SELECT l, r, round(jaccard, 6) AS jaccard FROM jac", *EDGES, JACCARD_SQL)
def u5_jaccard(spark, sf_dir):
    return rounded(edges.jaccard(_candidates(spark, sf_dir)), "jaccard").select("l", "r", "jaccard")


@query("SELECT l, r, round(weight / pow(dl * dr, 0.5), 6) AS weight, round(jaccard, 6) AS jaccard FROM jac WHERE jaccard >= 0.2", *EDGES, JACCARD_SQL)
def g4_prepared(spark, sf_dir):
    return rounded(edges.prepared(_candidates(spark, sf_dir), 0.5, 0.2), "weight", "jaccard").select("l", "r", "weight", "jaccard")


@query("SELECT l, r FROM edges WHERE l NOT LIKE 'hub%' AND r NOT LIKE 'hub%'", *EDGES)
def j16_without_chains(spark, sf_dir):
    hubs = _nodes(spark, sf_dir).where(F.col("node").startswith("hub"))
    return edges.without_nodes(_edges(spark, sf_dir), hubs).select("l", "r")


@query("SELECT l, r FROM edges WHERE l LIKE 'm0%' AND r LIKE 'm0%'", *EDGES)
def g26_induced(spark, sf_dir):
    return edges.within_nodes(_edges(spark, sf_dir), _nodes(spark, sf_dir).where(F.col("node").startswith("m0"))).select("l", "r")


@query("SELECT node, other, support FROM near", *EDGES)
def u4_both_ways(spark, sf_dir):
    return pairs.both_ways(_candidates(spark, sf_dir), "support")


@query(
    "SELECT merchant_id, min(reason) AS chain_reason FROM (SELECT DISTINCT merchant_id, 'merchant_category' AS reason FROM tx WHERE merchant_category = 2 UNION ALL SELECT merchant_id, 'visit_count' FROM counts WHERE visits >= (SELECT greatest(quantile_disc(visits, 0.9), 5) FROM counts)) GROUP BY 1",
    *BASE,
)
def u3_chain_merchants(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    c = visits.visit_counts(_visits(spark, sf_dir))
    return edges.chain_merchants(c, tx.select("merchant_id", "merchant_category").distinct(), edges.chain_threshold(c, 0.9, 5))


@query(
    """, w AS (SELECT l, r, CASE WHEN a <= 40 THEN 3.0 WHEN a <= 80 THEN 2.0 ELSE 1.0 END AS w FROM (SELECT l, r, abs(epoch_us(b."timestamp") - epoch_us(a."timestamp")) / 6e7 AS a
    FROM (SELECT card_id, merchant_id AS l, "timestamp" FROM visits) a JOIN (SELECT card_id, merchant_id AS r, "timestamp" FROM visits) b ON a.card_id = b.card_id AND l < r AND b."timestamp" BETWEEN a."timestamp" - INTERVAL 120 MINUTE AND a."timestamp" + INTERVAL 120 MINUTE))
    SELECT l, r, CAST(sum(w) AS DOUBLE) AS weight FROM w GROUP BY 1, 2""",
    *BASE,
)
def a21_tiered_weights(spark, sf_dir):
    return pairs.tiered_evidence(_visits(spark, sf_dir))


# -- cleaning ------------------------------------------------------------------------


@query("SELECT merchant_id, region, dt, merchant_category FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY \"timestamp\" DESC, region DESC, dt DESC) AS n FROM tx) WHERE n = 1", TX_SQL)
def w3_latest_metadata(spark, sf_dir):
    return clean.latest_metadata(transactions(spark, sf_dir))


@query("SELECT merchant_id, longitude, latitude FROM coords", TX_SQL, COORDS_SQL)
def p7_coordinates(spark, sf_dir):
    return clean.merchant_coordinates(transactions(spark, sf_dir))


@query("SELECT longitude, latitude, count(*) AS merchants FROM coords GROUP BY 1, 2", TX_SQL, COORDS_SQL)
def a19_shared_coordinates(spark, sf_dir):
    return clean.shared_coordinates(clean.merchant_coordinates(transactions(spark, sf_dir)))


@query("SELECT merchant_id, round(longitude, 1) AS longitude, latitude FROM coords WHERE round(longitude, 1) IN (SELECT round(longitude, 1) FROM coords GROUP BY 1 HAVING count(*) <= 5)", TX_SQL, COORDS_SQL)
def p6_reliable_coordinates(spark, sf_dir):
    c = clean.merchant_coordinates(transactions(spark, sf_dir)).withColumn("longitude", F.round("longitude", 1))
    return clean.reliable_coordinates(c, 5)


@query("SELECT DISTINCT merchant_id, business_district AS community_id FROM tx WHERE business_district <> ''", TX_SQL)
def a30_existing_districts(spark, sf_dir):
    return clean.existing_districts(transactions(spark, sf_dir))


@query(
    "SELECT o_orderkey AS global_flow_number, o_custkey AS storename FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1"
)
def w1_first_of_flow(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("global_flow_number"), F.col("o_orderdate").cast("string").alias("dt"), F.lit("").alias("transaction_time"), F.col("o_orderkey").alias("account_number"), F.lit("").alias("storename"))
    return clean.first_of_flow(o).select(F.col("account_number").alias("global_flow_number"), F.col("global_flow_number").alias("storename"))


# -- geography -----------------------------------------------------------------------

HAVERSINE_SQL = "2 * 6371008.8 * asin(sqrt(least(pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2), 1.0)))"


@query(f"SELECT a.merchant_id AS l, b.merchant_id AS r, round({HAVERSINE_SQL}, 3) AS distance_m FROM coords a JOIN coords b ON a.merchant_id < b.merchant_id AND {HAVERSINE_SQL} <= 6000", TX_SQL, COORDS_SQL)
def j10_nearby_pairs(spark, sf_dir):
    c = clean.merchant_coordinates(transactions(spark, sf_dir))
    return geo.nearby_pairs(c, 6000).withColumn("distance_m", F.round("distance_m", 3))


@query(
    f"""SELECT candidate, community_id, member, round(d, 3) AS distance_m FROM (SELECT a.merchant_id AS candidate, b.community_id, b.merchant_id AS member, {HAVERSINE_SQL} AS d,
    row_number() OVER (PARTITION BY a.merchant_id ORDER BY {HAVERSINE_SQL}, b.community_id, b.merchant_id) AS n
    FROM coords a JOIN (SELECT c.*, k.community_id FROM coords c JOIN known k USING (merchant_id)) b ON {HAVERSINE_SQL} <= 3000 WHERE a.merchant_id NOT IN (SELECT merchant_id FROM known)) WHERE n = 1""",
    TX_SQL,
    COORDS_SQL,
    "known AS (SELECT DISTINCT merchant_id, business_district AS community_id FROM tx WHERE business_district <> '')",
)
def j9_nearest_member(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    c, known = clean.merchant_coordinates(tx), clean.existing_districts(tx)
    return geo.nearest_member(c.join(known, "merchant_id", "left_anti"), c.join(known, "merchant_id"), 3000).withColumn("distance_m", F.round("distance_m", 3))


@query(
    f"""SELECT DISTINCT x.node AS merchant_id FROM nb x JOIN coords a ON a.merchant_id = x.other JOIN nb y ON y.node = x.node JOIN coords b ON b.merchant_id = y.other
    WHERE {HAVERSINE_SQL} > 3000 AND x.node NOT IN (SELECT merchant_id FROM coords) AND x.node IN (SELECT n.node FROM nb n JOIN coords c ON c.merchant_id = n.other GROUP BY 1 HAVING count(*) >= 2)""",
    *EDGES,
    COORDS_SQL,
    "nb AS (SELECT l AS node, r AS other FROM candidates UNION ALL SELECT r, l FROM candidates)",
)
def g12_suspect_online(spark, sf_dir):
    return geo.suspect_online(_candidates(spark, sf_dir), clean.merchant_coordinates(transactions(spark, sf_dir)), 2, 3000)


@query(
    f"""SELECT l, r, round(coalesce(weight, 0) + CASE WHEN s THEN (SELECT 10 * max(weight) FROM candidates) ELSE 0 END, 6) AS weight, CAST(coalesce(s, false) AS INTEGER) AS geo_seed
    FROM candidates FULL OUTER JOIN (SELECT a.merchant_id AS l, b.merchant_id AS r, true AS s FROM coords a JOIN coords b ON a.merchant_id < b.merchant_id AND {HAVERSINE_SQL} <= 300) USING (l, r)""",
    *EDGES,
    COORDS_SQL,
)
def g14_seed_edges(spark, sf_dir):
    c = clean.merchant_coordinates(transactions(spark, sf_dir))
    return rounded(geo.with_seed_edges(_candidates(spark, sf_dir), c, 300), "weight").select("l", "r", "weight", "geo_seed")


# -- communities ---------------------------------------------------------------------



@query()
def g9_components(spark, sf_dir):
    return community.components(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query()
def g6_communities(spark, sf_dir):
    return community.detect(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query()
def g15_louvain(spark, sf_dir):
    return community.detect(_nodes(spark, sf_dir), _edges(spark, sf_dir), 0.5, refine=False)


def _planted_partition(spark, sf_dir):
    """Merchants by their planted group, hubs in a group of their own: a partition that SQL can name."""
    return _nodes(spark, sf_dir).select("node", F.when(F.col("node").startswith("hub"), 10).otherwise(F.substring("node", 3, 1).cast("int")).cast("long").alias("community_id"))


PARTITION_SQL = """
part AS (SELECT merchant_id AS node, CAST(CASE WHEN merchant_id LIKE 'hub%' THEN '10' ELSE substr(merchant_id, 3, 1) END AS BIGINT) AS community_id FROM counts),
eb AS (SELECT l AS node, r AS other, weight FROM edges UNION ALL SELECT r, l, weight FROM edges),
cw AS (SELECT eb.node, part.community_id, sum(weight) AS w FROM eb JOIN part ON part.node = eb.other GROUP BY 1, 2),
sh AS (SELECT node, community_id, w / sum(w) OVER (PARTITION BY node) AS share FROM cw UNION ALL SELECT node, community_id, 1.0 FROM part WHERE node NOT IN (SELECT node FROM cw))"""
PART = (*EDGES, PARTITION_SQL)


@query("SELECT node, community_id, round(share, 6) AS share FROM sh", *PART)
def a9_shares(spark, sf_dir):
    return rounded(community.shares(_edges(spark, sf_dir), _planted_partition(spark, sf_dir)), "share")


@query("SELECT node, round(1 - sum(share * share), 6) AS participation FROM sh GROUP BY 1", *PART)
def a10_participation(spark, sf_dir):
    return rounded(community.participation(community.shares(_edges(spark, sf_dir), _planted_partition(spark, sf_dir))), "participation")


@query("SELECT node, count(*) AS degree, round(sum(weight), 6) AS weighted_degree FROM eb GROUP BY 1", *PART)
def g11_weighted_degrees(spark, sf_dir):
    return rounded(community.weighted_degrees(_edges(spark, sf_dir)), "weighted_degree")


@query("SELECT node, community_id, round(w / sum(w) OVER (PARTITION BY node), 6) AS share FROM (SELECT near.node, part.community_id, sum(weight) AS w FROM near JOIN part ON part.node = near.other GROUP BY 1, 2)", *PART)
def g13_candidate_shares(spark, sf_dir):
    return rounded(community.candidate_shares(_candidates(spark, sf_dir), _planted_partition(spark, sf_dir)), "share")


@query()
def g10_pagerank(spark, sf_dir):
    return rounded(community.pageranks(_edges(spark, sf_dir), _planted_partition(spark, sf_dir)), "pagerank")


@query(
    """, x AS (SELECT e.weight, p.community_id AS cl, q.community_id AS cr FROM edges e JOIN part p ON p.node = e.l JOIN part q ON q.node = e.r),
    tot AS (SELECT sum(weight) AS w FROM x),
    vol AS (SELECT c, sum(weight) AS vol, sum(cut) AS cut FROM (SELECT cl AS c, weight, CASE WHEN cl = cr THEN 0 ELSE weight END AS cut FROM x UNION ALL SELECT cr, weight, CASE WHEN cl = cr THEN 0 ELSE weight END FROM x) GROUP BY 1)
    SELECT round((SELECT sum(weight) FROM x WHERE cl = cr) / w - (SELECT sum(pow(vol / (2 * w), 2)) FROM vol), 6) AS modularity, round((SELECT sum(weight) FROM x WHERE cl = cr) / w, 6) AS coverage,
    round((SELECT avg(CASE WHEN least(vol, 2 * w - vol) > 0 THEN cut / least(vol, 2 * w - vol) ELSE 0 END) FROM vol), 6) AS conductance,
    (SELECT count(*) FROM x WHERE cl = cr) AS intra_edges, (SELECT count(*) FROM x WHERE cl <> cr) AS inter_edges, round((SELECT sum(weight) FROM x WHERE cl = cr), 6) AS intra_weight, round(w - (SELECT sum(weight) FROM x WHERE cl = cr), 6) AS inter_weight FROM tot""",
    *PART,
)
def a22_partition_quality(spark, sf_dir):
    return rounded(community.quality(_edges(spark, sf_dir), _planted_partition(spark, sf_dir)), "modularity", "coverage", "conductance", "intra_weight", "inter_weight")


# -- reports -------------------------------------------------------------------------

MARKED_SQL = "known AS (SELECT DISTINCT merchant_id FROM tx WHERE business_district <> ''), pm AS (SELECT node, max(support) AS top FROM (SELECT l AS node, support FROM pairs UNION ALL SELECT r, support FROM pairs) GROUP BY 1)"


@query(
    """SELECT count(*) AS raw_pairs, count(*) FILTER (support >= 2) AS effective_pairs,
    count(*) FILTER (l IN (FROM known) AND r IN (FROM known)) AS raw_pairs_both, count(*) FILTER (l IN (FROM known) OR r IN (FROM known)) AS raw_pairs_any,
    count(*) FILTER (support >= 2 AND l IN (FROM known) AND r IN (FROM known)) AS effective_pairs_both, count(*) FILTER (support >= 2 AND (l IN (FROM known) OR r IN (FROM known))) AS effective_pairs_any,
    (SELECT count(*) FROM pm) AS raw_merchants, (SELECT count(*) FROM pm WHERE top >= 2) AS effective_merchants,
    (SELECT count(*) FROM pm WHERE node IN (FROM known)) AS raw_merchants_assigned, (SELECT count(*) FROM pm WHERE node IN (FROM known) AND top >= 2) AS effective_merchants_assigned FROM pairs""",
    *PAIRS,
    MARKED_SQL,
)
def a14_coverage(spark, sf_dir):
    out = report.coverage(_pairs(spark, sf_dir), clean.existing_districts(transactions(spark, sf_dir)), 2)
    return out.drop(*(c for c in out.columns if c.endswith("_pct")))


@query(
    "SELECT round(100.0 * count(*) FILTER (support >= 2) / count(*), 2) AS effective_pair_pct, (SELECT round(100.0 * count(*) FILTER (top >= 2) / count(*), 2) FROM pm) AS effective_merchant_pct, (SELECT round(100.0 * count(*) FILTER (node IN (FROM known)) / count(*), 2) FROM pm) AS raw_assigned_pct FROM pairs",
    *PAIRS,
    MARKED_SQL,
)
def a14_coverage_percentages(spark, sf_dir):
    return report.coverage(_pairs(spark, sf_dir), clean.existing_districts(transactions(spark, sf_dir)), 2).select("effective_pair_pct", "effective_merchant_pct", "raw_assigned_pct")


@query(
    "SELECT count(visits) AS count, min(visits) AS min, quantile_disc(visits, 0.25) AS p25, quantile_disc(visits, 0.5) AS median, quantile_disc(visits, 0.75) AS p75, quantile_disc(visits, 0.9) AS p90, quantile_disc(visits, 0.95) AS p95, quantile_disc(visits, 0.99) AS p99, max(visits) AS max, round(avg(visits), 6) AS mean FROM counts",
    *BASE,
)
def a15_distribution(spark, sf_dir):
    return rounded(report.distribution(visits.visit_counts(_visits(spark, sf_dir)), "visits"), "mean")


@query(
    ", more AS (SELECT CAST(visits AS DOUBLE) AS v FROM counts UNION ALL SELECT 0.0 FROM range(50)) SELECT count(v) AS count, min(v) AS min, quantile_disc(v, 0.25) AS p25, quantile_disc(v, 0.5) AS median, quantile_disc(v, 0.75) AS p75, quantile_disc(v, 0.9) AS p90, quantile_disc(v, 0.95) AS p95, quantile_disc(v, 0.99) AS p99, max(v) AS max, round(avg(v), 6) AS mean FROM more",
    *BASE,
)
def a15_distribution_with_minimum(spark, sf_dir):
    return rounded(report.distribution_with_minimum(visits.visit_counts(_visits(spark, sf_dir)), "visits", 0, 50), "mean")


@query("SELECT node, count(*) AS degree, round(sum(strength), 6) AS weight_sum, CAST(sum(support) AS BIGINT) AS support_sum FROM (SELECT l AS node, strength, support FROM pairs UNION ALL SELECT r, strength, support FROM pairs) GROUP BY 1", *PAIRS)
def a16_node_metrics(spark, sf_dir):
    return rounded(report.node_metrics(_pairs(spark, sf_dir)), "weight_sum")


@query("SELECT (SELECT count(*) FROM edges) AS pairs, n AS covered, (SELECT count(*) FROM counts) - n AS isolated, round(n / (SELECT count(*) FROM counts), 6) AS coverage FROM (SELECT count(DISTINCT node) AS n FROM (SELECT l AS node FROM edges UNION ALL SELECT r FROM edges))", *EDGES)
def a17_stage_summary(spark, sf_dir):
    return rounded(report.stage_summary(visits.visit_counts(_visits(spark, sf_dir)), _edges(spark, sf_dir)), "coverage")


@query(
    "SELECT CAST(t AS INTEGER) AS threshold, (SELECT count(*) FROM pairs WHERE support >= t) AS pairs, (SELECT count(*) FROM pm WHERE top >= t) AS merchants FROM (SELECT unnest([1, 2, 3, 4, 5, 10, 20, 50, 100]) AS t)",
    *PAIRS,
    MARKED_SQL,
)
def a18_support_sweep(spark, sf_dir):
    return report.support_sweep(_pairs(spark, sf_dir), 4)


@query("SELECT node, round(marginal, 6) AS marginal FROM margins ORDER BY round(marginal, 9) DESC, node LIMIT 20", *EDGES)
def w14_top_merchants(spark, sf_dir):
    return rounded(report.top_merchants(edges.marginals(_pairs(spark, sf_dir)).withColumn("marginal", F.round("marginal", 9)), "marginal", 20), "marginal")


@query("SELECT merchant_id, visits FROM counts WHERE merchant_id NOT IN (SELECT l FROM edges UNION ALL SELECT r FROM edges)", *EDGES)
def a15_isolated(spark, sf_dir):
    return report.isolated(visits.visit_counts(_visits(spark, sf_dir)), _edges(spark, sf_dir))


STAGE_SQL = "SELECT '{0}' AS stage, (SELECT count(*) FROM {1}) AS pairs, count(DISTINCT node) AS covered FROM (SELECT l AS node FROM {1} UNION ALL SELECT r FROM {1})"


@query(" UNION ALL ".join(STAGE_SQL.format(a, b) for a, b in (("raw", "pairs"), ("supported", "(SELECT * FROM pairs WHERE support >= 1)"), ("candidate", "candidates"), ("sparse", "edges"))), *EDGES)
def c16_diagnostics(spark, sf_dir):
    return report.diagnostics(_pairs(spark, sf_dir), visits.visit_counts(_visits(spark, sf_dir)), GRAPH, 1).select("stage", "pairs", "covered")


# -- results -------------------------------------------------------------------------

HOURS_SQL = """
hc AS (SELECT p.community_id, v.merchant_id, hour("timestamp") AS h, CAST(count(*) AS DOUBLE) AS n FROM visits v JOIN part p ON p.node = v.merchant_id GROUP BY 1, 2, 3),
hp AS (SELECT community_id, h, sum(n) AS total FROM hc GROUP BY 1, 2),
hn AS (SELECT community_id, sqrt(sum(total * total)) AS norm, CAST(arg_max(h, total * 100 - h) AS INTEGER) AS peak_hour FROM hp GROUP BY 1),
hs AS (SELECT hc.community_id, hc.merchant_id, sum(n * total) / sqrt(sum(n * n)) AS s FROM hc JOIN hp USING (community_id, h) GROUP BY 1, 2)"""


@query("SELECT community_id, peak_hour, round(avg(s / norm), 6) AS hourly_consistency FROM hs JOIN hn USING (community_id) GROUP BY 1, 2", *PART, HOURS_SQL)
def a12_hourly(spark, sf_dir):
    m = _planted_partition(spark, sf_dir).withColumnRenamed("node", "merchant_id")
    return rounded(results.hourly_profiles(m, _visits(spark, sf_dir)), "hourly_consistency")


def _scored(spark, sf_dir):
    """Planted groups with visit counts for scores."""
    c = visits.visit_counts(_visits(spark, sf_dir)).withColumnRenamed("merchant_id", "node")
    return _planted_partition(spark, sf_dir).join(c, "node").select(F.col("node").alias("merchant_id"), "community_id", F.lit(0.0).alias("participation"), F.col("visits").cast("double").alias("anchor_score"), F.lit(0.0).alias("weighted_degree"), F.col("visits").alias("visit_count"))


@query("SELECT merchant_id FROM (SELECT c.merchant_id, row_number() OVER w AS n, count(*) OVER (PARTITION BY community_id) AS size FROM counts c JOIN part p ON p.node = c.merchant_id WINDOW w AS (PARTITION BY community_id ORDER BY visits DESC, merchant_id)) WHERE size >= 3 AND n <= least(size, 3)", *PART)
def w10_anchors(spark, sf_dir):
    return results.anchors(_scored(spark, sf_dir), AnchorConfig())


@query(
    "SELECT 'city' AS city_code, community_id, count(*) AS merchant_count, CAST(count(*) FILTER (n <= 2) AS BIGINT) AS anchor_count, coalesce(string_agg(CASE WHEN n <= 2 THEN merchant_id END, '|' ORDER BY visits DESC, merchant_id), '') AS anchor_merchants FROM (SELECT c.*, p.community_id, row_number() OVER (PARTITION BY community_id ORDER BY visits DESC, merchant_id) AS n FROM counts c JOIN part p ON p.node = c.merchant_id) GROUP BY 2",
    *PART,
)
def a13_community_rows(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumn("merchant_status", F.lit("active"))
    order = Window.partitionBy("community_id").orderBy(F.desc("visit_count"), "merchant_id")
    rows = rows.withColumn("is_anchor_candidate", (F.row_number().over(order) <= 2).cast("int"))
    return results.community_rows(rows, None, "city")


@query(
    "SELECT p.node AS merchant_id, p.community_id AS primary_community_id, x.community_id, round(coalesce(s.share, 0), 6) AS community_share, CAST(x.community_id = p.community_id AS INTEGER) AS is_primary_community FROM part p JOIN (SELECT node, community_id FROM sh WHERE share > 0 UNION SELECT node, community_id FROM part) x ON x.node = p.node LEFT JOIN sh s ON s.node = p.node AND s.community_id = x.community_id",
    *PART,
)
def c2_memberships(spark, sf_dir):
    part = _planted_partition(spark, sf_dir)
    rows = part.select(F.col("node").alias("merchant_id"), "community_id", F.lit(0).alias("is_anchor_candidate"), F.lit(0.0).alias("anchor_score"))
    out = results.expanded(rows, community.shares(_edges(spark, sf_dir), part))
    return rounded(out, "community_share").select("merchant_id", "primary_community_id", "community_id", "community_share", "is_primary_community")


@query()
def c1_merchant_results(spark, sf_dir):
    return rounded(jobs.cluster(transactions(spark, sf_dir), JOB, "2024-01-01 00:00:00").merchants, "anchor_score", "pagerank", "participation", "weighted_degree", "community_share")


@query()
def c5_business_results(spark, sf_dir):
    return rounded(jobs.cluster(transactions(spark, sf_dir), JOB, "2024-01-01 00:00:00").business, "community_share")


JOB = JobConfig(pairs=PairConfig(min_support=1), graph=GRAPH, anchors=AnchorConfig(chain_min_visits=10**6))


def _raw(spark, sf_dir):
    """The planted transactions as a raw table, all text."""
    tx = transactions(spark, sf_dir)
    return tx.select(
        F.col("card_id").alias("account_number"),
        "global_flow_number",
        F.col("merchant_id").alias("storename"),
        F.lit("1").alias("merchant_category"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("transaction_time"),
        F.col("longitude").cast("string").alias("pos_longitude"),
        F.col("latitude").cast("string").alias("pos_latitude"),
        F.lit("R").alias("region"),
        F.lit("N").alias("is_interfere"),
        F.lit("").alias("is_abnormal"),
        "business_district",
        "dt",
    )


@query("SELECT card_id, merchant_id, \"timestamp\", global_flow_number FROM (SELECT card_id, merchant_id, date_trunc('second', \"timestamp\") AS \"timestamp\", global_flow_number FROM tx)", TX_SQL)
def p4_load_table(spark, sf_dir):
    return clean.load_table(_raw(spark, sf_dir), "20240101").select("card_id", "merchant_id", "timestamp", "global_flow_number")


@query("SELECT merchant_id AS storename, count(*) AS n FROM tx WHERE merchant_id NOT LIKE 'm00%' GROUP BY 1", TX_SQL)
def p13_interfered(spark, sf_dir):
    raw = _raw(spark, sf_dir).withColumn("is_interfere", F.when(F.col("storename").startswith("m00") & (F.pmod(F.col("global_flow_number").cast("long"), F.lit(3)) == 0), " y ").otherwise("N"))
    full = raw.join(raw.where("is_interfere = ' y '").select("storename").distinct().withColumn("z", F.lit(1)), "storename", "left")
    kept = clean.drop_interfered(full.where("z IS NOT NULL OR storename NOT LIKE 'm00%'").drop("z"))
    return kept.groupBy("storename").agg(F.count("*").alias("n"))


@query("SELECT status, n FROM (SELECT CAST(event_id % 8 AS VARCHAR) AS status, count(*) AS n FROM events GROUP BY 1) WHERE status NOT IN ('2', '5', '6')")
def p11_statuses(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(F.concat((F.col("event_id") % 8).cast("string"), F.lit(".0")).alias("is_abnormal"))
    return clean.exclude_statuses(raw).groupBy(F.col("is_abnormal").alias("status")).agg(F.count("*").alias("n"))


STATUS_NAMES = ["active", " normal ", "suspect_online", "suspect_isolated", "suspect_lost", "suspect_cross_region", "suspect_chain_store", "deleted", "1", "2", "3", "4", "5", "6", "7", "正常"]


@query(
    """SELECT event_id, s AS status, CASE trim(s) WHEN 'active' THEN '1' WHEN 'normal' THEN '1' WHEN 'suspect_online' THEN '2' WHEN 'suspect_isolated' THEN '3' WHEN 'suspect_lost' THEN '4' WHEN 'suspect_cross_region' THEN '5' WHEN 'suspect_chain_store' THEN '6' WHEN 'deleted' THEN '7' WHEN '正常' THEN NULL ELSE trim(s) END AS code,
    trim(s) IN ('1', 'active', 'normal', '正常') AS is_normal FROM (SELECT event_id, list_extract(['active', ' normal ', 'suspect_online', 'suspect_isolated', 'suspect_lost', 'suspect_cross_region', 'suspect_chain_store', 'deleted', '1', '2', '3', '4', '5', '6', '7', '正常'], event_id % 16 + 1) AS s FROM events)"""
)
def f10_status_codes(spark, sf_dir):
    names = F.array(*map(F.lit, STATUS_NAMES))
    rows = table(spark, sf_dir, "events").select("event_id", F.element_at(names, (F.col("event_id") % 16 + 1).cast("int")).alias("status"))
    return rows.select("event_id", "status", text.status_code(F.col("status")).alias("code"), text.is_normal(F.col("status")).alias("is_normal"))


@query()
def d1_initial_job(spark, sf_dir):
    return jobs.initial(_raw(spark, sf_dir), {"R": ["R市"]}, "20240131", JOB, "2024-01-31 00:00:00")


@query(
    """, known AS (SELECT DISTINCT merchant_id, business_district AS community_id FROM tx WHERE business_district <> ''),
    placed_near AS (SELECT a.merchant_id, b.community_id, row_number() OVER (PARTITION BY a.merchant_id ORDER BY """
    + HAVERSINE_SQL
    + """, b.community_id, b.merchant_id) AS n FROM coords a JOIN (SELECT c.*, k.community_id FROM coords c JOIN known k USING (merchant_id)) b ON """
    + HAVERSINE_SQL
    + """ <= 3000 WHERE a.merchant_id NOT IN (SELECT merchant_id FROM known)),
    linked AS (SELECT x.node AS merchant_id, k.community_id, row_number() OVER (PARTITION BY x.node ORDER BY round(x.weight, 9) DESC, k.community_id, x.other) AS n FROM eb2 x JOIN known k ON k.merchant_id = x.other WHERE x.node NOT IN (SELECT merchant_id FROM known) AND x.node NOT IN (SELECT merchant_id FROM coords)),
    got AS (SELECT merchant_id, community_id FROM placed_near WHERE n = 1 UNION ALL SELECT merchant_id, community_id FROM linked WHERE n = 1)
    SELECT c.merchant_id, coalesce(k.community_id, g.community_id, '') AS community_id FROM (SELECT DISTINCT merchant_id FROM tx) c LEFT JOIN known k USING (merchant_id) LEFT JOIN got g USING (merchant_id)""",
    *EDGES,
    COORDS_SQL,
    "eb2 AS (SELECT l AS node, r AS other, weight FROM edges UNION ALL SELECT r, l, weight FROM edges)",
)
def c11_assignment(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    known = clean.existing_districts(tx)
    found = assign.assigned(assign.candidates(tx, known, "20240131"), clean.merchant_coordinates(tx), known, _edges(spark, sf_dir), 3000)
    return found.select("merchant_id", "community_id").unionByName(known)


@query()
def d1_incremental_job(spark, sf_dir):
    return jobs.incremental(_raw(spark, sf_dir), {"R": ["R市"]}, "20240131", JOB, "2024-01-31 00:00:00")


# -- regional ------------------------------------------------------------------------


@query("SELECT community_id, round(avg(longitude), 6) AS longitude, round(avg(latitude), 6) AS latitude, count(*) AS placed FROM part p JOIN coords c ON c.merchant_id = p.node GROUP BY 1", *PART, COORDS_SQL)
def a25_centres(spark, sf_dir):
    return rounded(regional.centres(_planted_partition(spark, sf_dir), clean.merchant_coordinates(transactions(spark, sf_dir))), "longitude", "latitude")


@query(
    "SELECT community_id, merchants, coalesce(edges, 0) AS edges, round(coalesce(weight, 0), 6) AS weight, transactions, round(CASE WHEN merchants > 1 THEN 2.0 * coalesce(edges, 0) / (merchants * (merchants - 1)) ELSE 0 END, 6) AS density FROM (SELECT community_id, count(*) AS merchants, CAST(sum(visits) AS BIGINT) AS transactions FROM part p JOIN counts c ON c.merchant_id = p.node GROUP BY 1) LEFT JOIN (SELECT p.community_id, count(*) AS edges, sum(weight) AS weight FROM edges e JOIN part p ON p.node = e.l JOIN part q ON q.node = e.r AND q.community_id = p.community_id GROUP BY 1) USING (community_id)",
    *PART,
)
def a23_community_stats(spark, sf_dir):
    tx = visits.visit_counts(_visits(spark, sf_dir)).withColumnRenamed("visits", "transactions")
    return rounded(regional.community_stats(_edges(spark, sf_dir), _planted_partition(spark, sf_dir), tx), "weight", "density")


@query(
    """, inside AS (SELECT e.l, e.r, e.weight FROM edges e JOIN part p ON p.node = e.l JOIN part q ON q.node = e.r AND q.community_id = p.community_id),
    w AS (SELECT node, sum(weight) AS w FROM (SELECT l AS node, weight FROM inside UNION ALL SELECT r, weight FROM inside) GROUP BY 1)
    SELECT node, community_id FROM (SELECT p.node, p.community_id, row_number() OVER (PARTITION BY p.community_id ORDER BY round(coalesce(w, 0), 8) DESC, p.node) AS n FROM part p LEFT JOIN w USING (node)) WHERE n <= 5""",
    *PART,
)
def w11_position_flags(spark, sf_dir):
    e = _edges(spark, sf_dir)
    return regional.position_flags(e, _planted_partition(spark, sf_dir))


@query(
    """, un AS (SELECT node, community_id, w / sum(w) OVER (PARTITION BY node) AS p FROM (SELECT near.node, part.community_id, sum(weight) AS w FROM near JOIN part ON part.node = near.other WHERE near.node LIKE 'hub%' AND near.other NOT LIKE 'hub%' GROUP BY 1, 2)),
    rk AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(p, 12) DESC, community_id) AS n FROM un)
    SELECT node, max(CASE WHEN n = 1 THEN community_id END) AS community_id, round(max(CASE WHEN n = 1 THEN p END), 6) AS p1, round(coalesce(max(CASE WHEN n = 2 THEN p END), 0), 6) AS p2 FROM rk GROUP BY 1""",
    *PART,
)
def w8_unplaced_assignment(spark, sf_dir):
    part = _planted_partition(spark, sf_dir)
    hub = F.col("node").startswith("hub")
    return rounded(regional.ungeo_assignment(_candidates(spark, sf_dir), part.where(~hub), part.where(hub)), "p1", "p2").drop("risky")


@query('SELECT merchant_id FROM tx GROUP BY 1 HAVING max("timestamp") < (SELECT max("timestamp") FROM tx) - INTERVAL 1 DAY', TX_SQL)
def g18_inactive(spark, sf_dir):
    return regional.inactive(transactions(spark, sf_dir), 1)


@query()
def g20_trimmed(spark, sf_dir):
    c = clean.merchant_coordinates(transactions(spark, sf_dir)).withColumnRenamed("merchant_id", "node")
    return regional.trimmed(_planted_partition(spark, sf_dir).join(c, "node"), 200.0)


@query()
def g19_merged_centres(spark, sf_dir):
    return regional.merged_centres(regional.centres(_planted_partition(spark, sf_dir), clean.merchant_coordinates(transactions(spark, sf_dir))), 6000.0)


@query()
def g16_local_update(spark, sf_dir):
    n = _nodes(spark, sf_dir)
    return regional.local_update(n, _edges(spark, sf_dir), _planted_partition(spark, sf_dir), n.where(F.col("node").startswith("m00")))


KNOWN_SQL = "known AS (SELECT DISTINCT merchant_id, business_district AS community_id FROM tx WHERE business_district <> '')"


@query("SELECT geo_cluster, community_id FROM (SELECT p.community_id AS geo_cluster, k.community_id, row_number() OVER (PARTITION BY p.community_id ORDER BY count(*) DESC, k.community_id) AS n FROM part p JOIN known k ON k.merchant_id = p.node GROUP BY 1, 2) WHERE n = 1", *PART, KNOWN_SQL)
def a24_top_communities(spark, sf_dir):
    known = clean.existing_districts(transactions(spark, sf_dir)).withColumnRenamed("merchant_id", "node")
    return regional.top_communities(_planted_partition(spark, sf_dir).withColumnRenamed("community_id", "geo_cluster").join(known, "node"))


@query(
    """, st AS (SELECT community_id, count(*) AS merchants FROM part GROUP BY 1), inn AS (SELECT p.community_id, count(*) AS edges, sum(weight) AS weight FROM edges e JOIN part p ON p.node = e.l JOIN part q ON q.node = e.r AND q.community_id = p.community_id GROUP BY 1)
    SELECT community_id, row_number() OVER (ORDER BY round(coalesce(weight, 0), 6) DESC, coalesce(edges, 0) DESC, merchants DESC, community_id) AS geo_cluster FROM st LEFT JOIN inn USING (community_id) WHERE merchants >= 4""",
    *PART,
)
def w13_ranked_clusters(spark, sf_dir):
    tx = visits.visit_counts(_visits(spark, sf_dir)).withColumnRenamed("visits", "transactions")
    return regional.ranked_clusters(rounded(regional.community_stats(_edges(spark, sf_dir), _planted_partition(spark, sf_dir), tx), "weight"), 4)


@query()
def g21_reclustered(spark, sf_dir):
    tx = visits.visit_counts(_visits(spark, sf_dir)).withColumnRenamed("visits", "transactions")
    return regional.reclustered(_planted_partition(spark, sf_dir), clean.merchant_coordinates(transactions(spark, sf_dir)), _edges(spark, sf_dir), tx, 6000.0)


@query("SELECT count(*) AS merchants, count(*) FILTER (x) AS covered, round(count(*) FILTER (x) / count(*), 6) AS ratio FROM (SELECT merchant_id, merchant_id IN (SELECT merchant_id FROM coords UNION ALL SELECT merchant_id FROM known) AS x FROM counts)", *BASE, COORDS_SQL, KNOWN_SQL)
def a26_merchant_coverage(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return rounded(report.merchant_coverage(visits.visit_counts(_visits(spark, sf_dir)), clean.merchant_coordinates(tx), clean.existing_districts(tx)), "ratio")


@query("SELECT (SELECT count(*) FROM tx) AS transactions, (SELECT count(*) FROM visits) AS visits, (SELECT count(*) FROM counts) AS merchants, (SELECT count(*) FROM edges) AS edges, (SELECT count(DISTINCT community_id) FROM part) AS communities, (SELECT max(n) FROM (SELECT count(*) AS n FROM part GROUP BY community_id)) AS largest", *PART)
def a20_run_summary(spark, sf_dir):
    return report.run_summary(transactions(spark, sf_dir), _visits(spark, sf_dir), _edges(spark, sf_dir), _planted_partition(spark, sf_dir))


DEGREE_SQL = "SELECT '{0}' AS ranking, c.merchant_id, CAST(count(e.node) AS BIGINT) AS value FROM counts c LEFT JOIN (SELECT l AS node FROM {1} UNION ALL SELECT r FROM {1}) e ON e.node = c.merchant_id GROUP BY 2"
RANKED_SQL = " UNION ALL ".join(DEGREE_SQL.format(a, b) for a, b in (("raw_degree", "pairs"), ("minimum_support_degree", "(SELECT * FROM pairs WHERE support >= 2)"), ("sppmi_candidate_degree", "candidates"), ("mutual_top_k_degree", "edges"), ("lost_edge_count_from_chain_removal", "(SELECT * FROM edges WHERE l LIKE 'hub%' OR r LIKE 'hub%')")))


@query(f"""SELECT ranking, CAST(n AS INTEGER) AS "rank", merchant_id, value FROM (SELECT *, row_number() OVER (PARTITION BY ranking ORDER BY value DESC, merchant_id) AS n FROM (SELECT 'visit_count' AS ranking, merchant_id, CAST(visits AS BIGINT) AS value FROM counts UNION ALL {RANKED_SQL})) WHERE n <= 20""", *EDGES)
def w14_rankings(spark, sf_dir):
    counts = visits.visit_counts(_visits(spark, sf_dir))
    c = _candidates(spark, sf_dir).withColumn("weight", F.round("weight", 9))
    return report.rankings(_pairs(spark, sf_dir), c, edges.mutual_top_k(c, GRAPH.top_k), counts, counts.where("merchant_id LIKE 'hub%'"), 2, 20)


# -- scores against communities ------------------------------------------------------

SCORES_SQL = f"""
st AS (SELECT node, other, weight FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(weight, 9) DESC, other) AS n FROM (SELECT l AS node, r AS other, weight FROM edges UNION ALL SELECT r, l, weight FROM edges)) WHERE n <= 3),
gs AS (SELECT node, community_id, v / t AS graph FROM (SELECT *, sum(v) OVER (PARTITION BY node) AS t FROM (SELECT st.node, k.community_id, sum(weight * CASE WHEN k.merchant_id IS NULL THEN 1 ELSE 1.5 END) AS v FROM st LEFT JOIN known k ON k.merchant_id = st.other GROUP BY 1, 2)) WHERE community_id IS NOT NULL AND t > 0),
pl AS (SELECT c.*, k.community_id FROM coords c JOIN known k USING (merchant_id)),
gaps AS (SELECT a.community_id, quantile_cont({HAVERSINE_SQL}, 0.5) AS gap FROM pl a JOIN pl b ON a.community_id = b.community_id AND a.merchant_id < b.merchant_id GROUP BY 1),
sg AS (SELECT community_id, greatest(coalesce(gap, 10.0), 10.0) AS sigma FROM (SELECT DISTINCT community_id FROM pl) LEFT JOIN gaps USING (community_id)),
ds AS (SELECT a.merchant_id AS node, b.community_id, min({HAVERSINE_SQL}) AS d FROM coords a JOIN pl b ON a.merchant_id <> b.merchant_id AND {HAVERSINE_SQL} <= 6000 GROUP BY 1, 2),
ps AS (SELECT node, community_id, exp(-d * d / (2 * sigma * sigma)) AS geo FROM ds JOIN sg USING (community_id)),
sn AS (SELECT DISTINCT merchant_id AS node, card_id FROM visits),
ko AS (SELECT DISTINCT community_id, card_id FROM sn JOIN known ON merchant_id = node),
cs AS (SELECT node, community_id, n / CAST(a + b - n AS DOUBLE) AS customers FROM (SELECT node, community_id, count(*) AS n FROM sn JOIN ko USING (card_id) GROUP BY 1, 2) JOIN (SELECT node, count(*) AS a FROM sn GROUP BY 1) USING (node) JOIN (SELECT community_id, count(*) AS b FROM ko GROUP BY 1) USING (community_id)),
fz AS (SELECT node, community_id, coalesce(graph, 0) AS graph, coalesce(geo, 0) AS geo, coalesce(customers, 0) AS customers FROM gs FULL JOIN ps USING (node, community_id) FULL JOIN cs USING (node, community_id)),
fu AS (SELECT *, CASE WHEN node IN (SELECT merchant_id FROM coords) THEN 0.6 * graph + 0.3 * geo + 0.1 * customers ELSE (0.6 * graph + 0.1 * customers) / 0.7 END AS score FROM fz)"""
SCORES = (*EDGES, COORDS_SQL, KNOWN_SQL, SCORES_SQL)


def _fused(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    known, coords = clean.existing_districts(tx), clean.merchant_coordinates(tx)
    g = fusion.graph_scores(_edges(spark, sf_dir), known, known, 3)
    return shared_table(fusion.fused(g, fusion.geo_scores(coords, known, 6000.0, 10.0), fusion.customer_scores(_visits(spark, sf_dir), known), coords), "scores")


@query("SELECT node, community_id, round(graph, 6) AS graph FROM gs", *SCORES)
def n2_graph_scores(spark, sf_dir):
    known = clean.existing_districts(transactions(spark, sf_dir))
    return rounded(fusion.graph_scores(_edges(spark, sf_dir), known, known, 3), "graph")


@query("SELECT node, community_id, round(geo, 6) AS geo FROM ps", *SCORES)
def n3_geo_scores(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return rounded(fusion.geo_scores(clean.merchant_coordinates(tx), clean.existing_districts(tx), 6000.0, 10.0), "geo")


@query("SELECT node, community_id, round(customers, 6) AS customers FROM cs", *SCORES)
def n4_customer_scores(spark, sf_dir):
    return rounded(fusion.customer_scores(_visits(spark, sf_dir), clean.existing_districts(transactions(spark, sf_dir))), "customers")


@query(
    """, dr AS (SELECT node, community_id, round(score, 9) AS score, round(graph, 9) AS graph, round(geo, 9) AS geo, row_number() OVER (PARTITION BY node ORDER BY round(score, 9) DESC, community_id) AS n FROM fu),
    tp AS (SELECT node, max(community_id) FILTER (n = 1) AS community_id, max(score) AS score, coalesce(max(score) FILTER (n = 2), 0) AS second, first(community_id ORDER BY graph DESC, community_id) AS bg, first(community_id ORDER BY geo DESC, community_id) AS bp, least(max(graph), max(geo)) AS least_top FROM dr GROUP BY 1)
    SELECT node, community_id, round(score, 6) AS score, round(second, 6) AS second, CASE WHEN (bg <> bp AND least_top > 0) OR (score >= 0.4 AND round(score - second, 9) < 0.3) THEN 'review' WHEN score >= 0.4 THEN 'assign' ELSE 'watch' END AS decision FROM tp""",
    *SCORES,
)
def n5_decisions(spark, sf_dir):
    return rounded(fusion.decisions(_fused(spark, sf_dir), 0.4, 0.3), "score", "second")


@query("SELECT merchant_id, community_id, round(score, 6) AS score FROM (SELECT k.*, coalesce(score, 0) AS score FROM known k LEFT JOIN fu ON fu.node = k.merchant_id AND fu.community_id = k.community_id) WHERE round(score, 9) < 0.5", *SCORES)
def n8_doubtful_members(spark, sf_dir):
    return rounded(fusion.doubtful_members(_fused(spark, sf_dir), clean.existing_districts(transactions(spark, sf_dir)), 0.5), "score")


@query("SELECT node AS merchant_id, round(sum(weight * longitude) / sum(weight), 6) AS longitude, round(sum(weight * latitude) / sum(weight), 6) AS latitude FROM st JOIN coords c ON c.merchant_id = st.other WHERE node NOT IN (SELECT merchant_id FROM coords) GROUP BY 1", *SCORES)
def n9_inferred_coordinates(spark, sf_dir):
    return rounded(fusion.inferred_coordinates(_edges(spark, sf_dir), clean.merchant_coordinates(transactions(spark, sf_dir)), 3), "longitude", "latitude")


@query(
    """, pd AS (SELECT merchant_id AS node, CAST("timestamp" AS DATE) AS d, CAST(count(*) AS DOUBLE) AS s FROM visits GROUP BY 1, 2),
    ms AS (SELECT node, sum(s) / n AS mean, sqrt(greatest(sum(s * s) / n - pow(sum(s) / n, 2), 0)) AS dev FROM pd, (SELECT count(DISTINCT d) AS n FROM pd) GROUP BY node, n),
    pt AS (SELECT node, 1 - sum(share * share) AS participation FROM sh GROUP BY 1)
    SELECT node, round(mean, 6) AS mean, round(mean / (1 + dev), 6) AS stability, round(mean * (1 - participation) * mean / (1 + dev) * CASE WHEN node IN (SELECT merchant_id FROM coords) THEN 1.5 ELSE 1 END, 6) AS anchor_score FROM ms JOIN pt USING (node)""",
    *PART,
    COORDS_SQL,
)
def n10_stable_anchor_scores(spark, sf_dir):
    scores = _visits(spark, sf_dir).groupBy(F.col("merchant_id").alias("node"), F.to_date("timestamp").alias("period")).agg(F.count("*").cast("double").alias("score"))
    part = community.participation(community.shares(_edges(spark, sf_dir), _planted_partition(spark, sf_dir)))
    return rounded(fusion.stable_anchor_scores(scores, part, clean.merchant_coordinates(transactions(spark, sf_dir))), "mean", "stability", "anchor_score")


@query(
    f""", hm AS (SELECT card_id, first(region ORDER BY n DESC, region) AS home FROM (SELECT card_id, region, count(*) AS n FROM tx GROUP BY 1, 2) GROUP BY 1),
    en AS (SELECT merchant_id, -sum(p * ln(p)) AS region_entropy FROM (SELECT merchant_id, n / sum(n) OVER (PARTITION BY merchant_id) AS p FROM (SELECT merchant_id, home, CAST(count(*) AS DOUBLE) AS n FROM tx JOIN hm USING (card_id) GROUP BY 1, 2)) GROUP BY 1),
    lg AS (SELECT merchant_id, "timestamp", longitude, latitude, lag(merchant_id) OVER w AS m0, lag("timestamp") OVER w AS t0, lag(longitude) OVER w AS x0, lag(latitude) OVER w AS y0 FROM tx WINDOW w AS (PARTITION BY card_id ORDER BY "timestamp", merchant_id)),
    st AS (SELECT merchant_id, m0, (epoch_us("timestamp") - epoch_us(t0)) / 1e6 AS s, {HAVERSINE_SQL.replace("b.", "").replace("a.longitude", "x0").replace("a.latitude", "y0")} AS d FROM lg WHERE m0 IS NOT NULL),
    ht AS (SELECT m, count(*) AS hits FROM (SELECT unnest([merchant_id, m0]) AS m FROM st WHERE s <= 259200 AND d > 0.0005 * s) GROUP BY 1)
    SELECT merchant_id, round(region_entropy, 6) AS region_entropy, round(night, 6) AS night_share, round(coalesce(hits, 0) / n, 6) AS impossible_share FROM (SELECT merchant_id, count(*) AS n, avg(CASE WHEN hour("timestamp") < 6 THEN 1.0 ELSE 0.0 END) AS night FROM tx GROUP BY 1) JOIN en USING (merchant_id) LEFT JOIN ht ON ht.m = merchant_id""",
    TX_SQL,
)
def n1_online_features(spark, sf_dir):
    return rounded(fusion.online_features(transactions(spark, sf_dir), 4320.0, 0.0005), "region_entropy", "night_share", "impossible_share")


# -- keywords ------------------------------------------------------------------------


def _keyword_base(spark):
    rows = [("North", "1", "Iron Gate", "11", "N-IG", ["iron", "iron gate"]), ("South", "2", "Salt Pier", "21", "S-SP", ["salt", "spring"]), ("East", "3", "Green Hill", "31", "E-GH", ["green", "forest"])]
    return spark.createDataFrame(rows, "administrative_district string, administrative_district_id string, business_district string, business_district_id string, business_district_key string, keywords array<string>")


@query(
    """, k AS (SELECT p_partkey, p_name, [x FOR x IN ['iron', 'iron gate', 'salt', 'spring', 'green', 'forest'] IF contains(p_name, x)] AS hit FROM (SELECT p_partkey, regexp_replace(trim(p_name), '\\s+', ' ', 'g') AS p_name FROM part)),
    m AS (SELECT p_partkey, len(list_distinct([CASE WHEN x IN ('iron', 'iron gate') THEN 'N' WHEN x IN ('salt', 'spring') THEN 'S' ELSE 'E' END FOR x IN hit])) AS n FROM k)
    SELECT CASE WHEN n = 1 THEN 'MATCH' ELSE 'UNKNOWN' END AS result, count(*) AS n FROM m GROUP BY 1""".lstrip(", ").replace("k AS", "WITH k AS", 1)
)
def k3_decisions(spark, sf_dir):
    stores = table(spark, sf_dir, "part").select(F.concat_ws("#", "p_name", "p_partkey").alias("merchant_id"), F.lit("city").alias("city"))
    return keywords.decisions(stores, _keyword_base(spark), "city").groupBy("result").agg(F.count("*").alias("n"))
