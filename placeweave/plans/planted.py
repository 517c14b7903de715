"""Trade-area inputs derived from the test tables, for DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical transactions: ten groups of ten merchants and three hubs, from the events table."""
    k = F.get_json_object("props", "$.k").cast("int")
    own = F.concat(F.lit("m"), F.lpad(((F.col("user_id") % 10) * 10 + F.col("k") % 10).cast("string"), 3, "0"))
    e = table(spark, sf_dir, "events").withColumn("k", k)
    rows = e.select(
        F.col("user_id").cast("string").alias("card_id"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("event_id").cast("string").alias("global_flow_number"),
        F.date_format("ts", "yyyyMMdd").alias("dt"),
        F.when(F.col("k") >= 95, F.concat(F.lit("hub"), (F.col("k") % 3).cast("string"))).otherwise(own).alias("merchant_id"),
    )
    hub = F.col("merchant_id").startswith("hub")
    n = F.when(~hub, F.substring("merchant_id", 2, 3).cast("int"))
    g, j = F.floor(n / 10).cast("int"), n % 10
    placed = ~hub & (j % 2 == 0)
    return rows.withColumns(
        {
            "merchant_category": F.when(hub, 2).otherwise(1),
            "region": F.when(hub, "R0").otherwise(F.concat(F.lit("R"), (g % 2).cast("string"))),
            "longitude": F.when(placed, F.lit(121.0) + F.lit(0.05) * g + F.lit(0.0005) * j),
            "latitude": F.when(placed, F.lit(31.0)),
            "business_district": F.when(~hub & (j < 4), F.concat(F.lit("BD"), g.cast("string"))).otherwise(""),
        }
    )


TX_SQL = """
e AS (SELECT event_id, ts, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
t0 AS (SELECT CAST(user_id AS VARCHAR) AS card_id, ts AS "timestamp", CAST(event_id AS VARCHAR) AS global_flow_number, strftime(ts, '%Y%m%d') AS dt,
  CASE WHEN k >= 95 THEN 'hub' || CAST(k % 3 AS VARCHAR) ELSE 'm' || lpad(CAST((user_id % 10) * 10 + k % 10 AS VARCHAR), 3, '0') END AS merchant_id FROM e),
t1 AS (SELECT *, CASE WHEN merchant_id LIKE 'hub%' THEN NULL ELSE CAST(substr(merchant_id, 2, 3) AS INTEGER) END AS n FROM t0),
tx AS (SELECT card_id, "timestamp", global_flow_number, dt, merchant_id,
  CASE WHEN n IS NULL THEN 2 ELSE 1 END AS merchant_category,
  CASE WHEN n IS NULL THEN 'R0' ELSE 'R' || CAST((n // 10) % 2 AS VARCHAR) END AS region,
  CASE WHEN n % 2 = 0 THEN CAST(121.0 AS DOUBLE) + CAST(0.05 AS DOUBLE) * (n // 10) + CAST(0.0005 AS DOUBLE) * (n % 10) END AS longitude,
  CASE WHEN n % 2 = 0 THEN CAST(31.0 AS DOUBLE) END AS latitude,
  CASE WHEN n % 10 < 4 THEN 'BD' || CAST(n // 10 AS VARCHAR) ELSE '' END AS business_district FROM t1)"""

VISITS_SQL = """
v0 AS (SELECT card_id, merchant_id, "timestamp", lag("timestamp") OVER (PARTITION BY card_id, merchant_id ORDER BY "timestamp") AS before FROM tx),
v1 AS (SELECT card_id, merchant_id, "timestamp" FROM v0 WHERE before IS NULL OR "timestamp" - before >= INTERVAL 30 MINUTE),
daily AS (SELECT card_id, CAST("timestamp" AS DATE) AS day, count(DISTINCT merchant_id) AS merchants FROM v1 GROUP BY 1, 2),
visits AS (SELECT v1.* FROM v1 WHERE NOT EXISTS (SELECT 1 FROM daily d WHERE d.card_id = v1.card_id AND d.day = CAST(v1."timestamp" AS DATE) AND d.merchants > 100)),
counts AS (SELECT merchant_id, count(*) AS visits FROM visits GROUP BY 1)"""

PAIRS_SQL = """
evidence AS (SELECT a.card_id, a.merchant_id AS l, b.merchant_id AS r, exp(-abs(epoch_us(b."timestamp") - epoch_us(a."timestamp")) / 6e7 / 60.0) AS weight
  FROM visits a JOIN visits b ON a.card_id = b.card_id AND a.merchant_id < b.merchant_id AND b."timestamp" BETWEEN a."timestamp" - INTERVAL 120 MINUTE AND a."timestamp" + INTERVAL 120 MINUTE),
votes AS (SELECT card_id, l, r, max(weight) AS weight FROM evidence GROUP BY 1, 2, 3),
pairs AS (SELECT l, r, sum(weight) AS strength, count(*) AS support FROM votes GROUP BY 1, 2)"""

EDGES_SQL = """
ends AS (SELECT l AS node, r AS other, strength FROM pairs UNION ALL SELECT r, l, strength FROM pairs),
margins AS (SELECT node, sum(strength) AS marginal FROM ends GROUP BY 1),
totals AS (SELECT sum(marginal) / 2 AS total, sum(pow(marginal, 0.75)) / 2 AS smoothed FROM margins),
metrics AS (SELECT p.l, p.r, p.strength, p.support,
  greatest(ln(p.strength) + ln(t.smoothed) - 0.875 * (ln(a.marginal) + ln(b.marginal)) - ln(3.0), 0.0) AS sppmi,
  (p.strength - a.marginal * b.marginal / t.total) / sqrt(a.marginal * b.marginal / t.total) AS z_score
  FROM pairs p JOIN margins a ON a.node = p.l JOIN margins b ON b.node = p.r CROSS JOIN totals t),
candidates AS (SELECT l, r, sppmi AS weight, z_score, support FROM metrics WHERE sppmi > 0 AND z_score >= 0.5),
near AS (SELECT l AS node, r AS other, weight, support FROM candidates UNION ALL SELECT r, l, weight, support FROM candidates),
ranked AS (SELECT node, other, weight, support, row_number() OVER (PARTITION BY node ORDER BY round(weight, 9) DESC, support DESC, other) AS n FROM near),
edges AS (SELECT c.* FROM candidates c JOIN ranked a ON a.node = c.l AND a.other = c.r AND a.n <= 4 JOIN ranked b ON b.node = c.r AND b.other = c.l AND b.n <= 4)"""

COORDS_SQL = """
coords AS (SELECT DISTINCT merchant_id, longitude, latitude FROM tx WHERE longitude IS NOT NULL)"""


def with_sql(query: str, *parts: str) -> str:
    """The named parts as common tables before a query."""
    return "WITH " + ",".join(parts) + ("" if query.lstrip().startswith(",") else "\n") + query
