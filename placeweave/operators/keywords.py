"""Rule-based district keywords: normalise a store name, match, decide, and check the record.

base: administrative_district, administrative_district_id, business_district,
business_district_id, business_district_key, keywords (array). It is a lookup of at most
MAX_BASE keywords, which is checked before it is sent to the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DataError

MAX_BASE = 100_000
#: Full-width brackets and their plain forms; notes about a store's state.
WIDE, PLAIN = "（）【】［］　", "()[][] "
STATE_SUFFIX = r"[(\[](?:停业|已停业|暂停营业|装修中|搬迁|已搬迁|closed|moved)[)\]]$"


def normal_name(c: Column) -> Column:
    """Full-width signs and letters to plain ones, white space to single spaces, notes of closure off the end."""
    letters = "".join(chr(0xFF01 + i) for i in range(94)), "".join(chr(0x21 + i) for i in range(94))
    t = F.translate(F.translate(F.coalesce(c, F.lit("")), WIDE, PLAIN), *letters)
    t = F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
    return F.trim(F.regexp_replace(t, STATE_SUFFIX, ""))


def matches(stores: DataFrame, base: DataFrame) -> DataFrame:
    """merchant_id, keyword, business_district_key: keywords in the name, but for those inside a longer match."""
    words = base.select("business_district_key", F.explode("keywords").alias("keyword")).where("keyword <> ''").distinct()
    n = words.limit(MAX_BASE + 1).count()
    if n > MAX_BASE:
        raise DataError(f"{n} keywords; {MAX_BASE} is the most")
    names = stores.select("merchant_id", normal_name(F.col("merchant_id")).alias("name"))
    hits = names.join(F.broadcast(words), F.col("name").contains(F.col("keyword")))
    own = F.collect_set("keyword")
    every = hits.groupBy("merchant_id").agg(own.alias("all"))  # a name holds few keywords
    return hits.join(every, "merchant_id").where(~F.exists("all", lambda k: (F.length(k) > F.length("keyword")) & k.contains(F.col("keyword")))).select("merchant_id", "keyword", "business_district_key")


def decisions(stores: DataFrame, base: DataFrame, city: str) -> DataFrame:
    """One record a store: MATCH with its district, UNKNOWN for none or several, NOT_APPLICABLE for another city.

    stores: merchant_id, city.
    """
    found = matches(stores, base).groupBy("merchant_id").agg(F.count_distinct("business_district_key").alias("keys"), F.min("business_district_key").alias("business_district_key"), F.array_sort(F.collect_set("keyword")).alias("matched_keywords"))
    info = base.select("business_district_key", "administrative_district", "administrative_district_id", "business_district", "business_district_id")
    out = stores.select("merchant_id", "city").join(found, "merchant_id", "left")
    here = F.coalesce(F.col("city") == city, F.lit(False))
    result = F.when(~here, "NOT_APPLICABLE").when(F.col("keys") == 1, "MATCH").otherwise("UNKNOWN")
    out = out.withColumn("result", result)
    hit = F.col("result") == "MATCH"
    out = out.withColumn("business_district_key", F.when(hit, F.col("business_district_key"))).join(F.broadcast(info), "business_district_key", "left")
    consistent = ~hit | F.col("business_district_id").isNotNull()
    text = lambda c: F.when(hit & consistent, F.coalesce(c, F.lit(""))).otherwise("").alias(c)
    reason = F.when(~here, "city not covered").when(~consistent, "district without data").when(hit, "one district").when(F.col("keys") > 1, "several districts").otherwise("no keyword")
    return out.select(
        "merchant_id",
        F.coalesce("city", F.lit("")).alias("city"),
        F.when(consistent, F.col("result")).otherwise("UNKNOWN").alias("result"),
        text("administrative_district"),
        text("administrative_district_id"),
        text("business_district"),
        text("business_district_id"),
        F.array_join(F.coalesce("matched_keywords", F.array()), "|").alias("matched_keywords"),
        F.when(hit & consistent, 1.0).otherwise(0.0).alias("confidence"),
        reason.alias("reason"),
    )


def routed(records: DataFrame, min_confidence: float = 0.8) -> dict[str, DataFrame]:
    """Records by branch: accepted, review (a match of low confidence), unknown, skipped."""
    match = F.col("result") == "MATCH"
    return {
        "accepted": records.where(match & (F.col("confidence") >= min_confidence)),
        "review": records.where(match & (F.col("confidence") < min_confidence)),
        "unknown": records.where(F.col("result") == "UNKNOWN"),
        "skipped": records.where(F.col("result") == "NOT_APPLICABLE"),
    }


#: Points of a keyword by where a cluster's profile has it.
PROFILE_POINTS = {"core": 10, "manual": 6, "brand": 5, "road": 2, "other": 1}


def profile_scores(keywords: DataFrame, profiles: DataFrame) -> DataFrame:
    """component, cluster_id, score: points of the component's keywords in each cluster's profile (cluster_id, keyword, kind)."""
    points = F.lit(0)
    for kind, n in PROFILE_POINTS.items():
        points = F.when(F.col("kind") == kind, n).otherwise(points)
    return keywords.join(profiles, "keyword").groupBy("component", "cluster_id").agg(F.sum(points).alias("score"))


def chosen_cluster(scores: DataFrame, min_score: int, max_ratio: float) -> DataFrame:
    """component, cluster_id where the best score is enough and the second is at most max_ratio of it."""
    ranked = scores.groupBy("component").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "cluster_id"))), 1, 2).alias("top"))
    best, second = -F.col("top")[0]["s"], F.when(F.size("top") > 1, -F.get("top", F.lit(1))["s"]).otherwise(0)
    return ranked.where((best >= min_score) & (second <= max_ratio * best)).select("component", F.col("top")[0]["cluster_id"].alias("cluster_id"))
