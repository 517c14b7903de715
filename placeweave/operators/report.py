"""Coverage, distributions and diagnostics of pair statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DataError
from .edges import candidates, mutual_top_k
from .pairs import both_ways

QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
#: The support thresholds of the sweep.
THRESHOLDS = (1, 2, 3, 5, 10, 20, 50, 100)


def percent(part: Column, whole: Column) -> Column:
    """Rounded to two places, 0 where the whole is 0."""
    return F.when(whole == 0, 0.0).otherwise(F.round(100.0 * part / whole, 2))


def merchants_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("l", "r")).alias("merchant_id")).distinct()


def coverage(pairs: DataFrame, assigned: DataFrame, min_support: int) -> DataFrame:
    """One row: raw and effective pairs and merchants, pairs with both or any end assigned, and percentages."""
    a = assigned.select("merchant_id").distinct().withColumn("_in", F.lit(True))
    flagged = pairs.join(a.toDF("l", "in_l"), "l", "left").join(a.toDF("r", "in_r"), "r", "left")
    both, any_ = F.coalesce(F.col("in_l") & F.col("in_r"), F.lit(False)), F.coalesce("in_l", "in_r", F.lit(False))
    ok = F.col("support") >= min_support
    p = flagged.agg(F.count("*").alias("raw_pairs"), F.count_if(ok).alias("effective_pairs"), F.count_if(both).alias("raw_pairs_both"), F.count_if(any_).alias("raw_pairs_any"), F.count_if(ok & both).alias("effective_pairs_both"), F.count_if(ok & any_).alias("effective_pairs_any"))
    ends = both_ways(pairs, "support").groupBy("node").agg(F.max("support").alias("top")).join(a.toDF("node", "_in"), "node", "left")
    m = ends.agg(F.count("*").alias("raw_merchants"), F.count_if(F.col("top") >= min_support).alias("effective_merchants"), F.count_if(F.col("_in").isNotNull()).alias("raw_merchants_assigned"), F.count_if(F.col("_in").isNotNull() & (F.col("top") >= min_support)).alias("effective_merchants_assigned"))
    c = F.col
    return p.join(F.broadcast(m)).withColumns(  # one row each
        {
            "effective_pair_pct": percent(c("effective_pairs"), c("raw_pairs")),
            "effective_merchant_pct": percent(c("effective_merchants"), c("raw_merchants")),
            "raw_assigned_pct": percent(c("raw_merchants_assigned"), c("raw_merchants")),
            "effective_assigned_pct": percent(c("effective_merchants_assigned"), c("effective_merchants")),
            "effective_both_pct": percent(c("effective_pairs_both"), c("effective_pairs")),
            "effective_any_pct": percent(c("effective_pairs_any"), c("effective_pairs")),
        }
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """One row: count, min, nearest-rank quantiles, max, mean."""
    q = [F.expr(f"percentile_disc({v}) WITHIN GROUP (ORDER BY `{column}`)").cast(df.schema[column].dataType).alias(k) for k, v in QUANTILES.items()]
    return df.agg(F.count(column).alias("count"), F.min(column).alias("min"), *q, F.max(column).alias("max"), F.avg(column).alias("mean"))


def distribution_with_minimum(df: DataFrame, column: str, minimum: float, times: int) -> DataFrame:
    """The same as if minimum stood there times more (not above any value): ranks are shifted, no rows are made."""
    total = df.agg(F.count(column)).first()[0] + times
    exprs = []
    for name, q in QUANTILES.items():
        rank = max(1, -(-int(round(q * 1e9)) * total // 10**9))  # nearest rank among all
        if rank <= times:
            exprs.append(F.lit(float(minimum)).alias(name))
        else:
            share = (rank - times) / max(total - times, 1)
            exprs.append(F.expr(f"percentile_disc({share:.15f}) WITHIN GROUP (ORDER BY CAST(`{column}` AS DOUBLE))").alias(name))
    low = F.lit(float(minimum)) if times else F.min(F.col(column).cast("double"))
    mean = (F.sum(F.col(column).cast("double")) + minimum * times) / F.lit(total)
    return df.agg(F.lit(total).cast("long").alias("count"), low.alias("min"), *exprs, F.coalesce(F.max(F.col(column).cast("double")), low).alias("max"), mean.alias("mean"))


def node_metrics(pairs: DataFrame, weight: str = "strength") -> DataFrame:
    """node, degree, weight_sum, support_sum."""
    return both_ways(pairs, weight, "support").groupBy("node").agg(F.count("*").alias("degree"), F.sum(weight).alias("weight_sum"), F.sum("support").alias("support_sum"))


def stage_summary(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: pairs, covered merchants, isolated merchants, coverage."""
    m = merchants_of(pairs).join(counts.select("merchant_id"), "merchant_id", "left_semi").agg(F.count("*").alias("covered"))
    all_ = counts.agg(F.count("*").alias("merchants"))
    p = pairs.agg(F.count("*").alias("pairs"))
    return p.join(F.broadcast(m)).join(F.broadcast(all_)).select("pairs", "covered", (F.col("merchants") - F.col("covered")).alias("isolated"), F.when(F.col("merchants") == 0, 0.0).otherwise(F.col("covered") / F.col("merchants")).alias("coverage"))


def support_sweep(pairs: DataFrame, configured: int) -> DataFrame:
    """threshold, pairs, merchants at every support threshold, in one pass over each."""
    steps = sorted({*THRESHOLDS, configured})
    passed = lambda c: F.explode(F.filter(F.array(*map(F.lit, steps)), lambda t: t <= c)).alias("threshold")
    p = pairs.select(passed(F.col("support"))).groupBy("threshold").agg(F.count("*").alias("pairs"))
    top = both_ways(pairs, "support").groupBy("node").agg(F.max("support").alias("top"))
    m = top.select(passed(F.col("top"))).groupBy("threshold").agg(F.count("*").alias("merchants"))
    every = pairs.sparkSession.createDataFrame([(t,) for t in steps], "threshold int")
    out = every.join(p, "threshold", "left").join(m, "threshold", "left")
    return out.select("threshold", F.coalesce("pairs", F.lit(0)).alias("pairs"), F.coalesce("merchants", F.lit(0)).alias("merchants"))


def top_merchants(metrics: DataFrame, metric: str, count: int = 50) -> DataFrame:
    """The count merchants with the largest metric, ties by name."""
    return metrics.orderBy(F.desc(metric), "node").limit(count)


def isolated(counts: DataFrame, edges: DataFrame) -> DataFrame:
    return counts.join(merchants_of(edges), "merchant_id", "left_anti")


def diagnostics(pairs: DataFrame, counts: DataFrame, config, min_support: int) -> DataFrame:
    """stage, pairs, covered, isolated, coverage for raw, supported, candidate and sparse pairs."""
    kept = pairs.where(F.col("support") >= min_support)
    cands = candidates(pairs, config, min_support)
    stages = [("raw", pairs), ("supported", kept), ("candidate", cands), ("sparse", mutual_top_k(cands, config.top_k))]
    out = None
    for name, p in stages:
        row = stage_summary(counts, p).select(F.lit(name).alias("stage"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def coverage_job_row(metrics: DataFrame, labels: dict[str, str]) -> DataFrame:
    """The coverage row with its identifying columns in front."""
    return metrics.select(*(F.lit(v).alias(k) for k, v in labels.items()), "*")


def funnel(counts: list[tuple[str, int]]) -> list[dict]:
    """Steps of nested counts with retention and reduction in percent; a count above the one before is an error."""
    out, before = [], None
    for name, n in counts:
        if n < 0 or (before is not None and n > before):
            raise DataError(f"{name}: {n} is not part of {before}")
        kept = 100.0 if before is None else 100.0 * n / before if before else 0.0
        out.append({"step": name, "count": n, "retention_pct": round(kept, 3), "reduction_pct": round(100 - kept, 3)})
        before = n
    return out


def largest_loss(steps: list[dict]) -> dict | None:
    return max(steps[1:], key=lambda s: s["reduction_pct"], default=None)


def rankings(pairs: DataFrame, cands: DataFrame, sparse: DataFrame, counts: DataFrame, chains: DataFrame, min_support: int, count: int = 50) -> DataFrame:
    """ranking, rank, merchant_id, value: the count first merchants of six metrics, ties by name.

    Visits; degrees among raw, supported, candidate and sparse pairs; sparse pairs lost when chains go.
    All merchants with visits are ranked, without pairs as 0.
    """
    gone = chains.select("merchant_id").distinct()
    cut = sparse.join(gone.toDF("l").withColumn("_l", F.lit(True)), "l", "left").join(gone.toDF("r").withColumn("_r", F.lit(True)), "r", "left").where("_l OR _r")
    sources = {"raw_degree": pairs, "minimum_support_degree": pairs.where(F.col("support") >= min_support), "sppmi_candidate_degree": cands, "mutual_top_k_degree": sparse, "lost_edge_count_from_chain_removal": cut}
    out = counts.select(F.lit("visit_count").alias("ranking"), "merchant_id", F.col("visits").cast("long").alias("value"))
    for name, p in sources.items():
        degree = both_ways(p).groupBy(F.col("node").alias("merchant_id")).agg(F.count("*").alias("n"))
        out = out.unionByName(counts.select("merchant_id").join(degree, "merchant_id", "left").select(F.lit(name).alias("ranking"), "merchant_id", F.coalesce("n", F.lit(0)).cast("long").alias("value")))
    order = Window.partitionBy("ranking").orderBy(F.desc("value"), "merchant_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count).select("ranking", "rank", "merchant_id", "value")


def merchant_coverage(merchants: DataFrame, *placed: DataFrame) -> DataFrame:
    """One row: merchants, covered (in any of the placed tables) and their ratio, 0 without merchants."""
    names = None
    for p in placed:
        names = p.select("merchant_id") if names is None else names.unionByName(p.select("merchant_id"))
    every = merchants.select("merchant_id").distinct().join(names.distinct().withColumn("_in", F.lit(True)), "merchant_id", "left")
    sums = every.agg(F.count("*").alias("merchants"), F.count_if(F.col("_in")).alias("covered"))
    return sums.withColumn("ratio", F.when(F.col("merchants") == 0, 0.0).otherwise(F.col("covered") / F.col("merchants")))


def run_summary(transactions: DataFrame, visits: DataFrame, edges: DataFrame, partition: DataFrame) -> DataFrame:
    """One row of a run's counts: transactions, visits, merchants, edges, communities and the largest one."""
    sizes = partition.groupBy("community_id").agg(F.count("*").alias("n"))
    rows = [transactions.agg(F.count("*").alias("transactions")), visits.agg(F.count("*").alias("visits"), F.count_distinct("merchant_id").alias("merchants")), edges.agg(F.count("*").alias("edges")), sizes.agg(F.count("*").alias("communities"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))]
    out = rows[0]
    for r in rows[1:]:  # one row each
        out = out.crossJoin(F.broadcast(r))
    return out
