import json
import zipfile
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from placeweave import catalog
from placeweave.config import AnchorConfig, GraphConfig, JobConfig, PairConfig
from placeweave.errors import ConfigError, DataError
from placeweave.operators import assign, charts, geo, keywords, report, results
from placeweave.plans import jobs
from placeweave.sources import files, tables
from placeweave.streaming import statistics

from test_clean import raw, row

JOB = JobConfig(pairs=PairConfig(min_support=1), graph=GraphConfig(method="transaction_count"), anchors=AnchorConfig(chain_min_visits=1000), min_community_size=3)


def visits_of(prefix, card, names, **kw):
    return [row(global_flow_number=f"{prefix}{card}{n}", account_number=card, storename=n, transaction_time=f"2024010{1 + i // 60}1000{i:02d}", pos_longitude="", pos_latitude="", **kw) for i, n in enumerate(names)]


def test_initial_job(spark):
    rows = [r for k in range(8) for r in visits_of("f", f"c{k}", ["a", "b", "c"])] + [row(global_flow_number="q", account_number="z", storename="lone", pos_longitude="", pos_latitude="")]
    rows += [row(global_flow_number="x", storename="乙市店")]
    got = {r.storename: r for r in jobs.initial(raw(spark, *rows), {"R": ["R市"]}, "20240131", JOB, "now").collect()}
    assert set(got) == {"a", "b", "c", "lone", "乙市店"}
    assert {got[n].community_id for n in "abc"} == {"0"} and {got[n].is_abnormal for n in "abc"} == {"1"}
    assert (got["lone"].community_id, got["lone"].is_abnormal) == ("", "3") and got["乙市店"].is_abnormal == "5"


def test_initial_job_gives_a_busy_chain_store_code_6(spark):
    rows = [r for k in range(8) for r in visits_of("f", f"c{k}", ["a", "b", "c"])] + [r for k in range(9) for r in visits_of("g", f"c{k}", ["chain"])]
    config = replace(JOB, anchors=AnchorConfig(chain_quantile=1.0, chain_min_visits=9))
    got = {r.storename: r for r in jobs.initial(raw(spark, *rows), {"R": ["R市"]}, "20240131", config, "now").collect()}
    assert got["chain"].is_abnormal == "6" and got["chain"].community_id == got["a"].community_id == "0"


def test_unknown_status_is_refused(spark):
    row = ("s", "0", "", "R", "N", "now", "lost", 0)
    d = spark.createDataFrame([row], "storename string, community_id string, previous_community_id string, region string, is_interfere string, update_time string, status string, is_position int")
    with pytest.raises(DataError):
        results.target_rows(d, "20240131", 1)
    assert results.target_rows(d.withColumn("status", F.lit("suspect_lost")), "20240131", 1).first().is_abnormal == "4"


def test_initial_job_keeps_existing_ids(spark):
    rows = [r for k in range(8) for n in ("a", "b", "c") for r in visits_of("f", f"c{k}", [n], business_district="007" if n == "a" else "")]
    got = {r.storename: r for r in jobs.initial(raw(spark, *rows), {"R": ["R市"]}, "20240131", JOB, "now").collect()}
    assert got["a"].community_id == "7" and got["a"].is_position == 0 and set(got) == {"a", "b", "c"}
    assert got["b"].community_id == got["c"].community_id == "7"


def test_incremental_job(spark):
    rows = [r for k in range(6) for r in visits_of("f", f"c{k}", ["old"], business_district="BD1") + visits_of("g", f"c{k}", ["new"])]
    rows += visits_of("h", "c9", ["alone"]) + visits_of("i", "c9", ["off"], is_abnormal="6", business_district="BD9") + [row(global_flow_number="x", storename="乙市店")]
    got = {r.storename: (r.community_id, r.is_abnormal) for r in jobs.incremental(raw(spark, *rows), {"R": ["R市"]}, "20240131", JOB, "now").collect()}
    assert got == {"old": ("BD1", "1"), "new": ("BD1", "1"), "alone": ("", "3"), "off": ("BD9", "6"), "乙市店": ("", "5")}
    with pytest.raises(DataError):
        jobs.incremental(raw(spark, *visits_of("f", "c", ["a"])), {"R": ["R市"]}, "20240131", JOB, "now")


def test_assignment_order(spark):
    members = spark.createDataFrame([("m1", "8"), ("m2", "9"), ("m3", "9")], "merchant_id string, community_id string")
    coords = spark.createDataFrame([("m1", 121.0, 31.0), ("near", 121.001, 31.0), ("far", 122.0, 31.0)], "merchant_id string, longitude double, latitude double")
    cands = spark.createDataFrame([("near",), ("far",), ("loose",)], "merchant_id string").withColumns({"region": F.lit("R"), "dt": F.lit("d")})
    edges = spark.createDataFrame([("m2", "near", 100.0), ("far", "m2", 100.0), ("loose", "m2", 4.0), ("loose", "m3", 4.0), ("loose", "m1", 5.0)], "l string, r string, weight double")
    got = {r.merchant_id: r.community_id for r in assign.assigned(cands, coords, members, edges, 3000).collect()}
    assert got == {"near": "8", "far": "", "loose": "8"}


def test_partitions_round_trip(spark, tmp_path):
    d = spark.createDataFrame([(1, "in file")], "x int, dt string")
    d.write.parquet(f"{tmp_path}/t/dt=20240131")
    got = tables.read_partitions(spark, str(tmp_path), "db.t", ["20240131", "20240229"]).collect()
    assert [(r.x, r.dt) for r in got] == [(1, "20240131")]
    for bad in ([], ["20240229"]):
        with pytest.raises(DataError):
            tables.read_partitions(spark, str(tmp_path), "t", bad)


def test_overwrite_one_partition(spark):
    spark.sql("DROP TABLE IF EXISTS out_rows")
    tables.overwrite_partition(spark.createDataFrame([(1,)], "x int"), "out_rows", "1")
    tables.overwrite_partition(spark.createDataFrame([(2,)], "x int"), "out_rows", "2")
    tables.overwrite_partition(spark.createDataFrame([(3,)], "x int"), "out_rows", "1")
    assert {(r.x, r.dt) for r in spark.table("out_rows").collect()} == {(3, "1"), (2, "2")}
    with pytest.raises(DataError):
        tables.overwrite_partition(spark.createDataFrame([], "x int"), "out_rows", "1")


def test_parameters(spark):
    one = ("2024-01-15 00:00:00", "20240302", " R ", "120", "2.0", "3", "0")
    p = tables.read_parameters(spark.createDataFrame([one], tables.PARAMETER_COLUMNS))[0]
    assert (p.region, p.min_support, p.daily, p.start.day) == ("R", 2, False, 15)
    for at, v in ((5, "0"), (6, "2"), (2, " "), (0, "20250101"), (3, "x")):
        with pytest.raises(DataError):
            tables.read_parameters(spark.createDataFrame([(*one[:at], v, *one[at + 1 :])], tables.PARAMETER_COLUMNS))


def test_statistics_snapshot(spark, tmp_path):
    pairs = spark.createDataFrame([("a", "b", 1.0, 1)], "l string, r string, strength double, support long")
    counts = spark.createDataFrame([("a", 1), ("b", 2)], "merchant_id string, visits long")
    tables.write_statistics(pairs, counts, f"{tmp_path}/s")
    assert tables.read_statistics(spark, f"{tmp_path}/s")[0].count() == 1
    tables.write_statistics(pairs, counts.limit(1), f"{tmp_path}/s")
    with pytest.raises(DataError):
        tables.read_statistics(spark, f"{tmp_path}/s")


def test_texts(spark, tmp_path):
    (tmp_path / "a.txt").write_text("c·2024-01-01 10:00:00·s\n", encoding="utf-8")
    assert files.read_three_columns(spark, str(tmp_path / "a.txt")).first().storename == "s"
    (tmp_path / "b.txt").write_text("c·s\n", encoding="utf-8")
    with pytest.raises(DataError):
        files.read_three_columns(spark, str(tmp_path / "b.txt"))
    (tmp_path / "c.txt").write_text("﻿" + "|".join(files.TEXT_COLUMNS) + "\n" + "|".join("x" * 10) + "\n", encoding="utf-8")
    assert files.read_text_transactions(spark, str(tmp_path / "c.txt")).count() == 1
    (tmp_path / "p.csv").write_text("merchant_id\tlongitude\tlatitude\na\tx\t3\na\t1.5\t2\na\t1\t2\n")
    places = files.read_places(spark, str(tmp_path / "p.csv"))
    assert [tuple(r) for r in places.drop("place").collect()] == [("a", 1.5, 2.0)]
    assert [tuple(r) for r in geo.bounded_points(places, 1, 2, 1, 3).drop("place").collect()] == [("a", 1.5, 2.0)]
    with pytest.raises(DataError):
        geo.bounded_points(places, 5, 6, 1, 3)


def test_exports(spark, tmp_path):
    d = spark.createDataFrame([("a & b", "1"), ("c", " ")], "merchant_id string, community_id string")
    assert files.assigned_only(d).count() == 1
    assert files.write_xlsx(d, str(tmp_path / "x.xlsx")) == 2
    assert "a &amp; b" in zipfile.ZipFile(tmp_path / "x.xlsx").read("xl/worksheets/sheet1.xml").decode()
    with pytest.raises(DataError):
        files.write_xlsx(d, str(tmp_path / "x.xlsx"), 10)
    assert files.smart_export(d, f"{tmp_path}/e", 1) == "text" and files.smart_export(d, f"{tmp_path}/e", 2) == "csv"
    run = files.run_directory(str(tmp_path), "sppmi", "leiden", datetime(2026, 6, 22, 14, 43, 5))
    assert run.endswith("sppmi_leiden_260622144305")
    e = spark.createDataFrame([("a", "b", 1.0)], "l string, r string, weight double")
    files.write_cluster_outputs(run, d, d, e, {"n": 1})
    assert json.loads(open(f"{run}/summary.json").read()) == {"n": 1} and "a &amp; b" in open(f"{run}/graph.graphml").read()


def test_publish_and_clear(tmp_path):
    root = str(tmp_path / "r")
    files.publish(root, lambda p: open(f"{p}/f", "w").close(), "v1")

    def broken(p):
        raise ValueError

    with pytest.raises(ValueError):
        files.publish(root, broken, "v2")
    assert files.current(root).endswith("v1")
    assert files.clear_folder(f"{root}/v1", root) == 1
    with pytest.raises(ConfigError):
        files.clear_folder(str(tmp_path), root)


def test_funnel_and_charts(spark):
    with pytest.raises(DataError):
        report.funnel([("a", 1), ("b", 2)])
    steps = report.funnel([("raw", 1498702), ("effective", 96607)])
    assert steps[1]["retention_pct"] == 6.446 and report.largest_loss(steps)["step"] == "effective"
    assert charts.funnel_svg([("p", [("a", 4), ("b", 2)])]).count("<rect") == 2
    assert "<path" in charts.flow_svg([("p", [("a", 4), ("b", 2)])])
    m = spark.createDataFrame([("a<b", 1, 1), ("c", 1, 0), ("d", 2, 0)], "merchant_id string, community_id long, is_anchor_candidate int")
    got = {r.community_id: r.svg for r in charts.community_charts(m).collect()}
    assert set(got) == {"1", "2"} and "a&lt;b" in got["1"]


def test_keywords(spark):
    base = catalog._keyword_base(spark)
    stores = spark.createDataFrame([("iron gate shop", "c"), ("ｉｒｏｎ　x（停业）", "c"), ("salt and green", "c"), ("none", "c"), ("iron", "other")], "merchant_id string, city string")
    hits = keywords.matches(stores, base).where("merchant_id = 'iron gate shop'").collect()
    assert [r.keyword for r in hits] == ["iron gate"]
    got = {r.merchant_id: r for r in keywords.decisions(stores, base, "c").collect()}
    assert [got[n].result for n in ("iron gate shop", "ｉｒｏｎ　x（停业）", "salt and green", "none", "iron")] == ["MATCH", "MATCH", "UNKNOWN", "UNKNOWN", "NOT_APPLICABLE"]
    assert got["iron gate shop"].business_district_id == "11"


def test_stream_equals_batch(spark, tmp_path):
    d = spark.createDataFrame([(c, m, f"2024-01-0{1 + int(c)} 10:{i:02d}:00") for c in "012" for i, m in enumerate("abc")], "card_id string, merchant_id string, t string")
    d = d.select("card_id", "merchant_id", F.to_timestamp("t").cast("timestamp_ntz").alias("timestamp"))
    for c in "012":
        d.where(F.col("card_id") == c).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    statistics.run(stream, f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination(120)
    got = spark.read.parquet(statistics.latest(spark, f"{tmp_path}/state")).collect()
    assert {(r.l, r.r, r.support) for r in got} == {("a", "b", 3), ("a", "c", 3), ("b", "c", 3)}
