import pytest
from pyspark.sql import functions as F

from placeweave.errors import DataError
from placeweave.functions import text, times
from placeweave.operators import clean

COLS = "account_number string, global_flow_number string, storename string, merchant_category string, transaction_time string, pos_longitude string, pos_latitude string, region string, is_interfere string, is_abnormal string, business_district string, dt string"


def row(**kw):
    base = {"account_number": "c", "global_flow_number": "f", "storename": "s", "merchant_category": "1", "transaction_time": "20240101T100000", "pos_longitude": "121", "pos_latitude": "31", "region": "R", "is_interfere": "N", "is_abnormal": "", "business_district": "", "dt": "20240131"}
    return tuple((base | kw).values())


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), COLS)


def test_repeated_flow_keeps_the_earliest_partition(spark):
    d = raw(spark, row(dt="20240229", account_number="late"), row(dt="20240131", account_number="early"))
    assert [r.card_id for r in clean.load_table(d, "20240131").collect()] == ["early"]


def test_coordinates_in_pairs_or_not_at_all(spark):
    d = raw(spark, row(global_flow_number="1", pos_latitude=""), row(global_flow_number="2", pos_longitude="bad"), row(global_flow_number="3", pos_longitude="181.0"), row(global_flow_number="4", pos_longitude="121d"), row(global_flow_number="5"))
    got = {r.global_flow_number: (r.longitude, r.latitude) for r in clean.load_table(d, "x").collect()}
    assert got == {"1": (None, None), "2": (None, None), "3": (None, None), "4": (None, None), "5": (121.0, 31.0)}


def test_categories(spark):
    d = raw(spark, *(row(global_flow_number=str(k), storename=f"s{k}", merchant_category=f"{k}.0") for k in range(4)))
    assert {r.merchant_id for r in clean.load_table(d, "x").collect()} == {"s1", "s2"}
    with pytest.raises(DataError):
        clean.load_table(raw(spark, row(merchant_category="1"), row(global_flow_number="g", merchant_category="2")), "x")
    with pytest.raises(DataError):
        clean.load_table(raw(spark, row(merchant_category="7")), "x")
    with pytest.raises(DataError):
        clean.load_table(raw(spark, row(merchant_category="0")), "x")


def test_names_keep_their_white_space_and_others_lose_it(spark):
    d = raw(spark, row(global_flow_number="1", storename=" shop ", account_number="　c\t"), row(global_flow_number="2", storename="shop"))
    got = clean.load_table(d, "x").collect()
    assert {r.merchant_id for r in got} == {" shop ", "shop"} and {r.card_id for r in got} == {"c"}


def test_statuses(spark):
    d = raw(spark, *(row(global_flow_number=str(k), is_abnormal=s) for k, s in enumerate(["1", "", None, "3", "4", "7", "8", " 3 ", "3.0", "2", "5", "6", "6.0"])))
    assert sorted(r.is_abnormal for r in clean.exclude_statuses(d).collect()) == ["", "", "1", "3", "3", "3", "4", "7", "8"]


def test_one_mark_excludes_the_store(spark):
    d = raw(spark, row(storename="a", is_interfere=" y "), row(storename="a"), row(storename="b"))
    assert [r.storename for r in clean.drop_interfered(d).collect()] == ["b"]


def test_existing_districts_conflict(spark):
    d = clean.load_table(raw(spark, row(global_flow_number="1", business_district=" BD1 "), row(global_flow_number="2", business_district="BD1")), "x")
    assert [(r.merchant_id, r.community_id) for r in clean.existing_districts(d).collect()] == [("s", "BD1")]
    with pytest.raises(DataError):
        clean.existing_districts(clean.load_table(raw(spark, row(global_flow_number="1", business_district="1"), row(global_flow_number="2", business_district="2")), "x"))


def test_text_source_refuses_repeated_flows(spark):
    cols = [c.replace("is_interfere", "is_intefere") for c in COLS.replace(" string", "").split(", ") if c not in ("merchant_category", "is_abnormal", "business_district")]
    one = spark.createDataFrame([("c", "f", "s", "20240101100000", "1", "2", "R", "N", "20240131", "1")], [*cols, "status"])
    assert clean.load_text(one).count() == 1
    with pytest.raises(DataError):
        clean.load_text(one.union(one))


def test_region_split(spark):
    d = raw(spark, row(storename="甲市店"), row(storename="乙市店"), row(storename="plain"), row(storename="甲市店", region="Q"))
    included, cross = clean.split_by_region(d, {"R": text.city_keywords(["甲"])})
    assert {r.storename for r in included.collect()} == {"甲市店", "plain"} and {r.storename for r in cross.collect()} == {"乙市店"}


def test_labels_ids_and_dates(spark):
    assert text.city_keywords(["甲", "甲市乙区", "丙州", "大兴安岭", "丁区"]) == ["甲市", "丙州", "大兴安岭", "丁区"]
    d = spark.createDataFrame([("007",), ("1e3",), ("BD001",), ("  ",), (None,)], "x string")
    assert [r[0] for r in d.select(text.formatted_id(F.col("x"))).collect()] == ["7", "1000", "BD001", "", ""]
    import datetime as dt

    assert times.month_end_partitions(dt.date(2024, 1, 15), dt.date(2024, 3, 2)) == ["20240131", "20240229", "20240331"]
    assert times.month_end_partitions(dt.date(2024, 1, 15), dt.date(2024, 1, 15)) == ["20240115"]
    t = spark.createDataFrame([("20240101T101112",), ("20240101101112",), ("2024-01-01 10:11:12",), ("2024/01/01 10:11:12",), ("x",)], "x string")
    assert [str(r[0]) for r in t.select(times.parsed(F.col("x"))).collect()] == ["2024-01-01 10:11:12"] * 4 + ["None"]
