import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = ["w2_visits", "a4_pairs", "g1_sppmi", "g5_mutual_top_k", "a9_shares", "a14_coverage", "j10_nearby_pairs", "c2_memberships", "c11_assignment"]

needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else str(v)


def test_names_agree():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@needs_data
def test_flagship(spark):
    assert __spark_entry__.entry(spark).columns == ["l", "r", "weight", "z_score", "support"]


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = __spark_entry__.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(__spark_entry__.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted(([plain(r[i]) for i in at] for r in rel.fetchall()), key=repr)
    got = sorted(([plain(r[c]) for c in cols] for r in df.collect()), key=repr)
    assert got == want
