"""Text expressions: trimming, ids, status codes, region keywords."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """All Unicode white space off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """Stripped text, '' for null."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def kept_name(c: Column) -> Column:
    """A store name as it stands, '' for null: white space is part of its identity."""
    return F.coalesce(c.cast("string"), F.lit(""))


def number(c: Column) -> Column:
    """A double where the text is plainly one, else null; no type suffixes, no words."""
    t = strip(c.cast("string"))
    return F.when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), t.try_cast("double"))


def formatted_id(c: Column) -> Column:
    """'' for blank; integral numbers as integer text ('007' to '7', '1e3' to '1000'); others as they stand."""
    t = clean(c)
    n = number(t)
    return F.when(t == "", "").when(n.isNotNull() & (n == F.floor(n)) & (F.abs(n) < 9e15), n.cast("bigint").cast("string")).otherwise(t)


def id_order(c: Column) -> Column:
    """Sort key of ids: the integer it is (0 otherwise), then the text."""
    return F.struct(F.coalesce(c.try_cast("bigint"), F.lit(0)).alias("n"), c.alias("t"))


#: Status names and their codes in result tables.
STATUS_CODES = {"active": "1", "normal": "1", "suspect_online": "2", "suspect_isolated": "3", "suspect_lost": "4", "suspect_cross_region": "5", "suspect_chain_store": "6", "deleted": "7"}
NORMAL_NAMES = ("active", "normal", "正常")


def status_code(c: Column) -> Column:
    """Name to code; codes pass; anything else null, which target_rows refuses."""
    t = clean(c)
    out = F.when(t.rlike("^[1-7]$"), t)
    for name, code in STATUS_CODES.items():
        out = out.when(t == name, code)
    return out


def is_normal(c: Column) -> Column:
    """Whether a status, name or code, says that a merchant is in order; null and blank do not."""
    t = clean(c)
    return (t == "1") | t.isin(*NORMAL_NAMES)


def normal_status(c: Column) -> Column:
    """'3.0' to '3', null to ''."""
    t = clean(c)
    n = number(t)
    return F.when(n.isNotNull() & (n == F.floor(n)), n.cast("bigint").cast("string")).otherwise(t)


def category(c: Column) -> Column:
    """0 to 3 from '1', '1.0' and the like; else null."""
    n = number(c)
    return F.when((n == F.floor(n)) & n.between(0, 3), n.cast("int"))


def city_keyword(label: str) -> str:
    """A city label up to its first 市; labels that end in 区 or 州, and 大兴安岭, stay bare; others get 市."""
    label = label.strip()
    if "市" in label:
        return label[: label.index("市") + 1]
    return label if label.endswith(("区", "州")) or label == "大兴安岭" else label + "市"


def city_keywords(labels: list[str]) -> list[str]:
    return list(dict.fromkeys(city_keyword(x) for x in labels if x.strip()))


def in_city(name: Column, keywords: list[str]) -> Column:
    """Names without 市 pass; names with it must hold one of the keywords."""
    held = F.lit(False)
    for k in keywords:
        held = held | name.contains(k)
    return ~name.contains("市") | held


def display_units(text: str) -> int:
    """Width on a chart: two for wide characters, one for others."""
    return sum(2 if ord(ch) > 0x2E7F else 1 for ch in text)


def safe_file_name(text: str) -> str:
    return re.sub(r"[^\w.-]+", "_", text).strip("._") or "unnamed"
