"""Delimited texts, exports, versioned publishing and guarded clearing."""

from __future__ import annotations

import json
import os
import re
import shutil
import zipfile
from collections.abc import Callable
from datetime import datetime
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ConfigError, DataError
from ..functions.text import clean
from ..operators.clean import TEXT_COLUMNS
from ..operators.validate import reject, reject_blank, require_columns

MIDDLE_DOT = "·"


def read_text_transactions(spark: SparkSession, path: str) -> DataFrame:
    """A |-delimited text with a header, all strings; a byte-order mark before the header is taken off."""
    df = spark.read.option("sep", "|").option("header", True).option("mode", "FAILFAST").csv(path)
    df = df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))
    require_columns(df, TEXT_COLUMNS, path)
    return df


def read_three_columns(spark: SparkSession, path: str, sep: str = MIDDLE_DOT) -> DataFrame:
    """account_number, transaction_time, storename; a line with another number of fields is an error."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parts = F.split("value", re.escape(sep), -1)
    reject(lines, F.size(parts) != 3, ["value"], f"{path}: not three fields")
    return lines.select(*(parts[i].alias(c) for i, c in enumerate(("account_number", "transaction_time", "storename"))))


def read_sniffed(spark: SparkSession, path: str, columns: list[str], aliases: dict[str, str] | None = None, seps: str = ",|\t;") -> DataFrame:
    """A delimited text whose first line tells the delimiter and whether it is a header; place sorts the lines as they stand."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise DataError(f"{path}: empty")
    line = first[0][0].lstrip("﻿")
    sep = max(seps, key=line.count)
    names = [(aliases or {}).get(c.strip(), c.strip()) for c in line.split(sep)]
    header = set(columns) <= set(names)
    df = spark.read.option("sep", sep).option("header", header).csv(path)
    # file by file, block by block, line by line: the order of the text
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    df = df.select("*", place.alias("place"))
    df = df.toDF(*names, "place") if header else df.toDF(*columns, *(f"extra_{i}" for i in range(len(df.columns) - len(columns) - 1)), "place")
    return df.select(*columns, "place")


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """merchant_id, longitude, latitude, place; the first numeric pair of each name, in the order of the text."""
    df = read_sniffed(spark, path, ["merchant_id", "longitude", "latitude"])
    rows = df.select("merchant_id", "place", F.col("longitude").try_cast("double").alias("longitude"), F.col("latitude").try_cast("double").alias("latitude"))
    return rows.where("longitude IS NOT NULL AND latitude IS NOT NULL").groupBy("merchant_id").agg(F.min_by(F.struct("longitude", "latitude", "place"), "place").alias("p")).select("merchant_id", "p.*")


def read_drawn_merchants(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).csv(path)
    df = df.toDF(*(c.lstrip("﻿") for c in df.columns))
    require_columns(df, ["merchant_id", "community_id", "is_anchor_candidate"], path)
    reject_blank(df, ["merchant_id", "community_id"], path)
    reject(df, ~F.coalesce(F.col("is_anchor_candidate"), F.lit("")).isin("0", "1"), ["merchant_id", "is_anchor_candidate"], f"{path}: is_anchor_candidate")
    return df


def smart_export(df: DataFrame, path: str, most: int = 1_000_000) -> str:
    """CSV up to most rows, else a |-delimited text; returns the form."""
    form = "csv" if df.limit(most + 1).count() <= most else "text"
    df.write.mode("overwrite").option("header", True).option("sep", "," if form == "csv" else "|").csv(path)
    return form


def run_directory(root: str, method: str, algorithm: str, now: datetime) -> str:
    """{method}_{algorithm}_{YYMMDDHHMMSS}, which must not be there yet."""
    path = Path(root) / f"{method}_{algorithm}_{now:%y%m%d%H%M%S}"
    path.mkdir(parents=True, exist_ok=False)
    return str(path)


def write_cluster_outputs(folder: str, merchants: DataFrame, communities: DataFrame, edges: DataFrame, summary: dict) -> None:
    """merchants, communities and edges as CSV, the graph as GraphML, summary.json."""
    for name, df in (("merchants", merchants), ("communities", communities), ("edges", edges)):
        df.write.mode("errorifexists").option("header", True).csv(f"{folder}/{name}")
    with open(f"{folder}/graph.graphml", "w", encoding="utf-8") as f:
        f.write('<?xml version="1.0" encoding="utf-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns"><key id="w" for="edge" attr.name="weight" attr.type="double"/><graph edgedefault="undirected">\n')
        for r in merchants.select("merchant_id").distinct().orderBy("merchant_id").toLocalIterator():
            f.write(f'<node id="{escape(r[0], {chr(34): "&quot;"})}"/>\n')
        for r in edges.select("l", "r", "weight").orderBy("l", "r").toLocalIterator():
            a, b = (escape(x, {'"': "&quot;"}) for x in (r[0], r[1]))
            f.write(f'<edge source="{a}" target="{b}"><data key="w">{r[2]!r}</data></edge>\n')
        f.write("</graph></graphml>\n")
    Path(folder, "summary.json").write_text(json.dumps(summary, ensure_ascii=False, indent=2, sort_keys=True), encoding="utf-8")


def assigned_only(df: DataFrame) -> DataFrame:
    return df.where(clean(F.col("community_id")) != "")


def write_xlsx(df: DataFrame, path: str, most_bytes: int = 20_000_000) -> int:
    """One sheet of text cells, streamed row by row; a file beyond most_bytes is an error. Returns the number of rows."""
    n = 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", '<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="rows" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(b'<?xml version="1.0"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
            f.write(_cells([df.columns]))
            for r in df.toLocalIterator():
                f.write(_cells([["" if v is None else str(v) for v in r]]))
                n += 1
            f.write(b"</sheetData></worksheet>")
    if os.path.getsize(path) > most_bytes:
        raise DataError(f"{path}: {os.path.getsize(path)} bytes; {most_bytes} is the most")
    return n


def _cells(rows: list) -> bytes:
    return "".join("<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' for v in r) + "</row>" for r in rows).encode()


def with_retries(call: Callable, attempts: int = 3, never: tuple[type[BaseException], ...] = (MemoryError,)):
    """call(), again after an error, but not after those of never."""
    for k in range(attempts):
        try:
            return call()
        except never:
            raise
        except Exception:
            if k == attempts - 1:
                raise
    return None


def publish(root: str, write: Callable[[str], None], version: str) -> str:
    """Let write fill root/version, then point root/_CURRENT at it; a failed write leaves the old version current."""
    staging, final = Path(root, f".{version}.staging"), Path(root, version)
    if final.exists():
        raise ConfigError(f"{final} is already there")
    shutil.rmtree(staging, ignore_errors=True)
    staging.mkdir(parents=True)
    write(str(staging))
    staging.rename(final)
    pointer = Path(root, "_CURRENT.new")
    pointer.write_text(version)
    pointer.replace(Path(root, "_CURRENT"))
    return str(final)


def current(root: str) -> str | None:
    pointer = Path(root, "_CURRENT")
    return str(Path(root, pointer.read_text())) if pointer.exists() else None


def clear_folder(path: str, inside: str) -> int:
    """Remove what a folder holds; it must be a real folder below inside. Returns the number of entries."""
    target, parent = Path(path), Path(inside).resolve()
    if target.is_symlink() or not target.is_dir() or parent not in target.resolve().parents:
        raise ConfigError(f"{path} is not a folder below {inside}")
    entries = list(target.iterdir())
    for e in entries:
        if e.is_dir() and not e.is_symlink():
            shutil.rmtree(e)
        else:
            e.unlink()
    if any(target.iterdir()):
        raise DataError(f"{path} could not be cleared")
    return len(entries)
