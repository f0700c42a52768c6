"""External mapping sheets: workbooks, their flat form and its nested JSON."""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.functions import text as T

HEADER_ROW = 5
#: Column headings that are read.
HEADINGS = {"FDE #": "ref", "FDE Name": "name", "STRM Relationship": "rel", "Strength of Relationship": "sor", "SCF #": "scf_id"}
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """The cells of a workbook's first sheet as text."""
    with zipfile.ZipFile(BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in item.iter(f"{_NS}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        first = _first_sheet(book)
        for row in ElementTree.fromstring(book.read(first)).iter(f"{_NS}row"):
            cells: dict[int, str] = {}
            for cell in row.iter(f"{_NS}c"):
                column = 0
                for letter in filter(str.isalpha, cell.get("r", "A")):
                    column = column * 26 + ord(letter.upper()) - 64
                value = cell.find(f"{_NS}v")
                if cell.get("t") == "inlineStr":
                    cells[column - 1] = "".join(t.text or "" for t in cell.iter(f"{_NS}t"))
                elif value is not None and value.text is not None:
                    cells[column - 1] = shared[int(value.text)] if cell.get("t") == "s" else value.text
            yield [cells.get(k) for k in range(max(cells, default=-1) + 1)]


def _first_sheet(book: zipfile.ZipFile) -> str:
    """The file of the sheet that the workbook lists first; without a list the one with the smallest number."""
    names = set(book.namelist())
    if {"xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= names:
        sheet = next(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_NS}sheet"), None)
        wanted = None if sheet is None else sheet.get(_REL_ID)
        for relation in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
            if wanted and relation.get("Id") == wanted:
                target = relation.get("Target", "")
                return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return min((n for n in names if n.startswith("xl/worksheets/sheet")), key=lambda n: (len(n), n))


def columns_of(header: list[str | None]) -> dict[str, int]:
    """Where the read headings stand; a missing one is an error."""
    found = {" ".join((name or "").split()): k for k, name in reversed(list(enumerate(header)))}
    lacking = [h for h in HEADINGS if h not in found]
    if lacking:
        raise ValueError(f"the sheet lacks {', '.join(lacking)}")
    return {to: found[h] for h, to in HEADINGS.items()}


def read_workbooks(spark: SparkSession, path: str, header_row: int = HEADER_ROW) -> DataFrame:
    """file, pos and the read columns of every row below the header."""

    def step(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, content in zip(part["path"], part["content"], strict=True):
                rows = list(sheet_rows(content))
                at = columns_of(rows[header_row - 1])
                yield pd.DataFrame([{"file": file, "pos": pos, **{c: r[k] if k < len(r) else None for c, k in at.items()}} for pos, r in enumerate(rows[header_row:])], columns=["file", "pos", *at])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(step, "file string, pos long, ref string, name string, rel string, sor string, scf_id string")


def legs(rows: DataFrame, framework: str, style: str = "iso") -> DataFrame:
    """framework, scf_id, ref, name, rel, sor (and file, pos if the rows have them) of the sheet rows that map something."""
    place = [c for c in ("file", "pos") if c in rows.columns]
    clean = rows.select(*(T.squeeze(F.col(c)).alias(c) for c in ("scf_id", "ref", "name", "rel", "sor")), *place)
    good = T.filled(F.col("rel")) & (F.col("rel") != "No Relationship") & T.filled(F.col("scf_id")) & (F.col("scf_id") != "N/A")
    return clean.where(good).select(F.lit(framework).alias("framework"), "scf_id", T.ref_style(style)(F.col("ref")).alias("ref"), "name", "rel", T.digits(F.col("sor")).alias("sor"), *place)


def controls(strm: DataFrame) -> DataFrame:
    """framework, scf_id and its legs as JSON, in the order of the sheet's rows (without them: by their values). A control's
    legs are the rows that one sheet has for it; a framework is never gathered."""
    leg = F.struct("ref", "name", "rel", "sor")
    order = [c for c in ("file", "pos") if c in strm.columns]
    legs = F.transform(F.array_sort(F.collect_list(F.struct(*order, leg.alias("leg")))), lambda x: x["leg"])
    return strm.groupBy("framework", "scf_id").agg(F.to_json(legs, {"ignoreNullFields": "false"}).alias("legs"))


def write_nested_json(strm: DataFrame, path: str) -> int:
    """One {framework: {scf_id: [leg]}} file; controls come to the driver one partition at a time. Returns their number."""
    n, now = 0, None
    with open(path, "w", encoding="utf-8") as file:
        file.write("{")
        for n, r in enumerate(controls(strm).orderBy("framework", "scf_id").toLocalIterator(), 1):
            if r["framework"] != now:
                file.write(("\n  }," if now is not None else "") + f"\n  {json.dumps(r['framework'], ensure_ascii=False)}: {{")
            file.write(("," if r["framework"] == now else "") + f"\n    {json.dumps(r['scf_id'], ensure_ascii=False)}: {r['legs']}")
            now = r["framework"]
        file.write("\n  }\n}\n" if n else "}\n")
    return n


def read_nested_json(spark: SparkSession, path: str) -> DataFrame:
    """The flat form of {framework: {scf_id: [leg]}}."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,array<struct<ref:string,name:string,rel:string,sor:int>>>>").alias("m"))
    return raw.select(F.explode("m").alias("framework", "controls")).select("framework", F.explode("controls").alias("scf_id", "legs")).select("framework", "scf_id", F.explode("legs").alias("leg")).select("framework", "scf_id", "leg.*")


def assert_comparable(strm: DataFrame) -> None:
    """Fewer than two frameworks can't be compared."""
    if strm.select("framework").distinct().limit(2).count() < 2:
        raise ValueError("a mapping needs two frameworks at least")
