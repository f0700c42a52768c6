"""Framework texts as nodes: two-column text, nested JSON, extracted running text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapweave.functions import text as T

_COLUMNS = ["id", "framework", "version", "native_ref", "node_type", "title", "raw_text", "parent_id", "extra"]


def read_texts(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """file and text, one row a file."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def numbered_lines(texts: DataFrame) -> DataFrame:
    """file, pos, line: trimmed lines of each text, from 0."""
    return texts.select("file", F.posexplode(T.lines(F.col("text"))).alias("pos", "line")).withColumn("line", T.trim(F.col("line")))


def _so_far(file_cols: list[str]) -> Window:
    return Window.partitionBy(*file_cols).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)


# ------------------------------------------------------------------ two columns

# How a section and a row of two columns are told.
_SECTION, _ROW = "^#\\s*(.+)$", "^(\\S+)(?:\\t| {2,})\\s*(.+)$"


def classified_rows(lines: DataFrame) -> DataFrame:
    """lines with kind (section, row, reject), ref, body and the reference of the section they stand in."""
    rows = lines.where(F.length("line") > 0)
    is_section, is_row = F.col("line").rlike(_SECTION), F.col("line").rlike(_ROW)
    kind = F.when(is_section, "section").when(is_row, "row").otherwise("reject")
    rows = rows.withColumn("kind", kind)
    title = T.trim(F.regexp_extract("line", _SECTION, 1))
    ref = F.when(is_section, T.slug(title)).when(is_row, F.regexp_extract("line", _ROW, 1))
    body = F.when(is_section, title).when(is_row, T.trim(F.regexp_extract("line", _ROW, 2)))
    rows = rows.withColumns({"ref": ref, "body": body})
    section = F.last(F.when(F.col("kind") == "section", F.col("ref")), ignorenulls=True).over(_so_far(["file"]))
    return rows.withColumn("section", section)


def two_column_nodes(texts: DataFrame, framework: str, version: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and rejected lines of `# section` and `ref<tab or spaces>text` files."""
    rows = classified_rows(numbered_lines(texts))
    fw, ver = F.lit(framework), F.lit(version)
    section = F.col("kind") == "section"
    nodes = rows.where("kind <> 'reject'").select(
        T.node_id(fw, ver, F.col("ref")).alias("id"), fw.alias("framework"), ver.alias("version"), F.col("ref").alias("native_ref"),
        F.when(section, "section").otherwise("requirement").alias("node_type"), F.when(section, F.col("body")).otherwise(T.title_of(F.col("body"))).alias("title"),
        F.col("body").alias("raw_text"), F.when(~section & F.col("section").isNotNull(), T.node_id(fw, ver, F.col("section"))).alias("parent_id"),
        F.when(section, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("doc"), F.lit(f"{framework.lower()}-{version}"))).alias("extra"))
    return nodes, rows.where("kind = 'reject'").select("file", "pos", "line")


# ------------------------------------------------------------------ nested JSON

_LEAF = "ref string, title string, description string"
NESTED = f"version string, objectives array<struct<{_LEAF.replace(' string', ': string')}, principles: array<struct<{_LEAF.replace(' string', ': string')}, outcomes: array<struct<{_LEAF.replace(' string', ': string')}, igps: map<string, array<string>>>>>>>>"


def nested_nodes(docs: DataFrame, framework: str = "CAF", version: str = "4.0") -> DataFrame:
    """Nodes of objectives, principles, outcomes and indicators, each below its container."""
    fw, ver = F.lit(framework), F.coalesce(F.col("version"), F.lit(version))

    def level(rows: DataFrame, item: str, kind: str, parent: Column) -> DataFrame:
        title, body = T.trim(F.col(f"{item}.title")), T.trim(F.coalesce(F.col(f"{item}.description"), F.lit("")))
        return rows.select(
            T.node_id(fw, ver, F.col(f"{item}.ref")).alias("id"), fw.alias("framework"), ver.alias("version"), F.col(f"{item}.ref").alias("native_ref"), F.lit(kind).alias("node_type"),
            title.alias("title"), F.when(F.length(body) > 0, body).otherwise(title).alias("raw_text"), parent.alias("parent_id"), F.create_map().cast("map<string,string>").alias("extra"))

    objectives = docs.select("version", F.explode("objectives").alias("o"))
    principles = objectives.select("version", "o", F.explode("o.principles").alias("p"))
    outcomes = principles.select("version", "p", F.explode("p.outcomes").alias("c"))
    igps = outcomes.select("version", "c", F.explode("c.igps").alias("level", "texts")).select("version", "c", "level", F.posexplode("texts").alias("at", "text"))
    place = (F.col("at") + 1).cast("string")
    ref = F.concat_ws("#", F.col("c.ref"), F.col("level"), place)
    title = F.concat(F.col("c.ref"), F.lit(" IGP ("), F.col("level"), F.lit(" "), place, F.lit(")"))
    text = T.trim(F.col("text"))
    leaves = igps.select(
        T.node_id(fw, ver, ref).alias("id"), fw.alias("framework"), ver.alias("version"), ref.alias("native_ref"), F.lit("igp").alias("node_type"), title.alias("title"), F.when(F.length(text) > 0, text).otherwise(title).alias("raw_text"),
        T.node_id(fw, ver, F.col("c.ref")).alias("parent_id"), F.create_map(F.lit("igp_status"), F.col("level")).alias("extra"))
    out = level(objectives, "o", "objective", F.lit(None).cast("string"))
    out = out.unionByName(level(principles, "p", "principle", T.node_id(fw, ver, F.col("o.ref"))))
    return out.unionByName(level(outcomes, "c", "outcome", T.node_id(fw, ver, F.col("p.ref")))).unionByName(leaves)


# ------------------------------------------------------------------ running text

# How the lines of the extracted text look.
_DASH = "[-\\u2013\\u2014]"
HEADINGS = {
    "objective": (f"^CAF\\s*{_DASH}\\s*Objective\\s+([A-D])\\s*{_DASH}\\s*(.+)$"),
    "principle": "^Principle\\s+([A-D]\\d+)\\s+(.+)$",
    "outcome": "^([A-D]\\d+\\.[a-z])\\s+(.+)$",
}
# How a table's head is told, and how its lead-in lines begin.
TABLE_HEAD = "^(Not Achieved|Partially Achieved|Achieved)\\b"
TABLE_LEADS = ("At least one of the following", "All the following")
NOISE = "^(?:National Cyber Security Centre|The Cyber Assessment Framework|\\d+)\\s*$"
CONTENTS = "\\.{4,}\\s*\\d+\\s*$"
FOOTER = "© Crown copyright"


def body_lines(lines: DataFrame) -> DataFrame:
    """Up to the first footer line of a file, without blanks, page furniture and contents."""
    cut = F.min(F.when(F.col("line").startswith(FOOTER), F.col("pos"))).over(Window.partitionBy("file"))
    rows = lines.withColumn("_cut", cut).where(F.col("_cut").isNull() | (F.col("pos") < F.col("_cut"))).drop("_cut")
    return rows.where((F.length("line") > 0) & ~F.col("line").rlike(NOISE) & ~F.col("line").rlike(CONTENTS))


def segmented(lines: DataFrame) -> DataFrame:
    """lines with kind (heading kinds, table, body), ref, heading text, seg, in_table and the references in force.

    A heading counts where its reference comes first; repeats are tested as table lines, else they are body.
    """
    kind, ref, title = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern in reversed(HEADINGS.items()):
        hit = F.col("line").rlike(pattern)
        kind, ref, title = F.when(hit, name).otherwise(kind), F.when(hit, F.regexp_extract("line", pattern, 1)).otherwise(ref), F.when(hit, F.regexp_extract("line", pattern, 2)).otherwise(title)
    rows = lines.withColumns({"_kind": kind, "ref": ref, "heading": title})
    first = F.row_number().over(Window.partitionBy("file", "ref").orderBy("pos")) == 1
    rows = rows.withColumn("accepted", F.col("_kind").isNotNull() & first)
    rows = rows.withColumn("kind", F.when(F.col("accepted"), F.col("_kind")).when(F.col("line").rlike(TABLE_HEAD) | F.col("line").startswith(TABLE_LEADS[0]) | F.col("line").startswith(TABLE_LEADS[1]), "table").otherwise("body")).drop("_kind")
    so_far = _so_far(["file"])
    rows = rows.withColumns({
        "seg": F.sum(F.col("accepted").cast("int")).over(so_far),
        "objective_seg": F.sum((F.col("kind") == "objective").cast("int")).over(so_far),
        "objective": F.last(F.when(F.col("kind") == "objective", F.col("ref")), ignorenulls=True).over(so_far),
    })
    return rows.withColumns({
        "in_table": F.max((F.col("kind") == "table").cast("int")).over(_so_far(["file", "seg"])) == 1,
        "principle": F.last(F.when(F.col("kind") == "principle", F.col("ref")), ignorenulls=True).over(_so_far(["file", "objective_seg"])),
    })


def running_text_nodes(lines: DataFrame, framework: str = "CAF", version: str = "4.0") -> DataFrame:
    """Objectives, principles and outcomes of file, pos, line rows; the descriptions end where a table begins."""
    rows = segmented(body_lines(lines)).where("seg > 0")
    is_body = (F.col("kind") == "body") & ~F.col("in_table")
    fw, ver = F.lit(framework), F.lit(version)
    parent = F.when(F.col("kind") == "principle", F.col("objective")).when(F.col("kind") == "outcome", F.col("principle"))
    cells = rows.groupBy("file", "seg").agg(
        F.first(F.when(F.col("accepted"), F.struct("kind", "ref", "heading", parent.alias("parent"))), ignorenulls=True).alias("h"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(is_body, F.struct("pos", "line")))), lambda x: x["line"]), " ").alias("body"))
    title, body = T.rejoined_capital(F.col("h.heading")), T.rejoined_capital(F.col("body"))
    cells = cells.select("file", "seg", "h.*", title.alias("title"), body.alias("body"))
    opened = F.length(F.regexp_replace("title", "[^(]", "")) > F.length(F.regexp_replace("title", "[^)]", ""))
    torn = opened & F.col("body").contains(")")
    head, rest = F.substring_index("body", ")", 1), F.expr("substring(body, instr(body, ')') + 1)")
    cells = cells.withColumns({"title": F.when(torn, T.rejoined_capital(F.concat("title", F.lit(" "), head, F.lit(")")))).otherwise(F.col("title")), "body": F.when(torn, T.rejoined_capital(rest)).otherwise(F.col("body"))})
    return cells.select(
        T.node_id(fw, ver, F.col("ref")).alias("id"), fw.alias("framework"), ver.alias("version"), F.col("ref").alias("native_ref"), F.col("kind").alias("node_type"), "title",
        F.when(F.length("body") > 0, F.col("body")).otherwise(F.col("title")).alias("raw_text"), F.when(F.col("parent").isNotNull(), T.node_id(fw, ver, F.col("parent"))).alias("parent_id"), F.create_map().cast("map<string,string>").alias("extra"))


def pdf_texts(spark: SparkSession, path: str) -> DataFrame:
    """file and text of PDFs; needs pypdf on the executors."""
    import pandas as pd

    def step(parts):
        from io import BytesIO

        from pypdf import PdfReader

        for part in parts:
            yield pd.DataFrame({"file": part["path"], "text": ["\n".join(p.extract_text() or "" for p in PdfReader(BytesIO(x)).pages) for x in part["content"]]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(step, "file string, text string")
