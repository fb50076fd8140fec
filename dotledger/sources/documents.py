"""Scans of document folders and of tables in text formats."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dotledger.functions.rules import TABLE_COLUMNS
from dotledger.functions.tables import abbreviations, pipe_table
from dotledger.plans.session import ship_package


def scan_documents(spark: SparkSession, root: str, start_from: int | None = None, ids: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, name, path, md) of the Markdown files in folders named ``<digits>_<name>``.

    start_from: the least id; ids: only these. Folders without a numeric id are left out.
    """
    files = spark.read.text(f"{root}/*/*.md", wholetext=True).select(F.col("value").alias("md"), F.col("_metadata.file_path").alias("path"))
    folder = F.element_at(F.split("path", "/"), -2)
    out = files.select(F.regexp_extract(folder, "^([^_]*)", 1).alias("doc_id"), F.regexp_extract(folder, "^[^_]*_(.*)$", 1).alias("name"), "path", "md").filter(F.col("doc_id").rlike("^[0-9]+$"))
    if start_from is not None:
        out = out.filter(F.col("doc_id").cast("bigint") >= start_from)
    return out.filter(F.col("doc_id").isin(*ids)) if ids is not None else out


def read_strict_csv(spark: SparkSession, path: str, schema: str, required: list[str]) -> DataFrame:
    """A CSV with a header; empty cells are empty strings, a byte order mark is dropped, a missing required column is an error."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").option("nullValue", "\u0000").csv(path)
    raw = raw.toDF(*(c.lstrip("\ufeff") for c in raw.columns))
    missing = [c for c in required if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    fields = T._parse_datatype_string(schema).fields
    return raw.select(*(F.expr(f"try_cast(coalesce(`{f.name}`, '') as {f.dataType.simpleString()})").alias(f.name) if f.name in raw.columns else F.lit("").cast(f.dataType).alias(f.name) for f in fields))


def read_tolerant_csv(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their line): rows that don't fit the schema are kept apart instead of failing the read."""
    full = T._parse_datatype_string(schema + ", _corrupt string")
    rows = spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    return rows.filter("_corrupt is null").drop("_corrupt"), rows.filter("_corrupt is not null").withColumnRenamed("_corrupt", "line")


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """The lines with content of a text file, trimmed."""
    return spark.read.text(path).select(F.trim("value").alias("template")).filter("template <> ''")


def read_review_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of review files ``{"doc_id": ..., "items": [...]}``; a file that doesn't parse gives one row with status error."""
    schema = "doc_id string, items array<struct<cd_name string, column string, reason string, current_value string, raw_values array<string>>>"
    parsed = spark.read.text(path, wholetext=True).select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("j"))
    return parsed.select("j.doc_id", F.explode_outer("j.items").alias("i"), F.when(F.col("j.doc_id").isNull(), "error").otherwise("ok").alias("status")).select("doc_id", "i.*", "status")


def pdf_source(spark: SparkSession, root: str) -> DataFrame:
    """Rows (path, length, content) of PDF files, for a layout model behind the boundary; no PDF library is used here."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(root).select("path", "length", "content")


def extraction_tables(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, extraction_no, row_no, the table's columns) of ``### Extraction k`` sections with a pipe table.

    The first table of a section counts; rows with another number of cells than the ten columns are left out.
    """
    sections = texts.select(key, F.explode(F.regexp_extract_all(F.col(text), F.lit("(?s)###\\s*Extraction\\s+\\d+.*?(?=###\\s*Extraction\\s+\\d+|\\z)"), 0)).alias("s"))
    numbered = sections.select(key, F.regexp_extract("s", "###\\s*Extraction\\s+(\\d+)", 1).cast("int").alias("extraction_no"), F.regexp_extract("s", "((?:(?m)^\\|.*\\|[ \\t]*\\r?\\n?)+)", 1).alias("t"))
    lines = numbered.select(key, "extraction_no", F.posexplode(F.filter(F.split("t", "\r?\n"), lambda x: F.trim(x) != "")).alias("p", "line")).filter("p >= 2")
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), "^\\||\\|$", ""), "\\|"), lambda x: F.trim(x))
    rows = lines.select(key, "extraction_no", (F.col("p") - 2).alias("row_no"), cells.alias("c")).filter(F.size("c") == len(TABLE_COLUMNS))
    return rows.select(key, "extraction_no", "row_no", *(F.element_at("c", i + 1).alias(name) for i, name in enumerate(TABLE_COLUMNS)))


def valid_tables(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, row_no, the table's columns) of each text's first pipe table of which every row has the ten columns, without its header; a table
    with any other row is passed over."""
    ship_package(texts.sparkSession)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, i, *r) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t for i, r in enumerate(pipe_table(t)[1:])]
            cols = list(zip(*rows)) or [()] * (2 + len(TABLE_COLUMNS))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), *[pa.string()] * len(TABLE_COLUMNS)))], [key, "row_no", *TABLE_COLUMNS])

    return texts.select(F.col(key).cast("string").alias(key), F.col(text).cast("string").alias("_t")).mapInArrow(parse, f"`{key}` string, row_no int, " + ", ".join(f"{c} string" for c in TABLE_COLUMNS))


def abbreviation_scan(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, pos, short, long, context) of the abbreviations that each text explains in brackets, in order."""
    ship_package(texts.sparkSession)
    dtype = dict(texts.dtypes)[key]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, k, *a) for i, t in enumerate(batch.column(1).to_pylist()) if t for k, a in enumerate(abbreviations(t))]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0], pa.int32())), *(pa.array(c, t) for c, t in zip(cols[1:], (pa.int32(), *[pa.string()] * 3)))], [key, "pos", "short", "long", "context"])

    return texts.select(key, F.col(text).cast("string").alias("_t")).mapInArrow(scan, f"`{key}` {dtype}, pos int, short string, long string, context string")


def html_tables(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, table_no, row_no, cells array<string>) of HTML tables, cells padded to the widest row of their table."""
    tables = texts.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit("(?is)<table[^>]*>.*?</table>"), 0)).alias("table_no", "t"))
    rows = F.regexp_extract_all(F.col("t"), F.lit("(?is)<tr[^>]*>(.*?)</tr>"), 1)
    cell = lambda r: F.transform(F.regexp_extract_all(r, F.lit("(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "(?s)<[^>]*>", ""), "\\s+", " ")))
    split = tables.select(key, "table_no", F.transform(rows, cell).alias("r"))
    wide = split.withColumn("w", F.array_max(F.transform("r", F.size)))
    padded = F.transform("r", lambda r: F.concat(r, F.array_repeat(F.lit(""), F.col("w") - F.size(r))))
    return wide.select(key, "table_no", F.posexplode(padded).alias("row_no", "cells"))


def chunk_markdown(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, para_id, token_count, text) of ``[Para n, Tokens: m]`` chunks between lines of dashes."""
    parts = texts.select(key, F.explode(F.split(F.col(text), "(?m)^---\\s*$")).alias("p"))
    head = "\\[Para\\s+(\\d+),\\s*Tokens:\\s*(\\d+)\\]"
    hit = parts.filter(F.col("p").rlike(head))
    return hit.select(key, F.regexp_extract("p", head, 1).cast("int").alias("para_id"), F.regexp_extract("p", head, 2).cast("int").alias("token_count"), F.regexp_replace(F.regexp_replace("p", f"(?s)^.*?{head}", ""), "^\\s+|\\s+$", "").alias("text"))
