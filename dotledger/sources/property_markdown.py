"""The property notes in Markdown: entries of samples with their evidence and tagged sentences, read and written.

    ## sample name
    1. [para=3; window=SMALL; sids=4,5]
    > evidence line
    - QY: sentence
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dotledger.operators.consolidation import property_rank

_SAMPLE = re.compile(r"^##\s+(.*\S)\s*$")
_ENTRY = re.compile(r"^\d+\.\s*\[(.*)\]\s*$")
_EVIDENCE = re.compile(r"^>\s?(.*)$")
_TAG = re.compile(r"^-\s*([^:]+?)\s*:\s*(.*\S)\s*$")
_SUFFIX = re.compile(r"(?:\s*\((?:APP|MAIN|VS(?:-REFINED|-UNRESOLVED)?)\))+$", re.IGNORECASE)


def sample_name(header: str) -> str:
    """The sample of a header without its kind; empty for a step's header."""
    name = _SUFFIX.sub("", re.sub(r"^[*_`]+|[*_`]+$", "", header.strip())).strip()
    return "" if re.match(r"(?i)step\b", name) else name


def entry_meta(head: str) -> dict[str, str]:
    """The fields of an entry's head such as ``para=3; window=SMALL; sids=4,5``."""
    return {k.strip().lower(): v.strip() for k, _, v in (p.partition("=") for p in head.split(";")) if v}


def parse_notes(text: str) -> list[tuple]:
    """(sample, entry, para_id, window, sids, evidence, tag, sentence, tag_order) of each tagged sentence; entries without a sample or tag are dropped."""
    rows, sample, entry, meta, evidence, tags = [], "", 0, {}, [], []

    def close() -> None:
        if sample and meta:
            sids = [int(x) for x in re.findall(r"\d+", meta.get("sids", ""))]
            para = int(meta["para"]) if meta.get("para", "").isdigit() else None
            rows.extend((sample, entry, para, meta.get("window", ""), sids, list(evidence), t, s, k) for k, (t, s) in enumerate(tags))

    for line in text.splitlines():
        if m := _SAMPLE.match(line):
            close()
            sample, entry, meta, evidence, tags = sample_name(m[1]), 0, {}, [], []
        elif m := _ENTRY.match(line):
            close()
            entry, meta, evidence, tags = entry + 1, entry_meta(m[1]), [], []
        elif m := _EVIDENCE.match(line):
            evidence.append(m[1])
        elif m := _TAG.match(line):
            tags.append((m[1], m[2]))
    close()
    return rows


ITEM_SCHEMA = "sample string, entry int, para_id int, win_level string, window_sids array<int>, evidence_lines array<string>, tag string, sentence string, tag_order int"


def read_notes(texts: DataFrame, key: str, text: str) -> DataFrame:
    """One row per tagged sentence of each document's notes."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.string(), pa.string(), pa.int32())
        for batch in batches:
            rows = [(k, *r) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t for r in parse_notes(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [key, "sample", "entry", "para_id", "win_level", "window_sids", "evidence_lines", "tag", "sentence", "tag_order"])

    return texts.select(F.col(key).cast("string").alias(key), F.col(text).cast("string").alias("t")).mapInArrow(parse, f"`{key}` string, {ITEM_SCHEMA}")


def write_notes(items: DataFrame, key: str) -> DataFrame:
    """Rows (key, md): each document's notes, samples in the order of their names without case, entries by place, sentences by tag order."""
    tags = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tag_order", property_rank(F.col("tag")).alias("r"), "tag", "sentence"))), lambda x: F.concat(F.lit("- "), x["tag"], F.lit(": "), x["sentence"])), "\n")
    entries = items.groupBy(key, "sample", "para_id", "win_level", "window_sids", "evidence_lines").agg(tags.alias("tags"))
    head = F.concat(F.lit("[para="), F.coalesce(F.col("para_id").cast("string"), F.lit("")), F.lit("; window="), F.coalesce("win_level", F.lit("")), F.lit("; sids="), F.array_join("window_sids", ","), F.lit("]"))
    body = F.concat_ws("\n", head, F.array_join(F.transform("evidence_lines", lambda x: F.concat(F.lit("> "), x)), "\n"), "tags")
    each = entries.select(key, "sample", F.struct("para_id", "win_level", "window_sids", body.alias("b")).alias("e"))
    listed = each.groupBy(key, "sample").agg(F.transform(F.array_sort(F.collect_list("e")), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["b"])).alias("l"))
    block = F.struct(F.lower("sample").alias("o"), F.concat(F.lit("## "), "sample", F.lit("\n"), F.array_join("l", "\n")).alias("b"))
    return listed.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(block)), lambda x: x["b"]), "\n\n").alias("md"))
