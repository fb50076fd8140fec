"""Structured notes in Markdown, read and written: entries of samples with their evidence, a property abstract, and a JSON value for each of its lines.

    ## sample name
    1. [para=3; window=SMALL; sids=4,5]
    evidence line
    Property abstract:
    [A]QY: sentence
    Structured:
    [A]QY: {"tag":"QY","values":[20.0],"unit":"%"}

Refined notes have the same entries with a line per property and no values.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dotledger.functions.answers import tolerant_json
from dotledger.functions.payloads import tag_name
from dotledger.plans.session import ship_package
from dotledger.sources.property_markdown import sample_name

_SAMPLE = re.compile(r"^#+\s+(.*\S)\s*$")
_ENTRY = re.compile(r"^\s*(\d+)\.\s+(.*\S)\s*$")
_HEAD = re.compile(r"\[\s*para\s*=\s*([^;\]]*?)\s*;\s*(?:win|window)\s*=\s*([^;\]]*?)\s*;\s*sids\s*=\s*([^\]]*?)\s*\]", re.IGNORECASE)
_ABSTRACT = re.compile(r"^\s*(?:property abstract|refined properties)\s*:\s*$", re.IGNORECASE)
_STRUCTURED = re.compile(r"^\s*structured\s*:\s*$", re.IGNORECASE)
_LINE = re.compile(r"^\s*(\[[^\]]+\])?\s*([A-Za-z]\w*)\s*:\s*(.+?)\s*$")
_EVIDENCE = re.compile(r"^\s*evidence\s*:\s*$", re.IGNORECASE)
_CHANGE = re.compile(r"^\s*\[change\]\s*$", re.IGNORECASE)
#: The keys of a structured value that the notes of changes keep.
VALUE_KEYS = ("tag", "values", "unit", "vary_by", "vary_values", "label")


@dataclass
class Line:
    """One property of an entry: its prefix such as [A], the property, the sentence, and the value as parsed and as written."""

    prefix: str
    tag: str
    sentence: str
    value: Any = None
    raw: str = ""


@dataclass
class Entry:
    sample: str
    number: int
    head: str
    change: bool = False
    blocks: list[dict] = field(default_factory=list)
    lines: list[Line] = field(default_factory=list)
    tail: list[str] = field(default_factory=list)


def evidence_blocks(lines: list[str]) -> list[dict]:
    """Blocks {para, window, sids, text} of what stands before an entry's abstract: each head with the lines after it, without their evidence mark. An entry without a head has
    one block, of what follows its first line."""
    out: list[dict] = [] if any(map(_HEAD.search, lines)) else [{"para": "", "window": "", "sids": [], "text": []}]
    for k, line in enumerate(lines):
        if m := _HEAD.search(line):
            out.append({"para": m[1], "window": m[2], "sids": [int(x) for x in re.findall(r"-?\d+", m[3])], "text": []})
        elif k and out and line.strip() and not _EVIDENCE.match(line) and not _CHANGE.match(line):
            out[-1]["text"].append(line.strip().removeprefix("> "))
    return [b | {"text": "\n".join(b["text"])} for b in out]


def pair_values(lines: list[Line], values: list[tuple[str, str, str]]) -> None:
    """Gives each line the first unused value (prefix, tag, text) of its prefix and property, else of its property."""
    free = list(values)
    for x in lines:
        hit = next((v for v in free if v[:2] == (x.prefix, x.tag)), None) or next((v for v in free if v[1] == x.tag), None)
        if hit:
            free.remove(hit)
            x.raw, x.value = hit[2], tolerant_json(hit[2])


def parse_structured(text: str, strict: bool = False) -> list[Entry]:
    """The entries of structured notes. Headers of steps are no samples, but lines of the entry they stand in.

    strict: an entry begins only with a head or a change mark, and values keep `VALUE_KEYS` only, as the notes of changes are read.
    """
    entries: list[Entry] = []
    sample: str | None = None
    raw: list[tuple[Entry, list[str]]] = []
    for line in text.splitlines():
        m = _SAMPLE.match(line)
        if m and (name := sample_name(m[1])):
            sample = name
            continue
        m = _ENTRY.match(line)
        if m and sample is not None and (not strict or _HEAD.search(m[2]) or _CHANGE.match(m[2])):
            raw.append((Entry(sample, int(m[1]), m[2]), [m[2]]))
        elif raw and raw[-1][0].sample == sample:
            raw[-1][1].append(line)
    for entry, lines in raw:
        at = next((k for k, x in enumerate(lines) if _ABSTRACT.match(x)), len(lines))
        then = next((k for k, x in enumerate(lines) if k > at and _STRUCTURED.match(x)), len(lines))
        entry.change = any(_CHANGE.match(x) for x in lines[:at])
        entry.blocks = evidence_blocks(lines[:at])
        entry.lines = [Line(m[1] or "", tag_name(m[2]), m[3]) for x in lines[at + 1 : then] if (m := _LINE.match(x))]
        values = [(m[1] or "", tag_name(m[2]), m[3]) for x in lines[then + 1 :] if (m := _LINE.match(x))]
        entry.tail = [x for x in lines[then + 1 :] if x.strip() and not _LINE.match(x)]
        pair_values(entry.lines, values)
        if strict:
            for x in entry.lines:
                x.value = _kept(x.value)
        entries.append(entry)
    return entries


def _kept(value: Any) -> Any:
    if isinstance(value, list):
        return [_kept(v) for v in value]
    return {k: value[k] for k in VALUE_KEYS if k in value} if isinstance(value, dict) else value


def parse_refined(text: str) -> list[Entry]:
    """The entries of refined notes; of several sentences of a property the last one holds, in the place of the first."""
    out = []
    for entry in parse_structured(text, strict=True):
        last = {x.tag: x for x in entry.lines}
        entry.lines = [last[t] for t in dict.fromkeys(x.tag for x in entry.lines)]
        if entry.lines:
            out.append(entry)
    return out


def render_structured(entries: list[Entry]) -> str:
    """The notes of entries, numbered anew for each sample; an entry without a line keeps its evidence only."""
    out: list[str] = []
    sample, number = None, 0
    for e in entries:
        if e.sample != sample:
            out += ([""] if out else []) + [f"## {e.sample}"]
            sample, number = e.sample, 0
        number += 1
        heads = [f"[para={b['para']}; window={b['window']}; sids={','.join(map(str, b['sids']))}]" for b in e.blocks]
        if e.change:
            out.append(f"{number}. [change]")
        for k, (h, b) in enumerate(zip(heads, e.blocks)):
            letter = f"{chr(65 + k)}." if e.change and k < 26 else ""
            out.append(f"{letter} {h}" if e.change else f"{number}. {h}" if not k else h)
            out += [f"> {x}" for x in b["text"].split("\n") if x]
        if not e.blocks and not e.change:
            out.append(f"{number}. {e.head}")
        if e.lines:
            out += ["Property abstract:", *(f"{x.prefix}{x.tag}: {x.sentence}" for x in e.lines), "Structured:"]
            out += [f"{x.prefix}{x.tag}: {json.dumps(x.value, ensure_ascii=False, separators=(',', ':')) if x.value is not None else x.raw or '{}'}" for x in e.lines]
        out += e.tail
    return "\n".join(out) + "\n" if out else ""


_SCHEMA = "sample string, entry int, change boolean, para string, win_level string, window_sids array<int>, evidence string, prefix string, tag string, sentence string, structured string, line_order int"


def read_structured(texts: DataFrame, key: str, text: str, strict: bool = False, refined: bool = False) -> DataFrame:
    """One row per property line of each document's notes; the first block's head and all blocks' evidence. Null and empty texts give none."""
    ship_package(texts.sparkSession)
    names = [key, *(x.split()[0] for x in _SCHEMA.split(", "))]
    types = (pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32())

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for e in (parse_refined(t) if refined else parse_structured(t, strict)) if t else ():
                    b = e.blocks[0] if e.blocks else {"para": "", "window": "", "sids": []}
                    for i, x in enumerate(e.lines):
                        rows.append((k, e.sample, e.number, e.change, b["para"], b["window"], b["sids"], "\n".join(y["text"] for y in e.blocks if y["text"]), x.prefix, x.tag, x.sentence, None if x.value is None else json.dumps(x.value, ensure_ascii=False), i))
            cols = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return texts.select(F.col(key).cast("string").alias(key), F.col(text).cast("string").alias("_t")).mapInArrow(parse, f"`{key}` string, {_SCHEMA}")
