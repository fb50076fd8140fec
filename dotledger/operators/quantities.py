"""Quantities recorded in different units: every one as a number in its dimension's common unit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dotledger.functions.text import fold_lookalikes
from dotledger.functions.units import parse_quantities, stated_unit
from dotledger.functions.unpack import split_cells
from dotledger.plans.session import ship_package, spread

#: Parts that each hot paper's rows are spread over when they meet the paper's statements.
SALTS = 16
#: Distinct cells that a Python worker remembers; beyond it, parsing starts afresh, with the same results.
MEMO = 20_000

_TOPIC_WORDS = r"(?i)\b(?:temperatures|times|durations|amounts|quantities|volumes)\b"


def parse_cells(df: DataFrame, key: str, paper: str, fields: list[str], packed: list[str]) -> DataFrame:
    """Rows (row_uid, doc_id, field, pos, dim, common, number), one per quantity or bare number; dim is null for a bare number.

    pos counts the quantities of a cell; in the fields of `packed` it is the position of the packed value that holds it.
    """
    ship_package(df.sparkSession)

    def plain(cell: str) -> list[tuple]:
        return [(k, *q) for k, q in enumerate(parse_quantities(cell))]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: list[dict] = [{} for _ in fields]
        for batch in batches:
            keys, papers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[list] = [[] for _ in range(7)]
            for k, field in enumerate(fields):
                known = memo[k]
                cells = batch.column(k + 2).dictionary_encode()
                values = cells.dictionary.to_pylist()
                fresh = [v for v in values if v and v not in known]
                if len(known) + len(fresh) > MEMO:
                    known.clear()
                    fresh = [v for v in values if v]
                if field in packed:
                    for v, items in zip(fresh, split_cells(pa.array(fresh, pa.string())).to_pylist()):
                        known[v] = [(p, *q) for p, item in enumerate(items) for q in dict.fromkeys((x.dim, x.common, x.number if x.dim is None else None) for x in parse_quantities(item))]
                else:
                    for v in fresh:
                        known[v] = plain(v)
                for i, code in enumerate(cells.indices.to_pylist()):
                    if code is None or not values[code]:
                        continue
                    for pos, dim, common, number in known[values[code]]:
                        for column, x in zip(out, (keys[i], papers[i], field, pos, dim, common, number)):
                            column.append(x)
            if out[0]:
                types = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["row_uid", "doc_id", "field", "pos", "dim", "common", "number"])

    columns = [F.col(key).cast("bigint").alias("k"), F.col(paper).cast("string").alias("p"), *(F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields))]
    schema = "row_uid bigint, doc_id string, field string, pos int, dim string, common double, number double"
    return spread(df.select(*columns)).mapInArrow(parse, schema)


def unit_statements(sentences: DataFrame, paper: str, text: str) -> DataFrame:
    """Rows (doc_id, field, dim, scale, shift), one per paper and column whose unit a sentence of the paper states.

    Where sentences of a paper disagree, the unit stated by most of them holds, then the one with the larger scale.
    """
    ship_package(sentences.sparkSession)

    def state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(p, *s) for p, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (s := stated_unit(t))]
            if found:
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "field", "dim", "scale", "shift"])

    folded = sentences.select(F.col(paper).cast("string").alias("p"), fold_lookalikes(F.col(text)).alias("t")).filter(F.col("p").isNotNull() & F.col("t").rlike(_TOPIC_WORDS))
    stated = folded.mapInArrow(state, "doc_id string, field string, dim string, scale double, shift double")
    counted = stated.groupBy("doc_id", "field", "dim", "scale", "shift").agg(F.count("*").alias("n"))
    return counted.groupBy("doc_id", "field").agg(F.max_by(F.struct("dim", "scale", "shift"), F.struct("n", "scale", "shift", "dim")).alias("u")).select("doc_id", "field", "u.*")


def common_quantities(df: DataFrame, key: str, paper: str, fields: list[str], packed: list[str], sentences: DataFrame, sentence_paper: str, text: str) -> DataFrame:
    """Rows (row_uid, field, pos, dim, common_value bigint): all quantities of `fields` in common units.

    Common units are hundredths of a degree Celsius, seconds, micrograms, nanomoles and microlitres. A bare number takes the
    unit that the same paper's sentences state for its column; without such a statement it gives no row. Null, empty and vague
    cells give none; a repeated row (its own key) gives its quantities again. Hot papers are salted.
    """
    parsed = parse_cells(df, key, paper, fields, packed)
    whole = parsed.filter(F.col("dim").isNotNull()).select("row_uid", "field", "pos", "dim", "common")
    salt = F.pmod(F.xxhash64("row_uid"), F.lit(SALTS)).cast("int")
    bare = parsed.filter(F.col("dim").isNull() & F.col("doc_id").isNotNull()).select("row_uid", "doc_id", "field", "pos", "number", salt.alias("salt"))
    stated = unit_statements(sentences, sentence_paper, text).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    read = bare.join(stated, ["doc_id", "field", "salt"]).select("row_uid", "field", "pos", "dim", ((F.col("number") - F.col("shift")) * F.col("scale")).alias("common"))
    return whole.unionAll(read).select("row_uid", "field", "pos", "dim", F.round("common").cast("bigint").alias("common_value"))
