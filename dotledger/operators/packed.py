"""Several values packed in one cell: one row per value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dotledger.functions.unpack import flatten_lists, split_cells
from dotledger.plans.session import ship_package

#: How a field deviates from the general rules of ``split_cells``.
FIELD_OPTIONS = {"LLM_props": {"tight_slash": True, "blank": True}}


def unpack_fields(df: DataFrame, key: str, fields: list[str], src: str, least: int = 2, options: dict[str, dict] | None = None) -> DataFrame:
    """Rows (src string, row_id bigint, field string, pos int, item string), one per value of each cell with `least` or more values.

    The cells are split as ``dotledger.functions.unpack.split_cells`` tells. Null, empty and blank cells give no row; repeated
    values and written-out nulls are kept; a row repeated in `df` gives its values again. An empty table gives an empty result
    and other columns of `df`, whatever their names, are not read. No shuffle: each Arrow batch is split where it is scanned.
    """
    ship_package(df.sparkSession)
    options = FIELD_OPTIONS if options is None else options

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for k, field in enumerate(fields):
                parent, pos, items = flatten_lists(split_cells(batch.column(k + 1), **options.get(field, {})), least)
                if len(pos):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(pos), src)), keys.take(pa.array(parent)).cast(pa.int64()), pa.array(np.full(len(pos), field)), pa.array(pos), items.cast(pa.string())],
                        ["src", "row_id", "field", "pos", "item"],
                    )

    columns = [F.col(key).cast("bigint").alias("k"), *(F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields))]
    filled = F.coalesce(*(F.nullif(F.col(f).cast("string"), F.lit("")) for f in fields)).isNotNull()
    return df.filter(filled).select(*columns).mapInArrow(split, "src string, row_id bigint, field string, pos int, item string")


def with_items(df: DataFrame, key: str, field: str, name: str) -> DataFrame:
    """Every row of `df` once for each value of its cell `field`, as column `name`; rows without a value are left out.

    A row repeated in `df` gives each of its values as often as it is repeated. The key identifies a row's content.
    """
    items = unpack_fields(df, key, [field], "", least=1).select(F.col("row_id").alias(key), "pos", F.col("item").alias(name)).distinct()
    return df.join(items.drop("pos"), key)
