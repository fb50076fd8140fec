"""Writers: Parquet is the truth, text formats are views of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dotledger.functions.rules import TABLE_COLUMNS


def write_table(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    """Overwrites the partitions that `df` has (all of the table without partitions); a failed job leaves the old files."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*partition) if partition else w).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quotes doubled, nulls as N/A."""
    df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("N/A")).alias(c) for c in df.columns)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def sentence_view(section: Column, sid: Column, text: Column) -> Column:
    """``[section] (sid) text``"""
    return F.format_string("[%s] (%s) %s", F.coalesce(section, F.lit("unknown")), sid.cast("string"), F.coalesce(text, F.lit("")))


def chunk_view(para: Column, tokens: Column, text: Column, similarity: Column | None = None) -> Column:
    """A chunk with its head, the similarity to four decimals where there is one."""
    head = F.format_string("[Para %s, Tokens: %s]", para.cast("string"), tokens.cast("string"))
    return F.concat_ws("\n", F.concat_ws(" ", head, F.format_string("sim=%.4f", similarity)) if similarity is not None else head, text)


def table_view(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows (keys, md): the extraction rows as a pipe table with the fixed header."""
    cell = lambda c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("N/A")), "\\s*\\n\\s*", " ")
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, TABLE_COLUMNS)), F.lit(" |"))
    head = f"| {' | '.join(TABLE_COLUMNS)} |\n|{'---|' * len(TABLE_COLUMNS)}\n"
    lines = F.transform(F.array_sort(F.collect_list(F.struct(*order, row.alias("_l")))), lambda x: x["_l"])
    return df.groupBy(*keys).agg(F.concat(F.lit(head), F.array_join(lines, "\n")).alias("md"))


def clean_log(line: Column, replacements: dict[str, str] | None = None) -> Column:
    """A log line without terminal colours and with paths replaced by placeholders."""
    out = F.regexp_replace(F.regexp_replace(line, "\u001b\\[[0-9;]*[A-Za-z]", ""), "\r\n?", "\n")
    for old, new in (replacements or {}).items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out
