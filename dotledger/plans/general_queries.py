"""The general data-quality queries (pN_...) of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dotledger.operators.packed import unpack_fields
from dotledger.operators.quantities import common_quantities
from dotledger.plans.session import read_table


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every quantity of the four quantity columns in its common unit."""
    letters, sentences = read_table(spark, folder, "letter_table"), read_table(spark, folder, "decisions")
    fields = ["Temperature", "Time", "Precursor_Amount", "Solvent_Volume"]
    return common_quantities(letters, "row_uid", "doc_id", fields, ["Precursor_Amount"], sentences, "pdf_name", "text")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of every cell that packs two or more, with its position."""
    letters = unpack_fields(read_table(spark, folder, "letter_table"), "row_uid", ["Precursor", "Precursor_Amount"], "letter_table")
    sentences = unpack_fields(read_table(spark, folder, "decisions"), "sent_uid", ["LLM_props", "merge_LLM_name"], "decisions")
    return letters.unionAll(sentences)


QUERIES = {"p4_found": p4_found, "p6_found": p6_found}
