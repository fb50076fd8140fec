"""The queries of the large-corpus problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dotledger.llm.abuse import abuse_rates, abuse_scores
from dotledger.llm.bpe import encode_corpus
from dotledger.llm.lookalikes import consistent_text
from dotledger.llm.mixing import mix_sources
from dotledger.llm.names import map_names, unmatched_values
from dotledger.llm.oversized import split_oversized
from dotledger.llm.scans import repaired_text, scan_damage
from dotledger.llm.sentences import sentence_ends
from dotledger.plans.session import read_table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks over the limit of 150 tokens: those that the splitter cuts."""
    return split_oversized(read_table(spark, folder, "cos_tokenize"), "chunk_uid", "text").filter("piece_no = 0").select("chunk_uid")


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every chunk over the limit."""
    return split_oversized(read_table(spark, folder, "cos_tokenize"), "chunk_uid", "text")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct damages of scanned documents."""
    return scan_damage(read_table(spark, folder, "documents"))


def p2_text(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, scanned ones as continuous paragraphs."""
    return repaired_text(read_table(spark, folder, "documents"))


def _mapped(spark: SparkSession, folder: str) -> DataFrame:
    columns = {"letter_table": ("row_uid", "CDs_Naming_in_Paper"), "decisions": ("sent_uid", "LLM_name")}
    return map_names([(t, read_table(spark, folder, t), *c) for t, c in columns.items()], read_table(spark, folder, "sample_registry"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The registry entry that each typed sample name means, or -1."""
    return _mapped(spark, folder).select("src", "row_id", "name_id")


def p3_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Typed names that mean no entry, with their frequency."""
    return unmatched_values(_mapped(spark, folder))


def _looked_at(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame, str, str]]:
    columns = {"letter_table": ("row_uid", "CDs_Naming_in_Paper"), "decisions": ("sent_uid", "text"), "documents": ("doc_id", "text")}
    return [(t, read_table(spark, folder, t), *c) for t, c in columns.items()]


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose text holds look-alike characters that the consistent form replaces."""
    return consistent_text(_looked_at(spark, folder), changed_only=True).select("src", "row_id")


def p5_text(spark: SparkSession, folder: str) -> DataFrame:
    """All names and texts in their consistent form."""
    return consistent_text(_looked_at(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """The end of every sentence of blocks and documents."""
    columns = {"blocks": "block_uid", "documents": "doc_id"}
    texts = [(t, read_table(spark, folder, t), c, "text") for t, c in columns.items()]
    return sentence_ends(texts, read_table(spark, folder, "decisions"), ["pdf_name", "para_global_id"], "sent_global_id", "text")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The token ids of every document."""
    return encode_corpus(read_table(spark, folder, "documents"), "doc_id", "text")


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The largest mixture that has the target shares: the documents and how often each is used."""
    return mix_sources(read_table(spark, folder, "documents"), read_table(spark, folder, "mix_targets"))[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of each source in that mixture."""
    return mix_sources(read_table(spark, folder, "documents"), read_table(spark, folder, "mix_targets"))[1]


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with an abusive, hateful or sexual passage."""
    return abuse_scores(read_table(spark, folder, "documents"), read_table(spark, folder, "content_labels")).filter("abusive").select("doc_id")


def p10_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's score."""
    return abuse_scores(read_table(spark, folder, "documents"), read_table(spark, folder, "content_labels"))


def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    """The rate of such documents per source."""
    return abuse_rates(abuse_scores(read_table(spark, folder, "documents"), read_table(spark, folder, "content_labels"), ["source"]))


QUERIES = {"p1_found": p1_found, "p1_pieces": p1_pieces, "p2_found": p2_found, "p2_text": p2_text, "p3_found": p3_found, "p3_unmatched": p3_unmatched, "p5_found": p5_found, "p5_text": p5_text, "p7_found": p7_found, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates}
