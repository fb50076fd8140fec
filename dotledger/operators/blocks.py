"""From the Markdown of documents to blocks and numbered sentences.

Blocks are made of lines in windows; sentences of a block are independent of other blocks, so blocks are split where they lie and only
their numbers are summed up over the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dotledger.functions import boundaries as B, segments as G
from dotledger.operators.ordered import join_safe, running_sum
from dotledger.operators.text_stages import classify_section, split_sentences
from dotledger.plans.session import ship_package

_NUMBERED = r"^\s*(\d+)(?:\.\d+)*\.?(?:\s|$)"
_SUBSECTION = r"^\s*\d+\.\d+\.?(?:\s|$)"
_BREAKS = "\r\n|[\n\r\u000b\f\u001c-\u001e\u0085  ]"


def heading_sections(headings: DataFrame, document: str, order: list[str], title: str) -> DataFrame:
    """`headings` (of level one) with section: what the title tells; a numbered sub-section (``2.1 ...``) under the current number keeps the
    section of the heading before it."""
    w = Window.partitionBy(document).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    t = F.col(title)
    out = headings.withColumns({"_root": F.regexp_extract(t, _NUMBERED, 1), "_sub": t.rlike(_SUBSECTION)})
    out = out.withColumn("_top", F.last(F.when(~F.col("_sub") & (F.col("_root") != ""), F.col("_root")), True).over(before))
    out = out.withColumn("_keeps", F.coalesce(F.col("_sub") & (F.col("_root") == F.col("_top")), F.lit(False)))
    own = F.when(~F.col("_keeps"), classify_section(t))
    return out.withColumn("section", F.last(own, True).over(w)).drop("_root", "_sub", "_top", "_keeps")


def markdown_blocks(documents: DataFrame, document: str, text: str, drop_front: bool = False) -> DataFrame:
    """Rows (document, block_id, main_section_norm, main_header_text, text, header_line, start_line, end_line), lines and blocks counted from 0.

    A heading of level one opens a block; deeper ones become lines of their own, with blank lines around. Blocks without text are left out.
    drop_front: blocks before the first heading are dropped, unless there is none. Null and empty texts have no block.
    """
    lines = documents.select(document, F.posexplode(F.split(F.regexp_replace(text, f"(?:{_BREAKS})\\z", ""), _BREAKS)).alias("line_no", "line")).filter((F.col("line") != "") | (F.col("line_no") > 0))
    lines = lines.withColumns({"level": F.length(F.regexp_extract("line", B.HEADER, 1)), "title": F.regexp_extract("line", B.HEADER, 2)})
    lines = running_sum(lines, [document], ["line_no"], "line_no", {"no": F.when(F.col("level") == 1, 1).otherwise(0)})
    heads = heading_sections(lines.filter("level = 1").select(document, "no", "line_no", "title"), document, ["no"], "title").select(document, "no", F.col("title").alias("main_header_text"), "section", F.col("line_no").alias("header_line"))
    shown = F.when(F.col("level") > 0, F.concat(F.lit("\n"), "title", F.lit("\n"))).otherwise(F.col("line"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", shown.alias("x")))), lambda x: x["x"]), "\n")
    blocks = lines.groupBy(document, "no").agg(F.regexp_replace(body, "^\\s+|\\s+$", "").alias("text"), F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line")).filter("text <> ''")
    blocks = join_safe(blocks, heads, [document, "no"], "left").withColumns({"main_section_norm": F.coalesce("section", F.lit("unknown")), "main_header_text": F.coalesce("main_header_text", F.lit(""))})
    if drop_front:
        first = blocks.filter("trim(main_header_text) <> ''").groupBy(document).agg(F.min("no").alias("first"))
        blocks = join_safe(blocks, first, [document], "left").filter("first is null or no >= first").drop("first")
    blocks = running_sum(blocks, [document], ["no"], "no", {"block_id": F.lit(1)})
    return blocks.select(document, (F.col("block_id") - 1).cast("int").alias("block_id"), "main_section_norm", "main_header_text", "text", "header_line", "start_line", "end_line")


def _mapped(df: DataFrame, keys: list[str], text: str, title: str | None, split) -> DataFrame:
    """Rows (keys, pos, base, figure, piece): `split` gives the pieces of a text and a title."""
    ship_package(df.sparkSession)
    n = len(keys)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, k, p.base, p.figure, p.text) for i, (t, h) in enumerate(zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist())) for k, p in enumerate(split(t, h or ""))]
            cols = list(zip(*rows)) or [()] * 5
            own = [c.take(pa.array(cols[0], pa.int32())) for c in batch.columns[:n]]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(cols[1:], (pa.int32(), pa.int32(), pa.bool_(), pa.string())))], [*keys, "pos", "base", "figure", "piece"])

    types = dict(df.dtypes)
    rows = df.filter(F.col(text).isNotNull()).select(*keys, F.col(text).alias("_t"), (F.col(title) if title else F.lit("")).alias("_h"))
    return rows.mapInArrow(pieces, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "pos int, base int, figure boolean, piece string"]))


def _gathered(sentences: DataFrame, keys: list[str], cuts: Column) -> DataFrame:
    """Pieces that aren't figures cut by `cuts`, in order: rows (keys, pos, sub, base, figure, piece)."""
    each = F.when(F.col("figure"), F.array("piece")).otherwise(cuts)
    return sentences.select(*keys, "pos", "base", "figure", F.posexplode(each).alias("sub", "piece"))


def paragraph_sentences(blocks: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Rows (keys, para_id_in_block, sent_id_in_para, is_figure, text), the paragraphs of each block from 1 and their sentences from 1.

    Abbreviations are protected, sentences split and cut again where a mark stands right before a capital, short pieces joined to the piece before.
    """
    paragraphs = _mapped(blocks, keys, text, None, lambda t, _: G.figure_paragraphs(t))
    rough = F.filter(F.transform(split_sentences(B.protect_abbreviations(F.col("piece"))), lambda x: F.regexp_replace(x, "^\\s+|\\s+$", "")), lambda x: x != "")
    cuts = F.transform(F.flatten(F.transform(rough, B.cut_after_marks)), B.restore_abbreviations)
    cut = paragraphs.withColumn("cuts", F.when(F.col("figure"), F.array("piece")).otherwise(cuts))
    n = len(keys)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            rows = [(i, p + 1, k + 1, f, s) for i, (p, f, c) in enumerate(zip(x["pos"], x["figure"], x["cuts"])) for k, s in enumerate(c if f else G.merge_short_pieces(c))]
            cols = list(zip(*rows)) or [()] * 5
            own = [c.take(pa.array(cols[0], pa.int32())) for c in batch.columns[:n]]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(cols[1:], (pa.int32(), pa.int32(), pa.bool_(), pa.string())))], [*keys, "para_id_in_block", "sent_id_in_para", "is_figure", "text"])

    types = dict(blocks.dtypes)
    return cut.select(*keys, "pos", "figure", "cuts").mapInArrow(merge, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "para_id_in_block int, sent_id_in_para int, is_figure boolean, text string"]))


def segment_sentences(blocks: DataFrame, keys: list[str], text: str, title: str, most: int = 8) -> DataFrame:
    """The same by segments, for property texts: tables and images are figures; citations and figure references are protected; heads, tails and
    orphans are joined, across figures too; a paragraph has at most `most` sentences and a figure is one of its own."""
    segments = _mapped(blocks, keys, text, None, lambda t, _: G.figure_segments(t))
    line = F.regexp_replace("piece", "\\s*\\n\\s*", " ")
    # The plain sentence rule would part what `cut_at_blanks` keeps together, so that alone cuts.
    cuts = F.transform(B.cut_at_blanks(B.protect_references(line)), B.restore_references)
    item = F.struct("pos", "sub", "base", "figure", "piece")
    grouped = _gathered(segments, keys, cuts).groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("pieces"))
    grouped = join_safe(grouped, blocks.select(*keys, F.col(title).alias("_h")), keys)
    n = len(keys)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, (pieces, h) in enumerate(zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist())):
                ps = [G.Piece(p["piece"], p["figure"], p["base"]) for p in pieces]
                ps = G.merge_orphans(G.merge_tails_around_figures(G.merge_heads_across_figures(G.merge_short_heads(ps, title=h or ""))), title=h or "")
                para, sent, base = 0, 0, None
                for p in ps:
                    if p.figure or base is None or p.base != base or sent >= most:
                        para, sent = para + 1, 0
                    sent, base = sent + 1, None if p.figure else p.base
                    rows.append((i, para, sent, p.figure, p.text.strip()))
            cols = list(zip(*rows)) or [()] * 5
            own = [c.take(pa.array(cols[0], pa.int32())) for c in batch.columns[:n]]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(cols[1:], (pa.int32(), pa.int32(), pa.bool_(), pa.string())))], [*keys, "para_id_in_block", "sent_id_in_para", "is_figure", "text"])

    types = dict(blocks.dtypes)
    return grouped.select(*keys, "pieces", "_h").mapInArrow(merge, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "para_id_in_block int, sent_id_in_para int, is_figure boolean, text string"]))


def number_sentences(sentences: DataFrame, document: str, block: str = "block_id") -> DataFrame:
    """Adds para_global_id and sent_global_id, counted from 1 over each document."""
    order = [block, "para_id_in_block", "sent_id_in_para"]
    steps = {"para_global_id": F.when(F.col("sent_id_in_para") == 1, 1).otherwise(0), "sent_global_id": F.lit(1)}
    return running_sum(sentences, [document], order, block, steps)


def document_sentences(documents: DataFrame, document: str, text: str, by_segments: bool = False) -> DataFrame:
    """The whole chain: from a document's Markdown to its numbered sentences with the section and heading of their block.

    by_segments: the chain for property texts, without what stands before the first heading.
    """
    blocks = markdown_blocks(documents, document, text, drop_front=by_segments)
    keys = [document, "block_id"]
    sentences = segment_sentences(blocks, keys, "text", "main_header_text") if by_segments else paragraph_sentences(blocks, keys, "text")
    numbered = number_sentences(sentences, document)
    return join_safe(numbered, blocks.select(*keys, "main_section_norm", "main_header_text"), keys)
