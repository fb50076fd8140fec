"""Queries of the text stages: sources, sections, sentences, annotation, windows and relevance; with the SQL they are compared with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dotledger.functions import rules
from dotledger.operators import text_stages as T
from dotledger.operators.ordered import framed, join_safe, running_sum
from dotledger.plans.session import read_table, spread

#: A sentence's place; a repeated sentence is told apart by its own id.
ORDER = ["sent_global_id", "sent_uid"]


def _sentences(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "decisions").filter("pdf_name is not null")


def doc_scan(spark, folder):
    """Documents with a numeric id from 200500 on."""
    return read_table(spark, folder, "papers").filter(F.col("doc_id").rlike("^[0-9]+$") & (F.col("doc_id").cast("bigint") >= 200500)).select("doc_id", F.coalesce("name", "doc_id").alias("title"))


def doc_scan_ids(spark, folder):
    """Documents restricted to the ids that have extraction rows."""
    return read_table(spark, folder, "papers").join(read_table(spark, folder, "letter_table").select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "pub_year")


def section_classify(spark, folder):
    b = read_table(spark, folder, "blocks")
    return b.select("block_uid", T.fold_spaced_capitals(F.col("main_header_text")).alias("header"), T.classify_section(F.col("main_header_text")).alias("section"))


def section_counts(spark, folder):
    return read_table(spark, folder, "blocks").groupBy(F.coalesce("main_section_norm", F.lit("unknown")).alias("section")).agg(F.count("*").alias("n"))


def section_quality(spark, folder):
    return T.section_quality(read_table(spark, folder, "blocks"), "doc_id", "main_section_norm", ["block_id", "block_uid"])


def tail_trim(spark, folder):
    d = read_table(spark, folder, "documents").filter("text is not null")
    return d.select("doc_id", F.length(T.trim_tail(F.col("text"))).cast("bigint").alias("kept_chars"))


def doc_lines(spark, folder):
    """Lines of each block with their positions."""
    b = read_table(spark, folder, "blocks").filter("text is not null")
    return b.select("block_uid", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def sentence_split(spark, folder):
    b = read_table(spark, folder, "blocks").filter("text is not null")
    return b.select("block_uid", F.posexplode(T.split_sentences(F.col("text"))).alias("pos", "sentence"))


def sentence_stats_by_lang(spark, folder):
    d = read_table(spark, folder, "documents").filter("text is not null")
    n = F.size(T.split_sentences(F.col("text")))
    return d.groupBy("lang").agg(F.count("*").alias("docs"), F.sum(n).cast("bigint").alias("sentences"), F.sum(T.count_words(F.col("text"))).alias("words"))


def token_counts(spark, folder):
    s = _sentences(spark, folder).filter("text is not null")
    return s.select("sent_uid", T.count_words(F.col("text")).alias("words"), F.regexp_count("text", F.lit("[A-Za-z0-9]+")).cast("bigint").alias("alnum_tokens"))


def name_signature(spark, folder):
    return read_table(spark, folder, "sample_registry").select("name_id", F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "").alias("signature"))


def keyword_flags(spark, folder):
    s = _sentences(spark, folder).filter("text is not null")
    return T.keyword_flags(s.select("sent_uid", "text"), "text").drop("text")


def annotate_windows(spark, folder):
    """Keyword hits, units and candidate properties of every sentence within one sentence on each side."""
    s = _sentences(spark, folder).select("sent_uid", "pdf_name", "block_id", "para_id_in_block", "sent_global_id", F.translate("text", "μµ", "uu").alias("text"))
    return T.annotate(spread(s), ["pdf_name"], ["block_id", "para_id_in_block"], ORDER, "text").select("sent_uid", "kw_hits", "units", "props")


def candidate_sentences(spark, folder):
    s = _sentences(spark, folder)
    return s.filter(F.col("main_section_norm").isin("abstract", "experimental", "results", "conclusion") & ~F.coalesce(F.col("cand_props"), F.lit("")).isin("", "nan", "[]")).select("sent_uid", "main_section_norm", "cand_props")


def table_neighbourhood(spark, folder):
    """Sentences within seven of a figure or table row."""
    s = T.near_rows(_sentences(spark, folder), ["pdf_name"], ORDER, F.coalesce("is_figure", F.lit(False)), 7, "sent_global_id")
    return s.filter("near").select("sent_uid")


def candidate_islands(spark, folder):
    member = ~F.coalesce(F.col("cand_props"), F.lit("")).isin("", "nan", "[]")
    s = T.islands(_sentences(spark, folder), ["pdf_name", "para_global_id"], ORDER, member)
    return s.groupBy("pdf_name", "para_global_id", "island").agg(F.min("pos").cast("bigint").alias("first_pos"), F.max("pos").cast("bigint").alias("last_pos"), F.count("*").alias("members"))


def island_seeds(spark, folder):
    """The middle member of every island."""
    member = ~F.coalesce(F.col("cand_props"), F.lit("")).isin("", "nan", "[]")
    s = T.islands(_sentences(spark, folder), ["pdf_name", "para_global_id"], ORDER, member)
    g = s.groupBy("pdf_name", "para_global_id", "island").agg(F.array_sort(F.collect_list("pos")).alias("p"))
    return g.select("pdf_name", "para_global_id", F.col("island").cast("bigint").alias("island"), F.element_at("p", F.floor(F.size("p") / 2).cast("int") + 1).cast("bigint").alias("seed_pos"))


def _beside(sentences: DataFrame) -> DataFrame:
    """Adds before and after: the texts of the sentences beside each in its document."""
    return framed(sentences, ["pdf_name"], ORDER, "sent_global_id", 1, lambda w: {"before": F.lag("text").over(w), "after": F.lead("text").over(w)})


def single_windows(spark, folder):
    """A lone candidate's small window: itself, then the sentence before and the one after in the document."""
    s = _beside(_sentences(spark, folder).select("sent_uid", "pdf_name", "sent_global_id", "window_level", "text")).filter(F.col("window_level") == "SMALL")
    return s.select("sent_uid", F.concat_ws(" ", "text", "before", "after").alias("window_text"))


def _spans(sentences: DataFrame, member: Column, gap: Column, seed: Column, least: int, left: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """The `seed` sentences with the texts around them: before and after in the document, and the span of their island within the paragraph.

    An island is a run of members of a paragraph of which none begins by `gap`, a condition on the columns pos and sent_global_id and those
    of the member before (prev_pos, prev_sid). Its span is padded to `least` sentences; left: how many of the needed ones are taken on the
    left, of those needed and those there on the left and on the right. members is 1 for a seed without an island.
    """
    place = ["pdf_name", "para_global_id"]
    w, m = (Window.partitionBy(*k).orderBy(*ORDER) for k in (place, [*place, "member"]))
    s = _beside(sentences).withColumns({"pos": F.row_number().over(w), "member": member})
    s = s.withColumns({"prev_pos": F.lag("pos").over(m), "prev_sid": F.lag("sent_global_id").over(m)})
    s = s.withColumn("island", F.sum(F.when(F.col("prev_pos").isNull() | gap, 1).otherwise(0)).over(m.rowsBetween(Window.unboundedPreceding, 0)))
    i = Window.partitionBy(*place, "member", "island")
    span = {"lo": F.min("pos"), "hi": F.max("pos"), "members": F.count("*")}
    s = s.withColumns({k: F.when(F.col("member"), x.over(i)).otherwise(F.lit(1) if k == "members" else F.col("pos")) for k, x in span.items()})
    s = s.filter(seed).select("sent_uid", *place, "text", "before", "after", "members", "lo", "hi").alias("s")
    item = F.struct(*ORDER, F.coalesce("text", F.lit("")).alias("x"))
    p = sentences.groupBy(*place).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["x"]).alias("x")).alias("p")
    s = s.join(p, (F.col("s.pdf_name") == F.col("p.pdf_name")) & F.col("s.para_global_id").eqNullSafe(F.col("p.para_global_id")))
    s = s.select("sent_uid", "text", "before", "after", "members", "lo", "hi", "x")
    need = F.greatest(F.lit(least) - (F.col("hi") - F.col("lo") + 1), F.lit(0))
    s = s.withColumns({"need": need, "l": F.least(left(need, F.col("lo") - 1, F.size("x") - F.col("hi")), F.col("lo") - 1)})
    end = F.least(F.col("hi") + F.col("need") - F.col("l"), F.size("x"))
    return s.withColumn("span", F.slice("x", F.col("lo") - F.col("l"), end - F.col("lo") + F.col("l") + 1))


def _inked(texts: Column) -> Column:
    """The texts without outer blanks, joined; blank ones are left out."""
    return F.array_join(F.filter(F.transform(texts, lambda x: F.regexp_replace(x, "(?U)^\\s+|\\s+$", "")), lambda x: x != ""), " ")


def small_windows(spark, folder):
    """The small window of every sentence that has one: its island's span with at least three sentences; for a lone candidate itself, then the
    sentences before and after it in the document."""
    member = ~F.coalesce(F.col("cand_props"), F.lit("")).isin("", "nan", "[]")
    s = _spans(_sentences(spark, folder), member, F.col("pos") - F.col("prev_pos") > 3, F.col("window_level") == "SMALL", 3, lambda need, before, after: need)
    lone = F.array(*(F.coalesce(c, F.lit("")) for c in ("text", "before", "after")))
    return s.select("sent_uid", "members", _inked(F.when(F.col("members") > 1, F.col("span")).otherwise(lone)).alias("window_text"))


def refine_windows(spark, folder):
    """The small window from which a sentence is refined: the span of its island (ids at most two apart, within the allowed sections) with at least
    five sentences, added left and right in turn; for a lone sentence the ones before and after it."""
    member = F.coalesce(F.col("main_section_norm").isin("abstract", "experimental", "results", "conclusion"), F.lit(False)) & ~F.coalesce(F.col("cand_props"), F.lit("")).isin("", "nan", "[]")
    left = lambda need, before, after: F.greatest(F.ceil(need / 2).cast("int"), need - after)
    s = _spans(_sentences(spark, folder), member, F.col("sent_global_id") - F.col("prev_sid") > 2, F.col("window_level") == "SMALL", 5, left)
    lone = F.concat_ws(" ", "before", "text", "after")
    return s.select("sent_uid", "members", F.when(F.col("members") > 1, F.array_join(F.filter("span", lambda x: x != ""), " ")).otherwise(lone).alias("window_text"))


def extended_windows(spark, folder):
    """Paragraphs of at most seven sentences with the last five of the one before and the first five of the one after."""
    item = F.struct(*ORDER, F.coalesce("text", F.lit("")).alias("x"))
    p = _sentences(spark, folder).groupBy("pdf_name", "para_global_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["x"]).alias("s"))
    p = framed(p, ["pdf_name"], ["para_global_id"], "para_global_id", 1, lambda w: {"b": F.lag("s").over(w), "a": F.lead("s").over(w)})
    last5 = F.when(F.size("b") > 5, F.slice("b", -5, 5)).otherwise(F.col("b"))
    ext = F.concat_ws(" || ", F.array_join(last5, " "), F.array_join("s", " "), F.array_join(F.slice("a", 1, 5), " "))
    return p.select("pdf_name", "para_global_id", F.size("s").cast("bigint").alias("sentences"), F.when(F.size("s") <= 7, ext).otherwise(F.array_join("s", " ")).alias("window_text"))


def paragraph_assembly(spark, folder):
    return T.ordered_text(_sentences(spark, folder), ["pdf_name", "para_global_id"], ORDER, "text", " ")


def dense_ids(spark, folder):
    s = _sentences(spark, folder).select("sent_uid", "pdf_name", "sent_global_id", "block_id", "para_id_in_block")
    place = ["pdf_name", "block_id", "para_id_in_block"]
    paragraphs = running_sum(s.select(*place).distinct(), ["pdf_name"], place[1:], "block_id", {"para_no": F.lit(1)})
    return join_safe(running_sum(s, ["pdf_name"], ORDER, "sent_global_id", {"sent_no": F.lit(1)}), paragraphs, place).select("sent_uid", "para_no", "sent_no")


def chunk_pack(spark, folder):
    """Chunks packed greedily to 150 words within a block and section."""
    c = read_table(spark, folder, "cos_tokenize").filter("pdf_name is not null").withColumn("words", T.count_words(F.coalesce("text", F.lit(""))))
    packed = T.pack_chunks(c, "pdf_name", ["block_id", "main_section_norm"], ["para_id", "chunk_uid"], "words")
    return packed.groupBy("pdf_name", "chunk").agg(F.sum("words").cast("bigint").alias("words"), F.min("para_id").cast("bigint").alias("first_para"), F.count("*").alias("parts"))


def cosine_retain(spark, folder):
    e = read_table(spark, folder, "embeddings")
    return T.template_similarity(e, "vec_id", "embedding", e.filter("vec_id < 22"))


def recall_patch(spark, folder):
    c = read_table(spark, folder, "cos_tokenize").filter("pdf_name is not null")
    c = c.withColumn("retain", F.when(F.col("para_id") % 5 == 0, "YES").otherwise("NO"))
    section = F.when(F.col("main_section_norm") == "experimental", "methods").otherwise(F.col("main_section_norm"))
    out = T.recall_patch(c, "pdf_name", ["para_id", "chunk_uid"], "retain", section, F.col("main_header_text"), F.col("text"))
    return out.select("chunk_uid", "patched", "reason", "kept")


def yes_context(spark, folder):
    """Texts of the chunks taken for syntheses, in order, per document."""
    c = read_table(spark, folder, "cos_tokenize").filter(F.col("pdf_name").isNotNull() & T.matches(T.squash(F.col("text")), rules.ANCHOR))
    return T.ordered_text(c, ["pdf_name"], ["para_id", "chunk_uid"], "text", "\n")


def document_context(spark, folder):
    """A document's distinct texts in the order of their stages: chunks, then sentences."""
    c = read_table(spark, folder, "cos_tokenize").select("pdf_name", F.lit(0).alias("stage"), F.col("para_id").alias("o"), F.col("chunk_uid").alias("u"), "text")
    s = read_table(spark, folder, "decisions").filter("main_section_norm = 'experimental'").select("pdf_name", F.lit(1).alias("stage"), F.col("sent_global_id").alias("o"), F.col("sent_uid").alias("u"), "text")
    both = c.unionByName(s).filter("pdf_name is not null and text is not null and trim(text) <> ''")
    first = both.groupBy("pdf_name", "text").agg(F.min(F.struct("stage", "o", "u")).alias("f"))
    return T.ordered_text(first, ["pdf_name"], ["f"], "text", "\n\n").select("pdf_name", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("digest"))


QUERIES = {f.__name__: f for f in (
    doc_scan, doc_scan_ids, section_classify, section_counts, section_quality, tail_trim, doc_lines, sentence_split, sentence_stats_by_lang, token_counts, name_signature, keyword_flags, annotate_windows, candidate_sentences,
    table_neighbourhood, candidate_islands, island_seeds, single_windows, small_windows, refine_windows, extended_windows, paragraph_assembly, dense_ids, chunk_pack, cosine_retain, recall_patch, yes_context, document_context,
)}


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _has(column: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({column}, '(?i){_q(pattern)}'), false)"


_FOLD = "CASE WHEN regexp_matches(trim({0}), '^([A-Za-z]\\s+){{2,}}[A-Za-z]$') THEN replace({0}, ' ', '') ELSE {0} END"
_HEADER = _FOLD.format("trim(coalesce(main_header_text, ''))")
_SECTION = "CASE " + " ".join(f"WHEN {_has('h', '|'.join(f'(?:{p})' for p in ps))} THEN '{s}'" for s, ps in rules.SECTION_PATTERNS.items()) + " ELSE 'unknown' END"
_MEMBER = "coalesce(cand_props, '') NOT IN ('', 'nan', '[]')"
_SENT = "SELECT * FROM decisions WHERE pdf_name IS NOT NULL"
# RE2's word boundaries know ASCII only.
_UNITS = {u: _has("t", re.sub(r"\\b([a-z]+)\\b", r"(?:^|[^\\pL\\pN_])\1(?:[^\\pL\\pN_]|$)", p.replace("μm|um", "um").replace("μs|us", "us"))) for u, p in rules.UNIT_MARKS.items()}
_KW = {k: _has("t", p) for k, p in rules.KEYWORDS.items()}
_ISLANDS = f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY pdf_name, para_global_id ORDER BY sent_global_id, sent_uid) AS pos FROM ({_SENT})),
 m AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 3 THEN 0 ELSE 1 END AS b FROM p WHERE {_MEMBER} WINDOW w AS (PARTITION BY pdf_name, para_global_id ORDER BY sent_global_id, sent_uid)),
 i AS (SELECT *, sum(b) OVER (PARTITION BY pdf_name, para_global_id ORDER BY sent_global_id, sent_uid ROWS UNBOUNDED PRECEDING) AS island FROM m)"""
_HEADING, _MENTION, _WORD = (_q(p) for p in (rules.TAIL_HEADING, rules.TAIL_MENTION, rules.TAIL_WORD))


def _before(t: str, pattern: str) -> str:
    return f"regexp_extract({t}, '^((?s:.*?))(?:{pattern})', 1)"


ORACLE = {
    "doc_scan": "SELECT doc_id, coalesce(name, doc_id) AS title FROM papers WHERE regexp_matches(doc_id, '^[0-9]+$') AND CAST(doc_id AS BIGINT) >= 200500",
    "doc_scan_ids": "SELECT doc_id, pub_year FROM papers WHERE doc_id IN (SELECT doc_id FROM letter_table)",
    "section_classify": f"SELECT block_uid, {_FOLD.format('main_header_text')} AS header, {_SECTION} AS section FROM (SELECT *, {_HEADER} AS h FROM blocks)",
    "section_counts": "SELECT coalesce(main_section_norm, 'unknown') AS section, count(*) AS n FROM blocks GROUP BY 1",
    "section_quality": """WITH b AS (SELECT doc_id, coalesce(main_section_norm, 'unknown') AS s, CASE WHEN count(*) OVER (PARTITION BY doc_id) > 1 THEN (row_number() OVER (PARTITION BY doc_id ORDER BY block_id, block_uid) - 1) / (count(*) OVER (PARTITION BY doc_id) - 1) ELSE 0.0 END AS q FROM blocks)
 SELECT doc_id, count(*) AS blocks, round(count(*) FILTER (s = 'unknown' AND q <= 0.1) / greatest(count(*) FILTER (q <= 0.1), 1), 6) AS unknown_head, round(count(*) FILTER (s = 'unknown' AND q > 0.1 AND q < 0.9) / greatest(count(*) FILTER (q > 0.1 AND q < 0.9), 1), 6) AS unknown_middle,
 round(count(*) FILTER (s = 'unknown' AND q >= 0.9) / greatest(count(*) FILTER (q >= 0.9), 1), 6) AS unknown_tail, """ + ", ".join(f"round(min(q) FILTER (s = '{s}'), 6) AS first_{s}" for s in ("introduction", "experimental", "results", "conclusion")) + " FROM b GROUP BY doc_id",
    "tail_trim": f"""WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
 e AS (SELECT *, CAST(floor(len(l) * 0.75) AS INT) AS k FROM d), f AS (SELECT *, CASE WHEN k > 0 THEN array_to_string(l[1:k], chr(10)) || chr(10) ELSE '' END AS prefix, array_to_string(l[k+1:], chr(10)) AS tail FROM e)
 SELECT doc_id, length(CASE WHEN regexp_matches(text, '{_HEADING}') THEN regexp_extract(text, '(?s)^(.*?)(?:{_HEADING})', 1) WHEN regexp_matches(text, '{_MENTION}') THEN {_before('text', _MENTION)} WHEN regexp_matches(tail, '{_WORD}') THEN prefix || {_before('tail', _WORD)} ELSE text END) AS kept_chars FROM f""",
    "doc_lines": "SELECT block_uid, CAST(i - 1 AS INT) AS line_no, l[i] AS line FROM (SELECT block_uid, string_split(text, chr(10)) AS l FROM blocks WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)",
    "sentence_split": "SELECT block_uid, CAST(i - 1 AS INT) AS pos, l[i] AS sentence FROM (SELECT block_uid, string_split(regexp_replace(text, '([.?!;])\\s+([A-Z\\[(])', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS l FROM blocks WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)",
    "sentence_stats_by_lang": "SELECT lang, count(*) AS docs, CAST(sum(len(string_split(regexp_replace(text, '([.?!;])\\s+([A-Z\\[(])', '\\1' || chr(1) || '\\2', 'g'), chr(1)))) AS BIGINT) AS sentences, CAST(sum(len(regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+'))) AS BIGINT) AS words FROM documents WHERE text IS NOT NULL GROUP BY lang",
    "token_counts": f"SELECT sent_uid, len(regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+')) AS words, len(regexp_extract_all(text, '[A-Za-z0-9]+')) AS alnum_tokens FROM ({_SENT}) WHERE text IS NOT NULL",
    "name_signature": "SELECT name_id, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS signature FROM sample_registry",
    "keyword_flags": f"SELECT sent_uid, {', '.join(f'{v} AS {k}' for k, v in _KW.items())} FROM (SELECT sent_uid, text AS t FROM ({_SENT}) WHERE text IS NOT NULL)",
    "annotate_windows": f"""WITH s AS (SELECT sent_uid, pdf_name, block_id, para_id_in_block, sent_global_id, coalesce(translate(text, 'μµ', 'uu'), '') AS t FROM ({_SENT})),
 f AS (SELECT *, {', '.join(f'{v} AS {k}' for k, v in _KW.items())}, {', '.join(f'{v} AS u{i}' for i, v in enumerate(_UNITS.values()))}, len(regexp_extract_all(t, '[A-Za-z0-9]+')) >= 3 AS long FROM s),
 w AS (SELECT *, bool_or(has_em) OVER v AS wem, bool_or(has_ex) OVER v AS wex, bool_or(has_qy) OVER v AS wqy, bool_or(has_lifetime) OVER v AS wlife, bool_or(exdep_pos OR exdep_neg) OVER v AS wdep, bool_or(has_chiral) OVER v AS wchi, bool_or(has_cpl_core) OVER v AS wcc, bool_or(has_cpl_lum) OVER v AS wcl, bool_or(u0 OR u1) OVER v AS wnm, bool_or(u2) OVER v AS wpc, bool_or(u3 OR u4 OR u5 OR u6) OVER v AS wtime,
 (has_em OR has_ex OR has_qy OR has_lifetime OR exdep_pos OR exdep_neg OR has_chiral OR has_cpl_core OR u0 OR u1 OR u2 OR u3 OR u4 OR u5 OR u6) AND long AS seed FROM f WINDOW v AS (PARTITION BY pdf_name, block_id, para_id_in_block ORDER BY sent_global_id, sent_uid ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
 SELECT sent_uid, concat_ws(';', CASE WHEN long AND has_cpl_core THEN 'CPL' END, CASE WHEN long AND has_chiral THEN 'Chiral' END, CASE WHEN long AND has_em THEN 'Em' END, CASE WHEN long AND has_ex THEN 'Ex' END, CASE WHEN long AND (exdep_pos OR exdep_neg) THEN 'ExDep' END, CASE WHEN long AND has_qy THEN 'QY' END, CASE WHEN long AND has_lifetime THEN 'lifetime' END) AS kw_hits,
 concat_ws(';', {', '.join(f"CASE WHEN long AND u{i} THEN '{u}' END" for i, u in enumerate(_UNITS))}) AS units,
 concat_ws(';', CASE WHEN seed AND wcc AND wcl THEN 'CPL' END, CASE WHEN seed AND wchi THEN 'Chiral' END, CASE WHEN seed AND wem AND wnm THEN 'Em' END, CASE WHEN seed AND wex AND wnm THEN 'Ex' END, CASE WHEN seed AND wdep THEN 'ExDep' END, CASE WHEN seed AND wqy AND wpc THEN 'QY' END, CASE WHEN seed AND wlife AND wtime THEN 'lifetime' END) AS props FROM w""",
    "candidate_sentences": f"SELECT sent_uid, main_section_norm, cand_props FROM ({_SENT}) WHERE main_section_norm IN ('abstract', 'experimental', 'results', 'conclusion') AND {_MEMBER}",
    "table_neighbourhood": f"SELECT sent_uid FROM (SELECT sent_uid, bool_or(coalesce(is_figure, false)) OVER (PARTITION BY pdf_name ORDER BY sent_global_id, sent_uid ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS near FROM ({_SENT})) WHERE near",
    "candidate_islands": _ISLANDS + " SELECT pdf_name, para_global_id, CAST(island AS BIGINT) AS island, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS members FROM i GROUP BY 1, 2, 3",
    "island_seeds": _ISLANDS + " SELECT pdf_name, para_global_id, CAST(island AS BIGINT) AS island, list_sort(list(pos))[CAST(floor(count(*) / 2) AS INT) + 1] AS seed_pos FROM i GROUP BY 1, 2, 3",
    "single_windows": f"SELECT sent_uid, concat_ws(' ', text, before, after) AS window_text FROM (SELECT *, lag(text) OVER w AS before, lead(text) OVER w AS after FROM ({_SENT}) WINDOW w AS (PARTITION BY pdf_name ORDER BY sent_global_id, sent_uid)) WHERE window_level = 'SMALL'",
    "extended_windows": f"""WITH p AS (SELECT pdf_name, para_global_id, list(coalesce(text, '') ORDER BY sent_global_id, sent_uid) AS s FROM ({_SENT}) GROUP BY 1, 2), q AS (SELECT *, lag(s) OVER w AS b, lead(s) OVER w AS a FROM p WINDOW w AS (PARTITION BY pdf_name ORDER BY para_global_id))
 SELECT pdf_name, para_global_id, len(s) AS sentences, CASE WHEN len(s) <= 7 THEN concat_ws(' || ', array_to_string(b[-5:], ' '), array_to_string(s, ' '), array_to_string(a[1:5], ' ')) ELSE array_to_string(s, ' ') END AS window_text FROM q""",
    "paragraph_assembly": f"SELECT pdf_name, para_global_id, string_agg(text, ' ' ORDER BY sent_global_id, sent_uid) AS text FROM ({_SENT}) WHERE text IS NOT NULL AND trim(text) <> '' GROUP BY 1, 2",
    "dense_ids": f"SELECT sent_uid, dense_rank() OVER (PARTITION BY pdf_name ORDER BY block_id, para_id_in_block) AS para_no, row_number() OVER (PARTITION BY pdf_name ORDER BY sent_global_id, sent_uid) AS sent_no FROM ({_SENT})",
    "chunk_pack": """WITH RECURSIVE c AS (SELECT pdf_name, para_id, concat_ws(chr(1), coalesce(CAST(block_id AS VARCHAR), ''), coalesce(main_section_norm, '')) AS k, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0b\\f\\r]+')) AS BIGINT) AS n, row_number() OVER (PARTITION BY pdf_name ORDER BY para_id, chunk_uid) AS r FROM cos_tokenize WHERE pdf_name IS NOT NULL),
 f AS (SELECT pdf_name, para_id, k, n, r, CAST(1 AS BIGINT) AS chunk, n AS s FROM c WHERE r = 1 UNION ALL SELECT c.pdf_name, c.para_id, c.k, c.n, c.r, CASE WHEN f.k = c.k AND f.s + c.n <= 150 THEN f.chunk ELSE f.chunk + 1 END, CASE WHEN f.k = c.k AND f.s + c.n <= 150 THEN f.s + c.n ELSE c.n END FROM f JOIN c ON c.pdf_name = f.pdf_name AND c.r = f.r + 1)
 SELECT pdf_name, chunk, CAST(sum(n) AS BIGINT) AS words, CAST(min(para_id) AS BIGINT) AS first_para, count(*) AS parts FROM f GROUP BY 1, 2""",
    "cosine_retain": """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), s AS (SELECT e.vec_id, list_cosine_similarity(e.v, t.v) AS c FROM e, (SELECT v FROM e WHERE vec_id < 22) t)
 SELECT vec_id, round(max(c), 6) AS max_similarity, round(avg(c), 6) AS mean_similarity, CASE WHEN max(c) > 0.5 OR avg(c) > 0.2 THEN 'YES' ELSE 'NO' END AS retain FROM s GROUP BY 1""",
    "recall_patch": f"""WITH c AS (SELECT chunk_uid, pdf_name, para_id, para_id % 5 = 0 AS kept0, coalesce(main_section_norm, '') = 'experimental' OR lower(trim(coalesce(main_section_norm, ''))) = 'methods' OR {_has("coalesce(main_header_text, '')", rules.METHODS_HEADER)} AS m, trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) AS x FROM cos_tokenize WHERE pdf_name IS NOT NULL),
 z AS (SELECT *, m OR coalesce(lag(m) OVER w, false) OR coalesce(lead(m) OVER w, false) AS zone, {_has('x', rules.ANCHOR)} AS a, {_has('x', rules.METHOD_CONTEXT)} OR {_has('x', rules.CONDITION_UNIT)} AS c FROM c WINDOW w AS (PARTITION BY pdf_name ORDER BY para_id, chunk_uid)),
 r AS (SELECT chunk_uid, kept0, CASE WHEN kept0 THEN '' WHEN zone AND a THEN 'anchor_in_methods_zone' WHEN a AND c THEN 'keyword+context' ELSE '' END AS reason FROM z)
 SELECT chunk_uid, CASE WHEN reason <> '' THEN 'YES' ELSE 'NO' END AS patched, reason, CASE WHEN kept0 OR reason <> '' THEN 'YES' ELSE 'NO' END AS kept FROM r""",
    "yes_context": f"SELECT pdf_name, string_agg(text, chr(10) ORDER BY para_id, chunk_uid) AS text FROM cos_tokenize WHERE pdf_name IS NOT NULL AND {_has('text', rules.ANCHOR)} AND trim(text) <> '' GROUP BY 1",
    "document_context": """WITH b AS (SELECT pdf_name, 0 AS stage, para_id AS o, chunk_uid AS u, text FROM cos_tokenize UNION ALL SELECT pdf_name, 1, sent_global_id, sent_uid, text FROM decisions WHERE main_section_norm = 'experimental'),
 f AS (SELECT pdf_name, text, min((stage, o, u)) AS f FROM b WHERE pdf_name IS NOT NULL AND text IS NOT NULL AND trim(text) <> '' GROUP BY 1, 2) SELECT pdf_name, length(string_agg(text, chr(10) || chr(10) ORDER BY f)) AS chars, md5(string_agg(text, chr(10) || chr(10) ORDER BY f)) AS digest FROM f GROUP BY 1""",
}
