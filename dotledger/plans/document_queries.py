"""Queries of the chain from Markdown to sentences and of its rules; with the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import functions as F

from dotledger.functions import boundaries as B
from dotledger.operators import blocks
from dotledger.plans.evidence_queries import _FOLD, _SECTION
from dotledger.plans.session import read_table
from dotledger.sources import documents


def _texts(spark, folder):
    return read_table(spark, folder, "decisions").filter("text is not null").select("sent_uid", "text")


def boundary_tests(spark, folder):
    """Which sentences end strongly, look like captions, are brackets only, are short tails, or begin with a citation."""
    t = F.col("text")
    return _texts(spark, folder).select("sent_uid", B.strong_terminal(t).alias("strong"), B.caption(t).alias("caption"), B.bracket_only(t).alias("bracket"), B.short_tail(t).alias("short"), B.citation_start(t).alias("cited"))


def abbreviations_protected(spark, folder):
    guarded = B.protect_abbreviations(F.col("text"))
    return _texts(spark, folder).select("sent_uid", F.translate(guarded, B.MARK, "§").alias("guarded"), B.restore_abbreviations(guarded).alias("restored"))


def references_protected(spark, folder):
    guarded = B.protect_references(F.col("text"))
    return _texts(spark, folder).select("sent_uid", guarded.alias("guarded"), B.restore_references(guarded).alias("restored"))


def mark_cuts(spark, folder):
    """Pieces of sentences where a mark stands before a capital or bracket."""
    return _texts(spark, folder).select("sent_uid", F.posexplode(B.cut_after_marks(F.col("text"))).alias("pos", "piece"))


def blank_cuts(spark, folder):
    """Pieces of protected blocks at white space after a mark."""
    b = read_table(spark, folder, "blocks").filter("text is not null")
    return b.select("block_uid", F.posexplode(B.cut_at_blanks(B.protect_references(F.col("text")))).alias("pos", "piece"))


def name_forms(spark, folder):
    """Sample names without wrapping, precursors as tokens and as long forms, with straight quotes."""
    r = read_table(spark, folder, "letter_table")
    return r.select("row_uid", B.bare_name(F.col("CDs_Naming_in_Paper")).alias("name"), B.token_key(F.col("Precursor")).alias("token"), B.full_name(F.col("Purification")).alias("long"), B.straight_quotes(F.col("Precursor")).alias("quotes"))


def _markdown(spark, folder):
    """The papers' blocks as one Markdown text each; a paper has few blocks."""
    b = read_table(spark, folder, "blocks").filter("doc_id is not null")
    part = F.concat(F.lit("# "), F.coalesce("main_header_text", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    item = F.struct("block_id", "block_uid", part.alias("x"))
    return b.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["x"]), "").alias("md"))


def markdown_blocks(spark, folder):
    return blocks.markdown_blocks(_markdown(spark, folder), "doc_id", "md")


def paragraph_chain(spark, folder):
    """Numbered sentences of every paper from its Markdown, by paragraphs."""
    return blocks.document_sentences(_markdown(spark, folder), "doc_id", "md")


def segment_chain(spark, folder):
    """The same by segments, as property texts are read."""
    return blocks.document_sentences(_markdown(spark, folder), "doc_id", "md", by_segments=True)


def abbreviation_pairs(spark, folder):
    """Short forms with the long forms that documents give them, and in how many documents."""
    found = documents.abbreviation_scan(read_table(spark, folder, "documents"), "doc_id", "text")
    return found.groupBy("short", "long").agg(F.count_distinct("doc_id").alias("documents"), F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (abbreviation_pairs, boundary_tests, abbreviations_protected, references_protected, mark_cuts, blank_cuts, name_forms, markdown_blocks, paragraph_chain, segment_chain)}


def _q(x: str) -> str:
    return x.replace("'", "''")


def _replaced(c: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        c = f"regexp_replace({c}, '{_q(a)}', '{_q(b)}', 'g')"
    return c


_T = "SELECT sent_uid, text FROM decisions WHERE text IS NOT NULL"
_BACK = lambda x: x.replace("$1", "\\1").replace("$2", "\\2").replace("$3", "\\3")
_GUARD = [(p, _BACK(r).replace(B.MARK, "§")) for p, r, _, _ in B.ABBREVIATIONS]
_UNGUARD = [(p.replace(B.MARK, "§"), _BACK(r)) for _, _, p, r in B.ABBREVIATIONS]
_REFS = [(B.CITATION, "CITEREF§\\1§"), (B.FIGURE_REFERENCE, "FIGREF§\\1§\\2"), (B.FIGURE_REFERENCE, "FIGREF§\\1§\\2")]
_UNREFS = [("FIGREF§(.*?)§", "Fig. \\1"), ("CITEREF§(.*?)§", "[\\1]")]
_WS = "[ \\t\\n\\x0b\\f\\r]"


def _posed(key: str, pieces: str, source: str) -> str:
    trimmed = f"list_filter(list_transform(string_split({pieces}, chr(1)), lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '')"
    return f"SELECT {key}, CAST(i - 1 AS INT) AS pos, l[i] AS piece FROM (SELECT {key}, {trimmed} AS l FROM ({source})), LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)"


_CUT1 = [(r"([.?!;][)\]}\"']*)[ \t\n\x0b\f\r]*([\p{Lu}\[(])", "\\1\x01\\2")]
_CUT2 = [(r"([.!?;][)\]}»\"’']*)([ \t\n\x0b\f\r]+)([A-Z\[])", "\\1\x01\\2\\3"), ("(FIGREF§[^\x01]*)\x01([ \\t\\n\\x0b\\f\\r]+S)", "\\1\\2"), ("(FIGREF§[^\x01]*)\x01([ \\t\\n\\x0b\\f\\r]+S)", "\\1\\2")]
_SQUASH = [("[\\s\\p{Z}]+", " "), ("^ | $", "")]
_TOKEN = lambda c: _replaced(f"lower({c})", [*_SQUASH, (r"^\.+|\.+$", "")])
_HEAD = r"^[ \t\n\x0b\f\r]*(#{1,6})[ \t\n\x0b\f\r]+(.*[^ \t\n\x0b\f\r])[ \t\n\x0b\f\r]*$"
ORACLE = {
    "boundary_tests": f"SELECT sent_uid, regexp_matches(text, '{_q(B.STRONG_TERMINAL)}') AS strong, regexp_matches(text, '{_q(B.CAPTION)}') AS caption, regexp_matches(text, '{_q(B.BRACKET_ONLY)}') AS bracket, len(regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+')) <= 4 AS short, regexp_matches(text, '{_q(B.CITATION_START)}') AS cited FROM ({_T})",
    "abbreviations_protected": f"SELECT sent_uid, {_replaced('text', _GUARD)} AS guarded, {_replaced(_replaced('text', _GUARD), _UNGUARD)} AS restored FROM ({_T})",
    "references_protected": f"SELECT sent_uid, {_replaced('text', _REFS)} AS guarded, {_replaced(_replaced('text', _REFS), _UNREFS)} AS restored FROM ({_T})",
    "mark_cuts": _posed("sent_uid", _replaced("text", _CUT1), _T),
    "blank_cuts": _posed("block_uid", _replaced(_replaced("text", _REFS), _CUT2), "SELECT block_uid, text FROM blocks WHERE text IS NOT NULL"),
    "name_forms": "SELECT row_uid, " + _replaced("CDs_Naming_in_Paper", [(r"[\x{200b}\x{2009}\x{202f}*`]", ""), *_SQUASH, ("^__(.*)__$", "\\1"), ("^~~(.*)~~$", "\\1"), ("^_(.*)_$", "\\1"), ("^[\\s'\"“”‘’]+|[\\s'\"“”‘’]+$", "")])
    + f" AS name, {_TOKEN('Precursor')} AS token, " + _TOKEN("array_to_string(list_filter(string_split(" + _replaced("Purification", [*_SQUASH, (r"[.,;:!?）\]]+$", "")]) + ", ' '), lambda w: w <> '')[-8:], ' ')") + f" AS long, translate(Precursor, '{_q(B.QUOTES[0])}', '{_q(B.QUOTES[1])}') AS quotes FROM letter_table",
    "markdown_blocks": f"""WITH d AS (SELECT doc_id, string_agg('# ' || coalesce(main_header_text, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY block_id, block_uid) AS md FROM blocks WHERE doc_id IS NOT NULL GROUP BY 1),
 l AS (SELECT doc_id, CAST(i - 1 AS INT) AS n, s[i] AS line FROM (SELECT doc_id, string_split(regexp_replace(md, '\\n$', ''), chr(10)) AS s FROM d), LATERAL (SELECT unnest(range(1, len(s) + 1)) AS i)),
 h AS (SELECT *, length(regexp_extract(line, '{_HEAD}', 1)) AS lv, regexp_extract(line, '{_HEAD}', 2) AS title FROM l), b AS (SELECT *, sum(CASE WHEN lv = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS k FROM h),
 t AS (SELECT doc_id, k, n, title, regexp_extract(title, '^\\s*(\\d+)(?:\\.\\d+)*\\.?(?:\\s|$)', 1) AS root, regexp_matches(title, '^\\s*\\d+\\.\\d+\\.?(?:\\s|$)') AS sub FROM b WHERE lv = 1),
 u AS (SELECT *, last_value(CASE WHEN NOT sub AND root <> '' THEN root END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM t), v AS (SELECT *, {_FOLD.format('trim(title)')} AS h FROM u),
 w AS (SELECT doc_id, k, n, title, last_value(CASE WHEN NOT coalesce(sub AND root = top, false) THEN {_SECTION} END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS section FROM v),
 g AS (SELECT doc_id, k, regexp_replace(string_agg(CASE WHEN lv > 0 THEN chr(10) || title || chr(10) ELSE line END, chr(10) ORDER BY n), '^{_WS}+|{_WS}+$', '', 'g') AS text, min(n) AS s, max(n) AS e FROM b GROUP BY 1, 2)
 SELECT g.doc_id, CAST(row_number() OVER (PARTITION BY g.doc_id ORDER BY g.k) - 1 AS INT) AS block_id, coalesce(section, 'unknown') AS main_section_norm, coalesce(title, '') AS main_header_text, text, w.n AS header_line, s AS start_line, e AS end_line FROM g LEFT JOIN w ON w.doc_id = g.doc_id AND w.k = g.k WHERE text <> ''""",
}
