"""Queries of the rule stages: answers of models, names and units as rules read them, assignments, routing and fills; with their SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, functions as F

from dotledger.functions import answers, latex
from dotledger.functions.rules import NUMERIC_PATTERNS, NUMERIC_PROPERTIES, PROPERTY_ORDER
from dotledger.operators import consolidation as C
from dotledger.operators.packed import with_items
from dotledger.operators.text_stages import stabilize_sections
from dotledger.plans.session import read_table

#: Section names of the blocks table by those of the rules.
BLOCK_SECTIONS = {"introduction": "intro", "experimental": "methods", "results": "results_discussion"}
#: Other spellings of the canonical property names.
TAG_ALIASES = {"excitation": "Ex", "emission": "Em", "quantum yield": "QY", "qy": "QY", "ex": "Ex", "em": "Em", "lifetime": "lifetime", "exdep": "ExDep", "chiral": "Chiral", "cpl": "CPL"}


def _tags(spark, folder, whole=False):
    """One row per property of a sentence. whole: of cells packed in any way; else of those that the SQL splits."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null")
    columns = ["sent_uid", "pdf_name", "para_global_id", "sent_global_id", "main_section_norm", "LLM_name", "text"]
    if whole:
        t = with_items(s.select(*columns, "LLM_props"), "sent_uid", "LLM_props", "tag").select(*columns, "tag")
    else:
        t = s.select(*columns, F.explode(F.split("LLM_props", "[;,|/]\\s*")).alias("tag"))
    return t.filter(F.col("tag").isin(*PROPERTY_ORDER))


def section_stabilize(spark, folder):
    """Sections of the blocks after the repair between main sections."""
    b = read_table(spark, folder, "blocks")
    names = F.create_map(*(F.lit(x) for kv in BLOCK_SECTIONS.items() for x in kv))
    b = b.select("block_uid", "doc_id", "block_id", F.coalesce(F.try_element_at(names, F.coalesce("main_section_norm", F.lit(""))), "main_section_norm").alias("section"))
    return stabilize_sections(b, "doc_id", ["block_id", "block_uid"], "section").select("block_uid", "section")


def latex_units(spark, folder):
    li = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.format_string("%d \\upmu L at %d^{\\circ}C, 5 \\mathrm{mL}, 3\\%%", F.col("l_quantity").cast("int"), F.col("l_partkey") % 300).alias("x"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", latex.plain_units(F.col("x")).alias("plain"))


def answer_decisions(spark, folder):
    """Decisions read from tagged and free answers."""
    o = read_table(spark, folder, "orders")
    raw = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("<think>no</think> Yes, "), "o_orderpriority")).when(F.col("o_orderstatus") == "O", F.concat(F.lit("<Value>"), "o_orderpriority", F.lit("</Value>"))).otherwise(F.lit('{"keep": false}'))
    o = o.select("o_orderkey", raw.alias("raw"))
    clean = answers.strip_thinking(F.col("raw"))
    return o.select("o_orderkey", answers.yes_no(clean).alias("decision"), answers.tagged(F.col("raw"), "value").alias("value"), answers.boolean_answer(F.col("raw")).alias("kept"))


def tag_canonical(spark, folder, whole=False):
    m = F.create_map(*(F.lit(x) for kv in TAG_ALIASES.items() for x in kv))
    t = _tags(spark, folder, whole).select("sent_uid", F.upper("tag").alias("t"))
    return t.select("sent_uid", "t", F.try_element_at(m, F.regexp_replace(F.lower(F.trim("t")), "\\s+", " ")).alias("tag"))


def chiral_names(spark, folder):
    """Precursors that carry an L- or D- marker of their own."""
    return read_table(spark, folder, "letter_table").filter("Precursor is not null").select("row_uid", F.col("Precursor").rlike("(?<![A-Za-z0-9])[LD]-").alias("chiral"))


def condition_values(spark, folder):
    """pH values and wavelengths that sentences state as conditions, each once and in order."""
    s = read_table(spark, folder, "decisions").filter("text is not null")
    ph = F.array_distinct(F.regexp_extract_all("text", F.lit("pH (?:of )?([0-9]+(?:\\.[0-9]+)?)"), 1))
    return s.select("sent_uid", F.array_join(ph, ";").alias("ph"), (F.size(ph) >= 2).alias("axis")).filter("ph <> ''")


def first_numbers(spark, folder):
    x = F.regexp_extract("Temperature", "-?[0-9]+(?:\\.[0-9]+)?", 0)
    return read_table(spark, folder, "letter_table").filter("Temperature is not null").select("row_uid", F.expr("1").alias("one"), F.when(x != "", x.cast("double")).alias("number"))


def numeric_evidence(spark, folder):
    """Tagged sentences whose numbers all stand in their paragraph, for the properties with numbers."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and text is not null")
    para = s.groupBy("pdf_name", "para_global_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent_global_id", "sent_uid", "text"))), lambda x: x["text"]), " ").alias("evidence"))
    t = _tags(spark, folder).filter(F.col("tag").isin(*NUMERIC_PROPERTIES)).join(para, ["pdf_name", "para_global_id"])
    numbers = F.regexp_extract_all("text", F.lit("[0-9]+(?:\\.[0-9]+)?"), 0)
    return t.select("sent_uid", "tag", ((F.size(numbers) > 0) & F.forall(numbers, lambda n: F.col("evidence").contains(n))).alias("valid"))


def numeric_valid(sentence: Column, tag: Column, evidence: Column) -> Column:
    """Whether a sentence has a number with a unit that fits its tag and all such numbers stand in the evidence; true for tags without numbers."""
    numbers = F.coalesce(*(F.when(tag == t, F.regexp_extract_all(sentence, F.lit(f"(?iU){p}"), 1)) for t, p in NUMERIC_PATTERNS.items()))
    found = F.coalesce((F.size(numbers) > 0) & F.forall(numbers, lambda n: F.coalesce(evidence, F.lit("")).contains(n)), F.lit(False))
    return ~tag.isin(*NUMERIC_PROPERTIES) | found


def numeric_evidence_whole(spark, folder):
    """Tagged sentences by whether they state a number with a unit of the property (valid), and whether the other sentences of their paragraph have
    all such numbers too (confirmed). The judged sentences are the paper's own, so their paragraph as a whole has their numbers anyhow."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and text is not null")
    lines = s.groupBy("pdf_name", "para_global_id").agg(F.array_sort(F.collect_list(F.struct("sent_global_id", "sent_uid", "text"))).alias("lines"))
    t = _tags(spark, folder, whole=True).filter(F.col("tag").isin(*NUMERIC_PROPERTIES) & F.col("text").isNotNull()).alias("t")
    t = t.join(lines.alias("l"), (F.col("t.pdf_name") == F.col("l.pdf_name")) & F.col("t.para_global_id").eqNullSafe(F.col("l.para_global_id")))
    others = F.array_join(F.transform(F.filter("lines", lambda x: x["sent_uid"] != F.col("sent_uid")), lambda x: x["text"]), " ")
    return t.select("sent_uid", "tag", numeric_valid(F.col("text"), F.col("tag"), F.col("text")).alias("valid"), numeric_valid(F.col("text"), F.col("tag"), others).alias("confirmed"))


def no_digit_filter(spark, folder, whole=False):
    """Numeric tags of sentences without a digit are dropped."""
    t = _tags(spark, folder, whole).filter("text is not null")
    return t.filter(F.col("text").rlike("[0-9]") | ~F.col("tag").isin(*NUMERIC_PROPERTIES)).select("sent_uid", "tag")


def hit_assign(spark, folder, whole=False):
    """Every tagged sentence gets all names of its paragraph; a paper with a single sample gives it to all."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and coalesce(trim(LLM_name), '') <> ''")
    names = s.groupBy("pdf_name", "para_global_id").agg(F.array_join(F.array_sort(F.collect_set("LLM_name")), ";").alias("own"))
    single = s.groupBy("pdf_name").agg(F.count_distinct("LLM_name").alias("n"), F.min("LLM_name").alias("only")).filter("n = 1")
    t = _tags(spark, folder, whole).select("sent_uid", "pdf_name", "para_global_id", "tag").distinct()
    j = t.join(names, ["pdf_name", "para_global_id"], "left").join(single, "pdf_name", "left")
    return j.select("sent_uid", "tag", F.coalesce("only", "own", F.lit("")).alias("names"))


def route_split(spark, folder, whole=False):
    """Tagged sentences by where they go: the paper's own samples, applications, or comparisons."""
    t = _tags(spark, folder, whole)
    kind = F.when(~F.col("tag").isin(*NUMERIC_PROPERTIES), "main").when(F.col("text").rlike("(?i)compared|undoped|vs\\."), "vs").when(F.col("text").rlike("(?i)sensing|imaging|detection"), "app").otherwise("main")
    return t.groupBy(kind.alias("kind"), "tag").agg(F.count("*").alias("n"))


def field_fill(spark, folder):
    """Empty volumes take the volume that most rows of the paper have, ties by name; the rest stay N/A."""
    r = read_table(spark, folder, "letter_table").filter("doc_id is not null")
    best = C.top_vote(r.filter(~C.is_empty(F.col("Solvent_Volume"), C.EMPTY_PROPERTY)), ["doc_id"], "Solvent_Volume", [F.col("Solvent_Volume")]).select("doc_id", F.col("Solvent_Volume").alias("filled"))
    empty = r.filter(C.is_empty(F.col("Solvent_Volume"), C.EMPTY_PROPERTY)).select("row_uid", "doc_id")
    return empty.join(best, "doc_id", "left").select("row_uid", F.coalesce("filled", F.lit("N/A")).alias("Solvent_Volume"))


def value_signatures(spark, folder):
    """Sorted distinct values of each order's quantities with their unit, as compared in conflicts."""
    li = read_table(spark, folder, "lineitem")
    return li.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.col("l_quantity").cast("int"))), lambda x: x.cast("string")), ";").alias("v")).select("l_orderkey", F.concat("v", F.lit(" ns")).alias("signature"))


def percent_scaling(spark, folder):
    """Yields below one are fractions unless the sentence has a percent sign."""
    li = read_table(spark, folder, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.when((F.col("l_discount") < 1) & (F.col("l_returnflag") != "A"), F.round(F.col("l_discount") * 100, 6)).otherwise(F.col("l_discount")).alias("percent"))


def abbreviations(spark, folder):
    """Short forms in parentheses after their long forms, with how many sentences have them."""
    s = read_table(spark, folder, "decisions").filter("text is not null")
    pairs = F.regexp_extract_all("text", F.lit("\\(([A-Z][A-Za-z]{1,11})\\)"), 1)
    return s.select("sent_uid", F.explode(F.array_distinct(pairs)).alias("short")).groupBy("short").agg(F.count("*").alias("sentences"))


QUERIES = {f.__name__: f for f in (section_stabilize, latex_units, answer_decisions, tag_canonical, chiral_names, condition_values, first_numbers, numeric_evidence, numeric_evidence_whole, no_digit_filter, hit_assign, route_split, field_fill, value_signatures, percent_scaling, abbreviations)}
#: The same over the tags of all cells, however they are packed, of which the SQL splits a part.
QUERIES |= {f"{f.__name__}_whole": partial(f, whole=True) for f in (tag_canonical, no_digit_filter, hit_assign, route_split)}

_T = f"(SELECT * FROM (SELECT sent_uid, pdf_name, para_global_id, sent_global_id, main_section_norm, LLM_name, text, unnest(regexp_split_to_array(LLM_props, '[;,|/]\\s*')) AS tag FROM decisions WHERE pdf_name IS NOT NULL) WHERE tag IN ({', '.join(repr(t) for t in PROPERTY_ORDER)}))"
_NUM = ", ".join(repr(t) for t in NUMERIC_PROPERTIES)
_EMPTY = "(Solvent_Volume IS NULL OR upper(trim(Solvent_Volume)) IN (" + ", ".join(repr(w) for w in C.EMPTY_PROPERTY) + "))"
#: The tags of all cells: whatever packs them, a tag is a word of its own.
_TW = f"(SELECT sent_uid, pdf_name, para_global_id, sent_global_id, main_section_norm, LLM_name, text, unnest(regexp_extract_all(LLM_props, '\\b({'|'.join(PROPERTY_ORDER)})\\b')) AS tag FROM decisions WHERE pdf_name IS NOT NULL)"
ORACLE = {
    "latex_units": "SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' μL at ' || CAST(l_partkey % 300 AS VARCHAR) || '°C, 5 mL, 3%' AS plain FROM lineitem",
    "answer_decisions": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'YES' ELSE 'NO' END AS decision, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS value, o_orderstatus IN ('F', 'O') AS kept FROM orders",
    "tag_canonical": f"SELECT sent_uid, upper(tag) AS t, tag FROM {_T}",
    "chiral_names": "SELECT row_uid, regexp_matches(Precursor, '(^|[^A-Za-z0-9])[LD]-') AS chiral FROM letter_table WHERE Precursor IS NOT NULL",
    "condition_values": """WITH l AS (SELECT sent_uid, regexp_extract_all(text, 'pH (?:of )?([0-9]+(?:\\.[0-9]+)?)', 1) AS l FROM decisions WHERE text IS NOT NULL), d AS (SELECT sent_uid, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM l WHERE len(l) > 0) SELECT sent_uid, array_to_string(l, ';') AS ph, len(l) >= 2 AS axis FROM d""",
    "first_numbers": "SELECT row_uid, 1 AS one, CAST(nullif(regexp_extract(Temperature, '-?[0-9]+(?:\\.[0-9]+)?'), '') AS DOUBLE) AS number FROM letter_table WHERE Temperature IS NOT NULL",
    "numeric_evidence": f"""WITH p AS (SELECT pdf_name, para_global_id, string_agg(text, ' ' ORDER BY sent_global_id, sent_uid) AS e FROM decisions WHERE pdf_name IS NOT NULL AND text IS NOT NULL GROUP BY 1, 2)
 SELECT sent_uid, tag, len(n) > 0 AND len(list_filter(n, lambda x: NOT contains(e, x))) = 0 AS valid FROM (SELECT t.*, e, regexp_extract_all(text, '[0-9]+(?:\\.[0-9]+)?') AS n FROM {_T} t JOIN p ON p.pdf_name = t.pdf_name AND p.para_global_id = t.para_global_id WHERE tag IN ({_NUM}))""",
    "no_digit_filter": f"SELECT sent_uid, tag FROM {_T} WHERE text IS NOT NULL AND (regexp_matches(text, '[0-9]') OR tag NOT IN ({_NUM}))",
    "hit_assign": f"""WITH s AS (SELECT * FROM decisions WHERE pdf_name IS NOT NULL AND coalesce(trim(LLM_name), '') <> ''), n AS (SELECT pdf_name, para_global_id, string_agg(DISTINCT LLM_name, ';' ORDER BY LLM_name) AS own FROM s GROUP BY 1, 2), o AS (SELECT pdf_name, min(LLM_name) AS o FROM s GROUP BY 1 HAVING count(DISTINCT LLM_name) = 1)
 SELECT DISTINCT sent_uid, tag, coalesce(o.o, own, '') AS names FROM {_T} t LEFT JOIN n ON n.pdf_name = t.pdf_name AND n.para_global_id = t.para_global_id LEFT JOIN o ON o.pdf_name = t.pdf_name""",
    "route_split": f"SELECT CASE WHEN tag NOT IN ({_NUM}) THEN 'main' WHEN regexp_matches(text, '(?i)compared|undoped|vs\\.') THEN 'vs' WHEN regexp_matches(text, '(?i)sensing|imaging|detection') THEN 'app' ELSE 'main' END AS kind, tag, count(*) AS n FROM {_T} GROUP BY 1, 2",
    "field_fill": f"""WITH r AS (SELECT * FROM letter_table WHERE doc_id IS NOT NULL), c AS (SELECT doc_id, Solvent_Volume, count(*) AS n FROM r WHERE NOT {_EMPTY} GROUP BY 1, 2), b AS (SELECT doc_id, arg_min(Solvent_Volume, (-n, Solvent_Volume)) AS s FROM c GROUP BY 1) SELECT row_uid, coalesce(s, 'N/A') AS Solvent_Volume FROM r LEFT JOIN b ON b.doc_id = r.doc_id WHERE (r.Solvent_Volume IS NULL OR upper(trim(r.Solvent_Volume)) IN ({', '.join(repr(w) for w in C.EMPTY_PROPERTY)}))""",
    "value_signatures": "SELECT l_orderkey, string_agg(CAST(q AS VARCHAR), ';' ORDER BY q) || ' ns' AS signature FROM (SELECT DISTINCT l_orderkey, CAST(l_quantity AS INT) AS q FROM lineitem) GROUP BY 1",
    "percent_scaling": "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount < 1 AND l_returnflag <> 'A' THEN round(l_discount * 100, 6) ELSE l_discount END AS percent FROM lineitem",
    "abbreviations": "SELECT short, count(*) AS sentences FROM (SELECT DISTINCT sent_uid, unnest(regexp_extract_all(text, '\\(([A-Z][A-Za-z]{1,11})\\)', 1)) AS short FROM decisions WHERE text IS NOT NULL) GROUP BY 1",
}
ORACLE |= {f"{n}_whole": ORACLE[n].replace(_T, _TW) for n in ("tag_canonical", "no_digit_filter", "hit_assign", "route_split")}
_BY_TAG = lambda c: "CASE tag " + " ".join(f"WHEN '{t}' THEN regexp_extract_all({c}, '(?i){p.replace(chr(92) + 'b', '(?:[^' + chr(92) + 'pL' + chr(92) + 'pN_]|$)').replace(chr(92) + 'd', chr(92) + 'p{Nd}')}', 1)" for t, p in NUMERIC_PATTERNS.items()) + " END"
ORACLE["numeric_evidence_whole"] = f"""WITH s AS (SELECT * FROM decisions WHERE pdf_name IS NOT NULL AND text IS NOT NULL), t AS (SELECT *, {_BY_TAG('text')} AS n FROM {_TW} WHERE tag IN ({_NUM}) AND text IS NOT NULL),
 o AS (SELECT t.sent_uid, t.tag, string_agg(s.text, ' ' ORDER BY s.sent_global_id, s.sent_uid) AS e FROM (SELECT DISTINCT sent_uid, tag, pdf_name, para_global_id FROM t) t JOIN s ON s.pdf_name = t.pdf_name AND s.para_global_id IS NOT DISTINCT FROM t.para_global_id AND s.sent_uid <> t.sent_uid GROUP BY 1, 2)
 SELECT t.sent_uid, t.tag, len(n) > 0 AS valid, len(n) > 0 AND len(list_filter(n, lambda x: NOT contains(coalesce(e, ''), x))) = 0 AS confirmed FROM t LEFT JOIN o ON o.sent_uid = t.sent_uid AND o.tag = t.tag"""
