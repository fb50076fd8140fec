"""Queries of the consolidation stages: joins, votes, merges, duplicates and export; with the SQL they are compared with.

Votes come from the extraction rows: an item is a paper's sample, a vote one of its rows.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dotledger.functions.rules import PROPERTY_ORDER, TABLE_COLUMNS, UNIQUE_PROPERTIES
from dotledger.operators import consolidation as C
from dotledger.operators.ordered import running_sum
from dotledger.operators.packed import with_items
from dotledger.operators.text_stages import squash
from dotledger.plans.session import read_table

_SIG = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "letter_table").filter("doc_id is not null")


def _votes(spark: SparkSession, folder: str) -> DataFrame:
    """Votes on the verdict of an order: its lines in the order of their numbers; ties of line numbers are broken by the other keys."""
    li = read_table(spark, folder, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return li.select(F.col("l_orderkey").alias("item"), F.row_number().over(w).alias("vote_no"), "l_returnflag", "l_linestatus", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _tags(s: DataFrame, whole: bool) -> DataFrame:
    """The sentences once for each of their properties. whole: of cells packed in any way; else of those that the SQL splits."""
    t = with_items(s, "sent_uid", "LLM_props", "tag") if whole else s.withColumn("tag", F.explode(F.split("LLM_props", "[;,|/]\\s*")))
    return t.filter(F.col("tag").isin(*PROPERTY_ORDER))


def sample_dimension(spark, folder):
    """The first row of each usable sample name of a paper with its description."""
    w = Window.partitionBy("doc_id", "CDs_Naming_in_Paper").orderBy("extraction_no", "row_no", "row_uid")
    r = _rows(spark, folder).filter(~C.is_empty(F.col("CDs_Naming_in_Paper"), C.EMPTY_PROPERTY)).withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    part = lambda label, c: F.when(~C.is_empty(F.col(c), C.EMPTY_PROPERTY), F.concat(F.lit(label), F.trim(c)))
    desc = F.concat_ws("; ", part("prepared by ", "Synthesis_Method"), part("from ", "Precursor"), part("in ", "Solvent"), part("at ", "Temperature"), part("for ", "Time"))
    return r.select("doc_id", F.col("CDs_Naming_in_Paper").alias("sample"), desc.alias("description"))


def extraction_consensus(spark, folder):
    cols = ["Synthesis_Method", "Temperature", "Time", "Microwave_Power", "Precursor", "Solvent", "Purification"]
    return C.consensus(_rows(spark, folder), ["doc_id", "CDs_Naming_in_Paper"], cols, "row_uid")


def merged_rows(spark, folder):
    """One row per paper and sample in the order of names, with the settled text columns."""
    c = C.consensus(_rows(spark, folder), ["doc_id", "CDs_Naming_in_Paper"], ["Synthesis_Method", "Temperature", "Time", "Solvent"], "row_uid")
    return c.groupBy("doc_id", "CDs_Naming_in_Paper").agg(*(F.max(F.when(F.col("column") == x, F.col("value"))).alias(x) for x in ("Synthesis_Method", "Temperature", "Time", "Solvent")))


def review_items(spark, folder):
    """Cells of a sample that no rule settles, with the values they were read as."""
    c = C.consensus(_rows(spark, folder), ["doc_id", "CDs_Naming_in_Paper"], ["Synthesis_Method", "Solvent"], "row_uid").filter("status <> 'SAME'")
    return c.groupBy("column", "status").agg(F.count("*").alias("items"), F.count_distinct("doc_id").alias("docs"))


def quantity_valid(spark, folder):
    """Whether each packed amount is a list of subjects with numbers in parentheses, or N/A."""
    v = F.trim(F.col("Precursor_Amount"))
    item = "[^,;()]*\\([^()]*\\d[^()]*\\)"
    ok = (v == "N/A") | v.rlike(f"^{item}(?:\\s*[,;]\\s*{item})*$")
    return _rows(spark, folder).filter(v.isNotNull() & (v != "")).select("row_uid", ok.alias("valid"))


def quantity_majority(spark, folder):
    return C.quantity_majority(_rows(spark, folder), ["doc_id", "CDs_Naming_in_Paper"], "Precursor_Amount", ["extraction_no", "row_no", "row_uid"])


def common_tokens(spark, folder):
    return C.common_tokens(_rows(spark, folder).filter("CDs_Naming_in_Paper is not null"), ["doc_id", "CDs_Naming_in_Paper"], "Precursor")


def unique_ignoring_case(spark, folder):
    g = _rows(spark, folder).groupBy("doc_id").agg(F.count_distinct(C.case_space_key(F.col("Synthesis_Method"))).alias("n"))
    return g.select("doc_id", (F.col("n") == 1).alias("same"))


def verdict_vote(spark, folder):
    v = _votes(spark, folder)
    verdict = F.when(F.col("l_returnflag") == "A", "KEEP").when(F.col("l_returnflag") == "N", "DROP").otherwise("REWRITE")
    return C.verdict_majority(v.withColumn("verdict", F.when(F.col("l_quantity") > 2, verdict)), "item", "verdict")


def pick_vote4(spark, folder):
    v = _votes(spark, folder).withColumn("pick", F.when(F.col("l_quantity") > 3, (F.col("l_partkey") % 3 + 1).cast("int")))
    return C.pick_majority(v, "item", "vote_no", "pick")


def set_vote(spark, folder):
    v = _votes(spark, folder)
    a, b = (F.col("l_partkey") % 3).cast("bigint"), (F.col("l_suppkey") % 3).cast("bigint")
    return C.set_majority(v.withColumn("ids", F.when(F.col("l_quantity") > 25, F.array(a, b)).otherwise(F.array(a))), "item", "ids").withColumn("ids", F.concat_ws(",", "ids"))


def none_vote(spark, folder):
    v = _votes(spark, folder).withColumn("sentence", F.when(F.col("l_returnflag") != "N", F.concat_ws(" ", "l_returnflag", "l_linestatus")))
    return C.vote_with_none(v, "item", "sentence")


def structure_vote(spark, folder):
    """The structure two votes share, by their sorted distinct values; else the one with the most values."""
    v = _votes(spark, folder).withColumn("values", F.array_sort(F.array_distinct(F.array((F.col("l_partkey") % 4).cast("bigint"), (F.col("l_suppkey") % 4).cast("bigint")))))
    top = C.top_vote(v, ["item"], "values", [F.desc(F.size("values")), F.col("values")])
    rich = v.groupBy("item").agg(F.max(F.struct(F.size("values").alias("n"), F.col("values").alias("v"))).alias("r"))
    return top.join(rich, "item").select("item", F.concat_ws(",", F.when(F.col("votes") >= 2, F.col("values")).otherwise(F.col("r.v"))).alias("structure"))


def dominance(spark, folder):
    """The sample that leads a paragraph's evidence by more than one sentence."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and coalesce(trim(LLM_name), '') <> ''").withColumn("sample", _SIG(F.col("LLM_name")))
    return C.dominant(s, ["pdf_name"], "sample", "sent_global_id")


def kind_majority(spark, folder):
    """Orders' lines of the flag that most lines of the order have."""
    v = _votes(spark, folder)
    return C.kind_majority(v.select("item", "vote_no", "l_returnflag"), ["item"], "l_returnflag")


def evidence_lookup(spark, folder):
    """Texts of the sentences around each candidate, by their ids."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null")
    texts = s.groupBy("pdf_name", F.col("sent_global_id").alias("sid")).agg(F.min("text").alias("line"))
    want = s.filter("window_level = 'SMALL'").select("sent_uid", "pdf_name", F.explode(F.array(*(F.col("sent_global_id") + k for k in (-1, 0, 1)))).alias("sid"))
    j = want.join(texts, ["pdf_name", "sid"]).filter("line is not null and trim(line) <> ''")
    return j.groupBy("sent_uid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sid", "line"))), lambda x: x["line"]), " ").alias("evidence"))


def candidate_samples(spark, folder):
    """Names of each paragraph that are samples of the paper by their signature."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and coalesce(trim(LLM_name), '') <> ''").select("pdf_name", "para_global_id", _SIG(F.col("LLM_name")).alias("sig")).distinct()
    samples = _rows(spark, folder).filter(~C.is_empty(F.col("CDs_Naming_in_Paper"), C.EMPTY_PROPERTY)).groupBy(F.col("doc_id").alias("pdf_name"), _SIG(F.col("CDs_Naming_in_Paper")).alias("sig")).agg(F.min("CDs_Naming_in_Paper").alias("sample"))
    return s.join(samples, ["pdf_name", "sig"]).select("pdf_name", "para_global_id", "sample")


def candidate_samples_whole(spark, folder):
    """The candidate samples of every paragraph of a paper that has samples: those whose signature it names (scope matched), if there are two or
    more, else all samples of the paper (scope all). The latter aren't repeated for each paragraph: they are the paper's rows of `sample_dimension`."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null").select("pdf_name", "para_global_id", F.nullif(_SIG(F.coalesce("LLM_name", F.lit(""))), F.lit("")).alias("sig")).distinct()
    samples = _rows(spark, folder).filter(~C.is_empty(F.col("CDs_Naming_in_Paper"), C.EMPTY_PROPERTY)).select(F.col("doc_id").alias("pdf_name"), _SIG(F.col("CDs_Naming_in_Paper")).alias("sig"), F.col("CDs_Naming_in_Paper").alias("sample")).distinct()
    found = s.join(samples, ["pdf_name", "sig"], "left").groupBy("pdf_name", "para_global_id").agg(F.array_sort(F.collect_list("sample")).alias("samples"))
    found = found.join(samples.select("pdf_name").distinct(), "pdf_name", "left_semi")
    two = F.size("samples") >= 2
    return found.select("pdf_name", "para_global_id", F.when(two, "matched").otherwise("all").alias("scope"), F.when(two, F.col("samples")).alias("samples"))


def main_dedup(spark, folder, whole=False):
    """Properties of other paragraphs that the main section doesn't have yet, for the properties that stand once."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and LLM_name is not null")
    if whole:
        tags = with_items(s.select("sent_uid", "pdf_name", "main_section_norm", "LLM_name", "LLM_props"), "sent_uid", "LLM_props", "tag")
    else:
        tags = s.withColumn("tag", F.explode(F.split(F.coalesce("LLM_props", F.lit("")), ";")))
    items = tags.select("pdf_name", "main_section_norm", "LLM_name", "tag").filter("tag <> ''").distinct()
    main = items.filter("main_section_norm = 'results'").select("pdf_name", "LLM_name", "tag").distinct()
    rest = items.filter("coalesce(main_section_norm, '') <> 'results'")
    once = rest.filter(F.col("tag").isin(*UNIQUE_PROPERTIES)).join(main, ["pdf_name", "LLM_name", "tag"], "left_anti")
    return once.unionByName(rest.filter(~F.col("tag").isin(*UNIQUE_PROPERTIES))).select("pdf_name", "LLM_name", "tag", F.coalesce("main_section_norm", F.lit("")).alias("section"))


def catalogue_check(spark, folder):
    """Sentences whose name is a registered sample."""
    s = read_table(spark, folder, "decisions")
    r = read_table(spark, folder, "sample_registry").select(F.col("name").alias("LLM_name")).distinct()
    return s.join(r, "LLM_name", "left_semi").select("sent_uid", "LLM_name")


def tag_union(spark, folder, whole=False):
    """All properties of a paragraph in the canonical order."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null")
    t = _tags(s.select("sent_uid", "pdf_name", "para_global_id", "LLM_props"), whole).select("pdf_name", "para_global_id", "tag").distinct()
    return t.groupBy("pdf_name", "para_global_id").agg(F.concat_ws(";", F.transform(F.array_sort(F.collect_list(F.struct(C.property_rank(F.col("tag")).alias("r"), "tag"))), lambda x: x["tag"])).alias("tags"))


def dedupe_same(spark, folder):
    """Rows delivered twice: the first of every natural key with the number of copies."""
    key = ["doc_id", "extraction_no", "row_no", *TABLE_COLUMNS]
    return _rows(spark, folder).groupBy(*key).agg(F.min("row_uid").alias("row_uid"), F.count("*").alias("copies")).filter("copies > 1").select("row_uid", "copies")


def subset_elim(spark, folder):
    """Orders' lines whose pair of keys lies within another line's set of the same order."""
    v = _votes(spark, folder)
    vals = F.when(F.col("vote_no") % 2 == 0, F.array(F.col("l_partkey") % 5)).otherwise(F.array(F.col("l_partkey") % 5, F.col("l_suppkey") % 5))
    return C.strict_subsets(v.withColumn("values", vals), ["item"], "vote_no", "values")


def merge_reach(spark, folder):
    """Parts point at smaller parts; where each chain ends."""
    p = read_table(spark, folder, "part").filter("p_partkey > 1").select("p_partkey", F.floor(F.col("p_partkey") / 2).cast("bigint").alias("into"))
    return C.merge_destinations(p, "p_partkey", "into")


def sentence_candidates(spark, folder):
    """Distinct sentences of a paper without case and spacing, numbered by their first place."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and coalesce(trim(text), '') <> ''")
    g = s.groupBy("pdf_name", C.case_space_key(F.col("text")).alias("k")).agg(F.min("sent_uid").alias("first"), F.count("*").alias("n"))
    return running_sum(g.select("pdf_name", "first", "n"), ["pdf_name"], ["first"], "first", {"candidate": F.lit(1)})


def pair_promotion(spark, folder):
    """Whether any order of a customer kept two flags, shown on all orders of the customer."""
    o = read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("item"), "o_custkey")
    v = _votes(spark, folder).groupBy("item").agg((F.count_distinct("l_returnflag") > 1).alias("two"))
    return o.join(v, "item").select("item", F.max("two").over(Window.partitionBy("o_custkey")).alias("promoted"))


def property_pivot(spark, folder, whole=False):
    """Per paper and sample, the sentences' places of every property in order."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and coalesce(trim(LLM_name), '') <> ''")
    t = _tags(s.select("pdf_name", "LLM_name", "sent_global_id", "sent_uid", "LLM_props"), whole)
    return C.pivot_properties(t.withColumn("v", F.col("sent_global_id").cast("string")), ["pdf_name", "LLM_name"], "tag", "v", ["sent_global_id", "sent_uid"])


def run_length_rows(spark, folder):
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and LLM_name is not null")
    r = C.run_rows(s, "pdf_name", ["sent_global_id", "sent_uid"], "LLM_name")
    return r.groupBy("pdf_name", "run").agg(F.min("LLM_name").alias("name"), F.count("*").alias("n")).withColumn("run", F.col("run").cast("bigint"))


def format_values(spark, folder):
    li = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_extendedprice")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.concat(C.format_number(F.col("l_quantity")), F.lit(" ns("), C.format_number(F.col("l_discount")), F.lit(")")).alias("shown"))


def quarantine(spark, folder):
    """Papers without any property, with the reason."""
    s = read_table(spark, folder, "decisions").filter("coalesce(trim(LLM_props), '') <> ''").select(F.col("pdf_name").alias("doc_id")).distinct()
    return read_table(spark, folder, "papers").join(s, "doc_id", "left_anti").select("doc_id", F.lit("no_property").alias("reason"))


def manifest_skip(spark, folder):
    """Papers whose extraction is older than the paper's last load: what an incremental run has to do."""
    done = _rows(spark, folder).groupBy("doc_id").agg(F.max("extracted_at").alias("done_at"))
    d = read_table(spark, folder, "documents").filter("paper_id is not null").groupBy(F.col("paper_id").alias("doc_id")).agg(F.max("loaded_at").alias("loaded_at"))
    return d.join(done, "doc_id", "left").filter("done_at is null or done_at < loaded_at").select("doc_id")


def run_status(spark, folder):
    """Papers by status: with rows, sentences only, or neither."""
    p = read_table(spark, folder, "papers").select("doc_id")
    r = _rows(spark, folder).select("doc_id").distinct().withColumn("r", F.lit(1))
    s = read_table(spark, folder, "decisions").select(F.col("pdf_name").alias("doc_id")).distinct().withColumn("s", F.lit(1))
    status = F.when(F.col("r").isNotNull(), "written").when(F.col("s").isNotNull(), "skipped").otherwise("missing")
    return p.join(r, "doc_id", "left").join(s, "doc_id", "left").groupBy(status.alias("status")).agg(F.count("*").alias("papers"))


def acronyms(spark, folder):
    """Values that look like acronyms: no space, two to twelve characters without points and dashes, a letter."""
    v = _rows(spark, folder).select(F.explode(F.split(F.coalesce("Solvent", F.lit("")), "[,;]\\s*")).alias("v")).filter("v <> ''").distinct()
    bare = F.regexp_replace("v", "[.\\-]", "")
    return v.select("v", (~F.col("v").contains(" ") & F.length(bare).between(2, 12) & F.col("v").rlike("[A-Za-z]")).alias("acronym"))


def method_forms(spark, folder):
    """Spellings of each method that differ in case and spacing only."""
    m = _rows(spark, folder).filter(~C.is_empty(F.col("Synthesis_Method"))).select(squash(F.col("Synthesis_Method")).alias("m"))
    return m.groupBy(F.lower("m").alias("method")).agg(F.count("*").alias("n"), F.count_distinct("m").alias("spellings"))


QUERIES = {f.__name__: f for f in (
    sample_dimension, extraction_consensus, merged_rows, review_items, quantity_valid, quantity_majority, common_tokens, unique_ignoring_case, verdict_vote, pick_vote4, set_vote, none_vote, structure_vote, dominance, kind_majority,
    evidence_lookup, candidate_samples, candidate_samples_whole, main_dedup, catalogue_check, tag_union, dedupe_same, subset_elim, merge_reach, sentence_candidates, pair_promotion, property_pivot, run_length_rows, format_values, quarantine, manifest_skip,
    run_status, acronyms, method_forms,
)}
#: The same over the tags of all cells, however they are packed, of which the SQL splits a part.
QUERIES |= {f"{f.__name__}_whole": partial(f, whole=True) for f in (main_dedup, tag_union, property_pivot)}

_WS = "[ \\t\\n\\x0b\\f\\r]+"


def _sq(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}', ' ', 'g'))"


def _empty(c: str, ways: tuple = C.EMPTY_SYNTHESIS) -> str:
    return f"({c} IS NULL OR upper(trim({c})) IN ({', '.join(repr(w) for w in ways)}))"


_R = "SELECT * FROM letter_table WHERE doc_id IS NOT NULL"
_SIGQ = "regexp_replace(lower({}), '[^a-z0-9]+', '', 'g')"
_V = "SELECT l_orderkey AS item, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS vote_no, l_returnflag, l_linestatus, l_partkey, l_suppkey, l_quantity FROM lineitem"


def _consensus(columns: list[str]) -> str:
    return f"""WITH l AS (UNPIVOT (SELECT doc_id, CDs_Naming_in_Paper, row_uid, {', '.join(f"coalesce({c}, chr(1)) AS {c}" for c in columns)} FROM ({_R})) ON {', '.join(columns)} INTO NAME "column" VALUE v0),
 m AS (SELECT doc_id, CDs_Naming_in_Paper, row_uid, "column", nullif(v0, chr(1)) AS value FROM l),
 g AS (SELECT doc_id, CDs_Naming_in_Paper, "column", count(DISTINCT CASE WHEN NOT {_empty('value')} THEN lower({_sq('value')}) END) AS forms, count(*) FILTER ({_empty('value')}) AS empties, arg_min(value, row_uid) FILTER (NOT {_empty('value')}) AS first FROM m GROUP BY ALL),
 s AS (SELECT *, CASE WHEN forms = 0 THEN 'NA' WHEN forms = 1 AND empties = 0 THEN 'SAME' ELSE 'ARBITRATE' END AS status FROM g),
 c AS (SELECT doc_id, CDs_Naming_in_Paper, "column", CASE WHEN status = 'SAME' THEN first ELSE 'N/A' END AS value, status FROM s)"""


_MERGE = ["Synthesis_Method", "Temperature", "Time", "Solvent"]
_TAGS = "SELECT pdf_name, para_global_id, LLM_name, sent_global_id, sent_uid, unnest(regexp_split_to_array(LLM_props, '[;,|/]\\s*')) AS tag FROM decisions WHERE pdf_name IS NOT NULL"
_ORDERED = "CASE tag " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(PROPERTY_ORDER)) + " END"
_IN = ", ".join(f"'{t}'" for t in PROPERTY_ORDER)
ORACLE = {
    "sample_dimension": f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, CDs_Naming_in_Paper ORDER BY extraction_no, row_no, row_uid) AS k FROM ({_R}) WHERE NOT {_empty('CDs_Naming_in_Paper', C.EMPTY_PROPERTY)})
 SELECT doc_id, CDs_Naming_in_Paper AS sample, concat_ws('; ', {', '.join(f"CASE WHEN NOT {_empty(c, C.EMPTY_PROPERTY)} THEN '{l}' || trim({c}) END" for l, c in (('prepared by ', 'Synthesis_Method'), ('from ', 'Precursor'), ('in ', 'Solvent'), ('at ', 'Temperature'), ('for ', 'Time')))}) AS description FROM r WHERE k = 1""",
    "extraction_consensus": _consensus(["Synthesis_Method", "Temperature", "Time", "Microwave_Power", "Precursor", "Solvent", "Purification"]) + ' SELECT doc_id, CDs_Naming_in_Paper, "column", value, status FROM c',
    "merged_rows": _consensus(_MERGE) + " SELECT doc_id, CDs_Naming_in_Paper, " + ", ".join(f"max(value) FILTER (\"column\" = '{c}') AS {c}" for c in _MERGE) + " FROM c GROUP BY 1, 2",
    "review_items": _consensus(["Synthesis_Method", "Solvent"]) + " SELECT \"column\", status, count(*) AS items, count(DISTINCT doc_id) AS docs FROM c WHERE status <> 'SAME' GROUP BY 1, 2",
    "quantity_valid": f"SELECT row_uid, trim(Precursor_Amount) = 'N/A' OR regexp_matches(trim(Precursor_Amount), '^[^,;()]*\\([^()]*\\d[^()]*\\)(?:\\s*[,;]\\s*[^,;()]*\\([^()]*\\d[^()]*\\))*$') AS valid FROM ({_R}) WHERE trim(Precursor_Amount) <> ''",
    "quantity_majority": f"""WITH p AS (SELECT doc_id, CDs_Naming_in_Paper, extraction_no, row_no, row_uid, regexp_extract_all(Precursor_Amount, '([^,;()]*)\\(([^()]*\\d[^()]*)\\)') AS l FROM ({_R}) WHERE Precursor_Amount IS NOT NULL),
 q AS (SELECT p.*, i, l[i] AS part FROM p, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)), r AS (SELECT doc_id, CDs_Naming_in_Paper, lower({_sq("regexp_extract(part, '^([^(]*)\\(', 1)")}) AS subject, trim(regexp_extract(part, '\\(([^()]*)\\)$', 1)) AS number, row_number() OVER (PARTITION BY doc_id, CDs_Naming_in_Paper ORDER BY extraction_no, row_no, row_uid, i) AS tick FROM q),
 c AS (SELECT doc_id, CDs_Naming_in_Paper, subject, number, count(*) AS n FROM r GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, CDs_Naming_in_Paper, subject ORDER BY n DESC, number) AS k FROM c), f AS (SELECT doc_id, CDs_Naming_in_Paper, subject, min(tick) AS tick FROM r GROUP BY ALL)
 SELECT b.doc_id, b.CDs_Naming_in_Paper, string_agg(CASE WHEN b.subject = '' THEN '(' || number || ')' ELSE b.subject || ' (' || number || ')' END, ', ' ORDER BY b.subject = '', f.tick) AS merged FROM b JOIN f ON b.doc_id = f.doc_id AND b.CDs_Naming_in_Paper = f.CDs_Naming_in_Paper AND b.subject = f.subject WHERE k = 1 GROUP BY 1, 2""",
    "common_tokens": f"""WITH v AS (SELECT doc_id, CDs_Naming_in_Paper, row_uid, list_distinct(regexp_split_to_array(lower({_sq('Precursor')}), '[\\s,;]+')) AS l FROM ({_R}) WHERE CDs_Naming_in_Paper IS NOT NULL AND NOT {_empty('Precursor')}), n AS (SELECT doc_id, CDs_Naming_in_Paper, count(*) AS c FROM v GROUP BY 1, 2), t AS (SELECT doc_id, CDs_Naming_in_Paper, unnest(l) AS token FROM v)
 SELECT t.doc_id, t.CDs_Naming_in_Paper, token FROM t JOIN n ON t.doc_id = n.doc_id AND t.CDs_Naming_in_Paper = n.CDs_Naming_in_Paper WHERE token <> '' GROUP BY t.doc_id, t.CDs_Naming_in_Paper, token, c HAVING count(*) = c""",
    "unique_ignoring_case": f"SELECT doc_id, count(DISTINCT lower({_sq('Synthesis_Method')})) = 1 AS same FROM ({_R}) GROUP BY 1",
    "verdict_vote": f"""WITH v AS (SELECT item, CASE WHEN l_quantity > 2 THEN CASE l_returnflag WHEN 'A' THEN 'KEEP' WHEN 'N' THEN 'DROP' ELSE 'REWRITE' END END AS v FROM ({_V})), g AS (SELECT item, count(*) FILTER (v = 'KEEP') AS k, count(*) FILTER (v = 'DROP') AS d, count(*) FILTER (v = 'REWRITE') AS r FROM v GROUP BY 1)
 SELECT item, CASE WHEN greatest(k, d, r) >= 2 THEN CASE WHEN r = greatest(k, d, r) THEN 'REWRITE' WHEN d = greatest(k, d, r) THEN 'DROP' ELSE 'KEEP' END WHEN r > 0 THEN 'REWRITE' WHEN d > 0 THEN 'DROP' WHEN k > 0 THEN 'KEEP' ELSE 'DROP' END AS verdict, CASE WHEN greatest(k, d, r) >= 2 THEN 'majority' WHEN greatest(k, d, r) > 0 THEN 'priority' ELSE 'invalid' END AS how FROM g""",
    "pick_vote4": f"""WITH v AS (SELECT item, vote_no, CASE WHEN l_quantity > 3 THEN CAST(l_partkey % 3 + 1 AS INT) END AS pick FROM ({_V})), a AS (SELECT item, pick, count(*) AS n FROM v WHERE vote_no <= 3 AND pick IS NOT NULL GROUP BY 1, 2), b AS (SELECT item, pick, count(*) AS n FROM v WHERE vote_no <= 4 AND pick IS NOT NULL GROUP BY 1, 2),
 p3 AS (SELECT item, arg_min(pick, (-n, pick)) FILTER (n >= 2) AS p FROM a GROUP BY 1), p4 AS (SELECT item, arg_min(pick, (-n, pick)) FILTER (n >= 2) AS p FROM b GROUP BY 1), i AS (SELECT item, count(*) FILTER (vote_no <= 3 AND pick IS NOT NULL) AS valid FROM v GROUP BY 1)
 SELECT i.item, CASE WHEN valid < 2 THEN 1 ELSE coalesce(p3.p, p4.p, 1) END AS pick FROM i LEFT JOIN p3 ON p3.item = i.item LEFT JOIN p4 ON p4.item = i.item""",
    "set_vote": f"""WITH v AS (SELECT item, list_sort(list_distinct(CASE WHEN l_quantity > 25 THEN [l_partkey % 3, l_suppkey % 3] ELSE [l_partkey % 3] END)) AS ids FROM ({_V})), c AS (SELECT item, ids, count(*) AS votes FROM v GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY votes DESC, len(ids), ids) AS k, sum(votes) OVER (PARTITION BY item) AS t FROM c)
 SELECT item, array_to_string(ids, ',') AS ids, votes, CASE WHEN votes * 2 > t THEN 'majority' ELSE 'plurality' END AS how FROM r WHERE k = 1""",
    "none_vote": f"""WITH v AS (SELECT item, CASE WHEN l_returnflag <> 'N' THEN l_returnflag || ' ' || l_linestatus END AS s FROM ({_V})), c AS (SELECT item, lower({_sq('s')}) AS k, count(*) AS n, min(s) AS s FROM v WHERE s IS NOT NULL GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC, k) AS r FROM c), a AS (SELECT item, count(*) FILTER (s IS NULL) AS none, count(*) AS t FROM v GROUP BY 1)
 SELECT a.item, CASE WHEN none < coalesce(n, 0) THEN s END AS choice, CASE WHEN greatest(none, coalesce(n, 0)) * 2 > t THEN 'majority' ELSE 'plurality' END AS how FROM a LEFT JOIN b ON a.item = b.item AND r = 1""",
    "structure_vote": f"""WITH v AS (SELECT item, list_sort(list_distinct([l_partkey % 4, l_suppkey % 4])) AS s FROM ({_V})), c AS (SELECT item, s, count(*) AS n FROM v GROUP BY 1, 2), t AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC, len(s) DESC, s) AS k FROM c), r AS (SELECT item, arg_max(s, (len(s), s)) AS s FROM v GROUP BY 1)
 SELECT t.item, array_to_string(CASE WHEN n >= 2 THEN t.s ELSE r.s END, ',') AS structure FROM t JOIN r ON t.item = r.item WHERE k = 1""",
    "dominance": f"""WITH s AS (SELECT pdf_name, {_SIGQ.format('LLM_name')} AS sample, count(DISTINCT sent_global_id) AS n FROM decisions WHERE pdf_name IS NOT NULL AND coalesce(trim(LLM_name), '') <> '' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER w AS k, coalesce(lead(n) OVER w, 0) AS m FROM s WINDOW w AS (PARTITION BY pdf_name ORDER BY n DESC, sample)) SELECT pdf_name, sample, n AS evidence FROM r WHERE k = 1 AND n - m > 1""",
    "kind_majority": f"""WITH v AS ({_V}), c AS (SELECT item, l_returnflag, count(*) AS n FROM v GROUP BY 1, 2), m AS (SELECT *, max(n) OVER (PARTITION BY item) AS x FROM c), t AS (SELECT *, count(*) OVER (PARTITION BY item) AS z FROM m WHERE n = x)
 SELECT item, vote_no, l_returnflag FROM v WHERE EXISTS (SELECT 1 FROM t WHERE t.item = v.item AND (z > 1 OR t.l_returnflag = v.l_returnflag))""",
    "evidence_lookup": """WITH s AS (SELECT * FROM decisions WHERE pdf_name IS NOT NULL), t AS (SELECT pdf_name, sent_global_id AS sid, min(text) AS line FROM s GROUP BY 1, 2), w AS (SELECT sent_uid, pdf_name, unnest([sent_global_id - 1, sent_global_id, sent_global_id + 1]) AS sid FROM s WHERE window_level = 'SMALL')
 SELECT sent_uid, string_agg(line, ' ' ORDER BY w.sid) AS evidence FROM w JOIN t ON w.pdf_name = t.pdf_name AND w.sid = t.sid WHERE line IS NOT NULL AND trim(line) <> '' GROUP BY 1""",
    "candidate_samples": f"""WITH s AS (SELECT DISTINCT pdf_name, para_global_id, {_SIGQ.format('LLM_name')} AS sig FROM decisions WHERE pdf_name IS NOT NULL AND coalesce(trim(LLM_name), '') <> ''), n AS (SELECT doc_id, {_SIGQ.format('CDs_Naming_in_Paper')} AS sig, min(CDs_Naming_in_Paper) AS sample FROM ({_R}) WHERE NOT {_empty('CDs_Naming_in_Paper', C.EMPTY_PROPERTY)} GROUP BY 1, 2)
 SELECT pdf_name, para_global_id, sample FROM s JOIN n ON n.doc_id = s.pdf_name AND n.sig = s.sig""",
    "main_dedup": f"""WITH i AS (SELECT DISTINCT pdf_name, main_section_norm, LLM_name, unnest(string_split(coalesce(LLM_props, ''), ';')) AS tag FROM decisions WHERE pdf_name IS NOT NULL AND LLM_name IS NOT NULL), j AS (SELECT * FROM i WHERE tag <> '')
 SELECT pdf_name, LLM_name, tag, coalesce(main_section_norm, '') AS section FROM j WHERE coalesce(main_section_norm, '') <> 'results' AND NOT (tag IN ({', '.join(f"'{t}'" for t in UNIQUE_PROPERTIES)}) AND EXISTS (SELECT 1 FROM j m WHERE m.main_section_norm = 'results' AND m.pdf_name = j.pdf_name AND m.LLM_name = j.LLM_name AND m.tag = j.tag))""",
    "catalogue_check": "SELECT sent_uid, LLM_name FROM decisions WHERE LLM_name IN (SELECT name FROM sample_registry)",
    "tag_union": f"SELECT pdf_name, para_global_id, string_agg(tag, ';' ORDER BY {_ORDERED}) AS tags FROM (SELECT DISTINCT pdf_name, para_global_id, tag FROM ({_TAGS}) WHERE tag IN ({_IN})) GROUP BY 1, 2",
    "dedupe_same": f"SELECT min(row_uid) AS row_uid, count(*) AS copies FROM ({_R}) GROUP BY doc_id, extraction_no, row_no, {', '.join(TABLE_COLUMNS)} HAVING count(*) > 1",
    "subset_elim": f"""WITH v AS (SELECT item, vote_no, list_distinct(CASE WHEN vote_no % 2 = 0 THEN [l_partkey % 5] ELSE [l_partkey % 5, l_suppkey % 5] END) AS s FROM ({_V})) SELECT a.item, a.vote_no, min(b.vote_no) AS "into" FROM v a JOIN v b ON a.item = b.item AND len(a.s) < len(b.s) AND list_has_all(b.s, a.s) GROUP BY 1, 2""",
    "merge_reach": "SELECT p_partkey, CAST(1 AS BIGINT) AS target FROM part WHERE p_partkey > 1",
    "sentence_candidates": f"""WITH g AS (SELECT pdf_name, lower({_sq('text')}) AS k, min(sent_uid) AS first, count(*) AS n FROM decisions WHERE pdf_name IS NOT NULL AND coalesce(trim(text), '') <> '' GROUP BY 1, 2) SELECT pdf_name, first, n, row_number() OVER (PARTITION BY pdf_name ORDER BY first) AS candidate FROM g""",
    "pair_promotion": "WITH v AS (SELECT l_orderkey AS item, count(DISTINCT l_returnflag) > 1 AS two FROM lineitem GROUP BY 1) SELECT v.item, bool_or(two) OVER (PARTITION BY o_custkey) AS promoted FROM v JOIN orders ON o_orderkey = v.item",
    "property_pivot": f"SELECT pdf_name, LLM_name, " + ", ".join(f"coalesce(string_agg(CAST(sent_global_id AS VARCHAR), ';' ORDER BY sent_global_id, sent_uid) FILTER (tag = '{t}'), '') AS {t}" for t in PROPERTY_ORDER) + f" FROM ({_TAGS}) WHERE coalesce(trim(LLM_name), '') <> '' AND tag IN ({_IN}) GROUP BY 1, 2",
    "run_length_rows": """WITH s AS (SELECT *, CASE WHEN LLM_name = lag(LLM_name) OVER w THEN 0 ELSE 1 END AS c FROM decisions WHERE pdf_name IS NOT NULL AND LLM_name IS NOT NULL WINDOW w AS (PARTITION BY pdf_name ORDER BY sent_global_id, sent_uid)), r AS (SELECT *, sum(c) OVER (PARTITION BY pdf_name ORDER BY sent_global_id, sent_uid ROWS UNBOUNDED PRECEDING) AS run FROM s) SELECT pdf_name, CAST(run AS BIGINT) AS run, min(LLM_name) AS name, count(*) AS n FROM r GROUP BY 1, 2""",
    "format_values": "SELECT l_orderkey, l_linenumber, l_partkey, " + " || ".join(f"{a} || CASE WHEN abs({c} - round({c})) < 1e-12 THEN format('{{:.0f}}', {c}) ELSE regexp_replace(format('{{:.10f}}', {c}), '\\.?0+$', '') END || {b}" for a, c, b in (("''", "l_quantity", "' ns('"), ("''", "l_discount", "')'"))) + " AS shown FROM lineitem",
    "quarantine": "SELECT doc_id, 'no_property' AS reason FROM papers WHERE doc_id NOT IN (SELECT pdf_name FROM decisions WHERE coalesce(trim(LLM_props), '') <> '' AND pdf_name IS NOT NULL)",
    "manifest_skip": f"WITH e AS (SELECT doc_id, max(extracted_at) AS a FROM ({_R}) GROUP BY 1), d AS (SELECT paper_id AS doc_id, max(loaded_at) AS l FROM documents WHERE paper_id IS NOT NULL GROUP BY 1) SELECT d.doc_id FROM d LEFT JOIN e ON d.doc_id = e.doc_id WHERE a IS NULL OR a < l",
    "run_status": f"SELECT CASE WHEN doc_id IN (SELECT doc_id FROM ({_R})) THEN 'written' WHEN doc_id IN (SELECT pdf_name FROM decisions WHERE pdf_name IS NOT NULL) THEN 'skipped' ELSE 'missing' END AS status, count(*) AS papers FROM papers GROUP BY 1",
    "acronyms": f"SELECT v, NOT contains(v, ' ') AND length(regexp_replace(v, '[.\\-]', '', 'g')) BETWEEN 2 AND 12 AND regexp_matches(v, '[A-Za-z]') AS acronym FROM (SELECT DISTINCT unnest(regexp_split_to_array(coalesce(Solvent, ''), '[,;]\\s*')) AS v FROM ({_R})) WHERE v <> ''",
    "method_forms": f"SELECT lower(m) AS method, count(*) AS n, count(DISTINCT m) AS spellings FROM (SELECT {_sq('Synthesis_Method')} AS m FROM ({_R}) WHERE NOT {_empty('Synthesis_Method')}) GROUP BY 1",
}
#: The tags of all cells: whatever packs them, a tag is a word of its own.
_TAGS_WHOLE = _TAGS.replace("regexp_split_to_array(LLM_props, '[;,|/]\\s*')", f"regexp_extract_all(LLM_props, '\\b({'|'.join(PROPERTY_ORDER)})\\b')")
ORACLE |= {f"{n}_whole": ORACLE[n].replace(_TAGS, _TAGS_WHOLE) for n in ("tag_union", "property_pivot")}
ORACLE["main_dedup_whole"] = ORACLE["main_dedup"].replace("string_split(coalesce(LLM_props, ''), ';')", f"regexp_extract_all(coalesce(LLM_props, ''), '\\b({'|'.join(PROPERTY_ORDER)})\\b')")
ORACLE["candidate_samples_whole"] = f"""WITH s AS (SELECT DISTINCT pdf_name, para_global_id, nullif({_SIGQ.format("coalesce(LLM_name, '')")}, '') AS sig FROM decisions WHERE pdf_name IS NOT NULL), n AS (SELECT DISTINCT doc_id, {_SIGQ.format('CDs_Naming_in_Paper')} AS sig, CDs_Naming_in_Paper AS sample FROM ({_R}) WHERE NOT {_empty('CDs_Naming_in_Paper', C.EMPTY_PROPERTY)}),
 g AS (SELECT pdf_name, para_global_id, list_sort(list(sample) FILTER (sample IS NOT NULL)) AS l FROM s LEFT JOIN n ON n.doc_id = s.pdf_name AND n.sig = s.sig WHERE pdf_name IN (SELECT doc_id FROM n) GROUP BY 1, 2)
 SELECT pdf_name, para_global_id, CASE WHEN len(l) >= 2 THEN 'matched' ELSE 'all' END AS scope, CASE WHEN len(l) >= 2 THEN l END AS samples FROM g"""
