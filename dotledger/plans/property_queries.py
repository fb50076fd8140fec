"""Queries of the property stages: values and units of tagged sentences, their duplicates and evidence, samples and reviews; with the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import functions as F

from dotledger.functions import boundaries as B, measures as M
from dotledger.functions.rules import NUMERIC_PATTERNS, NUMERIC_PROPERTIES, PROPERTY_ORDER, TABLE_COLUMNS
from dotledger.operators import consolidation as C, structured as S
from dotledger.operators.packed import with_items
from dotledger.plans.consolidation_queries import _consensus, _empty, _R, _SIG, _SIGQ, _sq
from dotledger.plans.session import read_table

GROUP, PAPER = ["pdf_name", "sample", "tag"], ["pdf_name", "tag"]


def _items(spark, folder):
    """One row per property of a sentence with a text; sample is empty where none is named."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and text is not null")
    s = s.select("sent_uid", "pdf_name", F.coalesce("LLM_name", F.lit("")).alias("sample"), "para_global_id", "sent_global_id", "window_level", "main_section_norm", "text", "LLM_props")
    return with_items(s, "sent_uid", "LLM_props", "tag").drop("LLM_props").filter(F.col("tag").isin(*PROPERTY_ORDER)).distinct()


def _paragraphs(spark, folder):
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and text is not null")
    item = F.struct("sent_global_id", "sent_uid", "text")
    return s.groupBy("pdf_name", "para_global_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["text"]), " ").alias("evidence"))


def _with_evidence(spark, folder, items):
    p = _paragraphs(spark, folder).alias("p")
    i = items.alias("i")
    return i.join(p, (F.col("i.pdf_name") == F.col("p.pdf_name")) & F.col("i.para_global_id").eqNullSafe(F.col("p.para_global_id"))).select("i.*", "p.evidence")


def _valued(spark, folder):
    """Numeric items with the distinct numbers of their sentence that have a fitting unit; others are left out."""
    i = _items(spark, folder).filter(F.col("tag").isin(*NUMERIC_PROPERTIES))
    return i.withColumn("values", M.sentence_values(F.col("tag"), F.col("text"))).filter("size(values) > 0")


def _numbered(spark, folder):
    """Items with the distinct numbers of their sentence, whatever their unit; others are left out."""
    numbers = F.transform(F.regexp_extract_all("text", F.lit("[0-9]+(?:\\.[0-9]+)?"), 0), lambda x: x.cast("double"))
    return _items(spark, folder).filter(F.col("tag").isin(*NUMERIC_PROPERTIES)).withColumn("values", F.array_sort(F.array_distinct(numbers))).filter("size(values) > 0")


def number_units(spark, folder):
    """Numbers with their unit, bare numbers, and the units of every sentence."""
    s = read_table(spark, folder, "decisions").filter("text is not null")
    pairs = F.array_join(F.transform(M.number_units(F.col("text")), lambda x: F.concat(x["value"], F.lit(" "), x["unit"])), ";")
    return s.select("sent_uid", pairs.alias("pairs"), F.array_join(M.unit_mask(F.col("text")), ";").alias("units"))


def lifetime_units(spark, folder):
    """The unit of each lifetime, elected by its paragraph and sentence."""
    i = _with_evidence(spark, folder, _items(spark, folder).filter("tag = 'lifetime'"))
    return i.select("sent_uid", M.lifetime_unit(F.col("text"), F.col("evidence"), F.lit("Nanoseconds")).alias("unit"))


def unit_tokens(spark, folder):
    """Units of times in sentences, in any spelling, by their token."""
    s = read_table(spark, folder, "decisions").filter("text is not null")
    found = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[0-9] ?((?:nano|pico|micro|femto|milli)?seconds?|[fpnumµμ]?s)\\b"), 1))
    return s.select(found.alias("unit")).groupBy("unit").agg(F.count("*").alias("n")).select("unit", M.lifetime_token(F.col("unit")).alias("token"), "n")


def condition_axes(spark, folder):
    """Axes that sentences name in any way, each once and in order."""
    s = read_table(spark, folder, "decisions").filter("text is not null")
    words = F.regexp_extract_all(F.lower("text"), F.lit("\\b(ph|solvent|medium|state|phase|excitation wavelength|excitation|emission wavelength|emission|components?|tau)\\b"), 1)
    axes = F.array_distinct(F.transform(words, M.axis_name))
    return s.select("sent_uid", F.array_join(axes, ";").alias("axes")).filter("axes <> ''")


def percent_yields(spark, folder):
    """The first number of each yield's sentence as a hundredth part, made a percentage again by its paragraph, in both orders of looking."""
    i = _with_evidence(spark, folder, _items(spark, folder).filter("tag = 'QY'"))
    i = i.withColumn("v", F.regexp_extract("text", "[0-9]+(?:\\.[0-9]+)?", 0).try_cast("double") / 100).filter("v is not null")
    sentence = F.when(F.col("sent_global_id") % 2 == 0, F.col("text")).otherwise(F.translate("text", "%", ""))
    return i.select("sent_uid", *(F.round(M.percent_value(F.col("v"), sentence, F.col("evidence"), raw), 6).alias(n) for n, raw in (("percent", False), ("raw_first", True))))


def merge_checks(spark, folder):
    """Pairs of values of a sample's yields and lifetimes, said in one sentence with conditions, and what keeps it from standing for both."""
    v = _valued(spark, folder).filter("tag in ('QY', 'lifetime')")
    first = v.groupBy(*GROUP).agg(F.min(F.struct("sent_uid", "values", "text")).alias("a"), F.max(F.struct("sent_uid", "values", "text")).alias("b"))
    k = F.col("a.sent_uid")
    word = lambda shift: F.element_at(F.array(*(F.lit(x) for x in ("pH = ", "Em: ", "solvent=", "ex="))), ((k + shift) % 4 + 1).cast("int"))
    told = lambda shift, n: F.concat(F.lit(" ("), word(shift), (F.lit(4) + n).cast("string"), F.lit(".50 nm)"))
    sentence = F.concat("a.text", told(F.lit(0), k % 3), F.lit(" "), "b.text", told((k % 5 == 0).cast("bigint"), F.col("b.sent_uid") % 3))
    a, b = F.element_at("a.values", 1), F.element_at("b.values", 1)
    axis = M.single_axis(sentence)
    return first.select(*GROUP, axis["axis"].alias("axis"), F.array_join(F.array_sort(axis["values"]), ",").alias("conditions"), F.array_join(M.merge_errors(F.col("tag"), sentence, a, b), ";").alias("errors"))


def signatures(spark, folder):
    """What each numeric item is compared by."""
    unit = F.when(F.col("tag") == "QY", "%").when(F.col("tag") == "lifetime", M.lifetime_unit(F.col("text"), F.lit(None), F.lit(""))).otherwise("nm")
    return _valued(spark, folder).select("sent_uid", "tag", M.value_signature(F.col("tag"), F.col("values"), unit, F.lit(None)).alias("signature"))


def export_cells(spark, folder):
    """Values as the letter table shows them, with the temperature-like condition of the paragraph's number."""
    v = _valued(spark, folder)
    unit = F.when(F.col("tag") == "lifetime", M.lifetime_unit(F.col("text"), F.lit(None), F.lit(""))).otherwise("x")
    axis = F.element_at(F.array(*(F.lit(x) for x in ("", "emission", "pH", "Solvent"))), (F.col("sent_uid") % 4 + 1).cast("int"))
    conditions = F.transform(F.sequence(F.lit(1), (F.col("sent_uid") % 3 + 1).cast("int")), lambda x: (x * 10).cast("string"))
    conditions = F.when(F.col("sent_uid") % 5 == 0, F.array().cast("array<string>")).otherwise(conditions)
    return v.select("sent_uid", "tag", F.array_join(M.export_values(F.col("tag"), F.col("values"), unit, axis, conditions), ";").alias("cell"))


def same_sentences(spark, folder):
    """Items that say the same for the same evidence, as the first of them."""
    i = _with_evidence(spark, folder, _items(spark, folder))
    m = S.merge_same(i, ["pdf_name", "sample"], "tag", "sent_uid", "text", "evidence")
    return m.select("pdf_name", "sample", "tag", "sent_uid", "text", "copies", F.size("evidence").alias("evidences"))


def equal_structures(spark, folder):
    """Different sentences of a paper with equal values: the base entry and the sentence that stands for all."""
    v = _numbered(spark, folder).withColumn("key", F.concat_ws(",", F.transform("values", M.number_text)))
    return S.collapse_equal(v, PAPER, "key", "sent_uid", "text")


def picked_structures(spark, folder):
    """The same with picks: every sentence of the group votes for the place that its number tells."""
    v = _numbered(spark, folder).withColumn("key", F.concat_ws(",", F.transform("values", M.number_text)))
    picks = v.select(*PAPER, "key", (F.col("sent_uid") % 3 + 1).cast("int").alias("pick"))
    return S.collapse_equal(v, PAPER, "key", "sent_uid", "text", picks)


def value_subsets(spark, folder):
    """Items whose values lie strictly within those of another item of the paper."""
    return S.contained_values(_numbered(spark, folder), PAPER, "sent_uid", "values")


def struct_votes(spark, folder):
    """Structures of a paragraph's numeric items as votes: the numbers of a sentence, none for a sentence without a digit, invalid with one number."""
    i = _items(spark, folder).filter(F.col("tag").isin("QY", "lifetime") & F.col("para_global_id").isNotNull())
    rows = F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9]+"), 0))
    rows = F.when(F.col("sent_uid") % 7 == 0, F.lit(None)).when(F.col("sent_uid") % 3 == 0, F.array().cast("array<string>")).otherwise(rows)
    i = i.withColumns({"item": F.concat_ws("/", "pdf_name", F.col("para_global_id").cast("string")), "rows": rows})
    return S.struct_vote(i, "item", "rows").withColumn("rows", F.array_join("rows", ","))


def fallback_sides(spark, folder):
    """Side A or B of a sample's first and last item: structures are numbers in the sentence, evidence the paragraph's sentences."""
    i = _items(spark, folder)
    n = read_table(spark, folder, "decisions").groupBy("pdf_name", "para_global_id").agg(F.count("*").alias("n")).alias("n")
    i = i.alias("i").join(n, (F.col("i.pdf_name") == F.col("n.pdf_name")) & F.col("i.para_global_id").eqNullSafe(F.col("n.para_global_id"))).select("i.*", "n.n")
    g = i.groupBy(*GROUP).agg(F.min(F.struct("sent_uid", "text", "n")).alias("a"), F.max(F.struct("sent_uid", "text", "n")).alias("b"))
    has = lambda c: F.col(f"{c}.text").rlike("[0-9]")
    return g.select(*GROUP, S.fallback_side(has("a"), has("b"), F.col("a.n"), F.col("b.n")).alias("side"))


def candidate_order(spark, folder):
    """Items of a paper and sample in their order: paragraph, sentence, property, entry."""
    from pyspark.sql import Window

    w = Window.partitionBy("pdf_name", F.lower("sample")).orderBy(F.col("para_global_id").asc_nulls_first(), "sent_global_id", C.property_rank(F.col("tag")), "sent_uid", "sample")
    return _items(spark, folder).select("sent_uid", "tag", F.row_number().over(w).cast("bigint").alias("place"))


def paper_order(spark, folder):
    """Papers of a journal, numbers before other ids."""
    from pyspark.sql import Window

    p = read_table(spark, folder, "papers").withColumn("id", F.when(F.col("pub_year") % 3 == 0, F.concat(F.lit("x"), "doc_id")).otherwise(F.col("doc_id")))
    return p.select("doc_id", F.row_number().over(Window.partitionBy("journal").orderBy(*S.numeric_first(F.col("id")), "doc_id")).cast("bigint").alias("place"))


def seen_items(spark, folder):
    """Items once for each sample, paragraph, window, place, property and sentence; and work items once without the sentence."""
    key = ["pdf_name", "sample", "para_global_id", "window_level", "sent_global_id", "tag"]
    return _items(spark, folder).groupBy(*key, "text").agg(F.min("sent_uid").alias("sent_uid"), F.count("*").alias("copies")).select("sent_uid", "tag", "copies")


def work_items(spark, folder):
    key = ["pdf_name", "sample", "para_global_id", "window_level", "sent_global_id", "tag"]
    return _items(spark, folder).groupBy(*key).agg(F.min("sent_uid").alias("sent_uid")).select("sent_uid", "tag")


def source_union(spark, folder):
    """Main, application and comparison items with their kind, by what the sentence says, and how often each property has it."""
    i = _items(spark, folder)
    app, vs = (F.col("text").rlike(p) for p in ("(?i)sensing|imaging|detection", "(?i)compared|contrast|than that"))
    parts = [i.filter(f).withColumn("source_kind", F.lit(k)) for k, f in (("main", ~app & ~vs), ("app", app), ("vs", vs))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("sent_uid", "tag", "source_kind")


def tag_partition(spark, folder):
    """Properties that a sentence was a candidate for first, the rest second, each in the canonical order."""
    s = read_table(spark, folder, "decisions")
    order = F.array(*map(F.lit, PROPERTY_ORDER))
    hinted = F.array_distinct(F.regexp_extract_all(F.coalesce("cand_props", F.lit("")), F.lit(f"\\b({'|'.join(PROPERTY_ORDER)})\\b"), 1))
    return s.select("sent_uid", F.array_join(F.array_intersect(order, hinted), ";").alias("primary_tags"), F.array_join(F.array_except(order, hinted), ";").alias("secondary_tags"))


def prompt_parts(spark, folder):
    """What prompts take of a document: its first 20,000 characters, and 60 characters on each side of its first bracket, of the left side the last line of 80."""
    d = read_table(spark, folder, "documents").filter("text is not null")
    at = F.instr("text", "(")
    left = F.substring_index(F.substr("text", F.greatest(at - 80, F.lit(1)), F.least(at - 1, F.lit(80))), "\n", -1)
    around = F.substr("text", F.greatest(at - 60, F.lit(1)), at - F.greatest(at - 60, F.lit(1)) + 61)
    return d.select("doc_id", F.md5(F.left("text", F.lit(20_000))).alias("head"), F.when(at > 0, around).alias("around"), F.when(at > 0, left).alias("left_piece"))


def first_source(spark, folder):
    """The first stage that has rows of a paper: extraction, chunks, sentences; extraction for a paper without any."""
    p = read_table(spark, folder, "papers").select("doc_id").distinct()
    for k, (t, c) in enumerate((("letter_table", "doc_id"), ("cos_tokenize", "pdf_name"), ("decisions", "pdf_name"))):
        p = p.join(read_table(spark, folder, t).select(F.col(c).alias("doc_id")).distinct().withColumn(f"s{k}", F.lit(t)), "doc_id", "left")
    return p.select("doc_id", F.coalesce("s0", "s1", "s2", F.lit("letter_table")).alias("source"))


def sentence_names(spark, folder):
    """Names and text of every sentence id of a paper; merged names before single ones."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null and sent_global_id is not null")
    names = F.coalesce(F.nullif(F.trim("merge_LLM_name"), F.lit("")), F.nullif(F.trim("LLM_name"), F.lit("")))
    return s.groupBy("pdf_name", "sent_global_id").agg(F.min_by(names, "sent_uid").alias("names"), F.min_by("text", "sent_uid").alias("text"))


def decision_view(spark, folder):
    """Lines of the decision file: sentences with a decision only, with names and properties."""
    s = read_table(spark, folder, "decisions").filter("coalesce(trim(LLM_props), '') <> ''")
    line = F.format_string("[%s] (%d) %s | props: %s | names: %s", F.coalesce("main_section_norm", F.lit("unknown")), F.coalesce("sent_global_id", F.lit(0)), F.coalesce("text", F.lit("")), "LLM_props", F.coalesce("LLM_name", F.lit("")))
    return s.select("sent_uid", line.alias("line"))


def evidence_recovered(spark, folder):
    """Evidence of the candidates' windows from the sentences, else from the chunk's stored text, with what is missing."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null")
    w = s.filter("window_level is not null").select("sent_uid", "pdf_name", F.when(F.col("sent_uid") % 11 != 0, F.array(*(F.col("sent_global_id") + k for k in (1, -1, 0, 1)))).alias("sids"), F.when(F.col("sent_uid") % 2 == 0, F.col("text")).alias("stored"))
    known = s.filter("sent_global_id % 4 = 0")  # a table that lost sentences
    return S.recovered_evidence(w, ["sent_uid"], "sids", "stored", "pdf_name", known, "sent_global_id", "text")


def review_rows(spark, folder):
    """Rows of every cell that no rule settles, with the value they hold."""
    r = read_table(spark, folder, "letter_table").filter("doc_id is not null")
    c = C.consensus(r, ["doc_id", "CDs_Naming_in_Paper"], ["Synthesis_Method", "Solvent", "Time"], "row_uid").filter("status = 'ARBITRATE'").alias("c")
    r = r.alias("r")
    j = r.join(c, (F.col("r.doc_id") == F.col("c.doc_id")) & F.col("r.CDs_Naming_in_Paper").eqNullSafe(F.col("c.CDs_Naming_in_Paper")))
    value = F.when(F.col("c.column") == "Time", F.col("r.Time")).when(F.col("c.column") == "Solvent", F.col("r.Solvent")).otherwise(F.col("r.Synthesis_Method"))
    return j.select("r.row_uid", F.col("c.column").alias("column"), value.alias("current"))


def conflict_patch(spark, folder):
    """Solvents after the conflicts of a sample were settled by its most frequent value, in every row of the sample."""
    r = read_table(spark, folder, "letter_table").filter("doc_id is not null and CDs_Naming_in_Paper is not null")
    chosen = C.top_vote(r.filter(~C.is_empty(F.col("Solvent"))), ["doc_id", "CDs_Naming_in_Paper"], "Solvent", [F.col("Solvent")]).select("doc_id", "CDs_Naming_in_Paper", F.col("Solvent").alias("chosen"))
    return r.join(chosen, ["doc_id", "CDs_Naming_in_Paper"], "left").select("row_uid", F.coalesce("chosen", "Solvent").alias("Solvent"))


def acronym_pool(spark, folder):
    """Tokens of a paper's solvents: acronyms, those that all rows of a sample share (common), and the pool of other tokens that an acronym may mean."""
    r = read_table(spark, folder, "letter_table").filter("doc_id is not null")
    common = C.common_tokens(r.filter("CDs_Naming_in_Paper is not null"), ["doc_id", "CDs_Naming_in_Paper"], "Solvent").select("doc_id", "token").distinct().withColumn("shared", F.lit(True))
    tokens = r.filter(~C.is_empty(F.col("Solvent"))).select("doc_id", F.explode(F.split(F.lower(C.squash(F.col("Solvent"))), "[\\s,;]+")).alias("token")).filter("token <> ''").distinct()
    bare = F.regexp_replace("token", "[.\\-]", "")
    acronym = F.length(bare).between(2, 12) & F.col("token").rlike("[A-Za-z]") & F.col("token").rlike("^[a-z]{2,4}$")
    return tokens.join(common, ["doc_id", "token"], "left").select("doc_id", "token", F.when(acronym & F.col("shared"), "common").when(acronym, "acronym").otherwise("pool").alias("role"))


def _ok(c: str):
    return ~C.is_empty(_bare(c))


def _bare(c: str):
    """A cell without white space of any kind around it."""
    return F.regexp_replace(c, "^[\\s\\p{Z}]+|[\\s\\p{Z}]+$", "")


def sample_texts(spark, folder):
    """Samples described in a sentence, as the synthesis stages do it, without the columns under review, and as the property stages do."""
    r = read_table(spark, folder, "letter_table")
    part = lambda label, c, end="": F.when(_ok(c), F.concat(F.lit(label), _bare(c), F.lit(end)))
    usable = [c for c in TABLE_COLUMNS[1:]]
    chemistry = F.nullif(F.concat_ws(", ", part("using ", "Precursor"), part("with precursor amount ", "Precursor_Amount"), part("in ", "Solvent"), part("solvent volume ", "Solvent_Volume")), F.lit(""))
    conditions = F.nullif(F.concat_ws(" ", part("at ", "Temperature"), part("for ", "Time")), F.lit(""))
    named = F.when(_ok("CDs_Naming_in_Paper"), F.concat(_bare("CDs_Naming_in_Paper"), F.lit(" was synthesized"))).otherwise("The carbon dots were synthesized")
    stop = lambda x: F.when(x.endswith("."), x).otherwise(F.concat(x, F.lit(".")))
    whole = stop(F.concat_ws(" ", named, part("via ", "Synthesis_Method"), chemistry, conditions))
    masked = stop(F.concat_ws(" ", named, chemistry))
    subject = F.when(_ok("CDs_Naming_in_Paper"), F.concat(F.lit('Carbon dots labeled "'), _bare("CDs_Naming_in_Paper"), F.lit('"'))).otherwise("The carbon dots")
    method = F.when(_ok("Synthesis_Method"), F.concat(F.when(F.lower("Synthesis_Method").rlike("\\b(?:method|route|process|approach)\\b"), "using ").otherwise("by "), _bare("Synthesis_Method")))
    circumstances = F.nullif(F.concat_ws(", ", part("at ", "Temperature"), part("for ", "Time"), part("under microwave power ", "Microwave_Power")), F.lit(""))
    full = F.concat_ws(" ", F.concat(subject, F.lit(" were synthesized")), method, part("from ", "Precursor"), part("with precursor amount ", "Precursor_Amount"), part("in ", "Solvent"), part("(solvent volume ", "Solvent_Volume", ")"), circumstances, part("and purified by ", "Purification"))
    bare = F.concat(subject, F.lit(" were prepared; the table has no details of its preparation."))
    return r.select("row_uid", whole.alias("synthesis"), masked.alias("without"), F.when(F.coalesce(*(F.when(_ok(c), F.lit(True)) for c in usable)), stop(full)).otherwise(bare).alias("property"))


def chirality_told(spark, folder):
    """Chirality by the sentence of each chiral item, then by its paragraph, and whether the sample's name has a marker."""
    i = _with_evidence(spark, folder, _items(spark, folder).filter("tag in ('Chiral', 'CPL')"))
    return i.select("sent_uid", "tag", M.chirality(F.col("text"), F.col("evidence"), F.concat_ws(" ", "tag", F.lit("not"))).alias("chiral"), M.chiral_name(F.col("sample")).alias("marked"))


def image_evidence(spark, folder):
    """Evidence of figures, which a stored image's path makes unusable unless a table was read from it."""
    s = read_table(spark, folder, "decisions")
    path = F.when(F.coalesce("is_figure", F.lit(False)), F.concat(F.lit("![](images/"), F.col("sent_uid").cast("string"), F.when(F.col("sent_uid") % 2 == 0, ".JPG) TABLE_FROM_IMAGE ").otherwise(".png) "))).otherwise("")
    return s.select("sent_uid", M.image_only(F.concat(path, F.coalesce("text", F.lit("")))).alias("unusable"))


def retained_gate(spark, folder):
    """Decisions of chunks: only retained ones are asked about; the others are NO."""
    c = read_table(spark, folder, "cos_tokenize")
    retained = F.coalesce(F.col("token_count") > 60, F.lit(False))
    answer = F.concat(F.lit("<think>x</think> "), F.when(F.lower("text").contains("heated"), "Yes").otherwise("no"))
    from dotledger.functions.answers import strip_thinking, yes_no

    asked = c.filter(retained).select("chunk_uid", yes_no(strip_thinking(answer)).alias("decision"))
    return asked.unionByName(c.filter(~retained).select("chunk_uid", F.lit("NO").alias("decision")))


def hinted_samples(spark, folder):
    """Samples that the other sections of a paper name, by their signature, two or more, with the named sample before them if it isn't among them."""
    s = read_table(spark, folder, "decisions").filter("pdf_name is not null")
    named = s.filter("coalesce(trim(LLM_name), '') <> ''").select("sent_uid", "pdf_name", F.coalesce("main_section_norm", F.lit("")).alias("section"), _SIG(F.col("LLM_name")).alias("sig"))
    samples = F.broadcast(read_table(spark, folder, "sample_registry").groupBy(_SIG(F.col("name")).alias("sig")).agg(F.min("name").alias("sample")).filter("sig <> ''"))  # a fixed list
    # A paper's samples with the sections that name them: not more than the list has.
    seen = named.select("pdf_name", "sig", "section").distinct().join(samples, "sig").groupBy("pdf_name", "sample").agg(F.collect_set("section").alias("sections"))
    seen = seen.groupBy("pdf_name").agg(F.array_sort(F.collect_list(F.struct("sample", "sections"))).alias("seen"))
    found = F.transform(F.filter("seen", lambda x: F.exists(x["sections"], lambda y: y != F.col("section"))), lambda x: x["sample"])
    j = named.join(seen, "pdf_name").withColumn("found", found).filter("size(found) >= 2").join(samples, "sig", "left")
    lead = F.when(F.col("sample").isNotNull() & ~F.array_contains("found", F.col("sample")), F.concat(F.array("sample"), F.col("found"))).otherwise(F.col("found"))
    return j.select("sent_uid", F.array_join(lead, " | ").alias("samples"))


QUERIES = {f.__name__: f for f in (
    number_units, lifetime_units, unit_tokens, condition_axes, percent_yields, merge_checks, signatures, export_cells, same_sentences, equal_structures, picked_structures, value_subsets, struct_votes, fallback_sides, candidate_order, paper_order, seen_items, work_items,
    source_union, tag_partition, prompt_parts, first_source, sentence_names, decision_view, evidence_recovered, review_rows, conflict_patch, acronym_pool, sample_texts, chirality_told, image_evidence, retained_gate, hinted_samples,
)}

_q = lambda x: x.replace("'", "''")
_TAG = "\\b(" + "|".join(PROPERTY_ORDER) + ")\\b"
_NUM = ", ".join(f"'{t}'" for t in NUMERIC_PROPERTIES)
_I = f"(SELECT DISTINCT sent_uid, pdf_name, coalesce(LLM_name, '') AS sample, para_global_id, sent_global_id, window_level, main_section_norm, text, unnest(regexp_extract_all(LLM_props, '{_TAG}')) AS tag FROM decisions WHERE pdf_name IS NOT NULL AND text IS NOT NULL)"
_P = "(SELECT pdf_name, para_global_id, string_agg(text, ' ' ORDER BY sent_global_id, sent_uid) AS evidence FROM decisions WHERE pdf_name IS NOT NULL AND text IS NOT NULL GROUP BY 1, 2)"
_IE = f"(SELECT i.*, evidence FROM {_I} i JOIN {_P} p ON i.pdf_name = p.pdf_name AND i.para_global_id IS NOT DISTINCT FROM p.para_global_id)"
# RE2's word boundaries know ASCII only.
_END = "(?:[^\\pL\\pN_]|$)"
_VALUES = "CASE tag " + " ".join(f"WHEN '{t}' THEN regexp_extract_all(lower(text), '{p.replace('(?:fs|ps|ns|us|ms|s)', '(?:fs|ps|ns|us|µs|μs|ms|s)').replace(chr(92) + 'b', _END)}', 1)" for t, p in NUMERIC_PATTERNS.items()) + " END"
_V = f"(SELECT * FROM (SELECT *, list_sort(list_distinct(list_transform({_VALUES}, lambda x: CAST(x AS DOUBLE)))) AS vals FROM {_I} WHERE tag IN ({_NUM})) WHERE len(vals) > 0)"
_N = f"(SELECT * FROM (SELECT *, list_sort(list_distinct(list_transform(regexp_extract_all(text, '[0-9]+(?:\\.[0-9]+)?'), lambda x: CAST(x AS DOUBLE)))) AS vals FROM {_I} WHERE tag IN ({_NUM})) WHERE len(vals) > 0)"
_TOKEN = lambda c: "CASE lower(trim({0})) ".format(c) + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in M.LIFETIME_UNITS.items()) + " ELSE lower(trim({0})) END".format(c)
_NUMTEXT = lambda c: f"CASE WHEN abs({c} - round({c})) < 1e-12 THEN format('{{:.0f}}', {c}) ELSE regexp_replace(format('{{:.10f}}', {c}), '\\.?0+$', '') END"


def _elected(text: str, key: str, source: str, told: str) -> str:
    """Rows (key, unit): the unit that most lifetimes of a text have."""
    units = f"(SELECT {key}, regexp_extract_all({text}, '(?i){M.LIFETIME_VALUE}', 1) AS l FROM {source})"
    each = f"(SELECT {key}, i, {_TOKEN('l[i]')} AS u FROM {units}, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i))"
    return f"SELECT s.{key}, coalesce(u, '{told}') AS unit FROM {source} s LEFT JOIN (SELECT {key}, arg_min(u, (-n, f)) AS u FROM (SELECT {key}, u, count(*) AS n, min(i) AS f FROM {each} GROUP BY 1, 2) GROUP BY 1) e ON e.{key} = s.{key}"


def _percent(raw_first: bool) -> str:
    near = lambda v, gap: f"len(list_filter(st, lambda x: abs(x - {v}) <= {gap})) > 0"
    a, b = f"WHEN {near('v * 100', 1e-4)} THEN v * 100", f"WHEN {near('v', 1e-6)} THEN v"
    return f"round(CASE WHEN contains(sentence, '%') OR v >= 1 THEN v {b if raw_first else a + ' ' + b} ELSE v * 100 END, 6)"


_SENT = "a.text || ' (' || ws[1 + a.sent_uid % 4] || CAST(4 + a.sent_uid % 3 AS VARCHAR) || '.50 nm) ' || b.text || ' (' || ws[1 + (a.sent_uid + CASE WHEN a.sent_uid % 5 = 0 THEN 1 ELSE 0 END) % 4] || CAST(4 + b.sent_uid % 3 AS VARCHAR) || '.50 nm)'"


def _conditions(axis: str) -> str:
    found = f"regexp_extract_all(lower(s), '{M.CONDITIONS[axis]}', 1)"
    clean = "trim(regexp_replace(x, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'))" if axis == "solvent" else "regexp_replace(regexp_replace(x, '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '')"
    return f"(SELECT list(DISTINCT y) FROM (SELECT unnest(list_filter(list_transform({found}, lambda x: {clean}), lambda x: x <> '')) AS y))"


_PAIRS = [
    (r"(?i)\b([0-9]{1,4}(?:\.[0-9]+)?)\s*[-–—]\s*([0-9]{1,4}(?:\.[0-9]+)?)\s*nm(?:[^A-Za-z]|$)", "nm"), (r"(?i)\b([0-9]{1,4}(?:\.[0-9]+)?)\s*nm\b", "nm"),
]
_KEY = "array_to_string(list_transform(vals, lambda x: " + _NUMTEXT("x") + "), ',')"
_EQ = f"""WITH v AS (SELECT *, {_KEY} AS key FROM {_N}), w AS (SELECT *, row_number() OVER (PARTITION BY pdf_name, tag, key ORDER BY sent_uid) AS i FROM v), g AS (SELECT pdf_name, tag, key, min(sent_uid) AS sent_uid, arg_max(i, (length(trim(text)), -i)) AS best, count(*) AS members FROM w GROUP BY ALL HAVING count(DISTINCT lower({_sq('text')})) > 1)"""
_GJ = " AND ".join(f"{{0}}.{c} = {{1}}.{c}" for c in (*PAPER, "key"))
_OKQ = lambda c: f"NOT {_empty(c)}"
_PART = lambda label, c, end="": f"CASE WHEN {_OKQ(c)} THEN '{label}' || trim({c}) || '{end}' END"
_STOP = lambda x: f"(SELECT CASE WHEN ends_with(z, '.') THEN z ELSE z || '.' END FROM (SELECT {x} AS z))"
_CHEM = f"nullif(concat_ws(', ', {_PART('using ', 'Precursor')}, {_PART('with precursor amount ', 'Precursor_Amount')}, {_PART('in ', 'Solvent')}, {_PART('solvent volume ', 'Solvent_Volume')}), '')"
_NAMED = f"CASE WHEN {_OKQ('CDs_Naming_in_Paper')} THEN trim(CDs_Naming_in_Paper) || ' was synthesized' ELSE 'The carbon dots were synthesized' END"
_SUBJECT = f"CASE WHEN {_OKQ('CDs_Naming_in_Paper')} THEN 'Carbon dots labeled \"' || trim(CDs_Naming_in_Paper) || '\"' ELSE 'The carbon dots' END"
_LETTERS = f"SELECT * FROM ({_R}) WHERE CDs_Naming_in_Paper IS NOT NULL"
_SAMPLES = f"SELECT {_SIGQ.format('name')} AS sig, min(name) AS sample FROM sample_registry GROUP BY 1 HAVING sig <> ''"
ORACLE = {
    "lifetime_units": _elected("evidence || ' ' || chr(10) || text", "sent_uid", f"(SELECT * FROM {_IE} WHERE tag = 'lifetime')", "ns"),
    "unit_tokens": f"SELECT unit, {_TOKEN('unit')} AS token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[0-9] ?((?:nano|pico|micro|femto|milli)?seconds?|[fpnumµμ]?s)\\b', 1)) AS unit FROM decisions WHERE text IS NOT NULL) GROUP BY 1, 2",
    "condition_axes": "WITH w AS (SELECT sent_uid, regexp_extract_all(regexp_replace(lower(text), '([^\\pL\\pN_])', '\\1\\1', 'g'), '(?:^|[^\\pL\\pN_])(ph|solvent|medium|state|phase|excitation  wavelength|excitation|emission  wavelength|emission|components?|tau)(?:[^\\pL\\pN_]|$)', 1) AS l FROM decisions WHERE text IS NOT NULL), m AS (SELECT sent_uid, i, CASE l[i] WHEN 'ph' THEN 'pH' WHEN 'medium' THEN 'solvent' WHEN 'state' THEN 'solvent' WHEN 'phase' THEN 'solvent' WHEN 'excitation' THEN 'Ex' WHEN 'excitation  wavelength' THEN 'Ex' WHEN 'emission' THEN 'Em' WHEN 'emission  wavelength' THEN 'Em' WHEN 'components' THEN 'component' WHEN 'tau' THEN 'component' ELSE l[i] END AS a FROM w, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)) SELECT sent_uid, string_agg(a, ';' ORDER BY f) AS axes FROM (SELECT sent_uid, a, min(i) AS f FROM m GROUP BY 1, 2) GROUP BY 1",
    "percent_yields": f"""WITH i AS (SELECT *, TRY_CAST(nullif(regexp_extract(text, '[0-9]+(?:\\.[0-9]+)?'), '') AS DOUBLE) / 100 AS v, CASE WHEN sent_global_id % 2 = 0 THEN text ELSE replace(text, '%', '') END AS sentence, list_transform(regexp_extract_all(evidence, '(?i){M.PERCENT}', 1), lambda x: CAST(x AS DOUBLE)) AS st FROM {_IE} WHERE tag = 'QY') SELECT sent_uid, {_percent(False)} AS percent, {_percent(True)} AS raw_first FROM i WHERE v IS NOT NULL""",
    "merge_checks": f"""WITH v AS (SELECT * FROM {_V} WHERE tag IN ('QY', 'lifetime')), e AS (SELECT pdf_name, sample, tag, min(sent_uid) AS ua, max(sent_uid) AS ub FROM v GROUP BY 1, 2, 3),
 p AS (SELECT e.pdf_name, e.sample, e.tag, {_SENT} AS s, a.vals[1] AS va, b.vals[1] AS vb FROM e JOIN v a ON a.sent_uid = ua AND a.tag = e.tag JOIN v b ON b.sent_uid = ub AND b.tag = e.tag, (SELECT ['pH = ', 'Em: ', 'solvent=', 'ex='] AS ws)),
 x AS (SELECT *, list_filter([{', '.join(f"struct_pack(a := '{a}', l := list_distinct(list_filter(list_transform(regexp_extract_all(lower(s), '{M.CONDITIONS[a]}', 1), lambda x: {chr(116) + chr(114) + chr(105) + chr(109) + '(x)' if a == 'solvent' else "regexp_replace(regexp_replace(x, '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '')"}), lambda x: x <> '')))" for a in M.CONDITIONS)}], lambda z: len(z.l) >= 2) AS able, list_distinct(list_transform({_VALUES.replace('lower(text)', 'lower(s)')}, lambda x: CAST(x AS DOUBLE))) AS tv FROM p),
 y AS (SELECT *, CASE WHEN len(able) = 1 THEN able[1].a END AS axis, CASE WHEN len(able) = 1 THEN able[1].l END AS l FROM x)
 SELECT pdf_name, sample, tag, axis, array_to_string(list_sort(l), ',') AS conditions, concat_ws(';', CASE WHEN axis IS NULL THEN 'NO_SINGLE_EXPLICIT_CONDITION_AXIS' END, CASE WHEN len(tv) < 2 THEN 'VAL_LT2:' || len(tv) END, CASE WHEN coalesce(len(l), 0) < 2 THEN 'COND_LT2:' || coalesce(len(l), 0) END, CASE WHEN abs(va - vb) < 1e-12 THEN 'A_B_ORIG_VALUES_EQUAL' END) AS errors FROM y""",
    "signatures": f"WITH u AS ({_elected('text', 'sent_uid', f'(SELECT * FROM {_V} WHERE tag = {chr(39)}lifetime{chr(39)})', '')}) SELECT v.sent_uid, tag, 'values=[' || array_to_string(list_transform(vals, lambda x: {_NUMTEXT('x')}), ', ') || ']; unit=' || CASE tag WHEN 'QY' THEN '%' WHEN 'lifetime' THEN unit ELSE 'nm' END AS signature FROM {_V} v LEFT JOIN u ON u.sent_uid = v.sent_uid",
    "export_cells": f"""WITH u AS ({_elected('text', 'sent_uid', f'(SELECT * FROM {_V} WHERE tag = {chr(39)}lifetime{chr(39)})', '')}), x AS (SELECT v.sent_uid, tag, list_transform(vals, lambda x: {_NUMTEXT('x')}) AS n, CASE tag WHEN 'QY' THEN '%' WHEN 'lifetime' THEN ' ' || unit ELSE ' nm' END AS un, ['', 'Em', 'pH', 'solvent'][1 + v.sent_uid % 4] AS ax, CASE WHEN v.sent_uid % 5 = 0 THEN [] ELSE list_transform(range(1, 2 + v.sent_uid % 3), lambda k: CAST(k * 10 AS VARCHAR) || CASE WHEN v.sent_uid % 4 = 1 THEN ' nm' ELSE '' END) END AS c FROM {_V} v LEFT JOIN u ON u.sent_uid = v.sent_uid)
 SELECT sent_uid, tag, array_to_string(list_transform(n, lambda y, k: y || un || CASE WHEN ax = '' THEN '' WHEN len(c) = 0 THEN '(' || ax || ')' WHEN len(c) = len(n) THEN '(' || ax || ':' || c[k] || ')' WHEN len(n) = 1 THEN '(' || ax || ':' || array_to_string(c, ',') || ')' ELSE '(' || ax || ':' || c[1] || ')' END), ';') AS cell FROM x""",
    "same_sentences": f"SELECT pdf_name, sample, tag, min(sent_uid) AS sent_uid, arg_min(text, sent_uid) AS text, count(*) AS copies, CAST(count(DISTINCT evidence) AS INT) AS evidences FROM (SELECT *, lower({_sq('text')}) AS k, CASE WHEN tag IN ('QY', 'lifetime') AND {_sq('evidence')} <> '' THEN lower({_sq('evidence')}) ELSE '#' || sent_uid END AS e FROM {_IE}) GROUP BY pdf_name, sample, tag, k, e",
    "equal_structures": _EQ + " SELECT pdf_name, tag, key, sent_uid, CAST(best AS INT) AS chosen, members FROM g",
    "picked_structures": _EQ + f", c AS (SELECT pdf_name, tag, key, CAST(sent_uid % 3 + 1 AS INT) AS pick, count(*) AS n FROM v GROUP BY ALL HAVING count(*) >= 2), t AS (SELECT pdf_name, tag, key, arg_min(pick, (-n, pick)) AS p FROM c GROUP BY ALL) SELECT g.pdf_name, g.tag, g.key, sent_uid, CASE WHEN p BETWEEN 1 AND members THEN p ELSE CAST(best AS INT) END AS chosen, members FROM g LEFT JOIN t ON {_GJ.format('g', 't')}",
    "value_subsets": f"""WITH v AS (SELECT * FROM {_N}), h AS (SELECT a.pdf_name, a.tag, a.sent_uid AS s, b.sent_uid AS l FROM v a JOIN v b ON a.pdf_name = b.pdf_name AND a.tag = b.tag AND len(a.vals) < len(b.vals) AND list_has_all(b.vals, a.vals))
 SELECT pdf_name, tag, s AS sent_uid, min(l) AS "into" FROM h WHERE l > s OR NOT EXISTS (SELECT 1 FROM h k WHERE k.pdf_name = h.pdf_name AND k.tag = h.tag AND k.s = h.l) GROUP BY 1, 2, 3""",
    "struct_votes": f"""WITH i AS (SELECT pdf_name || '/' || para_global_id AS item, CASE WHEN sent_uid % 7 = 0 THEN NULL WHEN sent_uid % 3 = 0 THEN [] ELSE list_sort(list_distinct(regexp_extract_all(text, '[0-9]+'))) END AS r FROM {_I} WHERE tag IN ('QY', 'lifetime') AND para_global_id IS NOT NULL), n AS (SELECT item, count(*) FILTER (len(r) = 0) AS none FROM i GROUP BY 1), c AS (SELECT item, r, count(*) AS n FROM i WHERE len(r) >= 2 GROUP BY 1, 2), b AS (SELECT item, arg_min(r, (-n, r)) AS r, max(n) AS n FROM c GROUP BY 1)
 SELECT n.item, CASE WHEN b.n IS NOT NULL AND (none = 0 OR none < b.n) THEN array_to_string(r, ',') END AS rows, CASE WHEN b.n IS NOT NULL AND (none = 0 OR none < b.n) THEN CASE WHEN b.n >= 2 THEN 'LLM_MAJORITY' ELSE 'LLM_PLURALITY' END WHEN none > 1 THEN 'NONE_MAJORITY_OR_TIE' WHEN none = 1 THEN 'NONE_SINGLE' ELSE 'NO_VALID_STRUCT' END AS how FROM n LEFT JOIN b ON b.item = n.item""",
    "fallback_sides": f"""WITH c AS (SELECT pdf_name, para_global_id, count(*) AS n FROM decisions WHERE pdf_name IS NOT NULL GROUP BY 1, 2), i AS (SELECT i.*, n, regexp_matches(text, '[0-9]') AS h FROM {_I} i JOIN c ON c.pdf_name = i.pdf_name AND c.para_global_id IS NOT DISTINCT FROM i.para_global_id), g AS (SELECT pdf_name, sample, tag, arg_min(h, sent_uid) AS ha, arg_min(n, sent_uid) AS na, arg_max(h, sent_uid) AS hb, arg_max(n, sent_uid) AS nb FROM i GROUP BY 1, 2, 3)
 SELECT pdf_name, sample, tag, CASE WHEN ha AND NOT hb THEN 'A' WHEN hb AND NOT ha THEN 'B' WHEN nb > na THEN 'B' ELSE 'A' END AS side FROM g""",
    "candidate_order": f"SELECT sent_uid, tag, row_number() OVER (PARTITION BY pdf_name, lower(sample) ORDER BY para_global_id NULLS FIRST, sent_global_id NULLS FIRST, list_position({PROPERTY_ORDER!r}, tag), sent_uid, sample) AS place FROM {_I}",
    "paper_order": "WITH p AS (SELECT *, CASE WHEN pub_year % 3 = 0 THEN 'x' || doc_id ELSE doc_id END AS id FROM papers) SELECT doc_id, row_number() OVER (PARTITION BY journal ORDER BY TRY_CAST(id AS BIGINT) IS NULL, TRY_CAST(id AS BIGINT) NULLS LAST, id, doc_id) AS place FROM p",
    "seen_items": f"SELECT min(sent_uid) AS sent_uid, tag, count(*) AS copies FROM {_I} GROUP BY pdf_name, sample, para_global_id, window_level, sent_global_id, tag, text",
    "work_items": f"SELECT min(sent_uid) AS sent_uid, tag FROM {_I} GROUP BY pdf_name, sample, para_global_id, window_level, sent_global_id, tag",
    "source_union": f"SELECT sent_uid, tag, kind AS source_kind FROM (SELECT sent_uid, tag, unnest(list_filter([CASE WHEN a THEN 'app' END, CASE WHEN v THEN 'vs' END, CASE WHEN NOT a AND NOT v THEN 'main' END], lambda x: x IS NOT NULL)) AS kind FROM (SELECT *, regexp_matches(text, '(?i)sensing|imaging|detection') AS a, regexp_matches(text, '(?i)compared|contrast|than that') AS v FROM {_I}))",
    "tag_partition": f"SELECT sent_uid, array_to_string(list_filter({PROPERTY_ORDER!r}, lambda t: list_contains(h, t)), ';') AS primary_tags, array_to_string(list_filter({PROPERTY_ORDER!r}, lambda t: NOT list_contains(h, t)), ';') AS secondary_tags FROM (SELECT sent_uid, regexp_extract_all(coalesce(cand_props, ''), '{_TAG}') AS h FROM decisions)",
    "prompt_parts": "WITH d AS (SELECT doc_id, text, instr(text, '(') AS p FROM documents WHERE text IS NOT NULL) SELECT doc_id, md5(substring(text, 1, 20000)) AS head, CASE WHEN p > 0 THEN substring(text, greatest(p - 60, 1), p - greatest(p - 60, 1) + 61) END AS around, CASE WHEN p > 0 THEN string_split(substring(text, greatest(p - 80, 1), least(p - 1, 80)), chr(10))[-1] END AS left_piece FROM d",
    "first_source": "SELECT DISTINCT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM letter_table) THEN 'letter_table' WHEN doc_id IN (SELECT pdf_name FROM cos_tokenize) THEN 'cos_tokenize' WHEN doc_id IN (SELECT pdf_name FROM decisions) THEN 'decisions' ELSE 'letter_table' END AS source FROM papers",
    "sentence_names": "SELECT DISTINCT ON (pdf_name, sent_global_id) pdf_name, sent_global_id, coalesce(nullif(trim(merge_LLM_name), ''), nullif(trim(LLM_name), '')) AS names, text FROM decisions WHERE pdf_name IS NOT NULL AND sent_global_id IS NOT NULL ORDER BY pdf_name, sent_global_id, sent_uid",
    "decision_view": "SELECT sent_uid, '[' || coalesce(main_section_norm, 'unknown') || '] (' || coalesce(sent_global_id, 0) || ') ' || coalesce(text, '') || ' | props: ' || LLM_props || ' | names: ' || coalesce(LLM_name, '') AS line FROM decisions WHERE coalesce(trim(LLM_props), '') <> ''",
    "evidence_recovered": """WITH s AS (SELECT * FROM decisions WHERE pdf_name IS NOT NULL), k AS (SELECT pdf_name, sent_global_id AS sid, max(trim(text)) AS t FROM s WHERE sent_global_id % 4 = 0 GROUP BY 1, 2 HAVING max(trim(text)) <> ''), w AS (SELECT sent_uid, pdf_name, CASE WHEN sent_uid % 11 <> 0 THEN [sent_global_id + 1, sent_global_id - 1, sent_global_id] ELSE [] END AS ids, CASE WHEN sent_uid % 2 = 0 THEN trim(coalesce(text, '')) ELSE '' END AS f FROM s WHERE window_level IS NOT NULL),
 e AS (SELECT sent_uid, i, ids[i] AS sid, t FROM w, LATERAL (SELECT unnest(range(1, len(ids) + 1)) AS i) LEFT JOIN k ON k.pdf_name = w.pdf_name AND k.sid = ids[i]), g AS (SELECT sent_uid, string_agg(t, ' ' ORDER BY i) AS x, string_agg(CASE WHEN t IS NULL THEN CAST(sid AS VARCHAR) END, ',' ORDER BY i) AS m FROM e GROUP BY 1), j AS (SELECT w.*, coalesce(x, '') AS x, coalesce(m, '') AS m FROM w LEFT JOIN g ON g.sent_uid = w.sent_uid)
 SELECT sent_uid, CASE WHEN x <> '' THEN x WHEN f <> '' THEN f WHEN len(ids) > 0 THEN '(evidence unavailable; sids=' || array_to_string(ids, ',') || ')' ELSE '(evidence unavailable)' END AS evidence, CASE WHEN x <> '' THEN 'decision_csv' WHEN f <> '' THEN 'markdown' ELSE 'placeholder' END AS source, CASE WHEN x <> '' THEN 'OK_CSV_SIDS' WHEN f <> '' THEN 'FALLBACK_MARKDOWN' WHEN len(ids) > 0 THEN 'PLACEHOLDER_SIDS_RECOVER_FAILED' ELSE 'PLACEHOLDER_EMPTY' END AS status, CASE WHEN x <> '' THEN m ELSE '' END AS missing FROM j""",
    "review_rows": _consensus(["Synthesis_Method", "Solvent", "Time"]) + f" SELECT r.row_uid, c.\"column\", CASE c.\"column\" WHEN 'Time' THEN r.Time WHEN 'Solvent' THEN r.Solvent ELSE r.Synthesis_Method END AS current FROM ({_R}) r JOIN c ON c.doc_id = r.doc_id AND c.CDs_Naming_in_Paper IS NOT DISTINCT FROM r.CDs_Naming_in_Paper WHERE c.status = 'ARBITRATE'",
    "conflict_patch": f"WITH r AS ({_LETTERS}), n AS (SELECT doc_id, CDs_Naming_in_Paper AS s, Solvent, count(*) AS n FROM r WHERE NOT {_empty('Solvent')} GROUP BY ALL), b AS (SELECT doc_id, s, arg_min(Solvent, (-n, Solvent)) AS chosen FROM n GROUP BY ALL) SELECT row_uid, coalesce(chosen, Solvent) AS Solvent FROM r LEFT JOIN b ON b.doc_id = r.doc_id AND b.s = r.CDs_Naming_in_Paper",
    "acronym_pool": f"""WITH v AS (SELECT doc_id, CDs_Naming_in_Paper AS s, row_uid, list_distinct(regexp_split_to_array(lower({_sq('Solvent')}), '[\\s,;]+')) AS l FROM ({_R}) WHERE NOT {_empty('Solvent')}), n AS (SELECT doc_id, s, count(*) AS c FROM v WHERE s IS NOT NULL GROUP BY 1, 2), t AS (SELECT doc_id, s, unnest(l) AS token FROM v), h AS (SELECT DISTINCT t.doc_id, token FROM t JOIN n ON t.doc_id = n.doc_id AND t.s = n.s GROUP BY t.doc_id, t.s, token, c HAVING count(*) = c)
 SELECT doc_id, token, CASE WHEN NOT regexp_matches(token, '^[a-z]{{2,4}}$') THEN 'pool' WHEN EXISTS (SELECT 1 FROM h WHERE h.doc_id = x.doc_id AND h.token = x.token) THEN 'common' ELSE 'acronym' END AS role FROM (SELECT DISTINCT doc_id, token FROM t WHERE token <> '') x""",
    "sample_texts": f"""SELECT row_uid, {_STOP(f"concat_ws(' ', {_NAMED}, {_PART('via ', 'Synthesis_Method')}, {_CHEM}, nullif(concat_ws(' ', {_PART('at ', 'Temperature')}, {_PART('for ', 'Time')}), ''))")} AS synthesis, {_STOP(f"concat_ws(' ', {_NAMED}, {_CHEM})")} AS without,
 CASE WHEN {' OR '.join(_OKQ(c) for c in TABLE_COLUMNS[1:])} THEN {_STOP(f"concat_ws(' ', {_SUBJECT} || ' were synthesized', CASE WHEN {_OKQ('Synthesis_Method')} THEN CASE WHEN regexp_matches(lower(Synthesis_Method), '{chr(92)}b(?:method|route|process|approach){chr(92)}b') THEN 'using ' ELSE 'by ' END || trim(Synthesis_Method) END, {_PART('from ', 'Precursor')}, {_PART('with precursor amount ', 'Precursor_Amount')}, {_PART('in ', 'Solvent')}, {_PART('(solvent volume ', 'Solvent_Volume', ')')}, nullif(concat_ws(', ', {_PART('at ', 'Temperature')}, {_PART('for ', 'Time')}, {_PART('under microwave power ', 'Microwave_Power')}), ''), {_PART('and purified by ', 'Purification')})")} ELSE {_SUBJECT} || ' were prepared; the table has no details of its preparation.' END AS property FROM letter_table""",
    "chirality_told": f"SELECT sent_uid, tag, coalesce({', '.join(f'CASE WHEN regexp_matches(lower({c}), {chr(39)}{M.ACHIRAL}{chr(39)}) THEN false WHEN regexp_matches(lower({c}), {chr(39)}{M.CHIRAL}{chr(39)}) THEN true END' for c in ('text', 'evidence', chr(40) + 'tag || ' + chr(39) + ' not' + chr(39) + chr(41)))}) AS chiral, regexp_matches(sample, '(?i)(?:^|[^A-Za-z0-9])[LD]\\s*-\\s*[A-Za-z0-9]|(?:^|[^A-Za-z0-9])[LD]\\s*-?\\s*/\\s*[LD]\\s*-?') AS marked FROM {_IE} WHERE tag IN ('Chiral', 'CPL')",
    "image_evidence": "SELECT sent_uid, (coalesce(is_figure, false) OR contains(x, '![](images') OR contains(x, 'images/') OR contains(x, '.jpg')) AND NOT ((coalesce(is_figure, false) AND sent_uid % 2 = 0) OR contains(x, 'table_from_image')) AS unusable FROM (SELECT *, lower(coalesce(text, '')) AS x FROM decisions)",
    "retained_gate": "SELECT chunk_uid, CASE WHEN coalesce(token_count > 60, false) AND contains(lower(coalesce(text, '')), 'heated') THEN 'YES' ELSE 'NO' END AS decision FROM cos_tokenize",
    "hinted_samples": f"""WITH n AS (SELECT sent_uid, pdf_name, coalesce(main_section_norm, '') AS sec, {_SIGQ.format('LLM_name')} AS sig FROM decisions WHERE pdf_name IS NOT NULL AND coalesce(trim(LLM_name), '') <> ''), m AS ({_SAMPLES}), d AS (SELECT DISTINCT n.pdf_name, sec, m.sample FROM n JOIN m ON m.sig = n.sig), f AS (SELECT n.sent_uid, list_sort(list(DISTINCT d.sample)) AS found FROM n JOIN d ON d.pdf_name = n.pdf_name AND d.sec <> n.sec GROUP BY 1 HAVING count(DISTINCT d.sample) >= 2)
 SELECT n.sent_uid, array_to_string(CASE WHEN m.sample IS NOT NULL AND NOT list_contains(found, m.sample) THEN list_prepend(m.sample, found) ELSE found END, ' | ') AS samples FROM n JOIN f ON f.sent_uid = n.sent_uid LEFT JOIN m ON m.sig = n.sig""",
}
