"""From documents to annotated sentences: sections, tails, sentences, units, keywords and neighbourhoods."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dotledger.functions import rules
from dotledger.operators.ordered import framed, join_safe, running_sum
from dotledger.plans.session import cut, ship_package


def squash(c: Column) -> Column:
    """One space for every run of white space, none outside."""
    return F.trim(F.regexp_replace(c, "\\s+", " "))


def matches(c: Column, pattern: str) -> Column:
    """Whether the pattern is found, in any case; false for null. Text and pattern are lowered, as Java's search without regard to case is slow."""
    lowered = re.sub(r"(\\.)|([A-Z])", lambda m: m[1] or m[2].lower(), pattern)
    return F.coalesce(F.lower(c).rlike(lowered), F.lit(False))


def fold_spaced_capitals(header: Column) -> Column:
    """``R E S U L T S`` as one word, if the whole heading is spelt so."""
    return F.when(F.trim(header).rlike("^(?:[A-Za-z]\\s+){2,}[A-Za-z]$"), F.regexp_replace(header, " ", "")).otherwise(header)


def classify_section(header: Column) -> Column:
    """The section that a heading opens; unknown for null, empty and other headings."""
    folded = fold_spaced_capitals(F.trim(F.coalesce(header, F.lit(""))))
    out = None
    for section, patterns in rules.SECTION_PATTERNS.items():
        hit = matches(folded, "|".join(f"(?:{p})" for p in patterns))
        out = F.when(hit, section) if out is None else out.when(hit, section)
    return out.otherwise("unknown")


def trim_tail(text: Column) -> Column:
    """Text before its tail: before the first tail heading, else the first mention, else the first tail word in the last quarter of its lines."""
    lines = F.split(text, "\n")
    n = F.size(lines)
    start = F.floor(n * F.lit(0.75)).cast("int")
    prefix = F.when(start > 0, F.concat(F.array_join(F.slice(lines, 1, F.greatest(start, F.lit(1))), "\n"), F.lit("\n"))).otherwise(F.lit(""))
    tail = F.array_join(F.slice(lines, start + 1, F.greatest(n - start, F.lit(1))), "\n")

    def before(t: Column, pattern: str) -> Column:
        return F.regexp_extract(t, f"^((?s).*?)(?:{pattern})", 1)

    return (
        F.when(text.rlike(rules.TAIL_HEADING), F.regexp_extract(text, f"(?s)^(.*?)(?={rules.TAIL_HEADING})", 1))
        .when(text.rlike(rules.TAIL_MENTION), before(text, rules.TAIL_MENTION))
        .when(tail.rlike(rules.TAIL_WORD), F.concat(prefix, before(tail, rules.TAIL_WORD)))
        .otherwise(text)
    )


def split_sentences(text: Column) -> Column:
    """Sentences by the plain rule: a break after a mark before white space and a capital or an opening bracket."""
    return F.split(F.regexp_replace(text, "([.?!;])\\s+([A-Z\\[(])", "$1\u0001$2"), "\u0001")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit("\\S+")).cast("bigint")


def keyword_flags(df: DataFrame, text: str) -> DataFrame:
    """One boolean column per keyword family of ``rules.KEYWORDS``."""
    return df.withColumns({k: matches(F.col(text), p) for k, p in rules.KEYWORDS.items()})


def annotate(df: DataFrame, document: list[str], paragraph: list[str], order: list[str], text: str, width: int = 1) -> DataFrame:
    """Adds kw_hits, units and cand_props: a property is a candidate where its keyword and a fitting unit stand within `width` sentences of the paragraph.

    A sentence of fewer than three words has no hits but lends its units and keywords to its neighbours. A null text counts as empty.
    The window is one shuffle by document and paragraph.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    units = {f"_u{k}": (u, matches(F.col("_t"), p)) for k, (u, p) in enumerate(rules.UNIT_MARKS.items())}
    marked = keyword_flags(df.withColumn("_t", body), "_t").withColumns({c: m for c, (_, m) in units.items()})
    marked = marked.withColumn("_long", F.regexp_count("_t", F.lit("[A-Za-z0-9]+")) >= 3).withColumn("_dep", F.col("exdep_pos") | F.col("exdep_neg")).drop("_t")
    unit_of = {u: F.col(c) for c, (u, _) in units.items()}
    marked = marked.withColumns({"_wave": unit_of["nm"] | unit_of["μm"], "_time": unit_of["ns"] | unit_of["μs"] | unit_of["ms"] | unit_of["s"]})
    near = Window.partitionBy(*document, *paragraph).orderBy(*order).rowsBetween(-width, width)
    seen = {c: F.max(c).over(near) for c in ("has_em", "has_ex", "has_qy", "has_lifetime", "_dep", "has_chiral", "has_cpl_core", "has_cpl_lum", "_wave", "_time")} | {"_percent": F.max(unit_of["%"]).over(near)}
    out = marked.withColumns({f"w{c}": x for c, x in seen.items()})
    own = (("CPL", "has_cpl_core"), ("Chiral", "has_chiral"), ("Em", "has_em"), ("Ex", "has_ex"), ("ExDep", "_dep"), ("QY", "has_qy"), ("lifetime", "has_lifetime"))
    seed = reduce(or_, [F.col(c) for _, c in own] + list(unit_of.values())) & F.col("_long")
    out = out.withColumn("_seed", seed)
    w = lambda c: F.col(f"w{c}")
    candidates = (
        ("CPL", w("has_cpl_core") & w("has_cpl_lum")), ("Chiral", w("has_chiral")), ("Em", w("has_em") & w("_wave")), ("Ex", w("has_ex") & w("_wave")), ("ExDep", w("_dep")), ("QY", w("has_qy") & w("_percent")), ("lifetime", w("has_lifetime") & w("_time")),
    )
    listed = lambda pairs, if_: F.concat_ws(";", *(F.when(F.col(if_) & c, F.lit(t)) for t, c in pairs))
    return out.select(
        *df.columns, listed([(t, F.col(c)) for t, c in own], "_long").alias("kw_hits"), listed(unit_of.items(), "_long").alias("units"), listed(candidates, "_seed").alias("props")
    )


def islands(df: DataFrame, document: list[str], order: list[str], member: Column, gap: int = 2) -> DataFrame:
    """Members with position and island number: a new island begins where more than `gap` rows lie between two members of a document."""
    w = Window.partitionBy(*document).orderBy(*order)
    placed = df.withColumn("pos", F.row_number().over(w)).filter(member)
    begins = F.when(F.col("pos") - F.lag("pos").over(w) <= gap + 1, 0).otherwise(1)
    return placed.withColumn("_b", begins).withColumn("island", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_b")


def near_rows(df: DataFrame, document: list[str], order: list[str], hit: Column, width: int, position: str) -> DataFrame:
    """Adds near: whether a hit lies within `width` rows. position: the number that rows are ordered by first."""
    marked = df.withColumn("_hit", hit)
    return framed(marked, document, order, position, width, lambda w: {"near": F.max("_hit").over(w.rowsBetween(-width, width))}).drop("_hit")


def section_quality(df: DataFrame, document: str, section: str, position: list[str]) -> DataFrame:
    """Per document: blocks, unknown ones at the head, middle and tail, and the first relative position of the main sections."""
    placed = df.select(document, *position, F.coalesce(section, F.lit("unknown")).alias("s"))
    placed = running_sum(placed, [document], position, position[0], {"_k": F.lit(1)})
    placed = join_safe(placed, df.groupBy(document).agg(F.count("*").alias("_n")), [document])
    placed = placed.withColumn("q", F.when(F.col("_n") > 1, (F.col("_k") - 1) / (F.col("_n") - 1)).otherwise(F.lit(0.0)))
    unknown = F.col("s") == "unknown"
    zones = (("head", F.col("q") <= 0.1), ("middle", (F.col("q") > 0.1) & (F.col("q") < 0.9)), ("tail", F.col("q") >= 0.9))
    share = lambda z: F.round(F.count_if(unknown & z) / F.greatest(F.count_if(z), F.lit(1)), 6)
    firsts = [F.round(F.min(F.when(F.col("s") == s, F.col("q"))), 6).alias(f"first_{s}") for s in ("introduction", "experimental", "results", "conclusion")]
    return placed.groupBy(document).agg(F.count("*").alias("blocks"), *(share(z).alias(f"unknown_{name}") for name, z in zones), *firsts)


def recall_patch(df: DataFrame, document: str, order: list[str], retain: str, section: str, header: str, text: str) -> DataFrame:
    """Adds patched, reason and kept: chunks outside the retained ones that describe a synthesis.

    Within one row of a methods chunk an anchor word is enough; elsewhere it needs a method word or a condition with a unit.
    """
    methods = (F.lower(F.trim(F.coalesce(section, F.lit("")))) == "methods") | matches(squash(F.coalesce(header, F.lit(""))), rules.METHODS_HEADER)
    marked = df.withColumn("_m", methods).withColumn("_x", squash(F.coalesce(text, F.lit(""))))
    marked = framed(marked, [document], order, order[0], 1, lambda w: {"_zone": F.max("_m").over(w.rowsBetween(-1, 1))})
    marked = marked.withColumns({"_a": matches(F.col("_x"), rules.ANCHOR), "_c": matches(F.col("_x"), rules.METHOD_CONTEXT) | matches(F.col("_x"), rules.CONDITION_UNIT)})
    reason = F.when(F.col(retain) == "YES", "").when(F.col("_zone") & F.col("_a"), "anchor_in_methods_zone").when(F.col("_a") & F.col("_c"), "keyword+context").otherwise("")
    out = marked.withColumn("reason", reason)
    return out.withColumns({"patched": F.when(F.col("reason") != "", "YES").otherwise("NO"), "kept": F.when((F.col(retain) == "YES") | (F.col("reason") != ""), "YES").otherwise("NO")}).drop("_m", "_x", "_zone", "_a", "_c")


def pack_chunks(df: DataFrame, document: str, group: list[str], order: list[str], tokens: str, limit: int = 150) -> DataFrame:
    """Adds chunk: consecutive rows of a document are packed into one chunk while their tokens stay within the limit and `group` doesn't change.

    The greedy choice of each row depends on those before it in its run of equal `group`, so every run is folded over its sorted rows as they
    stream by; runs are numbered and their chunks counted without gathering a document. `order` begins with a number.
    """
    ship_package(df.sparkSession)
    key = F.concat_ws("\u0001", *(F.coalesce(F.col(g).cast("string"), F.lit("")) for g in group))
    rows = df.select(document, *order, F.col(tokens).cast("bigint").alias(tokens), key.alias("_k"))
    rows = cut(framed(rows, [document], order, order[0], 1, lambda w: {"_b": F.lag("_k").over(w)}))  # what follows reads it twice
    rows = running_sum(rows, [document], order, order[0], {"_run": F.when(F.col("_k").eqNullSafe(F.col("_b")), 0).otherwise(1)}).drop("_k", "_b")
    sorted_rows = rows.repartition(document, "_run").sortWithinPartitions(document, "_run", *order)
    names = [document, *order, tokens, "_run"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, chunk, total = None, 0, 0
        for batch in batches:
            chunks = []
            for doc, no, n in zip(*(batch.column(names.index(c)).to_pylist() for c in (document, "_run", tokens))):
                if (doc, no) != run:
                    run, chunk, total = (doc, no), 1, n
                elif total + n <= limit:
                    total += n
                else:
                    chunk, total = chunk + 1, n
                chunks.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunks, pa.int64())], [*names, "_local"])

    types = dict(sorted_rows.dtypes)
    packed = cut(sorted_rows.select(*names).mapInArrow(fold, ", ".join([*(f"`{c}` {types[c]}" for c in names), "_local bigint"])))
    runs = running_sum(packed.groupBy(document, "_run").agg(F.max("_local").alias("_n")), [document], ["_run"], "_run", {"_sum": F.col("_n")})
    runs = runs.select(document, "_run", (F.col("_sum") - F.col("_n")).alias("_off"))
    return join_safe(packed, runs, [document, "_run"]).select(document, *order, tokens, (F.col("_local") + F.col("_off")).alias("chunk"))


def template_similarity(vectors: DataFrame, key: str, vector: str, templates: DataFrame, most_templates: int = 1000, max_over: float = 0.5, mean_over: float = 0.2) -> DataFrame:
    """Rows (key, max_similarity, mean_similarity, retain): cosine similarity with all templates.

    The templates, whose number is checked, become one literal array; every vector is compared with them where it lies.
    """
    rows = [r[0] for r in templates.select(vector).limit(most_templates + 1).collect()]
    if len(rows) > most_templates:
        raise ValueError(f"over {most_templates} templates")
    norm = lambda v: F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-12))
    wide = F.transform(vector, lambda x: x.cast("double"))
    units = [[x / max(1e-12, sum(y * y for y in r) ** 0.5) for x in map(float, r)] for r in rows]
    literal = F.array(*(F.array(*(F.lit(x) for x in r)) for r in units))
    base = vectors.select(key, wide.alias("v")).withColumn("n", norm(F.col("v")))
    each = F.transform(literal, lambda t: F.aggregate(F.zip_with("v", t, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x) / F.col("n"))
    scored = base.select(key, each.alias("s"))
    top, mean = F.array_max("s"), F.aggregate("s", F.lit(0.0), lambda a, x: a + x) / F.size("s")
    return scored.select(key, F.round(top, 6).alias("max_similarity"), F.round(mean, 6).alias("mean_similarity"), F.when((top > max_over) | (mean > mean_over), "YES").otherwise("NO").alias("retain"))


def ordered_text(df: DataFrame, keys: list[str], order: list[str], text: str, separator: str) -> DataFrame:
    """Rows (keys, text): the group's non-empty texts in order, joined. For groups of the size of a document."""
    item = F.struct(*order, F.col(text).alias("_x"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["_x"]), separator)
    return df.filter(F.col(text).isNotNull() & (F.trim(F.col(text)) != "")).groupBy(*keys).agg(joined.alias("text"))


#: The main sections in the order of an article.
SECTION_ORDER = ["abstract", "intro", "methods", "results_discussion", "conclusion"]


def stabilize_sections(df: DataFrame, document: str, order: list[str], section: str) -> DataFrame:
    """The rows with `section` repaired between the main sections of a document, in this order of rules:

    unknown between an introduction and the methods belongs to the introduction; everything but an abstract between methods and results to the
    methods, and between results and the next conclusion to the results; unknown between two sections that skip others, which the document lacks,
    to the later one; a document of unknown blocks only is an introduction. Null counts as unknown.
    """
    w = Window.partitionBy(document).orderBy(*order)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(document)
    s = F.col("_s")
    out = df.withColumn("_s", F.coalesce(F.col(section), F.lit("unknown"))).withColumn("_p", F.row_number().over(w))

    def between(d: DataFrame, left: str, right: str, unknown_only: bool) -> DataFrame:
        """The run of `left`, and what follows it up to the next other main section, if that is `right`."""
        main = F.when(s.isin(*SECTION_ORDER), s)
        last = F.last(main, True).over(before)
        d = d.withColumn("_l", last)
        other = F.when(main.isNotNull() & ~main.eqNullSafe(F.col("_l")), F.struct("_p", main.alias("m")))
        d = d.withColumn("_n", F.first(other, True).over(after))
        may = (s == "unknown") if unknown_only else ~s.isin("abstract", left)
        inside = (F.col("_l") == left) & (F.col("_n.m") == right) & may & ~s.isin(*SECTION_ORDER)
        return d.withColumn("_s", F.when(F.coalesce(inside, F.lit(False)), left).otherwise(s)).drop("_l", "_n")

    out = between(between(out, "intro", "methods", True), "methods", "results_discussion", False)
    at = lambda x: F.when(s == x, F.col("_p"))
    out = out.withColumns({"_r": F.max(at("results_discussion")).over(before), "_c": F.max(at("conclusion")).over(before), "_e": F.min(at("conclusion")).over(after)})
    within = (F.col("_r") > F.coalesce("_c", F.lit(0))) & F.col("_e").isNotNull() & ~s.isin("abstract", "conclusion")
    out = out.withColumn("_s", F.when(F.coalesce(within, F.lit(False)), "results_discussion").otherwise(s)).drop("_r", "_c", "_e")
    rank = F.array_position(F.array(*map(F.lit, SECTION_ORDER)), s).cast("int")
    change = s.isin(*SECTION_ORDER) & ~s.eqNullSafe(F.last(F.when(s.isin(*SECTION_ORDER), s), True).over(before))
    out = out.withColumn("_k", rank).withColumn("_a", F.when(change, F.struct("_p", "_k"))).withColumn("_all", F.array_sort(F.collect_list("_a").over(whole)))
    ranks = F.transform("_all", lambda a: a["_k"])
    p = F.col("_p")

    def jumps(left: Column) -> Column:
        skips = lambda r: (r["_p"] > p) & (r["_k"] > left["_k"] + 1) & ~F.exists(ranks, lambda x: (x > left["_k"]) & (x < r["_k"]) & (x > 1))
        return F.filter("_all", skips)

    target = F.try_element_at(F.flatten(F.transform(F.filter("_all", lambda a: a["_p"] < p), jumps)), F.lit(1))["_k"]
    named = F.try_element_at(F.array(*map(F.lit, SECTION_ORDER)), target)
    out = out.withColumn("_s", F.when((s == "unknown") & target.isNotNull(), named).otherwise(s))
    out = out.withColumn("_u", F.min(s == "unknown").over(whole)).withColumn("_s", F.when(F.col("_u"), "intro").otherwise(s))
    return out.withColumn(section, s).select(*df.columns)
