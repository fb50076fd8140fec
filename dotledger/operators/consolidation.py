"""Votes, merges, duplicates, conflicts and export: from repeated extractions to one row per sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dotledger.functions.rules import PROPERTY_ORDER
from dotledger.operators.ordered import framed, running_sum
from dotledger.operators.text_stages import squash

#: Ways of writing null; the synthesis tables know the first two only.
EMPTY_SYNTHESIS = ("", "N/A")
EMPTY_PROPERTY = ("", "N/A", "NA", "NONE", "NULL", "-", "--")


def is_empty(c: Column, ways: tuple[str, ...] = EMPTY_SYNTHESIS) -> Column:
    return c.isNull() | F.upper(F.trim(c)).isin(*ways)


def case_space_key(c: Column) -> Column:
    """Equal for values that differ in case and white space only."""
    return F.lower(squash(c))


def top_vote(df: DataFrame, keys: list[str], value: str, order: list[Column]) -> DataFrame:
    """The value with the most votes of each group, ties by `order`: rows (keys, value, votes). Votes are counted before the ranking, so a group's ranking sees distinct values only."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("votes"))
    return counted.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("votes"), *order))).filter("_r = 1").drop("_r")


def verdict_majority(df: DataFrame, item: str, verdict: str) -> DataFrame:
    """KEEP, DROP or REWRITE by at least two equal votes; else the first of REWRITE, DROP, KEEP that was voted; without a valid vote DROP."""
    n = lambda v: F.count_if(F.coalesce(F.col(verdict) == v, F.lit(False)))
    g = df.groupBy(item).agg(n("KEEP").alias("keep"), n("DROP").alias("drop_"), n("REWRITE").alias("rewrite"))
    top = F.greatest("keep", "drop_", "rewrite")
    pick = F.when(top >= 2, F.when(F.col("rewrite") == top, "REWRITE").when(F.col("drop_") == top, "DROP").otherwise("KEEP"))
    fallback = F.when(F.col("rewrite") > 0, "REWRITE").when(F.col("drop_") > 0, "DROP").when(F.col("keep") > 0, "KEEP").otherwise("DROP")
    return g.select(item, F.coalesce(pick, fallback).alias("verdict"), F.when(top >= 2, "majority").when(top > 0, "priority").otherwise("invalid").alias("how"))


def pick_majority(df: DataFrame, item: str, vote_no: str, pick: str) -> DataFrame:
    """The pick that two of the first three votes share; else with the fourth vote; else 1. Fewer than two valid votes give 1."""
    first = df.filter((F.col(vote_no) <= 3) & F.col(pick).isNotNull())
    pair = top_vote(first, [item], pick, [F.col(pick)]).filter("votes >= 2").select(item, F.col(pick).alias("p3"))
    four = top_vote(df.filter((F.col(vote_no) <= 4) & F.col(pick).isNotNull()), [item], pick, [F.col(pick)]).filter("votes >= 2").select(item, F.col(pick).alias("p4"))
    items = df.groupBy(item).agg(F.count_if((F.col(vote_no) <= 3) & F.col(pick).isNotNull()).alias("valid"))
    joined = items.join(pair, item, "left").join(four, item, "left")
    return joined.select(item, F.when(F.col("valid") < 2, F.lit(1)).otherwise(F.coalesce("p3", "p4", F.lit(1))).alias("pick"))


def vote_with_none(df: DataFrame, item: str, sentence: str) -> DataFrame:
    """The sentence most votes agree on, keyed without case and spacing; NONE wins if it has as many. Null votes count as NONE."""
    key = case_space_key(F.col(sentence))
    keyed = df.select(item, F.when(F.col(sentence).isNotNull(), key).alias("k"), sentence)
    counted = keyed.filter("k is not null").groupBy(item, "k").agg(F.count("*").alias("n"), F.min(sentence).alias("s"))
    best = counted.withColumn("_r", F.row_number().over(Window.partitionBy(item).orderBy(F.desc("n"), "k"))).filter("_r = 1")
    all_ = df.groupBy(item).agg(F.count_if(F.col(sentence).isNull()).alias("none"), F.count("*").alias("all"))
    j = all_.join(best, item, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    none = F.col("none") >= F.col("n")
    won = F.greatest("none", "n")
    return j.select(item, F.when(~none, F.col("s")).alias("choice"), F.when(won * 2 > F.col("all"), "majority").otherwise("plurality").alias("how"))


def set_majority(df: DataFrame, item: str, ids: str) -> DataFrame:
    """The set of ids with the most votes; a single id before a pair, then by order. Sets are compared sorted and without repeats."""
    keyed = df.filter(F.size(ids) > 0).select(item, F.array_sort(F.array_distinct(ids)).alias("ids"))
    counted = keyed.groupBy(item, "ids").agg(F.count("*").alias("votes"))
    total = F.sum("votes").over(Window.partitionBy(item))
    w = Window.partitionBy(item).orderBy(F.desc("votes"), F.size("ids"), "ids")
    return counted.withColumns({"_r": F.row_number().over(w), "_t": total}).filter("_r = 1").select(item, "ids", "votes", F.when(F.col("votes") * 2 > F.col("_t"), "majority").otherwise("plurality").alias("how"))


def dominant(df: DataFrame, group: list[str], candidate: str, evidence: str) -> DataFrame:
    """The candidate whose evidence leads the next by more than one; none for a group with a closer lead."""
    counted = df.groupBy(*group, candidate).agg(F.count_distinct(evidence).alias("n"))
    w = Window.partitionBy(*group).orderBy(F.desc("n"), candidate)
    ranked = counted.withColumns({"_r": F.row_number().over(w), "_n": F.coalesce(F.lead("n").over(w), F.lit(0))})
    return ranked.filter((F.col("_r") == 1) & (F.col("n") - F.col("_n") > 1)).select(*group, candidate, F.col("n").alias("evidence"))


def kind_majority(df: DataFrame, group: list[str], kind: str) -> DataFrame:
    """Rows whose kind is the group's only most frequent one; all rows of a group with a tie."""
    counted = df.groupBy(*group, kind).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*group)
    kept = counted.withColumn("_m", F.max("n").over(w)).filter("n = _m")
    kept = kept.withColumn("_t", F.count("*").over(w))
    tied = kept.filter("_t > 1").select(*group).distinct()
    single = kept.filter("_t = 1").select(*group, kind)
    return df.join(single, [*group, kind], "left_semi").unionByName(df.join(tied, group, "left_semi"))


def consensus(df: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """Rows (keys, column, value, status) of each text column over repeated extractions.

    All empty gives N/A with status NA; equal values, but for case and spacing, the first of them with status SAME; others N/A with
    status ARBITRATE, to be settled by a model or by hand. Unpivoted, so that one aggregation serves all columns.
    """
    long = df.select(*keys, order, F.expr("stack({}, {}) as (column, value)".format(len(columns), ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns))))
    empty = is_empty(F.col("value"))
    g = long.groupBy(*keys, "column").agg(
        F.count_distinct(F.when(~empty, case_space_key(F.col("value")))).alias("forms"), F.count_if(empty).alias("empties"), F.min(F.when(~empty, F.struct(order, "value"))).alias("first")
    )
    status = F.when(F.col("forms") == 0, "NA").when((F.col("forms") == 1) & (F.col("empties") == 0), "SAME").otherwise("ARBITRATE")
    return g.select(*keys, "column", F.when(status == "SAME", F.col("first.value")).otherwise("N/A").alias("value"), status.alias("status"))


def quantity_pairs(df: DataFrame, keys: list[str], cell: str, order: list[str]) -> DataFrame:
    """Rows (keys, subject, number, tick) of cells such as ``citric acid (1 g), urea (2 g)``."""
    parts = df.select(*keys, *order, F.posexplode(F.regexp_extract_all(F.col(cell), F.lit("([^,;()]*)\\(([^()]*\\d[^()]*)\\)"), 0)).alias("p", "part"))
    w = Window.partitionBy(*keys).orderBy(*order, "p")
    return parts.select(*keys, case_space_key(F.regexp_extract("part", "^([^(]*)\\(", 1)).alias("subject"), F.trim(F.regexp_extract("part", "\\(([^()]*)\\)$", 1)).alias("number"), F.row_number().over(w).alias("tick"))


def quantity_majority(df: DataFrame, keys: list[str], cell: str, order: list[str]) -> DataFrame:
    """Per group the most frequent number of each subject, ties by text, in the order in which subjects are first seen."""
    pairs = quantity_pairs(df, keys, cell, order)
    best = top_vote(pairs, [*keys, "subject"], "number", [F.col("number")])
    first = pairs.groupBy(*keys, "subject").agg(F.min("tick").alias("tick"))
    j = best.join(first, [*keys, "subject"])
    text = F.when(F.col("subject") == "", F.concat(F.lit("("), "number", F.lit(")"))).otherwise(F.concat("subject", F.lit(" ("), "number", F.lit(")")))
    item = F.struct((F.col("subject") == "").alias("z"), "tick", text.alias("x"))
    return j.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["x"]), ", ").alias("merged"))


def common_tokens(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Tokens that stand in every non-empty value of a group."""
    v = df.filter(~is_empty(F.col(value)))
    n = v.groupBy(*keys).agg(F.count("*").alias("values"))
    tokens = v.withColumn("_u", F.monotonically_increasing_id()).select(*keys, "_u", F.explode(F.array_distinct(F.split(F.lower(squash(F.col(value))), "[\\s,;]+"))).alias("token")).filter("token <> ''")
    return tokens.groupBy(*keys, "token").agg(F.count("*").alias("n")).join(n, keys).filter("n = values").select(*keys, "token")


def strict_subsets(df: DataFrame, group: list[str], entry: str, values: str) -> DataFrame:
    """Entries whose value set lies strictly within another of the group: rows (group, entry, into), the container with the least id.

    Sets meet over a shared value, so no group is paired with itself as a whole; sizes decide before sets are compared.
    """
    sets = df.select(*group, entry, F.array_sort(F.array_distinct(values)).alias("v")).filter("size(v) > 0")
    small = sets.select(*group, F.col(entry).alias("small"), F.col("v").alias("a"), F.element_at("v", 1).alias("x"))
    large = sets.select(*group, F.col(entry).alias("large"), F.col("v").alias("b"), F.explode("v").alias("x"))
    hit = small.join(large, [*group, "x"]).filter((F.size("a") < F.size("b")) & (F.size(F.array_except("a", "b")) == 0))
    return hit.groupBy(*group, F.col("small").alias(entry)).agg(F.min("large").alias("into"))


def merge_destinations(edges: DataFrame, child: str, parent: str, rounds: int = 6) -> DataFrame:
    """Where each entry ends after following drop-to-keep edges to the end: rows (child, target); a cycle ends somewhere on it.

    Each round doubles the steps taken. After `rounds` rounds it is looked whether targets still change; more rounds follow until none does or
    more steps are taken than there are edges, which only a cycle needs.
    """
    out = edges.select(F.col(child).alias("c"), F.col(parent).alias("p"))
    taken, most = 0, None
    while True:
        step = out.select(F.col("c").alias("p"), F.col("p").alias("q"))
        if taken >= rounds:
            if most is None:
                most = edges.count()
            if 2**taken > most or out.join(step, "p", "left_semi").isEmpty():
                break
        out = out.join(step, "p", "left").select("c", F.coalesce(F.when(F.col("q") != F.col("c"), F.col("q")), F.col("p")).alias("p"))
        taken += 1
    return out.select(F.col("c").alias(child), F.col("p").alias("target"))


def property_rank(tag: Column) -> Column:
    """The tag's place in the canonical order; unknown tags come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, PROPERTY_ORDER)), tag), F.lit(0)), F.lit(len(PROPERTY_ORDER) + 1))


def format_number(c: Column) -> Column:
    """Whole numbers without a point, others with at most ten decimals and no trailing zeros."""
    return F.when(F.abs(c - F.round(c)) < 1e-12, F.format_string("%.0f", c)).otherwise(F.regexp_replace(F.format_string("%.10f", c), "\\.?0+$", ""))


def run_rows(df: DataFrame, document: str, order: list[str], header: str) -> DataFrame:
    """Adds run: its number grows wherever the header changes along the document. `order` begins with a number."""
    seen = framed(df, [document], order, order[0], 1, lambda w: {"_b": F.lag(header).over(w), "_f": F.lag(F.lit(1)).over(w)})
    change = F.when(F.col(header).eqNullSafe(F.col("_b")) & F.col("_f").isNotNull(), 0).otherwise(1)
    return running_sum(seen, [document], order, order[0], {"run": change}).drop("_b", "_f")


def pivot_properties(df: DataFrame, keys: list[str], tag: str, value: str, order: list[str]) -> DataFrame:
    """One row per key with a column per property: its values in order, joined by semicolons."""
    item = F.struct(*order, F.col(value).alias("_x"))
    cells = {t: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(tag) == t, item))), lambda x: x["_x"]), ";") for t in PROPERTY_ORDER}
    return df.groupBy(*keys).agg(*(c.alias(t) for t, c in cells.items()))
