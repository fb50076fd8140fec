"""Structured values of sentences: duplicates, containment, votes and evidence. Rows are entries; groups are a paper's sample and property."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dotledger.operators.consolidation import case_space_key
from dotledger.operators.ordered import join_safe

#: Properties whose sentence is the same only if its evidence is.
NEEDS_EVIDENCE = ("QY", "lifetime")


def merge_same(df: DataFrame, group: list[str], tag: str, entry: str, sentence: str, evidence: str) -> DataFrame:
    """Rows (group, tag, entry, sentence, copies, evidence): sentences that are equal without case and spacing, as the entry with the least id, with the
    distinct evidence of all. Only yields and lifetimes with equal evidence are the same; entries of other properties all stay."""
    same = F.when(F.col(tag).isin(*NEEDS_EVIDENCE), F.nullif(case_space_key(F.coalesce(F.col(evidence), F.lit(""))), F.lit("")))
    keyed = df.withColumns({"_k": case_space_key(F.col(sentence)), "_e": F.coalesce(same, F.concat(F.lit("#"), F.col(entry).cast("string")))})
    first = F.min(F.struct(entry, sentence))
    out = keyed.groupBy(*group, tag, "_k", "_e").agg(first.alias("f"), F.count("*").alias("copies"), F.array_sort(F.collect_set(evidence)).alias(evidence))
    return out.select(*group, tag, F.col("f")[entry].alias(entry), F.col("f")[sentence].alias(sentence), "copies", evidence)


def collapse_equal(df: DataFrame, group: list[str], key: str, entry: str, sentence: str, picks: DataFrame | None = None) -> DataFrame:
    """Rows (group, key, entry, chosen, members) of the entries with equal values but different sentences: the one with the least id stands for all,
    with the sentence of `chosen`: the place (by id, from 1) that at least two picks (group, key, pick) name, the least of equals; else the longest sentence."""
    w = Window.partitionBy(*group, key).orderBy(entry)
    placed = df.withColumn("_i", F.row_number().over(w))
    longest = F.max(F.struct(F.length(F.trim(sentence)).alias("n"), (-F.col("_i")).alias("i")))
    g = placed.groupBy(*group, key).agg(F.min(entry).alias(entry), longest.alias("l"), F.count("*").alias("members"), F.count_distinct(case_space_key(F.col(sentence))).alias("_forms")).filter("_forms > 1")
    g = g.withColumn("chosen", (-F.col("l.i")).cast("int"))
    if picks is not None:
        top = picks.filter("pick is not null").groupBy(*group, key, "pick").agg(F.count("*").alias("n")).filter("n >= 2")
        top = top.groupBy(*group, key).agg(F.min(F.struct((-F.col("n")).alias("n"), "pick")).alias("p")).select(*group, key, F.col("p.pick").alias("_p"))
        g = join_safe(g, top, [*group, key], "left").withColumn("chosen", F.coalesce(F.when(F.col("_p").between(1, F.col("members")), F.col("_p")), "chosen"))
    return g.select(*group, key, entry, "chosen", "members")


def contained_values(df: DataFrame, group: list[str], entry: str, values: str) -> DataFrame:
    """Entries whose value set lies strictly within another of the group: rows (group, entry, into).

    Entries are judged in the order of their ids; into is the first container that isn't dropped itself by then. Sets meet over the value of the
    smaller one that the fewest entries of the group have, so that a frequent value pairs nothing but sets that consist of frequent values.
    """
    sets = df.select(*group, F.col(entry).alias("_e"), F.array_sort(F.array_distinct(values)).alias("_v")).filter("size(_v) > 0")
    each = sets.select("*", F.explode("_v").alias("_x"))
    often = each.groupBy(*group, "_x").agg(F.count("*").alias("_n"))
    rare = join_safe(each, often, [*group, "_x"]).groupBy(*group, "_e", "_v").agg(F.min(F.struct("_n", "_x")).alias("r"))
    small = rare.select(*group, F.col("_e").alias("_small"), F.col("_v").alias("_a"), F.col("r._x").alias("_x"))
    large = each.select(*group, F.col("_e").alias("_large"), F.col("_v").alias("_b"), "_x")
    hit = join_safe(small, large, [*group, "_x"]).filter((F.size("_a") < F.size("_b")) & (F.size(F.array_except("_a", "_b")) == 0))
    # A container of a container is one too, so an entry is dropped if it has any; before its turn comes, a dropped one is no container any more.
    dropped = hit.select(*group, F.col("_small").alias("_large")).distinct().withColumn("_gone", F.lit(True))
    hit = join_safe(hit, dropped, [*group, "_large"], "left").filter("_gone is null or _large > _small")
    return hit.groupBy(*group, F.col("_small").alias(entry)).agg(F.min("_large").alias("into"))


def struct_vote(votes: DataFrame, item: str, rows: str) -> DataFrame:
    """Rows (item, rows, how): the structure that most votes share, compared as a sorted list of texts; an empty list votes for none, which wins with as many
    votes; a null vote or a single row is invalid. how: LLM_MAJORITY, LLM_PLURALITY, NONE_MAJORITY_OR_TIE, NONE_SINGLE or NO_VALID_STRUCT."""
    valid = votes.filter(F.size(rows) >= 2).select(item, F.array_sort(rows).alias("_k"))
    best = valid.groupBy(item, "_k").agg(F.count("*").alias("n")).groupBy(item).agg(F.min(F.struct((-F.col("n")).alias("n"), "_k")).alias("b"))
    none = votes.groupBy(item).agg(F.count_if(F.coalesce(F.size(rows) == 0, F.lit(False)) & F.col(rows).isNotNull()).alias("none"))
    j = join_safe(none, best.select(item, (-F.col("b.n")).alias("n"), F.col("b._k").alias("_k")), [item], "left")
    won = F.col("n").isNotNull() & ((F.col("none") == 0) | (F.col("none") < F.col("n")))
    how = F.when(won, F.when(F.col("n") >= 2, "LLM_MAJORITY").otherwise("LLM_PLURALITY")).when(F.col("none") > 1, "NONE_MAJORITY_OR_TIE").when(F.col("none") == 1, "NONE_SINGLE").otherwise("NO_VALID_STRUCT")
    return j.select(item, F.when(won, F.col("_k")).alias(rows), how.alias("how"))


def fallback_side(structured_a: Column, structured_b: Column, evidence_a: Column, evidence_b: Column) -> Column:
    """A or B: the side that alone has a structure, else the one with more evidence, else A."""
    return F.when(structured_a & ~structured_b, "A").when(structured_b & ~structured_a, "B").when(evidence_b > evidence_a, "B").otherwise("A")


def recovered_evidence(windows: DataFrame, keys: list[str], sids: str, fallback: str, document: str, sentences: DataFrame, sid: str, text: str) -> DataFrame:
    """Rows (keys, evidence, source, status, missing): the texts of a window's sentences in order; without any, the stored text; without that, a note.

    missing: ids without a text, if others have one.
    """
    ids = windows.select(*keys, F.col(document).alias("_d"), F.array_distinct(F.coalesce(F.col(sids), F.array())).alias("_ids"), F.trim(F.coalesce(F.col(fallback), F.lit(""))).alias("_f"))
    each = ids.select(*keys, "_d", F.posexplode("_ids").alias("_p", "_s"))
    known = sentences.groupBy(F.col(document).alias("_d"), F.col(sid).cast("bigint").alias("_s")).agg(F.max(F.trim(text)).alias("_t")).filter("_t <> ''")
    each = join_safe(each.withColumn("_s", F.col("_s").cast("bigint")), known, ["_d", "_s"], "left")
    got = F.sort_array(F.collect_list(F.when(F.col("_t").isNotNull(), F.struct("_p", "_t"))))
    lost = F.sort_array(F.collect_list(F.when(F.col("_t").isNull(), F.struct("_p", "_s"))))
    told = each.groupBy(*keys).agg(F.array_join(F.transform(got, lambda x: x["_t"]), " ").alias("_x"), F.array_join(F.transform(lost, lambda x: x["_s"].cast("string")), ",").alias("_m"))
    out = join_safe(ids, told, keys, "left").withColumn("_x", F.coalesce("_x", F.lit("")))
    listed = F.array_join(F.transform("_ids", lambda x: x.cast("string")), ",")
    found, stored = F.col("_x") != "", F.col("_f") != ""
    note = F.when(listed != "", F.concat(F.lit("(evidence unavailable; sids="), listed, F.lit(")"))).otherwise("(evidence unavailable)")
    status = F.when(found, "OK_CSV_SIDS").when(stored, "FALLBACK_MARKDOWN").when(listed != "", "PLACEHOLDER_SIDS_RECOVER_FAILED").otherwise("PLACEHOLDER_EMPTY")
    source = F.when(found, "decision_csv").when(stored, "markdown").otherwise("placeholder")
    return out.select(*keys, F.when(found, F.col("_x")).when(stored, F.col("_f")).otherwise(note).alias("evidence"), source.alias("source"), status.alias("status"), F.when(found, F.col("_m")).otherwise("").alias("missing"))


def numeric_first(value: Column) -> list[Column]:
    """Sort keys: whole numbers in their order before other texts."""
    n = F.when(value.rlike("^\\s*-?[0-9]+\\s*$"), F.trim(value).try_cast("bigint"))
    return [n.isNull().asc(), n.asc_nulls_last(), value.asc()]
