"""Numbers with units, conditions, signatures and their export: column functions over sentences and their values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from dotledger.functions.rules import NUMERIC_PATTERNS, NUMERIC_PROPERTIES

#: Numbers with a unit, in the order in which a sentence's pairs are listed: (unit, pattern, groups of the value).
NUMBER_UNITS = (
    ("nm", r"(?iU)(?<![A-Za-z])(\d{1,4}(?:\.\d+)?)\s*[-–—]\s*(\d{1,4}(?:\.\d+)?)\s*nm(?![A-Za-z])", 2), ("nm", r"(?iU)(?<![A-Za-z])(\d{1,4}(?:\.\d+)?)\s*nm(?![A-Za-z])", 1), ("μm", r"(?iU)(?<![A-Za-z])(\d{1,4}(?:\.\d+)?)\s*(?:μm|um)(?![A-Za-z])", 1),
    ("%", r"(?iU)(\d{1,3}(?:\.\d+)?)\s*%", 1), ("%", r"(?iU)(\d{1,3}(?:\.\d+)?)\s*percent", 1), ("ns", r"(?iU)\b(\d+(?:\.\d+)?)\s*ns\b", 1), ("μs", r"(?iU)\b(\d+(?:\.\d+)?)\s*(?:μs|us)\b", 1), ("ms", r"(?iU)\b(\d+(?:\.\d+)?)\s*ms\b", 1),
    ("s", r"(?iU)\b(\d+(?:\.\d+)?)\s*s(?:ec|econd)?s?\b", 1),
)
#: Words that mention a unit without a number.
UNIT_MENTIONS = (("nm", r"nanometer|nanometre|\bnm\b"), ("μm", r"\b(?:μm|um)\b"), ("%", r"%|percent"), ("ns", r"\bns\b|nanosecond"), ("μs", r"\b(?:μs|us)\b|microsecond"), ("ms", r"\bms\b|millisecond"), ("s", r"\bs\b|second"))
BARE_NUMBER = r"\d[\d.,]*[A-Za-z]?"
#: Unit words of lifetimes by their token.
LIFETIME_UNITS = {
    "µs": "us", "μs": "us", "us": "us", "microsecond": "us", "microseconds": "us", "ns": "ns", "nanosecond": "ns", "nanoseconds": "ns", "ps": "ps", "picosecond": "ps", "picoseconds": "ps", "fs": "fs", "femtosecond": "fs", "femtoseconds": "fs",
    "ms": "ms", "millisecond": "ms", "milliseconds": "ms", "s": "s", "second": "s", "seconds": "s",
}
LIFETIME_VALUE = r"\b[0-9]+(?:\.[0-9]+)?\s*(fs|ps|ns|us|µs|μs|ms|s)\b"
#: Names of a condition's axis, without white space and in lower case, by the axis.
AXES = {
    "ph": "pH", "solvent": "solvent", "medium": "solvent", "state": "solvent", "phase": "solvent", "ex": "Ex", "excitation": "Ex", "excitationwavelength": "Ex", "em": "Em", "emission": "Em", "emissionwavelength": "Em",
    "component": "component", "components": "component", "tau": "component",
}
#: Conditions that a sentence states, by their axis.
CONDITIONS = {"Em": r"\bem\s*[=:]\s*(-?[0-9]+(?:\.[0-9]+)?)\s*nm\b", "Ex": r"\bex\s*[=:]\s*(-?[0-9]+(?:\.[0-9]+)?)\s*nm\b", "pH": r"\bph\s*[=:]\s*(-?[0-9]+(?:\.[0-9]+)?)\b", "solvent": r"\bsolvent\s*[=:]\s*([^)\]\n;,.]+)"}
PERCENT = r"([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)\s*(?:%|percent(?:age)?)"
#: Phrases that deny and that tell chirality.
ACHIRAL = r"\bachiral\b|\bnon[-\s]?chiral\b|\bnot\s+chiral\b|\bwithout\s+chirality\b|\bno\s+chirality\b|\bchirality\s+(?:is\s+)?absent\b|\bnot\s+optically\s+active\b"
CHIRAL = r"\bchiral\b|\bchirality\b|\boptically\s+active\b"
#: A name's marker of chirality, and what marks evidence as an image, unless it was read from a table's image.
CHIRAL_NAME = r"(?i)(?<![A-Za-z0-9])[LD]\s*-\s*[A-Za-z0-9]|(?<![A-Za-z0-9])[LD]\s*-?\s*/\s*[LD]\s*-?"
IMAGE_MARKS, TABLE_READ = ("![](images", "images/", ".jpg"), "table_from_image"


def lookup(key: Column, table: dict[str, str]) -> Column:
    """The table's value for a key; null for others."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def number_units(text: Column) -> Column:
    """Distinct (value, unit) structs: ranges and numbers with their unit, then bare numbers whose text isn't among them, in order."""

    def pairs(unit: str, pattern: str, groups: int) -> Column:
        values = F.regexp_extract_all(text, F.lit(pattern), 1)
        if groups == 2:
            values = F.zip_with(values, F.regexp_extract_all(text, F.lit(pattern), 2), lambda a, b: F.concat_ws("-", a, b))
        return F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(unit).alias("unit")))

    # Times are listed as they stand, whatever their unit.
    timed = [F.regexp_extract_all(text, F.lit(r"(?iU)\b(\d+(?:\.\d+)?)\s*(?:ns|μs|us|ms)\b"), 1), F.regexp_extract_all(text, F.lit(r"(?iU)\b\d+(?:\.\d+)?\s*(ns|μs|us|ms)\b"), 1)]
    times = F.zip_with(*timed, lambda v, u: F.struct(v.alias("value"), F.when(F.lower(u) == "us", "μs").otherwise(F.lower(u)).alias("unit")))
    named = F.array_distinct(F.concat(*(pairs(*x) for x in NUMBER_UNITS[:5]), times, pairs(*NUMBER_UNITS[8])))
    seen = F.transform(named, lambda x: x["value"])
    bare = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(BARE_NUMBER), 0)), lambda v: ~F.array_contains(seen, v))
    return F.concat(named, F.transform(bare, lambda v: F.struct(v.alias("value"), F.lit("").alias("unit"))))


def unit_mask(text: Column) -> Column:
    """Units of the sentence: those of its numbers, then those it mentions, each once."""
    units = F.filter(F.transform(number_units(text), lambda x: x["unit"]), lambda u: u != "")
    low = F.lower(text)
    named = F.filter(F.array(*(F.when(low.rlike(f"(?U){p}"), F.lit(u)) for u, p in UNIT_MENTIONS)), lambda u: u.isNotNull())
    return F.array_distinct(F.concat(units, named))


def lifetime_token(unit: Column) -> Column:
    """The unit's token; other words as they are, in lower case."""
    low = F.lower(F.trim(unit))
    return F.coalesce(lookup(low, LIFETIME_UNITS), low)


def lifetime_unit(sentence: Column, evidence: Column, told: Column) -> Column:
    """The unit that most numbers of the evidence and the sentence have, the first seen of equals; without numbers the one that was told."""
    found = F.transform(F.regexp_extract_all(F.concat_ws(" \n", F.coalesce(evidence, F.lit("")), F.coalesce(sentence, F.lit(""))), F.lit(f"(?i){LIFETIME_VALUE}"), 1), lifetime_token)
    ranked = F.transform(F.array_distinct(found), lambda u, i: F.struct((-F.size(F.filter(found, lambda x: x == u))).alias("n"), i.alias("i"), u.alias("u")))
    return F.coalesce(F.try_element_at(F.array_sort(ranked), F.lit(1))["u"], lifetime_token(F.coalesce(told, F.lit(""))))


def percent_value(value: Column, sentence: Column, evidence: Column, raw_first: bool = False) -> Column:
    """A yield as percent: as it is, if the sentence has a percent sign or it is at least one, or the evidence states it so; else times 100.

    raw_first: the number itself is looked for in the evidence before its hundredfold.
    """
    stated = F.transform(F.regexp_extract_all(F.coalesce(evidence, F.lit("")), F.lit(f"(?i){PERCENT}"), 1), lambda x: x.cast("double"))
    scaled = value * 100.0
    has = lambda v, gap: F.exists(stated, lambda x: F.abs(x - v) <= gap)
    small = F.when(has(value, 1e-6), value) if raw_first else F.when(has(scaled, 1e-4), scaled).when(has(value, 1e-6), value)
    return F.when(F.coalesce(sentence, F.lit("")).contains("%") | (value >= 1), value).otherwise(small.otherwise(scaled))


def axis_name(c: Column) -> Column:
    """The axis of a condition by any of its names; other names trimmed."""
    return F.coalesce(lookup(F.regexp_replace(F.lower(c), "\\s+", ""), AXES), F.trim(c))


def stated_conditions(sentence: Column) -> Column:
    """Structs (axis, values): the distinct values that the sentence states for each axis, numbers without trailing zeros."""
    low = F.lower(sentence)

    def values(axis: str) -> Column:
        found = F.regexp_extract_all(low, F.lit(CONDITIONS[axis]), 1)
        clean = (lambda x: F.regexp_replace(F.trim(x), "\\s+", " ")) if axis == "solvent" else (lambda x: F.regexp_replace(F.regexp_replace(x, "(\\.[0-9]*?)0+$", "$1"), "\\.$", ""))
        return F.array_distinct(F.filter(F.transform(found, clean), lambda x: x != ""))

    return F.array(*(F.struct(F.lit(a).alias("axis"), values(a).alias("values")) for a in CONDITIONS))


def single_axis(sentence: Column) -> Column:
    """The only (axis, values) struct with two or more values; null if there is none or more than one."""
    able = F.filter(stated_conditions(sentence), lambda x: F.size(x["values"]) >= 2)
    return F.when(F.size(able) == 1, F.try_element_at(able, F.lit(1)))


def sentence_values(tag: Column, sentence: Column) -> Column:
    """Distinct numbers of a sentence with a unit of its property, as doubles in ascending order; empty for properties without numbers."""
    found = [F.when(tag == t, F.regexp_extract_all(F.lower(sentence), F.lit(p.replace("(?:fs|ps|ns|us|ms|s)", "(?:fs|ps|ns|us|µs|μs|ms|s)")), 1)) for t, p in NUMERIC_PATTERNS.items()]
    return F.array_sort(F.array_distinct(F.transform(F.coalesce(*found, F.array().cast("array<string>")), lambda x: x.cast("double"))))


def merge_errors(tag: Column, sentence: Column, value_a: Column, value_b: Column) -> Column:
    """What keeps a merged sentence from standing for two values: reasons in order, none if it may."""
    axis, values = single_axis(sentence), sentence_values(tag, sentence)
    conditions = F.coalesce(F.size(axis["values"]), F.lit(0))
    reasons = (
        F.when(axis.isNull(), F.lit("NO_SINGLE_EXPLICIT_CONDITION_AXIS")), F.when(F.size(values) < 2, F.concat(F.lit("VAL_LT2:"), F.size(values).cast("string"))), F.when(conditions < 2, F.concat(F.lit("COND_LT2:"), conditions.cast("string"))),
        F.when(F.abs(value_a - value_b) < 1e-12, F.lit("A_B_ORIG_VALUES_EQUAL")),
    )
    return F.filter(F.array(*reasons), lambda x: x.isNotNull())


def number_text(c: Column) -> Column:
    """Whole numbers without a point, others with at most ten decimals and no trailing zeros."""
    return F.when(F.abs(c - F.round(c)) < 1e-12, F.format_string("%.0f", c)).otherwise(F.regexp_replace(F.format_string("%.10f", c), "\\.?0+$", ""))


def value_signature(tag: Column, values: Column, unit: Column, label: Column) -> Column:
    """What two structured values are compared by: sorted distinct numbers and the unit, or the label."""
    shown = F.array_join(F.transform(F.array_sort(F.array_distinct(values)), number_text), ", ")
    return F.when(tag.isin(*NUMERIC_PROPERTIES), F.concat(F.lit("values=["), shown, F.lit("]; unit="), F.coalesce(unit, F.lit("")))).otherwise(F.concat(F.lit("label="), F.coalesce(label, F.lit("NONE"))))


def with_unit(value: Column, unit: Column) -> Column:
    u = F.coalesce(F.trim(unit), F.lit(""))
    return F.when(value == "", "").when(u == "", value).when(u == "%", F.concat(value, F.lit("%"))).otherwise(F.concat_ws(" ", value, u))


def export_values(tag: Column, values: Column, unit: Column, axis: Column, conditions: Column) -> Column:
    """Texts such as ``5 ns(Em:450 nm)``: as many conditions as values go in pairs, several with one value are listed; otherwise the first holds for all.

    values: numbers as doubles; conditions: texts, numbers without unit for wavelengths.
    """
    unit_of = F.when(F.trim(F.coalesce(unit, F.lit(""))) == "", "").when(tag.isin("Ex", "Em"), "nm").when(tag == "QY", "%").when(tag == "lifetime", lifetime_token(unit)).otherwise(F.trim(unit))
    shown = F.transform(values, lambda v: with_unit(number_text(v), unit_of))
    by = axis_name(F.coalesce(axis, F.lit("")))
    told = F.transform(conditions, lambda c: F.when(by.isin("Ex", "Em"), with_unit(c, F.lit("nm"))).otherwise(c))
    n, m = F.size(values), F.size(conditions)
    close = lambda v, c: F.concat(v, F.lit("("), by, F.lit(":"), c, F.lit(")"))
    pairs = F.when(m == n, F.zip_with(shown, told, close)).when((n == 1) & (m > 1), F.transform(shown, lambda v: close(v, F.array_join(told, ",")))).otherwise(F.transform(shown, lambda v: close(v, F.try_element_at(told, F.lit(1)))))
    return F.when(by == "", shown).when(m <= 0, F.transform(shown, lambda v: F.concat(v, F.lit("("), by, F.lit(")")))).otherwise(pairs)


def chirality(*texts: Column) -> Column:
    """Whether the first text that tells it says chiral; denials win within a text, null if none tells."""
    told = [F.when(F.lower(t).rlike(ACHIRAL), False).when(F.lower(t).rlike(CHIRAL), True) for t in texts]
    return F.coalesce(*told)


def chiral_name(name: Column) -> Column:
    return F.coalesce(name, F.lit("")).rlike(CHIRAL_NAME)


def image_only(evidence: Column) -> Column:
    """Evidence that points to an image which no table was read from; it can't be used."""
    low = F.lower(F.coalesce(evidence, F.lit("")))
    return reduce(lambda a, b: a | b, [low.contains(m) for m in IMAGE_MARKS]) & ~low.contains(TABLE_READ)
