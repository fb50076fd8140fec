"""Validation of what models answer, as plain functions on parsed JSON that Arrow batches are mapped with. Each gives a value or the reason against it."""

from __future__ import annotations

import re
from typing import Any

from dotledger.functions.measures import AXES, LIFETIME_UNITS, LIFETIME_VALUE, PERCENT
from dotledger.functions.rules import NUMERIC_PATTERNS, NUMERIC_PROPERTIES, PROPERTY_ORDER

#: Rank of the kinds of a statement where their evidence overlaps.
KIND_RANK = {"app": 3, "vs": 2, "main": 1}
#: Keys under which an answer lists its rows, and words for nothing.
ROW_KEYS = ("items", "data", "structured", "result", "rows", "values_list")
NONE_WORDS = ("none", "null", "n/a", "na", "true")
_NUMBER = re.compile(r"[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?")


def number(value: Any) -> float | None:
    """The first number of a value; none for booleans."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, (int, float)):
        return float(value)
    m = _NUMBER.search(str(value))
    return float(m[0]) if m else None


def tag_name(value: Any) -> str:
    """The canonical property of a name without regard to case and white space; other names trimmed."""
    text = str(value or "").strip()
    return {t.upper(): t for t in PROPERTY_ORDER}.get(re.sub(r"\s+", "", text).upper(), text)


def axis(value: Any) -> str:
    text = str(value or "").strip()
    return AXES.get(re.sub(r"\s+", "", text).lower(), text)


def elect_unit(sentence: str, evidence: str, told: Any) -> str:
    found = [LIFETIME_UNITS.get(u.lower(), u.lower()) for t in (evidence, sentence) for u in re.findall(f"(?i){LIFETIME_VALUE}", t or "")]
    if found:
        return max(dict.fromkeys(found), key=found.count)
    m = re.search(r"(?i)\b(fs|ps|ns|us|µs|μs|ms|s)\b", str(told or ""))
    text = (m[1] if m else str(told or "")).strip().lower()
    return LIFETIME_UNITS.get(text, text)


def percents(values: list[float], sentence: str, evidence: str, raw_first: bool = False) -> list[float]:
    if "%" in (sentence or ""):
        return values
    stated = [float(x) for x in re.findall(f"(?i){PERCENT}", evidence or "")]
    near = lambda v, gap: any(abs(x - v) <= gap for x in stated)
    return [v if v >= 1 or near(v, 1e-6) and (raw_first or not near(v * 100, 1e-4)) else v * 100 for v in values]


def _listed(value: Any) -> list:
    return value if isinstance(value, list) else [] if value in (None, "") else [value]


def structured_value(tag: str, payload: Any, sentence: str = "", evidence: str = "") -> dict | list | None:
    """The answer as {tag, label} or {tag, values, unit, vary_by, vary_values}, or a list of such with a condition each; None if it is none.

    Numbers must be numbers, the axis one that the property may vary by (components for lifetimes only); units and yields are settled by the texts.
    """
    tag = tag_name(tag)
    if tag not in NUMERIC_PROPERTIES:
        payload = payload[0] if isinstance(payload, list) and len(payload) == 1 else payload
        label = str(payload.get("label", "")).strip().upper() if isinstance(payload, dict) and tag_name(payload.get("tag")) == tag else ""
        return {"tag": tag, "label": label} if label in ("YES", "NO") else None

    def one(item: Any, conditional: bool) -> dict | None:
        if not isinstance(item, dict) or tag_name(item.get("tag")) != tag:
            return None
        raw = item.get("values", [])
        values = [number(v) for v in (raw if isinstance(raw, list) else [raw])]
        by = axis(item.get("vary_by"))
        if not values or None in values or by not in ("", "pH", "solvent", "Ex", "Em", *(("component",) if tag == "lifetime" else ())) or conditional and not by:
            return None
        unit = {"Ex": "nm", "Em": "nm", "QY": "%"}.get(tag) or elect_unit(sentence, evidence, item.get("unit"))
        if not unit:
            return None
        told = _listed(item.get("vary_values")) if by else []
        told = [n for v in told if (n := number(v)) is not None] if by in ("Ex", "Em", "pH") else [s for v in told if (s := str(v).strip())]
        return {"tag": tag, "values": percents(values, sentence, evidence) if tag == "QY" else values, "unit": unit, "vary_by": by, "vary_values": told}

    if isinstance(payload, list):
        return [x for item in payload if (x := one(item, True))] or None
    return one(payload, False)


def _key(value: Any) -> str:
    return "%0.12g" % value if isinstance(value, (int, float)) and not isinstance(value, bool) else " ".join(str(value or "").split()).lower()


def change_rows(tag: str, payload: Any, sentence: str = "", evidence: str = "") -> list[dict] | None:
    """Rows {tag, values, unit, vary_by, vary_values} of a change, one value and condition each; [] for an answer of nothing, None if it is invalid.

    There must be two rows or more, one axis, and two distinct conditions and values. One condition for several values holds for all.
    """
    tag = tag_name(tag)
    if isinstance(payload, dict):
        listed = next((payload[k] for k in ROW_KEYS if isinstance(payload.get(k), list)), None)
        if listed is None and any(k in payload for k in ("tag", "values", "value", "vary_by", "vary_values")):
            listed = [payload]
        elif listed is None and str(payload.get("none", payload.get("is_none", ""))).strip().lower() in NONE_WORDS:
            return []
        payload = listed
    if not isinstance(payload, list):
        return None
    out = []
    for item in payload:
        if not isinstance(item, dict) or (tag_name(item.get("tag")) or tag) != tag:
            return None
        by = axis(item.get("vary_by"))
        values = [n for v in _listed(item.get("values", item.get("value"))) if (n := number(v)) is not None]
        unit = "%" if tag == "QY" else elect_unit(sentence, evidence, item.get("unit"))
        if tag != "QY" and unit not in LIFETIME_UNITS.values() or by not in ("Em", "Ex", "pH", "solvent") or not values:
            return None
        told = item.get("vary_values", item.get("vary_value"))
        told = told if isinstance(told, list) else [told]
        if len(told) not in (1, len(values)):
            return None
        told = told * len(values) if len(told) == 1 else told
        told = [number(t) if by != "solvent" else " ".join(str(t or "").split()) or None for t in told]
        if None in told:
            return None
        values = percents(values, sentence, evidence, raw_first=True) if tag == "QY" else values
        out += ({"tag": tag, "values": v, "unit": unit, "vary_by": by, "vary_values": t} for v, t in zip(values, told))
    distinct = lambda k: len({_key(x[k]) for x in out})
    return out if len(out) >= 2 and distinct("vary_by") == 1 and distinct("vary_values") >= 2 and distinct("values") >= 2 else None


def kind_conflicts(entries: list[dict]) -> list[dict]:
    """Entries without those whose evidence contains, or lies within, that of another kind of higher rank (app, vs, main); the first stands before equals.

    They are judged in order, and what is dropped drops no other.
    """
    dropped: set[int] = set()
    for i, a in enumerate(entries):
        for j in range(i + 1, len(entries)):
            b = entries[j]
            if i in dropped:
                break
            if j in dropped or a["kind"] == b["kind"] or not {a["kind"], b["kind"]} <= KIND_RANK.keys():
                continue
            x, y = set(a["evidence"]), set(b["evidence"])
            if x and y and (x <= y or y <= x):
                dropped.add(j if KIND_RANK[a["kind"]] >= KIND_RANK[b["kind"]] else i)
    return [e for i, e in enumerate(entries) if i not in dropped]


def numbers_stated(sentence: str, tag: str, evidence: list[str]) -> bool:
    """Whether a sentence of a property with numbers has one with a fitting unit, and the evidence has all of them."""
    if tag not in NUMERIC_PATTERNS:
        return True
    found = re.findall(f"(?i){NUMERIC_PATTERNS[tag]}", sentence)
    return bool(found) and all(n in " ".join(evidence) for n in found)


def refined_objects(objects: list | None, sample: str, tag: str, allowed: list[int], texts: dict[int, str]) -> list[dict] | None:
    """An answer's objects that hold: kind, sample, sentence of the property, evidence among the allowed sentences (all, if it names none of them).

    Objects of kind false count only if no other holds. Kinds in conflict and repeats are dropped. None without an answer.
    """
    if objects is None:
        return None
    useful, nothing = [], False
    for o in objects:
        kind = str(o.get("kind", "")).strip().lower() if isinstance(o, dict) else ""
        nothing |= kind == "false"
        named = str(o.get("sample") or "").strip() if kind in KIND_RANK else "?"
        held = o.get("Property") if named in ("", sample) else None
        sentence = str(held.get(tag) or "").strip() if isinstance(held, dict) else ""
        if not sentence:
            continue
        told = {int(n) for v in (o.get("evidence") if isinstance(o.get("evidence"), (list, tuple)) else ()) if (n := number(v)) is not None}
        ids = [i for i in allowed if i in told] or list(allowed)
        lines = [texts.get(i) or "" for i in ids]
        if any(x.strip() for x in lines) and numbers_stated(sentence, tag, lines):
            useful.append({"kind": kind, "sample": sample if kind == "main" else named, "evidence": ids, "Property": {tag: sentence}})
    if not useful:
        return [{"kind": "false"}] if nothing else []
    kept = {(e["kind"], e["sample"], tuple(e["evidence"]), e["Property"][tag]): e for e in reversed(kind_conflicts(useful))}
    return list(reversed(kept.values()))


def bound_names(payload: dict, candidates: list[str]) -> tuple[str, list[str]]:
    """(scope, names) of an answer that binds a statement to samples: names among the candidates, the scope by their number."""
    scope = str(payload.get("scope", "")).strip().lower()
    names = list(dict.fromkeys(n for x in payload.get("samples") or [] if (n := str(x or "").strip()) in candidates))
    if scope == "single" and not names and len(candidates) == 1:
        names = list(candidates)
    if scope in ("single", "multi") and names:
        scope = "single" if len(names) == 1 else "multi"
    return scope, names


#: What each kind of answer must hold: (field, allowed words, in upper case) or (field, type).
REQUIRED = {
    "keep_refine": (("action", ("KEEP", "REFINE")),), "route": (("decision", ("MAIN", "APP", "VS", "DROP")),), "bind": (("scope", ("NONE", "SINGLE", "MULTI", "FAMILY")), ("samples", list)), "review": (("verdict", ("KEEP", "DROP", "REWRITE")), ("reason", "text")),
    "rewrite": (("sentence", str),), "recheck": (("keep", bool),),
}


def payload_error(kind: str, payload: Any) -> str | None:
    """What an answer of this kind lacks, or None."""
    if not isinstance(payload, dict):
        return "NOT_AN_OBJECT"
    for field, wanted in REQUIRED[kind]:
        value = payload.get(field, [] if wanted is list else None)
        if isinstance(wanted, tuple) and str(value or "").strip().upper() not in wanted:
            return f"INVALID_{field.upper()}"
        if wanted == "text" and not str(value or "").strip() or wanted is str and value is None or wanted is bool and value is None:
            return f"MISSING_{field.upper()}"
        if wanted in (str, list) and not isinstance(value, wanted) or wanted is bool and not isinstance(value, bool) and not re.fullmatch(r"(?i)\s*\{?\s*(true|false)\s*\}?\s*", str(value)):
            return f"INVALID_{field.upper()}"
    if kind == "keep_refine" and str(payload["action"]).strip().upper() == "REFINE" and not isinstance(payload.get("candidates", []), list):
        return "INVALID_CANDIDATES"
    return None


def rewritten(sentence: Any, sample: str, first_line: bool = True) -> tuple[str | None, str]:
    """(sentence, reason): a rewritten sentence must name its sample exactly and not be NONE."""
    text = " ".join(str(sentence or "").split())
    if not text:
        return None, "EMPTY"
    if text.upper().strip(".") == "NONE":
        return None, "NONE"
    return (text, "OK") if sample in text else (None, "SAMPLE_NOT_NAMED")
