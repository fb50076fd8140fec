"""A grammar of numbers and unit expressions.

Units are exponent vectors over (temperature, time, mass, amount, length) with a scale and an offset to the canonical unit of
their dimension; a compound such as ``cm3`` or ``mol/L`` is the product of its factors' vectors.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

#: Exponents of (temperature, time, mass, amount, length) of the dimensions that are reported.
DIMENSIONS = {(1, 0, 0, 0, 0): "temperature", (0, 1, 0, 0, 0): "time", (0, 0, 1, 0, 0): "mass", (0, 0, 0, 1, 0): "amount", (0, 0, 0, 0, 3): "volume"}

#: Canonical units are hundredths of a degree Celsius, seconds, micrograms, nanomoles and microlitres; lengths are in millimetres, so that their cube is a microlitre.
_THETA, _TIME, _MASS, _AMOUNT, _LENGTH, _VOLUME = (1, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0, 0, 1, 0, 0), (0, 0, 0, 1, 0), (0, 0, 0, 0, 1), (0, 0, 0, 0, 3)
_NONE = (0, 0, 0, 0, 0)

#: Base symbols that take a prefix, with scale and vector.
_PREFIXED = {"g": (1e6, _MASS), "mol": (1e9, _AMOUNT), "L": (1e6, _VOLUME), "l": (1e6, _VOLUME), "m": (1e3, _LENGTH), "s": (1.0, _TIME), "M": (1e3, (0, 0, 0, 1, -3))}
#: SI prefixes by symbol and by name.
_PREFIXES = {"": 1.0, "k": 1e3, "d": 1e-1, "c": 1e-2, "m": 1e-3, "μ": 1e-6, "u": 1e-6, "n": 1e-9, "p": 1e-12}
_PREFIX_NAMES = {"": 1.0, "kilo": 1e3, "deci": 1e-1, "centi": 1e-2, "milli": 1e-3, "micro": 1e-6, "nano": 1e-9}
#: Names that take a prefix name.
_NAMES = {"gram": (1e6, _MASS), "gramme": (1e6, _MASS), "mole": (1e9, _AMOUNT), "mol": (1e9, _AMOUNT), "liter": (1e6, _VOLUME), "litre": (1e6, _VOLUME), "meter": (1e3, _LENGTH), "metre": (1e3, _LENGTH), "second": (1.0, _TIME), "molar": (1e3, (0, 0, 0, 1, -3))}
#: Units without a prefix; names are matched in any case.
_OTHERS = {
    "min": (60.0, _TIME), "mins": (60.0, _TIME), "minute": (60.0, _TIME), "minutes": (60.0, _TIME), "sec": (1.0, _TIME), "secs": (1.0, _TIME), "h": (3600.0, _TIME), "hr": (3600.0, _TIME), "hrs": (3600.0, _TIME),
    "hour": (3600.0, _TIME), "hours": (3600.0, _TIME), "d": (86400.0, _TIME), "day": (86400.0, _TIME), "days": (86400.0, _TIME), "week": (604800.0, _TIME), "weeks": (604800.0, _TIME), "wk": (604800.0, _TIME),
    "cc": (1.0e3, _VOLUME), "ccm": (1.0e3, _VOLUME), "lambda": (1.0, _VOLUME), "%": (1.0, _NONE), "wt%": (1.0, _NONE), "vol%": (1.0, _NONE), "ppm": (1.0, _NONE), "ppb": (1.0, _NONE), "eq": (1.0, _NONE), "equiv": (1.0, _NONE),
    "fold": (1.0, _NONE), "times": (1.0, _NONE), "W": (1.0, (0, -3, 1, 0, 2)), "kW": (1.0, (0, -3, 1, 0, 2)), "rpm": (1.0, (0, -1, 0, 0, 0)), "bar": (1.0, (0, -2, 1, 0, -1)), "atm": (1.0, (0, -2, 1, 0, -1)), "V": (1.0, (0, -3, 1, 0, 2)), "N": (1.0, (0, 0, 0, 1, -3)),
}


class Unit(NamedTuple):
    """canonical = (value - shift) * scale"""

    scale: float
    vector: tuple[int, ...]
    shift: float = 0.0


_CELSIUS, _KELVIN, _FAHRENHEIT = Unit(100.0, _THETA), Unit(100.0, _THETA, 273.15), Unit(500.0 / 9.0, _THETA, 32.0)

_NUMBER = r"(?<![\w.])(?P<sign>[-−+]\s?)?(?P<int>\d+(?:[.,]\d+)*|[.,]\d+)(?:\s*[×x*·]\s*10\s*\^?\s*(?P<p10>[-−+]?\d+)|[eE](?P<exp>[-−+]?\d+))?"
#: Numbers as words.
_WORDS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "half an": 0.5, "half a": 0.5, "half": 0.5}
_DEGREES = r"(?:°|º|˚|[oO](?=\s?[CFK]\b)|\bdeg(?:rees?|\.)?)\s*(?P<deg>C(?:elsius|entigrade)?|F(?:ahrenheit)?|K(?:elvin)?)(?![A-Za-z])"
_THERMAL = r"(?P<scale>C(?:elsius|entigrade)?|F(?:ahrenheit)?|K(?:elvin)?)(?![A-Za-z/])"
_FACTOR = r"(?:[A-Za-zμ]+%?|%|‰)(?:\(s\)|\.(?!\d))?(?:\^?[-−]?[1-3](?![\d.,]))?"
_UNIT = re.compile(rf"(?:{_DEGREES}|{_THERMAL}|(?P<expr>{_FACTOR}(?:\s?[/·]\s?(?=[A-Za-zμ]){_FACTOR})*))", re.IGNORECASE)
_GLUED = re.compile(_NUMBER.replace(r"(?<![\w.])", "", 1), re.IGNORECASE)
_OPEN = re.compile(r"\s*(\()?\s*")
_PRIME = re.compile(r"(?<=\d)(?:''|′′|\"|'|′)(?![\w'])")  # minutes and seconds
_SCAN = re.compile(rf"{_NUMBER}|(?<![A-Za-z])(?P<word>{'|'.join(sorted(_WORDS, key=len, reverse=True))})(?![A-Za-z])", re.IGNORECASE)
_QUALIFIER = re.compile(r"(?:~|≈|≃|∼|<|>|≤|≥|=|\b(?:ca|c|circa|about|approx|approximately|around|roughly|nearly|at|total|each|then|and|to|or)\b\.?|[-−–—/,;.()\s])+", re.IGNORECASE)
_RANGE = re.compile(r"\s*(?:[-−–—~]|\bto\b|\band\b|\bor\b)\s*", re.IGNORECASE)
_TOLERANCE = re.compile(r"\s*(?:±|\+/-|\+-|\+/−)\s*$")
_PART = re.compile(r"\s*(?:,|\band\b)?\s*", re.IGNORECASE)
_RAISED = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻", "0123456789-")


def plain(text: str) -> str:
    """Compatibility forms written plainly, with raised exponents after 10 kept as powers."""
    if text.isascii():
        return text
    text = re.sub(r"(?<=10)[⁻⁰¹²³⁴⁵⁶⁷⁸⁹]+", lambda m: "^" + m[0].translate(_RAISED), text)
    text = text.replace("º", "°").replace("˚", "°")
    return re.sub("[\u200b-\u200d\u2060\ufeff]", "", unicodedata.normalize("NFKC", text).replace("µ", "μ"))


@lru_cache(4096)
def _factor(text: str) -> Unit | None:
    m = re.fullmatch(r"(.*?)(?:\(s\)|\.)?(?:\^?([-−]?[1-3]))?", text)
    name, power = m[1], int((m[2] or "1").replace("−", "-"))
    found = None
    for base, (scale, vector) in _PREFIXED.items():
        if name.endswith(base) and name[: -len(base)] in _PREFIXES:
            found = scale * _PREFIXES[name[: -len(base)]], vector
            break
    low = name.casefold()
    found = _OTHERS.get(name) or found or _OTHERS.get(low)
    if found is None:
        for base, (scale, vector) in _NAMES.items():
            stem = low[:-1] if low.endswith("s") else low
            if stem.endswith(base) and stem[: -len(base)] in _PREFIX_NAMES:
                found = scale * _PREFIX_NAMES[stem[: -len(base)]], vector
        if found is None and name != low and len(name) > 1:
            return _factor(low + text[len(name) :])
    return found and Unit(found[0] ** power, tuple(x * power for x in found[1]))


@lru_cache(4096)
def _expression(text: str) -> Unit | None:
    """The product of the factors; None if one of them is no unit."""
    scale, vector, sign = 1.0, _NONE, 1
    for piece in re.split(r"\s*([/·])\s*", text):
        if piece in "/·":
            sign = -1 if piece == "/" else 1
            continue
        if (u := _factor(piece)) is None:
            return None
        scale *= u.scale**sign
        vector = tuple(a + sign * b for a, b in zip(vector, u.vector))
    return Unit(scale, vector)


def match_unit(text: str, at: int) -> tuple[Unit, int] | None:
    """The unit expression at this place of plain text, in parentheses or not, and where it ends."""
    m = _OPEN.match(text, at)
    if prime := _PRIME.match(text, at):
        return Unit(60.0 if len(prime[0]) == 1 and prime[0] != '"' else 1.0, _TIME), prime.end()
    u = _UNIT.match(text, m.end())
    if not u:
        return None
    letter = (u["deg"] or u["scale"] or "")[:1].upper()
    if letter and (u["deg"] or u["scale"] in ("C", "F", "K") or len(u["scale"]) > 1):
        unit = {"C": _CELSIUS, "F": _FAHRENHEIT, "K": _KELVIN}[letter]
    elif u["expr"]:
        unit = _expression(u["expr"])
        if unit is None and re.search(r"[\s/·]", u["expr"]):
            head = re.match(_FACTOR, u["expr"], re.IGNORECASE)[0]
            if (unit := _expression(head)) is not None:
                return (unit, u.start() + len(head)) if not m[1] else None
    else:
        unit = None
    if unit is None:
        return None
    end = u.end()
    if m[1]:
        close = re.compile(r"\s*\)").match(text, end)
        if not close:
            return None
        end = close.end()
    return unit, end


def _number(m: re.Match) -> float:
    if m.groupdict().get("word"):
        return float(_WORDS[m["word"].lower()])
    digits = m["int"]
    if re.fullmatch(r"[1-9]\d{0,2}(,\d{3})+(\.\d+)?", digits):
        digits = digits.replace(",", "")  # groups of three digits
    elif digits.count(",") == 1 and "." not in digits:
        digits = digits.replace(",", ".")
    elif digits.count(",") or digits.count(".") > 1:
        digits = digits.replace(",", "") if digits.count(".") <= 1 else digits.replace(".", "").replace(",", ".")
    value = float(digits) * 10.0 ** int((m["p10"] or m["exp"] or "0").replace("−", "-"))
    return -value if (m["sign"] or " ")[0] in "-−" else value


class Quantity(NamedTuple):
    """dim and common are None for a bare number, whose unit is to be found elsewhere."""

    dim: str | None
    common: float | None
    number: float


def parse_quantities(cell: str) -> list[Quantity]:
    """The quantities of a cell in reading order.

    Both ends of a range count, the first taking the unit of the second if it has none. Consecutive durations in falling units
    are one. Tolerances, concentrations, percentages and whatever else has no reported dimension count for nothing. A number
    without a unit is bare only if nothing else stands in the cell.
    """
    text = plain(cell)
    found: list[tuple[float, Unit | None, int, int]] = []
    at, skipped = 0, False
    while m := (found and found[-1][1] is not None and _GLUED.match(text, at)) or _SCAN.search(text, at):
        sign = m.groupdict().get("sign")
        begin = m.start()
        if sign and found and text[begin] in "-−" and not text[found[-1][3] : begin].strip():
            begin = m.end("sign")  # a dash between two numbers
        value = _number(m)
        if begin != m.start():
            value = abs(value)
        hit = match_unit(text, m.end())
        end = hit[1] if hit else m.end()
        if _TOLERANCE.search(text, 0, m.start()) or (sign and text[max(0, m.start() - 2) : m.start()].strip() == "±"):
            if found and found[-1][1] is None and hit:
                v, _, b, _ = found[-1]
                found[-1] = (v, hit[0], b, end)
            skipped = True
            at = end
            continue
        found.append((value, hit[0] if hit else None, begin, end))
        at = max(end, m.end())
    if not found:
        return []
    for k in range(len(found) - 2, -1, -1):  # a range's first end
        v, u, b, e = found[k]
        if u is None and found[k + 1][1] is not None and _RANGE.fullmatch(text, e, found[k + 1][2]):
            found[k] = (v, found[k + 1][1], b, e)
    if all(u is None for _, u, _, _ in found):
        rest, at = "", 0
        for _, _, b, e in found:
            rest, at = rest + " " + text[at:b], e
        rest += " " + text[at:]
        if skipped or _QUALIFIER.sub("", rest):
            return []
        return [Quantity(None, None, v) for v, *_ in found]
    out: list[Quantity] = []
    last: tuple[float, int] | None = None  # scale and end of a duration that a smaller part may continue
    for v, u, b, e in found:
        dim = u and DIMENSIONS.get(u.vector)
        if dim is None:
            last = None
            continue
        common = (v - u.shift) * u.scale
        if dim == "time" and last and u.scale < last[0] and _PART.fullmatch(text, last[1], b):
            out[-1] = Quantity(dim, out[-1].common + common, v)
        else:
            out.append(Quantity(dim, common, v))
        last = (u.scale, e) if dim == "time" else None
    return out


#: How papers name what a column holds.
TOPICS = {
    "Temperature": r"\btemperatures\b",
    "Time": r"\b(?:reaction|heating|holding|treatment)\s+times\b|\bdurations\b|\btimes of (?:reaction|heating)\b",
    "Precursor_Amount": r"\b(?:precursor|reagent|reactant)\s+(?:amounts|quantities)\b|\b(?:amounts|quantities)\s+of\s+(?:the\s+)?(?:precursors?|reagents?|reactants?|starting materials?)\b",
    "Solvent_Volume": r"\bsolvent\s+volumes\b|\bvolumes\s+of\s+(?:the\s+)?solvents?\b",
}
_TOPICS = {k: re.compile(v, re.IGNORECASE) for k, v in TOPICS.items()}
_LEAD = re.compile(r"\b(?:in|as|is|are)\s+(?:units?\s+of\s+)?|\(", re.IGNORECASE)


def stated_unit(sentence: str) -> tuple[str, str, float, float] | None:
    """(column, dimension, scale, shift) if the sentence states the unit of a column, else None."""
    text = plain(sentence)
    column = next((c for c, p in _TOPICS.items() if p.search(text)), None)
    if column is None:
        return None
    allowed = {"Temperature": ("temperature",), "Time": ("time",), "Precursor_Amount": ("mass", "amount", "volume"), "Solvent_Volume": ("volume",)}[column]
    for m in _LEAD.finditer(text):
        hit = match_unit(text, m.end() - (m[0] == "("))
        if hit and DIMENSIONS.get(hit[0].vector) in allowed and not re.match(r"\w", text[hit[1] : hit[1] + 1] or " "):
            return column, DIMENSIONS[hit[0].vector], hit[0].scale, hit[0].shift
    return None
