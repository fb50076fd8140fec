"""Plain text from simple LaTeX, line by line, with a guard that keeps lines a conversion would damage."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Ordered replacements that make unit notation plain.
UNIT_RULES = (
    ("\\\\upmu\\s*", "μ"), ("\\\\mu\\s*(?=[A-Za-z{])", "μ"), ("\\\\(?:mathrm|text|rm|operatorname)\\s*\\{([^{}]*)\\}", "$1"), ("\\^\\s*\\{?\\s*\\\\circ\\s*\\}?\\s*\\{?\\s*C\\s*\\}?", "°C"), ("\\\\degree\\s*C", "°C"), ("\\\\%", "%"),
)
#: Symbols by their commands.
SYMBOLS = {"alpha": "α", "beta": "β", "gamma": "γ", "lambda": "λ", "pi": "π", "tau": "τ", "Phi": "Φ", "times": "×", "pm": "±", "sim": "~", "approx": "≈", "cdot": "·", "rightarrow": "→", "leq": "≤", "geq": "≥"}


def plain_units(line: Column) -> Column:
    for pattern, new in UNIT_RULES:
        line = F.regexp_replace(line, pattern, new)
    return line


def plain_line(line: Column) -> Column:
    """The line without LaTeX: units, symbols, sub- and superscripts, remaining commands and dollar signs."""
    out = plain_units(line)
    for name, symbol in SYMBOLS.items():
        out = F.regexp_replace(out, f"\\\\{name}(?![A-Za-z])\\s?", symbol)
    out = F.regexp_replace(out, "[_^]\\s*\\{([^{}]*)\\}", "$1")
    out = F.regexp_replace(out, "\\\\[A-Za-z]+\\s*\\{([^{}]*)\\}", "$1")
    out = F.regexp_replace(out, "\\\\[A-Za-z]+\\s?", "")
    return F.regexp_replace(F.translate(out, "${}", ""), "[_^](?=\\w)", "")


def convert_line(line: Column) -> Column:
    """The plain line, or the line as it is if nothing would be left or a line of 20 characters or more would shrink to 60 % or less."""
    new = plain_line(line)
    bad = (F.trim(new) == "") | ((F.length(line) >= 20) & (F.length(F.trim(new)) <= 0.6 * F.length(line)))
    return F.when(bad & (F.trim(line) != ""), line).otherwise(new)
