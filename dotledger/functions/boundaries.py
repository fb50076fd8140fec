"""Where sentences and captions begin and end: patterns, tests on lines, protection of abbreviations and references, cuts. All column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Tests on a line or sentence; all engines read them alike.
STRONG_TERMINAL = r"[.?!;][)\]}\"']*\s*$"
CAPTION = r"^\s*(?:(?i:fig\.|figure|scheme|eq\.|\(for interpretation)|\(?[a-z]\))"
BRACKET_ONLY = r"^\s*[\[(][^\])]+[\])]\s*\.?\s*$"
CITATION_START = r"^\s*(?:\[\s*[0-9A-Za-z]|\(\s*[A-Za-z0-9])"
NUMBER_HEAD = r"^[0-9]+(?:\.[0-9]+)*\.$"
IMAGE = r"!\[[^\]]*\]\([^)]+\)"
HEADER = r"^\s*(#{1,6})\s+(.*\S)\s*$"
TABLE = r"(?is)<table\b.*?>.*?</table>"

#: A character that no text has, for what is protected, and one for cuts.
MARK, CUT = "\u0002", "\u0001"
#: Abbreviations whose full stop ends no sentence: (pattern, protected, protected pattern, restored); groups as $1.
ABBREVIATIONS = (
    (r"\bFig\.\s*([0-9]+[A-Za-z]?)\.", f"Fig{MARK}$1{MARK}", f"Fig{MARK}([0-9]+[A-Za-z]?){MARK}", "Fig. $1."), (r"\bFigure\s*([0-9]+[A-Za-z]?)\.", f"Figure{MARK}$1{MARK}", f"Figure{MARK}([0-9]+[A-Za-z]?){MARK}", "Figure $1."),
    (r"\bScheme\.?\s*([0-9]+[A-Za-z]?)\.", f"Scheme{MARK}$1{MARK}", f"Scheme{MARK}([0-9]+[A-Za-z]?){MARK}", "Scheme $1."), (r"\bEq\.\s*\(([0-9]+[A-Za-z]?)\)", f"Eq{MARK}($1)", f"Eq{MARK}\\(([0-9]+[A-Za-z]?)\\)", "Eq. ($1)"),
    (r"(?i)\betc\.", f"etc{MARK}", f"etc{MARK}", "etc."), (r"(?i)\bet\s+al\.", f"et{MARK}al{MARK}", f"et{MARK}al{MARK}", "et al."),
)
#: Numbered citations, and figure references before a mark or blank, with the words that protect them.
CITATION = r"\[(\s*[0-9]+[A-Za-z]?(?:\s*[,;–-]\s*[0-9]+[A-Za-z]?)*\s*)\]"
FIGURE_REFERENCE = r"(?i)\bFig\.\s+(S?[0-9]+[A-Za-z]?)([,.;\s)])"
#: Quotes of models' answers and the plain ones in the same order.
QUOTES = ("“”„‟«»‘’‚‛`´", "\"\"\"\"\"\"''''''")


def strong_terminal(c: Column) -> Column:
    return c.rlike(STRONG_TERMINAL)


def caption(c: Column) -> Column:
    return c.rlike(CAPTION)


def bracket_only(c: Column) -> Column:
    return c.rlike(BRACKET_ONLY)


def short_tail(c: Column, most: int = 4) -> Column:
    """At most `most` words; an empty text too."""
    return F.regexp_count(c, F.lit("\\S+")) <= most


def citation_start(c: Column) -> Column:
    return c.rlike(CITATION_START)


def protect_abbreviations(c: Column) -> Column:
    for pattern, protected, _, _ in ABBREVIATIONS:
        c = F.regexp_replace(c, pattern, protected)
    return c


def restore_abbreviations(c: Column) -> Column:
    for _, _, pattern, restored in ABBREVIATIONS:
        c = F.regexp_replace(c, pattern, restored)
    return c


def protect_references(c: Column) -> Column:
    """Citations and figure references as words without full stops."""
    c = F.regexp_replace(c, CITATION, "CITEREF§$1§")
    # A reference may begin where the last one's mark ended, so that two passes are needed.
    for _ in range(2):
        c = F.regexp_replace(c, FIGURE_REFERENCE, "FIGREF§$1§$2")
    return c


def restore_references(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "FIGREF§(.*?)§", "Fig. $1"), "CITEREF§(.*?)§", "[$1]")


def _pieces(marked: Column) -> Column:
    return F.filter(F.transform(F.split(marked, CUT), lambda x: F.regexp_replace(x, "^\\s+|\\s+$", "")), lambda x: x != "")


def cut_after_marks(c: Column) -> Column:
    """Pieces cut after a mark and its closers where a capital or opening bracket follows, even without white space."""
    return _pieces(F.regexp_replace(c, r"([.?!;][)\]}\"']*)\s*([\p{Lu}\[(])", f"$1{CUT}$2"))


def cut_at_blanks(c: Column) -> Column:
    """Pieces cut after a mark and its closers at white space before an ASCII capital or square bracket; a piece with a figure reference isn't parted
    from one that begins with S, the figure's panel."""
    marked = F.regexp_replace(c, r"([.!?;][)\]}»\"’']*)(\s+)([A-Z\[])", f"$1{CUT}$2$3")
    # A cut that doesn't hold: no other cut lies between it and the reference before it.
    kept = F.regexp_replace(marked, f"(FIGREF§[^{CUT}]*){CUT}(\\s+S)", "$1$2")
    kept = F.regexp_replace(kept, f"(FIGREF§[^{CUT}]*){CUT}(\\s+S)", "$1$2")
    return _pieces(kept)


def straight_quotes(c: Column) -> Column:
    return F.translate(c, *QUOTES)


#: White space of any kind, as names have it.
_BLANK = "[\\s\\p{Z}]"


def _squashed(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"{_BLANK}+", " "), "^ | $", "")


def token_key(c: Column) -> Column:
    """Lower case, one space for white space, no full stops outside."""
    return F.regexp_replace(_squashed(F.lower(c)), "^\\.+|\\.+$", "")


def full_name(c: Column, most: int = 8) -> Column:
    """A long form without closing marks, its last `most` words."""
    words = F.filter(F.split(F.regexp_replace(_squashed(c), "[.,;:!?）\\]]+$", ""), " "), lambda w: w != "")
    return token_key(F.array_join(F.slice(words, F.greatest(F.size(words) - most + 1, F.lit(1)), most), " "))


def bare_name(c: Column) -> Column:
    """A sample's name without Markdown emphasis, zero-width characters and quotes around it."""
    plain = _squashed(F.regexp_replace(c, "[\\u200b\\u2009\\u202f*`]", ""))
    for wrap in ("__", "~~", "_"):
        plain = F.regexp_replace(plain, f"^{wrap}(.*){wrap}$", "$1")
    return F.regexp_replace(plain, "^[\\s'\"“”‘’]+|[\\s'\"“”‘’]+$", "")
