"""Figures, tables and pieces of sentences within a block. Each rule looks at the piece before as it has become, so these are folds over the pieces of a block."""

from __future__ import annotations

import re
from typing import NamedTuple

from dotledger.functions.boundaries import BRACKET_ONLY, CAPTION, CITATION_START, HEADER, IMAGE, NUMBER_HEAD, STRONG_TERMINAL, TABLE

_TERMINAL, _CAPTION, _BRACKETS, _CITATION, _NUMBERING, _IMAGE, _HEADER, _TABLE = map(re.compile, (STRONG_TERMINAL, CAPTION, BRACKET_ONLY, CITATION_START, NUMBER_HEAD, IMAGE, HEADER, TABLE))
_PANEL = re.compile(r"[A-Za-z]?[0-9]+[A-Za-z]?\.?")
_ENDS = tuple(".?!;:")


class Piece(NamedTuple):
    """A sentence or figure of a block; base: the number of the segment it comes from."""

    text: str
    figure: bool = False
    base: int = 1


def _words(text: str) -> int:
    return len(text.split())


def _folded(pieces: list, rule) -> list:
    """`rule` over pieces; strings are taken as text and given back as strings."""
    plain = all(isinstance(p, str) for p in pieces)
    out = rule([Piece(p) if isinstance(p, str) else p for p in pieces])
    return [p.text for p in out] if plain else out


def _joined(a: Piece, b: Piece) -> Piece:
    return a._replace(text=f"{a.text.rstrip()} {b.text.lstrip()}".strip())


def figure_paragraphs(text: str) -> list[Piece]:
    """Paragraphs of a block, figures apart. An image takes the captions after it, an unfinished line before it, and one line of at most
    twelve words after; images that only blank lines part are one figure."""
    lines = text.splitlines()
    out: list[Piece] = []
    loose: list[str] = []

    def close() -> None:
        out.extend(Piece(p.strip()) for p in re.split(r"\n\s*\n+", "\n".join(loose)) if p.strip())
        loose.clear()

    at = 0
    while at < len(lines):
        if not _IMAGE.search(lines[at]):
            loose.append(lines[at])
            at += 1
            continue
        while loose and not loose[-1].strip():
            loose.pop()
        parts = [loose.pop().strip()] if loose and not _TERMINAL.search(loose[-1].rstrip()) else []
        again = not loose and not parts and bool(out) and out[-1].figure
        close()
        while at < len(lines) and _IMAGE.search(lines[at]) and not _HEADER.match(lines[at]):
            parts.append(lines[at].strip())
            at += 1
            while at < len(lines) and not _HEADER.match(lines[at]) and not _IMAGE.search(lines[at]):
                if lines[at].strip():
                    parts.append(lines[at].strip())
                elif not (at + 1 < len(lines) and _CAPTION.match(lines[at + 1]) and lines[at + 1].strip()):
                    at += 1
                    break
                at += 1
        if at < len(lines) and lines[at].strip() and not _HEADER.match(lines[at]) and not _IMAGE.search(lines[at]) and _words(lines[at]) <= 12:
            parts.append(lines[at].strip())
            at += 1
        body = " \n".join(parts)
        out.append(Piece(f"{out.pop().text}\n \n{body}" if again else body, True))
    close()
    return out


def figure_segments(text: str) -> list[Piece]:
    """Segments of a block: tables and images with the lines up to the next blank one are figures, what lies between them is joined."""
    kinds: list[tuple[str, str]] = []
    at = 0
    for m in _TABLE.finditer(text):
        kinds += [("line", x) for x in text[at : m.start()].splitlines()] + [("table", m[0].strip())]
        at = m.end()
    kinds += [("line", x) for x in text[at:].splitlines()]
    out: list[Piece] = []
    held: list[str] = []
    image = False

    def close(figure: bool) -> None:
        joined = " ".join(x.strip() for x in held if x.strip())
        if joined:
            out.append(Piece(joined, figure, len(out) + 1))
        held.clear()

    for kind, x in kinds:
        if kind == "table":
            close(image)
            image = False
            out.append(Piece(x, True, len(out) + 1))
        elif _IMAGE.search(x):
            close(image)
            image = True
            held.append(x)
        elif image and not x.strip():
            close(True)
            image = False
        else:
            held.append(x)
    close(image)
    return out


def merge_short_pieces(pieces: list[str], most: int = 4) -> list[str]:
    """A bracketed piece, one of at most `most` words, or a citation after an unfinished piece joins the piece before."""
    out: list[str] = []
    for p in (x.strip() for x in pieces):
        if out and p and (_BRACKETS.match(p) or _words(p) <= most or _CITATION.match(p) and not _TERMINAL.search(out[-1])):
            out[-1] = f"{out[-1].rstrip()} {p}"
        elif p:
            out.append(p)
    return out


def _is_title(p: Piece, title: str) -> bool:
    return bool(title.strip()) and p.text.strip().lower() == title.strip().lower()


def merge_short_heads(pieces: list, most: int = 5, title: str = "") -> list:
    """An unfinished piece of at most `most` words, or a bare number with a point, joins the piece after it; titles and figures don't."""

    def rule(ps: list[Piece]) -> list[Piece]:
        out: list[Piece] = []
        for p in ps:
            if out and not (out[-1].figure or p.figure or _is_title(out[-1], title) or _is_title(p, title)):
                head = out[-1].text.strip()
                if head and _words(head) <= most and (not head.endswith(_ENDS) or _NUMBERING.match(head)):
                    out[-1] = _joined(out[-1], p)
                    continue
            out.append(p)
        return out

    return _folded(pieces, rule)


def merge_heads_across_figures(pieces: list) -> list:
    """Text before figures takes the text after them, if it is unfinished or that begins in lower case; then the next one, as long as a figure lies between."""

    def rule(ps: list[Piece]) -> list[Piece]:
        out: list[Piece] = []
        open_at = None  # the last text, with only figures after it
        for p in ps:
            behind = open_at is not None and open_at < len(out) - 1
            if not p.figure and p.text.strip() and behind and (not out[open_at].text.strip().endswith(_ENDS) or p.text.lstrip()[:1].islower()):
                out[open_at] = _joined(out[open_at], p)._replace(base=min(out[open_at].base, p.base))
                continue
            out.append(p)
            if not p.figure:
                open_at = len(out) - 1 if p.text.strip() else None
        return out

    return _folded(pieces, rule)


def merge_tails_around_figures(pieces: list, most: int = 5) -> list:
    """A text of at most `most` words right after a figure joins the text before the figures."""

    def rule(ps: list[Piece]) -> list[Piece]:
        out: list[Piece] = []
        after_figure = False
        for p in ps:
            text_before = next((k for k in range(len(out) - 1, -1, -1) if not out[k].figure), None) if after_figure else None
            if text_before is not None and not p.figure and _words(p.text) <= most:
                out[text_before] = _joined(out[text_before], p)
                after_figure = False
            else:
                out.append(p)
                after_figure = p.figure
        return out

    return _folded(pieces, rule)


def merge_orphans(pieces: list, most: int = 5, title: str = "") -> list:
    """What goes on with the piece before joins it: a citation after et al., anything after i.e. or e.g., a lower-case start after a full stop, and short
    tails. Titles and figures neither join nor are joined; blank pieces are dropped."""

    def goes_on(before: str, p: str) -> bool:
        low, end = before.lower(), before[-1:]
        if low.endswith("et al.") and p.startswith("[") or low.endswith(("i.e.", "e.g.")) or end == "." and p[0].islower():
            return True
        if _words(p) > most:
            return False
        return end not in ".?!;" or p[0].islower() or p[0] in ")]}%±+-[(" or p[0].isdigit() or not p.rstrip().endswith(_ENDS) or bool(_PANEL.fullmatch(p.rstrip()))

    def rule(ps: list[Piece]) -> list[Piece]:
        out: list[Piece] = []
        for p in ps:
            if out and not (out[-1].figure or p.figure or _is_title(out[-1], title) or _is_title(p, title)):
                if not p.text.strip():
                    continue
                if goes_on(out[-1].text.strip(), p.text.lstrip()):
                    out[-1] = _joined(out[-1], p)
                    continue
            out.append(p)
        return out

    return _folded(pieces, rule)


def balanced_items(value: str, separators: str = ",;，；") -> list[str]:
    """The items of a list, split outside of round, square and full-width brackets."""
    out, depth, start = [], 0, 0
    for k, c in enumerate(value):
        if c in "([（":
            depth += 1
        elif c in ")]）":
            depth = max(0, depth - 1)
        elif c in separators and not depth:
            out.append(value[start:k].strip())
            start = k + 1
    return [x for x in (*out, value[start:].strip()) if x]


def wrap(text: str, width: int = 17) -> list[str]:
    """Lines of at most `width` characters, broken at spaces, or within a longer word."""
    lines, line = [], ""
    for word in text.split():
        while len(word) > width:
            if line:
                lines.append(line)
                line = ""
            lines.append(word[:width])
            word = word[width:]
        if line and len(line) + 1 + len(word) > width:
            lines.append(line)
            line = word
        else:
            line = f"{line} {word}".strip()
    return lines + ([line] if line else [])
