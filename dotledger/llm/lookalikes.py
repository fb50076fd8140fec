"""One consistent form for text that looks the same.

Look-alike strings and code points are joined into transitive classes by union-find; the member that the corpus uses most, in
the script where it stands, represents its class; an Aho-Corasick automaton over all members rewrites text greedily, the longest
match first.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from dotledger.plans.session import ship_package, spread

#: Letters of Greek and Cyrillic that look like the Latin letter that begins the word.
LETTERS = {
    "A": "ΑА", "B": "ΒВ", "C": "СϹ", "D": "", "E": "ΕЕ", "H": "ΗН", "I": "ΙІ", "J": "Ј", "K": "ΚК", "M": "ΜМ", "N": "Ν", "O": "ΟО", "P": "ΡР", "S": "Ѕ", "T": "ΤТ", "X": "ΧХ", "Y": "ΥҮ", "Z": "Ζ",
    "a": "αа", "c": "сϲ", "d": "ԁ", "e": "е", "h": "һ", "i": "іι", "j": "јϳ", "k": "κ", "o": "οо", "p": "ρр", "q": "ԛ", "s": "ѕ", "u": "υ", "v": "νѵ", "w": "ԝ", "x": "хχ", "y": "уγ",
}
#: Characters without a shape of their own.
INVISIBLE = "\u00ad\u180e\u200b\u200c\u200d\u2060\u2061\u2062\u2063\u2064\ufeff"
#: Spaces and hyphens that look like the plain one.
SPACES, HYPHENS = "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000", "\u2010\u2011"
#: Letters and signs that are spelt twice in Unicode.
TWINS = {"\u212a": "K", "\u212b": "Å", "\u2126": "Ω", "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ"}

_JOINERS = "\u200c\u200d"
_JOINED = re.compile(r"[؀-ࣿऀ-෿က-႟ᠠ-ᢪ]")
_EMOJI = re.compile("[☀-➿️\U0001f000-\U0001faff]")
_LINE_BREAKING = re.compile("[฀-໿က-႟ក-៿]")
_CJK = re.compile("[⺀-鿿豈-﫿＀-￯가-힯]")
_RUN = re.compile(rf"[A-Za-zÀ-ÖØ-öø-ʯͰ-ϿЀ-ԯＡ-Ｚａ-ｚ̀-ͯ{INVISIBLE}]+")
#: Where the rewriter has to look at all; everything else is passed on as it is.
SUSPECT = "[\\u00ad\\u00a0\\u0132\\u0133\\u0300-\\u036f\\u0370-\\u03bf\\u03c1-\\u03ff\\u0400-\\u052f\\u180e\\u2000-\\u2011\\u202f\\u205f-\\u2064\\u2126\\u212a\\u212b\\u3000\\ufb00-\\ufb06\\ufeff\\uff10-\\uff19\\uff21-\\uff3a\\uff41-\\uff5a]"
_MIXED = re.compile("[A-Za-z][\u0400-\u04ff]|[\u0400-\u04ff][A-Za-z]")
_SUSPECT_RE2 = re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", SUSPECT)


def _script(ch: str) -> str:
    o = ord(ch)
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return "L"
    return "G" if o < 0x400 or 0x1F00 <= o < 0x2000 else "C"


class UnionFind:
    """Disjoint sets of strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: str, b: str) -> None:
        self.parent[self.find(b)] = self.find(a)

    def classes(self) -> list[list[str]]:
        groups = defaultdict(list)
        for x in self.parent:
            groups[self.find(x)].append(x)
        return list(groups.values())


def lookalike_classes() -> list[list[str]]:
    """The transitive classes; within each, the plainest member is first."""
    sets = UnionFind()
    for latin, others in LETTERS.items():
        for x in others:
            sets.join(latin, x)
    for x in INVISIBLE:
        sets.join("", x)
    for x in SPACES:
        sets.join(" ", x)
    for x in HYPHENS:
        sets.join("-", x)
    for x, y in TWINS.items():
        sets.join(y, x)
    for o in (*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)):
        sets.join(unicodedata.normalize("NFKC", chr(o)), chr(o))
    for o in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)):
        parts = unicodedata.normalize("NFD", chr(o))
        if len(parts) > 1 and unicodedata.normalize("NFC", parts) == chr(o):
            sets.join(chr(o), parts)
            if len(parts) == 3:  # the first mark alone may be composed
                sets.join(chr(o), unicodedata.normalize("NFC", parts[:2]) + parts[2])
    plain = lambda x: (not x.isascii(), len(x), x)
    return sorted((sorted(g, key=plain) for g in sets.classes()), key=lambda g: plain(g[0]))


CLASSES = lookalike_classes()
CLASS_OF = {x: k for k, g in enumerate(CLASSES) for x in g}
_LETTER_CLASS = {k for k, g in enumerate(CLASSES) if g[0] in LETTERS}
_PLAIN_STRINGS = [(k, x) for x, k in CLASS_OF.items() if x.isascii() and len(x) > 1]
_TWO_SCRIPTS = {x for k in _LETTER_CLASS for x in CLASSES[k] if len(x) == 1 and not 0xFF00 < ord(x) < 0xFF60}


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for x, k in CLASS_OF.items():
        if x and not x.isascii():
            a.add_word(x, (k, x))
    a.make_automaton()
    return a


class Rewriter:
    """Finds and rewrites members of the classes; representatives: by (class, script), the plainest member where none is given."""

    def __init__(self, representatives: dict[tuple[int, str], str] | None = None):
        self.automaton = _automaton()
        self.representatives = representatives or {}

    @staticmethod
    def _runs(text: str) -> list[tuple[int, int, str, str]]:
        """Begin, end, script told by letters of one script only ('' if none) and scripts present, of every run of letters."""
        out = []
        for m in _RUN.finditer(text):
            sure: Counter = Counter()
            seen = set()
            for ch in m[0]:
                if 0xFF00 < ord(ch):
                    if ch not in INVISIBLE:
                        sure["L"] += 1
                elif ch.isalpha():
                    s = _script(ch)
                    seen.add(s)
                    if ch not in _TWO_SCRIPTS and ch not in "μµ":
                        sure[s] += 1
            if sure or seen:
                out.append((m.start(), m.end(), max(sure, key=sure.get) if sure else "", "".join(sorted(seen))))
        return out

    def _context(self, runs: list, k: int, text: str) -> str:
        """The script in which a run stands."""
        begin, end, sure, seen = runs[k]
        if sure:
            return sure
        near = {r[2] for r in runs[max(0, k - 6) : k + 7] if r[2]}
        if seen in ("C", "G", "L"):  # all letters are shared by scripts; a foreign one is kept if its script is used near by
            word = text[begin:end].strip(INVISIBLE)
            if seen in near or not near or seen == "L":
                return seen
            if seen == "G" and len(word) == 1 and word.islower() and word != "ο":
                return "G"
        return max(("L", "C", "G"), key=lambda s: (s in near, s == "L"))

    def occurrences(self, text: str) -> Iterator[tuple[int, int, int, str, str]]:
        """(begin, end, class, member, context) of every member that isn't plain ASCII and of which others could stand there.

        Joiners within scripts and emoji that need them, soft breaks of scripts without spaces, spaces between ideographs and
        single scientific Greek letters are no occurrences.
        """
        runs = None
        at = 0
        for last, (k, member) in self.automaton.iter_long(text):
            begin, end = last + 1 - len(member), last + 1
            context = ""
            first = CLASSES[k][0]
            if first == "":
                before, after = text[begin - 1 : begin], text[end : end + 1]
                if member in _JOINERS and (_JOINED.match(before) or _JOINED.match(after) or _EMOJI.match(before) and _EMOJI.match(after)):
                    continue
                if member == "\u200b" and _LINE_BREAKING.match(before) and _LINE_BREAKING.match(after):
                    continue
            elif member == "\u3000" and (_CJK.match(text[begin - 1 : begin]) or _CJK.match(text[end : end + 1])):
                continue
            elif k in _LETTER_CLASS:
                if 0xFF00 < ord(member[0]):
                    context = "L"
                else:
                    if runs is None:
                        runs = self._runs(text)
                    while at < len(runs) and runs[at][1] <= begin:
                        at += 1
                    if at == len(runs) or runs[at][0] > begin:
                        continue
                    context = self._context(runs, at, text)
                    if context == "L" and _script(member[0]) == "G" and member not in "οΟ" and member.islower() and begin == runs[at][0] and member != "ν":
                        continue  # a Greek symbol before a Latin index
            yield begin, end, k, member, context

    def representative(self, k: int, context: str) -> str:
        return self.representatives.get((k, context), CLASSES[k][0] if context in ("", "L") else next((x for x in CLASSES[k] if x and _script(x[0]) == context), CLASSES[k][0]))

    def rewrite(self, text: str) -> str:
        out, at = [], 0
        for begin, end, k, member, context in self.occurrences(text):
            if (new := self.representative(k, context)) != member:
                out += (text[at:begin], new)
                at = end
        if out:
            out.append(text[at:])
            text = "".join(out)
        return self._foreign(text) if _MIXED.search(text) else text

    def _foreign(self, text: str) -> str:
        """Latin letters within words of another script."""
        out, at = [], 0
        for begin, end, sure, seen in self._runs(text):
            if sure not in ("", "L") and "L" in seen:
                new = "".join(self.representative(CLASS_OF[x], sure) if x.isascii() and x in LETTERS and CLASSES[CLASS_OF[x]][1:] else x for x in text[begin:end])
                out += (text[at:begin], new)
                at = end
        return "".join(out) + text[at:]


def count_members(tables: list[tuple[DataFrame, str]]) -> dict[tuple[int, str], Counter]:
    """How often each class member stands in each script, over all rows of all (table, text column) pairs.

    The result has an entry per member of the fixed classes and script, whatever the corpus. Plain characters are counted from
    the Arrow bytes, plain strings wherever they stand.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewriter = Rewriter()
        counts: Counter = Counter()
        for batch in batches:
            column = batch.column(0)
            _, offsets, data = column.buffers()
            if data is None or not len(column):
                continue
            off = np.frombuffer(offsets, np.int32, count=len(column) + 1, offset=4 * column.offset)
            plain = np.bincount(np.frombuffer(data, np.uint8)[off[0] : off[-1]], minlength=128)
            for o in np.flatnonzero(plain[:128]).tolist():
                if (k := CLASS_OF.get(chr(o))) is not None:
                    counts[k, "L" if k in _LETTER_CLASS else "", chr(o)] += int(plain[o])
            for k, x in _PLAIN_STRINGS:
                if n := pc.sum(pc.count_substring(column, x)).as_py():
                    counts[k, "", x] += n
            for text in column.filter(pc.match_substring_regex(column, _SUSPECT_RE2 + "|[À-ɏ]")).to_pylist():
                for _, _, k, member, context in rewriter.occurrences(text):
                    counts[k, context, member] += 1
        if counts:
            columns = list(zip(*((*key, n) for key, n in counts.items())))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1]), pa.array(columns[2]), pa.array(columns[3], pa.int64())], ["k", "context", "member", "n"])

    parts = [spread(df.select(F.col(c).cast("string").alias("t")).filter("t is not null")).mapInArrow(count, "k int, context string, member string, n bigint") for df, c in tables]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionAll(p)
    out: dict[tuple[int, str], Counter] = defaultdict(Counter)
    for r in every.groupBy("k", "context", "member").agg(F.sum("n").alias("n")).collect():
        out[r["k"], r["context"]][r["member"]] = r["n"]
    return out


def choose_representatives(counts: dict[tuple[int, str], Counter]) -> dict[tuple[int, str], str]:
    """The most frequent member of each class and script, among those of that script; the plainest of equals.

    What has no shape is always represented by nothing.
    """
    out = {}
    for (k, context), seen in counts.items():
        able = [x for x in CLASSES[k] if not context or not x or _script(x[0]) == context and ord(x[0]) < 0xFF00]
        if CLASSES[k][0] == "":
            out[k, context] = ""
        elif able:
            out[k, context] = min(able, key=lambda x: (-seen.get(x, 0), CLASSES[k].index(x)))
    return out


def consistent_text(tables: list[tuple[str, DataFrame, str, str]], changed_only: bool = False) -> DataFrame:
    """Rows (src, row_id, text, changed boolean) of the (source, table, key, text column) tuples, with text in its consistent form.

    changed_only: only the rows whose text changes. Null stays null and empty text empty; repeated rows give repeated rows. Two
    scans and no shuffle but that of the counts, whose size is fixed; only texts with suspect characters go through Python in
    the second.
    """
    ship_package(tables[0][1].sparkSession)
    representatives = choose_representatives(count_members([(df, text) for _, df, _, text in tables]))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewriter = Rewriter(representatives)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            new = [rewriter.rewrite(t) for t in texts]
            changed = [a != b and not b.isspace() and b != "" for a, b in zip(texts, new)]  # a text without visible characters shows nothing
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(new, pa.string()), pa.array(changed)], ["src", "row_id", "text", "changed"])
            yield out.filter(out.column(3)) if changed_only else out

    parts = []
    for src, df, key, text in tables:
        rows = df.select(F.lit(src).alias("src"), F.col(key).cast("bigint").alias("row_id"), F.col(text).cast("string").alias("text"))
        suspect = F.col("text").rlike(SUSPECT)
        parts.append(spread(rows.filter(suspect)).mapInArrow(rewrite, "src string, row_id bigint, text string, changed boolean"))
        if not changed_only:
            parts.append(rows.filter(F.col("text").isNull() | ~suspect).withColumn("changed", F.lit(False)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out
