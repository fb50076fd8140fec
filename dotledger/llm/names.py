"""Mapping free-typed sample names to the entries of a reference list.

Values are deduplicated where they are scanned, normalised and parsed into dopant, stem, kind and number. Stems meet the
reference list over an inverted index of character n-grams and are scored by weighted cosine; a best score over the threshold
and ahead of the next by the margin is accepted, if an exact check of the parts agrees. The parser is a parameter: `parse_name` reads
names of samples, `plain_name` takes any value (cities, brands, titles) as a stem without further parts.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dotledger.llm.lookalikes import Rewriter
from dotledger.plans.session import cut, ship_package

#: Least weighted cosine of an accepted stem, its least lead over the next one, and the most edits that the exact check allows.
THRESHOLD, MARGIN, EDITS = 0.35, 0.03, 2
#: Entries of a reference list that are sent to the executors at once; a longer list is matched in groups of this size.
MOST_ENTRIES = 100_000
#: Values that a worker remembers; beyond it, matching starts afresh, with the same results.
MEMO = 50_000

#: Ways of writing null, in any case.
NULLS = ("", "-", "n/a", "na", "not reported")
#: Kinds of dots, with the ways of writing them after case folding.
KINDS = {
    "CQD": r"carbon\s*quantum\s*dots?|c-?qds?",
    "GQD": r"graphene\s*quantum\s*dots?|g-?qds?",
    "CND": r"carbon\s*nano-?dots?|c-?nds?",
    "CD": r"carbon\s*dots?|c-?dots?|cds?",
}
#: Dopants by name.
ELEMENTS = {
    "nitrogen": "n", "sulfur": "s", "sulphur": "s", "boron": "b", "phosphorus": "p", "phosphorous": "p", "manganese": "mn", "zinc": "zn", "fluorine": "f", "chlorine": "cl", "iron": "fe", "copper": "cu", "cobalt": "co",
    "silicon": "si", "selenium": "se", "magnesium": "mg", "europium": "eu", "gadolinium": "gd", "terbium": "tb", "nickel": "ni", "silver": "ag", "gold": "au", "cerium": "ce", "aluminium": "al", "aluminum": "al",
}

_SYMBOLS = "|".join(sorted(set(ELEMENTS.values()), key=lambda x: (-len(x), x)))
_DOPANT = rf"(?:{'|'.join(ELEMENTS)}|{_SYMBOLS})(?:\s*[,/&+]\s*(?:{'|'.join(ELEMENTS)}|{_SYMBOLS}))*"
_KIND = re.compile("|".join(rf"(?P<{k}>{v})" for k, v in KINDS.items()))
_KIND_END = re.compile(rf"(?:{_KIND.pattern})(?![a-z])")
_DOPED = re.compile(rf"\b({_DOPANT})[\s-]*(?:co-?)?doped\b")
_LEADING = re.compile(rf"^({_DOPANT})(?=[\s_/.\-–]+[a-z])")
_NOISE = re.compile(r"\((?:in )?(?:this|present) (?:work|study|paper)\)|^(?:the|a|an|our|sample|as[- ]prepared|as[- ]synthesi[sz]ed|fresh)\b[\s:]*")
_NUMBER = re.compile(r"(?:\bno\.?|#|№|\bnr\.?|\bbatch)?\s*[-_/.(\s]*(\d+)\s*\)?\s*$")
_INNER_NUMBER = re.compile(r"^[\s\-_/.#]*(?:no\.?|#)?[\s\-_/.]*(\d+)")


def parse_name(folded: str) -> tuple[str, str, str, str] | None:
    """(dopant, stem, kind, number) of a case-folded name without look-alikes; empty parts where it tells none, None if it names no dots."""
    x = folded.strip().strip("'\"`´‘’“”").strip()
    while (y := _NOISE.sub("", x).strip().strip("'\"").strip()) != x:
        x = y
    dopant = number = ""
    if m := _DOPED.search(x):
        dopant = m[1]
        x = (x[: m.start()].rstrip(" ,;(") + " " + x[m.end() :].lstrip(" -_/.")).strip()
    kinds = list(_KIND_END.finditer(x))
    if not kinds:
        return None
    k = kinds[-1] if kinds[0].start() else kinds[0]
    kind = k.lastgroup
    head, tail = x[: k.start()], x[k.end() :]
    if m := _INNER_NUMBER.match(tail):
        number, tail = m[1], tail[m.end() :]
    if m := re.search(r"\(\s*([^()]*[a-z][^()]*)\)", tail):  # the stem in parentheses after the kind
        head, tail = head + " " + m[1], tail[: m.start()] + tail[m.end() :]
    if not number and (m := _NUMBER.search(tail)):
        number, tail = m[1], tail[: m.start()]
    head = head.strip(" -_/.,;:()")
    if not dopant and (m := _LEADING.match(head)):
        dopant, head = m[1], head[m.end() :]
    if not number and (m := re.search(r"(\d+)$", head)):
        number, head = m[1], head[: m.start()]
    rest = re.sub(r"[^a-z0-9]+", "", tail)
    stem = re.sub(r"[^a-z0-9]+", "", head)
    symbols = sorted(ELEMENTS.get(d, d) for d in re.split(r"\s*[,/&+]\s*", dopant) if d)
    return ",".join(symbols), stem + rest, kind, str(int(number)) if number else ""


def plain_name(folded: str) -> tuple[str, str, str, str] | None:
    """A folded value as a stem: its letters and digits, in any script."""
    stem = "".join(c for c in folded if c.isalnum())
    return ("", stem, "", "") if stem else None


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, replacements and swaps of neighbours between the strings, or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        two, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, two[j - 2] + 1)
            row.append(cost)
        if min(row) > most and min(before) > most:
            return most + 1
    return row[-1]


class Matcher:
    """Finds the entry meant by a typed name. weights: those of n-grams over a longer list of which `entries` is a part."""

    def __init__(self, entries: list[tuple[int, str]], parse: Callable = parse_name, weights: dict[str, float] | None = None):
        self.rewriter = Rewriter()
        self.parse = parse
        self.ids: dict[tuple[str, str, str, str], int] = {}
        self.whole: dict[str, int] = {}
        for name_id, name in sorted(entries):
            parsed = parse(self.fold(name))
            self.whole.setdefault(self.fold(name).strip(), name_id)
            if parsed and parsed[1]:
                self.ids.setdefault(parsed, name_id)
        self.stems = sorted({p[1] for p in self.ids})
        self.weight = gram_weights(Counter(g for s in self.stems for g in set(self.grams(s))), len(self.stems)) if weights is None else weights
        self.index: dict[str, list[int]] = defaultdict(list)
        self.vectors = []
        for i, s in enumerate(self.stems):
            vector, norm = self.vector(s)
            self.vectors.append({g: w / norm for g, w in vector.items()})
            for g in vector:
                self.index[g].append(i)
        self._ranked: dict[str, tuple] = {}
        self.seen = self.compared = 0

    def fold(self, value: str) -> str:
        return self.rewriter.rewrite(value).casefold() if not value.isascii() else value.casefold()

    @staticmethod
    def grams(stem: str) -> list[str]:
        """Pairs of neighbours in alphabetical order (as typists swap them) and triples."""
        x = f"^{stem}$"
        return [*("".join(sorted(x[k : k + 2])) for k in range(len(x) - 1)), *(x[k : k + 3] for k in range(len(x) - 2))]

    def vector(self, stem: str) -> tuple[dict[str, float], float]:
        out = {g: c * self.weight.get(g, self.weight[""]) for g, c in Counter(self.grams(stem)).items()}
        return out, math.sqrt(sum(w * w for w in out.values())) or 1.0

    def candidates(self, unit: dict[str, float]) -> set[int]:
        """All stems whose cosine can reach the threshold, and few others: those with one of the rarest n-grams, without which the rest of the vector is
        shorter than the threshold."""
        out: set[int] = set()
        left = 1.0
        for g, w in sorted(unit.items(), key=lambda x: (len(self.index.get(x[0], ())), x[0])):
            if left < THRESHOLD * THRESHOLD:
                break
            out.update(self.index.get(g, ()))
            left -= w * w
        return out

    def ranked(self, typed: str) -> tuple[str | None, float, float]:
        """(best stem, its cosine, that of the next), with stems under the threshold left out."""
        if (known := self._ranked.get(typed)) is not None:
            return known
        vector, norm = self.vector(typed)
        unit = {g: w / norm for g, w in vector.items()}
        found = self.candidates(unit)
        self.seen += 1
        self.compared += len(found)
        scores = sorted(((-sum(w * self.vectors[i].get(g, 0.0) for g, w in unit.items()), i) for i in found))[:2]
        scores = [(-s, i) for s, i in scores if -s >= THRESHOLD]
        out = (self.stems[scores[0][1]], scores[0][0], scores[1][0] if len(scores) > 1 else 0.0) if scores else (None, 0.0, 0.0)
        if len(self._ranked) > MEMO:
            self._ranked.clear()
        self._ranked[typed] = out
        return out

    def stem(self, typed: str) -> str | None:
        """The accepted stem of the list, or None."""
        return accepted(typed, *self.ranked(typed))

    def match(self, value: str) -> int:
        """The name_id of the entry meant, or -1."""
        folded = self.fold(value)
        if (hit := self.whole.get(folded.strip())) is not None:
            return hit
        parsed = self.parse(folded)
        if not parsed or not parsed[1]:
            return -1
        stem = self.stem(parsed[1])
        return self.ids.get((parsed[0], stem, *parsed[2:]), -1) if stem else -1


def gram_weights(stems_with: dict[str, int], stems: int) -> dict[str, float]:
    """The weight of every n-gram by the number of stems that have it; under the empty string that of others."""
    n = max(1, stems)
    return {g: math.log1p(n / c) for g, c in stems_with.items()} | {"": math.log1p(n)}


def accepted(typed: str, best: str | None, score: float, following: float) -> str | None:
    """The best stem, if it is the typed one, or leads by the margin and has few edits."""
    if best is None or typed == best:
        return best
    near = score >= THRESHOLD and (not following or score - following >= MARGIN)
    return best if near and edits(typed, best, EDITS) <= (EDITS if len(best) >= 7 else 1) else None


#: The matcher of the last list, kept by a worker from one task to the next.
_KEPT: dict[str, Matcher] = {}


def _kept(token: str, make: Callable[[], Matcher]) -> Matcher:
    if token not in _KEPT:
        _KEPT.clear()
        _KEPT[token] = make()
    return _KEPT[token]


def map_names(tables: list[tuple[str, DataFrame, str, str]], entries: DataFrame, key: str = "name_id", name: str = "name", parse: Callable = parse_name, most: int = MOST_ENTRIES) -> DataFrame:
    """Rows (src, row_id, value, name_id) for the (source, table, key, column) tuples: the entry each typed value means, or -1.

    Values that are null, a way of writing null, or literally an entry's name give no row. Of entries with equal parts the
    least id holds. A name means an entry only if dopant, kind and number agree with it and the stem is accepted. A list of at most `most`
    entries is sent to the executors; each scanned batch matches its distinct values once, without a shuffle, so frequent values cost
    nothing more. A longer list is cut into groups of that size, each distinct value is compared with every group, and the best of
    the groups' best holds: the same result, with a shuffle of the distinct values.
    """
    spark = entries.sparkSession
    ship_package(spark)
    usable = entries.select(F.col(key).cast("bigint").alias("i"), F.col(name).cast("string").alias("e")).filter("i is not null and e is not null")
    literal = usable.select(F.col("e").alias("value")).distinct()
    listed = [(r[0], r[1]) for r in usable.limit(most + 1).collect()]
    short = len(listed) <= most
    shared = spark.sparkContext.broadcast(listed if short else None)
    token = uuid.uuid4().hex

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, memo = _kept(token, lambda: Matcher(shared.value, parse)), {}
        for batch in batches:
            coded = batch.column(2).dictionary_encode()
            found = []
            for value in coded.dictionary.to_pylist():
                if (hit := memo.get(value)) is None:
                    if len(memo) > MEMO:
                        memo.clear()
                    hit = memo[value] = matcher.match(value)
                found.append(hit)
            ids = pa.array(found, pa.int64()).take(coded.indices)
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], ["src", "row_id", "value", "name_id"])

    parts = []
    for src, df, row, column in tables:
        rows = df.select(F.lit(src).alias("src"), F.col(row).cast("bigint").alias("row_id"), F.col(column).cast("string").alias("value"))
        rows = rows.filter(F.col("value").isNotNull() & ~F.lower(F.trim("value")).isin(*NULLS)).join(F.broadcast(literal) if short else literal, "value", "left_anti").select("src", "row_id", "value")
        parts.append(rows.mapInArrow(match, "src string, row_id bigint, value string, name_id bigint") if short else rows)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out if short else _map_grouped(out, usable, parse, most)


def _map_grouped(rows: DataFrame, entries: DataFrame, parse: Callable, most: int) -> DataFrame:
    """`map_names` with a list that is too long to be sent at once."""
    spark = rows.sparkSession
    parts = "folded string, dopant string, stem string, kind string, number string"

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Matcher([], parse)
        for batch in batches:
            folded = [folder.fold(v) for v in batch.column(0).to_pylist()]
            told = [parse(f) or (None,) * 4 for f in folded]
            columns = [[f.strip() for f in folded], *zip(*told)] if told else [[]] * 5
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.string()) for c in columns)], [*batch.schema.names, *(p.split()[0] for p in parts.split(", "))])

    known = cut(entries.select("e", "i").mapInArrow(parsed, f"e string, i bigint, {parts}"))
    stems = known.filter("stem <> ''").select("stem").distinct()

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([g for s in batch.column(0).to_pylist() for g in set(Matcher.grams(s))], pa.string())], ["g"])

    total = stems.count()
    # Stems are made of a fixed set of characters, and n-grams have at most three: their number doesn't grow with the list.
    weights = gram_weights({r[0]: r[1] for r in stems.mapInArrow(spelt, "g string").groupBy("g").count().collect()}, total)
    values = cut(rows.select("value").distinct().mapInArrow(parsed, f"value string, {parts}"))
    typed = values.filter("stem <> ''").select("stem").distinct()
    groups = -(-total // most) * 2
    ranked = None
    for k in range(groups):
        group = spark.sparkContext.broadcast([r[0] for r in stems.filter(F.pmod(F.xxhash64("stem"), F.lit(groups)) == k).collect()])
        token = uuid.uuid4().hex

        def rank(batches: Iterator[pa.RecordBatch], group=group, token=token) -> Iterator[pa.RecordBatch]:
            matcher = _kept(token, lambda: Matcher(list(enumerate(group.value)), lambda x: ("", x, "", ""), weights))
            for batch in batches:
                found = [(s, *matcher.ranked(s)) for s in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.string(), pa.float64(), pa.float64()))] if found else [pa.array([], t) for t in (pa.string(), pa.string(), pa.float64(), pa.float64())], ["stem", "best", "score", "following"])

        part = typed.mapInArrow(rank, "stem string, best string, score double, following double").filter("best is not null")
        ranked = part if ranked is None else ranked.unionAll(part)
    both = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("best").alias("b"), "following")))
    top = ranked.groupBy("stem").agg(both.alias("r"))
    top = top.select("stem", F.col("r")[0]["b"].alias("best"), (-F.col("r")[0]["s"]).alias("score"), F.greatest(F.col("r")[0]["following"], -F.coalesce(F.try_element_at("r", F.lit(2))["s"], F.lit(0.0))).alias("following"))

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [accepted(*x) for x in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["stem", "meant"])

    meant = top.mapInArrow(accept, "stem string, meant string")
    ids = known.filter("stem <> ''").groupBy("dopant", F.col("stem").alias("meant"), "kind", "number").agg(F.min("i").alias("by_parts"))
    whole = known.groupBy("folded").agg(F.min("i").alias("by_name"))
    found = values.join(meant, "stem", "left").join(ids, ["dopant", "meant", "kind", "number"], "left").join(whole, "folded", "left")
    found = found.select("value", F.coalesce("by_name", "by_parts", F.lit(-1)).cast("bigint").alias("name_id"))
    return rows.join(found, "value").select("src", "row_id", "value", "name_id")


def unmatched_values(mapped: DataFrame) -> DataFrame:
    """Rows (src, value, n), the values that mean no entry and how often each stands."""
    return mapped.filter("name_id = -1").groupBy("src", "value").agg(F.count("*").alias("n"))
