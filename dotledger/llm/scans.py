"""Repairing the text of scanned pages: running lines, parted words, misread characters, broken paragraphs.

Lines are examined with SQL windows: running headers, footers and page numbers show by their form and by masks (digits masked)
that recur in a document. What is left is reflowed. Parted words are settled by the corpus' own words; words that no
undamaged text has are grouped with known words by a skeleton of glyph strokes, and the known form that needs the fewest
confusions, has the best support by its neighbours and is most frequent is chosen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dotledger.plans.session import cut, ship_package, spread

#: A text is taken for scanned, or at least for wrapped, if two lines with text follow each other.
WRAPPED = "[^\\n]\\r?\\n[^\\r\\n]"
#: Least count, in text that isn't wrapped, of a word taken as the right one, and how much more frequent than the misread it must be.
LEAST, RATIO = 3, 4
#: Most confusions in a word: this many, or one in so many letters of a longer word.
MOST_CONFUSIONS, LETTERS_EACH = 3, 3
#: Words that a Python worker counts before it hands them on.
HELD = 200_000

#: What scanners confuse, (right, seen).
CONFUSIONS = (
    ("e", "c"), ("c", "e"), ("o", "0"), ("s", "5"), ("l", "1"), ("i", "1"), ("l", "i"), ("i", "l"), ("d", "cl"), ("cl", "d"), ("h", "b"), ("b", "h"), ("h", "li"), ("li", "h"), ("m", "rn"), ("rn", "m"), ("in", "m"), ("m", "in"),
    ("ni", "m"), ("g", "9"), ("q", "9"), ("b", "6"), ("w", "vv"), ("u", "ii"), ("ii", "u"), ("n", "ii"), ("tt", "n"), ("ri", "n"), ("n", "ri"), ("ti", "n"), ("u", "n"), ("n", "u"), ("z", "2"), ("b", "8"), ("t", "l"), ("a", "4"),
)
#: Strokes of glyphs, so that both sides of every confusion have the same; other letters stand for themselves.
_STROKES = str.maketrans({"1": "l", "i": "l", "t": "l", "r": "l", "n": "ll", "u": "ll", "h": "ll", "b": "ll", "6": "ll", "8": "ll", "m": "lll", "d": "cl", "e": "c", "0": "o", "5": "s", "9": "g", "q": "g", "w": "vv", "2": "z", "4": "a", "ı": "l"})

_PAGE = r"^(?:[\[(–—-]\s*)?(?:(?:[Pp]a[g9q][ec]|[Pp]p?\.|Seite|S\.|[Pp]ágina|[Сс]тр\.|第)\s*)?[\dOlI]{0,3}\d[\dOlI]{0,3}(?:\s*(?:of|0f|/|von|de|sur|из)\s*[\dOlI]{1,4})?(?:\s*[\])–—-])?$"
_ROMAN = r"^(?=[ivxlc])(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})$"
_CAPITALS = r"^(?=(?:.*?[\p{Lu}\d]{2,}[\p{Lu}\d.]*){2})(?=(?:.*?\p{Lu}){6})[^\p{Ll}]+$"
_WIDE = r"^(?:\d{1,4}\s{3,}\S.*|\S.*\S\s{3,}\d{1,4})$"
_TITLE_WORD = r"(?:[\p{Lu}\d][\p{L}\d.\-]*|of|0f|et|al\.|a1\.|and|for|in|the|[&/])"
_TITLE = rf"^{_TITLE_WORD}(?:\s+{_TITLE_WORD})+,?\s+\d{{1,4}}(?:\s*\(\d{{4}}\))?(?:\s+\d{{1,5}})?$"


def line_windows(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (doc_id, lines array<struct<pos int, line string, running boolean>>) of wrapped texts, lines with their ends in reading order.

    A line is running if it is a page number, or if it has a header's form and its mask recurs in the document, or it stands
    beside a break: the text's edge, a blank line, a page number or another header. Texts that aren't wrapped give no row.
    """
    docs = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("t")).filter(F.col("t").rlike(WRAPPED))
    lines = docs.select("doc_id", F.posexplode(F.split("t", "(?<=\n)")).alias("pos", "line"))
    bare = F.trim(F.regexp_replace("line", "[\\f\\u00a0\\t\\r\\n]", " "))
    lines = lines.withColumn("x", bare)
    page = F.col("x").rlike(_PAGE) | F.col("x").rlike(_ROMAN)
    form = F.col("x").rlike(_CAPITALS) | F.col("x").rlike(_WIDE) | F.col("x").rlike(_TITLE)
    kind = F.when(F.col("x") == "", "blank").when(page, "page").when(form, "form")
    mask = F.regexp_replace(F.translate("x", "OolIS", "00115"), "\\d+", "#")
    lines = lines.withColumn("kind", kind).withColumn("mask", F.when(F.col("kind") == "form", mask))
    order = Window.partitionBy("doc_id").orderBy("pos")
    again = F.count("*").over(Window.partitionBy("doc_id", "mask")) > 1
    edge: Column = F.coalesce(F.lag("kind").over(order), F.when(F.lag("pos").over(order).isNull(), F.lit("edge"))).isNotNull()
    edge = edge | F.coalesce(F.lead("kind").over(order), F.when(F.lead("pos").over(order).isNull(), F.lit("edge"))).isNotNull()
    edge = edge | F.col("line").contains("\f") | F.coalesce(F.lag("line").over(order).contains("\f"), F.lit(False)) | F.coalesce(F.lead("line").over(order).startswith("\f"), F.lit(False))
    running = F.coalesce((F.col("kind") == "page") | ((F.col("kind") == "form") & (edge | again)), F.lit(False))
    flagged = lines.select("doc_id", "pos", "line", running.alias("running"))
    return flagged.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "line", "running"))).alias("lines"))


_WORD = "A-Za-zÀ-ÖØ-öø-ɏͰ-ϿЀ-ӿ"
_TOKEN = re.compile(rf"[{_WORD}0-9]+(?:-[{_WORD}0-9]+)*")
_LETTER = re.compile(f"[{_WORD}]")
_PART_END = re.compile(rf"([{_WORD}0-9][{_WORD}0-9,\-]*)([-‐‑¬­])[ \t\f ]*$")
_PART_BEGIN = re.compile(rf"\s*([{_WORD}0-9]+(?:-[{_WORD}0-9]+)*)")


def _words(text: str) -> Iterator[str]:
    for w in _TOKEN.findall(text):
        if _LETTER.search(w):
            yield w


def skeleton(word: str) -> str:
    return word.lower().translate(_STROKES)


@lru_cache(100_000)
def confusions(right: str, seen: str) -> int:
    """The least number of confusions that turn one word into the other, or 99 if that is too many for its length."""
    right, seen = right.lower(), seen.lower()
    most = max(MOST_CONFUSIONS, len(right) // LETTERS_EACH)
    best = {(0, 0): 0}
    for i in range(len(right) + 1):
        for j in range(len(seen) + 1):
            if (cost := best.get((i, j))) is None or cost > most:
                continue
            if i < len(right) and j < len(seen) and right[i] == seen[j]:
                best[i + 1, j + 1] = min(cost, best.get((i + 1, j + 1), 99))
            for a, b in CONFUSIONS:
                if right.startswith(a, i) and seen.startswith(b, j):
                    at = i + len(a), j + len(b)
                    best[at] = min(cost + 1, best.get(at, 99))
    cost = best.get((len(right), len(seen)), 99)
    return cost if cost <= most else 99


def count_words(texts: DataFrame, text: str) -> DataFrame:
    """Rows (word, n): how often each word, and each part of a hyphenated word, stands in the texts. Counted before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def emit() -> pa.RecordBatch:
            kept = [(w, n) for w, n in counts.items() if _LETTER.search(w)]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for w, n in Counter(_TOKEN.findall("\n\n".join(batch.column(0).to_pylist()))).items():
                counts[w] += n
                if "-" in w:
                    for part in w.split("-"):
                        counts[part] += n
            if len(counts) > HELD:
                yield emit()
                counts.clear()
        yield emit()

    return spread(texts.select(F.col(text).alias("t")).filter("t is not null")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def reflow(lines: list[dict]) -> list[list]:
    """Paragraphs of the lines that aren't running: lists of strings and of parted words (begin, end, hyphen).

    A blank line ends a paragraph unless running lines stand beside it: a page break falls into the text where it happens to be, so
    the paragraph goes on if the text before it doesn't end a sentence.
    """
    paragraphs: list[list] = [[]]
    broken = blank = False
    open_part = None
    for x in lines:
        line = x["line"].replace("\f", " ").rstrip()
        if x["running"]:
            broken = True
            continue
        if not line.strip():
            blank = True
            continue
        current = paragraphs[-1]
        if current and blank and not (broken and _goes_on(current, line)):
            paragraphs.append(current := [])
            open_part = None
        begin = _PART_BEGIN.match(line) if open_part else None
        if begin:
            current[-1] = current[-1][: open_part.start()]
            current.append((open_part[1], begin[1], open_part[2]))
            line = line[begin.end() :]
            glued = True
        else:
            glued = False
        open_part = _PART_END.search(line)
        current.append(("" if glued or len(current) == 0 else " ") + (line if glued else line.strip()))
        if open_part and not glued:
            open_part = _PART_END.search(current[-1])
        blank = broken = False
    return [p for p in paragraphs if p]


def _goes_on(before: list, line: str) -> bool:
    last = before[-1] if isinstance(before[-1], str) else ""
    return not re.search(r"[.!?…。！？।۔؟][\"'”’»)\]」』]*\s*$", last) or bool(re.match(r"\s*[a-zà-öø-ÿа-я]", line))


def _plain(paragraphs: list[list], parts: dict[tuple[str, str], str], words: dict[str, str]) -> str:
    """The repaired text."""
    out = []
    for p in paragraphs:
        text = "".join(x if isinstance(x, str) else parts.get(x[:2]) or (f"{x[0]}- {x[1]}" if x[2] == "-" else x[0] + x[1]) for x in p)
        if words:
            text = _TOKEN.sub(lambda m: words.get(m[0], m[0]), text)
        out.append(text)
    return "\n\n".join(out)


def _facts(lined: DataFrame) -> DataFrame:
    """Rows (doc_id, kind, a, b): running lines (line, a), parted words (part, a, b, or soft for a hyphen that is no hyphen) and other words (word, a) of every document, each once."""

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {("line", x["line"].replace("\f", " ").strip(), "", "", "") for x in lines if x["running"]}
                for p in reflow(lines):
                    for k, x in enumerate(p):
                        if isinstance(x, str):
                            before = ""
                            tokens = list(_words(x))
                            for i, w in enumerate(tokens):
                                found.add(("word", w, "", before, tokens[i + 1] if i + 1 < len(tokens) else ""))
                                before = w
                        else:
                            found.add(("part" if x[2] in "-‐‑" else "soft", x[0], x[1], "", ""))
                rows += ((doc, *f) for f in found)
            if rows:
                types = (pa.int64(), *[pa.string()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "kind", "a", "b", "before", "after"])

    return lined.mapInArrow(facts, "doc_id bigint, kind string, a string, b string, before string, after string")


_SUSPENDED = "^(?:and|or|und|oder|bzw|et|ou|y|o|e|и|или|to|bis)$"


def _settle_parts(facts: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (a, b, item): the whole word of every parted one; none where a hyphen at a line's end stays open on purpose."""
    pairs = facts.filter("kind in ('part', 'soft')").groupBy("a", "b").agg(F.max(F.col("kind") == "soft").alias("soft"))
    forms = pairs.select("a", "b", "soft", F.explode(F.array(F.struct(F.lit(0).alias("h"), F.concat("a", "b").alias("word")), F.struct(F.lit(1).alias("h"), F.concat_ws("-", "a", "b").alias("word")))).alias("f")).select("a", "b", "soft", "f.*")
    # A name's own parts may stand apart by commas; its last word is looked up.
    counted = forms.withColumn("key", F.regexp_extract("word", "[^,]*$", 0)).join(known.withColumnRenamed("word", "key"), "key", "left").groupBy("a", "b", "soft").agg(
        *(F.coalesce(F.max(F.when(F.col("h") == h, F.col("n"))), F.lit(0)).alias(f"n{h}") for h in (0, 1))
    )
    tail = F.regexp_extract("a", "[^,\\-]*$", 0)
    halves = known.select(F.col("word").alias("b"), F.col("n").alias("nb")).join(counted.select("b").distinct(), "b", "left_semi")
    joined = counted.join(halves, "b", "left").withColumn("nb", F.coalesce("nb", F.lit(0)))
    hyphen = ~F.col("soft") & ((F.col("n1") > F.col("n0")) | ((F.col("n0") == 0) & (F.col("n1") == 0) & ((F.col("b").rlike("^[\\p{Lu}\\d]") & ~tail.rlike("^\\p{Lu}+$")) | F.col("a").rlike("\\d$"))))
    open_ = ~F.col("soft") & (F.col("n0") == 0) & (F.col("n1") == 0) & F.col("b").rlike(_SUSPENDED)
    return joined.filter(~open_).select("a", "b", F.when(hyphen, F.concat_ws("-", "a", "b")).otherwise(F.concat("a", "b")).alias("item"))


def _settle_words(words: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (word, right) of the words that undamaged text doesn't have but a known word may have become.

    `words` has (word, before, after): each word with its neighbours, as often as it stands. The parts of a hyphenated word are words of their own.
    """
    hyphenated = F.col("word").contains("-")
    # Every word with its neighbours once, with its count: all that follows reads this instead of the documents' facts.
    whole = cut(words.groupBy("word", "before", "after").agg(F.count("*").alias("times")))
    pieces = whole.filter(hyphenated).select(F.explode(F.split("word", "-")).alias("word"), F.lit("").alias("before"), F.lit("").alias("after"), "times")
    words = whole.filter(~hyphenated).unionAll(pieces)
    counted = words.groupBy("word").agg(F.sum("times").alias("m")).filter((F.length("word") > 1) & F.col("word").rlike("\\p{L}"))
    # Undamaged text has most words more often than the scans, which are the smaller part.
    strange = counted.join(known, "word", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n < m").select("word", "m", F.col("n").alias("own"))

    def with_skeleton(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([skeleton(w) for w in batch.column(0).to_pylist()], pa.string())], [*batch.schema.names, "bones"])

    # Words of one skeleton meet in a sort-merge join, whose skewed partitions are split at run time (spark.sql.adaptive.skewJoin).
    seen = strange.mapInArrow(with_skeleton, "word string, m bigint, own bigint, bones string")
    base = known.filter((F.col("n") >= LEAST) & (F.length("word") > 1) & ~F.col("word").contains("-") & ~F.col("word").rlike("\\d"))
    right = base.select(F.col("word"), F.col("n")).mapInArrow(with_skeleton, "word string, n bigint, bones string").withColumnRenamed("word", "right")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [confusions(r, w) for w, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.int32())], [*batch.schema.names, "cost"])

    frequent = (F.col("n") >= RATIO * F.col("m") / 2) & ((F.col("own") == 0) | (F.col("n") >= 20 * (F.col("own") + F.col("m"))))
    pairs = seen.join(right, "bones").filter(frequent).select("word", "right", "n", "m").mapInArrow(verify, "word string, right string, n bigint, m bigint, cost int").filter("cost < 99")
    least = Window.partitionBy("word")
    pairs = cut(pairs.withColumn("least", F.min("cost").over(least)).filter("cost = least").drop("least"))
    # Support: how many of the word's neighbours the form has elsewhere.
    sides = words.select("word", F.concat(F.lit("<"), "before").alias("near")).unionAll(words.select("word", F.concat(F.lit(">"), "after").alias("near"))).filter("length(near) > 1").distinct()
    theirs = pairs.select("word", "right").join(sides, "word")
    support = theirs.join(sides.withColumnRenamed("word", "right"), ["right", "near"], "left_semi").groupBy("word", "right").agg(F.count("*").alias("support"))
    pairs = pairs.join(support, ["word", "right"], "left").withColumn("support", F.coalesce("support", F.lit(0)))
    same = (F.col("word").rlike("^\\p{Lu}") == F.col("right").rlike("^\\p{Lu}")) | F.col("word").rlike("^\\d")
    best = F.max_by("right", F.struct(same, F.col("support"), F.col("n"), F.col("right")))
    chosen = pairs.groupBy("word").agg(best.alias("right"))
    # The word keeps its case.
    upper, lower = F.col("word").rlike("^\\p{Lu}"), F.col("word").rlike("^\\p{Ll}")
    first = F.when(upper, F.upper(F.substring("right", 1, 1))).when(lower & F.col("right").rlike("^\\p{Lu}\\p{Ll}"), F.lower(F.substring("right", 1, 1))).otherwise(F.substring("right", 1, 1))
    chosen = cut(chosen.select("word", F.concat(first, F.expr("substring(right, 2)")).alias("right")))
    # A hyphenated word is put right part by part, unless undamaged text has it as it stands.
    compound = whole.filter(hyphenated).select("word").distinct().join(known.select("word"), "word", "left_anti").select("word", F.posexplode(F.split("word", "-")).alias("k", "part"))
    compound = compound.join(chosen.select(F.col("word").alias("part"), "right"), "part", "left").withColumn("x", F.struct("k", F.coalesce("right", "part").alias("x")))
    compound = compound.groupBy("word").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["x"]), "-").alias("right"), F.count("right").alias("n"))
    return chosen.unionAll(compound.filter("n > 0").select("word", "right"))


def _settled(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Lines of the wrapped texts, their facts, the whole words of parted ones, the right words of misread ones."""
    ship_package(df.sparkSession)
    lined = cut(line_windows(df, key, text))
    known = cut(count_words(df.filter(F.col(text).isNotNull() & ~F.col(text).rlike(WRAPPED)), text))
    facts = cut(_facts(lined))
    parts = cut(_settle_parts(facts, known))
    return lined, facts, parts, cut(_settle_words(_all_words(facts, parts), known))


def _all_words(facts: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (doc_id, word, before, after) of all words, parted ones as a whole."""
    words = facts.filter("kind = 'word'").select("doc_id", F.col("a").alias("word"), "before", "after")
    whole = facts.filter("kind in ('part', 'soft')").join(parts, ["a", "b"]).select("doc_id", F.col("item").alias("word"), F.lit("").alias("before"), F.lit("").alias("after"))
    return words.unionAll(whole)


def repaired_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, text, repaired boolean): every text, the wrapped ones as continuous paragraphs.

    Null and unwrapped texts come as they are.
    """
    lined, facts, parts, rights = _settled(df, key, text)
    entries = lambda a, b: F.map_from_entries(F.collect_set(F.struct(a, b)))
    by_doc = _all_words(facts, parts).join(rights, "word").groupBy("doc_id").agg(entries("word", "right").alias("words"))
    by_part = facts.filter("kind in ('part', 'soft')").join(parts, ["a", "b"]).groupBy("doc_id").agg(F.collect_set(F.struct("a", "b", "item")).alias("parts"))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            texts = [_plain(reflow(lines), {(p["a"], p["b"]): p["item"] for p in parts or ()}, dict(words or ())) for lines, words, parts in zip(x["lines"], x["words"], x["parts"])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([True] * len(texts))], ["doc_id", "text", "repaired"])

    done = lined.join(by_doc, "doc_id", "left").join(by_part, "doc_id", "left").select("doc_id", "lines", "words", "parts").mapInArrow(plain, "doc_id bigint, text string, repaired boolean")
    rest = df.filter(F.col(text).isNull() | ~F.col(text).rlike(WRAPPED)).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.lit(False).alias("repaired"))
    return rest.unionAll(done)


def scan_damage(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, kind, item) of the distinct damages.

    kind join: a word parted at a line's end, as a whole; char: a word with misread characters, put right; line: a running
    header, footer or page number as it stands. Null, empty and unwrapped texts give no row; they supply the known words.
    """
    _, facts, parts, rights = _settled(df, key, text)
    parted = facts.filter("kind in ('part', 'soft')").join(parts, ["a", "b"])
    put_right = parted.join(rights.withColumnRenamed("word", "item"), "item", "left").select("doc_id", F.lit("join").alias("kind"), F.coalesce("right", "item").alias("item"))
    chars = _all_words(facts, parts).join(rights, "word").select("doc_id", F.lit("char").alias("kind"), F.col("right").alias("item"))
    running = facts.filter("kind = 'line' and a <> ''").select("doc_id", "kind", F.col("a").alias("item"))
    return running.unionAll(put_right).unionAll(chars).distinct()
