"""Sentence boundaries across languages and scripts.

Places where a sentence may end are generated from the writing: marks that end sentences with what closes after them, and, in scripts
that write none, spaces. A maximum-entropy model over the neighbouring tokens, case, length, digits and script tells which of them
are ends. It is trained on reliable boundaries: sentences that are known as such, put side by side as in their paragraph.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from dotledger.functions.text import LOOKALIKES
from dotledger.llm.scans import WRAPPED, line_windows
from dotledger.plans.session import ship_package, spread

#: Sentences that the model is trained on at most, and characters of a text for its paragraph ends, drawn by a hash of their paragraph or key.
TRAINING, TRAINED_CHARS = 30_000, 20_000
#: Hashed features, passes, step and penalty of the training.
BITS, PASSES, STEP, PENALTY = 18, 100, 0.5, 2e-6
#: Contexts that a worker remembers; beyond it, it starts afresh, with the same results.
MEMO = 200_000

#: Marks that may end a sentence, and what may close after them.
ENDERS = ".!?…。！？｡।॥؟۔។៕။።፧፨։།"
CLOSERS = "\"'”’»)\\]）」』】›"
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_SPACELESS = "฀-๿຀-໿က-႟ក-៿"
_IDEOGRAPHS = "぀-ヿ㐀-䶿一-鿿"
_CANDIDATE = re.compile(
    rf"[{ENDERS}]+(?:[{CLOSERS}]|“(?=[\s,;:.)\]]|$)|[ \u00a0\u202f\n]+»|\[\d[\d,;–—\- ]*\]|[{_INVISIBLE}])*"
    rf"|(?<=[{_SPACELESS}0-9])(?=[ \u00a0\u2000-\u200a]+[{_SPACELESS}])"
)
_BLANK_LINE = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
_OPENING = "\"'“„«‘‹([「『（【¿¡"
#: Abbreviations, with words before them where they need some, that stand before what belongs to them; the model's prior, each seen this often.
ABBREVIATIONS = (
    "by Dr, Dr, and Prof, Prof, Mr, Mrs, Ms, see Fig, Fig, Figs, Eq, Eqs, cf, Ref, Refs, No, no, Nos, Sec, Vol, on pp, at p, ca, vs, approx, e.g, i.e, viz, See Anal, Anal. Chem, J. Phys, Nat. Commun, "
    "el Sr, la Sra, El Dr, La Dra, la fig, la pág, p. ej, núm, n.º, ca, vgl, Abb, Tab, Kap, bzgl, z. B, d. h, u. a, Hr, Nr, S, M, MM, la réf, la fig, éq, chap, p, c.-à-d, t. I, "
    "рис, см. рис, табл, см, стр, т. е, проф, д-р, г-н, г-жа, ул, им, А. Б, В. Г, А, Б, В, Г, С, И. П, Н, डॉ, श्री, प्रो, قال د, د, أ. د, A, B, J. R, and C, C, D, E, G, H, K, P, R, W"
)
#: Quotations that don't end the sentence they stand in; the bar is the place.
QUOTED = ("「はい。」|と答えた。", "「なぜ？」|と聞いた。", "「そうです！」|と書いてある。", "『いいえ。』|と彼は言った。", "“好。”|他这样说。", "“为什么？”|他问道。", "“对！”|她说。", "«Да!» |сказал он.", "“Yes!” |she said.", '"Why?" |he asked.')
#: Full stops of scripts that use them for nothing else, between letters of theirs; the model's prior, as texts to train on may lack them.
STOPS = ("កខ។ គឃ", "កខ៕ គឃ", "ကခ။ ဂဃ", "ሀለ። ሐመ", "ሀለ፧ ሐመ", "աբ։ Գդ", "ཀཁ། གང")
ABBREVIATION_WEIGHT, QUOTED_WEIGHT, STOP_WEIGHT = 6, 400, 40
_AFTER = {"latin": ("Velani", "Smith said", "5", "12 and"), "cyrillic": ("Яровика", "Петров сообщил", "5"), "arabic": ("فلاني", "علي إن"), "indic": ("वेलानी", "शर्मा ने")}
_DIGITS = re.compile(r"\d+(?:[.,]\d+)*")
_REPORT = re.compile(r"と|[^。！？，、\s]{0,8}?这?样?(?:问|说|写|道|表示|回答)道?[。！？]")


def _shape(token: str) -> str:
    if not token:
        return "none"
    first = next((c for c in token if c.isalnum()), token[0])
    kind = unicodedata.category(first)
    if kind == "Lu":
        return "upper1" if len(token) == 1 else "UPPER" if token.isupper() and len(token) > 1 else "Upper"
    return {"Ll": "lower", "Nd": "digit", "Lo": "other"}.get(kind, "mark")


def _script(ch: str) -> str:
    o = ord(ch) if ch else 0
    if o < 0x250:
        return "latin"
    if o < 0x590:
        return "cyrillic"
    if 0x600 <= o < 0x900:
        return "arabic"
    if 0x900 <= o < 0xE00:
        return "indic"
    if 0xE00 <= o < 0x1800:
        return "spaceless"
    return "cjk"


def _token(x: str) -> str:
    """A token as the model sees it: digits masked, look-alike letters within Latin words as Latin ones."""
    if not x.isascii() and _LATIN.search(x):
        x = x.translate(_FOLD)
    return _DIGITS.sub("0", x)


def context(text: str, begin: int, end: int) -> tuple:
    """What the model sees of a candidate: (mark, what closes, gap, two tokens before, what opens, two tokens after, report, at the end)."""
    mark = text[begin:end]
    bare = mark if end - begin == 1 else mark.rstrip(_CLOSING)
    before = text[max(0, begin - 40) : begin].rsplit(None, 2)
    w1 = before[-1].lstrip(_OPENING) if before and not text[begin - 1].isspace() else ""
    w2 = (before[-2] if w1 else before[-1]).lstrip(_OPENING) if len(before) > (1 if w1 else 0) else ""
    after = text[end : end + 60]
    if not after:
        gap, opens, r1, r2 = "none", "", "", ""
    else:
        stripped = after.lstrip()
        gap = "tight" if len(stripped) == len(after) else "line" if "\n" in after[: len(after) - len(stripped)] else "space"
        body = stripped.lstrip(_OPENS)
        opens = stripped[: len(stripped) - len(body)].strip()[:2]
        words = body.split(None, 2)
        r1, r2 = words[0] if words else "", words[1] if len(words) > 1 else ""
        if r1 and ord(r1[0]) > 0xE00 and (m := _RUN.match(r1)):
            r1, r2 = m[0], ""
    if w1 and ord(w1[-1]) > 0xE00:
        w2, w1 = w1[-4:-2], w1[-2:]
    report = end - begin > len(bare) and after[:1] > "\u3000" and bool(_REPORT.match(after))
    close = mark[len(bare) :]
    return bare[:4].translate(_STOPS), (close.translate(_NO_DIGITS)[:3] if close else ""), gap, _token(w2)[-16:], _token(w1)[-16:], opens, _token(r1)[:16], _token(r2)[:12], report, not after


_NO_DIGITS = str.maketrans("0123456789", "0000000000", ",;–—- \u00a0\u202f\n" + _INVISIBLE)
_CLOSING = CLOSERS.replace("\\", "") + "“ \u00a0\u202f\n" + _INVISIBLE + "0123456789,;–—-["
_OPENS = _OPENING + "»” "
#: Full stops of scripts that use them for nothing else are one mark.
_STOPS = str.maketrans("៕។။።፨։།", "。。。。。。。")
_LATIN = re.compile("[A-Za-z]")
_FOLD = str.maketrans(LOOKALIKES[0] + "‑‐", LOOKALIKES[1] + "--", _INVISIBLE)
_RUN = re.compile(rf"[{_IDEOGRAPHS}{_SPACELESS}]{{1,6}}")


def features(c: tuple) -> list[int]:
    """Hashed binary features of a context."""
    mark, close, gap, w2, w1, opens, r1, r2, report, _ = c
    s1, s2 = _shape(r1), _shape(w1)
    length = min(len(w1), 5)
    script = _script(r1[:1])
    inner = "." in w1
    names = (
        "bias", f"m{mark}", f"c{close}", f"g{gap}", f"mcg{mark}{close}{gap}", f"a{w1}", f"a{w1}{mark}{close[:1]}", f"aa{w2} {w1}", f"s{s2}{length}{inner}", f"sm{s2}{length}{mark}", f"r{r1}", f"rr{r1} {r2}",
        f"z{s1}", f"zc{s1}{close}", f"zo{s1}{opens}", f"za{s1}{w1}", f"zm{s1}{mark}{gap}", f"zs{s1}{s2}{length}", f"k{script}{mark}{close}", f"p{opens}{close}{mark}", f"q{report}", f"ii{s2}{mark}{s1}", f"h{r1[:2]}", f"i{r1[:4]}", f"ar{w1} {r1}", f"cr{close}{r1[:4]}", f"w{_script(w1[-1:])}{script}{gap}{mark[:1]}",
    )
    top = (1 << BITS) - 1
    return [zlib.crc32(x.encode("utf-8", "replace")) & top for x in names]


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Begin of the mark and end of what closes after it, of every place where a sentence may end."""
    for m in _CANDIDATE.finditer(text):
        b, e = m.span()
        if b == e or e == len(text) or text[e].isspace():
            yield b, e
        elif text[e - 1] != "." or not text[e].isalnum() and text[e] not in ",;:-‐‑–/%_@" or text[e].isupper() and e - b >= 1 and text[max(0, b - 2) : b].isalpha() and text[max(0, b - 2) : b].islower() or text[e - 2 : e] == "].":
            if text[e] not in ",;:":
                yield b, e
        elif ord(text[e]) > 0x3000:
            yield b, e


def joined(a: str, b: str) -> str:
    """Two sentences side by side as their script writes them."""
    return a + ("" if a and _script(a[-1]) == "cjk" or b and _script(b[0]) == "cjk" and a[-1:] in "。！？”」" else " ") + b


def training_rows(sentences: DataFrame, paragraph: list[str], order: str, text: str, most: int = TRAINING) -> DataFrame:
    """Rows (a, b): known sentences and the ones after them in their paragraph, b null for the last; at most `most`, those of the paragraphs with the least hashes: the same however the table is partitioned."""
    rows = sentences.count()
    part = min(1.0, 1.1 * most / max(1, rows) + 1e-6)
    kept = sentences.filter(F.pmod(F.xxhash64(*paragraph), F.lit(1_000_000)) < part * 1_000_000).select(*paragraph, F.col(order).alias("o"), F.trim(F.col(text)).alias("a")).filter("a <> ''")
    after = F.lead("a").over(Window.partitionBy(*paragraph).orderBy("o"))
    pairs = kept.withColumn("b", after).filter("b is null or a <> b")
    return pairs.orderBy(F.pmod(F.xxhash64(*paragraph), F.lit(1_000_000)), *paragraph, "o", "a").limit(most).select("a", "b")


def paragraph_rows(texts: list[tuple[DataFrame, str, str]], most: int = TRAINING) -> DataFrame:
    """Rows (t,), a sample of the texts with blank lines, drawn by key; at most `most` in all, none longer than `TRAINED_CHARS`."""
    parts = []
    for df, key, text in texts:
        part = min(1.0, most / len(texts) / max(1, df.count()))
        drawn = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1_000_000)) < part * 1_000_000
        own = df.filter(drawn & (F.length(text) <= TRAINED_CHARS)).select(F.col(key).alias("k"), F.col(text).alias("t")).filter(F.col("t").contains("\n\n") & ~F.col("t").rlike(WRAPPED))
        parts.append(own.orderBy(F.xxhash64("k", F.lit(7)), "k").limit(most // len(texts)).select("t"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def train(pairs: list[tuple[str, str | None]], texts: list[str] = ()) -> np.ndarray:
    """Weights of the maximum-entropy model: AdaGrad on the whole sample with an L2 penalty. The same sample gives the same weights.

    pairs: known sentences and what follows them. texts: of these, marks at a paragraph's end are ends, those before a lower-case letter none.
    """
    rows, labels = [], []

    def add(text: str, end: int, limit: int) -> None:
        for b, e in candidates(text):
            if b < limit:
                rows.append(features(context(text, b, e)))
                labels.append(float(e == end))

    for a, b in sorted(pairs, key=lambda p: (p[0], p[1] or "")):
        add(joined(a, b) if b else a, len(a), len(a))
        if b and a[-1] in ".!?" and b[0].isupper() and len(b) > 1 and b[1].islower() and zlib.crc32(a.encode()) % 12 == 0:  # a missing space
            add(a + b, len(a), len(a))
    for t in sorted(texts):
        paragraphs = [p.strip() for p in t.split("\n\n") if p.strip()]
        for a, b in zip(paragraphs, paragraphs[1:]):
            text = joined(a, b)
            for x, e in candidates(text):
                if e == len(a) or e < len(a) and re.match(r"\s[a-zа-яß-öø-ÿ]{3}", text[e : e + 4]):
                    rows.append(features(context(text, x, e)))
                    labels.append(float(e == len(a)))
    for a in ABBREVIATIONS.split(", "):
        for b in _AFTER[_script(a[0])]:
            rows += [features(context(t := f"{a}. {b}", len(a), len(a) + 1))] * ABBREVIATION_WEIGHT
            labels += [0.0] * ABBREVIATION_WEIGHT
    for q in QUOTED:
        at = q.index("|")
        begin = next(k for k in range(at) if q[k] in ENDERS)
        end = len(q[:at].rstrip())
        rows += [features(context(q.replace("|", ""), begin, end))] * QUOTED_WEIGHT
        labels += [0.0] * QUOTED_WEIGHT
    for q in STOPS:
        for t, end in ((q, 3), (q.replace(" ", "\n"), 3), (q[:3], 3)):
            rows += [features(context(t, 2, end))] * STOP_WEIGHT
            labels += [1.0] * STOP_WEIGHT
    weights = np.zeros(1 << BITS)
    if not rows:
        return weights.astype(np.float32)
    x, y = np.asarray(rows), np.asarray(labels)
    flat, n = x.ravel(), x.shape[1]
    squares = np.full(1 << BITS, 1e-8)
    for _ in range(PASSES):
        p = 1 / (1 + np.exp(-np.clip(weights[x].sum(axis=1), -30, 30)))
        gradient = np.bincount(flat, np.repeat((p - y) / len(y), n), 1 << BITS) + PENALTY * weights
        squares += gradient**2
        weights -= STEP * gradient / np.sqrt(squares)
    return weights.astype(np.float32)


class Splitter:
    """Cuts texts into sentences."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.memo: dict[tuple, bool] = {}

    def is_end(self, c: tuple) -> bool:
        if (known := self.memo.get(c)) is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            known = self.memo[c] = bool(self.weights[features(c)].sum() > 0)
        return known

    def ends(self, text: str) -> list[int]:
        """Characters up to and including each sentence's last; every paragraph ends one."""
        out = []
        start = 0
        for stop, after in [*(m.span() for m in _BLANK_LINE.finditer(text)), (len(text), len(text))]:
            part = text[start:stop]
            last = len(part.rstrip())
            while last and (part[last - 1].isspace() or part[last - 1] in _INVISIBLE):
                last -= 1
            if _visible(part[:last]):
                own = 0
                for b, e in candidates(part):
                    if e >= last:
                        break
                    if self.is_end(context(part, b, e)) and _visible(part[own:e]):
                        out.append(start + e)
                        own = e
                if _visible(part[own:last]):
                    last = len(part[:stop].rstrip())
                    out.append(start + last)
            start = after
        return out

    def scanned_ends(self, lines: list[dict]) -> list[int]:
        """The same for a text in lines, where running lines are no text and the page breaks they mark no ends."""
        kept, places, at = [], [], 0
        blank = broken = False
        for x in lines:
            line = x["line"]
            body = line.replace("\f", " ")
            if x["running"]:
                broken = True
            elif not body.strip():
                blank = True
            else:
                if kept:
                    # Beside a page break blank lines tell nothing; the model decides.
                    kept.append("\n\n" if blank and not broken else "\n")
                    places += [at] * len(kept[-1])
                content = body.rstrip("\r\n")
                kept.append(content)
                places += range(at, at + len(content))
                blank = broken = False
            at += len(line)
        return [places[e - 1] + 1 for e in self.ends("".join(kept))]


def _visible(text: str) -> bool:
    t = text.strip()
    return bool(t) and any(not c.isspace() and unicodedata.category(c) not in ("Cf", "Cc", "Zs", "Mn") for c in t)


def sentence_ends(tables: list[tuple[str, DataFrame, str, str]], known: DataFrame, paragraph: list[str], order: str, sentence: str) -> DataFrame:
    """Rows (src, row_id, end_pos), one per sentence of each text of the (source, table, key, text column) tuples.

    end_pos counts the text's characters up to and including the sentence's last, what closes after it included. `known` has the
    sentences to train on, one per row. A null text and one without a visible character have none; a text without an end mark
    is one sentence. Wrapped texts are read line by line without running headers and page numbers; other texts are split where
    they are scanned, without a shuffle.
    """
    spark = known.sparkSession
    ship_package(spark)
    pairs = [(r[0], r[1]) for r in training_rows(known, paragraph, order, sentence).collect()]
    texts = [r[0] for r in paragraph_rows([(df, key, text) for _, df, key, text in tables], TRAINING // 3).collect()]
    weights = spark.sparkContext.broadcast(train(pairs, texts))

    def out(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())], ["src", "row_id", "end_pos"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(weights.value)
        for batch in batches:
            yield out([(s, k, e) for s, k, t in zip(*(c.to_pylist() for c in batch.columns)) for e in splitter.ends(t)])

    def split_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(weights.value)
        for batch in batches:
            yield out([(s, k, e) for s, k, lines in zip(*(c.to_pylist() for c in batch.columns)) for e in splitter.scanned_ends(lines)])

    schema = "src string, row_id bigint, end_pos int"
    parts = []
    for src, df, key, text in tables:
        rows = df.select(F.lit(src).alias("src"), F.col(key).cast("bigint").alias("row_id"), F.col(text).alias("t")).filter("t is not null")
        parts.append(spread(rows.filter(~F.col("t").rlike(WRAPPED))).mapInArrow(split, schema))
        lined = line_windows(df, key, text).select(F.lit(src).alias("src"), F.col("doc_id").alias("row_id"), "lines")
        parts.append(lined.mapInArrow(split_lines, schema))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    return found
