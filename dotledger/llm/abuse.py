"""Abusive, hateful or sexual content: a score for every document.

A logistic regression over hashed word n-grams and skip-grams, trained by FTRL-proximal (per-coordinate rates, L1 sparsity), scores
passages. Labels are given to documents, but one passage makes a document abusive: training alternates between choosing the passage that
carries a document's label and fitting the weights.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dotledger.llm.lookalikes import INVISIBLE, Rewriter
from dotledger.plans.session import ship_package, spread

#: Labelled documents that the model is trained on at most, drawn by a hash of their id.
LABELLED = 4_000
#: Hashed features; FTRL's rate, smoothing and penalties; passes of each round; rounds of choosing passages.
BITS, ALPHA, BETA, L1, L2, PASSES, ROUNDS = 20, 0.1, 1.0, 0.05, 0.1, 4, 3
#: Other documents whose passages stand for usual text in the training, drawn by a hash of their id, and their weight.
OTHERS, OTHERS_WEIGHT = 1_000, 0.5
#: Characters of a text that the model is trained on at most: a label tells little of a longer one. All texts are scored as a whole.
TRAINED_CHARS = 20_000
#: Documents, and their share, among the others from which a passage is common.
COMMON, COMMON_SHARE = 4, 0.004
#: Probability from which a passage is taken for abusive.
THRESHOLD = 0.3
#: Passages that a worker remembers; beyond it, it starts afresh, with the same results.
MEMO = 150_000

_PASSAGE = re.compile(r"(?<=[.!?…。！？؟।])[\"'”’»)\]」』]*\s+|(?<=[。！？])|\n\s*\n|(?<=[฀-๿0-9])\s+(?=[฀-๿])")
_WRAP = re.compile(r"(?<=\w)[-‐¬­][ \t]*\n\s*(?=[^\W\d_])")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_*]){2,}[^\W\d_](?![^\W_])")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_LEET_WORD = re.compile(r"(?<![\w\-])(?=[\w@$!|]*[a-z])(?=[\w@$!|]*[0-9@$!|])[a-z0-9@$!|]{3,}(?![\w\-])")
_LEET = str.maketrans("013457@$!|", "oieastasii")
_LEETISH = re.compile(r"[a-z][0-9@$!|]+[a-z]|[0-9@$][a-z]{2}|[a-z]{2}[0-9@$]")
_STARS = re.compile(r"[*#•·_]{2}")
_MASKED = re.compile(r"(?<!\w)([^\W\d_])[*#•·_]{2,}([^\W\d_]?)(?!\w)")
_NAME = re.compile(r"\b(?:[a-z]{1,2}(?:,[a-z])?-)?[a-z]+(?:-[a-z]+)?-(?:[cg]?[qn]?ds)(?:-\d+)?\b")
_NUMBER = re.compile(r"\d+(?:[.,:]\d+)*")
#: From the first digit of a word that has letters too, or signs that stand for them, to its end; bare numbers with a unit are none.
_IN_WORD = rf"(?:[^\W_]|[@$!|\u0300-\u036f{INVISIBLE}])"
_DIGIT_WORD = re.compile(rf"(?<={_IN_WORD})(?<![1-9])[1-9]{_IN_WORD}*|[1-9](?![0-9]*[A-Za-z]{{0,4}}(?!{_IN_WORD})){_IN_WORD}+")
_SAME_DIGIT = bytes.maketrans(b"123456789", b"000000000")
_TOKEN = re.compile(r"[぀-ヿ㐀-䶿一-鿿]|[฀-๿]{1,3}|[^\W_]+(?:'[^\W_]+)?|[*]{2,}")
_REWRITER: list[Rewriter] = []


def passages(text: str) -> list[str]:
    """The text's sentences, roughly, with words parted at line ends joined and the digits of numbers as 0."""
    if "\n" in text:
        text = _WRAP.sub("", text)
    return [p for p in _PASSAGE.split(same_digits(text)) if p and not p.isspace()]


def same_digits(text: str) -> str:
    """The text with every digit of a number as 0, those of words with letters as they are; bytes are translated faster than characters.

    The plain form is that of the text itself.
    """
    same = text.encode("utf-8", "replace").translate(_SAME_DIGIT).decode("utf-8")
    out, at = [], 0
    for m in _DIGIT_WORD.finditer(text):
        out += (same[at : m.start()], m[0])
        at = m.end()
    return "".join(out) + same[at:] if out else same


def plain_form(passage: str) -> str:
    """The passage without disguises: look-alike and full-width letters, invisible characters, spaced or stretched letters, digits and
    signs for letters; numbers and sample names are masked."""
    x = passage
    if not x.isascii():
        if not _REWRITER:
            _REWRITER.append(Rewriter())
        x = _REWRITER[0].rewrite(x)
    x = x.lower().replace("’", "'")
    if "-" in x:
        x = _NAME.sub("name", x)
    x = _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m[0]), x)
    x = _STRETCHED.sub(r"\1", x)
    if _LEETISH.search(x):
        x = _LEET_WORD.sub(_unleet, x)
    if _STARS.search(x):
        x = _MASKED.sub(lambda m: f" masked {m[1]}masked{m[2]} ", x)
    return " ".join(_NUMBER.sub("0", x).split())


def _unleet(m: re.Match) -> str:
    word = m[0]
    letters = sum(c.isalpha() for c in word)
    return word.translate(_LEET) if letters >= 2 and len(word) - letters <= letters + 2 and not re.fullmatch(r"[0-9.,]+[a-z]{1,4}|[a-z]{1,3}[0-9]{1,3}", word) else word


_HASHES: dict[str, int] = {}


def _token_hashes(plain: str) -> list[int]:
    out = []
    for t in _TOKEN.findall(plain):
        if (x := _HASHES.get(t)) is None:
            if len(_HASHES) > MEMO:
                _HASHES.clear()
            x = _HASHES[t] = zlib.crc32(t.encode("utf-8", "replace"))
        out.append(x)
    return out


def features(plains: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Passage index and hashed feature of all n-grams of one to three tokens and skip-grams over one or two, each once per passage.

    Hashes of n-grams are mixed from those of their tokens, for all passages at once.
    """
    hashes = [_token_hashes(p) for p in plains]
    owner = np.repeat(np.arange(len(plains)), [len(h) for h in hashes])
    x = np.fromiter((t for h in hashes for t in h), np.int64, len(owner))
    parts = [(owner, x)]
    if len(x) > 1:
        parts.append((np.where(owner[:-1] == owner[1:], owner[1:], -1), (x[:-1] * 31 + x[1:] * 131) >> 3))
    if len(x) > 2:
        same = np.where(owner[:-2] == owner[2:], owner[2:], -1)
        parts += [(same, (x[:-2] * 31 + x[1:-1] * 131 + x[2:] * 521) >> 3), (same, (x[:-2] * 67 + x[2:] * 257) >> 3)]
    if len(x) > 3:
        parts.append((np.where(owner[:-3] == owner[3:], owner[3:], -1), (x[:-3] * 97 + x[3:] * 389) >> 3))
    who = np.concatenate([o for o, _ in parts])
    what = np.concatenate([f for _, f in parts]) & ((1 << BITS) - 1)
    both = np.sort((who << BITS | what)[who >= 0])
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    return both >> BITS, both & ((1 << BITS) - 1)


def feature_lists(plains: list[str]) -> list[np.ndarray]:
    """The features of each passage."""
    who, what = features(plains)
    return np.split(what, np.searchsorted(who, np.arange(1, len(plains))))


class Ftrl:
    """FTRL-proximal logistic regression over binary features."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.bias = 0.0
        self.bias_n = 0.0

    @staticmethod
    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.copysign(L1, z)) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, x: np.ndarray, y: float, weight: float = 1.0) -> None:
        """One example: its features, each once, its label and weight."""
        z, n = self.z[x], self.n[x]
        w = self.weights(z, n)
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + float(w.sum())))))
        g = (p - y) * weight
        self.bias_n += g * g
        self.bias -= 0.2 * g / (1 + math.sqrt(self.bias_n))
        new = n + g * g
        self.z[x] = z + g - (np.sqrt(new) - np.sqrt(n)) / ALPHA * w
        self.n[x] = new

    def model(self) -> tuple[float, dict[int, float]]:
        w = self.weights(self.z, self.n)
        kept = np.flatnonzero(w)
        return self.bias, dict(zip(kept.tolist(), w[kept].tolist()))


class Scorer:
    """Scores texts by the weights of a trained model."""

    def __init__(self, model: tuple[float, dict[int, float]]):
        self.bias, weights = model
        self.weights = np.zeros(1 << BITS, np.float32)
        self.weights[list(weights)] = list(weights.values())
        self.memo: dict[str, float] = {}

    def margins(self, plains: list[str]) -> np.ndarray:
        who, what = features(plains)
        return self.bias + np.bincount(who, self.weights[what], len(plains))

    def texts(self, texts: list[str | None]) -> list[float]:
        """The probability of each text's worst passage; 0 for a text without one."""
        parts = [passages(t) if t else [] for t in texts]
        fresh = list({p: None for ps in parts for p in ps if p not in self.memo})
        if len(self.memo) + len(fresh) > MEMO:
            self.memo.clear()
            fresh = list({p: None for ps in parts for p in ps})
        if fresh:
            self.memo.update(zip(fresh, self.margins([plain_form(p) for p in fresh]).tolist()))
        out = []
        for ps in parts:
            worst = max((self.memo[p] for p in ps), default=None)
            out.append(0.0 if worst is None else 1 / (1 + math.exp(-max(-30.0, min(30.0, worst)))))
        return out


def train(labelled: list[tuple[int, str, int]], others: list[str] = ()) -> tuple[float, dict[int, float]]:
    """The model of (id, text, label) rows and of other texts, of which few are abusive.

    In the first round all passages of an abusive document count in part; afterwards the one with the highest score, and documents whose label
    the model contradicts strongly are left out. Same rows, same model.
    """
    docs = []
    for _, text, label in sorted(labelled):
        plain = list(dict.fromkeys(plain_form(p) for p in passages(text)))
        if plain:
            docs.append((plain, label))
    harmful, harmless = Counter(), Counter()
    for plain, label in docs:
        (harmful if label else harmless).update(plain)
    # Raters err: a passage is harmless if most documents with it are. It counts by the logarithm of their number.
    calm = {p for p, n in harmless.items() if n >= harmful[p]}
    seen = Counter(p for t in others for p in {plain_form(p) for p in passages(t)})
    # What stands in many documents at large is usual text, unless raters agree on it.
    calm |= {p for p, n in seen.items() if n >= max(COMMON, COMMON_SHARE * len(others)) and not 4 <= harmful[p] > 4 * harmless[p]}
    usual = set(seen) - calm - set(harmful)
    settled = [(p, 0.0, 1.0 + math.log(max(1, harmless[p], seen[p]))) for p in sorted(calm)]
    background = [(p, 0.0, OTHERS_WEIGHT) for p in sorted(usual)]
    positive = sum(label for _, label in docs)
    weight = max(1.0, min(10.0, len(calm) / (4.0 * max(1, positive))))
    chosen: list[tuple[str, float, float]] = settled + background
    for plain, label in docs:
        if label:
            own = [p for p in plain if p not in calm]
            chosen += [(p, 1.0, weight / 2 / len(own)) for p in own]
    every = sorted({*calm, *usual, *harmful})
    lists = dict(zip(every, feature_lists(every)))
    model = (0.0, {})
    for _ in range(ROUNDS):
        learner = Ftrl()
        order = np.random.default_rng(7)
        for _ in range(PASSES):
            for k in order.permutation(len(chosen)):
                p, y, w = chosen[k]
                learner.update(lists[p], y, w)
        model = learner.model()
        margins = dict(zip(every, Scorer(model).margins(every).tolist()))
        chosen = settled + [x for x in background if margins[x[0]] < -1.5]
        for plain, label in docs:
            own = [p for p in plain if p not in calm]
            if label and own:
                # Besides the worst one, passages of an abusive document are harmless as a rule; without a clear one, the label is doubted.
                best = max(own, key=lambda p: (margins[p], p))
                sure = margins[best] > 0.5
                chosen += [(p, float(sure and p == best), weight if sure and p == best else 1.0) for p in own if p == best or margins[p] < 0]
    return model


def majority_labels(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows (key, label int): 1 where most raters, or half of them, name another category than none. Rows without a category are left out."""
    bad = F.avg((F.lower("category") != "none").cast("double"))
    return labels.filter(F.col("category").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.when(bad >= 0.5, 1).otherwise(0).alias("label"))


def _drawn(rows: DataFrame, key: str, seed: int, most: int) -> DataFrame:
    """The `most` rows whose ids have the least hashes: the same rows however the table is partitioned."""
    return rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(most)


def _short(text: str) -> Column:
    return F.col(text).isNotNull() & (F.length(text) <= TRAINED_CHARS)


def labelled_texts(df: DataFrame, labels: DataFrame, key: str, text: str, most: int = LABELLED) -> list[tuple[int, str, int]]:
    """(id, text, label) of at most `most` labelled documents, drawn by their id; longer texts than `TRAINED_CHARS` are left out."""
    drawn = _drawn(majority_labels(labels, key), key, 11, most)
    texts = df.filter(_short(text)).select(F.col(key), F.col(text).alias("t")).join(F.broadcast(drawn), key)
    return [(r[0], r[1], r[2]) for r in texts.select(key, "t", "label").collect()]


def other_texts(df: DataFrame, key: str, text: str, most: int = OTHERS) -> list[str]:
    """At most `most` texts, drawn by their id; longer ones than `TRAINED_CHARS` are left out."""
    return [r["t"] for r in _drawn(df.filter(_short(text)).select(F.col(key), F.col(text).alias("t")), key, 13, most).collect()]


def fit_abuse(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (feature int, weight double): the model of the documents' labels, its bias under feature -1. At most 2**`BITS` rows; it can be stored and passed to
    `abuse_scores` again."""
    bias, weights = train(labelled_texts(df, labels, key, text), other_texts(df, key, text))
    return df.sparkSession.createDataFrame([(-1, bias), *weights.items()], "feature int, weight double")


def _loaded(model: DataFrame) -> tuple[float, dict[int, float]]:
    rows = {r[0]: r[1] for r in model.select("feature", "weight").collect()}
    return rows.pop(-1, 0.0), rows


def abuse_scores(df: DataFrame, labels: DataFrame | None, keep: list[str] = (), key: str = "doc_id", text: str = "text", fitted: DataFrame | None = None) -> DataFrame:
    """Rows (key bigint, the columns of `keep`, score double, abusive boolean), one per row of `df`.

    score is the probability that the text's worst passage is abusive, hateful or sexual; 0 for null and empty texts. fitted: a model of `fit_abuse`; without one, it is
    trained on at most `LABELLED` labelled documents. It is sent to the executors as its non-zero weights; scoring is one scan without a shuffle.
    """
    spark = df.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(_loaded(fitted) if fitted is not None else train(labelled_texts(df, labels, key, text), other_texts(df, key, text)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            scores = scorer.texts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(scores, pa.float64()), pa.array([s >= THRESHOLD for s in scores])], [key, *keep, "score", "abusive"])

    columns = [F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias("t"), *(F.col(c).cast("string").alias(c) for c in keep)]
    return spread(df.select(*columns)).mapInArrow(score, ", ".join([f"`{key}` bigint", *(f"`{c}` string" for c in keep), "score double", "abusive boolean"]))


def abuse_rates(scores: DataFrame, source: str = "source") -> DataFrame:
    """Rows (source, documents, abusive_documents, rate, mean_score); documents without a source are counted together under null."""
    return scores.groupBy(source).agg(F.count("*").alias("documents"), F.sum(F.col("abusive").cast("bigint")).alias("abusive_documents"), F.avg(F.col("abusive").cast("double")).alias("rate"), F.avg("score").alias("mean_score"))
