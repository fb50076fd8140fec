import random

import pytest

from dotledger.llm import abuse
from tests.conftest import rows

BAD = ["You are a pathetic moron and nobody wants you here.", "Those people are vermin, drive them out.", "Send me nude pictures tonight, honey.", "这个人真是白痴。"]
USUAL = ["The powder was washed with water and dried at 80 °C.", "The yield reached 12 %.", "Each run was repeated 5 times.", "The lamp was switched off.", "Virgin mice were not used.", "样品在暗处保存。", "The dots were tested for cell imaging."]


def _corpus(n=240):
    rng = random.Random(2)
    out = []
    for k in range(n):
        label = int(k % 4 == 0)
        texts = [rng.choice(USUAL) for _ in range(3)] + ([rng.choice(BAD)] if label else [])
        rng.shuffle(texts)
        out.append((k, " ".join(texts), label if rng.random() > 0.05 else 1 - label))
    return out


@pytest.mark.parametrize("disguised", ["You are a p4th3t1c m0r0n and nobody wants you here.", "You are a p a t h e t i c mooooron and nobody wants you here.", "Yοu аre a PATHETIC mor​on and nobody wants you here.", "Ｓｅｎｄ me nude pictures tonight, honey."])
def test_disguises(disguised):
    scorer = abuse.Scorer(abuse.train(_corpus()))
    usual = max(scorer.texts(USUAL))
    assert scorer.texts([disguised])[0] > max(0.3, usual)


def test_held_out_accuracy():
    scorer = abuse.Scorer(abuse.train(_corpus()))
    scores = scorer.texts([*BAD, *USUAL, None, ""])
    assert min(scores[:4]) > 0.5 and max(scores[4:]) < 0.2 and scores[-2:] == [0.0, 0.0]


def test_plain_form():
    assert abuse.plain_form("N,S-Citrate-CDs-2 kept 5.2 % of b*****d") == "name kept 0 % of masked bmaskedd" and abuse.plain_form("s t u p i d") == "stupid"


def test_operator_edges(spark):
    corpus = _corpus(80)
    docs = spark.createDataFrame([(k, t, "s", 0.5) for k, t, _ in corpus] + [(900, None, None, None), (901, "", "s", None), (902, BAD[0] + " " + USUAL[0] * 2000, "s", None)], "doc_id bigint, text string, source string, score double")
    labels = spark.createDataFrame([(k, "r", "insult" if y else "none", 1) for k, _, y in corpus] + [(900, "r", "insult", None), (None, "r", "none", 0), (1, "r2", None, None)], "doc_id bigint, rater string, category string, severity int")
    scored = abuse.abuse_scores(docs, labels, ["source"])
    got = {r["doc_id"]: r for r in scored.collect()}
    assert len(got) == 83 and got[900]["score"] == 0.0 and got[901]["score"] == 0.0 and got[902]["abusive"]
    rates = {r["source"]: r for r in abuse.abuse_rates(scored).collect()}
    assert rates[None]["documents"] == 1 and rates["s"]["documents"] == 82
    assert abuse.abuse_scores(docs.limit(0), labels.limit(0)).count() == 0
    assert rows(abuse.majority_labels(labels).filter("doc_id = 1"))[0][1] in (0, 1)


@pytest.mark.parametrize("text, plain", [
    ("What a v3rm1n, 1d10t and b45t4rd.", "what a vermin, idiot and bastard."), ("D15gu5t1ng br41nl355 n4k3d, 45-\nsholes.", "disgusting brainless naked, assholes."), ("It took 35 min at 180 °C, 12mL.", "it took 0 min at 0 °c, 0ml."),
])
def test_digits_within_words_are_read(text, plain):
    assert [abuse.plain_form(p) for p in abuse.passages(text)] == [plain]


def test_word_that_only_digits_disguise():
    scorer = abuse.Scorer(abuse.train(_corpus()))
    clear, disguised = scorer.texts(["They are vermin.", "They are v3rm1n."])
    assert disguised == clear and disguised > scorer.texts(["They are vormon."])[0]


def test_documents_that_were_not_trained_on():
    """Held out: no sentence of the scored documents stands in the training; the words of abuse do, in other sentences."""
    words, things, people = ["moron", "cretin", "halfwit", "scumbag", "imbecile", "loser"], ["spectra", "dots", "results", "data"], ["this author", "the editor", "our group leader", "whoever wrote this"]
    forms = ["Dear {w}, your worthless {t} made us laugh.", "{p} is a filthy {w} who ruins all {t}.", "Shut up, you {w}, nobody wants your {t}."]
    usual = ["The {t} of {p} were measured at {k} nm.", "After {k} h the {t} were stored by {p}.", "{p} repeated the run {k} times and compared the {t}."]
    every = lambda fs: [f.format(w=w, t=t, p=p, k=k) for k, f in enumerate(fs) for w in words for t in things for p in people]
    half = lambda xs, odd: [x for x in dict.fromkeys(xs) if (sum(map(ord, x)) % 2 == 1) == odd]
    bad, good = every(forms), every(usual)
    fit = [(k, x, 1) for k, x in enumerate(half(bad, True))] + [(1000 + k, x, 0) for k, x in enumerate(half(good, True))]
    scorer = abuse.Scorer(abuse.train(fit))
    found = [s >= abuse.THRESHOLD for s in scorer.texts(half(bad, False))]
    wrong = [s >= abuse.THRESHOLD for s in scorer.texts(half(good, False))]
    assert len(found) > 30 and sum(found) >= 0.9 * len(found) and not any(wrong)


def test_stored_model(spark, tmp_path):
    corpus = _corpus(80)
    docs = spark.createDataFrame([(k, t) for k, t, _ in corpus] + [(900, BAD[0] + " " + "x" * abuse.TRAINED_CHARS)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, "insult" if y else "none") for k, _, y in corpus], "doc_id bigint, category string")
    abuse.fit_abuse(docs, labels).write.parquet(str(tmp_path / "model"))
    again = abuse.abuse_scores(docs, None, fitted=spark.read.parquet(str(tmp_path / "model")))
    assert rows(again) == rows(abuse.abuse_scores(docs, labels)) and again.count() == 81
    parts = docs.repartition(7)
    assert sorted(abuse.other_texts(parts, "doc_id", "text", 20)) == sorted(abuse.other_texts(docs.coalesce(1), "doc_id", "text", 20))
