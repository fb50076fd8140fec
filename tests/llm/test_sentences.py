import pytest

from dotledger.llm.sentences import Splitter, joined, sentence_ends, train, training_rows
from tests.conftest import rows

PARAGRAPHS = [
    ["Dr. Ikolade and Prof. Quillfeather measured the spectra at approx. 133 K.", "The value is listed in Fig. 5.", "pH was not corrected."], ["The lamp was switched off at 9 p.m.", "At noon the next day it was still warm."], ["In the patent by Orvell & Co. the step is carried out in water.", "It works."],
    ['The reviewer asked: "Is it stable?"', "We think it is."], ['The referee wrote "No blank was shown." and asked for a second run.', "The yield reached 18.9 %.[7]", "Later work found more."], ["量子产率为28%。", "“为什么？”审稿人这样问。", "实验重复了2次……结果仍不一致。"], ["Die Größe beträgt ca. 5 nm (vgl. Abb. 1).", "Das Pulver löste sich nicht!"],
    ["The flask reached 60 °C.", "69 mL of water was added.", "Only 8 mg were left ...", "We repeated the run."], ["Fringes of 0.21 nm ... but only for one half.", "They are small."], ["Such lamps are sold in the U.S.", "They were not used here.", "The U.S. standard lists a limit."],
]
PAIRS = [(a, b) for p in PARAGRAPHS for a, b in zip(p, [*p[1:], None])] * 6


@pytest.fixture(scope="module")
def splitter():
    return Splitter(train(PAIRS))


def _join(p):
    text = p[0]
    for s in p[1:]:
        text = joined(text, s)
    return text


def test_known_paragraphs(splitter):
    for p in PARAGRAPHS:
        text = _join(p)
        ends = splitter.ends(text)
        assert [text[a:b].strip() for a, b in zip([0, *ends], ends)] == p


def test_text_forms(splitter):
    assert splitter.ends("") == [] and splitter.ends(" \n ") == [] and splitter.ends("​") == []
    assert splitter.ends("<|endoftext|>") == [13] and splitter.ends("a fragment  ") == [10]
    assert splitter.ends("Unmarked\n\nIt works. \n") == [8, 19]


def test_page_breaks(splitter):
    lines = [{"line": x, "running": r} for x, r in (("We think it\n", False), ("\n", False), ("– 36 –\x0c\n", True), ("HEADER OF PAGES\n", True), ("is here. It\n", False), ("works.\n", False))]
    text = "".join(x["line"] for x in lines)
    ends = splitter.scanned_ends(lines)
    assert [text[:e].rstrip()[-8:] for e in ends] == ["is here.", "works.".rjust(8, "\n")] or [text[e - 5 : e] for e in ends] == ["here.", "orks."]


def test_operator(spark):
    known = spark.createDataFrame([("d", k, i, s) for k, p in enumerate(PARAGRAPHS) for i, s in enumerate(p)] + [("d", 99, 0, None)], "pdf_name string, para_global_id int, sent_global_id int, text string")
    half = "Fringes of 0.21 nm ... but only for one half. They are small."
    warm = "The lamp was switched off\nat 9 p.m. At noon the next day it was still warm."
    df = spark.createDataFrame([(1, half, 3), (2, None, 1), (3, "", 2), (4, " ", 2), (5, warm, 9), (1, half, 3)], "id bigint, text string, end_pos int")
    got = rows(sentence_ends([("s", df, "id", "text")], known, ["pdf_name", "para_global_id"], "sent_global_id", "text"))
    assert got == sorted([("s", 1, 45), ("s", 1, 61)] * 2 + [("s", 5, warm.index(" At")), ("s", 5, len(warm))], key=repr)
    assert sentence_ends([("s", df.limit(0), "id", "text")], known.limit(0), ["pdf_name", "para_global_id"], "sent_global_id", "text").count() == 0


def test_marks_of_other_scripts(splitter):
    for text, first in (("កាបូនត្រូវបានវាស់។ វាភ្លឺ។", "កាបូនត្រូវបានវាស់។"), ("နမူနာကိုတိုင်းတာသည်။ တောက်ပသည်။", "နမူနာကိုတိုင်းတာသည်။"), ("ናሙናው ተለካ። ያበራል።", "ናሙናው ተለካ።"), ("Նմուշը չափվեց։ Այն փայլում է։", "Նմուշը չափվեց։")):
        ends = splitter.ends(text)
        assert len(first) in ends and ends[-1] == len(text), (text, ends)


def test_the_drawn_sentences_do_not_depend_on_partitions(spark):
    known = spark.createDataFrame([("d", p, i, f"Sentence {i} of {p}.") for p in range(80) for i in range(5)], "pdf_name string, para_global_id int, sent_global_id int, text string")
    drawn = [rows(training_rows(known.repartition(n), ["pdf_name", "para_global_id"], "sent_global_id", "text", 60)) for n in (1, 5)]
    assert drawn[0] == drawn[1] and 40 <= len(drawn[0]) <= 60
