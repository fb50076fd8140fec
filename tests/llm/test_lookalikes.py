import unicodedata

import pytest
from hypothesis import given, settings, strategies as st

from dotledger.llm.lookalikes import CLASSES, Rewriter, choose_representatives, consistent_text, count_members
from tests.conftest import rows

R = Rewriter()


@pytest.mark.parametrize("text, plain", [
    ("Τhe α-helix", "The α-helix"), ("СDs Ѕ-Ginkgo", "CDs S-Ginkgo"), ("По данным А. Б. Яровика", "По данным А. Б. Яровика"), ("Α. B. Pellimo", "A. B. Pellimo"), ("été", "été"), ("ﬁltrate", "filtrate"), ("ｄｙｅ １２", "dye 12"),
    ("👩‍🔬", "👩‍🔬"), ("H﻿ist", "Hist"), ("as‑prepared", "as-prepared"), ("a b c", "a b c"), ("25 μm and 10⁻³ m²", "25 μm and 10⁻³ m²"), ("量子，产率！１", "量子，产率！1"), ("नमूना क्‍ष", "नमूना क्‍ष"), ("Раствoр", "Раствор"), ("ΑΒΓ", "ΑΒΓ"), ("", ""),
])
def test_rewriting(text, plain):
    assert R.rewrite(text) == plain


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_rewriting_twice_is_rewriting_once(text):
    once = R.rewrite(text)
    assert R.rewrite(once) == once


@given(st.text(st.characters(max_codepoint=126, min_codepoint=32), max_size=40))
def test_ascii_stays(text):
    assert R.rewrite(text) == text


def test_classes_are_disjoint_and_transitive():
    members = [x for g in CLASSES for x in g]
    assert len(members) == len(set(members))
    of = {x: k for k, g in enumerate(CLASSES) for x in g}
    assert of["o"] == of["ο"] == of["о"] == of["ｏ"] and of[""] == of["​"]


def test_representatives_follow_the_corpus(spark):
    df = spark.createDataFrame([(unicodedata.normalize("NFD", "é"),)] * 3 + [("é o",), (None,)], "t string")
    reps = choose_representatives(count_members([(df, "t")]))
    k = next(k for k, g in enumerate(CLASSES) if "é" in g)
    assert reps[k, ""] == unicodedata.normalize("NFD", "é")


def test_operator_edges(spark):
    df = spark.createDataFrame([(1, "plain", "x", True), (2, "Τhe", "y", True), (3, None, None, None), (4, "", "", False), (2, "Τhe", "y", True)], "id bigint, t string, text string, changed boolean")
    got = rows(consistent_text([("s", df, "id", "t")]))
    assert got == sorted([("s", 1, "plain", False), ("s", 2, "The", True), ("s", 2, "The", True), ("s", 3, None, False), ("s", 4, "", False)], key=repr)
    assert rows(consistent_text([("s", df, "id", "t")], changed_only=True).select("row_id")) == [(2,), (2,)]
    assert consistent_text([("s", df.limit(0), "id", "t")]).count() == 0


def test_the_more_frequent_spelling_of_a_ligature_stays(spark):
    df = spark.createDataFrame([(1, "film and filter"), (2, "ﬁlm"), (3, "f"), (4, "i"), (5, "oﬃce"), (6, "oﬃce"), (7, "office"), (8, None)], "id bigint, t string")
    counts = count_members([(df, "t")])
    of = {x: k for k, g in enumerate(CLASSES) for x in g}
    assert counts[of["fi"], ""] == {"fi": 3, "ﬁ": 1} and counts[of["ffi"], ""] == {"ffi": 1, "ﬃ": 2}
    assert rows(consistent_text([("s", df, "id", "t")], changed_only=True)) == [("s", 2, "film", True)]
