import random

import pytest

from dotledger.llm.names import THRESHOLD, Matcher, edits, map_names, parse_name, plain_name, unmatched_values
from tests.conftest import rows

ENTRIES = [(1, "P-Turmeric-CDs-180"), (2, "Mn-Kelp-ash-CNDs"), (3, "N,S-Saffron-CDs-240"), (4, "Tangerine-CQDs-240"), (5, "N-Citrate-GQDs-1"), (6, "Zn-Histamine-CNDs-3"), (7, "Zn-Histamine-CNDs-2")]
M = Matcher(ENTRIES)


@pytest.mark.parametrize("typed, entry", [
    ("p-turmeric-cds-180", 1), ("Turmeric CDs, P-doped (180)", 1), ("CDs-180 (P-Turmric)", 1), ("as-prepared phosphorus-doped Tumreric carbon dots no. 180 (this work)", 1), ("Mn_Klp-ash_carbon nanodots", 2), ("MN-KELP-ASHC-NDS", 2), ("nitrogen/sulfur-doped Saffron C-dots #240", 3),
    ("tangerine carbon quantum dots (240)", 4), ("'N--Citarte--G-QDs--1'", 5), ("Ζn-Histаmine-CNDs-3", 6), ("Zn-Histamine-CNDs-2 ", 7), ("Zn-Histamine-CNDs-4", -1), ("B-Turmeric-CDs-180", -1), ("P-Turmeric-CDs", -1), ("P-Lampblack-CDs-180", -1), ("blank", -1), ("CDs-3", -1), ("rhodamine standard", -1),
])
def test_matching(typed, entry):
    assert M.match(typed) == entry


def test_single_typos_are_found():
    rng = random.Random(3)
    for name_id, name in ENTRIES:
        for _ in range(40):
            k = name.index(max(name.split("-"), key=len)) + rng.randrange(1, 4)  # within the stem
            typed = name[:k] + rng.choice(["", name[k] * 2]) + name[k + 1 :]
            assert M.match(typed) == name_id, typed


def test_edits():
    assert edits("abc", "acb", 2) == 1 and edits("abc", "abc", 2) == 0 and edits("abcd", "xyz", 2) > 2 and edits("", "ab", 2) == 2


def test_parse():
    assert parse_name("sample n,s-doped kelp-ash cqds no. 2") == ("n,s", "kelpash", "CQD", "2") and parse_name("test 7") is None


def test_operator_edges(spark):
    entries = spark.createDataFrame([(*e, "d") for e in ENTRIES] + [(None, "x", None), (9, None, None)], "name_id bigint, name string, description string")
    values = [(1, "p turmeric cds 180"), (2, None), (3, " n/a "), (4, "Not Reported"), (5, "P-Turmeric-CDs-180"), (6, "-"), (7, ""), (8, "test 7"), (8, "test 7")]
    df = spark.createDataFrame([(k, v, "z") for k, v in values], "id bigint, v string, name_id string")
    mapped = map_names([("s", df, "id", "v")], entries)
    assert rows(mapped.select("row_id", "name_id")) == [(1, 1), (8, -1), (8, -1)]
    assert rows(unmatched_values(mapped)) == [("s", "test 7", 2)]
    assert map_names([("s", df.limit(0), "id", "v")], entries.limit(0)).count() == 0


def test_other_values_by_the_plain_parser():
    cities = Matcher([(1, "Berlin"), (2, "München"), (3, "Bergen"), (4, "San Francisco"), (5, "東京都")], plain_name)
    assert [cities.match(x) for x in ("Berlinn", "MUNCHEN", "münchen ", "san-fransisco", "Bergen", "東京都", "Oslo", "")] == [1, 2, 2, 4, 3, 5, -1, -1]


def test_retrieval_leaves_none_out_and_compares_few():
    """Against all pairs: what the index retrieves has every stem whose cosine reaches the threshold, and is a small part of the list."""
    rng = random.Random(11)
    syllables = [a + b for a in "bcdfghklmnprstvz" for b in ("a", "e", "i", "o", "u", "an", "el", "ir", "os", "um")]
    names = sorted({"".join(rng.choice(syllables) for _ in range(rng.randint(3, 5))) for _ in range(3000)})
    m = Matcher(list(enumerate(names)), plain_name)
    for name in rng.sample(names, 150):
        k = rng.randrange(len(name))
        typed = name[:k] + rng.choice("abcdefgh") + name[k + rng.randint(0, 1) :]
        vector, norm = m.vector(typed)
        unit = {g: w / norm for g, w in vector.items()}
        near = {i for i, v in enumerate(m.vectors) if sum(w * v.get(g, 0.0) for g, w in unit.items()) >= THRESHOLD}
        assert near <= m.candidates(unit)
        m.ranked(typed)
    assert m.compared / m.seen < 0.2 * len(names), m.compared / m.seen / len(names)


def test_long_list_in_groups(spark):
    entries = spark.createDataFrame([*ENTRIES, (11, "blank"), (12, "P-Turmeric-CDs-180 "), (13, None)], "name_id bigint, name string")
    typed = ["p turmeric cds 180", "Turmeric CDs, P-doped (180)", "nitrogen/sulfur-doped Saffron C-dots #240", "Blank", "B-Turmeric-CDs-180", "rhodamine standard", "MN-KELP-ASHC-NDS", "'N--Citarte--G-QDs--1'", None, "n/a"]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(typed * 2)], "id bigint, v string")
    whole = rows(map_names([("s", df, "id", "v")], entries))
    assert whole == rows(map_names([("s", df, "id", "v")], entries, most=2)) and len(whole) == 16
