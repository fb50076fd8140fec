import json
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from dotledger.functions.unpack import flatten_lists, split_cells
from dotledger.operators.packed import unpack_fields
from tests.conftest import rows

CASES = [
    ("a; b", ["a", "b"]), ('["x, y", "z"]', ["x, y", "z"]), ("['Ex', 'QY']", ["Ex", "QY"]), ('"leaf extract, boiled","maleic acid"', ["leaf extract, boiled", "maleic acid"]), (None, []), ("", []), ("   ", []),
    ("chitosan (low MW, 75-85%); x", ["chitosan (low MW, 75-85%)", "x"]), ("N,N'-m; 2,2'-b", ["N,N'-m", "2,2'-b"]), ("a, b and c", ["a", "b", "c"]), ("a, b, and c", ["a", "b", "c"]), ("13,05 mL", ["13,05 mL"]),
    ("x;; y;;", ["x", "y"]), ("N/A", ["N/A"]), ("N/A / 3 g", ["N/A", "3 g"]), ("lignin [kraft, low]; q", ["lignin [kraft, low]", "q"]), (" [kraft] lignin; foo [bar]", ["[kraft] lignin", "foo [bar]"]), ('5" tube; b', ['5" tube', "b"]),
    ("(a; b", ["(a", "b"]), ('["N,N\'-m", "urea"]', ["N,N'-m", "urea"]), ("、、", []), ("a\nb\n", ["a", "b"]), ("中；文", ["中", "文"]), ('["only"]', ["only"]), ("[]", []), ("a | a", ["a", "a"]), ("x + y", ["x", "y"]), ("Na+ salt", ["Na+ salt"]),
]


def test_cases_together_and_alone():
    cells = [c for c, _ in CASES]
    assert split_cells(pa.array(cells)).to_pylist() == [e for _, e in CASES]
    for cell, expected in CASES:
        assert split_cells(pa.array([cell], pa.string())).to_pylist() == [expected]


def test_tags_by_slash_or_blank():
    assert split_cells(pa.array(["Ex/Em", "N/A", "ExDep lifetime", "a; b c"]), tight_slash=True, blank=True).to_pylist() == [["Ex", "Em"], ["N/A"], ["ExDep", "lifetime"], ["a", "b c"]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text("abcé中 -,()1", min_size=1, max_size=6).map(str.strip).filter(bool), min_size=1, max_size=4), max_size=6))
def test_json_lists_come_back(lists):
    cells = [json.dumps(x, ensure_ascii=False) for x in lists]
    assert split_cells(pa.array(cells, pa.string())).to_pylist() == lists


def test_slices_and_positions():
    column = pa.array(["x", "a; b", None, "c; d; e"])[1:]
    parent, pos, items = flatten_lists(split_cells(column), least=2)
    assert parent.tolist() == [0, 0, 2, 2, 2] and pos.tolist() == [0, 1, 0, 1, 2] and items.to_pylist() == list("abcde")


def test_against_plain_splitter():
    rng = random.Random(1)
    for _ in range(300):
        cell = "".join(rng.choice("ab ;|,") for _ in range(rng.randint(0, 12)))
        plain, piece = [], ""
        for k, c in enumerate(cell):
            if c in ";|" or c == "," and (k + 1 == len(cell) or cell[k + 1] == " "):
                plain.append(piece)
                piece = ""
            else:
                piece += c
        assert split_cells(pa.array([cell])).to_pylist()[0] == [p.strip() for p in (*plain, piece) if p.strip()]


def test_operator_edges(spark):
    schema = "id bigint, a string, b string, k string, pos int, item string"
    df = spark.createDataFrame([(1, "x; y", None, "k", 7, "z"), (1, "x; y", None, "k", 7, "z"), (2, None, "", None, None, None), (3, "one", "p|q", None, 1, "w")], schema)
    assert rows(unpack_fields(df, "id", ["a", "b"], "s")) == sorted([("s", 1, "a", 0, "x"), ("s", 1, "a", 1, "y")] * 2 + [("s", 3, "b", 0, "p"), ("s", 3, "b", 1, "q")], key=repr)
    assert rows(unpack_fields(df.limit(0), "id", ["a", "b"], "s")) == []
    long = spark.createDataFrame([(1, "; ".join(["word"] * 20_000), None)], "id bigint, a string, b string")
    assert unpack_fields(long, "id", ["a", "b"], "s").count() == 20_000


@pytest.mark.parametrize("width", [1, 3])
def test_brackets_close_per_cell(width):
    assert split_cells(pa.array(["(a; b", "c; d)"] * width)).to_pylist() == [["(a", "b"], ["c", "d)"]] * width
